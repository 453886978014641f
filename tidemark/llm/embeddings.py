"""Near copies among vectors: cover trees, traversed in pairs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components, fresh
from tidemark.llm.frames import held

COSINE = 0.98
# Distinct vectors of one tree; a label with more of them has several trees.
PART = 2048
LEAF = 16
# Distances of unit vectors are rounded, most near zero; pruning leaves this much room.
ROOM = 1e-6


class Node:
    """A ball of a cover tree: its centre, the largest distance to a member, and its children or members."""

    __slots__ = ("centre", "centres", "children", "members", "radii", "radius")

    def __init__(self, centre: np.ndarray, radius: float, members: np.ndarray):
        self.centre, self.radius, self.members = centre, radius, members
        self.children: list[Node] = []


def _distances(products: np.ndarray) -> np.ndarray:
    """Distances of unit vectors from their inner products."""
    return np.sqrt(np.maximum(2.0 - 2.0 * products, 0.0))


def cover_tree(units: np.ndarray, members: np.ndarray, reach: float, level: float = 2.0) -> Node:
    """Nested levels: children cover their members within half the parent's level, the first child keeps its centre.

    A ball no wider than ``reach`` stays whole, as most of its members link anyway.
    """
    away = _distances(units[members] @ units[members[0]])
    node = Node(units[members[0]], float(away.max()), members)
    if len(members) <= LEAF or node.radius <= reach:
        return node
    while node.radius <= level / 2:
        level /= 2
    own = units[members]
    near = _distances(own @ own.T) <= level / 2
    free = np.ones(len(members), bool)
    for k in range(len(members)):
        if free[k]:
            taken = near[k] & free
            taken[k] = True
            free &= ~taken
            node.children.append(cover_tree(units, members[taken], reach, level / 2))
    node.centres = np.stack([c.centre for c in node.children])
    node.radii = np.array([c.radius for c in node.children])
    return node


def close_pairs(left: Node, right: Node, reach: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Member lists of all pairs of leaves that may hold two vectors within ``reach``."""
    found, stack = [], [(left, right)]
    while stack:
        a, b = stack.pop()
        if not a.children and not b.children:
            found.append((a.members, b.members))
            continue
        # Nodes with children are opened together, a leaf stays; the covering radii prune all their pairs at once.
        a_centres, a_radii = (a.centres, a.radii) if a.children else (a.centre[None, :], np.array([a.radius]))
        b_centres, b_radii = (b.centres, b.radii) if b.children else (b.centre[None, :], np.array([b.radius]))
        near = _distances(a_centres @ b_centres.T) <= reach + a_radii[:, None] + b_radii[None, :] + ROOM
        for i, j in zip(*np.nonzero(near), strict=True):
            stack.append((a.children[i] if a.children else a, b.children[j] if b.children else b))
    return found


def linked_within(ids: np.ndarray, counts: np.ndarray, vectors: np.ndarray, part: np.ndarray, cosine: float) -> pd.DataFrame:
    """For each vector with a link between the two parts: links (with copies) and a connected lesser vector."""
    norms = np.sqrt((vectors**2).sum(axis=1))
    units = vectors / norms[:, None]
    parts = [np.flatnonzero(part == p) for p in np.unique(part)]
    reach = float(np.sqrt(2 - 2 * cosine))
    trees = [cover_tree(units, p, reach) for p in parts]
    left, right = [], []
    # Both orders of a pair of leaves come up within one tree; the lesser place counts.
    for a, b in close_pairs(trees[0], trees[-1], reach):
        near = (vectors[a] @ vectors[b].T) / (norms[a][:, None] * norms[b][None, :]) >= cosine
        if len(trees) == 1:
            near &= a[:, None] < b[None, :]
        i, j = np.nonzero(near)
        left.append(a[i])
        right.append(b[j])
    i = np.concatenate(left) if left else np.empty(0, np.int64)
    j = np.concatenate(right) if right else np.empty(0, np.int64)
    links = np.bincount(i, counts[j], len(ids)) + np.bincount(j, counts[i], len(ids))
    root = np.arange(len(ids))
    while len(i):
        least = root.copy()
        np.minimum.at(least, i, root[j])
        np.minimum.at(least, j, root[i])
        least = least[least]
        if (least == root).all():
            break
        root = least
    some = np.flatnonzero(links > 0)
    return pd.DataFrame({"node": ids[some], "other": ids[root[some]], "links": links[some].astype(np.int64)})


def near_vectors(
    table: DataFrame, cosine: float = COSINE, id_name: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Rows link when labels are equal and not null, lengths are equal, and the
    cosine in double precision is at least ``cosine``. Null or zero vectors and
    those with null or non-finite components link with nothing, and are
    components of their own. Equal vectors of a label are taken together and
    counted. Distinct vectors of a label are dealt by hash over parts of about
    2,048; every part and pair of parts is one small group: it builds cover
    trees over unit vectors and walks them in pairs. So the work within a label
    is spread evenly, however large its share of the rows. A group returns link
    counts and one connecting link for each vector, never its pairs.

    A component's id is the least id reachable. A row with a null id has links
    and a component, but is never kept. Rows that repeat an id count as vectors
    of their own; each row of the least id is kept. Other columns are not
    read. An empty table gives an empty result.
    """
    given = F.transform(F.col(vector), lambda x: x.cast("double"))
    # Scaled by a power of two, which changes no cosine, so that squares neither overflow nor vanish.
    largest = F.array_max(F.transform(given, F.abs))
    exponent = F.greatest(F.lit(-1022.0), F.least(F.lit(1022.0), -F.floor(F.log2(largest)).cast("double")))
    values = F.when((largest > 0) & (largest < float("inf")), F.transform(given, lambda x: x * F.pow(F.lit(2.0), exponent)))
    # A finite sum of squares leaves out NaN, infinities and zero vectors; a null component makes it null.
    square = F.aggregate(values, F.lit(0.0), lambda total, x: total + x * x)
    fine = F.col(label).isNotNull() & (square > 0) & (square < float("inf"))
    rows = held(table.select(
        F.col(id_name).cast("long").alias("vec_id"), F.col(label).alias("label"),
        F.when(fine, values).alias("vector"),
    ))
    classes = held(
        rows.where("vector IS NOT NULL").groupBy("label", "vector").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    sizes = classes.groupBy("label", F.size("vector").alias("size")).agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    sizes = sizes.select(F.col("label").alias("__label"), F.col("size").alias("__size"), "parts")
    dealt = classes.join(sizes, (F.col("label") == F.col("__label")) & (F.size("vector") == F.col("__size"))).withColumn(
        "part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    )
    # One row for the part itself and for each pair with another part.
    blocks = dealt.select(
        "node", "copies", "vector", "__label", "__size", "part",
        F.explode(F.transform(
            F.sequence(F.lit(0), F.col("parts") - 1),
            lambda o: F.struct(F.least("part", o).alias("a"), F.greatest("part", o).alias("b")),
        )).alias("x"),
    )

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        part = group["part"].to_numpy()
        if group["a"].iat[0] != group["b"].iat[0] and part.min() == part.max():
            return pd.DataFrame({"node": [], "other": [], "links": []}).astype("int64")
        return linked_within(
            group["node"].to_numpy(), group["copies"].to_numpy(), np.stack(group["vector"].to_list()), part, cosine
        )

    found = held(
        blocks.select("node", "copies", "vector", "__label", "__size", "part", "x.a", "x.b")
        .groupBy("__label", "__size", "a", "b").applyInPandas(run, "node long, other long, links long")
    )
    roots = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    marked = held(
        classes.select("label", "vector", "copies", "least", "node")
        .join(links.select(fresh("node").alias("__n"), "links"), F.col("node") == F.col("__n"), "left")
        .join(roots.select(fresh("node").alias("__m"), "root"), F.col("node") == F.col("__m"), "left")
        .select("label", "vector", "least", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    least = marked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = marked.join(least.select(fresh("root").alias("__root"), "component_id"), F.col("root") == F.col("__root")).select(
        F.col("label").alias("__label"), F.col("vector").alias("__vector"), "n_links", "component_id"
    )
    same = (F.col("label") == F.col("__label")) & (F.col("vector") == F.col("__vector"))
    alone = F.col("vector").isNull()
    return rows.join(named, same, "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("vec_id") == F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")), F.lit(False)).alias("kept"),
    )
