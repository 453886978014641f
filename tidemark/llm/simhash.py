"""Near copies by 64-bit fingerprints and pivot distance tables."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components, fresh
from tidemark.llm.frames import as_row, by_batch, held, row_columns, whole_text

SHINGLE = 4
RADIUS = 4
SEED = 42
# With two more bands than differing bits allowed, any link agrees on two whole bands.
BANDS = (11, 11, 11, 11, 10, 10)
PIVOTS = 16
# Fingerprints of one band pair that one task compares; larger groups are dealt over pairs of parts.
PART = 16_384
# Groups up to this size are compared by shifts over the whole batch, larger ones by growing components.
SMALL = 8
_CHUNK = 65_536


def fingerprint(text: str) -> int:
    """Unsigned fingerprint; zero without words."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = ends - sizes + 1
    last = ends[SHINGLE - 1 :] if len(words) >= SHINGLE else ends[-1:]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(last), _CHUNK):
        stop = last[at : at + _CHUNK].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array(
            [digest(joined[a:b], SEED) for a, b in zip(starts[at : at + len(stop)].tolist(), stop, strict=True)], "<u8"
        )
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(last)).view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``tie`` (hash of the text) and ``fp`` (signed fingerprint) of every row."""

    def run(batch: pa.Table) -> pa.Table:
        found = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], "<u8").view("<i8")
        return pa.table({"doc_id": batch.column("doc_id"), "tie": batch.column("tie"), "fp": pa.array(found, pa.int64())})

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(whole_text()).alias("tie"), whole_text().alias("text")
    )
    return by_batch(rows, run, "doc_id long, tie long, fp long")


def _masks() -> list[int]:
    """Signed masks of all pairs of bands."""
    low = np.cumsum([0, *BANDS])
    bands = [((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(low[:-1], low[1:], strict=True)]
    return [int(np.array([x | y], "u8").view("i8")[0]) for x, y in combinations(bands, len(BANDS) - RADIUS)]


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint to the reference fingerprints, which follow from their numbers."""
    import xxhash

    pivots = np.array([xxhash.xxh64_intdigest(f"pivot {k}", SEED) for k in range(PIVOTS)], "u8")
    return np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)


def _near(fps: np.ndarray, table: np.ndarray, left: np.ndarray | int, right: np.ndarray) -> np.ndarray:
    """Which pairs link: the pivots discard most, the rest are verified."""
    near = np.abs(table[left] - table[right]).max(axis=1) <= RADIUS
    rest = np.flatnonzero(near)
    first = fps[left] if np.isscalar(left) else fps[left[rest]]
    near[rest] = np.bitwise_count(first ^ fps[right[rest]]) <= RADIUS
    return near


def spanning_links(group: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what links within each group; ``group`` is sorted, fingerprints differ within one."""
    table = pivot_table(fps)
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(starts, len(group)))
    size = np.repeat(sizes, sizes)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for shift in range(1, SMALL):
        left = np.flatnonzero((group[:-shift] == group[shift:]) & (size[shift:] <= SMALL)) if len(group) > shift else []
        if len(left) == 0:
            break
        left = left[_near(fps, table, left, left + shift)]
        found.append((left, left + shift))
    for start, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL], strict=True):
        rest = np.arange(start, start + n)
        while len(rest):
            grow, rest = [rest[0]], rest[1:]
            while grow and len(rest):
                node = int(grow.pop())
                near = _near(fps, table, node, rest)
                hits = rest[near]
                found.append((np.full(len(hits), node), hits))
                grow.extend(hits)
                rest = rest[~near]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    left, right = (np.concatenate(x) for x in zip(*found, strict=True))
    return fps[left].view("i8"), fps[right].view("i8")


def _link_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each run of equal (mask, key, part); the last run of a batch waits for the next."""
    waiting: list[np.ndarray] = []

    def linked(rows: list[np.ndarray]) -> pa.RecordBatch:
        change = np.zeros(len(rows[0]), bool)
        for column in rows[:-1]:
            change[1:] |= column[1:] != column[:-1]
        a, b = spanning_links(np.cumsum(change), rows[-1].astype("i8").view("u8"))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if waiting:
            rows = [np.concatenate(x) for x in zip(waiting, rows, strict=True)]
        if not len(rows[0]):
            continue
        same = np.ones(len(rows[0]), bool)
        for column in rows[:-1]:
            same &= column == column[-1]
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        waiting = [x[cut:] for x in rows]
        if cut:
            yield linked([x[:cut] for x in rows])
    if waiting:
        yield linked(waiting)


def links(classes: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct fingerprints ``fp`` within the radius of each other.

    Random pivots alone cannot place fingerprints (two unrelated ones differ by
    at most 4 in one coordinate in 57 of 100 cases), so candidates share two
    whole bands, which every link does. Pivot tables discard candidates and
    the rest are verified bit by bit. A group of more than ``PART``
    fingerprints is dealt over pairs of its parts. Only links that connect are
    emitted, at most one for each member and group beyond ``SMALL``.
    """
    keys = classes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("mask"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key"))
        for k, m in enumerate(_masks())
    ])).alias("x")).select("x.mask", "x.key", "fp")
    hot = (
        keys.groupBy("mask", "key").agg(F.count("*").alias("n")).where(F.col("n") > PART)
        .select(F.col("mask").alias("__mask"), fresh("key").alias("__key"), F.ceil(F.col("n") / PART).cast("int").alias("__parts"))
    )
    own = F.pmod(F.xxhash64("fp"), F.col("__parts")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("__parts") - 1),
        lambda other: F.least(own, other) * F.col("__parts") + F.greatest(own, other),
    )
    dealt = keys.join(hot, (F.col("mask") == F.col("__mask")) & (F.col("key") == F.col("__key")), "left").select(
        "mask", "key", F.explode(F.when(F.col("__parts").isNull(), F.array(F.lit(0))).otherwise(pairs)).alias("part"), "fp"
    )
    ordered = dealt.repartition("mask", "key", "part").sortWithinPartitions("mask", "key", "part")
    return ordered.mapInArrow(_link_task, "a long, b long").distinct()


def grouped(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``tie``, ``fp`` and ``root`` (least fingerprint that links reach) of every row."""
    rows = held(fingerprints(docs))
    roots = components(links(rows.select("fp").distinct()))
    return rows.join(roots.select(fresh("node").alias("__fp"), "root"), F.col("fp") == F.col("__fp"), "left").select(
        "doc_id", "tie", "fp", F.coalesce("root", "fp").alias("root")
    )


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def near_copies(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id`` of every row.

    A component's id is the least document id in it; null when all its ids are
    null. Null and empty texts have fingerprint zero, which links like any
    other. Equal rows and repeated ids each give a row. Other columns are not
    read. An empty table gives an empty result.
    """
    rows = held(grouped(docs))
    least = rows.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    least = least.select(fresh("root").alias("__root"), "component_id")
    return rows.join(least, F.col("root") == F.col("__root")).select(
        "doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one document of each component: the least id, null ids last.

    Rows that agree in id and text count as one document.
    """
    rows = grouped(docs)
    best = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")).alias("x"))
    kept = best.select(
        F.col("x.none").alias("__k_none"), F.coalesce("x.doc_id", F.lit(0)).alias("__k_id"), F.col("x.tie").alias("__k_tie")
    )
    marked = docs.select(
        as_row(docs), F.col("doc_id").isNull().alias("__none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("__id"),
        F.xxhash64(whole_text()).alias("__tie"),
    )
    same = (F.col("__none") == F.col("__k_none")) & (F.col("__id") == F.col("__k_id")) & (F.col("__tie") == F.col("__k_tie"))
    return marked.join(kept, same, "left_semi").dropDuplicates(["__none", "__id", "__tie"]).select(*row_columns(docs.columns))
