"""Links between vectors against comparing all pairs."""

import random

import numpy as np
import pytest

from tidemark.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, node string, links int"


def vectors():
    rng = np.random.default_rng(5)
    rows = []
    for label in (1, 2, None):
        centres = rng.normal(size=(25, 8))
        for k in range(160):
            rows.append([centres[k % 25] + rng.normal(size=8) * 0.09, label])
    rows += [[rows[3][0], 1]] * 4 + [[rows[3][0] * 2.0, 1], [rows[3][0], 2]]
    rows = [(k, [float(np.float32(x)) for x in v], label, "x", 1) for k, (v, label) in enumerate(rows)]
    odd = [None, [], [0.0] * 8, [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7, [None] + [1.0] * 7, [1.0, 2.0], [1.0, 2.0]]
    rows += [(1000 + k, v, 1, None, None) for k, v in enumerate(odd)]
    return [*rows, (None, rows[0][1], 1, None, None), (7, rows[5][1], 1, None, None), rows[9], rows[9]]


def plain(rows):
    def usable(r):
        return r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])

    links = [set() for _ in rows]
    for i, a in enumerate(rows):
        for j in range(i):
            b = rows[j]
            if usable(a) and usable(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.98:
                    links[i].add(j)
                    links[j].add(i)
    root = list(range(len(rows)))
    changed = True
    while changed:
        new = [min([root[i], *(root[j] for j in links[i])]) for i in range(len(rows))]
        changed, root = new != root, new
    least = {}
    for r, k in zip(rows, root, strict=True):
        if r[0] is not None:
            least[k] = min(least.get(k, r[0]), r[0])
    return sorted(
        (str(r[0]), len(links[i]), str(least.get(root[i])), r[0] is not None and r[0] == least.get(root[i])) for i, r in enumerate(rows)
    )


@pytest.mark.parametrize("part", [2048, 30])
def test_links_equal_all_pairs(spark, monkeypatch, part):
    monkeypatch.setattr(embeddings, "PART", part)
    rows = vectors()
    found = embeddings.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in found) == plain(rows)


def test_empty_table(spark):
    assert embeddings.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_trees_are_nested_and_cover_their_members():
    units = np.random.default_rng(2).normal(size=(500, 6))
    units /= np.sqrt((units**2).sum(axis=1))[:, None]

    def walk(node, level):
        away = np.sqrt(((units[node.members] - node.centre) ** 2).sum(axis=1))
        assert away.max() <= node.radius + 1e-7
        assert node.radius <= level + 1e-7
        if node.children:
            assert sorted(np.concatenate([c.members for c in node.children])) == sorted(node.members)
            assert (node.children[0].centre == node.centre).all()
            for child in node.children:
                walk(child, level)

    walk(embeddings.cover_tree(units, np.arange(500), 0.2), 2.0)


def test_pruning_loses_no_pair():
    rng = random.Random(1)
    units = np.random.default_rng(4).normal(size=(400, 4))
    units /= np.sqrt((units**2).sum(axis=1))[:, None]
    at = np.array(rng.sample(range(400), 400))
    left, right = at[:180], at[180:]
    found = set()
    for a, b in embeddings.close_pairs(embeddings.cover_tree(units, left, 0.2), embeddings.cover_tree(units, right, 0.2), 0.2):
        found |= {(i, j) for i in a for j in b}
    close = {(i, j) for i in left for j in right if np.sqrt(((units[i] - units[j]) ** 2).sum()) <= 0.2}
    assert close <= found and len(found) < 180 * 220


def test_extreme_components(spark):
    rows = [(1, "a", [1e-200, 2e-200]), (2, "a", [1e-200, 2e-200]), (3, "b", [1e200, 1e200]), (4, "b", [1e300, 1e300]), (5, "c", [5e-324, 0.0]),
            (6, "c", [1.0, 0.0]), (7, "c", [0.0, 1.0]), (8, "d", [0.0, 0.0]), (9, "d", [float("inf"), 1.0]), (10, "d", [float("nan"), 1.0]), (11, "d", [None, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    found = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(df).collect()}
    assert found == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 3), 5: (1, 5), 6: (1, 5), 7: (0, 7), 8: (0, 8), 9: (0, 9), 10: (0, 10), 11: (0, 11)}
