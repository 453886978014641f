"""Targets and draws of the mix."""

import random
import re
from collections import defaultdict

import pytest
from fixtures import DOCS, no_docs, odd_docs, prose

from tidemark.llm import mixing


def targets(sizes):
    """Share, stop at twice the size, reshare the excess by weight until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    cap = {s: 2.0 * sizes[s] for s in names}
    left, found, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > cap[s]}
        if not full:
            return found | {s: level * weight[s] for s in free}
        for s in full:
            found[s] = cap[s]
            left -= cap[s]
        free -= full
    return found


def many(spark):
    rng = random.Random(4)
    rows = []
    for k in range(900):
        source = "hot" if k % 3 else f"src{k % 7}"
        rows.append((k, prose(k, rng.randrange(1, 120)), "en", source, 1, None, None))
    return spark.createDataFrame([*rows, (2000, prose(1, 700), "en", None, 1, None, None), (2001, "", "en", "nil", 0, None, None)], DOCS)


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("build", [many, odd_docs])
def test_sources_come_near_their_targets(spark, build):
    docs = build(spark)
    rows = mixing.decide(docs).collect()
    assert len(rows) == docs.count()
    sizes, by_source = defaultdict(int), defaultdict(list)
    for r in docs.collect():
        sizes[r.source] += size(r.text)
    for r in rows:
        by_source[None if r["__source"] == "1" else r["__source"][1:]].append(r)
    assert set(by_source) == set(sizes)
    for source, target in targets(sizes).items():
        own = by_source[source]
        assert all(abs(r.target - target) < 1e-6 * max(1, target) and r.source_size == sizes[source] for r in own)
        taken = sum(r.size * r.times for r in own)
        assert all(0 <= r.times <= 2 for r in own)
        largest = max(r.size for r in own)
        assert abs(taken - target) <= largest / 2 + 1
        if build is many and source == "hot":
            assert abs(taken - target) <= 2
        # Whole epochs first: every row is taken at least as often as the target goes into the source.
        if sizes[source]:
            assert min((r.times for r in own if r.size), default=0) >= int(target // sizes[source])


def test_reruns_agree_and_partitions_do_not_matter(spark):
    def state(docs):
        return sorted((r.doc_id, r.times) for r in mixing.decide(docs).collect())

    assert state(many(spark)) == state(many(spark).repartition(7)) == state(many(spark).orderBy("text").coalesce(1))


def test_quality_makes_texts_likelier(spark):
    rows = [(k, prose(k, 30) if k % 2 else "#1# " * 30, "en", "ab"[k % 3 == 0], 1, None, None) for k in range(3000)]
    taken = defaultdict(list)
    for r in mixing.decide(spark.createDataFrame(rows, DOCS)).collect():
        taken[r.doc_id % 2].append(r.times)
    assert sum(taken[1]) > 1.1 * sum(taken[0])


def test_rows_are_taken_as_often_as_decided(spark):
    docs = odd_docs(spark)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    wanted, found = defaultdict(int), defaultdict(int)
    for r in mixing.decide(docs).collect():
        wanted[r.doc_id, r.size] += r.times
    for r in mixed.collect():
        found[r.doc_id, size(r.text)] += 1
    assert {k: v for k, v in wanted.items() if v} == dict(found)
    assert mixing.mix(no_docs(spark)).count() == 0 and mixing.decide(no_docs(spark)).count() == 0


def test_names_that_the_operator_uses_may_clash(spark):
    docs = many(spark).withColumnsRenamed({"spans": "times", "fingerprint": "target"})
    assert mixing.mix(docs).columns == docs.columns and mixing.mix(docs).count() == mixing.mix(many(spark)).count()


def test_main_path_has_no_python(spark):
    plan = mixing.mix(many(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
