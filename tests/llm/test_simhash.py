"""Fingerprints, links and components against comparing all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from fixtures import no_docs, odd_docs, prose

from tidemark.llm import simhash
from tidemark.llm.components import components


def plain_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(fps):
    """Least member of each value's component among distinct values."""
    root = {f: f for f in fps}
    while True:
        new = {f: min(root[g] for g in root if (f ^ g).bit_count() <= simhash.RADIUS) for f in root}
        if new == root:
            return root
        root = new


def test_fingerprint_equals_the_definition():
    for text in ["", " ", "a", "A b", "a b c D", prose(1, 300), "É é Ü a\x1cb c\xa0d", "x " * 70_000, "日本 語 a b c d"]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_spark_hash_is_the_same_function(spark):
    value = spark.sql("SELECT xxhash64('abc def')").first()[0]
    assert value % 2**64 == xxhash.xxh64_intdigest(b"abc def", 42)


def near(rng, f, bits):
    for b in rng.sample(range(64), bits):
        f ^= 1 << b
    return f


@pytest.mark.parametrize("part", [16_384, 40])
def test_links_connect_all_near_fingerprints(spark, monkeypatch, part):
    """Chains, a dense ball, and lone values; with a small part size groups are dealt over pairs of parts."""
    monkeypatch.setattr(simhash, "PART", part)
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for seed in list(fps)[:40]:
        for _ in range(4):
            seed = near(rng, seed, 4)
            fps.add(seed)
    ball = rng.getrandbits(64)
    fps |= {near(rng, ball, rng.randrange(1, 4)) for _ in range(150)}
    rows = spark.createDataFrame([(int(np.array(f, "u8").view("i8")),) for f in fps], "fp long").repartition(5)
    found = {r.node % 2**64: r.root for r in components(simhash.links(rows)).collect()}
    wanted = plain_groups(fps)
    groups, own = {}, {}
    for f in fps:
        groups.setdefault(wanted[f], set()).add(f)
        own.setdefault(found.get(f, f"alone {f}"), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, own.values()))
    assert simhash.links(rows).count() <= 15 * len(fps) * 4


def test_pivots_never_discard_a_link():
    rng = random.Random(8)
    left = np.array([rng.getrandbits(64) for _ in range(2000)], "u8")
    right = np.array([near(rng, int(f), rng.randrange(7)) for f in left], "u8")
    table = simhash.pivot_table(np.concatenate([left, right]))
    at = np.arange(2000)
    linked = np.bitwise_count(left ^ right) <= 4
    assert (simhash._near(np.concatenate([left, right]), table, at, at + 2000) == linked).all()


def test_batches_may_cut_groups():
    rng = random.Random(4)
    base = rng.getrandbits(63)
    fps = [near(rng, base, 1) for _ in range(30)]
    fps = sorted({int(np.array(f, "u8").view("i8")) for f in fps})
    rows = pa.RecordBatch.from_arrays([pa.array([0] * len(fps)), pa.array([7] * len(fps)), pa.array([0] * len(fps)), pa.array(fps)], list("mkpf"))
    whole = sum(b.num_rows for b in simhash._link_task(iter([rows])))
    cut = sum(b.num_rows for b in simhash._link_task(iter([rows.slice(k, 1) for k in range(len(fps))])))
    assert whole == cut == len(fps) - 1


def copies():
    text = prose(11, 900)
    return [(100 + k, text + f" tail{k}", "en", "n", 1, None, None) for k in range(12)] + [(90, text, "en", "n", 1, None, None)]


def test_near_copies_and_deduplication(spark):
    docs = odd_docs(spark, copies())
    rows = simhash.near_copies(docs).collect()
    assert len(rows) == docs.count()
    texts = docs.collect()
    roots = plain_groups({plain_fingerprint(r.text) for r in texts})
    least = {}
    for r in texts:
        root = roots[plain_fingerprint(r.text)]
        if r.doc_id is not None:
            least[root] = min(least.get(root, r.doc_id), r.doc_id)
    wanted = sorted((str(r.doc_id), f"{plain_fingerprint(r.text):016x}", str(least.get(roots[plain_fingerprint(r.text)]))) for r in texts)
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == wanted
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    kept = kept.collect()
    assert sorted(roots[plain_fingerprint(r.text)] for r in kept) == sorted({roots[plain_fingerprint(r.text)] for r in texts})
    for r in kept:
        assert r.doc_id == least.get(roots[plain_fingerprint(r.text)])
    assert simhash.near_copies(no_docs(spark)).count() == 0 and simhash.keep_one(no_docs(spark)).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(6)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 200 + k) for k in range(50)] + [(5000, 5000), (None, 3), (-7, 9000)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(80)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges if None not in e for x in e}
    for _ in root:
        for a, b in edges:
            if a is not None:
                root[a] = root[b] = min(root[a], root[b])
    assert found == root
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
