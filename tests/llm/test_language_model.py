"""Exact scores against counting, and the filter against true counts."""

import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from fixtures import DOCS, no_docs, odd_docs, prose

from tidemark.llm import language_model as lm


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), ""]


def out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


@pytest.mark.parametrize("hot", [100_000, 3])
def test_base_scores_are_exact(spark, monkeypatch, hot):
    monkeypatch.setattr(lm, "HOT_WORDS", hot)
    docs = odd_docs(spark, [(50 + k, prose(k, 40), "en", "m", 1, None, None) for k in range(60)])
    counts = Counter(w for r in docs.collect() if not out(r.doc_id) for w in tokens(r.text))
    n, v = sum(counts.values()), len(counts)
    rows = lm.score_texts(docs).collect()
    assert len(rows) == docs.count() and any(r.held_out for r in rows)
    found = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.held_out, round(r.base_score, 6)) for r in rows)
    wanted = []
    for r in docs.collect():
        own = tokens(r.text)
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        wanted.append((str(r.doc_id), len(own), sum(counts[w] > 0 for w in own), out(r.doc_id), round(base, 6)))
    assert found == sorted(wanted)
    assert all(r.train_tokens == n and math.isfinite(r.score) and r.score < 0 for r in rows)


def test_model_prefers_texts_like_its_corpus(spark):
    rows = [(k, prose(k, 60), "en", "m", 1, None, None) for k in range(200)]
    rows += [(1000, prose(3, 60), "en", "m", 1, None, None), (1001, " ".join(reversed(prose(3, 60).split())), "en", "m", 1, None, None)]
    scores = {r.doc_id: r.score for r in lm.score_texts(spark.createDataFrame(rows, DOCS)).collect()}
    assert scores[1000] > scores[1001]


def counted(spark, values, segments=16):
    segment = lm.segment_of(values, segments)
    rows = []
    for s in np.unique(segment):
        own = values[segment == s]
        distinct, n = np.unique(own, return_counts=True)
        large = n[n >= 255].astype("<u4")
        rows.append((int(s), bytearray(distinct.view(np.uint8).reshape(-1, 8).T.tobytes()), bytearray(np.minimum(n, 255).astype(np.uint8).tobytes()), bytearray(large.tobytes())))
    return spark.createDataFrame(rows, "segment int, hashes binary, counts binary, large binary")


def test_filter_holds_quantised_counts(spark):
    rng = np.random.default_rng(1)
    distinct = rng.integers(0, 2**64 - 1, 3000, np.uint64, endpoint=True)
    counts = np.maximum(1, rng.pareto(0.8, 3000).astype(int)).clip(1, 3000)
    partial = counted(spark, np.repeat(distinct, counts))
    rows = lm._segments(partial.union(partial)).collect()
    model = lm.FrequencyFilter(rows, 0, 16, 16)
    levels = model.levels(distinct)
    true = np.floor(np.log2(2 * counts)).astype(int) + 1  # both halves are added up
    assert (levels >= true).all() and (levels == true).mean() > 0.9
    unseen = rng.integers(0, 2**64 - 1, 3000, np.uint64, endpoint=True)
    assert (model.levels(unseen) > 0).mean() < 0.05
    # Groups of segments answer the same, each for its own range of sorted n-grams.
    values = np.unique(np.concatenate([distinct, unseen]))
    parts = []
    for first in range(0, 16, 5):
        part = lm.FrequencyFilter([r for r in rows if first <= r.segment < first + 5], first, min(16, first + 5), 16)
        parts.append(part.levels(values[part.share(values)]))
    assert np.array_equal(np.concatenate(parts), model.levels(values))


def test_empty_table_and_no_training_rows(spark):
    assert lm.score_texts(no_docs(spark)).count() == 0
    held = [k for k in range(100) if out(k)][:3]
    docs = spark.createDataFrame([(k, "a b", "en", "m", 1, None, None) for k in held], DOCS)
    rows = lm.score_texts(docs).collect()
    assert [(r.n_known, r.train_tokens, r.n_tokens) for r in rows] == [(0, 0, 3)] * 3
    assert all(abs(r.base_score) < 1e-9 and math.isfinite(r.score) for r in rows)


def test_filter_grows_with_its_entries(spark):
    rng = np.random.default_rng(3)
    values = np.unique(rng.integers(0, 2**54 - 1, 40_000, np.uint64))
    spread = bytearray(values.view(np.uint8).reshape(-1, 8).T.tobytes())
    partial = spark.createDataFrame([(0, spread, bytearray(b"\1" * len(values)), bytearray())], "segment int, hashes binary, counts binary, large binary")
    row, = lm._segments(partial).collect()
    assert 8 * len(row.field) >= lm.BITS_FOR_ENTRY * len(values)
    assert (lm.FrequencyFilter([row], 0, 1, 1).levels(values) >= 1).all()
    assert lm.level_means(np.array(row.stats))[1] == 1


def plain_model(texts):
    """Probability of a word after another by plain counting; None is the start of a text."""
    single, pair = Counter(w for t in texts for w in t), Counter(x for t in texts for x in zip([None, *t], t))
    groups = {}
    for n in single.values():
        groups.setdefault(n.bit_length(), []).append(n)
    space = sum(single.values()) + 0.1 * (len(single) + 1)

    def chance(before, word):
        n = single.get(word, 0)
        own = sum(groups[n.bit_length()]) / len(groups[n.bit_length()]) if n else 0
        most = len(texts) if before is None else 2 ** single.get(before, 0).bit_length() - 1
        alone = (own + 0.1) / space
        seen = pair.get((before, word), 0)
        return 0.8 * alone + 0.2 * (2 ** (seen.bit_length() - 1) if seen else 0) / most if most else alone

    return chance, single


@pytest.mark.parametrize(("chunk", "ngrams", "group"), [(2_000_000, 1 << 20, 64 << 20), (300, 1 << 20, 2000), (300, 2, 1)])
def test_scores_follow_from_all_counts(spark, monkeypatch, chunk, ngrams, group):
    """Any cut into blocks, segments and groups gives the scores of plain counting; with many bits false positives are rare."""
    for name, value in (("CHUNK", chunk), ("SEGMENT_NGRAMS", ngrams), ("BITS_FOR_ENTRY", 256), ("GROUP_BYTES", group), ("SEGMENTS", 3)):
        monkeypatch.setattr(lm, name, value)
    if ngrams == 2:
        monkeypatch.setattr(lm, "SEGMENT_NGRAMS", 2000)
    docs = odd_docs(spark, [(50 + k, prose(k, 40), "en", "m", 1, None, None) for k in range(60)])
    chance, _ = plain_model([tokens(r.text) for r in docs.collect() if not out(r.doc_id)])
    wanted = []
    for r in docs.collect():
        t = tokens(r.text)
        wanted.append((str(r.doc_id), len(t), sum(math.log10(chance(a, b)) for a, b in zip([None, *t], t))))
    found = sorted((str(r.doc_id), r.n_tokens, r.score) for r in lm.score_texts(docs).collect())
    assert [f[:2] for f in found] == [w[:2] for w in sorted(wanted)]
    assert [f[2] for f in found] == pytest.approx([w[2] for w in sorted(wanted)])


def test_groups_do_not_add_up_in_the_driver(spark, monkeypatch):
    """Segments do not come as pickled rows, and of all groups broadcast only the last, which the result reads, is left."""
    for name, value in (("SEGMENTS", 3), ("GROUP_BYTES", 1)):
        monkeypatch.setattr(lm, name, value)
    made, long = [], []
    broadcast, collect = type(spark.sparkContext).broadcast, type(spark.range(0)).collect

    def noted(context, value):
        made.append((broadcast(context, value), isinstance(value, lm.FrequencyFilter)))
        return made[-1][0]

    def weighed(df):
        rows = collect(df)
        long.extend(v for r in rows for v in r if isinstance(v, (bytes, bytearray)))
        return rows

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", noted)
    monkeypatch.setattr(type(spark.range(0)), "collect", weighed)
    docs = odd_docs(spark)
    assert lm.score_texts(docs).count() == docs.count()
    groups = [b for b, is_filter in made if is_filter]
    assert len(groups) == 3 and not long
    assert [os.path.exists(b._path) for b in groups] == [False, False, True]


def test_chances_after_every_context_sum_to_one_at_most(spark, monkeypatch):
    """Over the vocabulary and one unseen word; the counts are those that once summed to 1.15."""
    monkeypatch.setattr(lm, "BITS_FOR_ENTRY", 256)
    train = [k for k in range(3000) if not out(k)]
    texts = [f"seven f{k}" for k in range(7)] + [f"w{k} w{(k * 7) % 200} x{k % 3}" for k in range(200) for _ in range(2)] + ["common " * 9] * 5
    rows = [(i, t, "en", "m", 1, None, None) for i, t in zip(train, texts)]
    chance, single = plain_model([tokens(t) for t in texts])
    words = [*single, "never"]
    for before in [None, "seven", "w3", "common", "x1", "never", "f2"]:
        total = sum(chance(before, w) for w in words)
        assert total <= 1 + 1e-9
        assert total > 0.79 and (before != "never" or total == pytest.approx(1))
    # The operator gives these very chances, for texts that the model has not seen, too.
    asked = [k for k in range(3000) if out(k)][: len(words)]
    rows += [(i, f"seven {w}".strip(), "en", "m", 1, None, None) for i, w in zip(asked, words)]
    found = {r.doc_id: r.score for r in lm.score_texts(spark.createDataFrame(rows, DOCS)).collect()}
    for i, w in zip(asked, words):
        t = tokens(f"seven {w}".strip())
        assert found[i] == pytest.approx(sum(math.log10(chance(a, b)) for a, b in zip([None, *t], t)), abs=1e-6)
