"""Phrase counts, cuts, covers and ranks against a plain version."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from fixtures import DOCS, no_docs, odd_docs

from tidemark.llm import collocations
from tidemark.llm.collocations import HatTrie


def plain_counts(rows, longest):
    counts = defaultdict(Counter)
    for lang, text in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, longest + 1):
                for k in range(len(words) - m + 1):
                    counts[lang or "und"][tuple(words[k : k + m])] += 1
    return counts


def plain_collocations(rows, least, longest, report):
    found = []
    for lang, f in plain_counts(rows, longest).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            cuts = [(1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            covered = any(
                len(q) > len(p) and b >= a and any(q[k : k + len(p)] == p for k in range(len(q) - len(p) + 1)) for q, b in candidates.items()
            )
            if not covered:
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:report], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(found)


def corpus(spark, seed=1, texts=80):
    rng = random.Random(seed)
    words = ["a", "B", "of", "the", "The", "été", "x", "日本", "ÄB", "stone\x0b", "paper", "\x1c"]
    fixed = ["of the Stone age", "paper of the a", "x x x x x x x", "the old man and the sea"]
    rows = []
    for k in range(texts):
        parts = [rng.choice(fixed) if rng.random() < 0.2 else rng.choice(words) for _ in range(rng.randrange(200))]
        text = "".join(p + rng.choice([" ", " ", " ", "\t", "  ", ", ", ". ", "\n", "\r"]) for p in parts)
        rows.append((k, text, rng.choice(["en", "en", "de", None, "und"]), "t", 1, None, None))
    return spark.createDataFrame(rows, DOCS)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("seed,least,longest,report", [(1, 20, 5, 2000), (2, 8, 5, 30), (3, 5, 3, 2000)])
def test_collocations_equal_the_plain_version(spark, seed, least, longest, report):
    docs = corpus(spark, seed)
    plain = plain_collocations([(r.lang, r.text) for r in docs.collect()], least, longest, report)
    assert rows_of(collocations.collocations(docs, least, longest, report)) == plain and len(plain) > 20


def test_spills_bursts_and_full_tables_change_no_count(spark, monkeypatch):
    docs = corpus(spark, 4)

    def counts(**k):
        phrases, totals = collocations.phrase_counts(docs, 10, 5, **k)
        return sorted(map(tuple, phrases.collect())), sorted(map(tuple, totals.collect()))

    whole = counts()
    plain = plain_counts([(r.lang, r.text) for r in docs.collect()], 5)
    assert whole[0] == sorted((g, " ".join(p), n, len(p)) for g, f in plain.items() for p, n in f.items() if n >= 10)
    assert counts(bits=7) == whole
    monkeypatch.setattr(collocations, "PAIR_BITS", 17)
    assert counts() == whole
    for name, value in (("BURST", 4), ("MEMORY", 30), ("CHUNK", 50), ("GATHER", 300), ("NUMBERS", 20), ("BATCH", 7)):
        monkeypatch.setattr(collocations, name, value)
    assert counts() == whole


def test_tries_burst_and_spill_whole_subtrees():
    rng = random.Random(6)
    trie, plain = HatTrie(burst=5), Counter()
    spilled = []
    for k in range(3000):
        phrase = tuple(rng.choice([0, 0, 1, 2, 3]) for _ in range(4))
        trie.add(phrase, 2)
        plain[phrase] += 2
        if k % 700 == 699:
            before = Counter(p[0] for p in plain)
            run = list(trie.spill(50))
            assert len(trie) <= 50 and run
            # A first word leaves with all its phrases.
            assert not {p[0] for p, _ in run} & {p[0] for p, _ in trie._below(trie.root, ())} and len(before) == 4
            spilled += run
    # Sorted phrases go in together, also where buckets burst on the way.
    together = sorted(plain.items())
    whole = HatTrie(burst=5)
    whole.add_sorted([p for p, _ in together], [n for _, n in together])
    assert Counter(dict(whole.spill(0))) == plain and len(whole) == 0
    spilled += trie.spill(0)
    found = Counter()
    for phrase, n in spilled:
        found[phrase] += n
    assert found == plain and len(trie) == 0
    deep = HatTrie(burst=5)
    for k in range(200):
        deep.add((0, k % 7, k % 11, k), 1)
    assert type(deep.root[0]) is collocations._Node


def test_scores_pass_64_bits(spark):
    n, a, left, right = 90_000_000_000_000, 4_000_000_000_001, 5_000_000_000_003, 6_000_000_000_007
    phrases = spark.createDataFrame([("en", "p q", a, 2), ("en", "p", left, 1), ("en", "q", right, 1)], "lang string, phrase string, n long, size int")
    row = collocations.scored(phrases, spark.createDataFrame([("en", n)], "lang string, total long")).first()
    assert row.score == 1000 * a * n // (left * right) and (row.l, row.r, row.a, row.n) == (left, right, a, n)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    plain = plain_collocations([(r.lang, r.text) for r in docs.collect()], 5, 5, 2000)
    assert rows_of(collocations.collocations(docs, 5)) == plain and plain
    assert collocations.collocations(no_docs(spark)).count() == 0
    assert collocations.collocations(docs).count() >= 0


def test_stretches_keep_neighbours_and_break_where_words_go():
    import pyarrow as pa

    words = pa.array([b"a", b"b", b"c", b"d", b".", b"e", b"f", b"g", b"h", b"i"], pa.binary())
    text = collocations.stretches(words, np.arange(10), np.array([0, 1, 5, 8]), 2)
    assert [p.split() for p in text.split(b"\n")] == [[b"a", b"b", b"c"], [b"e", b"f"], [b"h", b"i"]]


def listed(texts):
    return [[words[k] for k in places if words[k] not in (b".", b"")] for words, places in collocations.tokens(texts)]


def test_tokens_of_texts_cut_into_chunks(monkeypatch):
    rng = random.Random(7)
    texts = ["".join(rng.choice("aB \t.,\n\x0b\r日é\x1c\x00\x85\u2003") for _ in range(rng.randrange(60))).encode() for _ in range(40)]
    plain = [w.encode() for t in texts for w in re.findall(r"[^\x20\x09.,\x0A-\x0D]+", t.decode().replace("B", "b"))]
    assert [w for part in listed(texts) for w in part] == plain
    monkeypatch.setattr(collocations, "CHUNK", 10)
    parts = listed(texts)
    assert len(parts) > 20 and [w for part in parts for w in part] == plain
    assert listed([]) == [] and [w for p in listed([b"", b"..", b" "]) for w in p] == []


def test_pair_tables_miss_no_frequent_pair(spark, monkeypatch):
    monkeypatch.setattr(collocations, "PAIR_BITS", 18)
    docs = corpus(spark, 9).repartition(5)
    texts = docs.selectExpr("coalesce(lang, 'und') lang", "cast(text as binary) phrase")
    for least in (10, 300):
        table = collocations._pair_table(texts, np.full(1 << 23, 255, np.uint8), least)
        plain = plain_counts([(r.lang, r.text) for r in docs.collect()], 2)
        known = {}
        for lang, own in plain.items():
            for p, n in own.items():
                if len(p) == 2:
                    words = np.array([collocations.xxhash.xxh64_intdigest(w.encode(), 42) for w in p], np.uint64)
                    known[lang, p] = n, bool(collocations.may_hold(table, collocations.phrase_hashes(lang, words, 2))[0])
        assert all(held for n, held in known.values() if n >= least)
        assert sum(held for n, held in known.values() if n < least) < 0.05 * len(known)


def test_distinct_phrases():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 3, 400)
    at = np.flatnonzero(rng.random(396) < 0.5)
    for size in (2, 3, 5):
        columns, counts = collocations.distinct_phrases(ids, at, size)
        plain = Counter(tuple(ids[k : k + size].tolist()) for k in at)
        assert dict(zip(zip(*(c.tolist() for c in columns)), counts.tolist())) == dict(plain)
