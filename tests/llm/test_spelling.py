"""Word pairs, forms and roots against a plain version."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from fixtures import DOCS, no_docs, odd_docs

from tidemark.llm import bits, spelling


def plain_variants(rows):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            count[word] += 1
    words = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    near = defaultdict(set)
    letters = {c for w in words for c in w}
    for w in words:
        for k in range(len(w) + 1):
            made = [w[:k] + c + w[k:] for c in letters]
            if k < len(w):
                made += [w[:k] + c + w[k + 1 :] for c in letters] + [w[:k] + w[k + 1 :]]
            near[w].update(x for x in made if x in words and x != w)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    found = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        found.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return found


def corpus(spark, seed=1, texts=60):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abeinrtsäéÀ") for _ in range(rng.randrange(4, 9))) for _ in range(40)]
    base += [b[:k] + rng.choice("abxé") + b[k + rng.randrange(2) :] for b in base for k in (0, 2, 4)]
    rows = [
        (k, " ".join(rng.choice(base[: rng.randrange(1, len(base))]).replace("a", rng.choice("aaaaaA")) + rng.choice(["", ",", "1", "ß"]) for _ in range(rng.randrange(120))),
         "en", "t", 1, None, None) for k in range(texts)
    ]
    return spark.createDataFrame(rows, DOCS)


def rows_of(df):
    return [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_equal_the_plain_version(spark, seed):
    docs = corpus(spark, seed)
    found = rows_of(spelling.variants(docs))
    plain = plain_variants([(r.doc_id, r.text) for r in docs.collect()])
    assert len(found) == len(set(found)) and set(found) == plain
    assert sum(r[1] is not None for r in found) > 20 and any(r[1] != r[2] and r[1] for r in found)


def test_crowded_codes_and_full_bit_tables_change_nothing(spark, monkeypatch):
    docs = corpus(spark, 3)
    words = spelling.occurrences(docs).where("n >= 3")
    vocabulary = spelling.reduced(words).cache()
    pairs = lambda **k: sorted(tuple(sorted((r.word_a, r.word_b))) for r in spelling.near_words(vocabulary, **k).collect())
    whole = pairs()
    assert len(whole) == len(set(whole)) > 50
    assert pairs(crowd=0) == whole and pairs(crowd=2) == whole and pairs(bits=8) == whole
    monkeypatch.setattr(spelling, "_SYMBOL", np.ones(256, np.uint64))
    vocabulary = spelling.reduced(words).cache()
    assert pairs() == whole and pairs(crowd=10) == whole


def test_neighbourhoods_are_whole():
    rng = random.Random(5)
    for _ in range(40):
        rows = [[rng.randrange(1, spelling.SYMBOLS + 1) if rng.random() < 0.6 else 1 for _ in range(6)] for _ in range(3)]
        symbols = np.array(rows, np.uint64)
        made = defaultdict(Counter)
        for code, counts in spelling.neighbourhood(symbols):
            for row, column in zip(*np.nonzero(counts), strict=True):
                made[row][int(code[row, column])] += 1
        for k, row in enumerate(rows):
            plain = {tuple(row[:i] + row[i + 1 :]) for i in range(6)}
            plain |= {tuple(row[:i] + [c] + row[i + d :]) for i in range(7) for c in range(1, spelling.SYMBOLS + 1) for d in (0, 1)} - {tuple(row)}
            plain = {x for x in plain if len(x) != 6 or sum(a != b for a, b in zip(x, row)) == 1}
            expected = {int(spelling.codes(np.array([x], np.uint64))[0]) for x in plain}
            assert set(made[k]) == expected and max(made[k].values()) == 1


def test_bit_tables(spark):
    rng = np.random.default_rng(3)
    hashes = rng.integers(-(2**63), 2**63, 500)
    table = bits.bit_table(spark.createDataFrame([(int(h),) for h in hashes], "h long"), "h", 12)
    assert len(table) == 512 and bits.may_hold(table, hashes.view(np.uint64)).all()
    others = rng.integers(-(2**63), 2**63, 5000).view(np.uint64)
    expected = len(set((hashes.view(np.uint64) >> np.uint64(52)).tolist())) / 4096
    assert abs(bits.may_hold(table, others).mean() - expected) < 0.03
    assert not bits.bit_table(spark.createDataFrame([], "h long"), "h", 12).any()


def test_odd_rows(spark):
    long = "stone" * 700
    docs = odd_docs(spark, [(20, f"{long} {long}x {long} {long} {long}x {long}x", "en", "a", 1, None, None)])
    found = rows_of(spelling.variants(docs))
    plain = plain_variants([(r.doc_id, r.text) for r in docs.collect()])
    assert set(found) == plain and len(found) == len(plain)
    assert any(len(r[0]) > 3000 and r[4] == 1 for r in found)
    assert spelling.variants(no_docs(spark)).count() == 0
