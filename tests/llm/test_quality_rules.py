"""Text statistics against their definition, and what the learned lists reject."""

import random
import re
from collections import Counter

from fixtures import no_docs, odd_docs, prose

from tidemark.llm import quality

LABELS = "doc_id long, quality int, toxic int, kept int"


def plain(text):
    text = text or ""
    word = re.compile(r"[^\x20\x09-\x0D]+")
    words = word.findall(text)
    triples = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = Counter(triples)
    covered = {i + k for i, t in enumerate(triples) if counts[t] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if word.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_equal_the_definition(spark):
    rng = random.Random(2)
    texts = ["a b c a b c a", "a a a a a", "x\ny\nx\n \n \nx", "a b c d a b c", "é ü # |$ a\x0bb\x0cc", "\U0001f600 a\U0001f600b", "a\x1cb c\xa0d", "a b"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(40))) for _ in range(200)]
    docs = odd_docs(spark, [(100 + k, t, "en", "q", 1, None, None) for k, t in enumerate(texts)])
    labels = spark.createDataFrame([(1, 1, 0, 1), (None, 0, 0, 0), (2, None, 1, None)], LABELS)
    rows = quality.assess(docs, labels).collect()
    found = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in rows)
    wanted = []
    for r in docs.collect():
        p = plain(r.text)
        failed = p[0] < 50 or 100 * p[4] > 50 * p[0]
        wanted.append((str(r.doc_id), *p, failed, not failed))
    assert found == sorted(wanted)


def labelled(spark, seed):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(600):
        bad = k % 5 == 0
        words = prose(seed * 1000 + k, rng.randrange(60, 200)).split()
        if bad and k % 2:
            words = [w + "***" for w in words]
        elif bad:
            words = [x for w in words for x in (w, "|")]
        rows.append((k, " ".join(words), "en", "s", 1, None, None))
        if k % 3:
            labels.append((k, 0 if bad else 1, 0, 1))
    schema = "doc_id long, text string, lang string, source string, n_chars long, spans string, fingerprint int"
    return spark.createDataFrame(rows, schema), spark.createDataFrame(labels, LABELS)


def test_list_rejects_unlabelled_bad_texts_and_keeps_clean_ones(spark):
    docs, labels = labelled(spark, 1)
    verdict = {r.doc_id: r.kept for r in quality.assess(docs, labels).collect()}
    unlabelled = [k for k in range(600) if k % 3 == 0]
    assert all(not verdict[k] for k in unlabelled if k % 5 == 0)
    assert all(verdict[k] for k in unlabelled if k % 5)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, v in verdict.items() if v}


def test_rules_are_ordered_conjunctions():
    text = str(quality.verdict([[("symbol_share", ">=", 0.1), ("words", "<", 90.0)], [("repeat_share", ">=", 0.5)]]))
    assert text.index("__symbol_share") < text.index("__words") < text.index("__repeat_share")


def test_main_path_has_no_python(spark):
    docs, _ = labelled(spark, 2)
    plan = quality.measured(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_without_rows_or_labels(spark):
    none = spark.createDataFrame([], LABELS)
    assert quality.assess(no_docs(spark), none).count() == 0
    assert quality.keep_good(no_docs(spark), none).count() == 0
    docs, _ = labelled(spark, 3)
    assert all(r.kept != r.base_failed for r in quality.assess(docs, none).collect())
