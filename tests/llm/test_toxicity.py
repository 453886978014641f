"""Held-out accuracy, and scores that do not hang on identity terms."""

import random
import zlib

from fixtures import DOCS, no_docs, odd_docs, prose

from tidemark.llm import toxicity

LABELS = "doc_id long, quality int, toxic int, score double"
INSULTS = ["blargface", "snorkhead", "grubling"]


def corpus(spark, bias=False):
    """Every fourth text holds insults; with ``bias`` the toxic ones also name a group more often."""
    rng = random.Random(9)
    rows, labels = [], []
    for k in range(900):
        words, toxic = prose(k, rng.randrange(30, 120)).split(), k % 4 == 0
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS) + rng.choice(["", "s", "ish", "!"]))
        if bias and rng.random() < (0.8 if toxic else 0.05):
            words.insert(0, "muslim")
        rows.append((k, " ".join(words), "en", "t", 1, None, None))
        labels.append((k, 1, int(toxic), None))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    rows = toxicity.classify(docs, labels).collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1
    right = [r.predicted == int(r.doc_id % 4 == 0) for r in rows if r.held_out]
    assert len(right) > 200 and sum(right) / len(right) > 0.97


def test_swaps_replace_or_leave_out():
    words = {"The", "women,", "met"}
    assert toxicity.swapped(words, False) == {"The", "men", "met"}
    assert toxicity.swapped(words, True) == {"The", "met"}
    assert toxicity.swapped({"The", "met"}, False) is None


def test_regularised_scores_ignore_identity_terms(spark):
    docs, labels = corpus(spark, bias=True)

    def named(counterfactual):
        """What the group's name adds to the raw score, and the share of right predictions."""
        weights, bias = toxicity.train(docs, labels, counterfactual)
        found = {r.doc_id: r.score for r in toxicity.score(docs, weights, bias).collect()}
        right = sum((s >= 0.7) == (k % 4 == 0) for k, s in found.items()) / len(found)
        return sum(weights.get(f, 0.0) for f in toxicity.word_features("muslim")), right

    loose, tight = named(0.0), named(toxicity.COUNTERFACTUAL)
    assert loose[0] > 0.3 and abs(tight[0]) < 0.1 * loose[0]
    assert tight[1] > 0.97


def test_labels_of_held_out_rows_are_not_read(spark):
    docs, labels = corpus(spark)
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(toxicity.F.col("doc_id")), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))

    def scores(labels):
        return sorted((r.doc_id, r.score) for r in toxicity.classify(docs, labels).collect())

    assert scores(labels) == scores(flipped)


def test_odd_rows_and_labels(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(None, 1, 1, None), (1, None, None, None), (4, 1, 7, None)], LABELS)
    rows = toxicity.classify(docs, labels).collect()
    assert len(rows) == docs.count() and len({r.score for r in rows}) == 1 and not any(r.predicted for r in rows)
    _, known = corpus(spark)
    assert toxicity.classify(no_docs(spark), known).count() == 0
    assert toxicity.classify(docs, known).count() == docs.count()


def test_all_of_a_text_without_blanks_counts(spark):
    assert set(toxicity.word_features("\"grubling!")) == {"grubling", "grub*", "grubl*", "grubli*"}
    docs, labels = corpus(spark)
    glued = [",".join(["stone"] * 30 + INSULTS), "_".join(INSULTS + ["stone"] * 30), "stone" * 30 + "".join(INSULTS) + "stone" * 9]
    more = spark.createDataFrame([(9000 + k, t, "en", "t", 1, None, None) for k, t in enumerate([*glued, ",".join(["stone"] * 30)])], DOCS)
    found = {r.doc_id: r.predicted for r in toxicity.classify(docs.unionByName(more), labels).collect()}
    assert [found[9000 + k] for k in range(4)] == [1, 1, 1, 0]


def test_swaps_reach_terms_between_marks():
    assert toxicity.swapped({"women/lawyers", "met"}, False) == {"men/lawyers", "met"}
    assert toxicity.swapped({"(women/men)", "met"}, True) == {"met"}


def test_equal_texts_with_both_labels_count_as_toxic(spark):
    rows = [(k, f"{prose(k % 40, 20)}", "en", "t", 1, None, None) for k in range(200)]
    labels = [(k, 1, int(k < 60), None) for k in range(200)]
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    found = [sorted(map(tuple, toxicity._sample(docs.repartition(n), known).select("text", "toxic").collect())) for n in (1, 7, 13)]
    assert found[0] == found[1] == found[2]
    train = {k for k in range(200) if __import__("zlib").crc32(str(k).encode()) % 3 != 1}
    assert {t: y for t, y in found[0]} == {prose(j, 20): int(any(k < 60 for k in train if k % 40 == j)) for j in {k % 40 for k in train}}
