"""A linear toxicity classifier whose scores may not hang on identity terms."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import by_batch, held, whole_text

# At most so many labelled texts of each class fit the classifier; the hash of an id decides which.
MOST_TOXIC = 10_000
MOST_CLEAN = 20_000
# Words and word beginnings that tell the classes apart, by the likelihood ratio.
FEATURES = 4096
LEAST_TEXTS = 3
LEAST_RATIO = 10.83  # chi-squared, one degree of freedom, one in a thousand
PREFIXES = (4, 5, 6)
# A longer run without marks is no word; beginnings of words are looked for all over it.
LONGEST_WORD = 64

STEPS = 400
RATE = 0.3
RIDGE = 5e-5
# Weight of the toxic texts among all; more than their share, as one insult has to be enough.
TOXIC_WEIGHT = 0.6
# Weight of the penalty on score changes when an identity term is swapped.
COUNTERFACTUAL = 10.0
THRESHOLD = 0.7
MEMORY = 300_000

# Identity terms in groups; each is swapped with the next of its group, and also left out.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("black", "white", "asian", "latino"),
    ("muslim", "christian", "jewish", "hindu", "atheist"), ("muslims", "christians", "jews", "hindus", "atheists"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"), ("immigrants", "citizens"), ("disabled", "deaf", "blind"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("frauen", "männer"), ("muslime", "christen", "juden"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
)
_NEXT = {t: group[(k + 1) % len(group)] for group in IDENTITY_TERMS for k, t in enumerate(group)}
_MARKS = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~«»“”„‘’…¡¿"
_INNER = re.compile(f"[{re.escape(_MARKS)}]+")
_PART = re.compile(f"[^{re.escape(_MARKS)}]+")


def in_training(doc_id: Column) -> Column:
    """Whether labels of the id may be learned: the remainder of its checksum by three is not 1."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) != 1, F.lit(False))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def text_words(text: str) -> set[str]:
    return set(text.lower().split())


def word_features(word: str) -> Iterator[str]:
    """The word without marks around it, its beginnings, and those of its parts between marks.

    A part of over ``LONGEST_WORD`` characters, such as a sentence of a script
    without blanks, has a beginning at each of its characters.
    """
    bare = word.strip(_MARKS)
    parts = _INNER.split(bare) if bare else []
    if len(parts) > 1 and len(bare) <= LONGEST_WORD:
        parts.append(bare)
    for part in parts:
        if len(part) > LONGEST_WORD:
            for n in PREFIXES:
                for k in range(len(part) - n + 1):
                    yield f"{part[k : k + n]}*"
        else:
            yield part
            for n in PREFIXES:
                if len(part) > n:
                    yield f"{part[:n]}*"


def text_features(words: set[str]) -> set[str]:
    return {f for w in words for f in word_features(w)}


def swapped(words: set[str], leave_out: bool) -> set[str] | None:
    """The words with each identity term left out or replaced; None where there is none."""
    terms = {w for w in words if any(p in _NEXT for p in _INNER.split(w))}
    if not terms:
        return None

    def other(part: re.Match) -> str:
        return ("" if leave_out else _NEXT[part[0]]) if part[0] in _NEXT else part[0]

    return (words - terms) | {x for w in terms if (x := _PART.sub(other, w).strip(_MARKS))}


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Different labelled texts of at most ``MOST_TOXIC`` and ``MOST_CLEAN`` ids."""
    known = (
        labels.where(F.col("toxic").isin(0, 1) & in_training(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("__doc")).agg(F.max("toxic").alias("toxic"))
    )
    # An id's hash as a number from 0 to 1 decides; a share of 0.95 leaves chance some room below the bound.
    draw = F.shiftrightunsigned(F.xxhash64("__doc"), 11) / float(1 << 53)
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {y: 1.0 if n.get(y, 0) <= most else 0.95 * most / n[y] for y, most in ((1, MOST_TOXIC), (0, MOST_CLEAN))}
    ids = known.where(draw < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    # The ids are few by the two bounds, so they may go to all tasks.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = rows.join(F.broadcast(ids.select("__doc", "toxic")), F.col("doc_id") == F.col("__doc"))
    # Equal texts count once, as toxic if any of them is.
    return rows.groupBy("text").agg(F.max("toxic").alias("toxic"))


def _vocabulary(sample: DataFrame) -> list[str]:
    """Features whose share of texts differs most between the classes."""

    def run(batch: pa.Table) -> pa.Table:
        counts: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist(), strict=True):
            for feature in text_features(text_words(text)):
                counts[feature][toxic] += 1
        return pa.table({
            "feature": pa.array(list(counts), pa.string()),
            "clean": pa.array([c[0] for c in counts.values()], pa.int64()),
            "bad": pa.array([c[1] for c in counts.values()], pa.int64()),
        })

    n = sample.groupBy().agg(F.sum(1 - F.col("toxic")).alias("clean"), F.sum("toxic").alias("bad")).first()
    if not n["clean"] or not n["bad"]:
        return []
    counts = by_batch(sample, run, "feature string, clean long, bad long").groupBy("feature").agg(
        F.sum("clean").alias("clean"), F.sum("bad").alias("bad")
    ).where(F.col("clean") + F.col("bad") >= LEAST_TEXTS)
    everything = n["clean"] + n["bad"]

    def part(count: Column, expected: Column) -> Column:
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)

    seen = F.col("clean") + F.col("bad")
    ratio = 2 * (
        part(F.col("bad"), seen * n["bad"] / everything) + part(F.col("clean"), seen * n["clean"] / everything)
        + part(n["bad"] - F.col("bad"), (everything - seen) * n["bad"] / everything)
        + part(n["clean"] - F.col("clean"), (everything - seen) * n["clean"] / everything)
    )
    best = counts.withColumn("ratio", ratio).where(F.col("ratio") >= LEAST_RATIO).orderBy(F.desc("ratio"), "feature").limit(FEATURES)
    return [r["feature"] for r in best.collect()]


def fit(rows: list[np.ndarray], toxic: np.ndarray, changes: list[tuple[np.ndarray, np.ndarray]], size: int, counterfactual: float = COUNTERFACTUAL) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model by Adam steps over all rows.

    ``rows`` hold the features of each text; ``changes`` the features that a
    swapped text gains and loses. The loss adds the mean squared change of the
    raw score over all swaps.
    """
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    feature = np.concatenate(rows) if len(rows) else np.empty(0, np.int64)
    swap = np.concatenate([np.full(len(g) + len(x), k) for k, (g, x) in enumerate(changes)]) if changes else np.empty(0, np.int64)
    moved = np.concatenate([np.concatenate(c) for c in changes]).astype(np.int64) if changes else np.empty(0, np.int64)
    sign = np.concatenate([np.r_[np.ones(len(g)), -np.ones(len(x))] for g, x in changes]) if changes else np.empty(0)
    # Classes weigh the same for any share of them, so a rare class is not drowned.
    weight = np.where(toxic == 1, TOXIC_WEIGHT / max(1, (toxic == 1).sum()), (1 - TOXIC_WEIGHT) / max(1, (toxic == 0).sum()))
    w, b = np.zeros(size), 0.0
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        score = b + np.bincount(owner, w[feature], len(rows))
        off = weight * (1 / (1 + np.exp(-np.clip(score, -40, 40))) - toxic)
        slope = np.bincount(feature, off[owner], size) + RIDGE * w
        if changes:
            change = np.bincount(swap, sign * w[moved], len(changes))
            slope += counterfactual * 2 * np.bincount(moved, sign * change[swap], size) / len(changes)
        slope = np.r_[slope, off.sum()]
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8) * min(1.0, 2 * (1 - step / (STEPS + 1)))
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def train(docs: DataFrame, labels: DataFrame, counterfactual: float = COUNTERFACTUAL) -> tuple[dict[str, float], float]:
    """Weights by feature and the bias; no weights and a bias of -2 without labels of both kinds."""
    sample = held(_sample(docs, labels))
    vocabulary = _vocabulary(sample)
    if not vocabulary:
        return {}, -2.0
    place = {f: k for k, f in enumerate(vocabulary)}

    def run(batch: pa.Table) -> pa.Table:
        def places(words: set[str]) -> list[int]:
            return sorted(place[f] for f in text_features(words) if f in place)

        toxic, found, swaps = batch.column("toxic").to_pylist(), [], []
        for text in batch.column("text").to_pylist():
            words = text_words(text)
            found.append(places(words))
            other = [places(s) for s in (swapped(words, True), swapped(words, False)) if s is not None]
            swaps.append(other)
        ints = pa.list_(pa.int32())
        return pa.table({"toxic": pa.array(toxic, pa.int32()), "own": pa.array(found, ints), "swaps": pa.array(swaps, pa.list_(ints))})

    # Bounded: 30,000 texts of at most FEATURES places.
    table = by_batch(sample.withColumn("toxic", F.col("toxic").cast("int")), run, "toxic int, own array<int>, swaps array<array<int>>").collect()
    table.sort(key=lambda r: (r["toxic"], r["own"]))
    rows = [np.array(r["own"], np.int64) for r in table]
    changes = [
        (np.setdiff1d(s, own), np.setdiff1d(own, s))
        for r, own in zip(table, rows, strict=True) for s in r["swaps"]
    ]
    w, b = fit(rows, np.array([r["toxic"] for r in table]), changes, len(vocabulary), counterfactual)
    return {f: float(w[k]) for f, k in place.items()}, b


def score(docs: DataFrame, weights: dict[str, float], bias: float) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of every row, from its words alone."""

    def run(batches):
        known: dict[str, tuple[str, ...]] = {}
        for batch in batches:
            found = []
            for text in batch.column(1).to_pylist():
                features: set[str] = set()
                for word in text_words(text):
                    hits = known.get(word)
                    if hits is None:
                        hits = tuple({f for f in word_features(word) if f in weights})
                        if len(known) >= MEMORY:
                            known.clear()
                        if len(word) <= LONGEST_WORD:
                            known[word] = hits
                    if hits:
                        features.update(hits)
                # Summed in one order, so that equal texts get equal scores.
                raw = bias + sum(sorted(weights[f] for f in features))
                found.append(1 / (1 + np.exp(-np.clip(raw, -40, 40))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row.

    Trained on labelled rows that are not held out. Inputs are a text's words,
    their parts between marks, and beginnings of both only; all of a long run
    without blanks is read. Null and empty texts get the score of the bias.
    Labels with null or other values, or null ids, are left out; an id labelled
    both ways counts as toxic, and so does a text that several rows share. Equal
    texts count once in training. A row with a
    null id is scored and not held out. Other columns are not read. An empty
    table gives an empty result; without labels of both kinds every score is
    that of a bias of -2.
    """
    weights, bias = train(docs, labels)
    return score(docs, weights, bias).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
