"""A logistic quality classifier over hashed word n-grams, trained by follow-the-regularised-leader steps."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import held, whole_text

# At most so many labelled texts of each class fit the classifier; hashes decide which.
MOST_GOOD = 24_576
MOST_BAD = 8_192
# One learner takes so many texts in turn; more texts get more learners, whose steps are averaged after each round.
SHARD = 4_096
ROUNDS = 12

BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
BIAS = BUCKETS
# The steps' settings: rate, its offset, and the weights of both penalties.
ALPHA, BETA, LASSO, RIDGE = 0.3, 1.0, 0.02, 0.5
# Weight of the bad texts among all.
BAD_WEIGHT = 0.5
THRESHOLD = 0.7

# Bytes of text that are hashed at once.
CHUNK = 1 << 20

# Classes of bytes: 0 is white space, 1 a byte of a word, and each mark is its own class.
_CLASS = np.ones(256, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
for _byte in range(33, 127):
    if not chr(_byte).isalnum():
        _CLASS[_byte] = _byte
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# What a word is made of: capitals, small letters, digits, other bytes.
_MADE_OF = np.zeros(256, np.uint8)
_MADE_OF[65:91], _MADE_OF[97:123], _MADE_OF[48:58], _MADE_OF[128:] = 1, 2, 4, 8
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PLACES = np.array([pow(0xD1342543DE82EF95, k + 1, 1 << 64) for k in range(64)], np.uint64)


def learnable(doc_id: Column) -> Column:
    """Whether labels of the id may be learned: the remainder of its checksum by four is not 2."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) != 2, F.lit(False))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _ODD
    return h ^ (h >> np.uint64(29))


def _chunks(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about ``CHUNK`` bytes that end with white space."""
    at = 0
    while len(text) - at > CHUNK:
        ends = [e for mark in b" \t\n\x0b\x0c\r" if (e := text.find(bytes([mark]), at + CHUNK)) >= 0]
        end = min(ends, default=len(text))
        yield text[at:end]
        at = end
    yield text[at:]


def words_and_shapes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a text's words without case, and of their shapes; runs of one mark are words of their own."""
    words, shapes = [], []
    for chunk in _chunks(text):
        raw = np.frombuffer(chunk, np.uint8)
        kind = _CLASS[raw]
        border = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1]]) if len(raw) else np.empty(0, np.int64)
        length = np.diff(np.r_[border, len(raw)])
        if not len(border):
            continue
        place = np.arange(len(raw)) - np.repeat(border, length)
        value = (_LOWER[raw].astype(np.uint64) + np.uint64(1)) * _PLACES[place & 63]
        word = _mixed(np.add.reduceat(value, border))
        made = np.bitwise_or.reduceat(_MADE_OF[raw], border).astype(np.uint64)
        mark = kind[border] > 1
        shape = np.where(mark, (kind[border].astype(np.uint64) << np.uint64(8)) + np.minimum(length, 4).astype(np.uint64), made)
        kept = kind[border] > 0
        words.append(word[kept])
        shapes.append(_mixed(shape[kept] + np.uint64(1)))
    none = np.empty(0, np.uint64)
    return (np.concatenate(words), np.concatenate(shapes)) if words else (none, none)


def _n_grams(hashes: np.ndarray, n: int, salt: int) -> np.ndarray:
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    size = len(hashes) - n + 1
    h = _mixed(np.full(size, salt, np.uint64))
    for k in range(n):
        h = _mixed(h + hashes[k : k + size])
    return h


def text_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's n-grams, ascending, and their values.

    N-grams are one and two words, two and three shapes, and, as signs of
    repetition, a word that follows itself and three words seen before in the
    text. A value is the root of the n-gram's share of the text's words, so a
    text's length does not matter. The bias is the last feature.
    """
    words, shapes = words_and_shapes(text)
    pairs, triples = _n_grams(words, 2, 2), _n_grams(words, 3, 3)
    again = len(triples) - len(np.unique(triples))
    twice = int((words[1:] == words[:-1]).sum()) if len(words) else 0
    hashes = np.concatenate([
        _n_grams(words, 1, 1), pairs, _n_grams(shapes, 2, 4), _n_grams(shapes, 3, 5),
        _mixed(np.repeat(np.array([6, 7], np.uint64), [again, twice])),
    ])
    bucket, count = np.unique((hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int32), return_counts=True)
    value = np.sqrt(count / max(1, len(words)))
    return np.r_[bucket, np.int32(BIAS)].astype(np.int32), np.r_[value, 1.0].astype(np.float32)


class Leader:
    """State of follow-the-regularised-leader steps for each feature: ``z`` and the squared slopes ``n``."""

    def __init__(self, z: np.ndarray, n: np.ndarray):
        self.z, self.n = z.copy(), n.copy()

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        small = np.abs(z) <= LASSO
        return np.where(small, 0.0, (np.sign(z) * LASSO - z) / ((BETA + np.sqrt(n)) / ALPHA + RIDGE))

    def step(self, at: np.ndarray, value: np.ndarray, good: int, weight: float) -> None:
        w = self.weights(at)
        slope = weight * (_chance(float(w @ value)) - good) * value
        new = self.n[at] + slope * slope
        self.z[at] += slope - (np.sqrt(new) - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] = new


def _chance(raw: float) -> float:
    return 1 / (1 + math.exp(-min(40.0, max(-40.0, raw))))


def _sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Different labelled texts of at most ``MOST_GOOD`` and ``MOST_BAD`` ids, and the numbers of labelled ids by class."""
    known = (
        labels.where(F.col("quality").isin(0, 1) & learnable(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("__doc")).agg(F.min("quality").cast("int").alias("__good"))
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().cast("binary").alias("text"))

    def counted(found: DataFrame) -> dict[int, int]:
        return {r["__good"]: r["n"] for r in found.groupBy("__good").agg(F.count("*").alias("n")).collect()}

    n = counted(known)
    # An id's hash as a number from 0 to 1 decides; a share of 0.95 leaves chance some room below the bound.
    draw = F.shiftrightunsigned(F.xxhash64("__doc"), 11) / float(1 << 53)
    share = {y: 1.0 if n.get(y, 0) <= most else 0.95 * most / n[y] for y, most in ((1, MOST_GOOD), (0, MOST_BAD))}
    ids = known.where(draw < F.when(F.col("__good") == 1, share[1]).otherwise(share[0]))
    # The ids are few by the two bounds, so they may go to all tasks.
    rows = rows.join(F.broadcast(ids), F.col("doc_id") == F.col("__doc"))
    return rows.select("doc_id", F.col("__good").alias("good"), "text").distinct(), n


def _features(sample: DataFrame, shards: int) -> DataFrame:
    """Features of the sample in the shared folder, each learner's rows in one partition and in one fixed order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, good, text, turn in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at, value = text_features(text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([turn % shards], pa.int32()), pa.array([turn]), pa.array([doc]), pa.array([good], pa.int32()),
                     pa.array([at.tobytes()], pa.binary()), pa.array([value.tobytes()], pa.binary())],
                    ["shard", "turn", "doc_id", "good", "at", "value"],
                )

    turned = sample.withColumn("turn", F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 1))
    found = turned.mapInArrow(run, "shard int, turn long, doc_id long, good int, at binary, value binary")
    # Dealt and sorted once; every round reads the stored partitions as they are.
    return held(found.repartition(shards, "shard").sortWithinPartitions("shard", "turn", "good", "doc_id"))


def _round(rows: DataFrame, z: np.ndarray, n: np.ndarray, weight: dict[int, float]) -> tuple[np.ndarray, np.ndarray]:
    """One pass of every learner from the same state; a feature moves by the mean over the learners that met it."""
    state = rows.sparkSession.sparkContext.broadcast((z, n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start_z, start_n = state.value
        learner, shard = None, None

        def moved() -> pa.RecordBatch:
            at = np.flatnonzero((learner.z != start_z) | (learner.n != start_n)).astype(np.int32)
            parts = [at, learner.z[at] - start_z[at], learner.n[at] - start_n[at]]
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), *(pa.array([p.tobytes()], pa.binary()) for p in parts)], ["shard", "at", "z", "n"]
            )

        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("shard", "good", "at", "value"))
            for own, good, at, value in zip(*columns, strict=True):
                if own != shard:
                    if learner is not None:
                        yield moved()
                    learner, shard = Leader(start_z, start_n), own
                learner.step(np.frombuffer(at, np.int32), np.frombuffer(value, np.float32).astype(np.float64), good, weight[good])
        if learner is not None:
            yield moved()

    # Bounded: one row for each learner, of at most BUCKETS features of 20 bytes. Arrow batches pass the driver's JVM as
    # they are, and the state is destroyed there too, so rounds do not add up.
    found = rows.mapInArrow(run, "shard int, at binary, z binary, n binary").toArrow()
    state.destroy()
    change_z, change_n, met = np.zeros_like(z), np.zeros_like(n), np.zeros(len(z))
    for k in np.argsort(found.column("shard").to_numpy()).tolist():
        at, own_z, own_n = (np.frombuffer(found.column(c)[k].as_buffer(), t) for c, t in (("at", np.int32), ("z", np.float64), ("n", np.float64)))
        change_z[at] += own_z
        change_n[at] += own_n
        met[at] += 1
    met = np.maximum(met, 1)
    return z + change_z / met, n + change_n / met


def train(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Weights of all buckets and, last, the bias; only the bias of 2 without labels of both kinds."""
    sample, n_labels = _sample(docs, labels)
    none = np.zeros(BUCKETS + 1)
    none[BIAS] = 2.0
    if not n_labels.get(0) or not n_labels.get(1):
        return none
    taken = min(n_labels[0], MOST_BAD) + min(n_labels[1], MOST_GOOD)
    shards = -(-taken // SHARD)
    found = _features(sample, shards)
    n = {r["good"]: r["n"] for r in found.groupBy("good").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return none
    # Ids with many texts: the hash of a text decides as that of an id did.
    share = F.when(F.col("good") == 1, min(1.0, MOST_GOOD / n[1])).otherwise(min(1.0, MOST_BAD / n[0]))
    rows = found.where(F.col("turn") / float(1 << 63) <= share)
    # Steps weigh 1 in the mean, for any shares of the classes.
    weight = {0: BAD_WEIGHT * (n[0] + n[1]) / n[0], 1: (1 - BAD_WEIGHT) * (n[0] + n[1]) / n[1]}
    z, squares = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for _ in range(ROUNDS):
        z, squares = _round(rows, z, squares, weight)
    return Leader(z, squares).weights()


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of every row: the sparse dot product of its features and the weights."""
    known = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(1).to_pylist():
                at, value = text_features(text)
                found.append(_chance(float(known.value[at] @ value.astype(np.float64))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row.

    Trained on labelled rows that are not held out; inputs are the words of a
    whole text alone. Null and empty texts get the score of the bias. Labels
    with null or other values, or null ids, are left out; an id labelled both
    ways counts as bad. Equal rows are learned once. A row
    with a null id is scored and not held out. Other columns are not read. An
    empty table gives an empty result; without labels of both kinds every
    score is that of a bias of 2.
    """
    return score(docs, train(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
