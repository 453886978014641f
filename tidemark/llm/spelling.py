"""Spelling variants: words one edit apart, found in neighbourhoods over a reduced alphabet."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bits import BITS, bit_table, may_hold
from tidemark.llm.frames import whole_text
from tidemark.sources.scratch import new_folder

# The alphabet of a word, and the share of words that lose a letter.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
SLIP = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
RATIO = 2

# Letters are hashed to so many symbols.
SYMBOLS = 8
# Distinct words that a task counts before it hands them on.
MEMORY = 200_000
# Letters of the words whose neighbours a task makes at once.
BLOCK = 1 << 16
# Pairs of reduced words with more pairs of words than this are compared by their words less one letter.
CROWD = 4096

_CAPITALS = {c: c + 32 for c in range(65, 91)}
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
# The letter's symbol, from 1; a multiplicative hash spreads neighbouring code points.
_SYMBOL = np.array([((c * 0x9E3779B1) >> 20) % SYMBOLS + 1 for c in range(256)], np.uint64)


def occurrences(docs: DataFrame) -> DataFrame:
    """``word`` and ``n``, its occurrences in all texts, for every distinct result of the slips."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def handed() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return found

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                start = zlib.crc32(("" if doc is None else f"{doc}").encode() + b":")
                for word, n in Counter(RUN.findall(text.translate(_CAPITALS))).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % SLIP == 0:
                        k = h % len(word)
                        word = word[:k] + word[k + 1 :]
                    if len(word) >= LEAST_LENGTH:
                        seen[word] += n
                if len(seen) >= MEMORY:
                    yield handed()
        if seen:
            yield handed()

    rows = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _symbols(words: list[str]) -> np.ndarray:
    """Symbols of words of one length, a row for each word."""
    raw = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    return _SYMBOL[raw].reshape(len(words), -1)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(n, _BASE, np.uint64)])


def codes(symbols: np.ndarray) -> np.ndarray:
    """A 64-bit code of each row of symbols; equal rows have equal codes."""
    return (symbols * _powers(symbols.shape[1])[: symbols.shape[1]]).sum(axis=1, dtype=np.uint64)


def _spread(code: np.ndarray) -> np.ndarray:
    """The codes as hashes whose top bits are evenly spread; one to one."""
    code = (code ^ (code >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return code ^ (code >> np.uint64(32))


def neighbourhood(symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes of all reduced words one edit from each row, a column for each place of an edit, and which count.

    Leaving out any letter of a run of equal ones gives the same word, so the
    first stands for all; the same goes for a letter put beside an equal one.
    """
    rows, length = symbols.shape
    power = _powers(length + 1)
    before = np.concatenate([np.zeros((rows, 1), np.uint64), np.cumsum(symbols * power[:length], axis=1, dtype=np.uint64)], axis=1)
    total = before[:, -1:]
    last = np.concatenate([np.zeros((rows, 1), np.uint64), symbols], axis=1)
    yield before[:, :-1] + (total - before[:, 1:]) * np.uint64(_INVERSE), symbols != last[:, :-1]
    moved = before + (total - before) * np.uint64(_BASE)
    for other in map(np.uint64, range(1, SYMBOLS + 1)):
        yield total + (other - symbols) * power[:length], symbols != other
        yield moved + other * power[: length + 1], last != other


def _by_length(words: list[str]) -> Iterator[list[int]]:
    """Places of words of one length, in blocks whose neighbourhoods are bounded."""
    groups: dict[int, list[int]] = {}
    for k, word in enumerate(words):
        groups.setdefault(len(word), []).append(k)
    for length, places in groups.items():
        step = max(1, BLOCK // length)
        for k in range(0, len(places), step):
            yield places[k : k + step]


def reduced(words: DataFrame) -> DataFrame:
    """``words`` with ``code``, that of the reduced word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = batch.column(0).to_pylist()
            found = np.zeros(len(listed), np.uint64)
            for places in _by_length(listed):
                found[places] = _spread(codes(_symbols([listed[k] for k in places])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], ["word", "n", "code"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, code long")


def near_codes(vocabulary: DataFrame, bits: int = BITS) -> DataFrame:
    """``code < near``: codes of reduced words of the vocabulary at most one edit apart; each pair once.

    Every reduced word makes its whole neighbourhood. A bit table over the
    vocabulary's codes drops most of what no word has before the shuffle, and
    the join with the vocabulary drops the rest.
    """
    table = vocabulary.sparkSession.sparkContext.broadcast(bit_table(vocabulary, "code", bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = batch.column(0).to_pylist()
            for places in _by_length(listed):
                symbols = _symbols([listed[k] for k in places])
                own = _spread(codes(symbols)).view(np.int64)
                for made, counts in neighbourhood(symbols):
                    row = np.nonzero(counts)[0]
                    hashed = _spread(made[counts])
                    kept = may_hold(table.value, hashed)
                    near, mine = hashed[kept].view(np.int64), own[row[kept]]
                    # The other word meets this one in its own neighbourhood.
                    up = mine < near
                    yield pa.RecordBatch.from_arrays([pa.array(mine[up]), pa.array(near[up])], ["code", "near"])

    # One word stands for all with its code.
    one = vocabulary.groupBy("code").agg(F.min("word").alias("word"))
    made = one.select("word").mapInArrow(run, "code long, near long")
    known = one.select(F.col("code").alias("__near"))
    return made.join(known, F.col("near") == F.col("__near"), "left_semi").distinct()


def _one_edit(a: str, b: str) -> Column:
    return F.levenshtein(F.col(a), F.col(b), 1) == 1


def _named(vocabulary: DataFrame, suffix: str) -> DataFrame:
    return vocabulary.select(*[F.col(c).alias(f"{c}_{suffix}") for c in vocabulary.columns])


def _crowded(words: DataFrame, crowd: int) -> DataFrame:
    """Pairs one edit apart among ``words(word, n, code, size)`` of codes whose words make over ``crowd`` pairs.

    Words of one length meet on what is left without one letter, and a longer
    word, less one letter, meets the shorter one. At most an alphabet of words
    shares such a key.
    """
    place = F.explode(F.sequence(F.lit(1), F.length("word")))
    cuts = words.withColumn("at", place).withColumn("cut", F.concat(F.substring("word", F.lit(1), F.col("at") - 1), F.expr("substring(word, at + 1)")))
    keyed = cuts.withColumn("key", F.xxhash64("at", "cut")).drop("cut")
    a, b = _named(keyed, "a"), _named(keyed, "b")
    above = F.col("size_a") * F.col("size_b") > crowd
    same = a.join(
        b, (F.col("key_a") == F.col("key_b")) & (F.col("at_a") == F.col("at_b")) & (F.col("word_a") < F.col("word_b")) & above & _one_edit("word_a", "word_b")
    )
    first = (F.col("at") == 1) | (F.expr("substring(word, at, 1)") != F.expr("substring(word, at - 1, 1)"))
    a, b = _named(cuts.where(first), "a"), _named(words, "b")
    shorter = a.join(b, (F.col("cut_a") == F.col("word_b")) & above)
    kept = ["word_a", "n_a", "word_b", "n_b"]
    return same.select(*kept).unionByName(shorter.select(*kept))


def near_words(vocabulary: DataFrame, bits: int = BITS, crowd: int = CROWD) -> DataFrame:
    """``word_a``, ``n_a``, ``word_b``, ``n_b``: the pairs of ``vocabulary(word, n, code)`` one edit apart, each once.

    Words of two near codes are joined and verified. Where they make over
    ``crowd`` pairs, they meet by their words less one letter instead, so no
    group of words is compared pair by pair.
    """
    sizes = vocabulary.groupBy("code").agg(F.count("*").alias("size"))
    same = sizes.where("size > 1").select("code", F.col("code").alias("near"), F.col("size").alias("size_a"), F.col("size").alias("size_b"))
    a, b = _named(sizes, "a"), _named(sizes, "b")
    pairs = near_codes(vocabulary, bits).join(a, F.col("code") == F.col("code_a")).join(b, F.col("near") == F.col("code_b"))
    folder = new_folder(vocabulary.sparkSession, "near-codes")
    pairs.select("code", "near", "size_a", "size_b").unionByName(same).write.parquet(folder)
    pairs = vocabulary.sparkSession.read.parquet(folder)
    a, b = _named(vocabulary, "a"), _named(vocabulary, "b")
    once = (F.col("code") != F.col("near")) | (F.col("word_a") < F.col("word_b"))
    product = F.col("size_a") * F.col("size_b")
    light = pairs.where(product <= crowd).join(a, F.col("code") == F.col("code_a")).join(
        b, (F.col("near") == F.col("code_b")) & once & _one_edit("word_a", "word_b")
    )
    many = pairs.where(product > crowd).select(F.explode(F.array(
        F.struct(F.col("code").alias("__code"), F.col("size_a").alias("size")), F.struct(F.col("near").alias("__code"), F.col("size_b").alias("size"))
    )).alias("c")).select("c.*").distinct()
    words = vocabulary.join(many, F.col("code") == F.col("__code")).select("word", "n", "size")
    return light.select("word_a", "n_a", "word_b", "n_b").unionByName(_crowded(words, crowd))


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: forms followed to the last; counts at least double on the way, so it ends."""
    spark = forms.sparkSession
    step = forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open"))
    while True:
        folder = new_folder(spark, "spelling-roots")
        step.write.parquet(folder)
        step = spark.read.parquet(folder)
        if step.where("open").isEmpty():
            return step.select("word", "root")
        # Each round doubles the way that a word has gone.
        further = step.select(F.concat(F.col("word"), F.lit("")).alias("__at"), F.col("root").alias("__to"))
        step = step.join(further, F.col("root") == F.col("__at"), "left").select(
            "word", F.coalesce("__to", "root").alias("root"), F.col("__to").isNotNull().alias("open")
        )


def variants(docs: DataFrame) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every word that texts hold often enough.

    Words are runs of letters in whole texts, A-Z lower-cased, of at least
    five code points with at least three occurrences; the checksum of id and
    word drops a letter of some. Null texts have no words, a null id counts as
    empty in the checksum. Rows that repeat count again. Equal counts of near
    words fall to the least in code-point order. Other columns are not read.
    An empty table gives an empty result. Words may be of any length.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "vocabulary")
    reduced(occurrences(docs).where(F.col("n") >= LEAST_COUNT)).write.parquet(folder)
    vocabulary = spark.read.parquet(folder)
    pairs = near_words(vocabulary)
    ends = pairs.select(F.explode(F.array(
        F.struct(F.col("word_a").alias("word"), F.col("n_a").alias("n"), F.col("word_b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("word_b").alias("word"), F.col("n_b").alias("n"), F.col("word_a").alias("near"), F.col("n_a").alias("near_n")),
    )).alias("p")).select("p.*")
    best = ends.groupBy("word").agg(
        F.count("*").alias("n_near"), F.max("n").alias("n"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best")
    )
    takes = -F.col("best.n") >= RATIO * F.col("n")
    best = best.select(
        "word", "n_near", F.when(takes, F.col("best.near")).alias("form"), F.when(takes, -F.col("best.n")).alias("form_n")
    )
    folder = new_folder(spark, "near-words")
    best.write.parquet(folder)
    best = spark.read.parquet(folder)
    roots = _roots(best.where(F.col("form").isNotNull()))
    found = vocabulary.select("word", "n").join(best, "word", "left").join(roots, "word", "left")
    return found.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"
    )
