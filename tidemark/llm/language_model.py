"""Language-model scores from a log-frequency Bloom filter of n-gram counts."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import fresh
from tidemark.llm.frames import held, whole_text
from tidemark.sources.scratch import new_folder

ADDED = 0.1
# At least so many segments, and so many that about ``SEGMENT_NGRAMS`` n-grams meet in one.
SEGMENTS = 256
SEGMENT_NGRAMS = 1 << 20
# Segments go to the workers in groups of about so many bytes, one pass over the texts for each group.
GROUP_BYTES = 96 << 20
PROBES = 4
BITS_FOR_ENTRY = 8
# Share of the bigram estimate in a word's probability.
BIGRAM_SHARE = 0.2
# At most so many words' exact counts go to all tasks; rarer and longer words are joined.
HOT_WORDS = 100_000
HOT_BYTES = 40
# A task sorts and counts about so many n-gram hashes at a time: those of a block of texts.
CHUNK = 1_000_000
MEMORY = 200_000
LEVELS = 40

END = b""  # no word is empty
_START = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLY = np.uint64(0xBF58476D1CE4E5B9)
_AGAIN = np.uint64(0x94D049BB133111EB)


def held_out(doc_id: Column) -> Column:
    """A row whose id's checksum ends in 0; null ids are not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(10)) == 0, F.lit(False))


def tokens(text: str) -> list[bytes]:
    """Words with A-Z in lower case, and one end."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    words.append(END)
    return words


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _MULTIPLY
        x = (x ^ (x >> np.uint64(27))) * _AGAIN
        return x ^ (x >> np.uint64(31))


def bigrams(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of each word with the one before it; the first of a text follows the start mark."""
    before = np.empty_like(hashes)
    before[1:] = hashes[:-1]
    before[starts] = _START
    with np.errstate(over="ignore"):
        return _mixed(hashes + before * _AGAIN + np.uint64(1))


def ngrams(hashes: np.ndarray, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each distinct word and of each token's bigram; the lowest bit tells the order, so both are counted together."""
    return _mixed(hashes) & ~np.uint64(1), bigrams(hashes[codes], starts) | np.uint64(1)


def entries(hashes: np.ndarray, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-grams of a block, and the place of each distinct word and then of each token's bigram."""
    return np.unique(np.concatenate(ngrams(hashes, codes, starts)), return_inverse=True)


def segment_of(values: np.ndarray, segments: int | None = None) -> np.ndarray:
    """Equal ranges of the hashes."""
    return ((values >> np.uint64(32)) * np.uint64(segments or SEGMENTS) >> np.uint64(32)).astype(np.int64)


def _spread(values: np.ndarray) -> bytes:
    """Numbers byte by byte: the high bytes of sorted or small ones repeat, which files and shuffles compress."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _joined(data: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


class WordHashes(dict):
    """64-bit hashes of words; kept for the first words met, so that memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        found = xxhash.xxh64_intdigest(word, 7)
        if len(self) < MEMORY and len(word) <= HOT_BYTES:
            self[word] = found
        return found


def _word_counts(texts: DataFrame) -> DataFrame:
    """Exact counts ``(word, c)`` of all tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
            )
            counts.clear()
            return batch

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(tokens(text))
            if len(counts) > MEMORY:
                yield out()
        yield out()

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def _ngram_counts(blocks: DataFrame, segments: int) -> DataFrame:
    """Distinct n-gram hashes of each block's training texts by segment, sorted, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                lengths, hashes, codes = _joined(block["lengths"], "<i8"), _joined(block["hashes"], "<u8"), _joined(block["codes"], "<i4")
                learned = np.repeat(np.frombuffer(block["learned"], np.uint8), lengths) > 0
                if not learned.any():
                    continue
                own = np.bincount(codes[learned], minlength=len(hashes))
                words, pairs = ngrams(hashes, codes, np.cumsum(lengths) - lengths)
                pairs, both = np.unique(pairs[learned], return_counts=True)
                values, counts = np.concatenate([words[own > 0], pairs]), np.concatenate([own[own > 0], both])
                order = np.argsort(values)
                values, counts = values[order], counts[order]
                segment = segment_of(values, segments)
                edges = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1], True])
                small = np.minimum(counts, 255).astype(np.uint8)
                large = np.flatnonzero(counts >= 255)
                rows = []
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    more = large[np.searchsorted(large, a) : np.searchsorted(large, b)]
                    rows.append((int(segment[a]), _spread(values[a:b]), small[a:b].tobytes(), counts[more].astype("<u4").tobytes()))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
                    ["segment", "hashes", "counts", "large"],
                )

    return blocks.select("uid", "lengths", "hashes", "codes", "learned").mapInArrow(run, "segment int, hashes binary, counts binary, large binary")


def _position(values: np.ndarray, level: int, probe: int, bits: int | np.ndarray) -> np.ndarray:
    """The bit of an entry (n-gram, level) in its segment that a probe asks for."""
    with np.errstate(over="ignore"):
        first = _mixed(values + np.uint64(level) * _START)
        step = (first >> np.uint64(33)) | np.uint64(1)
        return ((first + np.uint64(probe) * step) % np.asarray(bits).astype(np.uint64)).astype(np.int64)


FILTERED = "segment int, field binary, stats array<long>"


def _segments(partial: DataFrame) -> DataFrame:
    """One filter segment for each hash range, and statistics of its levels."""

    def build(segment: int, values: np.ndarray, counts: np.ndarray) -> dict:
        order = np.argsort(values, kind="stable")
        values, counts = values[order], counts[order]
        edges = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
        values, counts = values[edges], np.add.reduceat(counts, edges)
        # A count of c has floor(log2(c)) + 1 entries, one for each power of two up to it.
        levels = np.minimum(np.floor(np.log2(counts)).astype(np.int64) + 1, LEVELS - 1)
        bits = max(1, int(levels.sum()) * BITS_FOR_ENTRY // 8) * 8
        field = np.zeros(bits, np.uint8)
        for level in range(1, int(levels.max()) + 1):
            entered = values[levels >= level]
            for probe in range(PROBES):
                field[_position(entered, level, probe, bits)] = 1
        own = (values & np.uint64(1)) == 0
        stats = [np.bincount(levels[own], minlength=LEVELS), np.bincount(levels[own], counts[own], LEVELS).astype(np.int64)]
        return {"segment": segment, "field": np.packbits(field).tobytes(), "stats": np.concatenate(stats).tolist()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts = None, []

        def out() -> pa.RecordBatch:
            values, counts = zip(*parts, strict=True)
            row = build(current, np.concatenate(values), np.concatenate(counts))
            types = (pa.int32(), pa.binary(), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types, strict=True)], list(row))

        for batch in batches:
            for row in batch.to_pylist():
                if row["segment"] != current and parts:
                    yield out()
                    parts = []
                current = row["segment"]
                counts = np.frombuffer(row["counts"], np.uint8).astype(np.int64)
                counts[counts == 255] = np.frombuffer(row["large"], "<u4")
                parts.append((_joined(row["hashes"], "<u8"), counts))
        if parts:
            yield out()

    dealt = partial.repartition("segment").sortWithinPartitions("segment")
    return dealt.mapInArrow(run, FILTERED)


def level_means(stats: np.ndarray) -> np.ndarray:
    """What a level stands for among words: their mean count, from the sums of all segments' statistics."""
    types, mass = stats.reshape(2, LEVELS)
    return mass / np.maximum(types, 1)


class FrequencyFilter:
    """Some segments of the filter, from number ``first`` on, of ``segments`` in all."""

    def __init__(self, rows: list, first: int, last: int, segments: int):
        fields = {r["segment"]: np.frombuffer(r["field"], np.uint8) for r in rows}
        # A segment without n-grams has eight bits, none of them set.
        fields = [fields.get(k, np.zeros(1, np.uint8)) for k in range(first, last)]
        self.bits = np.array([8 * len(f) for f in fields], np.int64)
        self.base, self.field = np.cumsum(self.bits) - self.bits, np.concatenate(fields)
        self.first, self.last, self.segments = first, last, segments

    def levels(self, values: np.ndarray) -> np.ndarray:
        """Power of two of each n-gram's count, plus one; 0 where it is not stored. All lie in these segments.

        Level after level is probed until one is missing; a probe that fails ends an n-gram's search.
        """
        segment = segment_of(values, self.segments) - self.first
        found, alive = np.zeros(len(values), np.uint8), np.arange(len(values))
        for level in range(1, LEVELS):
            for probe in range(PROBES):
                own = segment[alive]
                place = self.base[own] + _position(values[alive], level, probe, self.bits[own])
                alive = alive[(self.field[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1]
            if not len(alive):
                break
            found[alive] = level
        return found

    def share(self, values: np.ndarray) -> slice:
        """Which of sorted n-grams lie in these segments."""
        segment = segment_of(values, self.segments)
        return slice(*np.searchsorted(segment, [self.first, self.last]))


def _frequent(vocabulary: DataFrame) -> DataFrame:
    """At most ``HOT_WORDS`` short words: all whose counts lie in the highest classes that fit together.

    Classes are eighths of a power of two. A threshold needs no sort, and tasks
    do not send candidates to the driver as a global top-k would.
    """
    short = vocabulary.where(F.length("word") <= HOT_BYTES).withColumn("class", F.floor(8 * F.log2("c")))
    least, size = None, 0
    for row in sorted(short.groupBy("class").agg(F.count("*").alias("n")).collect(), reverse=True):
        size += row["n"]
        if size > HOT_WORDS:
            break
        least = row["class"]
    return short.where(F.lit(False) if least is None else F.col("class") >= least).select("word", "c")


SCORED = (
    "uid long, doc_id long, held_out boolean, n_tokens long, known long, base double, word binary, "
    "lengths binary, hashes binary, codes binary, learned binary"
)


def _numbers(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths of a block's texts, hashes of its distinct words, and the word of each token."""
    return _joined(block["lengths"], "<i8"), _joined(block["hashes"], "<u8"), _joined(block["codes"], "<i4")


def _shared(filtered: DataFrame, first: int, last: int, segments: int) -> Broadcast[FrequencyFilter]:
    """Some stored segments, broadcast. Arrow batches pass the driver's JVM one by one, not as rows that are all held there."""
    found = filtered.where(F.col("segment").between(first, last - 1)).select("segment", "field").toArrow()
    fields = (f for chunk in found.column("field").chunks for f in chunk)
    rows = [{"segment": k, "field": f.as_buffer()} for k, f in zip(found.column("segment").to_pylist(), fields, strict=True)]
    return filtered.sparkSession.sparkContext.broadcast(FrequencyFilter(rows, first, last, segments))


def _probed(blocks: DataFrame, shared: Broadcast[FrequencyFilter]) -> DataFrame:
    """``block, part, levels``: what some segments, broadcast, answer to each block's n-grams of their hash range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                lengths, hashes, codes = _numbers(block)
                values = np.unique(np.concatenate(ngrams(hashes, codes, np.cumsum(lengths) - lengths)))
                found = shared.value.levels(values[shared.value.share(values)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block["uid"]]), pa.array([shared.value.first], pa.int32()), pa.array([found.tobytes()], pa.binary())], ["block", "part", "levels"]
                )

    return blocks.select("uid", "lengths", "hashes", "codes").mapInArrow(run, "block long, part int, levels binary")


def chances(own: np.ndarray, pair: np.ndarray, before: np.ndarray, single: np.ndarray, space: float) -> np.ndarray:
    """Probability of tokens from the levels of their words and bigrams; ``before`` is the most that the word before may count.

    The unigram estimates of all words and one unseen sum to 1, as a level
    stands for the mean of its counts. A bigram counts as the least of its
    level, so those of a context never exceed what the context counts. After an
    unknown context the whole probability is the unigram's.
    """
    alone = (single[own] + ADDED) / space
    least = np.where(pair > 0, np.exp2(pair.astype(np.float64) - 1), 0.0)
    share = np.where(before > 0, BIGRAM_SHARE, 0.0)
    return (1 - share) * alone + share * np.minimum(1.0, least / np.maximum(before, 1.0))


def _scores(blocks: DataFrame, earlier: DataFrame, shared: Broadcast[FrequencyFilter], single: np.ndarray, texts: int, space: float) -> DataFrame:
    """``uid`` and ``score`` of each text, from the last segments, probed here, and the answers of those before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts = None, []

        def out() -> pa.RecordBatch:
            lengths, hashes, codes = _numbers(block)
            starts, words = np.cumsum(lengths) - lengths, len(hashes)
            values, place = entries(hashes, codes, starts)
            # Segments are ranges of the sorted hashes, so their answers follow each other.
            last = shared.value.levels(values[shared.value.share(values)])
            levels = np.concatenate([*(np.frombuffer(p, np.uint8) for p in parts), last])
            own, pair = levels[place[:words]][codes], levels[place[words:]]
            before = np.empty(len(own))
            before[1:], before[starts] = np.exp2(own[:-1].astype(np.float64)) - 1, texts
            chance = chances(own, pair, before, single, space)
            return pa.RecordBatch.from_arrays(
                [pa.array(block["block"] + np.arange(len(lengths))), pa.array(np.add.reduceat(np.log10(chance), starts))], ["uid", "score"]
            )

        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] < 0:
                    if block is not None:
                        yield out()
                    block, parts = row, []
                else:
                    parts.append(row["levels"])
        if block is not None:
            yield out()

    own = blocks.select(F.col("uid").alias("block"), F.lit(-1).alias("part"), "lengths", "hashes", "codes", F.lit(None).cast("binary").alias("levels"))
    nothing = [F.lit(None).cast("binary").alias(c) for c in ("lengths", "hashes", "codes")]
    both = own.unionByName(earlier.select("block", "part", *nothing, "levels"))
    return both.repartition("block").sortWithinPartitions("block", "part").mapInArrow(run, "uid long, score double")


def score_texts(docs: DataFrame, learn: Column | None = None, out: Column | None = None) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` of every row.

    The model learns from rows where ``learn`` holds (by default those that are
    not ``held_out``). All their n-grams are counted and stored: an n-gram of
    count c has an entry for each power of two up to c, and the filter has
    ``BITS_FOR_ENTRY`` bits for each, so it grows with the corpus. What it holds
    is exact up to quantisation and the filter's false positives, at any size.
    A word's probability is an interpolated mean of its bigram and unigram
    estimates, see ``chances``; over all words it sums to 1 at most, but for
    the filter's false positives.

    Neither the driver nor a task sees the whole filter. Texts are cut into
    blocks; a shuffle brings the n-grams of training texts with their counts to
    the segments of the filter, by hash range, which are built there and
    stored. The number of segments grows with the tokens, so that a task holds
    the n-grams of one segment of bounded size. Scoring reads the stored
    segments alone: groups of them, ``GROUP_BYTES`` large, are broadcast one
    after another, and workers probe them with the n-grams of every text, in
    one pass over the texts for each group. A group is destroyed after its
    pass, so groups do not add up in the driver.

    ``n_known`` and ``base_score`` are exact: counts of the most frequent
    words, 100,000 at most and of 40 bytes at most, go to all tasks (bounded);
    each other token is joined to the table of counts.

    A null text counts as empty: its end is its one token. Rows with null ids
    are learned from; repeated rows count each. Without training tokens, N is 0
    and every count too. Other columns are not read. An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    ident = F.col("doc_id").cast("long")
    out = held_out(ident) if out is None else out
    learned = ~out if learn is None else learn
    rows = docs.select(ident.alias("doc_id"), out.alias("held_out"), whole_text().alias("text"), F.coalesce(learned, F.lit(False)).alias("learn"))
    vocabulary = held(_word_counts(rows.where("learn").select("text")))
    total = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.coalesce(F.max(F.when(F.length("word") == 0, F.col("c"))), F.lit(0)).alias("texts")).first()
    n, v, texts = total["n"], total["v"], total["texts"]
    # Bounded: 100,000 words of at most 40 bytes.
    frequent = _frequent(vocabulary).toArrow()
    hot = spark.sparkContext.broadcast(dict(zip(frequent.column("word").to_pylist(), frequent.column("c").to_pylist(), strict=True)))
    space = n + ADDED * (v + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        uid, exact, known = TaskContext.get().partitionId() << 33, hot.value, WordHashes()
        names = [f.split()[0] for f in SCORED.split(", ")]
        types = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), *[pa.binary()] * 5)
        place: dict[bytes, int] = {}
        distinct: list[bytes] = []
        counts: list[int] = []
        waiting: list[tuple[np.ndarray, ...]] = []
        first, size = uid, 0

        def rows_of(n: int, **columns: object) -> pa.RecordBatch:
            found = [columns.get(c, pa.nulls(n, t)) for c, t in zip(names, types, strict=True)]
            return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(found, types, strict=True)], names)

        def block() -> pa.RecordBatch:
            lengths, codes, learned = (np.concatenate(x) for x in zip(*waiting, strict=True))
            hashes = np.fromiter((known[w] for w in distinct), np.uint64, len(distinct))
            found = rows_of(1, uid=[first], lengths=[_spread(lengths)], hashes=[_spread(hashes)], codes=[_spread(codes)], learned=[learned.tobytes()])
            for x in (place, distinct, counts, waiting):
                x.clear()
            return found

        for batch in batches:
            words = [tokens(t) for t in batch.column(2).to_pylist()]
            if not words:
                continue
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            starts = np.cumsum(lengths) - lengths
            codes = np.fromiter((place.setdefault(w, len(place)) for text in words for w in text), np.int32, int(lengths.sum()))
            new = list(islice(reversed(place), len(place) - len(distinct)))[::-1]
            distinct += new
            counts += [exact.get(w, -1) for w in new]
            count = np.array(counts, np.int64)[codes]
            base = np.where(count >= 0, np.log10(np.maximum(count, 0) + ADDED), 0.0)
            ids = uid + np.arange(len(words))
            uid += len(words)
            yield rows_of(
                len(words), uid=ids, doc_id=batch.column(0), held_out=batch.column(1), n_tokens=lengths,
                known=np.add.reduceat((count >= 0).astype(np.int64), starts), base=np.add.reduceat(base, starts),
            )
            tail = np.flatnonzero(count < 0)
            yield rows_of(len(tail), uid=np.repeat(ids, lengths)[tail], word=[distinct[k] for k in codes[tail]])
            waiting.append((lengths, codes, np.array(batch.column(3).to_pylist(), np.uint8)))
            size += 2 * len(codes)
            if size >= CHUNK:
                yield block()
                first, size = uid, 0
        if waiting:
            yield block()

    folder = new_folder(spark, "scored")
    rows.select("doc_id", "held_out", "text", "learn").mapInArrow(run, SCORED).write.option("compression", "zstd").parquet(folder)
    scored = spark.read.schema(SCORED).parquet(folder)
    blocks = scored.where("codes IS NOT NULL")
    size = scored.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    folder = new_folder(spark, "filter")
    segments = max(SEGMENTS, -(-2 * size // SEGMENT_NGRAMS))
    _segments(_ngram_counts(blocks, segments)).write.option("compression", "zstd").parquet(folder)
    filtered = spark.read.schema(FILTERED).parquet(folder)
    stats = np.zeros(2 * LEVELS, np.int64)
    for r in filtered.select(F.posexplode("stats").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).collect():
        stats[r["at"]] = r["n"]
    single = level_means(stats)
    largest = filtered.agg(F.coalesce(F.max(F.octet_length("field")), F.lit(1))).first()[0]
    passes = -(-segments // max(1, GROUP_BYTES // largest))
    group = -(-segments // passes)

    def probes(first: int) -> Broadcast[FrequencyFilter]:
        # Bounded: segments of GROUP_BYTES together, or a single one.
        return _shared(filtered, first, min(first + group, segments), segments)

    firsts = list(range(0, segments, group))
    answers = new_folder(spark, "answers")
    spark.createDataFrame([], "block long, part int, levels binary").write.parquet(answers)
    for first in firsts[:-1]:
        shared = probes(first)
        _probed(blocks, shared).write.mode("append").option("compression", "zstd").parquet(answers)
        shared.destroy()
    earlier = spark.read.schema("block long, part int, levels binary").parquet(answers)
    scores = _scores(blocks, earlier, probes(firsts[-1]), single, texts, space)
    counts = vocabulary.select(F.concat("word", F.lit(b"")).alias("__word"), "c")
    rest = (
        scored.where("word IS NOT NULL").select("uid", "word").join(counts, F.col("word") == F.col("__word"), "left")
        .select("uid", F.log10(F.coalesce("c", F.lit(0)) + F.lit(ADDED)).alias("base"), F.col("c").isNotNull().cast("long").alias("known"), F.lit(None).cast("double").alias("score"))
        .unionByName(scores.select("uid", F.lit(0.0).alias("base"), F.lit(0).cast("long").alias("known"), "score"))
        .groupBy("uid").agg(F.sum("base").alias("__base"), F.sum("known").alias("__known"), F.max("score").alias("score"))
        .select(fresh("uid").alias("__uid"), "__base", "__known", "score")
    )
    return scored.where("n_tokens IS NOT NULL").drop("word", "lengths", "hashes", "codes", "learned").join(rest, F.col("uid") == F.col("__uid"), "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("__known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("__base", F.lit(0.0)) - F.col("n_tokens") * F.lit(math.log10(space))).alias("base_score"),
        "score",
    )
