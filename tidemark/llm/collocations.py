"""Phrases that hold together, from exact phrase counts in HAT-tries that spill sorted runs."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bits import BITS, bit_table, may_hold
from tidemark.llm.frames import whole_text
from tidemark.operators.keyed import ranked
from tidemark.sources.scratch import new_folder

LEAST = 100
LONGEST = 5
REPORT = 2000
NO_LANGUAGE = "und"
# A longer phrase with this share of a phrase's count, in hundredths, covers it.
COVER = 100

# Entries of a bucket before it bursts, and of a task's tries before they spill.
BURST = 4096
MEMORY = 800_000
# Bytes of text that a task numbers at once, and that it gathers by language first; longer texts are cut where a piece ends.
CHUNK = 8 << 20
GATHER = 16 << 20
# Pairs are first counted by hash in a table of a fixed size: 2**24 numbers of a byte in a task, 2 MB of bits for all.
PAIR_BITS = 24
BLOCK_BITS = 16
# Words that a task numbers before it hands all on and starts anew.
NUMBERS = 1_000_000
BATCH = 20_000

# A mark that no word holds stands for the end of a piece.
_END = b"."
_ENDS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _END * 10)
_RUNS = "kind int, lang string, phrase binary, n long"
_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Node(dict):
    """Children by word id: nodes or buckets."""


class _Bucket(dict):
    """Counts by the rest of a phrase, a tuple of word ids."""


class HatTrie:
    """Counts of phrases as tuples of word ids: a shallow trie over hash buckets, each of which bursts when full.

    Subtrees under a first word leave as one sorted run.
    """

    def __init__(self, burst: int = BURST):
        self.burst = burst
        self.root = _Node()
        self.sizes: Counter[int] = Counter()

    def __len__(self) -> int:
        return self.sizes.total()

    def add(self, phrase: tuple[int, ...], n: int) -> None:
        node, at = self.root, 0
        child = node.get(phrase[0])
        while type(child) is _Node:
            node, at = child, at + 1
            child = node.get(phrase[at])
        rest = phrase[at + 1 :]
        if child is None:
            child = node[phrase[at]] = _Bucket()
        if rest in child:
            child[rest] += n
            return
        child[rest] = n
        self.sizes[phrase[0]] += 1
        if len(child) > self.burst and len(rest) > 1:
            parts = node[phrase[at]] = _Node()
            for word, *others in child:
                parts.setdefault(word, _Bucket())[tuple(others)] = child[(word, *others)]

    def add_sorted(self, phrases: Iterable[tuple[int, ...]], counts: Iterable[int]) -> None:
        """Add phrases that come with equal first words together; a first word's bucket is looked up once."""
        first = child = None
        for phrase, n in zip(phrases, counts, strict=True):
            if phrase[0] != first:
                first = phrase[0]
                child = self.root.get(first)
            if type(child) is not _Bucket or (len(child) >= self.burst and len(phrase) > 2):
                self.add(phrase, n)
                child = self.root[first]
                continue
            rest = phrase[1:]
            seen = child.get(rest)
            child[rest] = n if seen is None else seen + n
            if seen is None:
                self.sizes[first] += 1

    def _below(self, node: _Node | _Bucket, path: tuple[int, ...]) -> Iterator[tuple[tuple[int, ...], int]]:
        for key, value in node.items():
            if type(node) is _Bucket:
                yield path + key, value
            else:
                yield from self._below(value, (*path, key))

    def spill(self, keep: int) -> Iterator[tuple[tuple[int, ...], int]]:
        """Phrases of the largest subtrees, which go, until at most ``keep`` entries stay."""
        left = len(self)
        for first, size in self.sizes.most_common():
            if left <= keep:
                break
            yield from self._below(self.root.pop(first), (first,))
            left -= self.sizes.pop(first)


class _Numbers(dict):
    """Word ids of a task, given as words come; 0 is the end of a piece, as is an empty word."""

    def __init__(self):
        self.words: list[bytes] = []
        self.hashes: list[int] = []
        self[_END]
        self[b""] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.words)
        self.words.append(word)
        self.hashes.append(xxhash.xxh64_intdigest(word, 42))
        return n


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _ODD
    return h ^ (h >> np.uint64(29))


def phrase_hashes(lang: str, words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all phrases of ``size`` words, from the hashes of words that follow each other."""
    n = max(0, len(words) - size + 1)
    h = np.full(n, xxhash.xxh64_intdigest(lang.encode(), 42), np.uint64)
    for k in range(size):
        h = _mixed(h + words[k : k + n])
    return h


def _hashed(phrases: DataFrame, size: int) -> DataFrame:
    """``h``, the hash of each phrase of ``size`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = np.array([xxhash.xxh64_intdigest(w, 42) for w in phrase.split(b" ")], np.uint64)
                found.append(phrase_hashes(lang, words, size))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["h"])

    return phrases.select("lang", F.col("phrase").cast("binary")).mapInArrow(run, "h long")


def tokens(texts: list[bytes]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Different words of whole texts, A-Z lower-cased, and the place of each token's word among them.

    A mark, or an empty word, stands where a piece ends. About ``CHUNK`` bytes
    are taken at a time; they are cut where a piece ends.
    """
    whole = _END.join(texts).lower().translate(_ENDS)
    at = 0
    while at < len(whole):
        end = whole.find(_END, at + CHUNK)
        end = len(whole) if end < 0 else end
        part = pa.array([whole[at:end].replace(_END, b" " + _END + b" ")], pa.binary()).view(pa.string())
        found = pc.ascii_split_whitespace(part).flatten().dictionary_encode()
        yield found.dictionary.view(pa.binary()).to_pylist(), found.indices.to_numpy()
        at = end


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language together, ``GATHER`` bytes of all languages at a time."""
    texts: dict[str, list[bytes]] = defaultdict(list)
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            texts[lang].append(text)
            size += len(text)
            if size >= GATHER:
                yield from texts.items()
                texts, size = defaultdict(list), 0
    yield from texts.items()


def _rows(kind: int, lang: str, phrases: pa.Array, counts: pa.Array | None = None) -> Iterator[pa.RecordBatch]:
    """Rows of one kind and language, ``BATCH`` at a time."""
    size = len(phrases)
    counts = pa.nulls(size, pa.int64()) if counts is None else counts
    columns = [pa.array(np.full(size, kind, np.int32)), pa.array([lang] * size, pa.string()), phrases, counts]
    yield from pa.Table.from_arrays(columns, ["kind", "lang", "phrase", "n"]).to_batches(BATCH)


def _run(lang: str, phrases: pa.Array, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A sorted run of phrases and their counts."""
    order = pc.sort_indices(phrases)
    yield from _rows(1, lang, phrases.take(order), pa.array(counts).take(order))


def _word_runs(texts: DataFrame) -> DataFrame:
    """Counts of all words, one row for each word and task or less."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter[bytes]] = defaultdict(Counter)

        def handed() -> Iterator[pa.RecordBatch]:
            for lang, own in counts.items():
                for no_word in (_END, b""):
                    own.pop(no_word, None)
                yield from _run(lang, pa.array(list(own), pa.binary()), np.fromiter(own.values(), np.int64, len(own)))
            counts.clear()

        for lang, own in _by_lang(batches):
            for words, places in tokens(own):
                counts[lang].update(dict(zip(words, np.bincount(places, minlength=len(words)).tolist(), strict=True)))
                if sum(map(len, counts.values())) >= MEMORY:
                    yield from handed()
        yield from handed()

    return texts.mapInArrow(run, _RUNS)


def distinct_phrases(ids: np.ndarray, at: np.ndarray, size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The different phrases of ``size`` ids that start at ``at``, as a column for each place, and their counts."""
    group = ids[at]
    for k in range(1, size):
        # Groups and ids are below 2**31, so a group and the next id make one number.
        _, first, group, counts = np.unique(group << 32 | ids[at + k], return_index=True, return_inverse=True, return_counts=True)
    return [ids[at[first] + k] for k in range(size)], counts


class _Places:
    """Where phrases of ``size`` words may start: both parts of one word fewer may be frequent, and no piece ends within."""

    def __init__(self, size: int, table: np.ndarray):
        self.size, self.table = size, table
        self.numbers, self.hashes = _Numbers(), np.empty(0, np.uint64)

    def find(self, lang: str, words: list[bytes], places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all tokens, the hashes of their words, and the starts."""
        ids = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))[places]
        self.hashes = np.concatenate([self.hashes, np.array(self.numbers.hashes[len(self.hashes) :], np.uint64)])
        hashes = self.hashes[ids]
        part = may_hold(self.table, phrase_hashes(lang, hashes, self.size - 1))
        for k in range(self.size - 1):
            part &= ids[k : k + len(part)] != 0
        return ids, hashes, np.flatnonzero(part[:-1] & part[1:])


def _pair_table(texts: DataFrame, table: np.ndarray, least: int) -> np.ndarray:
    """Bits of the pair hashes that occur ``least`` times; several pairs may share a bit, so none that is frequent is missed.

    Each task counts in a table of its own, up to ``least`` at most, and sends
    it block by block; a task sums each block.
    """
    spark = texts.sparkSession
    shared, kind, size = spark.sparkContext.broadcast(table), np.uint8 if least < 256 else np.uint32, 1 << BLOCK_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, seen = _Places(2, shared.value), np.zeros(1 << PAIR_BITS, kind)
        for lang, own in _by_lang(batches):
            for words, places in tokens(own):
                _, hashes, at = found.find(lang, words, places)
                place, n = np.unique(phrase_hashes(lang, hashes, 2)[at] >> np.uint64(64 - PAIR_BITS), return_counts=True)
                seen[place] = np.minimum(seen[place] + n, least)
                if len(found.numbers) >= NUMBERS:
                    found = _Places(2, shared.value)
        for block, part in enumerate(seen.reshape(-1, size)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["block", "seen"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, seen = None, np.zeros(size, np.int64)

        def bits() -> pa.RecordBatch:
            packed = np.packbits(seen >= least, bitorder="little")
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([packed.tobytes()], pa.binary())], ["block", "seen"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != block:
                    if block is not None:
                        yield bits()
                    block, seen = row["block"], np.zeros(size, np.int64)
                seen += np.frombuffer(row["seen"], kind)
        if block is not None:
            yield bits()

    schema = "block int, seen binary"
    summed = texts.mapInArrow(run, schema).repartition("block").sortWithinPartitions("block").mapInArrow(total, schema)
    # Bounded: 2**PAIR_BITS bits.
    out = np.zeros((1 << (PAIR_BITS - BLOCK_BITS), size // 8), np.uint8)
    for row in summed.collect():
        out[row["block"]] = np.frombuffer(row["seen"], np.uint8)
    return out.ravel()


def _phrase_runs(texts: DataFrame, size: int, table: np.ndarray, whole: np.ndarray | None = None) -> DataFrame:
    """Counts of the phrases of ``size`` words whose two parts of one word fewer may be frequent.

    ``whole`` is a bit table of the phrases themselves, where there is one.
    Rows of kind 1 are phrases in sorted runs, rows of kind 0 the stretches of
    text that can hold longer ones.
    """
    shared = texts.sparkSession.sparkContext.broadcast((table, whole))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, whole = shared.value
        found = _Places(size, table)
        tries: dict[str, HatTrie] = defaultdict(HatTrie)

        def spilled(most: int) -> Iterator[pa.RecordBatch]:
            if sum(map(len, tries.values())) <= most:
                return
            named = pa.array(found.numbers.words, pa.binary())
            for lang, trie in tries.items():
                run = list(trie.spill(len(trie) // 2 if most else 0))
                if run:
                    ids, counts = np.array([p for p, _ in run]), np.array([n for _, n in run])
                    parts = [named.take(pa.array(column)) for column in ids.T]
                    yield from _run(lang, pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary())), counts)

        for lang, own in _by_lang(batches):
            for words, places in tokens(own):
                ids, hashes, at = found.find(lang, words, places)
                if whole is not None:
                    at = at[may_hold(whole, phrase_hashes(lang, hashes, size)[at])]
                if not len(at):
                    continue
                columns, counts = distinct_phrases(ids, at, size)
                tries[lang].add_sorted(zip(*(c.tolist() for c in columns), strict=True), counts.tolist())
                yield from _rows(0, lang, pa.array([stretches(pa.array(words, pa.binary()), places, at, size)], pa.binary()))
                yield from spilled(MEMORY)
                if len(found.numbers) >= NUMBERS:
                    yield from spilled(0)
                    found = _Places(size, table)
        yield from spilled(0)

    return texts.mapInArrow(run, _RUNS)


def stretches(words: pa.Array, tokens: np.ndarray, at: np.ndarray, size: int) -> bytes:
    """The words of the phrases that start at ``at``, with line ends where words between them are left out."""
    covered = np.zeros(len(tokens), bool)
    for k in range(size):
        covered[at + k] = True
    places = np.flatnonzero(covered)
    # Words that follow each other in the text stay neighbours; marks are never covered.
    glue = pa.array([b" ", b"\n"], pa.binary()).take(pa.array((np.diff(places, prepend=places[0]) > 1).astype(np.int32)))
    joined = pc.binary_join_element_wise(glue, words.take(pa.array(tokens[places])), pa.scalar(b"", pa.binary()))
    # The values of an array lie one behind the other.
    return joined.buffers()[2].to_pybytes()[: np.frombuffer(joined.buffers()[1], np.int32)[len(places)]]


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    folder = new_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _merged(runs: DataFrame) -> DataFrame:
    """``lang``, ``phrase`` and ``n`` from all runs.

    Each partition merges a range of prefixes; the ranges follow the runs, so
    a frequent first word is dealt over several.
    """
    rows = runs.where("kind = 1").select("lang", F.col("phrase").cast("string").alias("phrase"), "n")
    return rows.repartitionByRange("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """Phrases with ``least`` occurrences, ``(lang, phrase, n, size)``, and the words of each language, ``(lang, total)``.

    Sizes are counted in turn. A phrase can be frequent only if both its parts
    of one word fewer are, so each pass reads only the stretches of text that
    the last one left, and counts what a bit table of the last size lets pass.
    Pairs, of which there are most, are counted by hash before: what stays
    below ``least`` there is in no trie and no run.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), whole_text().cast("binary").alias("phrase"))
    words = _stored(_merged(_stored(_word_runs(texts), "word-runs")), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    found = [_stored(words.where(F.col("n") >= least), "phrases-1")]
    for size in range(2, longest + 1):
        table = bit_table(_hashed(found[-1], size - 1), "h", bits)
        pairs = _pair_table(texts, table, least) if size == 2 else None
        runs = _stored(_phrase_runs(texts, size, table, pairs), "phrase-runs")
        found.append(_stored(_merged(runs).where(F.col("n") >= least), f"phrases-{size}"))
        texts = runs.where("kind = 0").select("lang", "phrase")
    whole = found[0].withColumn("size", F.lit(1))
    for size, part in enumerate(found[1:], 2):
        whole = whole.unionByName(part.withColumn("size", F.lit(size)))
    return whole, totals


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def _part(start: Column | int, length: Column) -> Column:
    return F.array_join(F.slice("words", start, length), " ")


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates with ``a``, the counts ``l`` and ``r`` of the parts of their lowest-scoring cut, ``n`` and ``score``."""
    split = phrases.where("size > 1").withColumnRenamed("n", "a").withColumn("words", F.split("phrase", " "))
    cuts = split.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "size", "k", _part(1, F.col("k")).alias("first"), _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest")
    )

    def parts(column: str, count: str) -> DataFrame:
        return phrases.select(F.col("lang").alias(f"lang_{count}"), F.col("phrase").alias(column + "_known"), F.col("n").alias(count))

    cuts = cuts.join(parts("first", "l"), (F.col("lang") == F.col("lang_l")) & (F.col("first") == F.col("first_known")))
    cuts = cuts.join(parts("rest", "r"), (F.col("lang") == F.col("lang_r")) & (F.col("rest") == F.col("rest_known")))
    cuts = cuts.join(totals.select(F.col("lang").alias("lang_n"), F.col("total").alias("n")), F.col("lang") == F.col("lang_n"))
    # 38 digits hold a thousand times the product of two counts of up to 17 digits, and "div" drops the remainder.
    cuts = cuts.withColumn("above", F.lit(1000).cast("decimal(4,0)") * _exact("a") * _exact("n")).withColumn("below", _exact("l") * _exact("r"))
    cuts = cuts.withColumn("score", F.expr("above div below"))
    lowest = cuts.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", "a", "n", "size")).alias("cut")
    )
    return lowest.select("lang", "phrase", *[f"cut.{c}" for c in ("a", "l", "r", "n", "score", "size")])


def uncovered(candidates: DataFrame) -> DataFrame:
    """Candidates that no longer one holds with (nearly) all their occurrences."""
    place = F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("size") - 1),
        lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda k: F.struct(k.alias("k"), n.alias("n"))),
    )))
    inner = candidates.where("size > 2").withColumn("words", F.split("phrase", " ")).withColumn("place", place)
    inner = inner.select(F.col("lang").alias("__lang"), _part(F.col("place.k"), F.col("place.n")).alias("__phrase"), "a")
    cover = inner.groupBy("__lang", "__phrase").agg(F.max("a").alias("__longer"))
    found = candidates.join(cover, (F.col("lang") == F.col("__lang")) & (F.col("phrase") == F.col("__phrase")), "left")
    return found.where(F.col("__longer").isNull() | (100 * F.col("__longer") < COVER * F.col("a"))).drop("__lang", "__phrase", "__longer")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, report: int = REPORT) -> DataFrame:
    """The first phrases of each language by score: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    All whole texts count; a null text has no words, a null language is
    ``und``, rows that repeat count again. Equal scores go by count, then by
    the phrase's bytes. Other columns are not read. Texts without a frequent
    phrase, or an empty table, give no rows.
    """
    phrases, totals = phrase_counts(docs, least, longest)
    kept = uncovered(_stored(scored(phrases, totals), "candidates"))
    best = ranked(kept, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], report, "rank")
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
