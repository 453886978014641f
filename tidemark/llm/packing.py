"""Pack token ids into sequences of one length with a bounded number of open windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.encoding import encoder
from tidemark.llm.frames import whole_text
from tidemark.sources.scratch import new_folder

LENGTH = 2048
OPEN_WINDOWS = 16
END = 1
# Leftover windows that one task merges; each such task leaves one padded sequence at most.
MERGED = 4096

PIECES = "doc_id long, doc_tokens long, start long, ids binary, sequence_id long, offset long, open boolean"
_COLUMNS = [f.split()[0] for f in PIECES.split(", ")]
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()]
_TASK = 1 << 32
_MERGED = 1 << 62


class Packer:
    """Open windows of one task. Filled windows are written to ``rows`` as pieces."""

    def __init__(self, length: int, windows: int, first_id: int):
        self.length, self.windows, self.next_id = length, windows, first_id
        self.open: list[list] = []  # [tokens, pieces] of each
        self.rows: list[tuple] = []

    def _emit(self, pieces: list[tuple], still_open: bool = False) -> None:
        offset = 0
        for doc_id, doc_tokens, start, ids in pieces:
            self.rows.append((doc_id, doc_tokens, start, ids.tobytes(), self.next_id, offset, still_open))
            offset += len(ids)
        self.next_id += 1

    def _put(self, window: list, piece: tuple) -> None:
        window[0] += len(piece[3])
        window[1].append(piece)
        if window[0] == self.length:
            self._emit(window[1])
            self.open = [w for w in self.open if w is not window]

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        """Whole windows first; the rest goes best-fit, and fills up the fullest window when none has room."""
        tokens, start = len(ids), 0
        while tokens - start >= self.length:
            self._emit([(doc_id, tokens, start, ids[start : start + self.length])])
            start += self.length
        while start < tokens:
            need = tokens - start
            roomy = [w for w in self.open if self.length - w[0] >= need]
            if roomy:
                window = max(roomy, key=lambda w: w[0])
            elif len(self.open) < self.windows:
                window = [0, []]
                self.open.append(window)
            else:
                window = max(self.open, key=lambda w: w[0])
                need = self.length - window[0]
            self._put(window, (doc_id, tokens, start, ids[start : start + need]))
            start += need

    def leave(self) -> None:
        """Hand over the windows that are still open."""
        for _, pieces in self.open:
            self._emit(pieces, still_open=True)
        self.open = []

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(_TYPES)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], _COLUMNS)


def _merge(leftovers: DataFrame, length: int) -> DataFrame:
    """Lay the pieces of open windows end to end, cut at the sequence length."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer = Packer(length, 1, _MERGED + TaskContext.get().partitionId() * _TASK)
        window: list = [0, []]
        for batch in batches:
            for row in batch.to_pylist():
                ids, at = np.frombuffer(row["ids"], "<u4"), 0
                while at < len(ids):
                    part = ids[at : at + length - window[0]]
                    window[0] += len(part)
                    window[1].append((row["doc_id"], row["doc_tokens"], row["start"] + at, part))
                    at += len(part)
                    if window[0] == length:
                        packer._emit(window[1])
                        window = [0, []]
            yield packer.batch()
        if window[0]:
            packer._emit(window[1])
        yield packer.batch()

    windows = leftovers.select(F.count_distinct("sequence_id")).first()[0]
    tasks = max(1, -(-windows // MERGED))
    dealt = leftovers.repartition(tasks, "sequence_id").sortWithinPartitions("sequence_id", "offset")
    return dealt.mapInArrow(each, PIECES)


def pack(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, windows: int = OPEN_WINDOWS, end: int = END
) -> DataFrame:
    """Pieces of all documents in sequences of ``length`` tokens.

    Columns: ``doc_id``, ``doc_tokens`` (with the end id), ``start`` (the
    document's ids before the piece), ``ids`` (little-endian unsigned 32-bit),
    ``sequence_id`` and ``offset`` in the sequence. Each task keeps ``windows``
    open windows. A text's full-length parts become sequences at once; its rest
    goes to the window it fills best, and if none has room the fullest is
    filled up with a part of it and emitted. Windows open at the end of a task
    are laid end to end by a few tasks, so one sequence for each 4,096 leftover
    windows is shorter than ``length``.

    A null text counts as empty and still holds the end id. Every row counts as
    a document of its own, also with a null or repeated id. Other columns are
    not used. An empty table gives no pieces.
    """
    spark = docs.sparkSession

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer)
        packer = Packer(length, windows, TaskContext.get().partitionId() * _TASK)
        for batch in batches:
            offsets, ids = encode.encode_all(batch.column(1))
            ids = np.insert(ids, offsets[1:], end)
            offsets = offsets + np.arange(len(offsets))
            for k, doc_id in enumerate(batch.column(0).to_pylist()):
                packer.add(doc_id, ids[offsets[k] : offsets[k + 1]].copy())
            yield packer.batch()
        packer.leave()
        yield packer.batch()

    folder = new_folder(spark, "packed")
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
     .mapInArrow(each, PIECES).write.partitionBy("open").option("compression", "zstd").parquet(folder))
    pieces = spark.read.schema(PIECES).parquet(folder)
    merged = _merge(pieces.where("open"), length)
    return pieces.where("NOT open").unionByName(merged).drop("open")
