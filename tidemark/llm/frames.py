"""Reading, holding and Arrow helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.scratch import shared_folder

# Rows of a batch that goes to Python, so that a batch of long texts stays small.
BATCH_ROWS = 1000
BATCH_BYTES = 16 * 1024 * 1024

# Words are runs of characters other than ASCII white space.
SPACE = r"\x20\x09-\x0D"
SPACE_CHARACTERS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the driver; Python batches are kept small from here on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held(df: DataFrame) -> DataFrame:
    """The rows from reliable files in the shared folder: lineage ends here and executors may go."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def whole_text(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def by_batch(
    df: DataFrame, run: Callable[[pa.Table], pa.Table | None], schema: str
) -> DataFrame:
    """Apply ``run`` to each Arrow batch of ``df``; for schema details see mapInArrow."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = run(pa.Table.from_batches([batch]))
            if found is not None:
                yield from found.to_batches()

    return df.mapInArrow(each, schema)


ROW = "__row"


def as_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one, so that no name of theirs can meet a name used on the way."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW)


def row_columns(names: Iterable[str]) -> list[Column]:
    """The columns that :func:`as_row` packed."""
    return [F.col(ROW).getField(n).alias(n) for n in names]
