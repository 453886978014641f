"""Landing files to bronze tables, new files only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.entities import ENTITIES, LINEAGE, Entity
from tidemark.sources.landing import READERS, Evolution, rescue
from tidemark.sources.scratch import exists, new_folder, remove

# The listing fields of the binary file source; file contents are not read,
# because only the path is selected.
_LISTING = "path string, modificationTime timestamp, length bigint, content binary"
MAX_FILES = 10_000


def new_files(spark: SparkSession, landing: str, entity: Entity, max_files: int = MAX_FILES) -> DataFrame:
    """Stream of paths that match the entity's pattern, in the folder and below it."""
    return (
        spark.readStream.format("binaryFile")
        .schema(_LISTING)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", entity.file_glob)
        .option("maxFilesPerTrigger", max_files)
        .load(landing)
        .select("path")
    )


def batch_loader(
    entity: Entity, bronze: str, evolution: Evolution = "add"
) -> Callable[[DataFrame, int], None]:
    """Write the rows of a batch of files to a folder named after the batch.

    A batch keeps its list of files. When it is repeated, a complete folder
    stays as it is, since streams that follow the table may have read its
    files and would take new ones for new rows. An incomplete folder is
    replaced.
    """

    def load(files: DataFrame, batch_id: int) -> None:
        folder = f"{bronze}/batch_id={batch_id}"
        if exists(files.sparkSession, f"{folder}/_SUCCESS"):
            return
        # A list of at most ``max_files`` paths.
        paths = [row.path for row in files.collect()]
        scratch = new_folder(files.sparkSession, "landing")
        rows = READERS[entity.file_format](files.sparkSession, paths, entity, scratch) if paths else None
        if rows is not None:
            kept = rescue(rows, entity, evolution)
            kept.write.mode("overwrite").parquet(folder)
        remove(files.sparkSession, scratch)

    return load


def bronze_schema(entity: Entity) -> T.StructType:
    """Declared columns and lineage, as every batch can be read."""
    text = [T.StructField(c, T.StringType()) for c in entity.columns]
    lineage = [T.StructField(n, T.DataType.fromDDL(t)) for n, t in LINEAGE.items()]
    return T.StructType(text + lineage)


def ensure_table(spark: SparkSession, bronze: str, entity: Entity) -> None:
    """An empty first batch, so that a table without files yet can be read and followed."""
    if not exists(spark, bronze):
        empty = spark.createDataFrame([], bronze_schema(entity))
        empty.write.mode("overwrite").parquet(f"{bronze}/batch_id=-1")


def ingest(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    entity: Entity,
    evolution: Evolution = "add",
    max_files: int = MAX_FILES,
) -> StreamingQuery:
    """Start a run that takes every file not yet taken, then stops."""
    ensure_table(spark, bronze, entity)
    return (
        new_files(spark, landing, entity, max_files)
        .writeStream.foreachBatch(batch_loader(entity, bronze, evolution))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_all(spark: SparkSession, landing: str, root: str, **options) -> None:
    """Bring all six entities of a landing folder up to date under ``root``."""
    runs = [
        ingest(spark, landing, f"{root}/bronze/{name}", f"{root}/checkpoints/bronze/{name}", entity, **options)
        for name, entity in ENTITIES.items()
    ]
    for run in runs:
        run.awaitTermination()


def read_bronze(spark: SparkSession, bronze: str) -> DataFrame:
    """All batches; a column that came later is NULL in earlier rows."""
    return spark.read.option("mergeSchema", True).parquet(bronze)
