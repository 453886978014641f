"""Named tables: find, read, replace and extend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.scratch import children, exists, remove

# Fixed value: both spellings occur in table names.
QUARANTINE_PARTS = ("quarantine", "quaruntine")


def ensure_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


def find_tables(
    spark: SparkSession, schema: str, first: Sequence[str] = (), parts: Sequence[str] = QUARANTINE_PARTS
) -> list[str]:
    """Full names of existing tables: those in ``first``, then others whose name holds a part."""
    found = [name for name in first if spark.catalog.tableExists(name)]
    if not spark.catalog.databaseExists(schema):
        return found
    for table in spark.catalog.listTables(schema):
        full = f"{schema}.{table.name}"
        if not table.isTemporary and full not in found and any(p in table.name.lower() for p in parts):
            found.append(full)
    return found


def read_tables(spark: SparkSession, names: Sequence[str]) -> dict[str, DataFrame]:
    return {name: spark.read.table(name) for name in names}


def _fitted(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    return df.select(*columns) if columns else df


def quoted(path: str) -> str:
    """A path as SQL takes it for a file source."""
    return "`" + path.replace("`", "``") + "`"


def _plain_types(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema]


def refresh_table(df: DataFrame, name: str, folder: str, columns: Sequence[str] | None = None) -> None:
    """Replace a table whole, in the given column order; readers never see it half done.

    The rows go to a fresh folder under ``folder``. Once their number and
    columns are found as they were written, the view ``name`` turns to them.
    Until then, and for good if anything fails, it shows the rows before. The
    complete folder before stays, for readers that began before the turn; one
    job at a time may refresh a table.
    """
    spark, rows, written = df.sparkSession, _fitted(df, columns), Observation()
    versions = sorted(int(v.removeprefix("v")) for v in children(spark, folder) if v.startswith("v"))
    complete = [v for v in versions if exists(spark, f"{folder}/v{v}/_SUCCESS")]
    target = f"{folder}/v{max(versions, default=0) + 1}"
    rows.observe(written, F.count(F.lit(1)).alias("n")).write.parquet(target)
    stored = spark.read.parquet(target)
    if _plain_types(stored) != _plain_types(rows) or stored.count() != written.get["n"]:
        remove(spark, target)
        raise RuntimeError(f"{name}: stored rows differ from those written")
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.{quoted(target)}")
    for old in sorted({*versions} - {*complete[-1:]}):
        remove(spark, f"{folder}/v{old}")


def replace_table(df: DataFrame, name: str, columns: Sequence[str] | None = None) -> None:
    """Write a fully refreshed table, in the given column order."""
    _fitted(df, columns).write.mode("overwrite").format("parquet").saveAsTable(name)


def extend_table(df: DataFrame, name: str, columns: Sequence[str] | None = None) -> None:
    """Add rows to a history table."""
    _fitted(df, columns).write.mode("append").format("parquet").saveAsTable(name)
