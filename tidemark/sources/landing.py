"""Rows of landing files, as text, under the spelling each entity declares.

CSV files of one entity come with different headers, so files are read in
groups of equal headers and joined by column name. All values stay text: no
type is guessed, and ``00701`` or ``6.40E+11`` arrive as written.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from typing import Literal
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.entities import RESCUED, Entity
from tidemark.sources.scratch import new_folder

# Fixed value: how a region shows in a path.
REGION_IN_PATH = r"(?i)region\s*(\d+)"
SPLIT_BYTES = str(128 * 1024 * 1024)

LINEAGE_COLUMNS = ("_source_file", "_load_timestamp", "_region")

Evolution = Literal["add", "rescue"]


def escaped(path: str) -> str:
    """The path with glob characters taken literally."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def _first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of a split that starts its file; nothing more of the split is read."""
    for batch in batches:
        if batch.num_rows:
            if batch.column("start")[0].as_py() == 0:
                yield batch.slice(0, 1)
            return


def headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """Paths by the first line of the file, from one job for all files.

    A session of its own gives every split a task of its own and small Arrow
    batches, so a task stops after a few lines. Paths and first lines reach the
    driver; the stream's limit of files for each batch bounds them.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.files.openCostInBytes", SPLIT_BYTES)
    session.conf.set("spark.sql.files.maxPartitionBytes", SPLIT_BYTES)
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    lines = session.read.text([escaped(p) for p in paths]).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
    )
    groups: dict[str, list[str]] = defaultdict(list)
    for row in lines.mapInArrow(_first_rows, "path string, start long, value string").collect():
        groups[row.value.lstrip("\ufeff").rstrip("\r")].append(plain_path(row.path))
    return {header: sorted(group) for header, group in sorted(groups.items())}


def plain_path(uri: str) -> str:
    """A path as Spark reads it from the percent-encoded form in the file metadata."""
    return unquote(uri)


def column_names(header: str, entity: Entity) -> list[str]:
    """Names of a header line in the declared spelling; a repeated name gets its position."""
    declared = {c.lower(): c for c in entity.columns}
    names: list[str] = []
    for place, raw in enumerate(next(csv.reader([header]))):
        name = declared.get(raw.strip().lower(), raw.strip()) or f"_c{place}"
        taken = {n.lower() for n in names}
        names.append(f"{name}{place}" if name.lower() in taken else name)
    return names


def _with_lineage(df: DataFrame) -> DataFrame:
    # Paths arrive percent-encoded; a plain plus sign must survive decoding.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    number = F.regexp_extract(path, REGION_IN_PATH, 1)
    return df.withColumns(
        {
            "_source_file": path,
            "_load_timestamp": F.current_timestamp(),
            "_region": F.when(number == "", "global").otherwise(number),
        }
    )


def read_csv(spark: SparkSession, paths: Sequence[str], entity: Entity, scratch: str | None = None) -> DataFrame | None:
    """Files with different headers; nothing is stored on the way, so ``scratch`` stays unused."""
    frames = []
    for header, group in headers(spark, paths).items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in column_names(header, entity)])
        reader = spark.read.schema(schema).option("header", True)
        frames.append(_with_lineage(reader.csv([escaped(p) for p in group])))
    return _by_name(frames)


_RECORD = "__record"
# Fixed value: the column of a text that is no JSON.
CORRUPT = "_corrupt_record"


# A string of JSON, or a bare number or truth value. Strings hold no control characters, so two of them may mark what was bare.
_TOKEN = r'("(?:[^"\\]++|\\.)*+")|(-?[0-9][0-9.eE+-]*+|true|false)'
_OPEN, _CLOSE = "\x01", "\x02"


def _quoted(json: Column) -> Column:
    """JSON with every bare number and truth value as the string of what is written."""
    marked = F.regexp_replace(json, _TOKEN, f"$1{_OPEN}$2{_CLOSE}")
    return F.translate(F.replace(marked, F.lit(_OPEN + _CLOSE), F.lit("")), _OPEN + _CLOSE, '""')


def parse_json(files: DataFrame) -> DataFrame:
    """One row for each object of files read whole, as a map of texts.

    Numbers stay as written, also within nested values, which stay JSON text.
    That is why the values are texts and not variants: a variant keeps a number
    and forgets how it was written. A single object counts as an array of one.
    A file that is no JSON gives one row with its text under ``CORRUPT``.
    """
    text = F.regexp_replace("value", "^\ufeff", "")
    array = F.when(F.ltrim(text).startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    corrupt = F.array(F.create_map(F.lit(CORRUPT), F.col("value")))
    records = F.coalesce(F.from_json(_quoted(array), "array<map<string,string>>"), F.when(F.trim(text) != "", corrupt))
    return _with_lineage(files).select(F.explode(records).alias(_RECORD), *LINEAGE_COLUMNS).where(F.col(_RECORD).isNotNull())


def read_json(spark: SparkSession, paths: Sequence[str], entity: Entity, scratch: str | None = None) -> DataFrame | None:
    """Files that each hold one array of objects. Nested values stay JSON text.

    Files are read and parsed once, into the folder ``scratch``; the names of
    their fields are then gathered from the stored rows. Names that differ only
    by case are one column. One file is one task's work, held whole a few times
    over: it has to stay well below 2 GB, the most a text can hold.
    """
    rows = scratch or new_folder(spark, "json-rows")
    parse_json(spark.read.text([escaped(p) for p in paths], wholetext=True)).write.parquet(rows)
    stored = spark.read.parquet(rows)
    # As many rows as there are different names.
    names = sorted(r[0] for r in stored.select(F.explode(F.map_keys(_RECORD))).distinct().collect())
    if not names:
        return None
    spellings: dict[str, list[str]] = defaultdict(list)
    for name in names:
        spellings[name.lower()].append(name)
    declared = {c.lower(): c for c in entity.columns}
    merged = [
        F.coalesce(*[F.try_element_at(_RECORD, F.lit(name)) for name in same]).alias(declared.get(lower, same[0]))
        for lower, same in spellings.items()
    ]
    return stored.select(*merged, *LINEAGE_COLUMNS)


def _by_name(frames: Iterable[DataFrame]) -> DataFrame | None:
    frames = list(frames)
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


READERS = {"csv": read_csv, "json": read_json}


def rescue(df: DataFrame, entity: Entity, evolution: Evolution) -> DataFrame:
    """Handle columns the entity does not declare: keep them, or fold them into one JSON column."""
    known = {c.lower() for c in entity.columns} | set(LINEAGE_COLUMNS)
    extra = [c for c in df.columns if c.lower() not in known]
    if evolution == "add" or not extra:
        return df.withColumn(RESCUED, F.lit(None).cast("string"))
    named = F.struct(*[F.col(f"`{c}`") for c in extra])
    some = F.coalesce(*[F.col(f"`{c}`") for c in extra]).isNotNull()
    return df.withColumn(RESCUED, F.when(some, F.to_json(named))).drop(*extra)
