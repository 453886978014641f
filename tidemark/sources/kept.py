"""Tables kept by key buckets: an upsert rewrites only the buckets that its rows touch.

Every upsert writes its buckets to a folder of its own and then one small list
that says which folders hold each bucket. The list is what readers follow, so
a job that fails midway changes nothing for them, and a job that is repeated
finds its list and leaves the table as it is.

A table without a merge only grows: a batch brings rows that the table does not
hold, and they are written beside the old ones, which are not read. A bucket
that lies in many folders is written anew as one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.keyed import one_per_key
from tidemark.sources.scratch import children, exists, move, new_folder, remove

BUCKET = "__bucket"
# A look-up reads whole buckets, so their number goes with the size of the table.
BUCKETS = 64
# Folders that a growing bucket may lie in.
PARTS = 16

Merge = Callable[[DataFrame], DataFrame]


def newest(keys: Sequence[str], *order: Column) -> Merge:
    """Of the rows of a key the first by ``order`` stays, ties by a hash of the row; so no order of batches matters."""
    return lambda rows: one_per_key(rows, keys, order)


@dataclass
class KeptTable:
    """Rows by ``keys`` under ``root``; ``merge`` makes the rows of a key, old and new, into those that stay.

    Without ``merge`` the rows of a batch have to be new to the table.
    """

    spark: SparkSession
    root: str
    schema: T.StructType
    keys: tuple[str, ...]
    merge: Merge | None
    buckets: int = BUCKETS

    def _bucket(self, keys: Sequence[str]) -> Column:
        named = [F.col(k).cast(self.schema[name].dataType) for k, name in zip(keys, self.keys, strict=True)]
        return F.pmod(F.xxhash64(*named), F.lit(self.buckets)).cast("int")

    def _batches(self) -> list[int]:
        """Batches whose lists are complete, in order."""
        listed = [int(name.removeprefix("batch-")) for name in children(self.spark, f"{self.root}/lists")]
        return sorted(b for b in listed if self.holds(b))

    def holds(self, batch: int) -> bool:
        """Whether the batch has been merged."""
        return exists(self.spark, f"{self.root}/lists/batch-{batch}/_SUCCESS")

    def _places(self, batch: int | None = None) -> dict[int, list[int]]:
        """The batches whose folders hold each bucket, as of a batch; bounded by the number of buckets and ``PARTS``."""
        batches = self._batches()
        if not batches:
            return {}
        rows = self.spark.read.schema("bucket int, batch long").json(f"{self.root}/lists/batch-{batches[-1] if batch is None else batch}")
        places: dict[int, list[int]] = {}
        for r in sorted(rows.collect()):
            places.setdefault(r["bucket"], []).append(r["batch"])
        return places

    def _folder(self, bucket: int, batch: int) -> str:
        return f"{self.root}/rows/batch-{batch}/{BUCKET}={bucket}"

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets."""
        places = self._places()
        paths = [self._folder(b, n) for b in (sorted(places) if buckets is None else buckets) for n in places.get(b, ())]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def touched(self, rows: DataFrame, keys: Sequence[str] | None = None) -> list[int]:
        """Buckets that the keys of ``rows`` fall into."""
        found = rows.select(self._bucket(keys or self.keys).alias(BUCKET)).distinct().collect()
        return sorted(r[BUCKET] for r in found)

    def matching(self, rows: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
        """The buckets that may hold keys of ``rows``; other buckets are not read."""
        return self.read(self.touched(rows, keys))

    def write(self, rows: DataFrame, folder: str) -> DataFrame:
        """Rows by bucket in a folder, as :meth:`upsert` can take it over; every task writes its rows of each bucket."""
        named = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema])
        written = named.withColumn(BUCKET, self._bucket(self.keys)).write.mode("overwrite")
        written.partitionBy(BUCKET).option("compression", "zstd").parquet(folder)
        return self.spark.read.schema(self.schema).parquet(folder)

    def upsert(self, rows: DataFrame, batch: int, stored: str | None = None) -> None:
        """Merge the rows of a batch; batches are numbered upwards, a repeated one changes nothing.

        ``stored`` says that the rows come from stored ones and may be read
        twice. If the table has no merge, it is the folder that :meth:`write`
        put them into, which the table takes over.
        """
        if self.holds(batch):
            return
        if self._batches() and batch < self._batches()[-1]:
            raise ValueError(f"batch {batch} comes after batch {self._batches()[-1]}")
        staged, new = None, rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema])
        if stored is None:
            # The new rows are computed once, for the buckets that they touch and for the merge.
            staged = new_folder(self.spark, "upsert")
            new.write.parquet(staged)
            new = self.spark.read.schema(self.schema).parquet(staged)
        touched, places, target = self.touched(new), self._places(), f"{self.root}/rows/batch-{batch}"
        whole = {b for b in touched if self.merge or len(places.get(b, ())) >= PARTS}
        old = sorted(b for b in whole if b in places)
        # A failed attempt may have left files in the target.
        if touched and stored and not self.merge and not old:
            if exists(self.spark, target):
                remove(self.spark, target)
            move(self.spark, stored, target)
        elif touched:
            both = self.read(old).unionByName(new) if old else new
            self.write(self.merge(both) if self.merge else both, target)
        for b in touched:
            places[b] = [batch] if b in whole else [*places.get(b, ()), batch]
        pairs = [(b, n) for b in sorted(places) for n in places[b]]
        listed = self.spark.createDataFrame(pairs, "bucket int, batch long")
        listed.coalesce(1).write.mode("overwrite").json(f"{self.root}/lists/batch-{batch}")
        if staged:
            remove(self.spark, staged)
        self._clear()

    def _clear(self) -> None:
        """Remove buckets that neither the last list nor the one before names; a reader may be on the latter."""
        batches = self._batches()
        if len(batches) < 3:
            return
        kept = {(b, place) for batch in batches[-2:] for b, found in self._places(batch).items() for place in found}
        for bucket, found in self._places(batches[-3]).items():
            for place in found:
                if (bucket, place) not in kept:
                    remove(self.spark, self._folder(bucket, place))
        remove(self.spark, f"{self.root}/lists/batch-{batches[-3]}")
