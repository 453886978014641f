"""Stored answers of a text model: a prompt that has been answered is never asked again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import lookup_join
from tidemark.operators.scoring import ATTEMPTS, BatchModel, Model, score_prompts
from tidemark.sources.scratch import children, exists

SCHEMA = "run string, digest string, prompt string, reply string, status string"
_DIGEST = "__digest"


def digest(prompt: Column) -> Column:
    return F.sha2(prompt.cast("binary"), 256)


@dataclass
class ReplyStore:
    """Answers under ``root``, a folder for each run; only complete folders are read."""

    spark: SparkSession
    root: str

    def _complete(self) -> list[str]:
        folders = [f"{self.root}/{name}" for name in children(self.spark, self.root) if name.startswith("run-")]
        return [f for f in folders if exists(self.spark, f"{f}/_SUCCESS")]

    def read(self) -> DataFrame:
        """One row for each prompt asked in each run; a prompt has one answered row at most."""
        folders = self._complete()
        if not folders:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*folders)

    def answered(self) -> DataFrame:
        """``digest`` and ``reply`` of every answered prompt."""
        return self.read().where(F.col("reply").isNotNull()).select("digest", "reply")

    def ask(
        self,
        df: DataFrame,
        prompt: str,
        run: str,
        model: Model | None = None,
        batch_model: BatchModel | None = None,
        attempts: int = ATTEMPTS,
    ) -> None:
        """Ask for every different prompt of ``df`` that no run has answered, and store the answers under ``run``.

        A run that is complete stays as it is. One that broke off asks anew
        what it had not stored. Prompts without an answer are kept with their
        status and are open to the next run. A NULL prompt is not asked.
        """
        folder = f"{self.root}/run-{run}"
        if exists(self.spark, f"{folder}/_SUCCESS"):
            return
        wanted = df.select(F.col(prompt).alias("prompt")).where("prompt IS NOT NULL")
        wanted = wanted.select(digest(F.col("prompt")).alias("digest"), "prompt").dropDuplicates(["digest"])
        open_ = wanted.join(self.answered().select("digest"), "digest", "left_anti")
        none = F.lit(None).cast("string")
        asked = score_prompts(open_, "prompt", "reply", none, model, attempts, batch_model, "status")
        # Answers reach the store before anything else uses them, so a task lost later asks nobody.
        asked.select(F.lit(run).alias("run"), "digest", "prompt", "reply", "status").write.mode("overwrite").parquet(folder)

    def replies(self, df: DataFrame, prompt: str, output: str, fallback: Column) -> DataFrame:
        """``df`` with the stored answer to its prompt, or ``fallback``."""
        keyed = df.withColumn(_DIGEST, digest(F.col(prompt)))
        known = self.answered().withColumnRenamed("digest", _DIGEST)
        found = lookup_join(keyed, known, _DIGEST).select("e.*", F.col("o.reply").alias(output))
        return found.withColumn(output, F.coalesce(F.col(output), fallback)).drop(_DIGEST)
