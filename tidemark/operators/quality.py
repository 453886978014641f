"""Named data-quality rules: clean rows, quarantined rows, and both from one scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

NullPolicy = Literal["fail", "ignore"]

REASON = "error_reason"
STAMP = "quarantine_ts"
VERDICT = "verdict"


def _broken(rule: str, nulls: NullPolicy) -> Column:
    """True where the rule does not hold. A NULL outcome counts as broken under ``fail``."""
    held = F.expr(rule)
    return ~F.coalesce(held, F.lit(False)) if nulls == "fail" else ~held


def broken_rules(rules: Mapping[str, str], nulls: NullPolicy = "fail") -> Column:
    """Names of all broken rules, joined by commas; empty text when none."""
    return F.concat_ws(",", *[F.when(_broken(r, nulls), F.lit(n)) for n, r in rules.items()])


def keep_valid(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Rows that pass every rule. NULL does not pass."""
    return df.filter(" AND ".join(f"({r})" for r in rules.values()))


def quarantine(
    df: DataFrame, rules: Mapping[str, str], nulls: NullPolicy = "fail", stamp: bool = True
) -> DataFrame:
    """Rows that break a rule, with the names of the rules they break.

    Under ``fail`` the clean and quarantined rows make up the input and do not
    overlap. Under ``ignore`` a rule that evaluates to NULL is not reported.
    """
    out = df.withColumn(REASON, broken_rules(rules, nulls)).filter(F.col(REASON) != "")
    return out.withColumn(STAMP, F.current_timestamp()) if stamp else out


def quarantine_first(
    df: DataFrame, checks: Sequence[tuple[str, str]], nulls: NullPolicy = "fail"
) -> DataFrame:
    """Rows that break a check, with only the first broken check named."""
    return df.withColumn(REASON, first_broken(checks, nulls)).filter(F.col(REASON).isNotNull())


def first_broken(checks: Sequence[tuple[str, str]], nulls: NullPolicy = "fail") -> Column:
    """Name of the first broken check; NULL when none."""
    return F.coalesce(*[F.when(_broken(rule, nulls), F.lit(name)) for name, rule in checks])


def split_by_rules(
    df: DataFrame, rules: Mapping[str, str], first: Sequence[tuple[str, str]] = ()
) -> DataFrame:
    """All rows with ``verdict``, and with ``error_reason`` and its time where quarantined.

    Written with ``partitionBy("verdict")`` this gives the clean and the
    quarantine table from one scan of the input. ``first`` holds checks of
    which only the first broken one is named, in place of all broken rules.
    """
    reason = first_broken(first) if first else F.nullif(broken_rules(rules), F.lit(""))
    bad = F.col(REASON).isNotNull()
    return df.withColumn(REASON, reason).withColumns(
        {
            STAMP: F.when(bad, F.current_timestamp()),
            VERDICT: F.when(bad, "quarantine").otherwise("clean"),
        }
    )


def clean_rows(split: DataFrame) -> DataFrame:
    return split.filter(F.col(VERDICT) == "clean").drop(VERDICT, REASON, STAMP)


def quarantined_rows(split: DataFrame) -> DataFrame:
    return split.filter(F.col(VERDICT) == "quarantine").drop(VERDICT)


# --- counts from the same pass ----------------------------------------------------

COUNTS = "rule_counts"
ALL_ROWS = "rows"


def counted_rules(
    df: DataFrame, rules: Mapping[str, str], into: Observation | str = COUNTS, nulls: NullPolicy = "fail"
) -> DataFrame:
    """``df`` as it is; whatever reads it also counts its rows and, for each rule, those that break it.

    A batch job gives an ``Observation`` and asks it once the job is done. A
    stream gives a name, and :func:`stream_counts` adds up its batches.
    """
    broken = [F.count_if(_broken(rule, nulls)).alias(name) for name, rule in rules.items()]
    return df.observe(into, F.count(F.lit(1)).alias(ALL_ROWS), *broken)


def stream_counts(query: StreamingQuery, name: str = COUNTS) -> dict[str, int]:
    """Counts over all batches of a run that :func:`counted_rules` watched; batches without rows have none."""
    total: dict[str, int] = {}
    for progress in query.recentProgress:
        metrics = progress.observedMetrics.get(name)
        for key, n in (metrics.asDict() if metrics is not None else {}).items():
            total[key] = total.get(key, 0) + n
    return total
