"""Standardising expressions used by the silver plans.

Raw columns arrive as text. Every cast is a ``try_`` form, because ANSI mode
raises on dirty text and one bad row must not stop a job.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Date layouts accepted for orders and returns.
ISO_MINUTE = "yyyy-MM-dd HH:mm"
ISO_STAMP = "yyyy-MM-dd[ HH:mm[:ss]]"
US_STAMP = "MM/dd/yyyy[ HH:mm[:ss]]"
ISO_DAY_SHAPE = r"^\d{4}-\d{2}-\d{2}$"
US_DAY_SHAPE = r"^\d{2}-\d{2}-\d{4}$"


def present(df: DataFrame, name: str) -> str | None:
    """The frame's own spelling of ``name``, matched without case, or None."""
    wanted = name.lower()
    return next((c for c in df.columns if c.lower() == wanted), None)


def pick_column(df: DataFrame, names: Iterable[str], default: Column | None = None) -> Column | None:
    """First of ``names`` that the frame has; the choice is made while planning."""
    have = set(df.columns)
    for name in names:
        if name in have:
            return F.col(f"`{name}`")
    return default


def merge_variants(df: DataFrame, names: Sequence[str]) -> Column:
    """First non-NULL of several spellings of one field, as text. Absent spellings are skipped."""
    found = [F.col(f"`{c}`").cast("string") for c in (present(df, n) for n in names) if c]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def map_values(
    value: Column,
    targets: Mapping[str, Sequence[str]],
    ignore_case: bool = False,
    keep_unknown: bool = False,
) -> Column:
    """Replace each listed spelling by its target; others stay or become NULL."""
    probe = F.lower(value) if ignore_case else value
    out = None
    for target, spellings in targets.items():
        hit = probe.isin(*spellings)
        out = F.when(hit, target) if out is None else out.when(hit, target)
    return out.otherwise(value if keep_unknown else F.lit(None).cast("string"))


def swap_when(condition: Column, left: Column, right: Column) -> tuple[Column, Column]:
    """Exchange two columns on the rows where ``condition`` is true."""
    return (
        F.when(condition, right).otherwise(left),
        F.when(condition, left).otherwise(right),
    )


def parse_timestamp(value: Column) -> Column:
    """ISO or US date text, with or without a time. One parse per row; other text gives NULL."""
    return F.when(value.contains("/"), F.try_to_timestamp(value, F.lit(US_STAMP))).otherwise(
        F.try_to_timestamp(value, F.lit(ISO_STAMP))
    )


def parse_day(value: Column) -> Column:
    """Date text told apart by its shape: year first, or month first with dashes."""
    iso = F.try_to_timestamp(value, F.lit("yyyy-MM-dd")).cast("date")
    us = F.try_to_timestamp(value, F.lit("MM-dd-yyyy")).cast("date")
    return F.when(value.rlike(ISO_DAY_SHAPE), iso).when(value.rlike(US_DAY_SHAPE), us)


def reformat_stamp(value: Column, layout: str = ISO_MINUTE) -> Column:
    """Any text Spark reads as a timestamp, written back in one layout."""
    return F.date_format(F.try_to_timestamp(value), layout)


def null_if(value: Column, *sentinels: str) -> Column:
    return F.when(~value.isin(*sentinels), value)


def money(value: Column) -> Column:
    """``$12.50`` to 12.5; text that is no number gives NULL."""
    return F.replace(value.cast("string"), F.lit("$"), F.lit("")).try_cast("double")


def strip_marks(value: Column, marks: str = "?") -> Column:
    """Drop noise characters, then outer blanks."""
    return F.trim(F.translate(value, marks, ""))


def percent(value: Column) -> Column:
    """``40%`` to 40.0 and ``0.2`` to 20.0."""
    number = F.replace(value, F.lit("%"), F.lit("")).try_cast("double")
    return F.when(value.contains("%"), number).otherwise(value.try_cast("double") * F.lit(100.0))


def text_or(value: Column, default: str, *sentinels: str) -> Column:
    """``default`` for NULL and for the sentinel texts."""
    return F.coalesce(null_if(value, *sentinels), F.lit(default))


def int_or(value: Column, default: int) -> Column:
    """``default`` unless the text is a whole number."""
    return F.coalesce(value.try_cast("int"), F.lit(default))


def double_or(value: Column, default: float) -> Column:
    return F.coalesce(value.try_cast("double"), F.lit(default))


def recover(value: Column, rescued: Column, key: str) -> Column:
    """The column, or the same field from the rescued JSON text."""
    return F.coalesce(value, F.get_json_object(rescued, f"$.{key}"))


def plain_digits(value: Column) -> Column:
    """``6.40E+11`` to ``640000000000``."""
    return value.try_cast("decimal(20,0)").cast("string")


def split_list(value: Column, separator: str = ",") -> Column:
    """Text to an array; NULL to an empty array."""
    empty = F.array().cast("array<string>")
    return F.coalesce(F.split(value, _literal_pattern(separator)), empty)


def path_level(value: Column, level: int, separator: str = ">") -> Column:
    """Part ``level`` of a separated path, trimmed; NULL where the path is shorter."""
    return F.trim(F.get(F.split(value, _literal_pattern(separator)), F.lit(level)))


def _literal_pattern(text: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()*+-?^$|" else c for c in text)


def with_missing(df: DataFrame, wanted: Mapping[str, str]) -> DataFrame:
    """Add a typed NULL for every wanted column the frame lacks."""
    extra = {n: F.lit(None).cast(t) for n, t in wanted.items() if present(df, n) is None}
    return df.withColumns(extra) if extra else df


def public_lineage(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename lineage columns, keeping the others in place."""
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def is_true(flag: Column) -> Column:
    """NULL counts as false."""
    return F.coalesce(flag, F.lit(False))


def day_key(day: Column) -> Column:
    """yyyyMMdd as an int, without formatting text."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")
