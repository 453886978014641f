"""Registered queries: a Spark callable and the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.workload.inputs import Tables

Build = Callable[[Tables], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Build], Build]:
    """Register a function of the driver's tables under its own name."""

    def register(build: Build) -> Build:
        QUERIES[name or build.__name__] = Query(build, sql)
        return build

    return register


def runnable(build: Build) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: build(Tables(spark, folder))
