"""Each repair on the dirty values it exists for."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as c
from tidemark.plans import entities as e

STAMP = dt.datetime

CASES = [
    # repair, input, expected
    (lambda v: c.map_values(v, e.SEGMENTS, ignore_case=True), "cons", "Consumer"),
    (lambda v: c.map_values(v, e.SEGMENTS, ignore_case=True), "cosumer", "Consumer"),
    (lambda v: c.map_values(v, e.SEGMENTS, ignore_case=True), "CONSUMER", "Consumer"),
    (lambda v: c.map_values(v, e.SEGMENTS, ignore_case=True), "corp", "Corporate"),
    (lambda v: c.map_values(v, e.SEGMENTS, ignore_case=True), "ho", "Home Office"),
    (lambda v: c.map_values(v, e.SEGMENTS, ignore_case=True), "xyz", None),
    (lambda v: c.map_values(v, e.REGIONS), "E", "East"),
    (lambda v: c.map_values(v, e.REGIONS), "Central", "Central"),
    (lambda v: c.map_values(v, e.REGIONS), "e", None),
    (lambda v: c.map_values(v, e.SHIP_MODES, keep_unknown=True), "1st Class", "First Class"),
    (lambda v: c.map_values(v, e.SHIP_MODES, keep_unknown=True), "Std Class", "Standard Class"),
    (lambda v: c.map_values(v, e.SHIP_MODES, keep_unknown=True), "Same Day", "Same Day"),
    (lambda v: c.map_values(v, e.SHIP_MODES, keep_unknown=True), "Drone", "Drone"),
    (lambda v: c.map_values(v, e.SHIP_MODES, keep_unknown=True), None, None),
    (lambda v: c.map_values(v, e.RETURN_STATUSES, keep_unknown=True), "APPRVD", "Approved"),
    (lambda v: c.map_values(v, e.RETURN_STATUSES, keep_unknown=True), "PENDG", "Pending"),
    (c.parse_timestamp, "2018-01-02 10:30", STAMP(2018, 1, 2, 10, 30)),
    (c.parse_timestamp, "01/02/2018 10:30", STAMP(2018, 1, 2, 10, 30)),
    (c.parse_timestamp, "2018-01-02 10:30:05", STAMP(2018, 1, 2, 10, 30, 5)),
    (c.parse_timestamp, "01/02/2018", STAMP(2018, 1, 2)),
    (c.parse_timestamp, "2018-01-02", STAMP(2018, 1, 2)),
    (c.parse_timestamp, "abc", None),
    (c.parse_timestamp, "13/45/2018", None),
    (c.parse_timestamp, None, None),
    (c.parse_day, "2018-01-05", dt.date(2018, 1, 5)),
    (c.parse_day, "01-05-2018", dt.date(2018, 1, 5)),
    (c.parse_day, "31-12-2018", None),
    (c.parse_day, "5 Jan", None),
    (c.money, "$12.50", 12.5),
    (c.money, "4.5", 4.5),
    (c.money, "abc", None),
    (c.money, "$$1$2$", 12.0),
    (c.money, "", None),
    (c.percent, "40%", 40.0),
    (c.percent, "0.2", 20.0),
    (c.percent, None, None),
    (c.percent, "abc", None),
    (c.percent, "4%0%", 40.0),
    (lambda v: c.text_or(v, "credit_card", "?"), None, "credit_card"),
    (lambda v: c.text_or(v, "credit_card", "?"), "?", "credit_card"),
    (lambda v: c.text_or(v, "credit_card", "?"), "cash", "cash"),
    (lambda v: c.int_or(v, 0), "3", 3),
    (lambda v: c.int_or(v, 0), "x", 0),
    (lambda v: c.int_or(v, 0), None, 0),
    (lambda v: c.double_or(v, 0.0), None, 0.0),
    (c.strip_marks, "?Damaged? ", "Damaged"),
    (c.strip_marks, "?", ""),
    (c.plain_digits, "6.40E+11", "640000000000"),
    (c.plain_digits, "12345", "12345"),
    (c.plain_digits, "abc", None),
    (c.split_list, "A,B", ["A", "B"]),
    (c.split_list, None, []),
    (lambda v: c.path_level(v, 0), "X > Y > Z", "X"),
    (lambda v: c.path_level(v, 1), "X > Y > Z", "Y"),
    (lambda v: c.path_level(v, 1), "X", None),
    (lambda v: c.path_level(v, 1, "|"), "X|Y", "Y"),
    (c.reformat_stamp, "2015-11-09", "2015-11-09 00:00"),
    (c.reformat_stamp, "bad", None),
    (lambda v: c.null_if(v, "NULL"), "NULL", None),
    (lambda v: c.null_if(v, "NULL"), "a", "a"),
    (lambda v: c.recover(F.lit(None).cast("string"), v, "Order_id"), '{"Order_id":"7"}', "7"),
    (lambda v: c.recover(F.lit("5"), v, "Order_id"), '{"Order_id":"7"}', "5"),
]


def test_repairs(spark):
    names = [f"v{i}" for i in range(len(CASES))]
    raw = spark.range(1).select(*[F.lit(v).cast("string").alias(n) for n, (_, v, _) in zip(names, CASES, strict=True)])
    row = raw.select(*[f(F.col(n)).alias(n) for n, (f, _, _) in zip(names, CASES, strict=True)]).first()
    wrong = [(v, got, want) for (_, v, want), got in zip(CASES, row, strict=True) if got != want]
    assert not wrong


def test_day_key(spark):
    assert spark.sql("SELECT DATE'2018-01-05' d").select(c.day_key(F.col("d"))).first()[0] == 20180105


def test_variants_skip_absent_columns_and_ignore_case(spark):
    df = spark.createDataFrame([(None, "b"), ("a", "c")], "Customer_ID string, cust_id string")
    found = df.select(c.merge_variants(df, ["customer_id", "nowhere", "cust_id"]).alias("x"))
    assert [r.x for r in found.collect()] == ["b", "a"]
    none = df.select(c.merge_variants(df, ["nowhere"]).alias("x"))
    assert none.dtypes == [("x", "string")]


def test_swap_only_where_told(spark):
    df = spark.createDataFrame([("4", "s", "c"), ("1", "c", "s"), (None, "c", "s")], "r string, city string, state string")
    city, state = c.swap_when(F.col("r") == "4", F.col("city"), F.col("state"))
    assert {tuple(r) for r in df.select(city, state).collect()} == {("c", "s")}


def test_missing_columns_and_first_existing(spark):
    df = spark.createDataFrame([("x",)], "b string")
    assert c.with_missing(df, {"B": "string", "t": "timestamp"}).dtypes == [("b", "string"), ("t", "timestamp")]
    assert df.select(c.pick_column(df, ["a", "b"])).first()[0] == "x"
    assert c.pick_column(df, ["a"]) is None
    assert df.select(c.pick_column(df, ["a"], F.lit(1))).first()[0] == 1


@pytest.mark.parametrize(("flag", "kept"), [(True, True), (False, False), (None, False)])
def test_null_flag_is_false(spark, flag, kept):
    df = spark.createDataFrame([(flag,)], "f boolean")
    assert df.select(c.is_true(F.col("f"))).first()[0] is kept
