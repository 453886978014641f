from tidemark.operators import quality
from tidemark.plans import entities as e

RULES = {"valid_id": "id IS NOT NULL", "valid_kind": "kind IN ('a', 'b')"}
ROWS = [(1, "a"), (2, "z"), (3, None), (None, "b"), (None, None)]


def frame(spark):
    return spark.createDataFrame(ROWS, "id int, kind string")


def test_clean_and_quarantine_make_up_the_input(spark):
    df = frame(spark)
    clean = quality.keep_valid(df, RULES).collect()
    bad = quality.quarantine(df, RULES)
    assert [tuple(r) for r in clean] == [(1, "a")]
    assert bad.columns[-1] == "quarantine_ts"
    reasons = {(r.id, r.kind): r.error_reason for r in bad.collect()}
    assert reasons == {
        (2, "z"): "valid_kind",
        (3, None): "valid_kind",
        (None, "b"): "valid_id",
        (None, None): "valid_id,valid_kind",
    }


def test_ignoring_nulls_gives_the_literal_predicate(spark):
    bad = quality.quarantine(frame(spark), RULES, nulls="ignore", stamp=False)
    assert {(r.id, r.kind, r.error_reason) for r in bad.collect()} == {
        (2, "z", "valid_kind"), (None, "b", "valid_id"), (None, None, "valid_id")}


def test_first_failure_only(spark):
    df = spark.createDataFrame(
        [(None, None, None), ("1", None, "East"), ("1", "Consumer", None), ("1", "Consumer", "East")],
        "customer_id string, segment string, region string")
    bad = quality.quarantine_first(df, e.CUSTOMERS.first_failure)
    assert sorted(r.error_reason for r in bad.collect()) == ["INVALID_REGION", "INVALID_SEGMENT", "NULL_CUSTOMER_ID"]
    literal = quality.quarantine_first(df, e.CUSTOMERS.first_failure, nulls="ignore")
    assert [r.error_reason for r in literal.collect()] == ["NULL_CUSTOMER_ID"]


def test_split_agrees_with_the_two_filters(spark):
    split = quality.split_by_rules(frame(spark), RULES)
    assert split.filter("verdict = 'clean'").count() == 1
    assert split.filter("verdict = 'quarantine' AND error_reason IS NOT NULL").count() == 4
    assert quality.clean_rows(split).columns == ["id", "kind"]
    bad = quality.quarantined_rows(split)
    assert bad.columns == ["id", "kind", "error_reason", "quarantine_ts"]
    assert bad.filter("quarantine_ts IS NULL").count() == 0
    first = quality.split_by_rules(frame(spark), RULES, [("NO_ID", RULES["valid_id"]), ("BAD_KIND", RULES["valid_kind"])])
    reasons = {(r.id, r.kind): r.error_reason for r in first.collect()}
    assert reasons[(None, None)] == "NO_ID" and reasons[(3, None)] == "BAD_KIND" and reasons[(1, "a")] is None


def test_rule_count():
    assert sum(len(x.rules) for x in e.ENTITIES.values()) == 23
