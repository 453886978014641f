import datetime as dt

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators.exact import money_sum, ratio, total
from tidemark.operators.keyed import one_per_key, top_per_key
from tidemark.operators.nearest import top_k_documents
from tidemark.operators.points import points_json
from tidemark.operators.profile import null_profile
from tidemark.operators.scoring import score_prompts


def test_one_per_key_is_the_same_for_any_partitioning(spark):
    rows = [("k", i % 7, f"v{i}") for i in range(500)] + [("j", 1, "x")]
    df = spark.createDataFrame(rows, "k string, n int, v string")
    picks = {
        tuple(sorted(map(tuple, one_per_key(df.repartition(p), ["k"], [F.desc("n")]).collect()))) for p in (1, 3, 8)
    }
    assert len(picks) == 1
    (pick,) = picks
    assert [r[0] for r in pick] == ["j", "k"] and pick[1][1] == 6


def test_one_per_key_picks_one_row_whatever_columns_are_used(spark):
    rows = [("k", f"a{i}", f"b{i}") for i in range(50)]
    df = spark.createDataFrame(rows, "k string, a string, b string")
    a = one_per_key(df, ["k"]).select("a").first().a
    b = one_per_key(df, ["k"]).select("b").first().b
    assert a[1:] == b[1:]


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = top_per_key(df, ["k"], [F.asc("id")], 2)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize(
    ("top", "bottom", "digits", "want"),
    [("10.01", 2, 2, 5.01), ("-5", 2, 0, -3.0), ("1", 3, 4, 0.3333), ("1", 0, 2, None), (None, 2, 2, None)],
)
def test_ratio_rounds_half_away_from_zero(spark, top, bottom, digits, want):
    df = spark.range(1).select(ratio(F.lit(top).cast("decimal(18,2)"), F.lit(bottom), digits).alias("x"))
    assert df.first().x == want


def brute_force(questions, documents, k, digits):
    out = set()
    for qid, q in questions:
        scored = sorted((-round(float(np.dot(q, d)), digits), did) for did, d in documents)[:k]
        out |= {(qid, did, r + 1) for r, (_, did) in enumerate(scored)}
    return out


@pytest.mark.parametrize("block", [1, 3, 100])
@pytest.mark.parametrize("k", [1, 4, 60])
def test_nearest_equals_brute_force(spark, block, k):
    rng = np.random.default_rng(5)
    # Few distinct values, so that many scores tie.
    docs = [(i, [float(x) for x in rng.integers(-1, 2, 6)]) for i in range(40)]
    questions = [(100 + i, [float(x) for x in rng.integers(-1, 2, 6)]) for i in range(7)]
    d = spark.createDataFrame(docs, "doc_id long, vector array<float>").repartition(5)
    q = spark.createDataFrame(questions, "question_id int, vector array<float>")
    found = top_k_documents(q, d, k, 6, questions_per_block=block)
    got = {(r.question_id, r.doc_id, r["rank"]) for r in found.collect()}
    assert got == brute_force(questions, docs, k, 6)


def test_nearest_without_questions_or_documents(spark):
    q = spark.createDataFrame([(1, [1.0])], "question_id int, vector array<float>")
    d = spark.createDataFrame([("a", [1.0])], "doc_id string, vector array<float>")
    assert top_k_documents(q.limit(0), d, 2).count() == 0
    assert top_k_documents(q, d.limit(0), 2).count() == 0


def test_nearest_ranks_alike_for_any_block(spark):
    rng = np.random.default_rng(3)
    d = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=16)]) for i in range(200)] * 1, "doc_id long, vector array<float>")
    d = d.union(d.selectExpr("doc_id + 1000", "vector"))  # every score ties
    q = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=16)]) for i in range(9)], "question_id int, vector array<float>")
    ranks = [sorted(map(str, top_k_documents(q, d.repartition(n), 6, questions_per_block=b).collect())) for n, b in ((1, 9), (4, 2))]
    assert ranks[0] == ranks[1]


REPLIES = [
    ('[{"type":"reasoning","text":"no"},{"type":"text","text":" yes "}]', "yes"),
    ('[{"type":"text","text":"  "},{"type":"text","text":"second"}]', "second"),
    ('["x", {"type":"text","text":"mixed"}]', "mixed"),
    ('  [{"type":"text","text":"led"}]', "led"),
    ('[{"type":"other"}]', '[{"type":"other"}]'),
    ('{"type":"text","text":"object"}', '{"type":"text","text":"object"}'),
    ("a\n b\t c ", "a b c"),
    ("[not json", "[not json"),
    ("", ""),
    (None, ""),
]


def test_reply_text(spark):
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(REPLIES)], "i int, reply string")
    got = {r.i: r.t for r in df.select("i", text.reply_text(F.col("reply")).alias("t")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(REPLIES)}


def test_render_prints_nulls_as_empty_text(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert df.select(text.render("a={a}, b={b}!", {n: F.col(n) for n in "ab"})).first()[0] == "a=1, b=!"


def test_scoring_retries_and_falls_back(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def model(prompt):
        tried = log / prompt
        first = not tried.exists()
        tried.write_text("x" if first else tried.read_text() + "x")
        if prompt == "flaky" and first:
            raise RuntimeError("busy")
        return {"flaky": "fine", "blank": "  ", "list": '[{"type":"text","text":"in list"}]'}.get(prompt)

    df = spark.createDataFrame([("flaky",), ("blank",), ("list",), ("none",)], "p string").coalesce(1)
    out = score_prompts(df, "p", "answer", F.concat(F.lit("default "), "p"), model)
    assert {r.p: r.answer for r in out.collect()} == {
        "flaky": "fine", "blank": "default blank", "list": "in list", "none": "default none"}
    assert (log / "none").read_text() == "xx" and (log / "list").read_text() == "x"
    assert out.columns == ["p", "answer"]


def test_batch_scoring_sends_the_prompt_alone(spark):
    df = spark.createDataFrame([("a", 1), ("fail", 2), ("b", 3)], "p string, other int").coalesce(1)

    def model(prompts):
        return [None if p == "fail" else p * 2 for p in prompts]

    out = score_prompts(df, "p", "answer", F.lit("none"), batch_model=model, status="state")
    assert sorted((r.other, r.answer, r.state) for r in out.collect()) == [(1, "aa", "answered"), (2, "none", "failed"), (3, "bb", "answered")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    call = next(line for line in plan.splitlines() if "ArrowEvalPython" in line and "replies" in line)
    assert "other" not in call.split("replies(")[1].split(")")[0]


def test_scoring_without_model_starts_no_python(spark):
    df = spark.createDataFrame([("a",)], "p string")
    out = score_prompts(df, "p", "answer", F.lit("default"))
    assert out.first().answer == "default"


@settings(max_examples=8, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), max_size=30), st.integers(0, 2))
def test_points_keep_every_row(spark, names, digits):
    import json

    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, v int")
    pages = points_json(df, {"name": F.col("name"), "v": F.col("v")}, F.col("name"), digits).collect()
    points = [(p["name"], int(p["v"])) for row in pages for p in json.loads(row.points_json)]
    assert sorted(points) == sorted((n, i) for i, n in enumerate(names))
    assert all(len(row.page) == digits for row in pages)


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None, dt.date(2020, 1, 1)), (None, None, None)], "a int, b string, c date")
    got = {(r.column_name, r.row_count, r.null_count) for r in null_profile(df, "t").collect()}
    assert got == {("a", 2, 1), ("b", 2, 2), ("c", 2, 1)}
    assert null_profile(df, "t", max_columns=1).count() == 1
    wide = spark.range(3).select(*[F.lit(None).cast("int").alias(f"c{i}") for i in range(30)])
    assert null_profile(wide, "t").count() == 30


def test_money_sums_are_exact_and_skip_nan(spark):
    df = spark.createDataFrame([(0.1,)] * 1000 + [(float("nan"),), (None,), (-0.3,)], "x double").repartition(7)
    assert str(df.agg(money_sum(F.col("x"))).first()[0]) == "99.70"
    assert spark.createDataFrame([], "x double").agg(money_sum(F.col("x"))).first()[0] is None


def test_money_sum_beyond_its_range_raises(spark):
    df = spark.createDataFrame([(9e22,)] * 2, "x double")
    with pytest.raises(Exception, match="out of range"):
        df.agg(money_sum(F.col("x"))).collect()


def test_parts_below_a_cent_count(spark):
    df = spark.createDataFrame([(41.9136,), (6.8714,), *[(0.0044,)] * 3], "x double").repartition(3)
    row = df.agg(money_sum(F.col("x")), ratio(total(F.col("x")), F.count("x"), 4)).first()
    assert str(row[0]) == "48.80" and row[1] == 9.7596
