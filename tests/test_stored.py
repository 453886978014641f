"""Stored replies, rule counts of the judging pass, JSON read once, search in passes and weighted terms."""

import json
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.functions import columns as c
from tidemark.operators import nearest, quality
from tidemark.operators.replies import ReplyStore
from tidemark.plans import entities as e
from tidemark.plans import term_search
from tidemark.sources import landing
from tidemark.streaming import silver

# --- replies ---------------------------------------------------------------------------


@pytest.fixture
def model(tmp_path):
    """A model that notes every prompt it is asked, in a file, as tasks run elsewhere."""
    log = str(tmp_path / "asked")

    def ask(prompt):
        with open(log, "a") as file:
            file.write(prompt + "\n")
        return None if prompt.startswith("mute") else f"re {prompt}"

    def asked():
        try:
            return Counter(open(log).read().split("\n")[:-1])
        except FileNotFoundError:
            return Counter()

    return ask, asked


def test_each_different_prompt_is_asked_once(spark, tmp_path, model):
    ask, asked = model
    store = ReplyStore(spark, str(tmp_path / "store"))
    df = spark.createDataFrame([(n, f"p{n % 5}") for n in range(100)] + [(200, None)], "n int, prompt string").repartition(6)
    store.ask(df, "prompt", "monday", ask)
    assert asked() == {f"p{n}": 1 for n in range(5)}
    found = store.replies(df, "prompt", "answer", F.lit("none"))
    assert found.columns == ["n", "prompt", "answer"] and found.count() == 101
    assert {(r.prompt, r.answer) for r in found.collect()} == {(f"p{n}", f"re p{n}") for n in range(5)} | {(None, "none")}
    # Reading asks nobody, nor does a repeated run, whatever it brings.
    store.ask(df.union(spark.createDataFrame([(1, "late")], df.schema)), "prompt", "monday", ask)
    assert asked() == {f"p{n}": 1 for n in range(5)}
    store.ask(df.union(spark.createDataFrame([(1, "late")], df.schema)), "prompt", "tuesday", ask)
    assert asked() == {f"p{n}": 1 for n in range(5)} | {"late": 1}
    assert store.read().count() == 6


def test_unanswered_prompts_stay_open_and_broken_runs_store_nothing(spark, tmp_path, model):
    ask, asked = model
    store = ReplyStore(spark, str(tmp_path / "store"))
    df = spark.createDataFrame([("mute 1",), ("p",)], "prompt string")
    store.ask(df, "prompt", "1", ask, attempts=2)
    assert asked() == {"mute 1": 2, "p": 1}
    assert {(r.prompt, r.status) for r in store.read().collect()} == {("mute 1", "failed"), ("p", "answered")}
    store.ask(df, "prompt", "2", ask, attempts=1)
    assert asked() == {"mute 1": 3, "p": 1}
    broken = df.withColumn("prompt", F.when(F.col("prompt") == "p", F.raise_error(F.lit("x")).cast("string")).otherwise("new"))
    with pytest.raises(Exception, match="x"):
        store.ask(broken, "prompt", "3", ask)
    assert store.read().where("prompt = 'new'").count() == 0
    store.ask(spark.createDataFrame([("new",)], "prompt string"), "prompt", "3", ask)
    assert store.read().where("prompt = 'new' AND run = '3'").count() == 1


# --- rules -------------------------------------------------------------------------------


def test_rules_are_counted_in_the_pass_that_judges(spark, tmp_path):
    rules = {"a_known": "a IS NOT NULL", "b_small": "b < 5"}
    rng = random.Random(1)
    rows = [(rng.choice([None, 1]), rng.choice([None, 1, 9])) for _ in range(500)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(5)
    for nulls, b_broken in (("fail", sum(b is None or b >= 5 for _, b in rows)), ("ignore", sum(b is not None and b >= 5 for _, b in rows))):
        seen = Observation()
        quality.counted_rules(df, rules, seen, nulls).write.parquet(str(tmp_path / nulls))
        assert seen.get == {"rows": 500, "a_known": sum(a is None for a, _ in rows), "b_small": b_broken}
        assert spark.read.parquet(str(tmp_path / nulls)).count() == 500


def test_a_stream_counts_over_all_its_batches(spark, tmp_path):
    schema = silver.bronze_schema(e.VENDORS)
    for n in range(3):
        rows = [{"vendor_id": f"v{i}" if i % 3 else None, "vendor_name": "x" if i % 4 else None} for i in range(n * 10, n * 10 + 10)]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{tmp_path}/in")
        run = silver.refine(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/cp", e.VENDORS)
        run.awaitTermination()
        assert quality.stream_counts(run) == {
            "rows": 10, "valid_vendor_id": sum(i % 3 == 0 for i in range(n * 10, n * 10 + 10)),
            "valid_vendor_name": sum(i % 4 == 0 for i in range(n * 10, n * 10 + 10))}
    assert spark.read.parquet(f"{tmp_path}/out").count() == 30


# --- JSON ----------------------------------------------------------------------------------


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def read(spark, *paths):
    return landing.read_json(spark, list(paths), e.RETURNS)


def test_json_of_mixed_types_and_spellings(spark, tmp_path):
    a = put(tmp_path / "Region 2" / "returns_1.json", '﻿[{"OrderId": "o1", "amount": 1.50, "x": {"k": [1e3, true, null]}},\n {"orderid": 7, "amount": "$2", "x": "t"},'
            ' {"ORDERID": null, "amount": 6.40E+11, "x": [1]}, null]')
    b = put(tmp_path / "returns_2.json", '{"order_id": "say \\"1, 2\\" \\\\", "return_reason": "a: -3, [4] true"}')
    rows = read(spark, a, b)
    assert rows.columns[:-3] == ["OrderId", "amount", "order_id", "return_reason", "x"]
    found = {(r.OrderId, r.order_id, r.amount, r.x, r.return_reason, r._region) for r in rows.collect()}
    assert found == {
        ("o1", None, "1.50", '{"k":["1e3","true",null]}', None, "2"), ("7", None, "$2", "t", None, "2"), (None, None, "6.40E+11", '["1"]', None, "2"),
        (None, 'say "1, 2" \\', None, None, "a: -3, [4] true", "global")}
    assert c.merge_variants(rows, ["OrderId", "order_id"]) is not None


def test_json_without_rows_and_broken_json(spark, tmp_path):
    empty = [put(tmp_path / f"returns_{n}.json", text) for n, text in enumerate(["[]", "[\n]\n", "", "  \n"])]
    assert read(spark, *empty) is None
    broken = put(tmp_path / "returns_9.json", '[{"a": tru')
    (row,) = read(spark, empty[0], broken).collect()
    assert row[landing.CORRUPT] == '[{"a": tru'


def test_json_files_are_read_once(spark, tmp_path):
    path = put(tmp_path / "returns_1.json", json.dumps([{"a": n, "b": str(n)} for n in range(1000)]))
    rows = landing.read_json(spark, [path], e.RETURNS, str(tmp_path / "scratch"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan.lower().split("format: ")[1][:12] and "scratch" in "".join(rows.inputFiles())
    assert sorted(int(r.a) for r in rows.collect()) == list(range(1000))
    long = put(tmp_path / "returns_2.json", json.dumps([{"a": "\\\"" * 50_000 + "1" * 1_000_000}]))
    assert len(read(spark, long).first().a) == 1_100_000


# --- search ------------------------------------------------------------------------------------


def test_search_in_passes_reads_documents_once_a_pass(spark):
    rng = np.random.default_rng(4)
    questions = [(f"q{n}", rng.normal(size=8).tolist()) for n in range(23)]
    documents = [(n, rng.normal(size=8).tolist()) for n in range(200)]
    q = spark.createDataFrame(questions, "question_id string, vector array<double>")
    d = spark.createDataFrame(documents, "doc_id int, vector array<double>").repartition(3)
    whole = nearest.top_k_documents(q, d, 4)
    parts = nearest.top_k_documents(q, d, 4, questions_per_block=3, blocks_per_pass=2)
    rows = lambda df: sorted((r.question_id, r.rank, r.doc_id, r.score) for r in df.collect())
    assert rows(whole) == rows(parts) and len(rows(whole)) == 92
    m = np.round(np.array([v for _, v in questions]) @ np.array([v for _, v in documents]).T, nearest.DIGITS)
    for k, (name, _) in enumerate(questions):
        best = sorted(range(200), key=lambda n: (-m[k, n], n))[:4]
        assert [r[2] for r in rows(whole) if r[0] == name] == best
    # The documents are not part of what is left to run.
    assert "MapInPandas" not in parts._jdf.queryExecution().executedPlan().toString()
    assert nearest.top_k_documents(q.limit(0), d).count() == 0


def plain_weights(texts):
    counts = {k: Counter(w for w in re.split(r"[^\w]+", t.lower()) if w) for k, t in texts.items()}
    df = Counter(w for own in counts.values() for w in own)
    idf = {w: math.log(len(texts) / n) for w, n in df.items() if n < len(texts)}
    out = {}
    for k, own in counts.items():
        raw = {w: (1 + math.log(n)) * idf[w] for w, n in own.items() if w in idf}
        length = math.sqrt(sum(x * x for x in raw.values()))
        out |= {(k, w): round(x / length, 9) for w, x in raw.items()}
    return out


def test_weights_and_search_by_terms(spark):
    rng = random.Random(3)
    words = "alpha Beta gamma, delta; region EAST west vendor Ünder 12 the".split()
    texts = {f"d{n:02}": "the " + " ".join(rng.choice(words) for _ in range(rng.randrange(1, 30))) for n in range(40)} | {"empty": "the"}
    docs = spark.createDataFrame([(k, t) for k, t in texts.items()], "doc_id string, doc_text string").repartition(3)
    weights, idf = term_search.document_weights(docs, "doc_id", "doc_text")
    found = {(r.doc_id, r.term): float(r.weight) for r in weights.collect()}
    plain = plain_weights(texts)
    assert found.keys() == plain.keys() and all(abs(found[k] - v) < 2e-9 for k, v in plain.items())
    asked = spark.createDataFrame([(1, "Which vendor, in the WEST region?"), (2, "nothing known")], "question_id int, question string")
    rows = term_search.retrieve_by_terms(asked, docs, weights, idf, 3).collect()
    assert {r.question_id for r in rows} == {1} and sorted(r.rank for r in rows) == [1, 2, 3]
    own = {"vendor", "west", "region"}
    size = math.sqrt(sum(r.idf**2 for r in idf.where(F.col("term").isin(*own)).collect()))
    weigh = {r.term: r.idf / size for r in idf.collect() if r.term in own}
    scores = Counter()
    for (k, w), x in plain.items():
        scores[k] += x * weigh.get(w, 0)
    best = sorted(scores.items(), key=lambda s: (-round(s[1], 8), s[0]))[:3]
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.rank)] == [k for k, _ in best]


def test_a_region_question_finds_that_region_first(spark):
    regions = ["East", "West", "South", "North", "Central"]
    docs = spark.createDataFrame(
        [(f"p{n}", f"Product intelligence profile. Product name: thing {n}. Region context: {regions[n % 5]}. Slow mover flag: {'true' if n % 2 else 'false'}.") for n in range(100)],
        "doc_id string, doc_text string")
    weights, idf = term_search.document_weights(docs, "doc_id", "doc_text")
    asked = spark.createDataFrame(list(enumerate(f"Which products are slow movers in the {r} region?" for r in regions)), "question_id int, question string")
    rows = term_search.retrieve_by_terms(asked, docs, weights, idf, 5).collect()
    assert len(rows) == 25
    for r in rows:
        assert int(r.doc_id[1:]) % 5 == r.question_id
