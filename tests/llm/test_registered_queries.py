"""Every registered query of the operators over the smallest tables: columns, types and whole results."""

import re
import zlib
from pathlib import Path

import compare
import pytest

import __spark_entry__ as entry_point
from tidemark.llm import collocations, queries, spelling

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")

# What the contract of each query names; more may follow.
COLUMNS = {
    "op1_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op2_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op3_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op4_embeddings": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op5_quality": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op6_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op7_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op8_language_model": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op9_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op10_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op11_spelling": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
    "op12_collocations": "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
    "op13_quality_model": "doc_id bigint, held_out boolean, score double, predicted int",
}
ONE_ROW_A_DOCUMENT = [n for n in COLUMNS if n not in ("op2_packing", "op4_embeddings", "op11_spelling", "op12_collocations")]


@pytest.fixture(scope="module")
def found(spark):
    return {}


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").collect()


def result(spark, found, name):
    if name not in found:
        df = queries.QUERIES[name](spark, FOLDER)
        found[name] = dict(df.dtypes), df.collect()
    return found[name]


def test_all_are_registered():
    assert set(COLUMNS) == set(queries.QUERIES) and set(COLUMNS) | {"pipeline"} <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, found, name):
    types, rows = result(spark, found, name)
    wanted = dict(c.split(" ") for c in COLUMNS[name].split(", "))
    assert {c: types.get(c) for c in wanted} == wanted
    if name != "op12_collocations":
        assert rows


@pytest.mark.parametrize("name", ONE_ROW_A_DOCUMENT)
def test_one_row_for_each_document(spark, found, documents, name):
    _, rows = result(spark, found, name)
    assert sorted(r.doc_id for r in rows) == sorted(d.doc_id for d in documents)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert compare.mismatch(queries.QUERIES[name](spark, FOLDER), compare.oracle(FOLDER), queries.SQL[name]) is None


def test_spelling_equals_the_plain_version(spark, found, documents):
    from test_spelling import plain_variants, rows_of  # noqa: F401

    _, rows = result(spark, found, "op11_spelling")
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows} == plain_variants([(d.doc_id, d.text) for d in documents])
    assert spelling.LEAST_COUNT == 3


def test_collocations_equal_the_plain_version(spark, found, documents):
    from test_collocations import plain_collocations

    _, rows = result(spark, found, "op12_collocations")
    plain = plain_collocations([(d.lang, d.text) for d in documents], collocations.LEAST, collocations.LONGEST, collocations.REPORT)
    assert sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in rows) == plain


def test_classifiers_hold_out_as_stated(spark, found):
    for name, parts, rest in (("op9_toxicity", 3, 1), ("op13_quality_model", 4, 2), ("op8_language_model", 10, 0)):
        for r in result(spark, found, name)[1]:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == rest)


def test_quality_statistics_equal_the_plain_ones(spark, found, documents):
    texts = {d.doc_id: d.text or "" for d in documents}
    for r in result(spark, found, "op5_quality")[1]:
        text = texts[r.doc_id]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        seen = {w for w in windows if windows.count(w) > 1} if len(windows) < 400 else {w for w, n in __import__("collections").Counter(windows).items() if n > 1}
        covered = {k + j for k, w in enumerate(windows) if w in seen for j in range(3)}
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (len(words), sum(map(len, words)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words)) and not (r.base_failed and r.kept)


def test_pipeline_returns_pieces(spark):
    df = entry_point.queries()["pipeline"](spark, FOLDER)
    assert {"doc_id", "start", "ids", "sequence_id", "offset"} <= set(df.columns) and df.count() > 0
