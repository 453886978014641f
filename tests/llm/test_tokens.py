"""Token counts, packing and token files against the tokenizers library."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.orc as orc
import pytest
from fixtures import no_docs, odd_docs
from tokenizers import Tokenizer

from tidemark.llm import packing, token_counts, token_files
from tidemark.llm.encoding import encoder, tokenizer_path
from tidemark.sources.scratch import new_folder


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def true_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


ODD = [
    "", " ", "  ", " a", "a ", "a  b", "a \n b", "\n", "x<|endoftext|> y <|endoftext|>", "\0a b\0 c", "\0 a", "a \0b",
    "don't we.\nAre, <|endoftext|>b", "ŉé.,", "a.\n\nb", "ab.\ncd,e", "é  x", "\x1c a", "can't stop  ", "tab\t x",
    " " * 50 + "z", None, "a's don't'll", "x*** y_z!_", "a.b c,\n!x", "ab--\nc'd", "日本 語 12 3.5", "x" * 500,
]


@pytest.mark.parametrize("texts", [ODD, ODD[::-1], [None], [" "], []])
def test_encoder_equals_library(library, texts):
    offsets, ids = encoder(tokenizer_path()).encode_all(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [true_ids(library, t) for t in texts]
    assert encoder(tokenizer_path()).encode_all(pa.array(texts, pa.string()), counts_only=True)[0].tolist() == offsets.tolist()


def test_counts_come_from_the_cache(spark, library, monkeypatch):
    docs, cache = odd_docs(spark), new_folder(spark, "test-cache")
    rows = token_counts.count_tokens(docs, tokenizer_path(), cache).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.n_tokens == len(true_ids(library, r.text))
        assert r.n_bytes == len((r.text or "").encode())
    stored = spark.read.parquet(cache).where("n_tokens IS NOT NULL")
    assert stored.count() == docs.selectExpr("coalesce(text, '')").distinct().count()
    again = token_counts.count_tokens(docs, tokenizer_path(), cache)
    assert sorted(map(str, again.collect())) == sorted(map(str, rows))
    assert spark.read.parquet(cache).count() == stored.count()
    assert token_counts.count_tokens(no_docs(spark), tokenizer_path(), cache).count() == 0


@pytest.mark.parametrize("windows", [1, 3, 16])
def test_packing_keeps_every_id_once(spark, library, windows):
    docs = odd_docs(spark).repartition(3)
    pieces = packing.pack(docs, tokenizer_path(), length=256, windows=windows).collect()
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
    lengths = []
    for group in sequences.values():
        at = 0
        for p in sorted(group, key=lambda p: p.offset):
            assert p.offset == at
            at += len(p.ids) // 4
        lengths.append(at)
    assert max(lengths) <= 256
    assert sum(n < 256 for n in lengths) <= 1
    found = sorted((str(p.doc_id), p.start, np.frombuffer(p.ids, "<u4").tolist()) for p in pieces)
    wanted = defaultdict(list)
    for r in docs.collect():
        wanted[str(r.doc_id)] += [*true_ids(library, r.text), 1]
    got = defaultdict(int)
    for doc, _, ids in found:
        got[doc] += len(ids)
    assert dict(got) == {k: len(v) for k, v in wanted.items()}
    for doc in ("1", "4", "5", "8", "9"):  # ids that one row has
        assert sum([ids for d, _, ids in found if d == doc], []) == wanted[doc]
    assert packing.pack(no_docs(spark), tokenizer_path()).count() == 0


def test_token_files_round_trip(spark, library, tmp_path):
    docs, folder = odd_docs(spark), f"{tmp_path}/files"
    token_files.write_token_files(docs, tokenizer_path(), folder, parts=3)
    rows = token_files.token_file_digests(spark, folder).collect()
    wanted = sorted(
        ((r.doc_id is not None, r.doc_id or 0, [*true_ids(library, r.text), 0]) for r in docs.collect()),
        key=lambda x: x[:2],
    )
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.start)] == [w[1] if w[0] else None for w in wanted]
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    sums = sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in rows)
    assert sums == sorted((str(w[1] if w[0] else None), len(w[2]), zlib.crc32(np.array(w[2], "<u4").tobytes())) for w in wanted)
    assert token_files.read_token_files(spark, folder).where("doc_id = 4").count() == 1
    files = sorted(tmp_path.glob("files/*.orc"))
    ids = [i for f in files for i in orc.ORCFile(str(f)).read().column("doc_id").to_pylist()]
    assert ids == [w[1] if w[0] else None for w in wanted]
    token_files.write_token_files(no_docs(spark), tokenizer_path(), f"{tmp_path}/none", parts=2)
    assert token_files.token_file_digests(spark, f"{tmp_path}/none").count() == 0
