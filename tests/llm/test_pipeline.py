"""The pipeline's stages, and its run, against a plain version of each."""

import re

import corpus_pipeline
import numpy as np
import pytest
from test_mixing import size, targets
from test_pii import plain as plain_spans
from test_quality_rules import plain as plain_counts
from test_simhash import plain_fingerprint, plain_groups
from tokenizers import Tokenizer

from tidemark.llm.encoding import tokenizer_path
from tidemark.llm.frames import table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = table(spark, FOLDER, "documents")
    seen = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, seen[-1], FOLDER).write.parquet(path)
        seen.append(spark.read.parquet(path))
    return [d.collect() for d in seen]


def test_quality_keeps_labelled_good_and_drops_bad(spark, stages):
    before, after = stages[0], {r.doc_id for r in stages[1]}
    labels = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    for r in before:
        words, _, symbols, _, repeated = plain_counts(r.text)
        if words < 50 or 100 * repeated > 50 * words:
            assert r.doc_id not in after
        elif labels.get(r.doc_id) == 1 or (r.doc_id not in labels and symbols == 0):
            assert r.doc_id in after


def test_one_document_of_each_group_stays(stages):
    before, after = stages[1], stages[2]
    roots = plain_groups({plain_fingerprint(r.text) for r in before})
    least = {}
    for r in before:
        root = roots[plain_fingerprint(r.text)]
        least[root] = min(least.get(root, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(least.values())


def test_personal_data_is_gone(stages):
    before, after = {r.doc_id: r for r in stages[2]}, {r.doc_id: r for r in stages[3]}
    assert before.keys() == after.keys()
    for k, r in after.items():
        assert plain_spans(r.text) == []
        assert r.n_chars == len(r.text)
        if not plain_spans(before[k].text):
            assert r.text == before[k].text or re.search("<(IBAN|SSN|LOCAL_PHONE)>", r.text)


def test_sources_are_mixed(stages):
    before, after = stages[3], stages[4]
    sizes, taken, largest, times = {}, {}, {}, {}
    for r in before:
        sizes[r.source] = sizes.get(r.source, 0) + size(r.text)
        largest[r.source] = max(largest.get(r.source, 0), size(r.text))
    for r in after:
        taken[r.source] = taken.get(r.source, 0) + size(r.text)
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert max(times.values()) <= 2
    for source, target in targets(sizes).items():
        assert abs(taken.get(source, 0) - target) <= largest[source] / 2 + 1


def test_sequences_hold_every_id(stages):
    library = Tokenizer.from_file(tokenizer_path())
    wanted = sorted(tuple([*library.encode(r.text, add_special_tokens=False).ids, 1]) for r in stages[4])
    lengths, total = {}, 0
    for p in stages[5]:
        lengths[p.sequence_id] = lengths.get(p.sequence_id, 0) + len(p.ids) // 4
        total += len(p.ids) // 4
    assert total == sum(map(len, wanted)) and max(lengths.values()) <= 2048
    assert sum(n < 2048 for n in lengths.values()) <= 1
    ids = np.concatenate([np.frombuffer(p.ids, "<u4") for p in stages[5]])
    assert (np.bincount(ids, minlength=50_257) == np.bincount(np.concatenate([np.array(w) for w in wanted]), minlength=50_257)).all()


def test_run_equals_the_stages(spark, stages):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert sum(len(r.ids) for r in rows) == sum(len(r.ids) for r in stages[5])
