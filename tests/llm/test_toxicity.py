import zlib

import numpy as np
import pytest

from tarmac.llm import toxicity

LABELLED = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{LABELLED}/{t}.parquet") for t in ("documents", "labels")]


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.learned(*tables)


def test_held_out_accuracy(spark, tables, model):
    documents, labels = tables
    rows = toxicity.assessed(documents, model).join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    right = np.mean([r.predicted == r.toxic for r in rows])
    common = np.mean([r.toxic == 0 for r in rows])
    assert right > 0.97 > common


def test_offending_sentences_explain_the_score(tables, model):
    for r in toxicity.assessed(tables[0], model).where("size(offending) > 0").limit(200).collect():
        assert r.score >= max(s.score for s in r.offending) >= 0.5 and r.predicted == 1


def test_same_model_again(tables, model):
    again = toxicity.learned(*tables)
    assert np.array_equal(again.weights, model.weights) and again.bias == model.bias


def test_noisy_or(model):
    known = toxicity._Weights(model.weights)
    bad, _ = toxicity.scored("stupid idiot", known, model.bias)
    both, places = toxicity.scored("The and. Stupid idiot! Of the", known, model.bias)
    assert 0.5 < bad <= both <= 1 and [(p["start"], p["end"]) for p in places] == [(8, 21)]
    assert toxicity.scored("", known, model.bias) == (0.0, []) == toxicity.scored("... 12 !", known, model.bias)


def test_rows_of_any_kind(spark, model):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (2, "", 1), (None, "stupid " * 100_000, 0)], "doc_id bigint, text string, toxic int")
    rows = toxicity.assessed(docs, model).collect()
    assert sorted((r.doc_id or 0, r.predicted, r.held_out) for r in rows)[0] == (0, 1, False)
    assert sum(r.score == 0.0 for r in rows) == 3
    assert toxicity.assessed(docs.where("false"), model).count() == 0
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, toxic int")
    assert toxicity.assessed(docs, toxicity.learned(docs, labels)).count() == 4
