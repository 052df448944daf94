"""Ids beyond 2^53 stay exact beside null ids, in every operator that takes them through Python workers."""

import numpy as np
import pytest

from lotwise.llm import backoff_lm, decontaminate, embedding_dedup, html_extract, packing, quality, secret_scan, simhash

BIG = (1 << 60) + 1
IDS = {BIG, BIG + 2, None}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(BIG, "a b c", 1), (None, "password=hunter2zz", None), (BIG + 2, None, BIG)]
    return spark.createDataFrame(rows, "doc_id long, text string, source long").coalesce(1)


def test_documents(spark, docs):
    items = spark.createDataFrame([("i", "a b c")], "item_id string, text string")
    results = [
        secret_scan.with_secrets(docs),
        simhash.near_duplicates(docs),
        simhash.one_of_each(docs),
        decontaminate.contamination(docs, items),
        decontaminate.clean(docs, items).unionByName(docs.where("text = 'a b c'")),
        quality.with_scores(docs, np.zeros((1 << quality.BUCKET_BITS) + 1), "score"),
        backoff_lm.scores(docs),
        packing.pack_texts(docs),
    ]
    for found in results:
        assert found.schema["doc_id"].dataType.simpleString() == "bigint"
        rows = found.collect()
        assert {r.doc_id for r in rows} == IDS and len(rows) == 3
    kept = secret_scan.with_secrets(docs).collect()
    assert {r.source for r in kept} == {1, None, BIG}


def test_pages(spark):
    pages = spark.createDataFrame([(BIG, "http://a/b", "<p>x</p>"), (None, None, None)], "page_id long, url string, html string")
    assert {(r.page_id, r.text) for r in html_extract.main_texts(pages.coalesce(1)).collect()} == {(BIG, "x"), (None, "")}


def test_vectors(spark):
    rows = [(BIG, 3, [1.0, 0.0]), (BIG + 1, 3, [1.0, 0.01]), (None, 3, [0.0, 1.0])]
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").coalesce(1))
    assert {(r.vec_id, r.n_links) for r in found.collect()} == {(BIG, 1), (BIG + 1, 1), (None, 0)}
