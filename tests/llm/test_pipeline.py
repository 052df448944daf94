import re

import compare
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lotwise.llm import decontaminate, packing, quality, queries, secret_scan, simhash


@pytest.fixture(scope="module")
def con(small):
    return compare.duck(small)


@pytest.mark.parametrize("name", sorted(queries.all_oracles()))
def test_same_rows_as_sql(spark, small, con, name):
    columns, oracle_columns, rows, oracle_rows = compare.compare(spark, con, name, small)
    assert columns == oracle_columns
    assert rows == oracle_rows


def test_queries_name_every_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.all_queries())
    assert numbers == list(range(1, 14))


def test_near_dedup_broadcasts_no_cells(spark, small, documents, monkeypatch):
    found = []
    monkeypatch.setattr(simhash, "links", lambda *args, links=simhash.links: found.append(links(*args)) or found[-1])
    docs = documents(*[(n, f"words of text {n} that no other text has {n * n}") for n in range(300)])
    kept = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, docs, small)
    assert 0 < kept.count() <= 300 and len(found) == 1
    found[0].collect()
    plan = found[0]._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_stages_take_effect(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    weights = quality.fit(docs, spark.read.parquet(f"{small}/labels.parquet").where(~quality.is_held_out()))
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    windows = decontaminate.tables(items)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "best_fit_packing"]
    rows = lambda frame: {r.doc_id: r for r in frame.collect()}

    good = stages["quality_classifier"](spark, docs, small)
    before, after = rows(docs), rows(good)
    assert good.columns == columns
    scores = dict(zip(before, quality.scores([r.text for r in before.values()], weights), strict=True))
    assert set(after) == {i for i, s in scores.items() if s >= quality.THRESHOLD} and len(after) < len(before)

    single = stages["simhash_near_dedup"](spark, good, small)
    near = simhash.near_duplicates(good).collect()
    assert single.columns == columns and set(rows(single)) == {r.component_id for r in near}

    clean = stages["benchmark_decontamination"](spark, single, small)
    bad = set()
    for i, r in rows(single).items():
        n, ranges, _ = decontaminate.search(r.text, windows)
        hit = sum(e - b for b, e in ranges)
        if hit and 20 * hit >= n:
            bad.add(i)
    assert clean.columns == columns and set(rows(clean)) == set(rows(single)) - bad and bad

    safe = stages["secret_scans"](spark, clean, small)
    assert safe.columns == columns and safe.schema == docs.schema
    raw = rows(clean)
    for i, r in rows(safe).items():
        assert r.text == secret_scan.redacted(raw[i].text, "[secret]") and r.n_chars == len(r.text)

    packed = stages["best_fit_packing"](spark, safe, small)
    assert {r.doc_id for r in packed.collect()} == set(rows(safe))


def test_run_is_the_stages_one_after_the_other(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
    assert sorted(map(tuple, docs.collect()), key=str) == sorted(map(tuple, corpus_pipeline.run(spark, small).collect()), key=str)


def test_stages_take_odd_tables(spark, small, documents):
    docs = documents((1, None), (1, None), (None, "some text"), (2, ""), (3, "word " * 50_000))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for frame in (docs, docs.limit(0)):
            kept = stage(spark, frame, small)
            assert kept.columns == frame.columns, name
            kept.collect()
    assert packing.pack_texts(docs.withColumn("piece", F.lit(1))).where("bin_id is not null").count() > 0
