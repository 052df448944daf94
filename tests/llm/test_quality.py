import zlib

import numpy as np
from pyspark.sql import functions as F

from lotwise.llm import quality, queries


def _labels(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def test_held_out_rows_are_told_apart(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries.op3_quality(spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    judged = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert len(judged) > 50 and np.mean([a == b for a, b in judged]) >= 0.97


def test_scores_do_not_depend_on_neighbours_or_length():
    rng = np.random.default_rng(1)
    weights = rng.standard_normal((1 << quality.BUCKET_BITS) + 1).astype(np.float32)
    texts = ["One two two THREE!! 42", None, "", " ", "Éa b\nc", "x" * 10, "$$$ a%%%", "w w w w"] * 3
    alone = [quality.scores([t], weights)[0] for t in texts]
    assert np.allclose(quality.scores(texts, weights), alone, rtol=0, atol=1e-12)
    # A text longer than one piece gets the same score as its pieces' n-grams summed up, by the other way.
    long = "alpha beta BETA gamma!! " * 50_000
    assert len(long) > quality._PIECE
    short = "alpha beta BETA gamma!! " * 5_000
    assert len(short) < quality._PIECE
    assert abs(quality.scores([long], weights)[0] - quality.scores([short], weights)[0]) < 1e-3


def test_ftrl_step_matches_the_formula():
    own = quality.train(["good text"], np.array([1.0]), quality.Ftrl(0.5, 1.0, 0.0, 0.0), epochs=1)
    # One example with weight 0: gradient -0.5 for the intercept, so z = -0.5 and n = 0.25.
    assert abs(own[-1] - 0.5 / ((1 + 0.5) / 0.5)) < 1e-12


def test_rows_of_every_kind(spark, documents):
    good = [(i, f"plain words number {i} of a decent text about things") for i in range(40)]
    bad = [(i, "SPAM!! SPAM!! SPAM!! SPAM!! $$$ %%%") for i in range(40, 80)]
    docs = documents(*good, *bad, (1, good[1][1]), (None, "x"), (90, None), (91, ""))
    labels = _labels(spark, *[(i, int(i < 40), 0) for i in range(80)], (5, 1, 0), (6, None, 0), (7, 3, 0), (None, 1, 0))
    weights = quality.fit(docs, labels)
    assert np.array_equal(weights, quality.fit(docs.repartition(3), labels.repartition(2)))
    got = quality.with_scores(docs, weights, "rows", keep=["doc_id", "digest"]).collect()
    assert len(got) == 84
    by_id = {r.doc_id: r.rows for r in got}
    assert min(by_id[i] for i in range(40)) > 0.7 > 0.3 > max(by_id[i] for i in range(40, 80))
    assert by_id[90] == by_id[91]
    assert quality.with_scores(documents(), weights, "s").count() == 0
    kept = docs.where(quality.score_of(F.col("text"), weights) >= 0.7)
    assert kept.columns == docs.columns and kept.where("doc_id < 40").count() == 41


def test_without_labels_every_score_is_one_half(spark, documents):
    weights = quality.fit(documents((1, "a")), _labels(spark))
    assert list(quality.scores(["a b c", None], weights)) == [0.5, 0.5]
