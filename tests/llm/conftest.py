from __future__ import annotations

import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """Python workers find the package, and checkpoints have a folder, as a cluster's settings would see to."""
    spark.sparkContext.environment["PYTHONPATH"] = ROOT
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


@pytest.fixture(scope="session")
def documents(spark):
    """(doc_id, text) rows as a table of documents, with extra columns whose names the operators use themselves."""

    def make(*rows):
        full = [(i, t, "en", "src", len(t or ""), 1, 2, 3, "x") for i, t in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, digest int, bits int, rows int, _digest string"
        )

    return make


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("given tables not there")
    return SMALL
