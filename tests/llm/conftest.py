from __future__ import annotations

import os

import pytest
from brute import ODD_TEXTS
from pyspark.sql import functions as F

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Texts at the edges, with columns whose names operators might use inside."""
    rows = [(i, t, "en", "s", None) for i, t in ODD_TEXTS]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return frame.withColumns({c: F.lit("clash") for c in ("_id", "_text", "node", "score", "items", "hits", "size", "part")})


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
