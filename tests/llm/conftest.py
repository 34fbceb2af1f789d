import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_rows import SCHEMA, STRANGE  # noqa: E402


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def corpus(documents):
    """The test documents as a list of (id, text)."""
    return sorted((r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect())


@pytest.fixture(scope="session")
def strange(spark):
    """Nulls, empty and long texts, repeated rows and ids, odd characters; columns with clashing names."""
    rows = spark.createDataFrame([(i, t, "xx", "s", len(t or "")) for i, t in STRANGE], SCHEMA)
    for name in ("score", "n_words", "kept", "_row", "_block", "ids", "id", "digest", "offset", "start", "quality", "labels", "set", "a", "b"):
        rows = rows.withColumn(name, F.lit(f"own {name}"))
    return rows


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
