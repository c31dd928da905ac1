import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from corpus import TEXTS  # noqa: E402


@pytest.fixture
def edge_docs(spark):
    """Nulls, empty and long texts, repeated ids and rows, and columns named like those made inside."""
    rows = [(i, t, None if i in (3, 6) else f"src{(i or 0) % 3}", "x") for i, t in TEXTS]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, row string")
    clashing = ("piece", "part", "kept", "size", "key", "block", "copies", "n", "score", "ids", "text_key", "spans", "target")
    for name in clashing:
        docs = docs.withColumn(name, F.lit("mine"))
    return docs


@pytest.fixture
def no_docs(edge_docs):
    return edge_docs.limit(0)
