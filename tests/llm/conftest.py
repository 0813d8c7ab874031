import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from edges import edge_rows  # noqa: E402


@pytest.fixture
def edge_docs(spark):
    """The edge rows with columns whose names operators use themselves."""
    schema = "doc_id long, text string"
    names = ["ids", "decoded", "gone", "n_lines", "fp", "row", "group", "body", "data", "spans", "score", "n"]
    frame = spark.createDataFrame(edge_rows(), schema)
    return frame.withColumns({n: F.lit(None).cast("string") for n in names})


@pytest.fixture
def no_docs(edge_docs):
    return edge_docs.limit(0)
