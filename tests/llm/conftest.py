"""Small tables for the operators of the training-data pipeline."""

import sys
from pathlib import Path

import pyarrow.parquet as pq
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def folder():
    if not DATA.exists():
        pytest.skip("no test data")
    return str(DATA)


@pytest.fixture(scope="session")
def documents(folder):
    rows = pq.read_table(f"{folder}/documents.parquet").to_pylist()
    return {row["doc_id"]: row["text"] for row in rows}


@pytest.fixture(scope="session")
def odd_rows(spark):
    """Null ids and texts, empty and repeated rows, an extra column."""
    text = "one two three four five six seven"
    return spark.createDataFrame(
        [(1, text, "x"), (1, text, "x"), (2, None, None), (None, "", "y"), (3, "", "z"), (None, text, None), (4, "é" * 3000, "w")],
        "doc_id bigint, text string, extra string",
    )
