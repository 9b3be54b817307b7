import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cases import SF, odd_texts  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with odd texts, ids out of order, a repeated id, a null id, and further columns of clashing names."""
    rows = [(i * 7 % 41 if i != 3 else None, t, ["en", None, "de"][i % 3], "src", None, f"k{i}", i, "x") for i, t in enumerate(odd_texts())]
    rows += [rows[5], rows[24], (rows[30][0], "another text with a known id", None, None, 1, None, 0, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string, input long, body string").repartition(3).cache()


@pytest.fixture(scope="session")
def odd_rows(odd):
    return [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def document_rows(documents):
    return [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
