import pyarrow.parquet as pq
import pytest

from tests.conftest import SF_DIR


@pytest.fixture(scope="session")
def documents():
    """The documents of the small test tables as a list of dicts."""
    return pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()


@pytest.fixture
def odd(spark):
    """Rows with nulls in any column, empty, very long and repeated texts, and clashing extra columns."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [
        (1, "same words here again and again", "en", "a", 31, "x", 5),
        (1, "same words here again and again", "en", "a", 31, "x", 5),
        (2, "same words here again and again", "en", None, 31, None, None),
        (3, "", None, "b", 0, "y", 1), (4, None, "en", "b", None, None, 2), (None, "a text without an id", "en", "a", 20, "", 3),
        (None, None, None, None, None, None, None), (5, long, "en", "a", len(long), "z", 7), (6, long + " end", "en", "c", len(long) + 4, "z", 7),
    ]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, n bigint"
    )


@pytest.fixture
def no_rows(odd):
    return odd.limit(0)
