import zlib

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """Rows with every awkward case: nulls, empty and long texts, repeated rows, clashing extra columns."""

    def make(texts, extra=True):
        rows = [(i, t, "en", "src0", len(t or ""), 1, "x") for i, t in enumerate(texts)]
        frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size int, ids string")
        return frame if extra else frame.drop("size", "ids")

    return make


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def crc(value) -> int:
    return zlib.crc32(str(value).encode())
