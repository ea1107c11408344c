import public_tokenizers
import pyarrow.parquet as pq
import pytest

from quarry.llm.common import documents
from quarry.sources.tables import read_table

SF001 = "/root/testdata/sf0.001"

DDL = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["node", "key", "score", "range", "id", "content", "words", "a", "b", "row", "word", "class_id", "_dedup0", "held_out", "sig"]


@pytest.fixture(scope="session")
def docs(spark):
    return documents(spark, SF001)


@pytest.fixture(scope="session")
def texts():
    t = pq.read_table(f"{SF001}/documents.parquet", columns=["doc_id", "text"]).sort_by("doc_id").to_pydict()
    return dict(zip(t["doc_id"], t["text"], strict=True))


@pytest.fixture(scope="session")
def labels(spark):
    return read_table(spark, SF001, "labels")


@pytest.fixture(scope="session")
def benchmark(spark):
    return read_table(spark, SF001, "benchmark")


@pytest.fixture(scope="session")
def bpe_path():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def piece_path():
    return public_tokenizers.path("piece_bpe_32k.model")


LONG = " ".join(f"word{i % 997} thing{i % 89}" for i in range(60_000))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows and clashing columns."""
    rows = [
        (None, None, None, None, None),
        (None, "some words of a row without id", "en", "s", 5),
        (1, "", "en", "s", 0),
        (1, "", "en", "s", 0),
        (2, None, "en", "s", 0),
        (3, LONG, "en", "s", len(LONG)),
        (4, LONG + " end", "en", "s", len(LONG) + 4),
        (5, "the same short text", "en", "s", 19),
        (6, "the same short text", "en", "s", 19),
        (6, "another text under the same id", "en", "s", 19),
        (6, "another text under the same id", "en", "s", 19),
        (7, " \t\n\x0b  ", "en", "s", 6),
        (8, 'token = "abcdef0123456789abcdef01" \U0001f600 é', None, None, None),
    ]
    df = spark.createDataFrame(rows, DDL)
    for c in CLASH:
        df = df.selectExpr("*", f"'x' as `{c}`")
    return df


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def odd_labels(spark):
    return spark.createDataFrame([(None, 1, 1), (3, None, None), (3, 1, 0), (3, 0, 1), (5, 1, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
