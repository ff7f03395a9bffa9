import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _text string, _id long, key int"


def rows_of(texts):
    """Documents with columns whose names clash with those that operators use inside."""
    return [(i, t, "en", "s", None, "x", 7, 1) for i, t in texts]


EDGE = [
    (0, None), (1, ""), (2, "   \n\t "), (3, "Hello World"), (4, "Hello World"), (4, "Hello World"), (5, "a"), (6, "été ÉTÉ naïve\n\n"), (7, "x" * 50_000),
    (8, "the mit license and the MIT License, Apache-License"), (9, "word " * 5000), (10, "<|endoftext|> <s> ▁▁ a  b   c "), (11, "\U0001f600 日本語 テキスト"), (None, "no id here"), (13, "GNU General Public License"),
]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(rows_of(EDGE), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def more_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
