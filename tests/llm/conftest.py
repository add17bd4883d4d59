import pytest
from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
#: Rows that every document operator must take: null id, text and source, empty, white space, repeated rows, long words.
EDGE = [
    (1, "Alpha beta  gamma\tdelta.\nAlpha beta  gamma\tdelta.\n \nalpha", "en", "a"),
    (1, "Alpha beta  gamma\tdelta.\nAlpha beta  gamma\tdelta.\n \nalpha", "en", "a"),
    (2, "", "en", "a"),
    (3, None, "en", None),
    (4, " \n\t\r\x0b\x0c ", None, "b"),
    (5, "x" * 70_000, "en", "b"),
    (6, "été ▁ naïve　wide nbsp 日本語🎉 \x00 nul", "fr", "b"),
    (None, "one two three four five six", "en", None),
    (8, "w " * 3000, "en", "a"),
]


@pytest.fixture(scope="session")
def edge(spark) -> DataFrame:
    """The edge rows with a column whose names clash with results."""
    rows = [(i, t, la, s, len(t or ""), -1, "clash") for i, t, la, s in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_words int, kept string").repartition(3)


@pytest.fixture(scope="session")
def documents(spark: SparkSession) -> DataFrame:
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def empty(edge) -> DataFrame:
    return edge.limit(0)


def texts(df: DataFrame) -> list[tuple]:
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def key(row) -> tuple:
    return tuple((x is None, str(x)) for x in row)


def same(got: DataFrame, want: list[tuple]) -> None:
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
