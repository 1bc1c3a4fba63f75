import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, digest string, word string, cluster int, count int, `from` string"


def table(spark, texts, langs=None, sources=None):
    """Documents with columns whose names clash with those inside the operators; texts: (doc_id, text) pairs."""
    rows = [(i, t, (langs or {}).get(i, "en"), (sources or {}).get(i, "a"), None, "x", "y", 1, 2, "z") for i, t in texts]
    return spark.createDataFrame(rows, COLUMNS)


LONG = " ".join(f"w{i % 977}q{i % 31}" for i in range(20_000))
EDGES = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One"), (6, "the same text with a few words"), (7, "the same text with a few words"),
    (7, "the same text with a few words"), (8, "the same text  with a few words\n"), (None, "the same text with a few words"), (None, None),
    (9, LONG), (10, LONG + " end"), (11, "?!"), (12, "é ñ ß 日本語   x"),
]


@pytest.fixture(scope="session")
def edges(spark):
    return table(spark, EDGES, langs={4: None, 12: None}, sources={5: None})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def make(spark):
    return lambda texts, **more: table(spark, texts, **more)


def rows(df):
    """Collected rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=str)
