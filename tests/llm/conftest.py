import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lang licensed " * 20_000 + "under the MIT license token=abcdefghijklmnop"

# Nulls in every column, empty and blank texts, a very long one, ties and repeated rows.
EDGE_ROWS = [
    (1, "Released under the MIT License.  One two three four five.", "en", "a", 50),
    (2, "Released under the MIT License. One two\tthree four five.", "en", "a", 50),
    (2, "Released under the MIT License. One two\tthree four five.", "en", "a", 50),
    (3, None, "en", "b", 0),
    (4, "", None, "b", None),
    (5, " \t\n ", "de", None, 3),
    (None, "no id here, but a text", "en", None, 20),
    (None, "no id here, but a text", None, "c", 20),
    (6, LONG, "en", "c", len(LONG)),
    (6, "another text of the same id", "en", "c", 27),
    (7, "é ü 漢字 \U0001f600 password='Abcdefghijkl12' x", "fr", "é", 40),
]


# Names that the operators use themselves.
INTERNAL = ("size", "h", "entry", "kept", "fp", "score", "rid", "start", "bucket", "label", "positions",
            "sk", "k", "s", "sha", "doc", "l", "r", "m", "n", "o", "p", "w", "t", "x", "at", "count", "low",
            "component", "component_id", "none", "first", "gap", "cut", "cls", "item", "items", "rank",
            "value", "part", "term", "row", "col", "outside", "script", "__i", "__k", "__p", "__sha",
            "_K", "_b", "_tie", "sequence_id", "piece", "found", "new", "parts", "body", "kinds")


@pytest.fixture(scope="session")
def edge_docs(spark):
    """The edge cases, with extra columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F

    return spark.createDataFrame(EDGE_ROWS, DOCS).withColumns({c: F.lit(1) for c in INTERNAL})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return [(r.doc_id, r.text or "") for r in documents.select("doc_id", "text").collect()]
