import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use themselves.
CLASHES = ["kept", "n_removed", "quality_score", "toxic_score", "text_", "own_", "th_", "fp", "th", "rng", "rn", "size", "w", "h", "grp", "salt", "told_", "key_"]
LONG = "word " * 30_000 + "end. Of it"


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    base = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen. Fifteen\nsixteen"
    return [(1, base, "en", "a", 10), (1, base, "en", "a", 10), (2, base, None, None, None), (3, None, "en", "a", None), (4, "", "en", "a", 0),
            (5, " \t\n ", "en", "b", 4), (6, LONG, "en", "b", len(LONG)), (7, "a", "xx", "b", 1), (None, base + " more", "en", "b", 1),
            (None, None, None, None, None), (8, "É x\x1cy ß <|endoftext|> 日本 [INST] </s> \\", "fr", "c", 3), (8, "other text of the same id", "fr", "c", 3),
            (9, base.upper(), "en", "c", 2)]


@pytest.fixture(scope="session")
def edge(spark):
    df = spark.createDataFrame(edge_rows(), DOCS)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def read(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
