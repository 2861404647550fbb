import pytest

#: What every operator must stand: nulls, empty and blank texts, copies, ties, repeated rows, long texts, clashing names.
TEXTS = [
    (1, "The cat sat on the mat.\nThe cat sat on the mat.\nA line of its own"),
    (2, "the CAT sat on the mat.\nsomething else entirely"),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "The cat sat on the mat.\nThe cat sat on the mat.\nA line of its own"),
    (6, "The cat sat on the mat.\nThe cat sat on the mat.\nA line of its own"),
    (None, "something else entirely"),
    (7, "ß É 你好 мир 😀 " * 40),
    (8, "word " * 30000),
    (9, "x" * 70000),
    (10, "short"),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, key string, fp string, part int, length int, head boolean, digest string"


def rows_of(texts):
    return [(i, t, "en", "s", len(t or ""), "k", "f", 1, 2, True, "d") for i, t in texts]


@pytest.fixture(scope="session")
def odd(spark):
    """Two partitions of odd rows with columns that operators might use themselves."""
    return spark.createDataFrame(rows_of(TEXTS), COLUMNS).repartition(2).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
