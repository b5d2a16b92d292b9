import pytest

from wayfare.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


LONG = "wort " * 30_000
EDGE_TEXTS = [
    (1, "The cat sat on the mat. It was glad.\nThe dog did not care at all, it seems."),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, "one"),
    (6, "one two"),
    (7, LONG),
    (8, "The cat sat on the mat. It was glad.\nThe dog did not care at all, it seems."),
    (8, "The cat sat on the mat. It was glad.\nThe dog did not care at all, it seems."),
    (None, "A row without an id has some words too, and they are counted."),
    (9, "Ünïcödé 漢字 😀    x's don't 12 345"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """NULLs, empty and very long texts, repeated rows, and columns with clashing names."""
    rows = [
        (i, t, "en" if i and i % 2 else None, f"s{(i or 0) % 3}", 0, 1.0, "x", True, 7, "b")
        for i, t in EDGE_TEXTS
    ]
    names = "doc_id long, text string, lang string, source string, n_chars long, score double, "
    names += "block string, kept boolean, node int, position string"
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def tables(spark, sf_dir):
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
