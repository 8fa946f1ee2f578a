import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quarry.session import get_spark

    s = get_spark(master="local[*]", app="quarry-tests", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def docs(spark):
    from pyspark.sql import functions as F

    rows = [
        (1, "The cat", "the quick brown fox jumps over the lazy dog", "en", "b1", 3, "2024-01-01 00:00:00"),
        (2, "Of the sea", "songs of the sea and of the wind", "en", "b1", 5, "2024-01-02 00:00:00"),
        (3, "Dogs", "a dog and a cat play in the yard", "en", "b2", 3, "2024-01-03 12:00:00"),
        (4, "Пример", "Привет мир, ПРИВЕТ снова", "ru", "b2", 7, "2024-01-05 00:00:00"),
        (5, "Empty", "", "en", "b3", 5, "2024-01-06 00:00:00"),
        (6, "Fox news", "fox fox fox the end", "en", "b3", None, "2024-01-06 23:00:00"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, title string, body string, lang string, source string, "
                                     "author_id long, created_on string")
    return df.withColumn("created_on", F.to_timestamp("created_on"))


@pytest.fixture(scope="session")
def idx(docs):
    from quarry.operators.index import build_index

    return build_index("t", docs, ("title", "body"), "doc_id",
                       attrs=["lang", "source", "author_id", "created_on"])


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
