import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Nulls in every column, empty and blank texts, repeated rows and ids, ties, odd characters.
ODD = [
    (1, "one two three four five six seven", "en", "a", 33),
    (1, "one two three four five six seven", "en", "a", 33),
    (1, "another text under the same id", "en", "a", 30),
    (2, None, None, None, None),
    (3, "", "en", "b", 0),
    (4, " \t\n\r ", "fr", "b", 5),
    (None, "a row without an id but with some words in it", "en", None, 1),
    (None, None, None, None, None),
    (5, "Ünïcode ꜰ 汉字 🙂 ẞ     x", "de", "", 20),
    (6, "\n".join(["This line is long enough to be counted here and there."] * 3), "en", "c", 100),
    (-7, "one two three four five six seven", "en", "c", 33),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def wide(odd):
    """The odd rows with columns named as the operators name theirs."""
    from pyspark.sql import functions as F

    names = "size start fp node k1 k2 h1 h2 slot shard kept n_words blob found ids bytes words bits chars line pos key drops".split()
    return odd.select("*", *[F.lit(7).alias(n) for n in names])


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}
