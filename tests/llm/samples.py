"""Sample documents, and fixtures to import by name."""

import random

import pytest
from pyspark.sql import functions as F

from tripledger.staging import Staging

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def word(k):
    """A word of letters for every number."""
    return "".join("etaoinsrhl"[int(c)] for c in str(k + 10)) + "d"


def prose(rng, size, vocabulary=400):
    return " ".join(word(int(rng.paretovariate(0.7)) % vocabulary) for _ in range(size))


def sample(seed=3, rows=120):
    """Documents with nulls, empty and long texts, exact and near copies, ties and repeats."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randrange(1, 60)) for _ in range(rows)]
    for k in range(0, rows, 9):
        texts[k] = texts[0]
    for k in range(1, rows, 11):
        words = texts[1].split()
        words[k % len(words)] = word(k)
        texts[k] = " ".join(words)
    texts[3:9] = ["", None, " \t\n ", "One", prose(rng, 6000), "é" * 50 + " ÀB cD"]
    rows = [(k, t, rng.choice(["en", "de"]), rng.choice(["a", "b", "c", None]), len(t or "")) for k, t in enumerate(texts)]
    return rows + [rows[0], rows[2], rows[2], (None, texts[0], "en", None, 1), (None, "alone", None, "a", 5)]


@pytest.fixture
def staging(spark):
    with Staging(spark) as staging:
        yield staging


@pytest.fixture(scope="session")
def rows():
    return sample()


@pytest.fixture
def docs(spark, rows):
    """The sample, over several partitions, with extra columns whose names the operators use."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for name in ("keep_id", "fp", "root", "copies", "target", "text_key", "shard", "key", "_id", "_text", "grams",
                 "ll", "prior", "posterior", "confidence", "language", "kept", "row", "id", "_key", "_copies", "_without_id",
                 "host", "declared", "tie", "rank", "score", "_tie", "document", "runs", "words", "period"):
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.fixture
def none(docs):
    return docs.limit(0)
