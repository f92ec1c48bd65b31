import random

import pytest
from pyspark.sql import SparkSession

WORDS = "the of and rain river stone light winter paper garden small quiet field road letter window morning silver".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(("", "", "s", "ed", ",", ".")) for _ in range(n))


@pytest.fixture
def rng():
    return random.Random(7)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, texts: dict, extra: bool = False):
    """A documents table; with ``extra`` columns whose names clash with those the operators use inside."""
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in (texts.items() if isinstance(texts, dict) else texts)]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        for name in ("fp", "row", "line", "line_no", "words", "first", "score", "ids", "n_words", "label", "pick", "part", "key", "t"):
            df = df.selectExpr("*", f"'x' as {name}")
    return df
