import random

import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def texts():
    """Nulls, blanks, odd characters, ties, copies and one long text."""
    rng = random.Random(3)
    words = "the of And wh ere ing ñandú été über 12 word, end. a b c".split()

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    base = [prose(rng.randint(1, 90)) for _ in range(40)]
    odd = [None, "", " ", "\n\t ", "\x0b\x0c", "a", "a\x1fb", " nbsp em", "İSTANBUL ǅ", "\U0001F600 你好",
           "x" * 5000, "dup dup dup dup dup dup", prose(6_000)]
    return [*base, *odd, *base[:10], base[0], base[0]]


@pytest.fixture(scope="session")
def documents(spark, texts):
    """Documents with a null id, a repeated row, a repeated id and columns of clashing names."""
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id at all"), (3, texts[3]), (4, "another text of one id")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    return frame.withColumns({c: F.lit(c) for c in (
        "score", "keep", "posterior", "fingerprint", "component_id", "n_tokens", "token_ids", "lang_pred", "n_words", "spans",
        "items", "h", "at", "did", "th", "anchor", "a", "b", "v", "key", "licence")})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")
