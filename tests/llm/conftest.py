import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

LONG = " ".join(f"w{i % 997}x{i}" for i in range(60_000))


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, row string, id long, digest string, "
        "part int, `key` string, size long, node long, score double, words string, owner long"
    )
    more = ("r", 1, "d", 1, "k", 1, 1, 0.5, "w", 1)
    story = "the quick brown fox jumps over the lazy dog and runs far away from all the other animals today"
    texts = [
        (1, story), (2, story), (2, story), (3, None), (4, ""), (5, "one two"), (6, "   \t\n"), (7, LONG),
        (8, LONG + " end"), (9, story + " idiot"), (None, story), (None, None), (10, "é ü \U0001f600 x"),
        (11, "mail a.b@c.de, +1 (017) 555-7713, 10.0.0.1 and 4111 1111 1111 1111"), (3, "an other text"),
    ]
    rows = [(i, t, None if n % 3 == 0 else "en", None if n % 4 == 0 else f"s{n % 2}", None, *more) for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)
