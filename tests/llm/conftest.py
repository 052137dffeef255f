import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from tests.conftest import SF_CHECK  # noqa: E402, F401

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with everything that a table may hold: null and empty texts, blanks,
    no letters, repeated rows, a repeated and a null key, null languages, one very
    long text, and columns whose names clash with the operators' own."""
    long_text = " ".join(f"word{i % 977} and" for i in range(60_000))
    rows = [
        (1, "A short English text about the weather, and the sea.", "en", "a", 1),
        (2, None, "en", "a", 2), (3, "", "en", None, 3), (4, " \t\n ", None, "b", 4), (5, "12345 !!! 678", "en", "b", 5),
        (6, "A short English text about the weather, and the sea.", "en", "a", 6),
        (7, "Ein kurzer deutscher Text über das Wetter und die See.", "de", "a", 7),
        (7, "Ein kurzer deutscher Text über das Wetter und die See.", "de", "a", 7),
        (7, "quite another text with the same number as the one before it", None, "a", 7),
        (None, "a text without a number, written by jo.doe@mail.example.com", "en", "a", 9),
        (None, "a text without a number, written by jo.doe@mail.example.com", "en", "a", 9),
        (None, None, None, None, None),
        (20, long_text, "en", "c", len(long_text)), (40, long_text, "en", "c", len(long_text)),
        (41, "x" * 70_000, None, "c", 70_000), (42, "日本語のテキスト 🙂 ça", None, "c", 5),
        (-2**62 - 5, "low", "de", "d", 3), (2**53 + 1, "odd and large", "de", "d", 3), (2**53 + 3, "odd and larger", "de", "d", 3),
        (2**62 + 5, "quite high up", "de", "d", 3),
    ]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    clash = ["score", "class", "rep", "block", "row", "kind", "part", "component_id", "kept", "n_tokens", "length", "key",
             "draw", "quality", "sequence_id", "_row", "_moved", "_new", "guest", "tie", "id", "own", "copy", "node", "first",
             "body", "h1", "doc", "no_doc", "at", "least", "k"]
    return docs.selectExpr("*", *(f"'clash' as `{c}`" for c in clash))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
