import pytest

#: Names that the operators use inside.
CLASHING = "doc fp term pos bucket place key size item tokens text_hash part digest start rank clean own url_ a b u v m __id __hash __n __x __lang __doc"

LONG = "lorem ipsum dolor sit amet " * 20_000


@pytest.fixture(scope="session")
def odd_rows():
    return [
        (1, "The quick brown fox jumps over the lazy dog", "en"), (1, "The quick brown fox jumps over the lazy dog", "en"),
        (1, "another text under the same id, which is allowed", "en"), (2, None, "en"), (None, "a text without an id", None),
        (None, None, None), (3, "", "fr"), (4, " \t\n ", "fr"), (5, LONG, "de"), (6, "漢字 ▁ ﬁ É\u0001x\u0000y 🎉", "ja"),
        (7, "The quick brown fox jumps over the lazy dog!", "en"), (8, "12 34 !!", "en"),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """Nulls, empty and long texts, repeated rows, and columns with names that the operators use themselves."""
    names = CLASHING.split()
    rows = [(*r, "src0", len(r[1] or ""), *range(len(names))) for r in odd_rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} int" for n in names))


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, None), (3, None, 1), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
