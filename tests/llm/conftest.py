import pytest
from brute import SMALL

TEXT = "The quick brown fox jumps over the lazy dog and runs away from the hunter who had come to the wood at dawn to look for birds "


@pytest.fixture(scope="module")
def odd_rows():
    """(doc_id, text): nulls, empty, blank, short and very long texts, copies, repeated rows."""
    long = " ".join(f"word{i * i % 997} x{i}" for i in range(15_000))
    return [
        (1, TEXT * 3),
        (1, TEXT * 3),
        (2, TEXT * 3),
        (3, None),
        (4, ""),
        (5, " \n\t  \n"),
        (6, long),
        (7, "one"),
        (8, "One  two\nthree"),
        (9, f"Some text of its own, then: {TEXT}{TEXT} and an end that no other has, 123."),
        (10, "é " * 300),
        (11, "a" * 1000),
        (None, TEXT * 3),
        (None, None),
    ]


@pytest.fixture(scope="module")
def odd_docs(spark, odd_rows):
    """The same as documents, with columns whose names the operators use themselves."""
    rows = [(d, t, None if i % 4 == 0 else "en", None if i % 3 == 0 else f"s{i % 2}", len(t or ""), *["x"] * 12) for i, (d, t) in enumerate(odd_rows)]
    own = "block rows packed _row key hash fp node row size score part".split()
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in own)
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def no_docs(odd_docs):
    return odd_docs.filter("doc_id < 0")


@pytest.fixture(scope="session")
def small_docs():
    return SMALL()
