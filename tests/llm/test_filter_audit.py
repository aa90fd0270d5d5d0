"""Filter interactions (op13) against a walk through every order with every document."""

import itertools
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from barograph.llm import filter_audit
from barograph.llm.filter_audit import intervals, order_names, text_filters


def fails(rows):
    """For (doc_id, text) the letters of the filters that each row fails."""
    first = {}
    for doc_id, text in rows:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        found = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": text in first and (doc_id is None or first[text] < doc_id),
        }
        out.append({x for x, failed in found.items() if failed})
    return out


def walked(rows, good=(), toxic=()):
    """The audit's rows for (doc_id, text, part), document by document."""
    sets = fails([r[:2] for r in rows])
    count = Counter()
    parts = {r[2] or "" for r in rows}
    for order in map("".join, itertools.permutations("ABCDE")):
        for row, failed in zip(rows, sets, strict=True):
            part, gone = row[2] or "", False
            for step, letter in enumerate(order, 1):
                here = not gone and letter in failed
                count[part, order, step, "redundant"] += gone and letter in failed
                count[part, order, step, "unique_fails"] += failed == {letter}
                gone = gone or here
                count[part, order, step, "removed"] += here
                count[part, order, step, "kept"] += not gone
                count[part, order, step, "good_lost"] += here and row[0] in good
                count[part, order, step, "toxic_lost"] += here and row[0] in toxic
                count[part, letter, "shapley"] += here
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return sorted(
        (part, order, step, *(count[part, order, step, n] for n in names), count[part, order[step - 1], "shapley"])
        for part in parts
        for order in map("".join, itertools.permutations("ABCDE"))
        for step in range(1, 6)
    )


def audited(spark, docs, labels):
    return sorted(tuple(r) for r in filter_audit.audit_filters(spark, docs, labels, text_filters(), copies="E").collect())


@pytest.fixture(scope="module")
def marks(spark):
    rows = [(1, 1, 0), (2, 0, 1), (2, 1, None), (6, None, 1), (None, 1, 1), (9, 1, 1), (77, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("text", F.lit("x")).withColumn("lang", F.lit("y"))


@pytest.mark.parametrize("n", [1, 3, 5])
def test_intervals_are_the_orders_in_which_a_mask_goes(n):
    letters = "ABCDE"[:n]
    orders = order_names(letters)
    assert orders == sorted(orders)
    found = Counter((mask, step, rank) for mask, step, begin, end in intervals(n) for rank in range(begin, end))
    wanted = Counter()
    for mask in range(1, 1 << n):
        failed = {x for k, x in enumerate(letters) if mask >> k & 1}
        wanted.update((mask, min(order.index(x) for x in failed) + 1, rank) for rank, order in enumerate(orders))
    assert found == wanted


def test_odd_documents(spark, odd_docs, odd_rows, marks):
    rows = [(d, t, None if i % 4 == 0 else "en") for i, (d, t) in enumerate(odd_rows)]
    found = audited(spark, odd_docs, marks)
    assert found == walked(rows, good={1, 2, 9}, toxic={2, 6, 9})
    assert len(found) == 2 * 600


def test_crowd_of_copies(spark, marks):
    random.seed(3)
    words = [" ".join(random.choices("ab cd ef gh IJ KL m# nn oo pp".split(), k=random.choice([5, 120]))) for _ in range(25)]
    rows = [(i, words[0] if i % 3 else random.choice(words), random.choice(["en", "", None, "fr"])) for i in range(240)]
    rows += rows[40:60]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    assert audited(spark, docs, marks) == walked(rows, good={1, 2, 9, 77}, toxic={2, 6, 9, 77})


def test_empty_tables(spark, no_docs, odd_docs, marks):
    assert audited(spark, no_docs, marks) == []
    assert len(audited(spark, odd_docs, marks.filter("doc_id < 0"))) == 1200


def test_number_of_filters_is_bounded(spark, marks):
    with pytest.raises(ValueError):
        filter_audit.interactions(spark, marks, "ABCDEFGH")
