"""Divergence of sources (op12) against sums over every term."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from barograph.llm import divergence
from barograph.llm.divergence import run_lengths, share


def plain(rows, least=3, top=200):
    """The audit of (text, lang, source), term by term."""
    texts, langs = defaultdict(Counter), defaultdict(Counter)
    docs = defaultdict(Counter)
    for text, lang, source in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", low)
        texts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    kept = {lang: {t for t, n in seen.items() if n >= least} for lang, seen in docs.items()}
    for (lang, _), seen in texts.items():
        langs[lang].update(seen)

    def p(counts, lang, term):
        total = sum(counts[t] for t in kept[lang])
        return 1 + 10**9 * (counts[term] + 1) // (total + len(kept[lang]))

    out = []
    for (lang, source), counts in texts.items():
        own = {t: p(counts, lang, t) for t in kept[lang]}
        pairs = []
        for (other_lang, other), theirs in texts.items():
            if other_lang == lang and other != source:
                q = {t: p(theirs, lang, t) for t in kept[lang]}
                pairs.append((sum((own[t] - q[t]) ** 2 // q[t] for t in kept[lang]), other))
        whole = {t: p(langs[lang], lang, t) for t in kept[lang]}
        apart = [((own[t] - whole[t]) ** 2 // whole[t], t) for t in kept[lang] if counts[t] and own[t] > whole[t]]
        for part, found in (("pair", pairs), ("term", apart)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, rank) for rank, (value, item) in enumerate(found, 1) if part == "pair" or rank <= top]
    return sorted(out)


def audited(spark, docs, **limits):
    return sorted(tuple(r) for r in divergence.source_divergence(spark, docs, **limits).collect())


def test_odd_documents(spark, odd_docs):
    rows = [tuple(r) for r in odd_docs.select("text", "lang", "source").collect()]
    assert audited(spark, odd_docs, least_docs=2) == plain(rows, least=2)


def test_many_sources_and_a_crowd(spark, monkeypatch):
    monkeypatch.setattr(divergence, "COUNTS", 60)  # many ranges
    monkeypatch.setattr(divergence, "CHUNK", 500)
    random.seed(5)
    words = [f"{a}{b}" for a in "abcdéfgßhÀ" for b in ("x", "Y", "zz", "é", "'s", "q1r")]
    rows = []
    for i in range(300):
        lang = random.choice(["en", "fr", None, ""])
        source = "big" if i % 3 == 0 else random.choice(["s1", "s2", "Z", None, "", "lone"] if lang else ["s1"])
        text = "a crowd of words" if i % 5 == 0 else " ".join(random.choices(words, k=random.randrange(25)))
        rows.append((random.choice([text, text.upper(), None]) if i % 7 == 0 else text, lang, source))
    rows += [("solitary words of a lang", "xx", "s1"), (None, "yy", "s1"), ("", "yy", "s2")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(6)
    found = audited(spark, docs, top=20)
    assert found == plain(rows, top=20)
    assert ("yy", "s1", "pair", "s2", 0, 1) in found
    assert not [r for r in found if r[0] == "xx"]


def test_no_documents(spark, no_docs):
    assert audited(spark, no_docs) == []


def test_shares_are_exact_for_large_counts(spark):
    rows = [(0, 1, 1), (5, 7, 3), (10**13, 8 * 10**13, 10**9), (8 * 10**13, 8 * 10**13, 10**9), (123_456_789_012, 9_876_543_210_123, 77)]
    table = spark.createDataFrame(rows, "n long, total long, terms long")
    found = table.select("n", "total", "terms", share(table.n, table.total, table.terms).alias("p")).collect()
    for n, total, terms, p in found:
        assert p == 1 + 10**9 * (n + 1) // (total + terms)
        assert divergence._shares(np.array([n]), total, terms)[0] == p


@pytest.mark.parametrize("column", [[], [0], [3], [0, 0, 5, 5, 0, 7], [1, 1, 2, 0, 0], [0, 4, 4, 0, 4]])
def test_run_lengths(column):
    column = np.array(column, np.int64)
    at = np.flatnonzero(column)
    starts, values = run_lengths(at, column[at], len(column))
    if len(column):
        assert np.repeat(values, np.diff(np.append(starts, len(column)))).tolist() == column.tolist()
        assert (values[1:] != values[:-1]).all()
