"""Word windows (op1) and byte strings (op5) that repeat."""

import random

import numpy as np
import pytest
from brute import byte_strings, counted, windows
from pyspark.sql import functions as F

from barograph.llm import bytespans, substrings
from barograph.llm.blocks import squeeze, stretch
from barograph.llm.suffixes import repeated_suffixes, sort_suffixes
from barograph.llm.words import flat, spans, window_hashes, word_hashes


def of_windows(spark, docs, **limits):
    rows = substrings.without_repeats(spark, docs, **limits).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
    return counted(tuple(r) for r in rows)


def of_bytes(spark, docs, **limits):
    kept = bytespans.without_repeated_bytes(spark, docs, **limits)
    return counted(tuple(r) for r in kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect())


def test_words_and_window_hashes():
    import pyarrow as pa

    texts = ["a b  c\x0bd", None, "", " é\x1fx ß ", "a b c d"]
    data, offsets = flat(pa.array(texts))
    starts, ends, row = spans(data, offsets)
    found = [(int(r), data[a:b].tobytes()) for r, a, b in zip(row, starts, ends, strict=True)]
    assert found == [(i, w) for i, t in enumerate(texts) for w in (t or "").encode().split()]
    hashes = word_hashes(data, starts, ends, 1)
    assert len(set(hashes.tolist())) == len({w for _, w in found})
    for size in (1, 2, 3, 20):
        runs = np.concatenate([hashes] * 9)
        h = window_hashes(runs, size, 1)
        same = {}
        for i in range(len(h)):
            assert same.setdefault(tuple(runs[i : i + size].tolist()), h[i]) == h[i]
        assert len(set(h.tolist())) == len(same)


def test_numbers_survive_packing():
    rng = np.random.default_rng(0)
    for values in ([], [5], [-3, 7, 7, 1 << 62, -(1 << 62)], np.sort(rng.integers(0, 1 << 40, 1000))):
        assert stretch(squeeze(np.array(values, np.int64))).tolist() == list(values)


def test_two_stage_sort_equals_sorting():
    rng = np.random.default_rng(1)
    for _ in range(150):
        depth = 8 * int(rng.integers(1, 4))
        letters = int(rng.integers(1, 4))
        segments = [bytes(rng.integers(97, 97 + letters, int(rng.integers(depth, depth + 50))).astype(np.uint8)) for _ in range(int(rng.integers(1, 9)))]
        lengths = np.array(list(map(len, segments)))
        wanted = np.array([int(rng.integers(1, n - depth + 2)) for n in lengths])
        joined = np.frombuffer(b"".join(segments), np.uint8)
        text, order = sort_suffixes(joined, lengths, wanted, depth)
        keys = [text[p : p + depth].tobytes() for p in order]
        assert keys == sorted(keys)
        starts = [s[i : i + depth] for s, w in zip(segments, wanted, strict=True) for i in range(w)]
        assert repeated_suffixes(joined, lengths, wanted, depth).tolist() == [starts.count(x) > 1 for x in starts]


def test_windows_of_odd_documents(spark, odd_docs, odd_rows, no_docs):
    assert of_windows(spark, odd_docs) == counted(windows(odd_rows))
    assert not of_windows(spark, no_docs)


def test_bytes_of_odd_documents(spark, odd_docs, odd_rows, no_docs):
    expected = counted(byte_strings(odd_rows))
    assert of_bytes(spark, odd_docs) == expected
    assert of_bytes(spark, odd_docs, hot=3) == expected  # anchors that occur often take another way
    assert not of_bytes(spark, no_docs)


@pytest.fixture(scope="module")
def quilt(spark):
    """Texts pieced together from few words and passages, so that nearly all of them repeat, in any order."""
    random.seed(3)
    words = ["ab", "c", "def", "é", "gh1"]
    passages = [" ".join(random.choices(words, k=40)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [random.choice(passages)[random.randrange(30) :] if random.random() < 0.7 else " ".join(random.choices(words, k=9)) for _ in range(6)]
        rows.append((1000 - i, random.choice([" ", "\n", "  "]).join(parts)))
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(7)


def test_quilted_texts(spark, quilt):
    rows, docs = quilt
    assert of_windows(spark, docs) == counted(windows(rows))
    assert of_windows(spark, docs, size=5) == counted(windows(rows, 5))
    assert of_bytes(spark, docs) == counted(byte_strings(rows))
    assert of_bytes(spark, docs, hot=4) == counted(byte_strings(rows))


def test_small_table(spark, small_docs):
    docs = spark.createDataFrame(small_docs, "doc_id long, text string").repartition(5)
    assert of_windows(spark, docs) == counted(windows(small_docs))
    assert of_bytes(spark, docs) == counted(byte_strings(small_docs))
