"""Quality classifier by Bradley-Terry pairwise ranking.

A document's score is linear in features of its text: frequencies of pairs of adjacent character classes, and shape
figures of its words. The weights maximise the likelihood that of a pair of labelled documents, one of label 1 and one
of label 0, the first ranks higher: logistic loss on the difference of their features. The score that separates the
labels is the quantile of the training scores at which most training labels are right.

The fit reads ``SAMPLE`` labelled rows at most, those with the lowest hash of their id; everything else covers all rows.
Cases: a null or empty text has features of zero and gets a score; labels that are null, or that contradict each other
for one id, are left out, and repeated ones count once; with labels of one kind only, every score is 0.5; rows alike get
the same score; a null doc_id isn't held out; texts of any length are read whole, each in one task; of equally good separating scores
the middle one is taken; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barograph.llm.words import flat, spans, word_hashes

SAMPLE = 8000
_STEPS, _RATE, _DECAY = 400, 0.05, 1e-4
#: Bytes of text whose features are counted at once; the tables of a step take some fifty times as much.
_CHUNK = 1 << 18

_SINGLE = b".,!?;:|%$&*#@-_'\"()/<>=+"
_CLASSES = 32
_CLASS = np.zeros(256, dtype=np.uint8)
for _i, _byte in enumerate(_SINGLE):
    _CLASS[_byte] = _i + 1
_CLASS[ord("a") : ord("z") + 1] = 26
_CLASS[ord("A") : ord("Z") + 1] = 27
_CLASS[ord("0") : ord("9") + 1] = 28
_CLASS[ord(" ")] = 29
_CLASS[[9, 10, 11, 12, 13]] = 30
_CLASS[128:] = 31
N_SHAPES = 10
N_FEATURES = _CLASSES * _CLASSES + N_SHAPES


def _features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(n), sizes)
    kind = _CLASS[data].astype(np.int64)
    out = np.zeros((n, N_FEATURES), dtype=np.float32)
    if len(data) > 1:
        pair = (row * _CLASSES + kind)[:-1] * _CLASSES + kind[1:]
        pair = pair[row[:-1] == row[1:]]
        counts = np.bincount(pair, minlength=n * _CLASSES * _CLASSES).reshape(n, -1)
        out[:, :-N_SHAPES] = np.sqrt(counts / np.maximum(sizes - 1, 1)[:, None])
    starts, ends, doc = spans(data, offsets)
    hashes = word_hashes(data, starts, ends, 5)
    words = np.bincount(doc, minlength=n)
    per_word = np.maximum(words, 1)
    same = np.zeros((3, n))
    for gap in (1, 2, 3):
        alike = (hashes[gap:] == hashes[:-gap]) & (doc[gap:] == doc[:-gap])
        same[gap - 1] = np.bincount(doc[gap:][alike], minlength=n)
    order = np.lexsort((hashes, doc))
    first = np.ones(len(order), dtype=bool)
    first[1:] = (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    distinct = np.bincount(doc[order][first], minlength=n)
    length = np.bincount(doc, weights=ends - starts, minlength=n) / per_word
    spread = np.sqrt(np.bincount(doc, weights=(ends - starts - length[doc]) ** 2, minlength=n) / per_word)
    lines = np.bincount(row[data == 10], minlength=n)
    stops = np.bincount(row[(data == ord(".")) | (data == ord("!")) | (data == ord("?"))], minlength=n)
    shapes = [
        np.log1p(words) / 10,
        np.log1p(length) / 3,
        np.log1p(spread) / 3,
        distinct / per_word,
        *(same / per_word),
        np.log1p(words / (lines + 1)) / 6,
        np.log1p(words / (stops + 1)) / 6,
        words > 0,
    ]
    out[:, -N_SHAPES:] = np.stack(shapes, axis=1)
    return out


def features(texts: pa.Array) -> Iterator[np.ndarray]:
    """Features of the texts, a quarter of a megabyte of text at a time."""
    data, offsets = flat(texts)
    at = 0
    while at < len(offsets) - 1:
        to = min(len(offsets) - 1, at + 512, max(at + 1, int(np.searchsorted(offsets, offsets[at] + _CHUNK, side="right")) - 1))
        yield _features(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _labelled_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for block in features(batch.column("text")):
            rows = pa.array([x.tobytes() for x in block.astype(np.float16)], pa.binary())
            yield pa.RecordBatch.from_arrays([rows, batch.column("quality").slice(at, len(block))], ["features", "quality"])
            at += len(block)


def fit(x: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Weights, the separating score, and the scale that makes of a score's distance a probability."""
    good, bad = x[label == 1], x[label == 0]
    w = np.zeros(x.shape[1])
    if not len(good) or not len(bad):
        return w, 0.0, 1.0
    rng = np.random.default_rng(7)
    pairs = max(len(good), len(bad))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, _STEPS + 1):
        a = rng.permutation(np.resize(np.arange(len(good)), pairs))
        b = rng.permutation(np.resize(np.arange(len(bad)), pairs))
        margin = (good @ w)[a] - (bad @ w)[b]
        pull = 1 / (1 + np.exp(np.clip(margin, -30, 30))) / pairs
        grad = -(good.T @ np.bincount(a, pull, len(good)) - bad.T @ np.bincount(b, pull, len(bad))) + _DECAY * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= _RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    scores = x @ w
    order = np.argsort(scores, kind="stable")
    s, wrong = scores[order], np.concatenate([[0], np.cumsum(label[order] == 1)]) + np.concatenate([np.cumsum((label[order] == 0)[::-1])[::-1], [0]])
    cuts = np.concatenate([[True], s[1:] > s[:-1], [True]])
    best = np.flatnonzero(cuts & (wrong == wrong[cuts].min()))
    k = int(best[len(best) // 2])
    edge = (s[max(k - 1, 0)] + s[min(k, len(s) - 1)]) / 2
    scale = max(float(np.std(scores)), 1e-6) / 4
    return w, float(edge), scale


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float, float]:
    """Fits on the labelled rows that aren't held out; only the sample's features come to the driver."""
    agreed = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .filter(F.col("quality") == F.col("other"))
        .select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("quality"))
    )
    known = docs.select("doc_id").join(agreed, F.col("doc_id") == F.col("_id"), "left_semi").distinct()
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).join(agreed, F.col("doc_id") == F.col("_id"))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen.select("_id", "quality")), F.col("doc_id") == F.col("_id"))
    texts = texts.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    rows = texts.select("text", "quality").mapInArrow(_labelled_features, "features binary, quality int").collect()
    rows.sort(key=lambda r: (r.quality, bytes(r.features)))
    x = np.frombuffer(b"".join(bytes(r.features) for r in rows), np.float16).astype(np.float32).reshape(-1, N_FEATURES)
    return fit(x, np.array([r.quality for r in rows], dtype=np.int64))


def score(text: Column, model: tuple[np.ndarray, float, float]) -> Column:
    """A probability-like score; 0.5 is the separating score of the training documents."""
    weights, edge, scale = model

    @F.arrow_udf(T.DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        # Row by row sums: a matrix product's rounding would depend on the other rows of the batch.
        found = [(x * weights).sum(axis=1) for x in features(texts)] or [np.zeros(0)]
        distance = (np.concatenate(found) - edge) / scale
        return pa.array(1 / (1 + np.exp(-np.clip(distance, -500, 500))))

    return scored(text)


def classify(docs: DataFrame, model: tuple[np.ndarray, float, float], name: str = "score") -> DataFrame:
    """``docs`` with one more column, the score."""
    return docs.withColumn(name, score(F.col("text"), model))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return classify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
