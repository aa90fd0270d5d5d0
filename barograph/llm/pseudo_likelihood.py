"""Document scores by masked pseudo-likelihood.

A small network predicts every word from the two words before and the two after it. It sums one vector per neighbour and
place, and gives the word's probability in two steps: its class, then the id within the class. A document's score is
the sum of the logarithms of these probabilities over all of its words.

Words are counted over the whole corpus; the most frequent have ids of their own, the others share ids by hash. A word of
a shared id has its own part of the id's probability, by its count in the corpus: ``n_word / (n_id + 1)``. What is left is
for words that the corpus doesn't have; an id is taken to have as many of them as it has known ones on average, and one
more, and each gets an equal part. So the probabilities of different words sum to one. The counts are looked up by messages: stretches of documents send the
different words that they have to groups of words, which answer with the counts; no task holds all words. Training
runs on lists of ids, written once: in each round every task goes on from the common weights with its share of words, every
document included, and the tasks' weights are averaged by the number of words, in two levels, so that no task gathers more
than the square root of all. What a round sends grows with the corpus; the network itself has a fixed size.

Cases: words are as in ``words.WORD``; texts of any length are read whole, each in one task; a null or empty text has no words and score 0; beyond a document's ends there is a
mark in place of a neighbour; rows alike get the same score up to rounding; ties in frequency go by hash; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.llm.blocks import BLOCK_BYTES, NO_ID, text_bytes
from barograph.llm.words import flat, spans, word_hashes
from barograph.session import WorkArea

CLASSES, MEMBERS, OWN_IDS = 64, 64, 3072
IDS = CLASSES * MEMBERS
REACH, WIDTH = 2, 16
#: A round trains on every ``ROUNDS``-th word of each document; the rounds together train on every word once.
ROUNDS = 3
_BATCH, _RATE = 8192, 0.15
_CHUNK = 1 << 20
#: Words that are scored in one product, and the number of which a product's columns are a multiple.
_COLUMNS, _TILE = 1024, 32
_SLICES = 16
#: Text for each group of words, and the least number of groups.
GROUP_BYTES, LEAST_GROUPS = 64 << 20, 64

SHAPES = {
    "near": (2 * REACH, IDS + 1, WIDTH),
    "bias": (WIDTH,),
    "class_out": (CLASSES, WIDTH),
    "class_bias": (CLASSES,),
    "word_out": (CLASSES, MEMBERS, WIDTH),
    "word_bias": (CLASSES, MEMBERS),
}


def initial(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Weights at the start: small random vectors, and biases by the ids' frequencies."""
    rng = np.random.default_rng(17)
    weights = {k: (rng.standard_normal(s) * 0.1).astype(np.float32) for k, s in SHAPES.items()}
    table = counts.reshape(CLASSES, MEMBERS) + 1.0
    weights["class_bias"] = np.log(table.sum(axis=1) / table.sum()).astype(np.float32)
    weights["word_bias"] = np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)
    weights["bias"][:] = 0
    return weights


def packed(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in SHAPES])


def unpacked(flat_weights: np.ndarray) -> dict[str, np.ndarray]:
    sizes = [int(np.prod(s)) for s in SHAPES.values()]
    parts = np.split(flat_weights.astype(np.float32), np.cumsum(sizes)[:-1])
    return {k: p.reshape(s).copy() for (k, s), p in zip(SHAPES.items(), parts, strict=True)}


class Model(NamedTuple):
    """``counts`` has hash and n of all words, ``shared`` the number of words of each shared id; ``unseen`` is the number
    of different words unknown to the corpus that such an id is taken to have."""

    frequent: np.ndarray
    weights: np.ndarray
    counts: DataFrame
    shared: np.ndarray
    unseen: float


def shared_ids(hashes: np.ndarray) -> np.ndarray:
    return (OWN_IDS + (hashes >> np.uint64(33)) % np.uint64(IDS - OWN_IDS)).astype(np.int64)


class Vocabulary:
    """Ids of word hashes."""

    def __init__(self, frequent: np.ndarray):
        self.order = np.argsort(frequent)
        self.sorted = frequent[self.order]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        shared = shared_ids(hashes)
        if not len(self.sorted):
            return shared
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashes, self.order[at], shared)


def chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row, word hashes and the words' rows, for about a megabyte of text at a time."""
    data, offsets = flat(texts)
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _CHUNK, side="right")) - 1)
        part, own = data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        starts, ends, row = spans(part, own)
        yield at, to, word_hashes(part, starts, ends, 23), row
        at = to


def neighbours(ids: np.ndarray, row: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
    """Ids of the words around each word, or around those numbered ``own``; ``IDS`` beyond the ends of its document."""
    out = np.empty((len(ids if own is None else own), 2 * REACH), dtype=np.int64)
    if len(ids):
        # All words end to end, with marks between documents.
        place = np.arange(len(ids)) + REACH * (row - row[0] + 1)
        marked = np.full(int(place[-1]) + 1 + REACH, IDS, dtype=np.int64)
        marked[place] = ids
        place = place if own is None else place[own]
        for j, gap in enumerate([g for g in range(-REACH, REACH + 1) if g]):
            out[:, j] = marked.take(place + gap)
    return out


def targets(row: np.ndarray, turn: int) -> np.ndarray:
    """Indexes of the words that are trained in a round, by their places in their documents."""
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return np.flatnonzero(place % ROUNDS == turn % ROUNDS)


def _hidden(w: dict, near: np.ndarray) -> np.ndarray:
    total = w["near"][0].take(near[:, 0], axis=0)
    total += w["bias"]
    for j in range(1, 2 * REACH):
        total += w["near"][j].take(near[:, j], axis=0)
    return np.tanh(total, out=total)


_ONES = np.ones(max(CLASSES, MEMBERS), np.float32)


def _raised(x: np.ndarray) -> np.ndarray:
    """Exponentials in place, of each row up to a common factor; one shift for all rows, and nothing below the least float."""
    x -= x.max(initial=-np.inf)
    np.maximum(x, -80, out=x)
    return np.exp(x, out=x)


def _softmax(x: np.ndarray) -> np.ndarray:
    """In place."""
    _raised(x)
    x /= (x @ _ONES[: x.shape[1]])[:, None]
    return x


def log_probabilities(w: dict, near: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Logarithm of the probability of each word's id, given its neighbours.

    Words of one class go together, some at a time, so that tables stay in the processor's cache: classes lie above the ids of
    the class, a word is a column. No value of a column may depend on other columns, so none is shifted by a maximum; 80 is where
    values are cut, far above those of trained weights.
    """
    out = np.zeros(len(ids))
    ends = np.concatenate([np.broadcast_to(w["class_out"], (CLASSES, CLASSES, WIDTH)), w["word_out"]], axis=1).astype(np.float64)
    biases = np.concatenate([np.broadcast_to(w["class_bias"], (CLASSES, CLASSES)), w["word_bias"]], axis=1)[:, :, None]
    for a in range(0, len(ids), 1 << 16):
        order = a + np.argsort((ids[a : a + (1 << 16)] // MEMBERS).astype(np.int16), kind="stable")
        # Products in double precision, and all of whole tiles: otherwise rounding depends on a word's place in the batch.
        h, own = np.zeros((len(order) + _TILE, WIDTH)), ids.take(order)
        h[: len(order)] = _hidden(w, near.take(order, axis=0))
        kind, member = own // MEMBERS, CLASSES + own % MEMBERS
        p = np.empty(len(order))
        cuts = np.searchsorted(kind, np.arange(CLASSES + 1))
        for c in np.flatnonzero(np.diff(cuts)).tolist():
            for first in range(cuts[c], cuts[c + 1], _COLUMNS):
                last = min(first + _COLUMNS, cuts[c + 1])
                n = last - first
                wide = -(-n // _TILE) * _TILE
                x = (ends[c] @ h[first : first + wide].T).astype(np.float32)
                x += biases[c]
                np.minimum(x, 80, out=x)
                own = x[c, :n].astype(np.float64) + x[member[first:last], np.arange(n)]
                sums = np.exp(x, out=x).reshape(2, -1, wide).sum(axis=1)
                p[first:last] = own - np.log(sums, out=sums).sum(axis=0)[:n]
        out[order] = p
    return out


def train_step(w: dict, squares: dict, near: np.ndarray, ids: np.ndarray) -> None:
    """One step of AdaGrad on the mean of the logarithms; changes the weights in place."""
    n = len(ids)
    order = np.argsort((ids // MEMBERS).astype(np.int16), kind="stable")
    near, ids = near.take(order, axis=0), ids.take(order)
    kind, member = ids // MEMBERS, ids % MEMBERS
    h = _hidden(w, near)
    pull = _softmax(h @ w["class_out"].T + w["class_bias"])
    pull[np.arange(n), kind] -= 1
    grads = {"class_out": pull.T @ h, "class_bias": pull.sum(axis=0), "word_out": np.zeros_like(w["word_out"]), "word_bias": np.zeros_like(w["word_bias"])}
    back = pull @ w["class_out"]
    cuts = np.searchsorted(kind, np.arange(CLASSES + 1))
    for c in range(CLASSES):
        x = slice(cuts[c], cuts[c + 1])
        if cuts[c] < cuts[c + 1]:
            pull = _softmax(h[x] @ w["word_out"][c].T + w["word_bias"][c])
            pull[np.arange(len(pull)), member[x]] -= 1
            grads["word_out"][c], grads["word_bias"][c] = pull.T @ h[x], pull.sum(axis=0)
            back[x] += pull @ w["word_out"][c]
    back *= 1 - h * h
    grads["bias"] = back.sum(axis=0)
    for k, g in grads.items():
        g /= n
        squares[k] += g * g
        w[k] -= _RATE * g / np.sqrt(squares[k] + 1e-10)
    for j in range(2 * REACH):
        own = near[:, j].astype(np.int16)
        order = np.argsort(own, kind="stable")
        own = own[order]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        at = own[first]
        g = np.add.reduceat(back.take(order, axis=0), first, axis=0) / n
        past = squares["near"][j].take(at, axis=0)
        past += g * g
        squares["near"][j][at] = past
        w["near"][j][at] -= _RATE * g / np.sqrt(past + 1e-10)


def word_counts(docs: DataFrame) -> DataFrame:
    """hash and n of every word of the corpus."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [h for _, _, h, _ in chunks(batch.column("text"))] or [np.zeros(0, np.uint64)]
            hashes, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n)], ["hash", "n"])

    return docs.select("text").mapInArrow(rows, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def id_lists(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """number, ids (two bytes a word) and sizes (words of each document) of stretches of documents."""
    held = docs.sparkSession.sparkContext.broadcast(frequent)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(held.value)
        for batch in batches:
            for a, b, hashes, row in chunks(batch.column("text")):
                ids = vocabulary.ids(hashes).astype(np.uint16)
                sizes = np.bincount(row, minlength=b - a)
                columns = [batch.column("number")[a : a + 1], pa.array([ids.tobytes()]), pa.array([sizes.tobytes()])]
                yield pa.RecordBatch.from_arrays(columns, ["number", "ids", "sizes"])

    numbered = docs.select(F.monotonically_increasing_id().alias("number"), "text")
    return numbered.mapInArrow(rows, "number long, ids binary, sizes binary")


def trained(area: WorkArea, docs: DataFrame, frequent: np.ndarray, weights: np.ndarray, turn: int) -> np.ndarray:
    """The weights after one more round over ``docs``."""
    return trained_on(area, id_lists(docs, frequent), weights, turn)


def trained_on(area: WorkArea, lists: DataFrame, weights: np.ndarray, turn: int) -> np.ndarray:
    """The weights after one more round over ``id_lists``; only they come to the driver."""
    held = lists.sparkSession.sparkContext.broadcast(weights)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = unpacked(held.value)
        squares = {k: np.full(s, 1e-4, np.float32) for k, s in SHAPES.items()}
        done = 0
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        first = None
        for number, packed_ids, sizes in (r for batch in batches for r in zip(*batch.columns, strict=True)):
            first = number.as_py() if first is None else first
            ids = np.frombuffer(packed_ids.as_buffer(), np.uint16)
            row = np.repeat(np.arange(sizes.as_buffer().size // 8), np.frombuffer(sizes.as_buffer(), np.int64))
            own = targets(row, turn)
            waiting.append((neighbours(ids, row, own), ids[own].astype(np.int64)))
            if sum(len(x[1]) for x in waiting) < _BATCH:
                continue
            near, own_ids = (np.concatenate(x) for x in zip(*waiting, strict=True))
            whole = len(own_ids) // _BATCH * _BATCH
            for at in range(0, whole, _BATCH):
                train_step(w, squares, near[at : at + _BATCH], own_ids[at : at + _BATCH])
            done += whole
            waiting = [(near[whole:], own_ids[whole:])]
        if waiting and sum(len(x[1]) for x in waiting):
            near, own_ids = (np.concatenate(x) for x in zip(*waiting, strict=True))
            train_step(w, squares, near, own_ids)
            done += len(own_ids)
        if done:
            parts = np.array_split(packed(w).astype(np.float32), _SLICES)
            columns = [pa.array([first] * _SLICES), pa.array([done] * _SLICES), pa.array(range(_SLICES), pa.int32()), pa.array([p.tobytes() for p in parts])]
            yield pa.RecordBatch.from_arrays(columns, ["task", "words", "slice", "weights"])

    def mean(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("task")
        share = pdf["words"].to_numpy() / pdf["words"].sum()
        total = sum(np.frombuffer(x, np.float32).astype(np.float64) * s for x, s in zip(pdf["weights"], share, strict=True))
        return pd.DataFrame({"task": [pdf["task"].iloc[0]], "words": [pdf["words"].sum()], "slice": [pdf["slice"].iloc[0]], "weights": [total.astype(np.float32).tobytes()]})

    schema = "task long, words long, slice int, weights binary"
    own = area.stage(lists.select("number", "ids", "sizes").mapInArrow(rows, schema), f"weights-{turn}")
    tasks = own.filter("slice = 0").count()
    groups = max(1, int(tasks**0.5))
    some = own.withColumn("part", F.pmod(F.xxhash64("task"), F.lit(groups))).groupBy("slice", "part").applyInPandas(mean, schema)
    whole = some.groupBy("slice").applyInPandas(mean, schema).collect()
    if not whole:
        return weights
    return np.concatenate([np.frombuffer(bytes(r.weights), np.float32) for r in sorted(whole, key=lambda r: r.slice)])


def shared_counts(counts: DataFrame, top: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """Words of each shared id, and how many unknown ones it is taken to have; ``top`` are the words with ids of their own."""
    own_id = F.expr(f"shiftrightunsigned(hash, 33) % {IDS - OWN_IDS}").cast("int").alias("id")
    held = counts.groupBy(own_id).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    out = np.zeros(IDS - OWN_IDS)
    out[[r.id for r in held]] = [r.n for r in held]
    np.subtract.at(out, shared_ids(top) - OWN_IDS, n)
    return out, (sum(r.words for r in held) - len(top)) / len(out) + 1


def fit(spark: SparkSession, docs: DataFrame, rounds: int = ROUNDS) -> Model:
    """The hashes of the frequent words, most frequent first, the weights, and the counts."""
    area = WorkArea(spark)
    counts = area.stage(word_counts(docs), "words")
    top = counts.orderBy(F.desc("n"), "hash").limit(OWN_IDS).collect()
    frequent = np.array([r.hash for r in top], dtype=np.int64).view(np.uint64)
    by_id = np.zeros(IDS)
    by_id[: len(top)] = [r.n for r in top]
    shared, unseen = shared_counts(counts, frequent, by_id[: len(top)])
    by_id[len(top) : OWN_IDS] = 1e-6 - 1  # no word has them
    by_id[OWN_IDS:] = shared
    weights = packed(initial(by_id))
    lists = area.stage(id_lists(docs, frequent), "ids") if rounds else None
    for turn in range(rounds):
        weights = trained_on(area, lists, weights, turn)
    return Model(frequent, weights, counts, shared, unseen)


_PARTS = ["ids", "known", "n_words", "sums", "rare", "places"]


def _asking(docs: DataFrame, model: Model, groups: int) -> DataFrame:
    """Stretches of documents: block, their sums by id, where words of shared ids stand, and these words by group."""
    held = docs.sparkSession.sparkContext.broadcast((model.frequent, model.weights))

    def closed(block: int, parts: list[tuple], found: list[np.ndarray]) -> pa.RecordBatch:
        words, places = np.unique(np.concatenate(found), return_inverse=True)
        group = (words >> np.uint64(20)) % np.uint64(groups)
        order = np.argsort(group, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        some, first = np.unique(group[order], return_index=True)
        asked = [{"part": int(k), "words": w.tobytes()} for k, w in zip(some, np.split(words[order], first[1:]), strict=False)]
        columns = [np.concatenate(x).tobytes() for x in zip(*parts, strict=True)] + [rank[places].astype(np.uint32).tobytes()]
        kind = pa.list_(pa.struct([("part", pa.int32()), ("words", pa.binary())]))
        return pa.RecordBatch.from_arrays([pa.array([block]), *[pa.array([c]) for c in columns], pa.array([asked], kind)], ["block", *_PARTS, "asked"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, weights = held.value
        vocabulary, w = Vocabulary(frequent), unpacked(weights)
        parts: list[tuple] = []
        found: list[np.ndarray] = []
        size = block = 0
        for batch in batches:
            column = batch.column("doc_id")
            doc, known = column.fill_null(NO_ID).to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)
            for a, b, hashes, row in chunks(batch.column("text")):
                if not parts:
                    block = batch.column("number")[a].as_py()
                ids = vocabulary.ids(hashes)
                p = log_probabilities(w, neighbours(ids, row), ids)
                rare = np.flatnonzero(ids >= OWN_IDS)
                n, n_rare = np.bincount(row, minlength=b - a), np.bincount(row[rare], minlength=b - a)
                parts.append((doc[a:b], known[a:b], n, np.bincount(row, p, minlength=b - a), n_rare))
                found.append(hashes[rare])
                size += len(hashes)
                if size >= BLOCK_BYTES // 8 or len(parts) >= 1000:
                    yield closed(block, parts, found)
                    parts, found, size = [], [], 0
        if parts:
            yield closed(block, parts, found)

    schema = f"block long, {', '.join(f'{c} binary' for c in _PARTS)}, asked array<struct<part: int, words: binary>>"
    numbered = docs.select(F.monotonically_increasing_id().alias("number"), F.col("doc_id").cast("long"), "text")
    return numbered.mapInArrow(rows, schema)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_words and log_likelihood, the sum over the document's words."""
    area = WorkArea(docs.sparkSession)
    groups = max(LEAST_GROUPS, -(-text_bytes(docs) // GROUP_BYTES))
    shared, unseen = model.shared, model.unseen

    def answer(asked: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        """Logarithm of each asked word's part of its id."""
        hashes, n = counts["hash"].to_numpy(np.int64).view(np.uint64), counts["n"].to_numpy(np.int64)
        order = np.argsort(hashes)
        hashes, n = np.append(hashes[order], np.uint64(0)), np.append(n[order], 0)
        out = []
        for block, part, words in zip(asked["block"], asked["part"], asked["words"], strict=True):
            words = np.frombuffer(words, np.uint64)
            at, own = np.searchsorted(hashes[:-1], words), shared_ids(words) - OWN_IDS
            known = (hashes[at] == words) & (n[at] > 0)
            share = np.log(np.where(known, n[at], 1 / unseen)) - np.log(shared[own] + 1)
            out.append((block, part, share.tobytes()))
        return pd.DataFrame(out, columns=["block", "part", "shares"])

    def add(block: pd.DataFrame, shares: pd.DataFrame) -> pd.DataFrame:
        kinds = (np.int64, bool, np.int64, np.float64, np.int64, np.uint32)
        ids, known, n_words, sums, rare, places = (np.frombuffer(block[c].iloc[0], t) for c, t in zip(_PARTS, kinds, strict=True))
        share = np.frombuffer(b"".join(shares.sort_values("part")["shares"]), np.float64)
        sums = sums + np.bincount(np.repeat(np.arange(len(ids)), rare), share[places], minlength=len(ids))
        doc_id = pd.Series(ids, dtype="Int64").where(pd.Series(known))
        return pd.DataFrame({"doc_id": doc_id, "n_words": n_words, "log_likelihood": sums})

    blocks = area.stage(_asking(docs, model, groups), "blocks")
    asked = blocks.select("block", F.explode("asked").alias("a")).select("block", "a.part", "a.words")
    counts = model.counts.select("hash", "n", F.expr(f"int(shiftrightunsigned(hash, 20) % {groups})").alias("part"))
    found = asked.groupBy("part").cogroup(counts.groupBy("part")).applyInPandas(answer, "block long, part int, shares binary")
    found = area.stage(found, "shares")
    own = blocks.select("block", *_PARTS).groupBy("block").cogroup(found.groupBy("block"))
    return own.applyInPandas(add, "doc_id long, n_words long, log_likelihood double")


def op4_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = scores(docs, fit(spark, docs))
    return found.withColumn("mean_log_likelihood", F.col("log_likelihood") / F.nullif("n_words", F.lit(0)))
