"""Removal of word sequences that occurred before, found through a count-min prefilter.

A window is a run of ``WINDOW`` words of one document. Every block of documents sketches its windows: two rows of
counters, kept as the sorted numbers of the counters that aren't zero, cut off at two. The sketches are merged in slices
of the rows; a merged counter is at least the count of each window it stands for. A window is estimated repeated if both
its counters reach two. Only those windows are grouped exactly in a second pass, by 96 bits of hashes; nothing that is
repeated escapes, and what the estimate lets through by chance is alone in its group.

Before the windows of a block are sent, repeats within the block are taken together, so a window that stands in every
document is sent once per block. Widths grow with the text, so the share of chance hits doesn't.

Cases: words are as in ``words.WORD``, null texts have none; documents shorter than a window keep all; a text is never cut,
so one longer than a block is a block of its own, read whole by one task; there are no ties, as places are ordered; a null doc_id counts
as the largest; rows with one doc_id count as one place, so rows alike are treated alike; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.llm.blocks import Texts, gather, packed_blocks, squeeze, stretch, text_bytes
from barograph.llm.words import mix, spans, window_hashes, word_hashes
from barograph.session import WorkArea

WINDOW = 20
#: Text per slice of the sketch: about four million windows, at eight counters each.
SLICE_BYTES = 25_000_000
_SLICE_BITS = 25
_ROWS = 2


def windows(texts: Texts, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the block's windows, and the number, within the block, of each one's first word."""
    found, places, words = [], [], 0
    for a, b in texts.chunks():
        data = texts.data[texts.offsets[a] : texts.offsets[b]]
        starts, ends, row = spans(data, texts.offsets[a : b + 1] - texts.offsets[a])
        hashes = window_hashes(word_hashes(data, starts, ends, seed), size, seed)
        whole = np.flatnonzero(row[: len(hashes)] == row[size - 1 : size - 1 + len(hashes)])
        found.append(hashes[whole])
        places.append(whole + words)
        words += len(starts)
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(places)


def counters(hashes: np.ndarray, row: int, slices: int) -> np.ndarray:
    """Numbers of the windows' counters in a row of the sketch; the slice is in the upper bits."""
    h = hashes if row == 0 else mix(hashes + np.uint64(row))
    return (((h >> np.uint64(40)) % np.uint64(slices)) << np.uint64(_SLICE_BITS)) | (h & np.uint64((1 << _SLICE_BITS) - 1))


def by_slice(numbers: np.ndarray, slices: int) -> list[tuple[int, np.ndarray]]:
    """Sorted counters by slice, without the slice's bits."""
    cuts = np.searchsorted(numbers, np.arange(slices + 1, dtype=np.uint64) << np.uint64(_SLICE_BITS))
    low = numbers & np.uint64((1 << _SLICE_BITS) - 1)
    return [(k, low[a:b]) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]


def sketch(blocks: DataFrame, size: int, slices: int) -> DataFrame:
    """row, slice, block and counters: each block's partial sketch."""

    def partial(batches):
        for batch in batches:
            for block, packed in zip(batch["block"], batch["packed"], strict=True):
                hashes, _ = windows(Texts(packed), size, 1)
                out = []
                for row in range(_ROWS):
                    numbers = np.sort(counters(hashes, row, slices))
                    keep = np.ones(len(numbers), bool)
                    keep[2:] = numbers[2:] != numbers[:-2]
                    out += [(row, k, block, squeeze(low)) for k, low in by_slice(numbers[keep], slices)]
                yield pd.DataFrame(out, columns=["row", "slice", "block", "counters"])

    return blocks.select("block", "packed").mapInPandas(partial, "row int, slice int, block long, counters binary")


def merged(sketches: DataFrame) -> DataFrame:
    """row, slice, block and counters: of each block's counters those that reach two in the merged sketch."""

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        own = [stretch(c) for c in pdf["counters"]]
        all_ = np.sort(np.concatenate(own))
        twice = np.unique(all_[1:][all_[1:] == all_[:-1]])
        out = []
        for block, numbers in zip(pdf["block"], own, strict=True):
            numbers = np.unique(numbers)
            if len(twice):
                numbers = numbers[twice[np.minimum(np.searchsorted(twice, numbers), len(twice) - 1)] == numbers]
                if len(numbers):
                    out.append((pdf["row"].iloc[0], pdf["slice"].iloc[0], block, squeeze(numbers)))
        return pd.DataFrame(out, columns=["row", "slice", "block", "counters"])

    return sketches.groupBy("row", "slice").applyInPandas(merge, "row int, slice int, block long, counters binary")


def _estimated(hashes: np.ndarray, replies: pd.DataFrame, slices: int) -> np.ndarray:
    """Indexes of the windows whose counters all reach two."""
    at = np.arange(len(hashes))
    for row in range(_ROWS):
        own = replies[replies["row"] == row].sort_values("slice")
        if own.empty:
            return at[:0]
        twice = np.concatenate([stretch(c) | (int(k) << _SLICE_BITS) for k, c in zip(own["slice"], own["counters"], strict=True)])
        numbers = counters(hashes[at], row, slices).view(np.int64)
        at = at[twice[np.minimum(np.searchsorted(twice, numbers), len(twice) - 1)] == numbers]
    return at


def candidates(blocks: DataFrame, replies: DataFrame, size: int, slices: int) -> DataFrame:
    """Messages to the groups of exact keys: part, block, own, hashes, lows, docs, starts, places (first words).

    ``own`` marks windows that the block itself has earlier; they are only passed on.
    """
    columns = ["part", "block", "own", "hashes", "lows", "docs", "starts", "places"]

    def send(key: tuple, block: pd.DataFrame, reply: pd.DataFrame) -> pd.DataFrame:
        if block.empty or reply.empty:
            return pd.DataFrame([], columns=columns)
        texts = Texts(block["packed"].iloc[0])
        hashes, places = windows(texts, size, 1)
        at = _estimated(hashes, reply, slices)
        second, _ = windows(texts, size, 2)
        hashes, lows, places = hashes[at], (second[at] >> np.uint64(32)).astype(np.int64), places[at]
        first_word = _first_words(texts)
        doc = np.searchsorted(first_word, places, side="right") - 1
        ids, starts = texts.ids[doc], places - first_word[doc]
        order = np.lexsort((places, lows, hashes))  # places rise with doc_id, then with the start
        new = np.ones(len(order), bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (lows[order][1:] != lows[order][:-1])
        first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
        later = np.zeros(len(order), bool)
        later[order] = (ids[order] != ids[first]) | (starts[order] != starts[first])
        block_id = block["block"].iloc[0]
        out = [(int(block_id % slices), block_id, True, b"", b"", b"", b"", squeeze(places[later]))] if later.any() else []
        sent = np.flatnonzero(~later)
        part = (hashes[sent] >> np.uint64(20)) % np.uint64(slices)
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(slices + 1))
        for k in range(slices):
            x = sent[order[cuts[k] : cuts[k + 1]]]
            if len(x):
                out.append(
                    (k, block_id, False, hashes[x].tobytes(), lows[x].astype(np.uint32).tobytes(), squeeze(ids[x]), squeeze(starts[x]), squeeze(places[x]))
                )
        return pd.DataFrame(out, columns=columns)

    schema = "part int, block long, own boolean, hashes binary, lows binary, docs binary, starts binary, places binary"
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(send, schema)


def _first_words(texts: Texts) -> np.ndarray:
    """Number, within the block, of each row's first word."""
    counts = [np.zeros(0, np.int64)]
    for a, b in texts.chunks():
        _, _, row = spans(texts.data[texts.offsets[a] : texts.offsets[b]], texts.offsets[a : b + 1] - texts.offsets[a])
        counts.append(np.bincount(row, minlength=b - a))
    counts = np.concatenate(counts)
    return np.cumsum(counts) - counts


def repeated(messages: DataFrame) -> DataFrame:
    """block and places: first words of the block's windows that start earlier elsewhere."""

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [(b, p) for b, p, own in zip(pdf["block"], pdf["places"], pdf["own"], strict=True) if own]
        pdf = pdf[~pdf["own"]]
        if len(pdf):
            hashes = np.frombuffer(b"".join(pdf["hashes"]), np.uint64)
            lows = np.frombuffer(b"".join(pdf["lows"]), np.uint32)
            docs, starts = (np.concatenate([stretch(x) for x in pdf[c]]) for c in ("docs", "starts"))
            order = np.lexsort((starts, docs, lows, hashes))
            h, low, d, s = hashes[order], lows[order], docs[order], starts[order]
            new = np.ones(len(order), bool)
            new[1:] = (h[1:] != h[:-1]) | (low[1:] != low[:-1])
            first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
            later = np.zeros(len(order), bool)
            later[order] = (d != d[first]) | (s != s[first])
            at = 0
            for block, packed in zip(pdf["block"], pdf["places"], strict=True):
                places = stretch(packed)
                gone = places[later[at : at + len(places)]]
                at += len(places)
                if len(gone):
                    out.append((block, squeeze(gone)))
        return pd.DataFrame(out, columns=["block", "places"])

    return messages.groupBy("part").applyInPandas(group, "block long, places binary")


def kept_texts(blocks: DataFrame, found: DataFrame, size: int) -> DataFrame:
    """doc_id, n_words, n_removed and kept, the words that no such window covers."""

    def keep(key: tuple, block: pd.DataFrame, reply: pd.DataFrame) -> pd.DataFrame:
        texts = Texts(block["packed"].iloc[0])
        gone = np.concatenate([stretch(p) for p in reply["places"]]) if len(reply) else np.zeros(0, np.int64)
        out: list[tuple] = []
        words = 0
        ids = texts.doc_ids()
        for a, b in texts.chunks():
            data = texts.data[texts.offsets[a] : texts.offsets[b]]
            starts, ends, row = spans(data, texts.offsets[a : b + 1] - texts.offsets[a])
            depth = np.zeros(len(starts) + 1, np.int64)
            own = gone[(gone >= words) & (gone < words + len(starts))] - words
            np.add.at(depth, own, 1)
            np.add.at(depth, own + size, -1)
            stays = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
            lengths = ends[stays] - starts[stays] + 1
            padded = np.append(data, np.uint8(32))
            text = gather(padded, starts[stays], lengths)
            text[np.cumsum(lengths) - 1] = 32
            bounds = np.concatenate([[0], np.cumsum(np.bincount(row[stays], lengths, minlength=b - a)).astype(np.int64)])
            n = np.bincount(row, minlength=b - a)
            left = np.bincount(row[stays], minlength=b - a)
            raw = text.tobytes()
            for i in range(b - a):
                out.append((ids[a + i], int(n[i]), int(n[i] - left[i]), raw[bounds[i] : max(bounds[i], bounds[i + 1] - 1)].decode()))
            words += len(starts)
        frame = pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept"])
        return frame.astype({"doc_id": "Int64"})

    schema = "doc_id long, n_words long, n_removed long, kept string"
    return blocks.groupBy("block").cogroup(found.groupBy("block")).applyInPandas(keep, schema)


def without_repeats(spark: SparkSession, docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept (text) of each document."""
    area = WorkArea(spark)
    total = text_bytes(docs)
    slices = max(1, -(-total // SLICE_BYTES))
    blocks = packed_blocks(area, docs, total)
    replies = area.stage(merged(sketch(blocks, size, slices)), "estimates")
    found = area.stage(repeated(candidates(blocks, replies, size, slices)), "repeats")
    return kept_texts(blocks, found, size)


def op1_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_repeats(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
