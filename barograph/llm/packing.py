"""Token ids packed into rows of fixed length.

Each document becomes its token ids and an end mark, cut into pieces of at most the row length. Pieces are dealt by hash
to groups of bounded size. In a group the longest piece goes first, into the row whose free space fits it best; a segment
tree over the free spaces finds that row. A row of the result holds the padded ids, the segments' cumulative lengths and
the positions, which start at 0 with every segment; doc_ids and pieces name each segment, so all texts can be restored.

Cases: a null or empty text is one piece, the end mark; a text longer than a row goes on in further pieces; documents
alike are packed each for itself; a null doc_id stays null; ties in length go by doc_id and piece; no rows give no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.llm.words import flat

ROW = 2048
#: Bytes of text per group, about two million tokens.
GROUP_BYTES = 8 << 20
#: Bytes of text that a task encodes at once; its tables take some fifty times as much.
_CHUNK = 1 << 20
#: Bytes of distinct words that are encoded as one text.
_TOGETHER = 1 << 19

ROWS = (
    "pack_id long, n_tokens int, n_segments int, doc_ids array<long>, pieces array<int>, "
    "cumulative_lengths array<int>, ids binary, positions binary"
)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Token ids of whole Arrow columns: every distinct word of a batch is encoded once.

    A text may be cut before a single blank or line feed between two characters that aren't white space: no token of
    the vocabulary's pattern spans such a place, so the ids of the parts are those of the whole.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.bpe = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.end = max(ranks.values()) + 1
        self.dtype = np.dtype("<u2") if self.end < 1 << 16 else np.dtype("<u4")
        self.sizes = np.zeros(self.end + 1, dtype=np.int64)
        self.sizes[list(ranks.values())] = list(map(len, ranks))

    @staticmethod
    def _solid(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes that are characters but no white space, that end a letter of two bytes, and that begin one of either.

        No white space begins with 0xC3 to 0xDF.
        """
        solid = (data > 32) & (data < 127)
        wide = (data >= 0xC3) & (data <= 0xDF)
        letter = np.zeros(len(data), dtype=bool)
        letter[1:] = wide[:-1] & (data[1:] >= 128)
        return solid, letter, solid | wide

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Starts of the parts, which are never in the midst of a document's token."""
        n = len(data)
        if n < 3:
            return np.unique(offsets[:-1][np.diff(offsets) > 0])
        blank = (data == 32) | (data == 10)
        solid, letter, leads = self._solid(data)
        cut = np.zeros(n, dtype=bool)
        cut[1:-1] = blank[1:-1] & (solid[:-2] | letter[:-2]) & leads[2:]
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        ends = offsets[1:] - 1  # a blank that ends a document stays with the word before it
        ends = ends[(ends >= 0) & (np.diff(offsets) > 1)]
        cut[ends[blank[ends]]] = False
        return np.flatnonzero(cut)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows end to end, without end marks, and the rows' offsets in them."""
        starts = self.cuts(data, offsets)
        if not len(starts):
            return np.zeros(0, self.dtype), np.zeros(len(offsets), np.int64)
        bounds = np.append(starts, len(data)).astype(np.int64)
        parts = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        which = parts.indices.to_numpy()
        ids, begin, count = self._distinct(parts.dictionary)
        count = count[which]
        ends = np.cumsum(count)
        out = ids[np.repeat(begin[which] - ends + count, count) + np.arange(int(ends[-1]))]
        rows = np.concatenate([[0], ends])[np.searchsorted(starts, offsets, side="left")]
        return out, rows

    def _distinct(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the parts, and where each part's begin and how many they are.

        Parts that can follow each other go to the encoder as one text; the sizes of its tokens tell them apart.
        """
        data, offsets = flat(parts)
        first, last = offsets[:-1], offsets[1:] - 1
        solid, letter, leads = self._solid(data)
        joins = ((data[first] == 32) | (data[first] == 10)) & (last > first)
        joins &= leads[np.minimum(first + 1, last)] & (solid | letter)[last]
        begin, count = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        found, held = [], 0
        together = np.flatnonzero(joins)
        text, bounds = flat(parts.take(pa.array(together)))
        at = 0
        while at < len(together):
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + _TOGETHER, side="right")) - 1)
            ids = np.array(self.bpe.encode_ordinary(text[bounds[at] : bounds[to]].tobytes().decode()), dtype=self.dtype)
            reach, ends = np.cumsum(self.sizes[ids]), bounds[at + 1 : to + 1] - bounds[at]
            stop = np.searchsorted(reach, ends) + 1
            if stop[-1] > len(reach) or (reach[stop - 1] != ends).any():
                raise ValueError("the vocabulary's tokens span words")
            count[together[at:to]] = np.diff(stop, prepend=0)
            begin[together[at:to]] = held + stop - count[together[at:to]]
            found.append(ids)
            held += len(ids)
            at = to
        alone = np.flatnonzero(~joins)
        for i, part in zip(alone.tolist(), parts.take(pa.array(alone)).to_pylist(), strict=True):
            ids = np.array(self.bpe.encode_ordinary(part.decode("utf-8", "replace")), dtype=self.dtype)
            begin[i], count[i] = held, len(ids)
            found.append(ids)
            held += len(ids)
        return np.concatenate(found), begin, count


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def token_pieces(docs: DataFrame, path: str, row: int = ROW) -> DataFrame:
    """doc_id, piece, n and ids (little-endian binary) of every piece of at most ``row`` tokens."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            data, offsets = flat(batch.column("text"))
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _CHUNK, side="right")) - 1)
                ids, ends = own.encode(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
                # Room for the end mark of every row.
                marked = np.full(len(ids) + to - at, own.end, dtype=own.dtype)
                marked[np.arange(len(ids)) + np.repeat(np.arange(to - at), np.diff(ends))] = ids
                begin, length = ends[:-1] + np.arange(to - at), np.diff(ends) + 1
                parts = -(-length // row)
                doc = np.repeat(np.arange(to - at), parts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
                start = begin[doc] + piece * row
                n = np.minimum(row, length[doc] - piece * row)
                bounds = np.append(start, len(marked)) * own.dtype.itemsize
                for i in range(0, len(doc), 4096):
                    j = min(i + 4096, len(doc))
                    blob = pa.py_buffer(marked.view(np.uint8)[bounds[i] : bounds[j]].copy())
                    cells = pa.BinaryArray.from_buffers(pa.binary(), j - i, [None, pa.py_buffer((bounds[i : j + 1] - bounds[i]).astype(np.int32)), blob])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(at + doc[i:j])), pa.array(piece[i:j], pa.int32()), pa.array(n[i:j], pa.int32()), cells],
                        ["doc_id", "piece", "n", "ids"],
                    )
                at = to

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, "doc_id long, piece int, n int, ids binary")


class FreeSpace:
    """Open rows by their free space. A node of the tree tells whether any row below it is open."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, row: int, space: int) -> None:
        if space == 0:
            return
        self.open[space].append(row)
        at = space + self.leaves
        while at:
            self.tree[at] += 1
            at >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """The open row of the smallest free space of at least ``least``, and that space."""
        at = least + self.leaves
        if not self.tree[at]:
            while at > 1 and (at & 1 or not self.tree[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.tree[2 * at] else 2 * at + 1
        space = at - self.leaves
        while at:
            self.tree[at] -= 1
            at >>= 1
        return self.open[space].pop(), space


def best_fit(lengths: list[int], row: int) -> list[list[int]]:
    """Rows of indexes; ``lengths`` must fall."""
    free, rows = FreeSpace(row), []
    for i, n in enumerate(lengths):
        found = free.take(n)
        if found is None:
            rows.append([i])
            free.put(len(rows) - 1, row - n)
        else:
            rows[found[0]].append(i)
            free.put(found[0], found[1] - n)
    return rows


def pack(docs: DataFrame, path: str | None = None, row: int = ROW, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Packed rows of ``docs`` (doc_id, text); see the module's head for the columns."""
    path = path or default_vocabulary()
    size = docs.select(F.sum(F.octet_length("text") + F.lit(1))).first()[0] or 0
    groups = max(1, -(-size // group_bytes))
    wide = 2 if encoder(path).end < 1 << 16 else 4

    def rows(key: tuple, group: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = pd.concat(list(group), ignore_index=True)
        pieces = pieces.sort_values(["n", "doc_id", "piece"], ascending=[False, True, True], kind="stable", na_position="last")
        ids, lengths = pieces["ids"].tolist(), pieces["n"].tolist()
        doc_ids = [None if pd.isna(d) else int(d) for d in pieces["doc_id"].tolist()]
        numbers = pieces["piece"].tolist()
        counting = np.arange(row, dtype="<u2" if row <= 1 << 16 else "<u4")
        step = counting.itemsize
        counting = counting.tobytes()
        out = []
        for k, members in enumerate(best_fit(lengths, row)):
            ends = np.cumsum([lengths[i] for i in members])
            pad = row - int(ends[-1])
            out.append(
                (
                    (int(key[0]) << 32) | k,
                    int(ends[-1]),
                    len(members),
                    [doc_ids[i] for i in members],
                    [numbers[i] for i in members],
                    [0, *ends.tolist()],
                    b"".join(ids[i] for i in members) + b"\0" * (wide * pad),
                    b"".join(counting[: step * lengths[i]] for i in members) + b"\0" * (step * pad),
                )
            )
            if len(out) == 500:
                yield pd.DataFrame(out, columns=[c.split()[0] for c in ROWS.split(", ")])
                out = []
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in ROWS.split(", ")])

    pieces = token_pieces(docs, path, row)
    spread = F.xxhash64(F.coalesce("doc_id", F.lit(-1).cast("long")), "piece", F.substring("ids", 1, 64))
    dealt = pieces.withColumn("part", F.pmod(spread, F.lit(groups)))
    return dealt.groupBy("part").applyInPandas(lambda key, pdf: pd.concat(list(rows(key, iter([pdf]))), ignore_index=True), ROWS)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
