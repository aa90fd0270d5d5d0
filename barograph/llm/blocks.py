"""Documents in compressed blocks, and messages between blocks and groups of keys.

Operators that look for repeats all over a corpus take turns: every block tells each group of keys which keys it has, and
the group answers each block which of them matter. Blocks are of bounded size and stay where they are, in a table
bucketed by block, so only messages are shuffled and the texts are not.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.llm.words import flat, ragged
from barograph.session import WorkArea

BLOCK_BYTES = 8 << 20
#: Stands for a null doc_id, which counts as the largest.
NO_ID = np.iinfo(np.int64).max


def squeeze(values: np.ndarray) -> bytes:
    """Whole numbers of at most 64 bits, compressed well if neighbours are close."""
    values = values.astype(np.int64)
    steps = np.diff(values, prepend=0)
    planes = np.ascontiguousarray(((steps << 1) ^ (steps >> 63)).view(np.uint8).reshape(-1, 8).T)
    rest = zstandard.compress(planes[1:].tobytes(), 1)
    low = zstandard.compress(planes[0].tobytes(), 1)
    return np.array([len(values), len(low)], np.int64).tobytes() + low + rest


def stretch(packed: bytes) -> np.ndarray:
    """The numbers that ``squeeze`` was given."""
    n, size = np.frombuffer(packed, np.int64, 2)
    if not n:
        return np.zeros(0, np.int64)
    planes = zstandard.decompress(packed[16 : 16 + size]) + zstandard.decompress(packed[16 + size :])
    steps = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, n).T).view(np.uint64).ravel()
    steps = (steps >> np.uint64(1)).view(np.int64) ^ -(steps & np.uint64(1)).view(np.int64)
    return np.cumsum(steps)


def _close(ids: list[np.ndarray], valid: list[np.ndarray], sizes: list[np.ndarray], texts: list[bytes]) -> pa.RecordBatch:
    doc_id, known, size = np.concatenate(ids), np.concatenate(valid), np.concatenate(sizes)
    head = np.array([len(doc_id)], np.int64).tobytes() + doc_id.tobytes() + size.tobytes() + known.astype(np.uint8).tobytes()
    packed = zstandard.compress(head + b"".join(texts), 3)
    return pa.RecordBatch.from_arrays([pa.array([len(doc_id)], pa.int64()), pa.array([packed], pa.binary())], ["rows", "packed"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for batch in batches:
        data, offsets = flat(batch.column("text"))
        column = batch.column("doc_id")
        known = column.is_valid().to_numpy(zero_copy_only=False)
        ids = column.fill_null(NO_ID).to_numpy()
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES - size, side="right")) - 1)
            held.append((ids[at:to], known[at:to], np.diff(offsets[at : to + 1]), data[offsets[at] : offsets[to]].tobytes()))
            size += int(offsets[to] - offsets[at])
            at = to
            if size >= 0.9 * BLOCK_BYTES or len(held) >= 1000:
                yield _close(*zip(*held, strict=True))
                held, size = [], 0
    if held:
        yield _close(*zip(*held, strict=True))


class Texts:
    """The documents of a block, in order of doc_id."""

    def __init__(self, packed: bytes):
        raw = np.frombuffer(zstandard.decompress(packed), np.uint8)
        n = int(raw[:8].view(np.int64)[0])
        ids, sizes = raw[8 : 8 + 8 * n].view(np.int64), raw[8 + 8 * n : 8 + 16 * n].view(np.int64)
        known, data = raw[8 + 16 * n : 8 + 17 * n].astype(bool), raw[8 + 17 * n :]
        order = np.lexsort((~known, ids))
        begin = np.cumsum(sizes) - sizes
        self.ids, self.known = ids[order], known[order]
        self.offsets = np.concatenate([[0], np.cumsum(sizes[order])])
        self.data = np.empty_like(data)
        for i, b, e in zip(order.tolist(), self.offsets[:-1].tolist(), self.offsets[1:].tolist(), strict=True):
            self.data[b:e] = data[begin[i] : begin[i] + e - b]

    def doc_ids(self) -> list[int | None]:
        return [int(d) if k else None for d, k in zip(self.ids, self.known, strict=True)]

    def chunks(self, size: int = 1 << 21) -> Iterator[tuple[int, int]]:
        """Ranges of rows of about ``size`` bytes."""
        at, rows = 0, len(self.ids)
        while at < rows:
            to = max(at + 1, int(np.searchsorted(self.offsets, self.offsets[at] + size, side="right")) - 1)
            yield at, to
            at = to


def text_bytes(docs: DataFrame) -> int:
    return docs.select(F.sum(F.octet_length("text"))).first()[0] or 0


def packed_blocks(area: WorkArea, docs: DataFrame, size: int) -> DataFrame:
    """block (long), rows and packed: the documents' ids and texts, ``size`` bytes in all, bucketed by block."""
    spark = area.spark
    buckets = max(12, -(-size // (3 * BLOCK_BYTES)))
    packed = docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(_pack, "rows long, packed binary")
    name = f"barograph_blocks_{uuid.uuid4().hex}"
    (
        packed.select(F.monotonically_increasing_id().alias("block"), "rows", "packed")
        .write.bucketBy(buckets, "block")
        .option("path", f"{area.path}/{name}")
        .option("compression", "uncompressed")
        .saveAsTable(name)
    )
    blocks = spark.table(name)
    blocks.schema  # noqa: B018  the plan holds the files from here on
    spark.sql(f"DROP TABLE {name}")  # of the catalogue only; the files go with the work area
    return blocks


def gather(data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return data[ragged(begins, lengths)]
