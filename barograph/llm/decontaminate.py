"""Benchmark decontamination by spaced seeds.

Words are runs of letters and digits in lower case. A seed is a fixed mask over a window of words; it hashes the words at
its places and ignores the others, so a window with a word replaced at an ignored place still matches. Hashes of the
benchmark's windows and of the documents' windows meet in an equality join. Each meeting fixes an alignment of item and
document; along it, the longest overlap in which at least 80 % of the words agree is sought. The four masks together hit
every passage of 15 words with up to three words replaced.

A Bloom filter of fixed size keeps windows that no item has out of the join. It only saves work: if it were full, every
window would go to the join and the result would be the same.

An overlap counts if it spans 80 % of the item's words, or ``ENOUGH`` words of a longer item. Cases: null and empty texts
have no words; an item of fewer than ``LEAST`` words matches nothing; an item shorter than the longest mask also matches
by all its words in a row; a null doc_id or item_id stays null in the result; documents alike give rows alike; items that
are repeated under one id count once; texts of any length are read whole, each in one task; of overlaps of one length in
one alignment, any may stand for it, as only its length counts; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.llm.words import flat, mix, spans, word_hashes
from barograph.session import WorkArea

MASKS = ("110000111", "101100011", "1111001", "10010111")
SIMILARITY, LEAST, ENOUGH = 0.8, 5, 25
FILTER_BITS = 1 << 26

_GAP = np.ones(256, dtype=bool)
for _low, _high in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _GAP[_low:_high] = False
_CHUNK = 1 << 20


def words_of(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, word hashes and word offsets by row, for a megabyte of text at a time, which alone is lower-cased."""
    offsets = np.concatenate([[0], np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(), dtype=np.int64)])
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _CHUNK, side="right")) - 1)
        part, own = flat(pc.utf8_lower(texts.slice(at, to - at).cast(pa.large_string())))
        starts, ends, row = spans(part, own, _GAP)
        counts = np.bincount(row, minlength=to - at)
        yield at, word_hashes(part, starts, ends, 11, _GAP), np.concatenate([[0], np.cumsum(counts)])
        at = to


def seeds(mask_lengths: list[int]) -> list[np.ndarray]:
    """Places of every mask; after the fixed masks, one without gaps for each of the lengths."""
    return [np.flatnonzero(np.frombuffer(m.encode(), np.uint8) == 49) for m in MASKS] + [np.arange(n) for n in mask_lengths]


def seed_hashes(words: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The hash of every window under one mask."""
    n = max(0, len(words) - int(places[-1]))
    out = np.full(n, len(places), dtype=np.uint64)
    for p in places:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[p : p + n])
    return out


def _bits(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return hashes % np.uint64(FILTER_BITS), (hashes >> np.uint64(32)) % np.uint64(FILTER_BITS)


def _held(packed: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether each bit of the packed filter is set. Unpacked, the filter would take eight times as much in every worker."""
    return (packed[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1)).view(bool)


def item_words(items: DataFrame) -> DataFrame:
    """item_id and words (hashes) of each item."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, words, ends in words_of(batch.column("text")):
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(words.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("item_id").slice(at, len(ends) - 1), lists], ["item_id", "words"])

    read = items.select("item_id", "text").mapInArrow(rows, "item_id long, words array<long>")
    return read.filter(F.size("words") >= LEAST).distinct()


def item_seeds(items: DataFrame, short: list[int]) -> DataFrame:
    """item, place, seed and hash of every window of the items, and the item's number of words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, words in zip(batch.column("item").to_pylist(), batch.column("words"), strict=True):
                words = words.values.to_numpy().view(np.uint64)
                for k, places in enumerate(seeds(short)):
                    if k >= len(MASKS) and len(places) != len(words):
                        continue
                    h = seed_hashes(words, places)
                    place, n = np.arange(len(h), dtype=np.int32), np.full(len(h), len(words), np.int32)
                    columns = [np.full(len(h), item), place, np.full(len(h), k, np.int32), h.view(np.int64), n]
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["item", "item_place", "item_seed", "item_hash", "item_size"])

    return items.select("item", "words").mapInArrow(rows, "item long, item_place int, item_seed int, item_hash long, item_size int")


def hash_filter(item_hashes: DataFrame) -> bytes:
    """The packed Bloom filter; every task gives its own, of a fixed size, and they are united."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = _bits(batch.column("item_hash").to_numpy().view(np.uint64))
            at = np.unique(np.concatenate([first, second]).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(at)], ["bit"])

    words = (
        item_hashes.select("item_hash")
        .mapInArrow(rows, "bit long")
        .groupBy(F.expr("bit div 64").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, int(bit % 64))")).alias("bits"))
    )
    out = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    for row in words.toLocalIterator():  # no more than FILTER_BITS / 64 numbers, however large the benchmark
        out[row.word] = row.bits
    return out.tobytes()


def document_hits(docs: DataFrame, packed: bytes, short: list[int]) -> DataFrame:
    """doc_id, words and the windows that pass the filter, for documents that have any."""
    held = docs.sparkSession.sparkContext.broadcast(packed)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(held.value, np.uint8)
        for batch in batches:
            for at, words, ends in words_of(batch.column("text")):
                found = []
                for k, places in enumerate(seeds(short)):
                    h = seed_hashes(words, places)
                    first, second = _bits(h)
                    hit = np.flatnonzero(_held(bits, first))
                    hit = hit[_held(bits, second[hit])]
                    row = np.searchsorted(ends, hit, side="right") - 1
                    whole = hit + places[-1] < ends[row + 1]
                    found.append((row[whole], hit[whole], np.full(int(whole.sum()), k, np.int32), h[hit[whole]].view(np.int64)))
                row, place, seed, h = (np.concatenate(x) for x in zip(*found, strict=True))
                order = np.argsort(row, kind="stable")
                row, place, seed, h = row[order], place[order], seed[order], h[order]
                hit_rows, first = np.unique(row, return_index=True)
                if not len(hit_rows):
                    continue
                cuts = pa.array(np.append(first, len(row)), pa.int32())
                lengths = ends[hit_rows + 1] - ends[hit_rows]
                inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(ends[hit_rows], lengths)
                columns = [
                    batch.column("doc_id").take(pa.array(at + hit_rows)),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(words[inside].view(np.int64))),
                    *[pa.ListArray.from_arrays(cuts, pa.array(x)) for x in ((place - ends[row]).astype(np.int32), seed, h)],
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "words", "places", "seeds", "hashes"])

    schema = "doc_id long, words array<long>, places array<int>, seeds array<int>, hashes array<long>"
    return docs.select("doc_id", "text").mapInArrow(rows, schema)


def best_overlap(document: np.ndarray, item: np.ndarray, shifts: list[int]) -> tuple[int, int, int]:
    """Start in the document, length and number of equal words of the longest overlap along any of the alignments."""
    best = (0, 0, 0)
    for shift in sorted(set(shifts)):
        low, high = max(0, -shift), min(len(item), len(document) - shift)
        if high - low <= best[1]:
            continue
        same = document[low + shift : high + shift] == item[low:high]
        # Four steps back for a difference: a stretch that does not end lower than it began has 80 % equal words.
        height = np.concatenate([[0], np.cumsum(np.where(same, 1, -round(SIMILARITY / (1 - SIMILARITY))))])
        lowest = np.minimum.accumulate(height)
        begin = np.searchsorted(-lowest, -height, side="left")
        length = np.arange(len(height)) - begin
        end = int(length.argmax())
        if length[end] > best[1]:
            b = int(begin[end])
            while not same[b]:
                b += 1
            e = end
            while not same[e - 1]:
                e -= 1
            if e - b > best[1]:
                best = (low + shift + b, e - b, int(same[b:e].sum()))
    return best


def stretches() -> Column:
    """at, shifts and words of the parts of a document that an item can lie along: a part for each alignment, or one for all where
    that is shorter. Needs ``words`` of the document, ``shifts`` (alignments) and ``item_size``.
    """
    first = F.greatest(F.array_min("shifts"), F.lit(0))
    last = F.least(F.size("words"), F.array_max("shifts") + F.col("item_size"))

    def part(begin: Column, end: Column, shifts: Column) -> Column:
        return F.struct(begin.alias("at"), shifts.alias("shifts"), F.slice("words", begin + 1, end - begin).alias("words"))

    def along(shift: Column) -> Column:
        return part(F.greatest(shift, F.lit(0)), F.least(F.size("words"), shift + F.col("item_size")), F.array(shift))

    apart = F.size("shifts") * F.col("item_size") <= last - first
    return F.when(apart, F.transform("shifts", along)).otherwise(F.array(part(first, last, F.col("shifts"))))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep, found = [], []
        for i in range(batch.num_rows):
            item = batch.column("item_words")[i].values.to_numpy()
            start, length, equal = 0, 0, 0
            for part in batch.column("parts")[i].values:
                at, words = part["at"].as_py(), part["words"].values.to_numpy()
                place, n, same = best_overlap(words, item, [shift - at for shift in part["shifts"].as_py()])
                if n > length:
                    start, length, equal = at + place, n, same
            if length >= max(LEAST, min(ENOUGH, int(np.ceil(SIMILARITY * len(item))))):
                keep.append(i)
                found.append((start, length, equal, len(item)))
        if keep:
            at = pa.array(keep)
            columns = [batch.column(c).take(at) for c in ("_row", "doc_id", "item_id")] + [pa.array(x, pa.int32()) for x in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["_row", "doc_id", "item_id", "start_word", "n_words", "n_equal", "item_words"])


def contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document row and item that overlap: doc_id, item_id, start_word, n_words, n_equal, item_words."""
    area = WorkArea(spark)
    known = area.stage(item_words(items).withColumn("item", F.monotonically_increasing_id()), "items")
    longest = max(map(len, MASKS))
    short = sorted(r.n for r in known.select(F.size("words").alias("n")).filter(F.col("n") < longest).distinct().collect())
    hashes = area.stage(item_seeds(known, short), "item-seeds")
    hits = document_hits(docs, hash_filter(hashes), short).withColumn("_row", F.monotonically_increasing_id())
    hits = area.stage(hits, "hits")
    each = hits.select("_row", F.explode(F.arrays_zip("places", "seeds", "hashes")).alias("h")).select("_row", "h.*")
    met = each.join(hashes, (F.col("seeds") == F.col("item_seed")) & (F.col("hashes") == F.col("item_hash")))
    pairs = met.select("_row", "item", (F.col("places") - F.col("item_place")).alias("shift"), "item_size").distinct()
    pairs = pairs.groupBy("_row", "item", "item_size").agg(F.array_sort(F.collect_list("shift")).alias("shifts"))
    parts = pairs.join(hits.select("_row", "doc_id", "words"), "_row").select("_row", "doc_id", "item", stretches().alias("parts"))
    rows = parts.join(known.select("item", "item_id", F.col("words").alias("item_words")), "item")
    schema = "_row long, doc_id long, item_id long, start_word int, n_words int, n_equal int, item_words int"
    found = rows.select("_row", "doc_id", "item_id", "parts", "item_words").mapInArrow(_verify, schema)
    return found.drop("_row")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contaminated(spark, docs, items)
