"""Near-duplicates by SimHash, found through deletion variants.

A 64-bit fingerprint is cut into two halves. Of two fingerprints that differ in three bits at most, one half differs in
one bit at most, so the two agree in a variant of that half with one bit left out: 64 variants per fingerprint, joined
by equality and verified. A variant shared by very many fingerprints is cut again, the same way, by variants of the
quarters of its other half; what then agrees has at most 18 bits free, which bounds every group.

Cases: a null or empty text has no words and fingerprint 0; fewer than three words make one shingle; a null doc_id keeps
its row, and a component has the smallest id that isn't null; rows alike are one fingerprint; texts of any length are read whole, each
in one task; a bit that is set in exactly half the hashes is 0; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barograph.llm.graph import components, forest, roots
from barograph.session import WorkArea

SHINGLE, SEED, DISTANCE = 3, 42, 3
#: Fingerprints that share a variant are compared with each other up to this number, and cut again beyond it.
GROUP_LIMIT = 4096
PRINTS_PER_TASK = 20_000

_AT_ONCE = 1 << 15


def fingerprint(text: str | None) -> int:
    """SimHash of the 3-word shingles of a text, lower-cased in A-Z only, as an unsigned number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        hashes = map(xxhash.xxh64_intdigest, [b" ".join(words)], repeat(SEED))
    else:
        runs = zip(*[words[i:] for i in range(SHINGLE)], strict=False)
        hashes = map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(SEED))
    n = max(1, len(words) - SHINGLE + 1)
    hashes = np.fromiter(hashes, np.uint64, n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, _AT_ONCE):
        bits = np.unpackbits(hashes[i : i + _AT_ONCE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


_TEXTS_AT_ONCE = 256


@F.arrow_udf(T.LongType())
def fingerprints(texts: pa.Array) -> pa.Array:
    """Only some texts at a time become Python strings; a batch may hold ten thousand."""
    parts = (texts.slice(at, _TEXTS_AT_ONCE).to_pylist() for at in range(0, len(texts), _TEXTS_AT_ONCE))
    return pa.array(np.array([fingerprint(t) for part in parts for t in part], dtype=np.uint64).view(np.int64))


def variants(half: str, bits: int) -> list[str]:
    """SQL for the values of ``half`` with one of its lowest ``bits`` left out, each marked by the bit's number."""
    return [f"({half} & {((1 << bits) - 1) & ~(1 << i)}L) | ({i}L << 40)" for i in range(bits)]


def near_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between fingerprints of a group, from rows (k1, k2, fp) that come sorted by group; one forest per batch."""
    rest = np.zeros((0, 3), np.int64)

    def linked(rows: np.ndarray) -> pa.RecordBatch:
        found = []
        new = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
        sizes = np.diff(np.concatenate([[0], new, [len(rows)]]))
        end = np.repeat(np.concatenate([new, [len(rows)]]), sizes)
        prints = rows[:, 2].view(np.uint64)
        at = np.flatnonzero(np.arange(len(rows)) + 1 < end)
        step = 1
        while len(at):
            far = np.bitwise_count(prints[at] ^ prints[at + step])
            found.append((at[far <= DISTANCE], at[far <= DISTANCE] + step))
            if sum(len(x[0]) for x in found) > 1_000_000:
                found = [merged(len(rows), found)]
            step += 1
            at = at[at + step < end[at]]
        a, b = merged(len(rows), found) if found else (np.zeros(0, int),) * 2
        return pa.RecordBatch.from_arrays([pa.array(rows[a, 2]), pa.array(rows[b, 2])], ["a", "b"])

    def merged(n: int, found: list) -> tuple[np.ndarray, np.ndarray]:
        label = roots(n, *(np.concatenate(x) for x in zip(*found, strict=True)))
        own = np.flatnonzero(label != np.arange(n))
        return label[own], own

    for batch in batches:
        rows = np.concatenate([rest, np.stack([c.to_numpy() for c in batch.columns], axis=1)])
        last = (rows[:, :2] == rows[-1, :2]).all(axis=1) if len(rows) else np.zeros(0, bool)
        cut = len(rows) - int(last[::-1].argmin() if not last.all() else len(rows))
        if cut:
            yield linked(rows[:cut])
        rest = rows[cut:]
    if len(rest):
        yield linked(rest)


def links(area: WorkArea, prints: DataFrame, limit: int = GROUP_LIMIT) -> DataFrame:
    """Links a–b that join the distinct fingerprints ``fp`` of ``prints`` as all pairs within the distance would: a forest of each task."""
    # The table is small before each row becomes 64, so its tasks would be few and large.
    prints = prints.repartition(max(8, -(-prints.count() // PRINTS_PER_TASK)), "fp")
    high, low = "shiftrightunsigned(fp, 32)", "(fp & 4294967295L)"
    halves = [*variants(high, 32), *[f"({v}) | (1L << 48)" for v in variants(low, 32)]]
    keyed = prints.select(F.explode(F.expr(f"array({', '.join(halves)})")).alias("k1"), "fp")
    hot = area.stage(keyed.groupBy("k1").count().filter(F.col("count") > limit).select(F.col("k1").alias("hot")), "hot-variants")
    other = "if(k1 & (1L << 48) = 0, fp & 4294967295L, shiftrightunsigned(fp, 32))"
    quarters = [*variants(f"shiftright({other}, 16)", 16), *[f"({v}) | (1L << 48)" for v in variants(f"({other} & 65535L)", 16)]]
    if hot.isEmpty():
        grouped = keyed.withColumn("k2", F.lit(0).cast("long"))
    else:
        marked = keyed.join(hot, F.col("k1") == F.col("hot"), "left")
        plain = F.array(F.lit(0).cast("long"))
        grouped = marked.select("k1", F.explode(F.when(F.col("hot").isNull(), plain).otherwise(F.expr(f"array({', '.join(quarters)})"))).alias("k2"), "fp")
    grouped = grouped.select("k1", "k2", "fp").repartition("k1", "k2").sortWithinPartitions("k1", "k2")
    return grouped.mapInArrow(lambda batches: forest(near_pairs(batches)), "a long, b long")


def simhash_components(spark: SparkSession, docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """doc_id, fp (long), component_id (smallest doc_id reachable) and the columns ``carry`` of each document."""
    area = WorkArea(spark)
    own = [F.col(f"`{c}`").alias(f"_carry_{i}") for i, c in enumerate(carry or [])]
    prints = area.stage(docs.select("doc_id", fingerprints("text").alias("fp"), *own), "prints")
    distinct = area.stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    nodes = components(area, links(area, distinct), "simhash", forests=True)
    labels = distinct.join(nodes, F.col("fp") == F.col("node"), "left").select("fp", "first_id", F.coalesce("component", "fp").alias("c"))
    labels = area.stage(labels, "labels")
    least = labels.groupBy("c").agg(F.min("first_id").alias("component_id"))
    known = area.stage(labels.join(least, "c").select(F.col("fp").alias("_fp"), "component_id"), "components")
    return prints.join(known, F.col("fp") == F.col("_fp")).select(
        "doc_id", "fp", "component_id", *[F.col(f"_carry_{i}").alias(c) for i, c in enumerate(carry or [])]
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
