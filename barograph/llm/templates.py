"""Removal of lines whose template recurs in many documents.

A tree of fixed depth parses the lines: first by their number of tokens, then by their first ``DEPTH`` tokens; a token
with a digit counts as a variable field on the way. In a leaf, a line joins the template that it is most similar to, if
at least ``SIMILARITY`` of its tokens are equal, and places at which they differ become variable. Lines are taken in order
of the number of documents that have them. A template that lines of ``DOCUMENTS`` or more documents follow recurs: its
lines are dropped from all documents but the one of the smallest id.

Only lines of leaves that recur themselves are gathered, once for each different line. A Bloom filter of fixed size keeps
most other lines back early; it decides nothing, since a join by leaf follows. A leaf with more than ``LEAF`` different
lines is dealt to parts by hash; each is parsed by itself, and the parts' templates, as lines with their variable places,
are parsed once more by the same rule. So a task gathers the lines of a part or the templates of a leaf.

Cases: a null or empty text has no lines; lines of fewer than ``TOKENS`` tokens always stay; a null doc_id counts as the
largest; rows alike count as one document and are treated alike; very long texts are read whole, each in one task, and very long lines are lines like
any others; of equally frequent lines the one with the smaller hash is placed first in its leaf, and of equally similar templates the first
one takes a line; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.llm.words import flat, mix, ragged, spans, word_hashes
from barograph.session import WorkArea

DEPTH, SIMILARITY, TOKENS, DOCUMENTS, LEAF = 4, 0.7, 3, 5, 1000
FILTER_BITS = 1 << 26
_CHUNK = 2 << 20


class Lines:
    """The lines, with ``TOKENS`` tokens at least, of some texts laid end to end."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        breaks = np.flatnonzero(data == 10)
        starts, ends, row = spans(data, offsets)
        tokens = word_hashes(data, starts, ends, 29)
        digits = np.concatenate([[0], np.cumsum((data >= 48) & (data <= 57))])
        variable = digits[ends] > digits[starts]
        line = np.searchsorted(breaks, starts)  # across rows; a row's lines follow from its first
        new = np.ones(len(starts), bool)
        new[1:] = (line[1:] != line[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        length = np.diff(first, append=len(starts))
        long = length >= TOKENS
        self.first, self.length = first[long], length[long]
        self.row = row[self.first]
        self.number = line[self.first] - np.searchsorted(breaks, offsets[:-1])[self.row]
        self.tokens = np.where(variable, np.uint64(0), tokens)

    def key(self, depth: int) -> np.ndarray:
        """Hash of the number of tokens and of the first ones."""
        out = mix(self.length.astype(np.uint64) + np.uint64(depth << 32))
        for j in range(depth):
            has = self.length > j
            out[has] = mix(out[has] * np.uint64(0x9E3779B97F4A7C15) + self.tokens[self.first[has] + j])
        return out

    def whole(self) -> np.ndarray:
        """Hash of all tokens."""
        if not len(self.first):
            return np.zeros(0, np.uint64)
        at = ragged(self.first, self.length)
        place = at - np.repeat(self.first, self.length)
        begins = np.cumsum(self.length) - self.length
        return mix(np.add.reduceat(mix(self.tokens[at] + place.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)), begins))


def _lines(texts: pa.Array) -> Iterator[tuple[int, int, Lines]]:
    data, offsets = flat(texts)
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _CHUNK, side="right")) - 1)
        yield at, to, Lines(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and digest; doc_id and digest tell different documents apart."""
    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64(F.col("text").isNull(), "text").alias("digest"))


def recurring_leaves(docs: DataFrame, least: int) -> DataFrame:
    """leaf: keys of the leaves that lines of ``least`` rows or more reach."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, lines in _lines(batch.column("text")):
                pairs = np.unique(np.stack([lines.row.astype(np.uint64), lines.key(DEPTH)]), axis=1)
                leaf, n = np.unique(pairs[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(leaf.view(np.int64)), pa.array(n)], ["leaf", "n"])

    counted = docs.select("text").mapInArrow(rows, "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= least).select("leaf")


def leaf_filter(leaves: DataFrame) -> bytes:
    """A bit for each leaf; no more than FILTER_BITS / 64 numbers come to the driver, however many leaves there are."""
    bit = F.pmod("leaf", F.lit(FILTER_BITS)).alias("bit")
    words = leaves.select(bit).groupBy(F.expr("bit div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(bit % 64))")).alias("bits"))
    out = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    for row in words.toLocalIterator():
        out[row.word] = row.bits
    return out.tobytes()


def candidate_lines(docs: DataFrame, packed: bytes) -> DataFrame:
    """doc_id, digest, number, leaf, whole and tokens (hashes) of the lines that pass the filter."""
    held = docs.sparkSession.sparkContext.broadcast(packed)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(held.value, np.uint8), bitorder="little").view(bool)
        for batch in batches:
            for at, _, lines in _lines(batch.column("text")):
                leaf = lines.key(DEPTH).view(np.int64)
                own = np.flatnonzero(bits[np.mod(leaf, FILTER_BITS)])
                cells = lines.tokens[ragged(lines.first[own], lines.length[own])]
                bounds = np.concatenate([[0], np.cumsum(lines.length[own])]) * 8
                tokens = pa.BinaryArray.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(cells)])
                take = pa.array(at + lines.row[own])
                columns = [
                    batch.column("doc_id").take(take),
                    batch.column("digest").take(take),
                    pa.array(lines.number[own], pa.int32()),
                    pa.array(leaf[own]),
                    pa.array(lines.whole()[own].view(np.int64)),
                    tokens,
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "number", "leaf", "whole", "tokens"])

    schema = "doc_id long, digest long, number int, leaf long, whole long, tokens binary"
    return docs.select("doc_id", "digest", "text").mapInArrow(rows, schema)


def similar(tokens: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The template of each line (row of ``tokens``), numbered from 0, and the templates' tokens, 0 for variable ones.

    Lines come in order of precedence.
    """
    n = tokens.shape[1]
    forms = np.zeros_like(tokens)
    fixed = np.zeros(tokens.shape, bool)
    out = np.zeros(len(tokens), np.int64)
    count = 0
    for i, line in enumerate(tokens):
        same = (forms[:count] == line) & fixed[:count]
        score = same.sum(axis=1)
        best = int(score.argmax()) if count else 0
        if count and score[best] >= least * n:
            fixed[best] &= same[best]
            out[i] = best
        else:
            forms[count], fixed[count] = line, line != 0  # variable fields are no part of the likeness
            out[i] = count
            count += 1
    return out, np.where(fixed, forms, np.uint64(0))[:count]


def templates(area: WorkArea, distinct: DataFrame, leaf_limit: int = LEAF) -> DataFrame:
    """whole, leaf and template (hash) of each different line; ``distinct`` has leaf, whole, tokens and n."""

    def parse(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "whole"], ascending=[False, True], kind="stable")
        own, forms = similar(np.stack([np.frombuffer(t, np.uint64) for t in pdf["tokens"]]), SIMILARITY)
        _, first = np.unique(own, return_index=True)
        whole, form = pdf["whole"].to_numpy(), np.full(len(pdf), None, object)
        form[first] = [f.tobytes() for f in forms]
        return pd.DataFrame({"leaf": pdf["leaf"], "whole": whole, "template": whole[first][own], "n": pdf["n"], "form": form})

    schema = "leaf long, whole long, template long, n long, form binary"
    parts = F.ceil(F.count(F.lit(1)) / leaf_limit).cast("int").alias("parts")
    wide = area.stage(distinct.groupBy("leaf").agg(parts).filter("parts > 1"), "wide")
    part = F.coalesce(F.pmod(F.xxhash64("whole"), F.col("parts")), F.lit(0)).alias("part")
    dealt = distinct.join(wide, "leaf", "left").select("leaf", "whole", "tokens", "n", part)
    parsed = area.stage(dealt.groupBy("leaf", "part").applyInPandas(parse, schema), "parsed")
    heads = parsed.filter("form IS NOT NULL").join(wide, "leaf", "left_semi")
    heads = heads.select("leaf", F.col("template").alias("whole"), F.col("form").alias("tokens"), "n")
    merged = heads.groupBy("leaf").applyInPandas(parse, schema).select("leaf", F.col("whole").alias("template"), F.col("template").alias("common"))
    joined = parsed.select("leaf", "whole", "template").join(merged, ["leaf", "template"], "left")
    return joined.select("leaf", "whole", F.coalesce("common", "template").alias("template"))


def _dropped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, lines, gone = [], [], []
        for text, numbers in zip(batch.column("text").to_pylist(), batch.column("numbers").to_pylist(), strict=True):
            own = text.split("\n") if text else []
            drop = set(numbers or [])
            kept.append("\n".join(x for i, x in enumerate(own) if i not in drop))
            lines.append(len(own))
            gone.append(len(drop))
        columns = [batch.column("doc_id"), pa.array(lines, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_lines", "n_dropped", "kept"])


def without_recurring_lines(
    spark: SparkSession, docs: DataFrame, least: int = DOCUMENTS, leaf_limit: int = LEAF
) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept (text) of each document."""
    area = WorkArea(spark)
    docs = keyed(docs)
    leaves = area.stage(recurring_leaves(docs, least), "leaves")
    lines = candidate_lines(docs, leaf_filter(leaves)).join(leaves, "leaf", "left_semi").distinct()
    lines = area.stage(lines, "lines")
    distinct = lines.groupBy("leaf", "whole").agg(F.first("tokens").alias("tokens"), F.count_distinct("doc_id", "digest").alias("n"))
    found = area.stage(templates(area, area.stage(distinct, "distinct"), leaf_limit), "templates")
    placed = lines.select("doc_id", "digest", "number", "leaf", "whole").join(found, ["leaf", "whole"])
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("digest").alias("digest"))
    per_document = placed.groupBy("leaf", "template", "doc_id", "digest").agg(F.lit(1).alias("one"))
    recurs = per_document.groupBy("leaf", "template").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first")).filter(F.col("n") >= least)
    recurs = area.stage(recurs.select("leaf", "template", "first"), "recurring")
    gone = placed.join(recurs, ["leaf", "template"]).filter(order != F.col("first"))
    numbers = gone.groupBy(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).agg(F.collect_set("number").alias("numbers"))
    numbers = area.stage(numbers, "dropped")
    joined = docs.join(numbers, (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    return joined.select("doc_id", "text", "numbers").mapInArrow(_dropped, "doc_id long, n_lines long, n_dropped long, kept string")


def op2_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_recurring_lines(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
