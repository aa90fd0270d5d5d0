"""How far the word distributions of the sources of a language lie apart.

A term's share ``p`` in a group (a language and source) is a whole number of billionths, smoothed by one occurrence. The
distance of a group from another source adds ``f = (p - q)^2 / q``, rounded down, over all kept terms of the language.

The vocabulary is put in an order that brings terms of equal counts together: terms that have the same count in every
source become one line with a multiplicity, and the lines are range-sorted by their counts. In that order each group's column
of counts has long runs, zeros above all, and is kept as run lengths. For a pair of groups the ends of both columns' runs are
merged; on what lies between two ends both counts are constant, so ``f`` is computed once there and multiplied by the number
of terms. Every range of the order is a task of its own, whose sums per pair are added up afterwards; run lengths, not
terms or pairs of terms, decide the cost.

Counts are taken by whole Arrow columns, some megabytes of text at a time, and summed in tasks before they are shuffled.

Cases: null text, language and source count as empty; texts of any length are read whole, a batch of rows in one task; rows alike
count as documents of their own; a group or language without kept terms has distances of 0 and no terms; a language of one
source has no pairs; ties in value go by the item's UTF-8 bytes; no rows give no rows. All sums are of whole numbers, so neither
the order of rows nor the number of tasks changes them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barograph.llm.words import flat
from barograph.session import WorkArea

#: A term, in Spark's and DuckDB's regular expressions: letters of ASCII and whatever lies beyond ASCII.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UNIT, SMOOTHING, LEAST_DOCS, TOP = 1_000_000_000, 1, 3, 200
#: Text that is counted at once, and counts of the vocabulary per range.
CHUNK, COUNTS = 8 << 20, 200_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_TERM = np.array([b >= 128 or 97 <= b <= 122 for b in range(256)])


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The terms of ``flat`` texts one after the other, and the row of each."""
    low = _LOWER[data]
    inside = _IS_TERM[low]
    edge = np.zeros(len(low) + 1, dtype=bool)
    edge[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    lengths = np.flatnonzero(ends) + 1 - starts
    bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(low[inside])])
    return found, np.searchsorted(offsets, starts, side="right") - 1


def _counted(texts: pa.Array, group: np.ndarray) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
    """group, term, occurrences and documents, for some megabytes of text at a time."""
    data, offsets = flat(texts)
    at, rows = 0, len(offsets) - 1
    while at < rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, side="right")) - 1)
        terms, row = _terms(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        if len(terms):
            words = terms.dictionary_encode()
            code = words.indices.to_numpy().astype(np.int64)
            n = len(words.dictionary)
            in_row, times = np.unique(row * n + code, return_counts=True)  # a term and document
            of_group = group[at + in_row // n] * n + in_row % n
            keys, place = np.unique(of_group, return_inverse=True)
            yield keys // n, words.dictionary.take(pa.array(keys % n)), np.bincount(place, times).astype(np.int64), np.bincount(place)
        at = to


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang, source = batch.column("lang"), batch.column("source")
        pairs = pa.StructArray.from_arrays([lang, source], ["lang", "source"])
        names: dict[tuple, int] = {}
        group = np.array([names.setdefault(x, len(names)) for x in zip(lang.to_pylist(), source.to_pylist(), strict=True)], np.int64)
        first = np.unique(group, return_index=True)[1]
        for owner, term, count, docs in _counted(batch.column("text"), group):
            row = pairs.take(pa.array(first[owner]))
            columns = [row.field("lang"), row.field("source"), term.cast(pa.binary()), pa.array(count), pa.array(docs, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "count", "docs"])


def count_terms(docs: DataFrame) -> DataFrame:
    """lang, source, term, count (occurrences) and docs (rows with the term), each term of each group once."""
    texts = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")])
    found = texts.mapInArrow(_count_terms, "lang string, source string, term binary, count long, docs long")
    return found.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(UNIT * (count + 1) / (total + terms))`` by two steps of long division, since the product may not fit."""
    over, top = total + SMOOTHING * terms, count + SMOOTHING
    # Parts of five and four digits: right as long as a language has less than 9e13 occurrences and terms.
    high = F.call_function("div", top * 100_000, over)
    rest = top * 100_000 - high * over
    return 1 + high * 10_000 + F.call_function("div", rest * 10_000, over)


def _shares(count: np.ndarray, total: int, terms: int) -> np.ndarray:
    over, top = total + SMOOTHING * terms, count + SMOOTHING
    high, rest = np.divmod(top * 100_000, over)
    return 1 + high * 10_000 + rest * 10_000 // over


def run_lengths(lines: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and values of the runs of a column of ``n`` lines that holds ``counts`` at ``lines`` (rising) and 0 elsewhere."""
    gap = np.ones(len(lines) + 1, dtype=bool)  # zeros before an entry, and after the last
    gap[0] = len(lines) == 0 or lines[0] > 0
    gap[1:-1] = np.diff(lines) > 1
    gap[-1] = len(lines) == 0 or lines[-1] < n - 1
    before = np.concatenate([[-1], lines])[gap] + 1
    starts = np.concatenate([lines, before])
    values = np.concatenate([counts, np.zeros(len(before), np.int64)])
    order = np.argsort(starts, kind="stable")
    starts, values = starts[order], values[order]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    return starts[new], values[new]


def _distances(lines: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """What a range of the vocabulary adds to the distances of a language's groups.

    ``lines``: ``column`` (numbers of groups) and ``counts``, and ``terms``, how many terms are alike, in the range's order.
    """
    n = len(lines)
    ends = np.concatenate([[0], np.cumsum(lines["terms"].to_numpy())])
    sizes = [len(x) for x in lines["column"]]
    line = np.repeat(np.arange(n), sizes)
    column = np.concatenate([*lines["column"], np.zeros(0)]).astype(np.int64)
    counts = np.concatenate([*lines["counts"], np.zeros(0, np.int64)]).astype(np.int64)
    order = np.argsort(column, kind="stable")
    line, counts = line[order], counts[order]
    cut = np.searchsorted(column[order], groups["number"].to_numpy())
    until = np.searchsorted(column[order], groups["number"].to_numpy(), side="right")
    runs = []
    for a, b, total, terms in zip(cut, until, groups["total"], groups["kept"], strict=True):
        starts, values = run_lengths(line[a:b], counts[a:b], n)
        runs.append((starts, _shares(values, int(total), int(terms))))
    out = []
    for i, (starts, p) in enumerate(runs):
        for j in range(i):
            others, q = runs[j]
            begins = np.union1d(starts, others)
            mine = p[np.searchsorted(starts, begins, side="right") - 1]
            theirs = q[np.searchsorted(others, begins, side="right") - 1]
            times = np.diff(ends[np.append(begins, n)])
            square = (mine - theirs) ** 2
            out += [(i, j, int((square // theirs * times).sum())), (j, i, int((square // mine * times).sum()))]
    source = groups["source"].to_numpy()
    a, b, value = (np.array(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3
    lang = groups["lang"].iloc[0] if len(groups) else ""
    return pd.DataFrame({"lang": [lang] * len(value), "source": source[a.astype(int)], "item": source[b.astype(int)], "value": value.astype(np.int64)})


def pair_values(area: WorkArea, kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (another source of the language) and value, where a language keeps terms.

    ``kept``: lang, term, source and count. ``groups``: lang, source, number (from 1 within the language), total, kept.
    """
    numbered = kept.join(groups.select("lang", "source", "number"), ["lang", "source"])
    vectors = numbered.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("number", "count"))).alias("counts"))
    lines = area.stage(vectors.groupBy("lang", "counts").agg(F.count(F.lit(1)).alias("terms")), "lines")
    ranges = max(8, -(-(lines.agg(F.sum(F.size("counts"))).first()[0] or 0) // COUNTS))
    # Equal counts side by side: by language, then by the groups and their counts.
    ordered = area.stage(lines.repartitionByRange(ranges, "lang", "counts").withColumn("range", F.spark_partition_id()), "ranges")
    met = area.stage(ordered.select("range", "lang").distinct().join(groups, "lang").select("range", *groups.columns), "owners")

    def distances(key, lines: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
        """A range of one language."""
        lines = lines.sort_values("place", ignore_index=True)
        return _distances(lines, groups.sort_values("number", ignore_index=True))

    columns = ordered.select(
        "range", "lang", F.col("counts.number").alias("column"), F.col("counts.count").alias("counts"), "terms", F.struct("counts").alias("sorted")
    )
    place = F.row_number().over(Window.partitionBy("range", "lang").orderBy("sorted")).alias("place")
    columns = columns.select("range", "lang", "column", "counts", "terms", place)
    sums = (
        columns.groupBy("range", "lang")
        .cogroup(met.groupBy("range", "lang"))
        .applyInPandas(distances, "lang string, source string, item string, value long")
    )
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def source_divergence(spark: SparkSession, docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: every group's distance from each other source of its language (part ``pair``), and
    the terms that set it apart from its language most, ``top`` at most (part ``term``)."""
    area = WorkArea(spark)
    found = area.stage(count_terms(docs), "counts")
    names = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    terms = found.groupBy("lang", "term").agg(F.sum("docs").alias("in_docs"), F.sum("count").alias("in_lang"))
    terms = area.stage(terms.filter(F.col("in_docs") >= least_docs).select("lang", "term", "in_lang"), "terms")
    kept = area.stage(found.join(terms, ["lang", "term"]).select("lang", "term", "source", "count", "in_lang"), "kept")
    totals = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    langs = area.stage(terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("in_lang").alias("lang_total")), "langs")
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source"))
    groups = names.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "kept", "lang_total"])
    groups = area.stage(groups.withColumn("number", number), "groups")

    pairs = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").filter("source <> item")
    values = pair_values(area, kept.select("lang", "term", "source", "count"), groups.select("lang", "source", "number", "total", "kept"))
    pairs = pairs.join(values, ["lang", "source", "item"], "left").fillna(0, ["value"])
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))

    apart = kept.join(groups, ["lang", "source"])
    apart = apart.withColumn("p", share(F.col("count"), F.col("total"), F.col("kept"))).withColumn("q", share(F.col("in_lang"), F.col("lang_total"), F.col("kept")))
    apart = apart.filter("p > q").select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))
    apart = apart.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)
    return pairs.unionByName(apart.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), occurrences AS (
  SELECT doc, lang, source, unnest(terms) AS term FROM docs
), vocabulary AS (
  SELECT lang, term, count(*) AS n FROM occurrences GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
), langs AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM vocabulary GROUP BY lang
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM occurrences GROUP BY lang, source, term
), sources AS (
  SELECT DISTINCT lang, source FROM docs
), totals AS (
  SELECT c.lang, c.source, sum(c.n) AS total FROM counts c JOIN vocabulary USING (lang, term) GROUP BY c.lang, c.source
), filled AS (
  SELECT s.lang, s.source, w.term, coalesce(c.n, 0) AS n,
         CAST(1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (coalesce(t.total, 0) + l.v) AS HUGEINT) AS p,
         CAST(1 + 1000000000::HUGEINT * (w.n + 1) // (l.total + l.v) AS HUGEINT) AS q
  FROM sources s JOIN vocabulary w USING (lang) JOIN langs l USING (lang)
  LEFT JOIN totals t ON t.lang = s.lang AND t.source = s.source
  LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = w.term
), distances AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM filled a JOIN filled b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
), apart AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM filled WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM apart)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""
