"""Mixing sources to target weights.

Every document gets a random key, a hash of its id. Within each source the documents are sorted by that key in
ranges, prefix sums of their sizes run across the ranges, and the source is cut where its budget ends. A budget
larger than the source repeats it in whole epochs before the cut.

Cases: a null text has size 0; texts of any length are counted whole; a null source is a source of its own, last in order; rows alike in key, id and size
share one place in the order, so reruns agree; a table without rows or without words has targets of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.llm.ranking import prefix_sums, ranged
from barograph.llm.words import WORD
from barograph.session import WorkArea

WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column) -> Column:
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))


def source_targets(area: WorkArea, sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """source, source_size and target of each source.

    A source's share of all words follows its weight, up to ``most`` times its size; what it can't take goes to the
    others by weight. Each round fixes the sources that reach their limit; only three numbers come to the driver.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = F.col("source").asc_nulls_last()
    one = F.lit(1).alias("one")
    ranked = prefix_sums(
        area, ranged(area, by_source, [order], "sources").drop("_range").withColumn("one", one), [], [order], "one", "ranked"
    )
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_before") % len(weights) + 1).cast("int"))
    table = area.stage(ranked.select("source", "source_size", weight.cast("double").alias("weight")), "weights")
    limit = F.col("source_size") * most
    unit, fixed = 0.0, -1
    while True:
        full = F.lit(unit) * F.col("weight") >= limit
        n, total, taken, rest = table.agg(
            F.count_if(full), F.sum("source_size"), F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if n == fixed or not rest:
            break
        fixed, unit = n, ((total or 0) - (taken or 0)) / rest
    return table.select("source", "source_size", F.least(F.lit(unit) * F.col("weight"), limit.cast("double")).alias("target"))


def mix_sources(
    spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, carry: list[str] | None = None
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (words), epochs (whole copies) and cut
    (words of one more, partial copy, null for none). ``carry`` names further columns of ``docs`` to keep.
    """
    area = WorkArea(spark)
    own = [F.col(f"`{c}`").alias(f"_carry_{i}") for i, c in enumerate(carry or [])]
    sizes = area.stage(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), *own), "sizes")
    targets = area.stage(source_targets(area, sizes, weights, most), "targets")
    order = [random_key(F.col("doc_id")), F.col("doc_id").asc_nulls_last(), F.col("size"), *[F.col(f"_carry_{i}") for i in range(len(own))]]
    placed = prefix_sums(area, sizes, ["source"], order, "size", "placed")
    t = targets.select(F.col("source").alias("_source"), "source_size", "target")
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("least(bigint(round(target)) div source_size, bigint(2147483647))")).otherwise(F.lit(0))
    left = F.col("budget") - F.col("epochs") * F.col("source_size")
    cut = F.greatest(F.lit(0), F.least(F.col("size"), left - F.col("_before")))
    return (
        placed.join(t, F.col("source").eqNullSafe(F.col("_source")))
        .withColumns({"budget": budget, "epochs": epochs.cast("long")})
        .withColumns({"cut": F.when(left > F.col("_before"), cut), "partial": cut})
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            (F.col("epochs") * F.col("size") + F.col("partial")).cast("long").alias("taken"),
            "epochs",
            "cut",
            *[F.col(f"_carry_{i}").alias(c) for i, c in enumerate(carry or [])],
        )
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(spark, docs).select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight
  FROM sized GROUP BY source
), sorted AS (
  SELECT *, 3.0 * source_size AS cap,
         coalesce(sum(3.0 * source_size) OVER w, 0) AS capped, sum(source_size) OVER () AS total,
         sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS weight_left,
         row_number() OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST) AS place
  FROM sources
  WINDOW w AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT coalesce(arg_min((total - capped) / weight_left, place), 0) AS unit
  FROM sorted WHERE (total - capped) / weight_left * weight < cap
), targets AS (
  SELECT source, source_size, least(unit * weight, cap) AS target FROM sorted, level
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(coalesce(CAST(s.doc_id AS VARCHAR), '')), s.doc_id, s.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0 ELSE
         CAST(CAST(round(target) AS BIGINT) // source_size * size
           + greatest(0, least(size, CAST(round(target) AS BIGINT) % source_size - before)) AS BIGINT) END AS taken
FROM placed
"""
