"""How filters work together, over every order in which they could be applied.

Each document is reduced to the set of filters that it fails, a mask; documents of one mask and part share one row of
counts. In an order, a document goes at the first filter of its mask. The orders are numbered as permutations sort, by
Lehmer code, so all orders that begin alike are neighbours: for a mask and a step, the orders in which the mask goes at
that step make up a few intervals of numbers. Counts are added where an interval begins and taken off where it ends, and a
running sum over the orders gives what every step of every order removes. Only masks and intervals meet, never documents
and orders.

Whether a text stands in a row of smaller doc_id is found by grouping hashes of whole texts (SHA-256). Copies are counted
before they are shuffled, so a text that a third of all rows hold arrives as some rows per task.

Cases: a null text counts as empty, a null part as the empty string; texts of any length are read whole, each in one row of one
task; rows of one doc_id and one text are no copies of each other, as neither id is smaller; a null doc_id counts as the
largest and has no labels; of several labels of a document, 1 prevails; documents without labels count in ``kept`` and
``removed`` only; no rows give no rows. There are no ties: all counts are exact.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barograph.llm.words import WORD
from barograph.session import WorkArea

#: With more, the table of intervals and the result would have millions of rows.
MOST_FILTERS = 7
COUNTS = ("n", "good", "toxic")


def order_names(letters: str) -> list[str]:
    """All orders of the filters; an order's place in the list is its number."""
    return ["".join(p) for p in itertools.permutations(sorted(letters))]


def intervals(n: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, begin, end): in the orders begin to end - 1 of ``n`` filters, the mask goes at the step."""
    found: dict[tuple[int, int], list[list[int]]] = {}

    def extend(prefix: list[int], passed: int, begin: int) -> None:
        """``passed``: filters of the prefix but its last; ``begin``: the first order that starts with the prefix."""
        step, last = len(prefix), 1 << prefix[-1]
        width = math.factorial(n - step)
        for mask in range(1 << n):
            if mask & last and not mask & passed:
                known = found.setdefault((mask, step), [])
                if known and known[-1][1] == begin:
                    known[-1][1] = begin + width
                else:
                    known.append([begin, begin + width])
        rest = [x for x in range(n) if x not in prefix]
        for k, x in enumerate(rest):
            extend([*prefix, x], passed | last, begin + k * width // len(rest))

    for x in range(n):
        extend([x], 0, x * math.factorial(n - 1))
    return [(mask, step, *ends) for (mask, step), known in found.items() for ends in known]


def masks(docs: DataFrame, labels: DataFrame, filters: dict[str, Column], copies: str | None, part: str = "lang") -> DataFrame:
    """part, mask (bit k: it fails the k-th filter by name), n, good and toxic: documents alike in part and mask.

    ``filters`` are conditions on the column ``text``, true where a document fails; ``copies`` names the filter that texts of
    a smaller doc_id fail.
    """
    names = sorted([*filters, *([copies] if copies else [])])
    failed = sum((F.when(filters[x], 1 << k).otherwise(0) for k, x in enumerate(names) if x in filters), F.lit(0))
    rows = docs.select("doc_id", F.coalesce(part, F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "part", failed.alias("mask"), F.unhex(F.sha2("text", 256)).alias("hash"))
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id"))
    known = known.agg(*[F.max(F.when(F.col(x) == 1, 1).otherwise(0)).alias(y) for x, y in (("quality", "good"), ("toxic", "toxic"))])
    marks = [F.coalesce(x, F.lit(0)).alias(x) for x in ("good", "toxic")]
    rows = rows.join(known, F.col("doc_id") == F.col("_id"), "left").select("doc_id", "part", "mask", "hash", *marks)
    alike = ["hash", "mask", "part", "good", "toxic"]
    # Rows of one id first, so that the smallest id of a group comes with the number of its rows.
    units = rows.groupBy("doc_id", *alike).agg(F.count(F.lit(1)).alias("n"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "n"))
    texts = units.groupBy(*alike).agg(least.alias("least"), F.sum("n").alias("n"))
    if copies:
        own = F.struct("least.none", "least.doc_id")
        first = F.min(own).over(Window.partitionBy("hash"))  # a row per part and label
        firsts = F.when(own.eqNullSafe(first), F.col("least.n")).otherwise(0)
        bit = 1 << names.index(copies)
        both = F.array(F.struct("mask", F.col("firsts").alias("n")), F.struct((F.col("mask") + bit).alias("mask"), (F.col("n") - F.col("firsts")).alias("n")))
        texts = texts.withColumn("firsts", firsts).select("part", "good", "toxic", F.inline(both)).filter("n > 0")
    sums = [F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")]
    return texts.groupBy("part", "mask").agg(*sums)


def interactions(spark: SparkSession, masked: DataFrame, letters: str) -> DataFrame:
    """For each part, order and step of the filters ``letters``: what stays and goes. ``masked`` is as from ``masks``, stored."""
    letters = "".join(sorted(letters))
    n, orders = len(letters), order_names(letters)
    if n > MOST_FILTERS:
        raise ValueError(f"at most {MOST_FILTERS} filters")
    # Constants of n: the intervals, and the grid of orders and steps.
    ranges = spark.createDataFrame(intervals(n), "mask int, step int, begin int, end int")
    grid = spark.createDataFrame(
        [(rank, step, order, order[step - 1]) for rank, order in enumerate(orders) for step in range(1, n + 1)],
        "rank int, step int, filter_order string, filter string",
    )
    parts = masked.groupBy("part").agg(
        F.sum("n").alias("total"),
        F.map_from_arrays(
            F.array(*map(F.lit, letters)),
            F.array(
                *[
                    F.struct(
                        F.sum(F.when(F.col("mask").bitwiseAND(1 << k) > 0, F.col("n")).otherwise(0)).alias("fails"),
                        F.sum(F.when(F.col("mask") == 1 << k, F.col("n")).otherwise(0)).alias("alone"),
                    )
                    for k in range(n)
                ]
            ),
        ).alias("by_filter"),
    )
    met = masked.join(F.broadcast(ranges), "mask")
    ends = F.array(
        F.struct(F.col("begin").alias("rank"), *[F.col(c) for c in COUNTS]),
        F.struct(F.col("end").alias("rank"), *[(-F.col(c)).alias(c) for c in COUNTS]),
    )
    steps = met.select("part", "step", F.inline(ends))
    every = parts.select("part", F.explode(F.sequence(F.lit(0), F.lit(n * len(orders) - 1))).alias("at"))
    every = every.select("part", (F.col("at") % n + 1).cast("int").alias("step"), F.expr(f"int(at div {n})").alias("rank"), *[F.lit(0).cast("long").alias(c) for c in COUNTS])
    changes = steps.unionByName(every).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in COUNTS])
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    gone = changes.select("part", "step", "rank", *[F.sum(c).over(along).alias(c) for c in COUNTS])
    gone = gone.join(F.broadcast(grid), ["rank", "step"])
    within = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    gone = gone.withColumn("so_far", F.sum("n").over(within)).withColumn("shapley", F.sum("n").over(Window.partitionBy("part", "filter")))
    own = F.col("by_filter")[F.col("filter")]
    return gone.join(parts, "part").select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.col("so_far")).alias("kept"),
        F.col("n").alias("removed"),
        (own["fails"] - F.col("n")).alias("redundant"),
        own["alone"].alias("unique_fails"),
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        "shapley",
    )


def audit_filters(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, filters: dict[str, Column], copies: str | None = None, part: str = "lang"
) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley, for every part of
    ``docs``, every order of the filters (one letter each) and every step of it."""
    found = WorkArea(spark).stage(masks(docs, labels, filters, copies, part), "masks")
    return interactions(spark, found, "".join([*filters, *([copies] if copies else [])]))


def text_filters() -> dict[str, Column]:
    """Few words, few different words, many capitals, marks of code or markup."""
    text = F.col("text")
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 10 * F.char_length(text).cast("long"),
        "D": text.rlike(r"[#$%&*|]"),
    }


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return audit_filters(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), text_filters(), copies="E")


OP13_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), failing AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) OR (doc_id IS NULL AND count(doc_id) OVER (PARTITION BY t) > 0) THEN 'E' ELSE '' END AS fails
  FROM texts LEFT JOIN marks USING (doc_id)
), masks AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY part, fails
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS earlier
  FROM orders, range(1, 6) r(step)
), gone AS (
  SELECT part, fails, n, good, toxic, filter_order, step, letter,
         contains(fails, letter) AS failing,
         contains(fails, letter) AND translate(fails, earlier, '') = fails AS here,
         translate(fails, earlier || letter, '') = fails AS stays
  FROM masks, steps
), summed AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN stays THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN here THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN failing AND NOT here THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = letter THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN here THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN here THEN toxic ELSE 0 END) AS toxic_lost
  FROM gone GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM summed
"""
