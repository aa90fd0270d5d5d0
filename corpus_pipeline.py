"""The corpus pipeline: quality, near-duplicates, benchmark passages, mixing, packed tokens.

Cases, for all stages: a null text counts as empty, a null source as a source of its own; rows are told apart by all their
columns, so a repeated or null doc_id does no harm; texts of any length are handled whole, each in one task; a stage that is given
no rows returns none; further columns of the documents are left behind. What decides ties is said at each stage.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barograph.llm import classifier, decontaminate, mixing, packing, simhash
from barograph.llm.words import flat, spans
from barograph.session import WorkArea

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def row_key() -> Column:
    """Tells rows apart that differ in any column; rows alike share it."""
    return F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), F.md5("text"), "lang", F.col("source").isNull(), "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on all labelled documents of the corpus, does not reject; a score of exactly 0.5 stays."""
    model = classifier.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = classifier.classify(docs.select(*COLUMNS, F.col("text").alias("_read")), model, "_score")
    return kept.filter("_score >= 0.5").select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of the smallest id; of several rows of that id, the first by hash.

    Near means 3 of 64 bits over shingles of three words. Copies in which a few words differ are often further apart and stay.
    """
    keyed = docs.select(*COLUMNS, row_key().alias("_key"))
    found = simhash.simhash_components(spark, keyed, carry=["_key"])
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    group = F.struct("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("fp"))
    first = found.filter(stays).groupBy(group).agg(F.min("_key").alias("_first"))
    area = WorkArea(spark)
    chosen = area.stage(first.select("_first").distinct(), "stays")
    kept = keyed.join(chosen, F.col("_key") == F.col("_first"), "left_semi")
    if kept.groupBy("_key").count().filter("count > 1").isEmpty():
        return kept.select(*COLUMNS)
    return kept.dropDuplicates(["_key"]).select(*COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark; a text without words shares none."""
    keyed = docs.select(*COLUMNS, row_key().alias("_key"))
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contaminated(spark, keyed.select(F.col("_key").alias("doc_id"), "text"), items)
    hit = WorkArea(spark).stage(found.select(F.col("doc_id").alias("_hit")).distinct(), "contaminated")
    return keyed.join(hit, F.col("_key") == F.col("_hit"), "left_anti").select(*COLUMNS)


@F.arrow_udf(T.StringType())
def first_words(texts: pa.Array, counts: pa.Array) -> pa.Array:
    """The texts up to the end of their word number ``counts``, which is at least 1 and at most their number of words."""
    data, offsets = flat(texts)
    _, ends, row = spans(data, offsets)
    last = np.searchsorted(row, np.arange(len(texts))) + counts.to_numpy(zero_copy_only=False) - 1
    return pa.array([data[offsets[i] : ends[j]].tobytes().decode() for i, j in enumerate(last)], pa.string())


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document's whole copies, and where its source's budget ends within it, its first words.

    Texts without words take nothing of the budget and go along where their place in the order is taken. Rows alike share one
    place and are taken together.
    """
    keyed = docs.select(*COLUMNS, row_key().alias("_key"))
    taken = mixing.mix_sources(spark, keyed, carry=["_key"])
    units = taken.groupBy("_key").agg(
        F.sum("epochs").alias("_whole"),
        F.sum(F.when(F.col("cut") == F.col("size"), 1).otherwise(0)).alias("_more"),
        F.max(F.when(F.col("cut") < F.col("size"), F.col("cut"))).alias("_cut"),
        F.count(F.lit(1)).alias("_rows"),
    )
    units = units.select(F.col("_key").alias("_unit"), (F.col("_whole") + F.col("_more")).alias("_copies"), "_cut", "_rows")
    area = WorkArea(spark)
    units = area.stage(units, "mix")
    # Rows alike stand once for all of them.
    many = area.stage(units.filter("_rows > 1").select("_unit"), "alike")
    if not many.isEmpty():
        alike = keyed.join(many, F.col("_key") == F.col("_unit"), "left_semi").dropDuplicates(["_key"])
        keyed = keyed.join(many, F.col("_key") == F.col("_unit"), "left_anti").unionByName(alike)
    copies = area.stage(units.filter("_copies > 0").select("_unit", F.col("_copies").cast("int")), "copies")
    whole = keyed.join(copies, F.col("_key") == F.col("_unit")).select(*COLUMNS, F.explode(F.expr("array_repeat(0, _copies)"))).select(*COLUMNS)
    cut = area.stage(units.filter("_cut > 0").select("_unit", "_cut"), "cut")  # one document of each source
    part = keyed.join(cut, F.col("_key") == F.col("_unit")).withColumn("text", first_words("text", "_cut"))
    return whole.unionByName(part.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of token ids. Texts without tokens take no room; a text longer than a row goes on in further pieces."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed),
    ("token-ID / binary output", packed),
]

#: A trained classifier and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each one's rows are written to the shared folder and read again by the next. An empty corpus
    gives no rows."""
    area = WorkArea(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = area.stage(docs, f"stage-{k}")
    return docs
