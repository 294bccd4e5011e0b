"""A corpus pipeline: language, near duplicates, repeated passages, source mix, packed sequences.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and is
written as Parquet and read again as the next one's ``docs``. All but the last return the columns
of documents.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tagloom.llm import jaccard, language, mixing, packing, passages
from tagloom.operators.grouping import dedup_by_key
from tagloom.operators.numbering import numbered
from tagloom.operators.staging import scratch, stage

LEAST_SCORE = 0.5  # a text whose best language is less likely than this is rejected
HELD_OUT = "coalesce(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, false)"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a recognised language go; a missing language is filled in."""
    model = language.train(docs, F.expr(f"NOT {HELD_OUT}"))
    found = language.predict(docs, model, docs.columns)
    kept = found.where(F.col("lang_pred") != language.UNDETERMINED).where(F.col("score") >= LEAST_SCORE)
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each group of near duplicates stays, the one with the smallest id. Rows that share an
    id but not the text are texts of their own, ordered by a hash; of rows that share both, the smallest
    stays. Texts without words and rows without an id link with nothing and stay."""
    repeated = stage(docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return _first_of_groups(spark, docs, "doc_id")
    # numbers follow the ids, so the smallest number is the smallest id
    key = docs.select(F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__hash"))
    numbers = numbered(key.where("__id IS NOT NULL").distinct(), ["__id", "__hash"], "__number")
    rows = docs.join(numbers, (F.col("doc_id") == F.col("__id")) & (F.xxhash64("text") == F.col("__hash")), "left").select(*docs.columns, "__number")
    left = stage(_first_of_groups(spark, rows, "__number"), "firsts")
    copies = stage(left.groupBy("__number").count().where("__number IS NOT NULL AND count > 1").select("__number"), "copies")
    once = dedup_by_key(left.join(copies, "__number", "left_semi"), "__number", docs.columns)
    return left.join(copies, "__number", "left_anti").select(*docs.columns).unionByName(once.select(*docs.columns))


def _first_of_groups(spark: SparkSession, rows: DataFrame, key: str) -> DataFrame:
    """``rows`` but for those whose group of near duplicates has a smaller ``key``."""
    with scratch(spark):
        groups = jaccard.components(rows.select(F.col(key).alias("doc_id"), "text"), k=5, percent=80)
        gone = stage(groups.where("component_id <> doc_id").select(F.col("doc_id").alias(key)).distinct(), "duplicates", kept=True)
    return rows.join(gone, key, "left_anti").select(*rows.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier text has too are cut out; texts of which nothing is left go."""
    with scratch(spark):
        found = stage(passages.by_row(docs), "passages", kept=True)
    left = passages.without_duplicates(docs, found)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights; a text taken n times is there n times. Texts
    without words weigh nothing and are taken as often as their source is for certain."""
    rows, place = _placed(docs)
    mix = stage(mixing.mix(rows, keep=place).where("copies > 0").select(*place, F.col("copies").cast("int").alias("__copies")), "mix")
    return rows.join(mix, place).withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies"))).select(*docs.columns)


def _placed(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with columns that name every row. They must not change when the rows are read again, by
    whichever executors: a stored table's rows have a file and a place in it, other rows are stored first."""
    try:
        return docs.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__place")), ["__file", "__place"]
    except AnalysisException:
        return stage(docs.withColumn("__place", F.monotonically_increasing_id()), "placed"), ["__place"]


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every text with its sequence."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("source_mix", source_mix),
    ("packing", packed),
]

#: Learned models and verified near duplicates have no SQL. Tests hold the stages against what is planted in a small fixture, source_mix against a plain sampler, packing for whole texts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
