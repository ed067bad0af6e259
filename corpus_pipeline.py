"""Documents to training sequences: five stages, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spindlewave.llm import credentials, minhash, mixing, packing, quality, queries
from spindlewave.llm.common import dropped, small_batches, stored, table


#: Names that the mixing gives to columns of its own; documents may have them too.
MIXED = ("topic", "tokens", "probability", "sampled")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier does not reject."""
    small_batches(spark)
    trees = quality.learn(docs, table(spark, sf_dir, "labels"))
    found = quality.scored(docs, trees, threshold=0.3, keep=[*docs.columns])
    return found.where("predicted = 1").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8): that with the smallest id.

    Of rows with the same doc_id the one with the smallest text stays; rows without an
    id stay.
    """
    small_batches(spark)
    found = stored(minhash.near_duplicates(docs, width=5, percent=80).select("doc_id", "kept"), "near-duplicates")
    gone = found.where("not kept").select(F.col("doc_id").alias("__gone"))
    rows = docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")
    several = found.where("kept and doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if several.isEmpty():
        return rows
    several = several.select(F.col("doc_id").alias("__several"))
    once = rows.join(several, F.col("doc_id") == F.col("__several"), "left_anti")
    first = Window.partitionBy("doc_id").orderBy("text")
    again = rows.join(several, F.col("doc_id") == F.col("__several"), "left_semi")
    again = again.withColumn("__first", F.row_number().over(first)).where("__first = 1").drop("__first")
    return once.unionByName(again)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with every secret replaced by a mark."""
    small_batches(spark)
    return credentials.redacted(docs, credentials.learn(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents sampled to the target shares of source, language and topic."""
    own = [name for name in docs.columns if name not in MIXED]
    rows = docs.select(*own, F.struct(*docs.columns).alias("__row"))
    found = mixing.mixed(mixing.described(rows), queries.MARGINS, queries.KEEP)
    return found.where("sampled").select("__row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every token piece in sequences of 4096."""
    small_batches(spark)
    return packing.pack_documents(docs, queries.tokenizer(), queries.CAPACITY, queries.END)


STAGES = [
    ("quality classifier", keep_quality),
    ("near duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
#: Several stages cannot be written as SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's table is removed when the next one's is written."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        dropped(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
