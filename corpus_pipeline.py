"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as
Parquet and read again as the next stage's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plexus.llm import mixing, neardup, packing, secrets, toxicity
from plexus.llm.common import stored
from plexus.llm.registry import TOKENIZER, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
CUT = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity reaches the cut go; all others stay as they are."""
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select(*COLUMNS), machine).filter(F.col("toxicity") < CUT).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: that with the smallest
    id (on five-word shingles, similarity 0.8 or more), of several with that id
    the one with the least hash of its text; a null id comes last.  Documents
    without words aren't duplicates; a row repeated with id and text stays once."""
    found = neardup.near_duplicate_groups(docs)
    first = found.filter("root is not null").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "h")).alias("_first"))
    chosen = first.select(F.col("_first.doc_id").alias("_id"), F.col("_first.h").alias("_text")).union(
        found.filter("root is null").select("doc_id", "h").distinct())
    hashed = docs.select(*COLUMNS).withColumn("_h", F.xxhash64(F.coalesce("text", F.lit(""))))
    single = hashed.dropDuplicates(["doc_id", "_h"])
    return single.join(chosen, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_text")), "left_semi").select(*COLUMNS)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark; all documents stay."""
    return secrets.redact(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated (or left out) so that sources weigh as the square root
    of their size, in random order."""
    return mixing.replicate(docs.select(*COLUMNS)).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in sequences of 2048 tokens."""
    return packing.pack(docs, TOKENIZER)


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_duplicates), ("secrets", hide_secrets),
          ("mixing", mix_sources), ("packing", pack_sequences)]
ORACLE_SQL = None  # string kernels and tokenizers are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
