"""Mixing sources to target weights by Poisson replication.

Each document is repeated as often as a Poisson variable says whose mean is its
source's target repetition rate.  The variable is the inverse distribution
function at a uniform number hashed from seed and document, so every run, and
every retried task, repeats the same documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_BROADCAST = 20_000  # sources; beyond, rates are joined by shuffle


def rates(docs: DataFrame, weights: DataFrame | None = None, temperature: float = 0.5, epochs: float = 1.0, source_col: str = "source",
          text_col: str = "text") -> DataFrame:
    """(source, size, rate): each source's characters, and how often its
    documents should be repeated on average so that the mix has ``epochs`` times
    the corpus' characters in the target shares.

    ``weights`` (source, weight) gives the shares; without it a source's share
    is its size to the power ``temperature``.  A null source is a source of its
    own; sources without weight or text get rate 0."""
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(F.length(F.coalesce(F.col(text_col), F.lit("")))).cast("double").alias("size"))
    if weights is None:
        shares = sizes.withColumn("weight", F.pow("size", F.lit(temperature)))
    else:
        named = weights.select(F.col("source").alias("s"), F.col("weight").cast("double").alias("weight")).groupBy("s").agg(F.max("weight").alias("weight"))
        shares = sizes.join(named, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    shares = shares.withColumn("weight", F.when(F.col("size") > 0, F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0))).otherwise(0.0))
    totals = shares.agg(F.sum("size").alias("all"), F.sum("weight").alias("of")).first()  # two numbers
    budget, total = epochs * (totals["all"] or 0.0), totals["of"] or 0.0
    rate = F.when((F.col("weight") > 0) & (F.lit(total) > 0), F.lit(budget) * F.col("weight") / F.greatest(F.lit(total), F.lit(1e-300)) / F.greatest("size", F.lit(1.0))).otherwise(0.0)
    return shares.select("source", "size", rate.alias("rate"))


def uniform(seed: int, *columns) -> Column:
    """A number in (0, 1) from a hash."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11).cast("double") + 0.5) / float(1 << 53)


def poisson(rate: Column, u: Column) -> Column:
    """Least k with P(Poisson(rate) <= k) >= u; log-space terms, so that large
    rates don't underflow."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 25).cast("int")
    start = F.struct((-rate).alias("log_p"), F.exp(-rate).alias("upto"), F.when(F.exp(-rate) >= u, 0).otherwise(-1).alias("k"))
    step = lambda s, i: F.when(s["k"] >= 0, s).otherwise(F.struct(
        (s["log_p"] + F.log(rate) - F.log(i.cast("double"))).alias("log_p"),
        (s["upto"] + F.exp(s["log_p"] + F.log(rate) - F.log(i.cast("double")))).alias("upto"),
        F.when((s["upto"] + F.exp(s["log_p"] + F.log(rate) - F.log(i.cast("double"))) >= u) | (i == last), i).otherwise(-1).alias("k")))
    return F.when(rate <= 0, 0).otherwise(F.aggregate(F.sequence(F.lit(1), last), start, step, lambda s: s["k"]))


def replicate(docs: DataFrame, weights: DataFrame | None = None, seed: int = 17, id_col: str = "doc_id", source_col: str = "source",
              text_col: str = "text", **options) -> DataFrame:
    """``docs`` with ``copy`` (from 0, in place of a column of that name) for
    every repetition, in random order over the whole output.  Rows with one id
    and text are repeated equally often; null ids and texts take part; other
    columns keep their names and values, whatever they are; an empty table
    gives no rows."""
    table = rates(docs, weights, source_col=source_col, text_col=text_col, **options).select(F.col("source").alias("of"), "rate")
    if table.count() <= MOST_BROADCAST:
        table = F.broadcast(table)
    key = F.xxhash64(F.col(id_col), F.xxhash64(text_col))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns if c != "copy"]).alias("row"), F.col(source_col).alias("source"),
                       uniform(seed, F.col(id_col), F.xxhash64(text_col)).alias("u"), key.alias("key"))
    joined = rows.join(table, F.col("source").eqNullSafe(F.col("of")))
    copies = joined.withColumn("n", poisson(F.col("rate"), F.col("u"))).filter("n > 0").select(
        "row", "key", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("copy"))
    place = F.xxhash64(F.lit(seed + 1), F.col("key"), F.col("copy"))
    mixed = copies.withColumn("place", place).repartitionByRange("place").sortWithinPartitions("place")
    return mixed.select("row.*", "copy")
