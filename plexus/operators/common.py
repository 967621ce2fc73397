"""Small helpers shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plexus.session import ensure_checkpoint_dir, scratch_path


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over the session's parallelism when its scan gives
    fewer partitions (e.g. a file with one row group), before CPU-heavy
    per-row work.  A large input already has enough partitions and is left
    as is: no shuffle is added at scale."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def number_rows(df: DataFrame, group: list[str], order: list[Column], out: str) -> DataFrame:
    """Add ``out``: the place (long, from 1) of each row within its group.

    ``row_number`` over a group sorts all of it in one task.  Here rows are
    range-partitioned by group and order, so a large group covers several
    ranges; each range numbers its own rows, and a row's place is that number
    plus the group's rows in earlier ranges.  What is gathered per group is one
    count per range.  The ranges are checkpointed before they are read twice,
    since a range chosen anew would not fit the counts.  ``order`` should have
    no ties: those are broken arbitrarily.  Null groups form one group."""
    ensure_checkpoint_dir(df.sparkSession)
    ranges = df.repartitionByRange(*group, *order).withColumn("_range", F.spark_partition_id()).checkpoint(eager=True)
    local = ranges.withColumn("_n", F.row_number().over(Window.partitionBy("_range", *group).orderBy(*order)).cast("long"))
    counts = ranges.groupBy("_range", *group).agg(F.count("*").alias("_c"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    keys = [F.col(g).alias(f"_g{i}") for i, g in enumerate(group)]
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_c").over(before), F.lit(0))).select(
        F.col("_range").alias("_r"), *keys, "_before").where("_before > 0")
    same = F.col("_range") == F.col("_r")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return local.join(offsets, same, "left").select(
        *[local[c] for c in df.columns], (F.col("_n") + F.coalesce("_before", F.lit(0))).alias(out))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared scratch folder and read it back,
    for tables that several jobs of one query read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


LIST = 1024  # a key of at most so many items, all different, has them as one list


def item_lists(items: DataFrame, key: str, item: str) -> DataFrame:
    """(key, n_items, items) per key of ``items``: the number of its rows and,
    for a key of at most ``LIST`` rows whose items differ and are not null,
    their array; null for all other keys, so that no list grows with a hub.
    Null keys are left out."""
    items = items.select(key, item).where(F.col(key).isNotNull()).repartition(key)  # one shuffle for all below
    sizes = items.groupBy(key).agg(F.count("*").alias("n_items"))
    few = F.when(F.col("n_items") <= LIST, F.col(item))
    lists = items.join(sizes, key).groupBy(key).agg(F.first("n_items").alias("n_items"), F.collect_set(few).alias("items"))
    return lists.select(key, "n_items", F.when(F.size("items") == F.col("n_items"), F.col("items")).alias("items"))


def listed_items(rows: DataFrame, left: DataFrame, right: DataFrame, left_key: str, right_key: str, item: str) -> DataFrame:
    """``rows`` with one row per ``item`` that both keys have, for rows whose
    keys have lists in ``left`` and ``right`` (``item_lists`` named by those
    keys).  The left list travels to the right key as one array, not as a row
    per item."""
    some = rows.join(left.select(left_key, F.col("items").alias("_left")), left_key).join(
        right.select(right_key, F.col("items").alias("_right")), right_key)
    return some.select(*rows.columns, F.explode(F.array_intersect("_left", "_right")).alias(item))
