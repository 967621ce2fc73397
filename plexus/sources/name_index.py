"""A stored prefix index of user names (T8) that follows sign-ups and renames.

Each batch of name changes adds one epoch folder (``plexus.sources.epochs``) of
(prefix, userID, put) rows: the prefixes that a user gained and lost.  Nothing
stored is read to add a batch.  The newest row of a (prefix, userID) decides.
Folders are split into ``part=<hash of the prefix>`` and dealt by ranges of
(part, prefix, userID), so a one-letter prefix of most users fills many files,
and a lookup reads the folders of its prefixes only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plexus.operators import text as T
from plexus.sources import epochs
from plexus.sources.keyword_index import index_part

NAME_PARTS = 16
NAME_SCHEMA = "prefix string, userID long, put boolean, part int"
NAME_KEYS = ["prefix", "userID"]


def name_changes(before: DataFrame, after: DataFrame, users: DataFrame) -> DataFrame:
    """(userID, old_name, new_name) of ``users(userID)`` whose name differs
    between two states of the accounts; null where there was or is none."""
    some = users.select("userID").distinct()
    old = before.join(some, "userID", "left_semi").select("userID", F.col("username").alias("old_name"))
    new = after.join(some, "userID", "left_semi").select("userID", F.col("username").alias("new_name"))
    return old.join(new, "userID", "full_outer").where(~F.col("old_name").eqNullSafe(F.col("new_name")))


def prefix_changes(changes: DataFrame) -> DataFrame:
    """(prefix, userID, put) of a batch of ``name_changes``, one row per (prefix,
    userID): a prefix of both names stays.  A null or empty name has no prefixes;
    several changes of one user must be given as one (first name, last name)."""
    name = lambda col, put: changes.select("userID", F.lower(F.col(col)).alias("_name"), F.lit(put).alias("put"))
    names = name("old_name", False).unionByName(name("new_name", True)).where(F.length("_name") > 0)
    # A user's names in order: those with one prefix stand together, so only the next ones can have it too.
    before = Window.partitionBy("userID").orderBy("_name", "put").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("userID").orderBy(F.desc("_name"), F.desc("put")).rowsBetween(Window.unboundedPreceding, -1)
    new = F.when(F.col("put"), F.col("_name"))
    names = names.repartition("userID").distinct().select(
        "userID", "_name", "put", F.last(F.when(~F.col("put"), F.col("_name")), ignorenulls=True).over(before).alias("_old"),
        F.last(new, ignorenulls=True).over(before).alias("_new"), F.last(new, ignorenulls=True).over(after).alias("_next"))
    # A new name's prefix counts where it is first met, an old one's also if no new name has it.
    none = F.lit(None).cast("string")
    names = names.select("userID", "_name", "put", "_new", F.when(~F.col("put"), F.col("_old")).otherwise(none).alias("_old"),
                         F.when(~F.col("put"), F.col("_next")).otherwise(none).alias("_next"))
    return T.fresh_prefixes(names, "_old", "_new", "_next").select(*NAME_KEYS, "put")


TASK_ROWS = 2_000_000  # index rows that one task compares


def _newest(rows: DataFrame) -> DataFrame:
    """The newest row per key.  Files hold many rows a MB, and few share a key:
    they are dealt by it, into as many tasks as rows ask for, before they are
    grouped, so that no task holds a table that grows with the index."""
    spark = rows.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, -(-rows.count() // TASK_ROWS))
    return rows.repartition(tasks, *NAME_KEYS).groupBy(*NAME_KEYS).agg(F.max_by("put", "epoch").alias("put"))


def _writer(parts: int):
    def write(rows: DataFrame, path: str) -> None:
        keys = ["part", *NAME_KEYS]
        dealt = rows.select(*NAME_KEYS, "put", index_part("prefix", parts).alias("part")).repartitionByRange(*keys)
        dealt.sortWithinPartitions(*keys).write.mode("overwrite").partitionBy("part").parquet(path)
    return write


def add_names(changes: DataFrame, path: str, epoch: int, parts: int = NAME_PARTS, fanout: int = 4) -> None:
    """Store the prefix rows of batch number ``epoch`` (a repeated batch
    overwrites its folder) and merge what has become a full block.  The first
    batch, 0, is every account as a change from no name."""
    spark = changes.sparkSession
    write = _writer(parts)
    write(prefix_changes(changes), f"{path}/epoch={epoch}")
    epochs.merge_epochs(spark, path, NAME_SCHEMA, _newest, write, fanout)


def stored_names(spark: SparkSession, path: str) -> DataFrame:
    """(prefix, userID): the whole index as the last batch left it."""
    return _newest(epochs.read_epochs(spark, path, NAME_SCHEMA)).where("put").select(*NAME_KEYS)


def search_stored_users(searches: DataFrame, path: str, accounts: DataFrame, parts: int = NAME_PARTS) -> DataFrame:
    """T9 on a stored index: the result of ``search_users``, reading only the
    folders of the searched prefixes (at most ``parts`` numbers, fetched first)."""
    spark = searches.sparkSession
    asked = searches.select(F.lower("query").alias("prefix")).distinct()
    found = [r.part for r in asked.select(index_part("prefix", parts).alias("part")).distinct().collect()]
    rows = epochs.read_epochs(spark, path, NAME_SCHEMA).where(F.col("part").isin(found))
    names = _newest(rows.join(asked, "prefix", "left_semi")).where("put").select(*NAME_KEYS)
    return T.search_users(searches, names, accounts)
