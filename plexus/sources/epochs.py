"""Folders that grow by one per micro-batch, kept few by levelled merging.

A sink holds ``epoch=<n>`` folders, one per micro-batch, and ``run=<first>-<last>``
folders, each the merged rows of those epochs.  A folder counts once Spark has
written its ``_SUCCESS`` file, its last act: that is the switch, so a merge that
died leaves a folder nobody reads, and is simply done again.  Readers take the
widest runs and the epochs that none covers.  ``fanout`` neighbours of one level
make a run of the next, so a reader opens at most (fanout - 1) folders per level
and the levels grow with the logarithm of the epochs; each row is rewritten once
per level.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def committed(spark: SparkSession, sink: str) -> list[tuple[int, int, str]]:
    """(first epoch, last epoch, path) of every folder that is whole."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sink)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    out = []
    for status in fs.listStatus(path):
        kind, _, span = status.getPath().getName().partition("=")
        folder = status.getPath().toString()
        if kind in ("epoch", "run") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")):
            first, _, last = span.partition("-")
            out.append((int(first), int(last or first), folder))
    return out


def live(spark: SparkSession, sink: str) -> list[tuple[int, int, str]]:
    """The folders that together hold every epoch once, in order: from left to
    right the widest that starts after what is covered."""
    out, covered = [], -1
    for first, last, folder in sorted(committed(spark, sink), key=lambda p: (p[0], -p[1])):
        if first > covered:
            out.append((first, last, folder))
            covered = last
    return out


def read_epochs(spark: SparkSession, sink: str, schema: str) -> DataFrame:
    """The rows of all live folders with ``epoch``, the last epoch of their
    folder (higher is newer); no rows if there is no folder."""
    out = spark.createDataFrame([], schema).withColumn("epoch", F.lit(0))
    for _, last, folder in live(spark, sink):
        out = out.unionByName(spark.read.schema(schema).parquet(folder).withColumn("epoch", F.lit(last)))
    return out


def merge_epochs(spark: SparkSession, sink: str, schema: str, merge: Callable[[DataFrame], DataFrame],
                 write: Callable[[DataFrame, str], None], fanout: int = 4) -> int:
    """Merge every full block of ``fanout`` ** level epochs, lowest level first;
    the number of runs written.  ``merge`` gets rows with ``epoch`` and gives
    rows without; ``write`` stores them at a path, over what is there."""
    runs, width = 0, fanout
    while True:
        pieces = live(spark, sink)
        if not pieces or width > pieces[-1][1] + 1:
            return runs
        for start in range(0, pieces[-1][1] + 1, width):
            block = [p for p in pieces if start <= p[0] and p[1] < start + width]
            whole = sum(last - first + 1 for first, last, _ in block) == width
            if whole and len(block) > 1:
                rows = None
                for _, last, folder in block:
                    part = spark.read.schema(schema).parquet(folder).withColumn("epoch", F.lit(last))
                    rows = part if rows is None else rows.unionByName(part)
                write(merge(rows), f"{sink}/run={start}-{start + width - 1}")
                runs += 1
        width *= fanout
