"""Helpers of the training-data operators: intermediate tables, files in the
shared folder, batches of bounded size."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plexus.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared scratch folder and read it
    back: lineage ends there, so a lost executor costs one stage, not the
    whole chain."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared scratch folder, for files that tasks write."""
    path = scratch_path(spark, name)
    fs, at = pafs.FileSystem.from_uri(path)
    fs.create_dir(at, recursive=True)
    return path


def write_file(folder: str, name: str, write) -> str:
    """``write(stream)`` into a new file of ``folder``; returns its path.

    The file gets its final name only when complete, so a task that dies or is
    run twice leaves either no file or a whole one."""
    fs, at = pafs.FileSystem.from_uri(folder)
    temporary, final = f"{at}/.{name}.{uuid.uuid4().hex}", f"{at}/{name}"
    with fs.open_output_stream(temporary) as out:
        write(out)
    fs.move(temporary, final)
    return f"{folder}/{name}"


def open_file(path: str):
    """A readable file: memory-mapped on a mounted file system, else opened
    by its store's own reader."""
    fs, at = pafs.FileSystem.from_uri(path)
    if isinstance(fs, pafs.LocalFileSystem):
        return pa.memory_map(at)
    return fs.open_input_file(at)


def slices(batches: Iterator[pa.RecordBatch], column: str, budget: int = 4 << 20,
           rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the strings of ``column`` in one slice stay
    near ``budget`` bytes (a longer string is a slice of its own)."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for k, size in enumerate(sizes):
            if k > start and (held + size > budget or k - start >= rows):
                yield batch.slice(start, k - start)
                start, held = k, 0
            held += size
        if len(sizes) > start:
            yield batch.slice(start)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """The session has these settings while it lasts, then its own again."""
    before = {k: spark.conf.get(k) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def arrow_batches(spark: SparkSession, rows: int = 2000, size: str = "8m"):
    """While it lasts, Spark hands texts to Python in batches of at most ``rows``
    rows and about ``size`` (or one longer row), so that what a task holds
    outside the heap doesn't depend on how long texts are; then the session's
    own settings are put back.  Only for jobs that run within it."""
    return settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": size})


def shuffles_freed(spark: SparkSession):
    """While it lasts, a job's shuffle files go when it ends, not when the
    driver happens to collect its garbage.  For jobs in many rounds whose
    tables are ``stored``: nothing reads such a job's shuffles again."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The strings of a column, null as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def id_and_text(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """Only the columns an operator reads, under fixed names, so that extra
    columns of the input can't clash with the operator's own; null text is empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"), *more)
