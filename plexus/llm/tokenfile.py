"""Token files: ids as equal-length sequences in Arrow stream files.

A shard is two files.  ``ids-NNNNN.arrow`` is an Arrow IPC stream whose record
batches hold ``BATCH`` rows each (the last fewer) of two fixed-size lists:
``ids`` (uint16 or uint32, ``length`` entries) and ``mask`` (booleans, a bit
each, true for a token, false for padding at the end of the shard).  All rows
have one size, so row ``i`` is found by arithmetic and read from a memory map
without a copy.
``docs-NNNNN.arrow`` lists the shard's documents: id, first token, tokens."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from plexus.llm import common
from plexus.llm.encode import encoder

BATCH = 64
SHARDS = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("ids_path", T.StringType()),
                       T.StructField("docs_path", T.StringType()), T.StructField("n_docs", T.LongType()),
                       T.StructField("n_tokens", T.LongType())])
DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
READ = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
                     T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])


def file_schema(length: int, dtype: str) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(np.dtype(dtype)), length)),
                      ("mask", pa.list_(pa.bool_(), length))])


class _Rows:
    """Cuts a flow of ids into rows and writes a record batch whenever BATCH rows are full."""

    def __init__(self, stream, length: int, dtype: str):
        self.schema, self.length, self.dtype = file_schema(length, dtype), length, dtype
        self.writer = pa.ipc.new_stream(stream, self.schema)
        self.held, self.n_held, self.total = [], 0, 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids.astype(self.dtype))
        self.n_held += len(ids)
        self.total += len(ids)
        if self.n_held >= BATCH * self.length:
            self.flush(self.n_held // (BATCH * self.length) * BATCH)

    def flush(self, rows: int) -> None:
        flat = np.concatenate(self.held) if self.held else np.zeros(0, self.dtype)
        n = min(len(flat), rows * self.length)
        ids, mask = np.zeros(rows * self.length, self.dtype), np.zeros(rows * self.length, bool)
        ids[:n], mask[:n] = flat[:n], True
        self.held, self.n_held = [flat[n:]], len(flat) - n
        for k in range(0, rows, BATCH):
            part = slice(k * self.length, min(rows, k + BATCH) * self.length)
            self.writer.write_batch(pa.record_batch(
                [pa.FixedSizeListArray.from_arrays(pa.array(x[part]), self.length) for x in (ids, mask)],
                schema=self.schema))

    def close(self) -> None:
        if self.n_held:
            self.flush(-(-self.n_held // self.length))
        self.writer.close()


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, length: int = 2048, end_id: int = 2,
                      dtype: str = "uint16", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text and write shards in ascending id order; one row per
    shard (its number, paths, documents, tokens).

    Range partitions by (id, hash of text) become shards, so shard order is id
    order.  A null text is empty (an end id alone), null ids come first, rows
    with one id are ordered by their text's hash; an empty table has no shards."""
    rows = common.id_and_text(docs, id_col, text_col).withColumn("h", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").drop("h")

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        number, encode, total = TaskContext.get().partitionId(), encoder(tokenizer, end_id).encode, [0, 0]

        def write_docs(docs_out) -> None:
            def write_ids(ids_out) -> None:
                out, lists = _Rows(ids_out, length, dtype), pa.ipc.new_stream(docs_out, DOCS)
                for batch in common.slices(_chain(first, batches), "text", 12 << 20, 20000):
                    flat, counts = encode(batch.column("text"))
                    starts = out.total + np.cumsum(counts) - counts
                    out.add(flat)
                    lists.write_batch(pa.record_batch([batch.column("doc_id").cast(pa.int64()), pa.array(starts), pa.array(counts)],
                                                      schema=DOCS))
                    total[0] += len(counts)
                out.close()
                lists.close()
                total[1] = out.total
            total.append(common.write_file(folder, f"ids-{number:05d}.arrow", write_ids))
        docs_path = common.write_file(folder, f"docs-{number:05d}.arrow", write_docs)
        yield pa.RecordBatch.from_pydict({"shard": pa.array([number], pa.int32()), "ids_path": [total[2]],
                                          "docs_path": [docs_path], "n_docs": [total[0]], "n_tokens": [total[1]]})

    return common.stored(rows.mapInArrow(shard, SHARDS), "token-shards")


def _chain(first, rest):
    yield first
    yield from rest


def read_documents(shards: DataFrame) -> DataFrame:
    """One row per document read back from the files: id, ``start`` (tokens of
    all documents before it), ``n_tokens``, ``ids_crc32`` of its ids as
    little-endian unsigned 32-bit integers.

    The running total is a window over one row per shard, not per document."""
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    listed = shards.withColumn("before", before)
    tasks = max(1, min(listed.sparkSession.sparkContext.defaultParallelism * 4, shards.count()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _read_shard(row["ids_path"], row["docs_path"], row["before"])

    return listed.repartition(tasks, "shard").mapInArrow(read, READ)


def _read_shard(ids_path: str, docs_path: str, before: int) -> Iterator[pa.RecordBatch]:
    """Streams the ids once; holds one record batch of them and one of the list."""
    with common.open_file(ids_path) as ids_file, common.open_file(docs_path) as docs_file:
        rows = pa.ipc.open_stream(ids_file)
        held, at = np.zeros(0, np.uint32), 0  # ids from token ``at`` on
        for docs in pa.ipc.open_stream(docs_file):
            starts, counts = (docs.column(k).to_numpy() for k in (1, 2))
            sums = np.zeros(len(starts), np.int64)
            for k, (start, count) in enumerate(zip(starts, counts, strict=True)):
                done = 0
                while done < count:
                    if at + len(held) <= start + done:
                        at, held = at + len(held), rows.read_next_batch().column(0).values.to_numpy().astype("<u4")
                    part = held[start + done - at:start + count - at]
                    sums[k] = zlib.crc32(part, int(sums[k]))
                    done += len(part)
            yield pa.RecordBatch.from_arrays([docs.column(0), pa.array(starts + before), docs.column(2), pa.array(sums)],
                                             names=READ.names)


class TokenFile:
    """Random access to the sequences of one shard; each is a view into the
    memory-mapped file."""

    def __init__(self, path: str):
        self.batches = pa.ipc.open_stream(common.open_file(path)).read_all().to_batches()
        self.rows = sum(b.num_rows for b in self.batches)

    def __len__(self) -> int:
        return self.rows

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids (numpy) and mask (Arrow booleans) of sequence ``i``."""
        if not 0 <= i < self.rows:
            raise IndexError(i)
        batch, row = self.batches[i // BATCH], i % BATCH
        ids, mask = (batch.column(k)[row].values for k in (0, 1))
        return ids.to_numpy(zero_copy_only=True), mask
