"""Stupid-backoff scores of all documents under counts of all the others.

Documents are gathered into blocks, each a compressed file in the shared
folder.  A block's distinct n-grams, as 64-bit hashes with counts, are
partitioned by hash; each hash partition sums the counts of all blocks and
tells every block that asked what the other blocks hold, in the order of the
hashes it got, so that hashes travel once and texts never; each block looks
the answers up for its n-grams and sums per document.  A document's own counts
are taken off, so that it is scored by the rest of the corpus.  An n-gram in
very many documents is one row per block, however often it occurs."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.llm import common
from plexus.llm.shingles import M1, mix

BACKOFF, BLOCK_CHARS = 0.4, 6_000_000
BUCKET_GRAMS = 1_500_000  # n-grams, repeats counted, of a hash partition
KEYS, COUNTS = "bucket int, block long, keys binary, counts binary", "bucket int, block long, counts binary"
SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))


def ngrams(texts: list[str], order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Per n = 1 ... order the hash of the n-gram ending at each word (0 where it
    would start before the text); and where each text's words start.  Words are
    lower-cased (A-Z) runs of anything but ASCII white space."""
    words, starts = [], [0]
    for t in texts:
        found = t.encode().lower().split()
        words += found
        starts.append(len(words))
    starts = np.array(starts)
    known: dict[bytes, int] = {}
    w = np.fromiter((known[x] if x in known else known.setdefault(x, xxhash.xxh64_intdigest(x)) for x in words), np.uint64, len(words))
    place = np.arange(len(w)) - np.repeat(starts[:-1], np.diff(starts))
    out, rolled = [], np.zeros(len(w), np.uint64)
    for n in range(1, order + 1):
        back = np.zeros(len(w), np.uint64)
        back[n - 1:] = w[:len(w) - n + 1]
        rolled = mix(rolled * M1 + back + np.uint64(n))
        out.append(np.where(place >= n - 1, np.maximum(rolled, np.uint64(1)), np.uint64(0)))
    return out, starts


def table_of(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of all orders, sorted, and their counts."""
    flat = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
    return np.unique(flat[flat != 0], return_counts=True)


def squeezed(data: np.ndarray) -> bytes:
    """Whole numbers by byte planes, compressed; first how many bytes each takes
    and how many there are."""
    used = max(1, (int(data.max(initial=0)).bit_length() + 7) // 8)
    planes = data.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :used].T.tobytes()
    return bytes([used]) + len(data).to_bytes(5, "little") + pa.compress(planes, "zstd", asbytes=True)


def loose(data: bytes) -> np.ndarray:
    used, n = data[0], int.from_bytes(data[1:6], "little")
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :used] = np.frombuffer(pa.decompress(data[6:], used * n, "zstd", asbytes=True), np.uint8).reshape(used, n).T
    return wide.view("<u8").ravel()


def packed(keys: np.ndarray) -> bytes:
    """Sorted hashes, all their bits, as differences."""
    return squeezed(np.diff(keys, prepend=np.uint64(0)))


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(loose(data), dtype=np.uint64)


def block_scores(texts: list[str], order: int, others: np.ndarray, everything: int) -> tuple[np.ndarray, np.ndarray]:
    """Words and summed log scores of each text, given the other blocks' counts of
    the block's distinct n-grams, in the order of ``table_of``, and of all words."""
    grams, starts = ngrams(texts, order)
    keys, counts = table_of(grams)
    if len(keys) != len(others):
        raise ValueError(f"{len(others)} counts for {len(keys)} n-grams")
    totals = np.append(others + counts, 0)  # the last is for no n-gram
    n = np.diff(starts)
    doc = np.repeat(np.arange(len(n)), n)
    rest = []  # counts of each position's n-gram in the other documents
    for g in grams:
        at = np.where(g == 0, len(keys), np.searchsorted(keys, g))
        pair = doc * np.int64(len(keys) + 1) + at
        _, back, own = np.unique(pair, return_inverse=True, return_counts=True)
        rest.append(np.where(g == 0, 0, totals[at] - own[back]) if len(g) else np.zeros(0, np.int64))
    words = (everything - n)[doc]
    longest = np.minimum(order, np.arange(len(doc)) - starts[:-1][doc] + 1)
    value = np.log(BACKOFF) * longest - np.log(words + 1.0)
    for k in range(1, order + 1):  # longer n-grams replace shorter ones
        context = words if k == 1 else np.concatenate([[0], rest[k - 2][:-1]])
        seen = rest[k - 1] > 0
        value[seen] = (np.log(BACKOFF) * (longest[seen] - k) + np.log(rest[k - 1][seen]) - np.log(np.maximum(1, context[seen])))
    return n, np.bincount(doc, value, len(n)) if len(n) else np.zeros(0)


def backoff_scores(docs: DataFrame, order: int = 2, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per document: ``n_tokens``, ``log_score`` (sum of natural logarithms), and
    ``mean_log_score`` (null without words).

    Null text is empty; repeated rows are documents of their own, each scored
    by the others; an empty table gives no rows."""
    rows = common.id_and_text(docs, id_col, text_col)
    spark = docs.sparkSession
    folder = common.shared_folder(spark, "text-blocks")

    def block_of(rows: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        found = pa.Table.from_batches(rows)
        flat = np.frombuffer(" ".join(["", *found.column("text").to_pylist()]).encode(), np.uint8)
        space = SPACE[flat]

        def write(out) -> None:
            with pa.ipc.new_stream(out, found.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_table(found.combine_chunks())

        path = common.write_file(folder, f"{uuid.uuid4().hex}.arrow", write)
        return pa.RecordBatch.from_pydict({"block": [(TaskContext.get().partitionId() << 32) + number], "path": [path],
                                           "words": [int((space[:-1] & ~space[1:]).sum())]},
                                          pa.schema([("block", pa.int64()), ("path", pa.string()), ("words", pa.int64())]))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, 0
        for batch in common.slices(batches, "text", max(1, block_chars // 8)):
            held.append(batch)
            size += pa.compute.sum(pa.compute.binary_length(batch.column("text"))).as_py() or 0
            if size >= block_chars:
                yield block_of(held, number)
                held, size, number = [], 0, number + 1
        if held:
            yield block_of(held, number)

    def read(path: str) -> pa.Table:
        with common.open_file(path) as f, pa.ipc.open_stream(f) as stream:
            return stream.read_all()

    blocks = common.stored(rows.mapInArrow(gather, "block long, path string, words long"), "blocks")
    n_blocks, everything = blocks.agg(F.count("*"), F.coalesce(F.sum("words"), F.lit(0))).first()
    n_blocks, buckets = max(1, n_blocks), order * everything // BUCKET_GRAMS + 1

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, path in ((b, p) for frame in frames for b, p in zip(frame["block"], frame["path"], strict=True)):
            keys, counts = table_of(ngrams(read(path).column("text").to_pylist(), order)[0])
            bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)  # ranges of hashes
            cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
            yield pd.DataFrame([(b, block, packed(keys[x:y]), squeezed(counts[x:y])) for b, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)) if y > x],
                               columns=["bucket", "block", "keys", "counts"])

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        lists, counts = [unpacked(x) for x in group["keys"]], [loose(x).astype(np.int64) for x in group["counts"]]
        every, back = np.unique(np.concatenate(lists), return_inverse=True)
        totals = np.bincount(back, np.concatenate(counts)).astype(np.int64)
        ends = np.cumsum([len(x) for x in lists])
        out = group[["bucket", "block"]].copy()
        out["counts"] = [squeezed(totals[back[e - len(own):e]] - own) for own, e in zip(counts, ends, strict=True)]
        return out

    asked = blocks.repartition(n_blocks).mapInPandas(ask, KEYS)
    answers = asked.groupBy("bucket").applyInPandas(answer, COUNTS).repartition(n_blocks, "block")

    def score(group: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        rows = read(group["path"].iloc[0])
        others = np.concatenate([loose(x).astype(np.int64) for x in found.sort_values("bucket")["counts"]] or [np.zeros(0, np.int64)])
        n, logs = block_scores(rows.column("text").to_pylist(), order, others, everything)
        mean = np.divide(logs, n, out=np.full(len(n), np.nan), where=n > 0)
        return pd.DataFrame({"doc_id": rows.column("doc_id").to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get), "n_tokens": n,
                             "log_score": logs, "mean_log_score": pd.array(mean, "Float64")})

    out = blocks.repartition(n_blocks, "block").groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        score, "doc_id long, n_tokens long, log_score double, mean_log_score double")
    return out.withColumn("mean_log_score", F.when(F.col("n_tokens") > 0, F.col("mean_log_score")))
