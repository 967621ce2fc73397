"""Order MinHash fingerprints of documents, sensitive to edit distance.

A text's k-mers of code points are numbered by occurrence, so that each is
distinct.  Under each of ``SKETCHES`` hash functions the two smallest are taken
in the order of the text and hashed together.  The share of equal entries of
two fingerprints estimates their likeness: it falls with different k-mers (as
MinHash does) and with the same k-mers in another order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.llm import common
from plexus.llm.shingles import M1, M2, mix

K, SKETCHES, CHUNK = 6, 64, 8192
ODD = np.random.default_rng(77).integers(0, 2**31, SKETCHES, np.uint32) * np.uint32(2) + np.uint32(1)
COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def numbered_kmers(text: str, k: int = K) -> np.ndarray:
    """64-bit hashes of (k-mer, occurrence), in text order; a shorter text is one k-mer."""
    c = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    n = max(1, len(c) - k + 1)
    rolled = np.full(n, len(c) if len(c) < k else k, np.uint64)
    for j in range(min(k, len(c))):
        rolled = (rolled ^ c[j:j + n]) * M2
        rolled ^= rolled >> np.uint64(29)
    order = np.argsort(rolled, kind="stable")
    ranked = rolled[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    occurrence = np.empty(n, np.uint64)
    at = np.arange(n)
    occurrence[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return mix(rolled + occurrence * M1)


def fingerprint(text: str) -> np.ndarray:
    """``SKETCHES`` 16-bit values; all 0 for an empty text."""
    if not text:
        return np.zeros(SKETCHES, np.uint16)
    ids = numbered_kmers(text)
    x = (ids >> np.uint64(32)).astype(np.uint32)
    rows, values, places = np.arange(SKETCHES), [], []
    for a in range(0, len(x), CHUNK):
        v = ODD[:, None] * x[None, a:a + CHUNK]
        for _ in range(min(2, v.shape[1])):
            i = v.argmin(1)
            values.append(v[rows, i].copy())
            places.append(i + a)
            v[rows, i] = np.uint32(0xFFFFFFFF)
    values, places = np.array(values), np.array(places)
    least = np.lexsort((places, values), axis=0)[:2]
    chosen = np.sort(np.take_along_axis(places, least, 0), axis=0)
    first, last = ids[chosen[0]], ids[chosen[-1]]
    return (mix(mix(first) * M1 + last) >> np.uint64(48)).astype(np.uint16)


def edited(text: str, following: str) -> str:
    """The last quarter of ``text`` replaced by as much of the start of ``following``."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def with_following(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows dealt into id ranges, each with the first row of the next range
    (``ahead``), so that a task sees the document after each of its own.

    The ranges come from approximate percentiles of the ids; one row per range,
    its first id, reaches the driver.  Texts are shuffled once."""
    rows = common.id_and_text(docs, id_col, text_col).withColumn("h", F.xxhash64("text"))
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / ranges for k in range(1, ranges)] or [1.0]
    bounds = np.unique(rows.agg(F.percentile_approx("doc_id", shares, 100 * ranges)).first()[0] or [])

    @F.pandas_udf("int")
    def bucket(ids: pd.Series) -> pd.Series:
        known = ids.notna()
        at = np.searchsorted(bounds, ids.fillna(0).astype("int64"), side="left")
        return pd.Series(np.where(known, at, -1)).astype("int32")

    rows = rows.withColumn("bucket", bucket("doc_id"))
    firsts = rows.groupBy("bucket").agg(F.min(F.struct("doc_id", "h")).alias("f")).orderBy("bucket").collect()
    before = {(r.f.doc_id, r.f.h): firsts[k - 1].bucket for k, r in enumerate(firsts)}
    if not before:
        return rows.withColumn("ahead", F.lit(False))
    spark = docs.sparkSession
    heads = F.broadcast(spark.createDataFrame([(i, h, b) for (i, h), b in before.items()], "f_id long, f_h long, previous int"))  # one row per range
    rows = rows.join(heads, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("h") == F.col("f_h")), "left")
    own = F.struct(F.col("bucket").alias("b"), F.lit(False).alias("a"))
    both = F.array(own, F.struct(F.col("previous").alias("b"), F.lit(True).alias("a")))
    rows = rows.withColumn("to", F.explode(F.when(F.col("previous").isNull(), F.array(own)).otherwise(both)))
    rows = rows.select("doc_id", "text", "h", F.col("to.b").alias("bucket"), F.col("to.a").alias("ahead"))
    return rows.repartition(ranges, "bucket").sortWithinPartitions("bucket", "ahead", "doc_id", "h")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: fingerprint of its text and of its edited text (the end
    replaced by the start of the next document by id; after the last comes the
    first), and its likeness to that and to the next document.

    Null text is empty; two empty texts are alike.  Null ids come first; rows
    with one id are ordered by their text's hash; a sole document is its own
    next; an empty table gives no rows."""

    def show(f: np.ndarray) -> str:
        return f.byteswap().tobytes().hex()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the document whose next one is awaited: bucket, id, text, fingerprint
        names = [x.split()[0] for x in COLUMNS.split(", ")]
        for batch in common.slices(batches, "text", 4 << 20):
            out = []
            for b, i, text, ahead in zip(*(batch.column(k).to_pylist() for k in ("bucket", "doc_id", "text", "ahead")), strict=True):
                own = fingerprint(text)
                if held and held[0] == b:
                    changed = edited(held[2], text)
                    f = held[3] if changed == held[2] else fingerprint(changed)
                    out.append((held[1], len(held[2]), hashlib.sha256(changed.encode()).hexdigest(), show(held[3]), show(f),
                                float((f == held[3]).mean()), float((own == held[3]).mean())))
                held = None if ahead else (b, i, text, own)
            if out:
                columns = zip(*out, strict=True)
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return with_following(docs, id_col, text_col).mapInArrow(run, COLUMNS)
