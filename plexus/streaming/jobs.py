"""Structured Streaming versions of the live paths: message log (X1), like
state (X2), friend-request dedupe (X3) and the growing keyword index (X4).

Sources are file streams over a folder of parquet files (``pathGlobFilter``
picks one table); sinks and checkpoints live below the session's shared
checkpoint folder.  ``run_available`` drives a query over everything that is
present (``availableNow``) and waits, which is how the batch-equivalence
checks run them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from plexus.operators import social as S
from plexus.operators import text as T
from plexus.session import scratch_path
from plexus.sources import epochs
from plexus.sources.bindings import Bindings


def file_stream(spark: SparkSession, folder: str, table: str, max_files: int | None = None) -> DataFrame:
    """Stream the parquet files ``{table}*.parquet`` (and part files, as Spark
    names them, where ``max_files`` is set) of a folder (schema from
    the files' footer, never inferred per batch)."""
    glob = f"{{{table},part-}}*.parquet" if max_files else f"{table}*.parquet"
    schema = spark.read.option("pathGlobFilter", glob).parquet(folder).schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(folder)


def run_available(q: StreamingQuery) -> None:
    """Wait until everything that is there has been processed, however long it takes."""
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def _events_as_messages(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    return events.select(k.alias("chatID"), F.col("event_id").alias("message_id"),
                         F.col("user_id").alias("userID"), F.col("event_type").alias("message"), "ts")


# ------------------------------------------------------------------ X1

def stream_message_log(messages: DataFrame, accounts: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Drop blank messages, add the author's names (static join), append
    to a parquet log partitioned by message date (a partition per chat would
    mean one directory per chat, without bound)."""
    valid = messages.where(F.coalesce(F.trim("message"), F.lit("")) != "")
    names = accounts.select("userID", "firstName", "lastName")
    out = valid.join(names, "userID", "left").withColumn("dt", F.to_date("ts"))
    return (out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
            .partitionBy("dt").outputMode("append").trigger(availableNow=True).start())


# ------------------------------------------------------------------ X2

LIKE_KEYS = ["postID", "userID"]


def stream_like_state(like_log: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """The last operation per (postID, userID), kept in Spark's own keyed
    state (an aggregate in update mode, so a late, older operation loses and a
    restarted query goes on where it stopped).  Each micro-batch writes the
    keys it changed to a folder of its own, which a repeated batch overwrites;
    ``like_changes`` reads them."""
    put = F.col("op") != "delete"
    last = like_log.groupBy(*LIKE_KEYS).agg(
        F.max("seq").alias("seq"), F.max_by(put, F.col("seq")).alias("put"), F.max_by("ts", "seq").alias("ts"))

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")

    return (last.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def like_changes(spark: SparkSession, sink: str) -> DataFrame:
    """The change rows of X2 as an operation log for ``apply_changes``."""
    rows = spark.read.parquet(sink)
    return rows.select(*LIKE_KEYS, "seq", F.when(F.col("put"), "put").otherwise("delete").alias("op"), "ts")


LIKE_DELTAS = "postID long, delta long"


LIKE_BUCKETS = 1 << 12  # states that the (postID, userID) keys are dealt to by hash
LIKE_ROW = np.dtype([("post", "<i8"), ("user", "<i8"), ("none", "?"), ("seq", "<i8"), ("put", "?")])


def _like_step(key, frames, state):
    """One bucket of (postID, userID) keys in one micro-batch: the state is the
    newest operation (seq, put) of each, as sorted rows of ``LIKE_ROW``.  A late,
    older operation changes nothing; what does change is the post's count."""
    held = np.frombuffer(bytes(state.get[0]), LIKE_ROW) if state.exists else np.zeros(0, LIKE_ROW)
    parts = [held]
    for f in frames:
        new = np.empty(len(f), LIKE_ROW)
        for name in LIKE_ROW.names:
            new[name] = f[name].to_numpy()
        parts.append(new)
    rows = np.concatenate(parts)
    old = np.arange(len(rows)) < len(held)
    # Each key's operations stand together, oldest first; of equal ones the one held comes last.
    order = np.lexsort((old, rows["seq"], rows["none"], rows["post"], rows["user"]))
    rows, old = rows[order], old[order]
    same = (rows[1:][["post", "user", "none"]] == rows[:-1][["post", "user", "none"]]) if len(rows) > 1 else np.zeros(0, bool)
    first = np.concatenate([[True], ~same])
    last = np.concatenate([~same, [True]])
    group = np.cumsum(first) - 1
    was = np.zeros(group[-1] + 1, np.int64)
    was[group[old]] = rows["put"][old]
    newest = rows[last]
    state.update((newest.tobytes(),))
    delta = newest["put"].astype(np.int64) - was
    moved = delta != 0
    if moved.any():
        post = pd.array(newest["post"][moved], dtype="Int64")
        post[newest["none"][moved]] = pd.NA
        yield pd.DataFrame({"postID": post, "delta": delta[moved]})


def _sum_deltas(rows: DataFrame) -> DataFrame:
    return rows.groupBy("postID").agg(F.sum("delta").alias("delta")).where("delta != 0")


def _write_sorted(*keys: str):
    def write(rows: DataFrame, path: str) -> None:
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)
    return write


def stream_like_counts(like_log: DataFrame, sink: str, checkpoint: str, fanout: int = 4) -> StreamingQuery:
    """Like counts kept up to date.  Keyed state holds the newest operation
    per (postID, userID), ``LIKE_BUCKETS`` states of many keys each, so that
    Python is called per bucket, not per key, and a post of many likes is in many
    of them; each micro-batch writes what it adds to or takes from a post's
    count, summed per post, to an epoch folder, and merges full blocks of folders.  ``like_counts`` sums those; no change row is read again.  Rows
    without seq never are the newest and those without userID count for nobody,
    as in the batch job; a null postID is a post of its own."""
    put = F.coalesce(F.col("op") != "delete", F.lit(False))
    log = like_log.where("seq is not null and userID is not null").select(
        F.pmod(F.xxhash64(*LIKE_KEYS), F.lit(LIKE_BUCKETS)).alias("bucket"),
        F.coalesce(F.col("postID").cast("long"), F.lit(0)).alias("post"), F.col("userID").cast("long").alias("user"),
        F.col("postID").isNull().alias("none"), F.col("seq").cast("long").alias("seq"), put.alias("put"))
    deltas = log.groupBy("bucket").applyInPandasWithState(
        _like_step, LIKE_DELTAS, "keys binary", "append", GroupStateTimeout.NoTimeout)
    store = _write_sorted("postID")

    def write(batch: DataFrame, epoch: int) -> None:
        store(_sum_deltas(batch), f"{sink}/epoch={epoch}")
        epochs.merge_epochs(batch.sparkSession, sink, LIKE_DELTAS, _sum_deltas, store, fanout)

    return (deltas.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def like_counts(spark: SparkSession, sink: str) -> DataFrame:
    """(postID, n_likes) of the posts that have likes, from the deltas of X2."""
    return _sum_deltas(epochs.read_epochs(spark, sink, LIKE_DELTAS)).withColumnRenamed("delta", "n_likes")


# ------------------------------------------------------------------ X3

def stream_friend_requests(requests: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """A repeated request from the same sender to the same recipient is
    dropped.  There is no watermark: a request is remembered as long as the
    stream's state lives, so late files lose no pair and bring none out twice.
    The state is one entry per pair."""
    dedup = requests.select("recipientID", "senderID", "ts").dropDuplicates(["recipientID", "senderID"])
    return (dedup.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())


PENDING = "kind string, recipientID long, senderID long, ts timestamp, requestTs timestamp, seq long"


def request_events(requests: DataFrame, accepts: DataFrame) -> DataFrame:
    """Requests and acceptances as one stream of ``PENDING`` rows."""
    asked = S._only_requests(requests).select(F.lit("request").alias("kind"), "recipientID", "senderID", F.col("ts").cast("timestamp").alias("ts"),
                                              F.lit(None).cast("timestamp").alias("requestTs"), "seq")
    said = accepts.select(F.lit("accept").alias("kind"), "recipientID", "senderID", F.col("ts").cast("timestamp").alias("ts"),
                          F.col("requestTs").cast("timestamp").alias("requestTs"), "seq")
    return asked.unionByName(said)


def _pending_step(key, frames, state):
    """One (recipient, sender) pair in one micro-batch: the state is its waiting
    request (seq, time).  A request passes on if none waits or a later one does;
    an acceptance always passes on, and forgets the request it is for."""
    rows = sorted((r for f in frames for r in f.itertuples(index=False)), key=lambda r: (r.seq, r.kind))
    held, out = (state.get if state.exists else None), []
    for r in rows:
        at = None if r.ts is pd.NaT else int(r.ts.value)
        if r.kind == "accept":
            out.append(r)
            if held and held[0] < r.seq and r.requestTs is not pd.NaT and held[1] == int(r.requestTs.value):
                held = None
        elif held is None or r.seq < held[0]:
            out.append(r)
            held = (int(r.seq), at)
    if held:
        state.update(held)
    elif state.exists:
        state.remove()
    yield pd.DataFrame([tuple(r) for r in out], columns=["kind", "recipientID", "senderID", "ts", "requestTs", "seq"])


def stream_pending_requests(events: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """X3 with the exact rule: a request is remembered until it is accepted.

    ``events`` are ``request_events``.  Each pair's keyed state holds its waiting
    request only, and is dropped when that is accepted, so the state grows with
    the requests that wait.  Repeated requests are dropped, the rest and all
    acceptances are appended to ``sink``; what comes out of order, or again
    after an acceptance, is settled by ``streamed_requests``: a pair's first
    request and first acceptance always reach the sink."""
    step = events.groupBy("recipientID", "senderID").applyInPandasWithState(
        _pending_step, PENDING, "seq long, at long", "append", GroupStateTimeout.NoTimeout)
    return (step.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())


def streamed_requests(spark: SparkSession, sink: str, friends: DataFrame, pending: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From the sink of X3: the requests that were sent, and the pending list
    (S11 and S12 on the kept rows)."""
    rows = spark.read.schema(PENDING).parquet(sink)
    asked = rows.where("kind = 'request'").select("recipientID", "senderID", "ts", "seq").distinct()
    said = rows.where("kind = 'accept'").select("recipientID", "senderID", "ts", "requestTs", "seq")
    sent = S.friend_requests(asked, friends, pending, said).where("status = 'sent'").drop("status")
    return sent, S.pending_requests(asked, said, friends, pending)


# ------------------------------------------------------------------ X4

KEYWORDS = "keyword string, headline string, url string"


def stream_keyword_index(news: DataFrame, sink: str, checkpoint: str, stem: bool = True,
                         fanout: int | None = None) -> StreamingQuery:
    """Every micro-batch of articles is tokenized, stemmed and indexed
    (T3-T5) and written to a folder of its own, which a repeated batch
    overwrites.  With ``fanout``, full blocks of folders are merged into larger
    ones, sorted by (keyword, headline); else earlier folders aren't read again.
    ``grown_index`` reads what is there."""
    store = _write_sorted("keyword", "headline")

    def write(batch: DataFrame, epoch: int) -> None:
        T.build_keyword_index(batch, stem=stem).write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")
        if fanout:
            epochs.merge_epochs(batch.sparkSession, sink, KEYWORDS, lambda rows: T.merge_index(rows.drop("epoch")), store, fanout)

    return (news.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def grown_index(spark: SparkSession, sink: str) -> DataFrame:
    """The index X4 has written: (keyword, headline, url), one row per (keyword,
    headline), however the articles were cut into batches."""
    return T.merge_indexes(epochs.read_epochs(spark, sink, KEYWORDS), "epoch")


# ------------------------------------------------- batch-equivalent runs

BATCHES = 4  # files that a table is split into, read one per micro-batch


def out_of_order_files(spark: SparkSession, folder: str, table: str, order: str) -> str:
    """``table`` of ``folder`` written anew by Spark as at least ``BATCHES`` files
    (range-partitioned by falling ``order``); the new folder.  Streamed one file
    per batch, late rows are the rule."""
    out = scratch_path(spark, f"{table}-files")
    rows = spark.read.parquet(f"{folder}/{table}.parquet")
    rows.repartitionByRange(BATCHES, F.col(order).desc()).write.parquet(out)
    return out


def run_message_log(spark: SparkSession, folder: str, accounts: DataFrame) -> DataFrame:
    sink, ck = scratch_path(spark, "x1-sink"), scratch_path(spark, "x1-ck")
    msgs = _events_as_messages(file_stream(spark, folder, "events"))
    run_available(stream_message_log(msgs, accounts, sink, ck))
    return spark.read.parquet(sink).drop("dt")


def _like_log(events: DataFrame) -> DataFrame:
    return events.select(F.col("event_id").alias("seq"),
                         F.when(F.col("event_type") == "error", "delete").otherwise("put").alias("op"),
                         F.get_json_object("props", "$.k").cast("bigint").alias("postID"),
                         F.col("user_id").alias("userID"), F.col("ts"))


def run_like_state(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    log = _like_log(file_stream(spark, folder, "events", max_files))
    sink = scratch_path(spark, "x2-sink")
    run_available(stream_like_state(log, sink, scratch_path(spark, "x2-ck")))
    return S.apply_changes(like_changes(spark, sink), LIKE_KEYS, "seq")


def run_like_counts(spark: SparkSession, folder: str, max_files: int | None = None, fanout: int = 4) -> DataFrame:
    log = _like_log(file_stream(spark, folder, "events", max_files))
    sink = scratch_path(spark, "x2-counts")
    run_available(stream_like_counts(log, sink, scratch_path(spark, "x2-ck"), fanout))
    return like_counts(spark, sink)


def run_friend_requests(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    ev = file_stream(spark, folder, "events", max_files).where(F.col("event_type") == "signup")
    req = ev.select(F.col("user_id").alias("recipientID"),
                    F.get_json_object("props", "$.k").cast("bigint").alias("senderID"),
                    F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"))
    sink, ck = scratch_path(spark, "x3-sink"), scratch_path(spark, "x3-ck")
    run_available(stream_friend_requests(req, sink, ck))
    return spark.read.parquet(sink)


def run_pending_requests(spark: SparkSession, folder: str, b: Bindings, max_files: int | None = None) -> tuple[DataFrame, DataFrame]:
    """X3 over the request log of ``folder``; sent requests and the pending list."""
    files = Bindings(spark, folder, file_stream(spark, folder, "events", max_files))
    sink = scratch_path(spark, "x3-pending")
    first = b.first_requests
    run_available(stream_pending_requests(request_events(files.request_log, files.accepts_of(first)), sink, scratch_path(spark, "x3-ck")))
    return streamed_requests(spark, sink, b.old_friends, b.pending_before)


def run_keyword_index(spark: SparkSession, folder: str, stem: bool = True, max_files: int | None = None,
                      fanout: int | None = None) -> DataFrame:
    d = file_stream(spark, folder, "documents", max_files)
    news = d.select(F.col("source").alias("authors"), F.col("lang").alias("category"),
                    F.lit(None).cast("string").alias("date"), F.col("doc_id").cast("string").alias("headline"),
                    F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("link"),
                    F.col("text").alias("short_description"))
    sink, ck = scratch_path(spark, "x4-sink"), scratch_path(spark, "x4-ck")
    run_available(stream_keyword_index(news, sink, ck, stem=stem, fanout=fanout))
    return grown_index(spark, sink)
