"""Streaming jobs equal their batch counterparts, also over several
micro-batches that arrive out of order."""

import shutil
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from plexus.operators import social as S
from plexus.sources.bindings import Bindings
from plexus.streaming import jobs as X
from tests.conftest import SF_SMALL


def test_like_state_over_out_of_order_batches(spark, tmp_path):
    # split the events table into 4 files whose sequence numbers interleave
    t = pq.read_table(f"{SF_SMALL}/events.parquet")
    ids = t.column("event_id").to_pylist()
    for part in range(4):
        pq.write_table(t.filter([i % 4 == part for i in ids]), tmp_path / f"events-{3 - part}.parquet")
    got = X.run_like_state(spark, str(tmp_path), max_files=1)
    want = S.apply_changes(Bindings(spark, SF_SMALL).like_log, ["postID", "userID"], "seq")
    key = ["postID", "userID"]
    assert sorted(map(tuple, got.select(*key).collect())) == sorted(map(tuple, want.select(*key).collect()))


def _part_files(tmp_path, spark, table, order):
    """Files of a table, the latest rows first, in two folders: what is there at
    the start, and what arrives after a restart."""
    files = sorted(p for p in Path(X.out_of_order_files(spark, SF_SMALL, table, order).removeprefix("file:")).iterdir()
                   if p.suffix == ".parquet")
    assert len(files) == X.BATCHES
    inbox = tmp_path / "in"
    inbox.mkdir()
    return inbox, files


def test_like_state_goes_on_after_a_restart(spark, tmp_path):
    inbox, files = _part_files(tmp_path, spark, "events", "ts")
    sink, check = str(tmp_path / "sink"), str(tmp_path / "check")
    for half in (files[:2], files[2:]):
        for f in half:
            shutil.copy(f, inbox)
        ev = X.file_stream(spark, str(inbox), "events", 1)
        log = ev.select(F.col("event_id").alias("seq"), F.when(F.col("event_type") == "error", "delete").otherwise("put").alias("op"),
                        F.get_json_object("props", "$.k").cast("bigint").alias("postID"), F.col("user_id").alias("userID"), "ts")
        X.run_available(X.stream_like_state(log, sink, check))
    got = S.apply_changes(X.like_changes(spark, sink), X.LIKE_KEYS, "seq")
    want = S.apply_changes(Bindings(spark, SF_SMALL).like_log, X.LIKE_KEYS, "seq")
    assert sorted(map(tuple, got.select(*X.LIKE_KEYS).collect())) == sorted(map(tuple, want.select(*X.LIKE_KEYS).collect()))


def test_friend_requests_remember_after_a_restart(spark, tmp_path):
    inbox, files = _part_files(tmp_path, spark, "events", "ts")
    sink, check = str(tmp_path / "sink"), str(tmp_path / "check")
    for half in (files[:2], files[2:]):
        for f in half:
            shutil.copy(f, inbox)
        ev = X.file_stream(spark, str(inbox), "events", 1).where(F.col("event_type") == "signup")
        req = ev.select(F.col("user_id").alias("recipientID"), F.get_json_object("props", "$.k").cast("bigint").alias("senderID"), "ts")
        X.run_available(X.stream_friend_requests(req, sink, check))
    got = spark.read.parquet(sink).select("recipientID", "senderID")
    want = Bindings(spark, SF_SMALL).notifications.select("recipientID", "senderID").distinct()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_keyword_index_stream_equals_batch_for_any_batching(spark):
    from plexus.operators import text as T

    files = X.out_of_order_files(spark, SF_SMALL, "documents", "doc_id")
    got = X.run_keyword_index(spark, files, stem=False, max_files=1).select("keyword", "headline", "url")
    want = T.build_keyword_index(Bindings(spark, SF_SMALL).news, stem=False)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_message_log_drops_blank_and_adds_names(spark):
    out = X.run_message_log(spark, SF_SMALL, Bindings(spark, SF_SMALL).accounts)
    assert out.count() == 1000
    assert out.where(F.col("firstName").isNull()).count() == out.where(F.col("userID") >= 150).count()


def test_friend_request_stream_drops_repeats(spark):
    got = X.run_friend_requests(spark, SF_SMALL)
    want = Bindings(spark, SF_SMALL).notifications.select("recipientID", "senderID").distinct()
    pairs = got.select("recipientID", "senderID")
    assert pairs.count() == pairs.distinct().count() == want.count()
    assert pairs.exceptAll(want).count() == 0


def test_pending_requests_until_accepted_over_a_restart(spark, tmp_path):
    """Files latest first, cut by a restart: the same as the batch jobs; the
    state holds waiting requests only."""
    inbox, files = _part_files(tmp_path, spark, "events", "ts")
    sink, check = str(tmp_path / "sink"), str(tmp_path / "check")
    b = Bindings(spark, SF_SMALL)
    for half in (files[:2], files[2:]):
        for f in half:
            shutil.copy(f, inbox)
        stream = Bindings(spark, SF_SMALL, X.file_stream(spark, str(inbox), "events", 1))
        q = X.stream_pending_requests(X.request_events(stream.request_log, stream.accepts_of(b.first_requests)), sink, check)
        X.run_available(q)
    sent, pending = X.streamed_requests(spark, sink, b.old_friends, b.pending_before)
    rows = lambda df: sorted((r.recipientID, r.senderID, str(r.ts), r.seq or -1) for r in df.collect())
    assert rows(sent) == rows(S.friend_requests(b.request_log, b.old_friends, b.pending_before, b.accepts).where("status = 'sent'"))
    assert rows(pending) == rows(S.pending_requests(b.request_log, b.accepts, b.old_friends, b.pending_before))


def test_state_is_dropped_on_acceptance(spark, tmp_path):
    """As many pairs again and again, all accepted: no state is left."""
    ask = "recipientID long, senderID long, notificationType string, ts timestamp, seq long"
    said = "recipientID long, senderID long, requestTs timestamp, ts timestamp, seq long"
    for k in range(3):
        spark.range(50).selectExpr("id as recipientID", "id + 1 as senderID", "'friendRequest' as notificationType",
                                   f"timestamp_seconds({k}) as ts", f"{k} * 1000 + id as seq").coalesce(1).write.mode("append").parquet(str(tmp_path / "ask"))
        spark.range(50).where("id <> 7").selectExpr("id as recipientID", "id + 1 as senderID", f"timestamp_seconds({k}) as requestTs",
                                                    "timestamp_seconds(99) as ts", f"{k} * 1000 + 500 + id as seq").coalesce(1).write.mode("append").parquet(str(tmp_path / "said"))
        requests = spark.readStream.schema(ask).parquet(str(tmp_path / "ask"))
        accepts = spark.readStream.schema(said).parquet(str(tmp_path / "said"))
        q = X.stream_pending_requests(X.request_events(requests, accepts), str(tmp_path / "sink"), str(tmp_path / "check"))
        X.run_available(q)
        assert q.lastProgress.stateOperators[0].numRowsTotal == 1  # the one that nobody accepted


def test_like_counts_keep_many_keys_per_state(spark, tmp_path):
    """Late, repeated and null rows over several batches; the state is at most one row per bucket."""
    kinds = "postID long, userID long, seq long, op string, ts timestamp"
    rows = [(p, u, s, op, None) for p in (1, 2, None, 2**60 + 1) for u in range(40) for s, op in ((5, "put"), (9 + u % 3, "delete" if u % 2 else "put"))]
    late = [(1, 0, 1, "delete", None), (1, 1, 99, "put", None), (None, 2, 99, "delete", None), (2, None, 1, "put", None), (2, 3, None, "put", None), (2, 4, 100, None, None)]
    sink, check = str(tmp_path / "sink"), str(tmp_path / "check")
    for part in (rows[::2], rows[1::2], late):
        spark.createDataFrame(part, kinds).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q = X.stream_like_counts(spark.readStream.schema(kinds).parquet(str(tmp_path / "in")), sink, check)
        X.run_available(q)
    assert 0 < q.lastProgress.stateOperators[0].numRowsTotal <= X.LIKE_BUCKETS
    newest = {}
    for p, u, s, op, _ in rows + late:
        if u is not None and s is not None and (p, u) not in newest or u is not None and s is not None and s > newest[p, u][0]:
            newest[p, u] = (s, op is not None and op != "delete")
    want = {}
    for (p, _), (_, put) in newest.items():
        want[p] = want.get(p, 0) + put
    assert {r.postID: r.n_likes for r in X.like_counts(spark, sink).collect()} == {p: n for p, n in want.items() if n}


def test_grown_index_deals_repeated_headlines_only(spark, tmp_path):
    from plexus.operators import text as T

    def epoch(n, *rows):
        spark.createDataFrame(rows, X.KEYWORDS).write.parquet(f"{tmp_path}/epoch={n}")

    epoch(0, ("a", "h1", "u1"), ("b", "h1", "u1"), ("a", None, "u1"))
    epoch(1, ("a", "h2", None))
    got = X.grown_index(spark, str(tmp_path))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString() and got.count() == 4
    epoch(2, ("a", "h1", "u2"), ("c", "h1", "u2"), ("a", None, "u0"), ("d", None, None))
    got = sorted(map(tuple, X.grown_index(spark, str(tmp_path)).collect()), key=repr)
    want = sorted([("a", "h1", "u2"), ("b", "h1", "u1"), ("c", "h1", "u2"), ("a", None, "u1"), ("d", None, None), ("a", "h2", None)], key=repr)
    assert got == want
    many, T.REPEATED = T.REPEATED, 1
    try:
        assert sorted(map(tuple, X.grown_index(spark, str(tmp_path)).collect()), key=repr) == want
    finally:
        T.REPEATED = many
