"""Epoch folders and their merging, like counts kept in the stream, and the
stored name index under sign-ups and renames, each against a plain loop."""

import random
import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

from plexus.operators import text as T
from plexus.sources import epochs, name_index
from plexus.streaming import jobs as X

SCHEMA = "k long, v long"


def _sums(rows):
    return rows.groupBy("k").agg(F.sum("v").alias("v"))


def _store(rows, path):
    rows.write.mode("overwrite").parquet(path)


def _batch(spark, epoch):
    return spark.createDataFrame([(i % 3, epoch * 10 + i) for i in range(5)], SCHEMA)


def _totals(spark, sink):
    return {r.k: r.v for r in _sums(epochs.read_epochs(spark, sink, SCHEMA)).collect()}


def test_folders_read_grow_with_the_logarithm_of_the_epochs(spark, tmp_path):
    sink, want = str(tmp_path / "sink"), Counter()
    assert epochs.live(spark, sink) == [] and _totals(spark, sink) == {}
    for n in range(11):
        _store(_batch(spark, n), f"{sink}/epoch={n}")
        for i in range(5):
            want[i % 3] += n * 10 + i
        epochs.merge_epochs(spark, sink, SCHEMA, _sums, _store, 2)
        spans = [(a, b) for a, b, _ in epochs.live(spark, sink)]
        assert len(spans) == bin(n + 1).count("1")
        assert [e for a, b in spans for e in range(a, b + 1)] == list(range(n + 1))
        assert _totals(spark, sink) == want
    assert spans == [(0, 7), (8, 9), (10, 10)]
    assert epochs.merge_epochs(spark, sink, SCHEMA, _sums, _store, 2) == 0


def test_a_merge_that_died_is_not_read_and_done_again(spark, tmp_path):
    sink = tmp_path / "sink"
    for n in range(2):
        _store(_batch(spark, n), f"{sink}/epoch={n}")
    want = _totals(spark, str(sink))
    epochs.merge_epochs(spark, str(sink), SCHEMA, _sums, _store, 2)
    (sink / "run=0-1" / "_SUCCESS").unlink()  # died before the switch
    assert [p[:2] for p in epochs.live(spark, str(sink))] == [(0, 0), (1, 1)]
    assert _totals(spark, str(sink)) == want
    assert epochs.merge_epochs(spark, str(sink), SCHEMA, _sums, _store, 2) == 1
    assert [p[:2] for p in epochs.live(spark, str(sink))] == [(0, 1)]
    assert _totals(spark, str(sink)) == want


def test_a_missing_epoch_keeps_its_block_unmerged(spark, tmp_path):
    sink = str(tmp_path / "sink")
    for n in (0, 2, 3):
        _store(_batch(spark, n), f"{sink}/epoch={n}")
    assert epochs.merge_epochs(spark, sink, SCHEMA, _sums, _store, 2) == 1
    assert [p[:2] for p in epochs.live(spark, sink)] == [(0, 0), (2, 3)]


LOG = "seq long, op string, postID long, userID long, ts timestamp"


@pytest.mark.parametrize("seed", [0, 1])
def test_like_counts_with_toggles_in_any_order_and_a_restart(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(s, rng.choice(["put", "put", "delete", None]), rng.choice([1, 2, 2, 2, None]), rng.choice([7, 8, 9, None]), None)
            for s in range(60)] + [(None, "put", 1, 7, None)]
    last = {}
    for s, op, post, user, _ in rows:
        if s is not None:
            last[post, user] = op in ("put",)
    want = Counter(post for (post, user), put in last.items() if put and user is not None)
    rng.shuffle(rows)
    inbox, sink, check = tmp_path / "in", str(tmp_path / "sink"), str(tmp_path / "check")
    inbox.mkdir()
    for half in (rows[:30], rows[30:]):  # the second half arrives after a restart
        for i in range(0, len(half), 10):
            name = f"events-{half is rows}-{rows.index(half[i])}.parquet"
            spark.createDataFrame(half[i:i + 10], LOG).coalesce(1).write.parquet(str(tmp_path / "one" / name))
            part = next((tmp_path / "one" / name).glob("part-*.parquet"))
            shutil.copy(part, inbox / name)
        log = X.file_stream(spark, str(inbox), "events", 1)
        X.run_available(X.stream_like_counts(log, sink, check, fanout=2))
    got = {r.postID: r.n_likes for r in X.like_counts(spark, sink).collect()}
    assert got == dict(want)
    assert len(epochs.live(spark, sink)) <= 3


def _names(spark, names):
    return spark.createDataFrame(list(names.items()), "userID long, username string")


def test_name_index_equals_a_rebuilt_one(spark, tmp_path):
    path, names = str(tmp_path / "names"), {1: "Anna", 2: "anton", 3: "Bo", 4: None, 5: ""}
    steps = [names, {**names, 6: "Ann", 7: "annabel"},                     # sign-ups
             {**names, 1: "anton", 2: "Anna", 6: "Bob", 7: "annabel"},     # a swap and a rename
             {1: "anton", 2: "Anna", 4: "late", 5: "", 6: "Ann", 7: None}]  # back again, gone, named late
    before = {}
    for epoch, after in enumerate(steps):
        touched = _names(spark, {u: "" for u in {*before, *after}})
        changes = name_index.name_changes(_names(spark, before) if before else _names(spark, names).limit(0), _names(spark, after), touched)
        name_index.add_names(changes, path, epoch, parts=3, fanout=2)
        got = {(r.prefix, r.userID) for r in name_index.stored_names(spark, path).collect()}
        rebuilt = {(n.lower()[:k], u) for u, n in after.items() if n for k in range(1, len(n) + 1)}
        assert got == rebuilt
        searches = spark.createDataFrame([(1, "AN"), (2, "b"), (3, "zz"), (4, None)], "query_id long, query string")
        accounts = _names(spark, after)
        found = name_index.search_stored_users(searches, path, accounts, parts=3)
        want = T.search_users(searches, T.build_prefix_index(accounts), accounts)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
        before = after
    # a repeated batch overwrites its folder
    name_index.add_names(changes, path, 3, parts=3, fanout=2)
    assert {(r.prefix, r.userID) for r in name_index.stored_names(spark, path).collect()} == rebuilt


def test_a_name_lookup_reads_the_folders_of_its_prefixes(spark, tmp_path):
    path = str(tmp_path / "names")
    accounts = _names(spark, {u: f"user{u}" for u in range(50)})
    name_index.add_names(name_index.name_changes(accounts.limit(0), accounts, accounts), path, 0, parts=8)
    searches = spark.createDataFrame([(1, "user4")], "query_id long, query string")
    found = name_index.search_stored_users(searches, path, accounts, parts=8)
    assert found.count() == 11
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "part#" in plan.split("PartitionFilters")[1][:60]


def test_prefix_changes_of_users_with_several_names(spark):
    """One row per (prefix, user); a prefix of any new name stays."""
    changes = spark.createDataFrame([(1, "Anna", "Ann"), (1, "Annabel", "Bo"), (1, "Zoe", "Ann"), (2, None, "x"), (2, "", "xy"), (3, "xy", None),
                                     (4, "ab", "ab"), (None, "q", "qr")], "userID long, old_name string, new_name string")
    got = name_index.prefix_changes(changes)
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "HashAggregate" not in plan[:plan.index("Generate explode")]
    want = {}
    for r in changes.collect():
        for name, put in ((r.old_name, False), (r.new_name, True)):
            for n in range(1, len(name or "") + 1):
                key = (name[:n].lower(), r.userID)
                want[key] = want.get(key, False) or put
    rows = got.collect()
    assert len(rows) == len(want) and {(r.prefix, r.userID): r.put for r in rows} == want
