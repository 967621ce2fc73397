"""Follower-graph jobs: golden ranks on the six-edge demo graph (values
re-derived by hand from the rank rules), the decision rules D4-D9, and
properties on the driver tables."""

import random

import pytest
from pyspark.sql import functions as F

from plexus.operators import graph as G
from plexus.sources.bindings import Bindings
from plexus.sources.edges import read_edge_list
from tests.conftest import SF_SMALL

DEMO = [(1, 3), (3, 1), (1, 2), (2, 4), (3, 2), (3, 4)]


@pytest.fixture(scope="module")
def demo(spark):
    return spark.createDataFrame(DEMO, "src bigint, dst bigint")


def ranks(df):
    return {r.node: round(r.rank, 6) for r in df.collect()}


def test_demo_counts(demo):
    assert [r.node for r in G.find_sinks(demo).collect()] == [4]
    assert sorted(tuple(r) for r in G.back_links(demo).collect()) == [(4, 2), (4, 3)]
    s = G.edge_stats(demo).first()
    assert (s.n_edges, s.n_destinations, s.n_nodes, s.n_sinks, s.n_back_links) == (6, 4, 4, 1, 2)
    assert G.add_back_links(demo).count() == 8
    deg = {r.node: r.degree for r in G.degree_ranking(demo).collect()}
    assert deg == {3: 3, 1: 2, 2: 1}


@pytest.mark.parametrize("kw,expected", [
    (dict(max_iters=1, delta=None), {1: 0.433333, 2: 1.283333, 3: 1.0, 4: 1.283333}),
    (dict(max_iters=2, delta=None), {1: 0.433333, 2: 1.162917, 3: 0.879583, 4: 1.524167}),
    (dict(max_iters=3, delta=None), {1: 0.399215, 2: 1.231153, 3: 0.981937, 4: 1.387694}),
    (dict(max_iters=25, delta=1e-4), {1: 0.416039, 2: 1.204877, 3: 0.938838, 4: 1.440245}),
    (dict(max_iters=25, delta=None), {1: 0.416015, 2: 1.204910, 3: 0.938894, 4: 1.440180}),
    (dict(), {1: 1.0, 2: 1.0, 3: 1.0, 4: 1.0}),  # default delta 30 stops in round 1 (D5)
])
def test_demo_ranks_with_back_links(demo, kw, expected):
    assert ranks(G.social_rank(demo, **kw)) == pytest.approx(expected, abs=1e-6)


@pytest.mark.parametrize("kw,expected", [
    (dict(max_iters=1, delta=None), {1: 0.433333, 2: 0.858333, 3: 0.575, 4: 1.283333}),
    (dict(max_iters=3, delta=None), {1: 0.244681, 2: 0.377670, 3: 0.282990, 4: 0.667201}),
    (dict(max_iters=25, delta=1e-4), {1: 0.218873, 2: 0.311905, 3: 0.243032, 4: 0.484058}),
    (dict(), {1: 1.0, 2: 1.0, 3: 1.0}),
])
def test_demo_ranks_without_back_links(demo, kw, expected):
    assert ranks(G.social_rank(demo, back_links=False, **kw)) == pytest.approx(expected, abs=1e-6)


def test_early_stop_returns_previous_round(demo):
    res = G.social_rank_run(demo, max_iters=25, delta=1e-4)
    assert res.converged and res.rounds == 21
    latest = G.social_rank_run(demo, max_iters=25, delta=1e-4, return_latest=True)
    r20, r21 = ranks(res.ranks), ranks(latest.ranks)
    assert max(abs(r20[k] - r21[k]) for k in r20) <= 1e-4


def test_single_edge_without_back_links_does_not_fail(spark):
    e = spark.createDataFrame([(1, 2)], "src bigint, dst bigint")
    out = ranks(G.social_rank(e, back_links=False, max_iters=25, delta=1e-4))
    # round 1 moves the rank to node 2 (no common node: not converged, D6);
    # round 2 is empty, so the round-1 vector is kept
    assert out == {2: 1.0}


def test_salted_path_equals_plain_path(spark):
    e = Bindings(spark, SF_SMALL).edges
    plain = ranks(G.social_rank(e, max_iters=3, delta=None))
    salted = ranks(G.social_rank(e, max_iters=3, delta=None, fanout_chunk=2))
    assert plain == salted and len(plain) > 100


def test_history_and_top(demo):
    h = G.rank_history(demo, 3)
    assert sorted({r["round"] for r in h.collect()}) == [1, 2, 3]
    top = [r.node for r in G.top_ranked(G.social_rank(demo, max_iters=3, delta=None), 2).collect()]
    assert top == [4, 2]
    a = G.social_rank(demo, max_iters=3, delta=None)
    b = G.social_rank(demo, max_iters=3, delta=None, back_links=False)
    m = {r.node: r.membership for r in G.compare_top(a, b, 2).collect()}
    assert m == {4: "both", 2: "both"}


def test_weights_sum_to_one_and_back_links_leave_no_sink(spark):
    e = Bindings(spark, SF_SMALL).edges
    w = G.transition_weights(e).groupBy("src").agg(F.sum("w").alias("s"))
    assert w.where(F.abs(F.col("s") - 1.0) > 1e-9).count() == 0
    assert G.find_sinks(G.add_back_links(e)).count() == 0


def test_read_edge_list(spark, tmp_path):
    p = tmp_path / "edges.txt"
    p.write_text("1 2\n1 2\n2\t3\n3   4 extra\n")
    got = sorted(tuple(r) for r in read_edge_list(spark, str(p)).collect())
    assert got == [(1, 2), (2, 3), (3, 4)]
    bad = tmp_path / "bad.txt"
    bad.write_text("1 2\nx 1\n")
    with pytest.raises(Exception):
        read_edge_list(spark, str(bad)).collect()
    assert [tuple(r) for r in read_edge_list(spark, str(bad), mode="drop").collect()] == [(1, 2)]


def _brute_common(friends_rows, a, b):
    adj = {}
    for u, v in friends_rows:
        adj.setdefault(u, set()).add(v)
    return len(adj.get(a, set()) & adj.get(b, set()))


def test_mutual_friends_matches_brute_force(spark):
    f = Bindings(spark, SF_SMALL).friends.select("followerID", "followedID")
    rows = [tuple(r) for r in f.collect()]
    got = {(r.a, r.b): r.n_mutual for r in G.mutual_friends(f).collect()}
    assert got
    for (a, b), n in got.items():
        assert n == _brute_common(rows, a, b)


def test_expand_network_small(spark):
    acc = spark.createDataFrame(
        [(1, "A", "a", "X"), (2, "B", "b", "X"), (3, "C", "c", "X"), (4, "D", "d", "Y"), (5, "E", "e", "X")],
        "userID bigint, firstName string, lastName string, affiliation string")
    pairs = [(1, 2), (2, 3), (2, 4), (2, 5), (5, 1), (3, 5)]
    rows = pairs + [(b, a) for a, b in pairs]
    fr = spark.createDataFrame(rows, "followerID bigint, followedID bigint")
    req = spark.createDataFrame([(0, 1, 2)], "request_id int, viewer bigint, friend bigint")
    nodes, edges = G.expand_network(acc, fr, req)
    # friends of 2: 1 (viewer), 3, 4 (other affiliation), 5 (already a friend of 1)
    assert sorted((r.id, r.label) for r in nodes.collect()) == [(3, "C c")]
    # 2 -> 3 and, since 3 is friends with shown node 5, 5 -> 3
    assert sorted((r.src, r.dst) for r in edges.collect()) == [(2, 3), (5, 3)]


def plain_expansion(accounts, friends, screen, viewer, friend):
    """One click by loops: (new nodes, edges)."""
    aff = {a[0]: a[3] for a in accounts}
    new = sorted({b for a, b in friends if a == friend and b not in screen and aff.get(b) == aff[viewer]})
    edges = [(friend, n) for n in new]
    edges += [(x, n) for n in new for x in sorted(screen) if x != friend and (n, x) in friends]
    return new, sorted(edges)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_expansion_equals_loops(spark, seed):
    rng = random.Random(seed)
    accounts = [(i, f"F{i}", f"L{i}", rng.choice("XY")) for i in range(30)]
    friends = set()
    for _ in range(70):
        a, b = rng.sample(range(30), 2)
        friends |= {(a, b), (b, a)}
    friends |= {(0, i) for i in range(1, 25)} | {(i, 0) for i in range(1, 25)}     # a hub
    clicks = [(r, s, r % 30, rng.randrange(30)) for r in range(12) for s in (1, 2, 3)]
    acc = spark.createDataFrame(accounts, "userID bigint, firstName string, lastName string, affiliation string")
    fr = spark.createDataFrame(sorted(friends), "followerID bigint, followedID bigint")
    cl = spark.createDataFrame(clicks, "request_id bigint, step int, viewer bigint, friend bigint")
    nodes, edges = G.expand_network_steps(acc, fr, cl, 3)
    got_n = sorted((r.request_id, r.step, r.id) for r in nodes.collect())
    got_e = sorted((r.request_id, r.step, r.src, r.dst) for r in edges.collect())
    want_n, want_e = [], []
    for r in range(12):
        screen = {r} | {b for a, b in friends if a == r}
        for _, s, viewer, friend in [c for c in clicks if c[0] == r]:
            new, links = plain_expansion(accounts, friends, screen, viewer, friend)
            want_n += [(r, s, n) for n in new]
            want_e += [(r, s, *e) for e in links]
            screen |= set(new)
    assert got_n == sorted(want_n) and got_e == sorted(want_e)


def test_expansion_with_given_screen(spark):
    acc = spark.createDataFrame([(i, "F", str(i), "X" if i != 4 else "Y") for i in range(1, 7)],
                                "userID bigint, firstName string, lastName string, affiliation string")
    pairs = [(1, 2), (2, 3), (2, 4), (2, 5), (3, 6), (5, 6)]
    fr = spark.createDataFrame(pairs + [(b, a) for a, b in pairs], "followerID bigint, followedID bigint")
    req = spark.createDataFrame([(0, 1, 2), (1, 1, 2)], "request_id int, viewer bigint, friend bigint")
    shown = spark.createDataFrame([(0, 1), (0, 2), (0, 6), (0, 6)], "request_id int, id bigint")
    nodes, edges = G.expand_network(acc, fr, req, shown)
    # 4 has another affiliation; request 1 shows nothing yet, so the viewer is new as well
    assert sorted((r.request_id, r.id) for r in nodes.collect()) == [(0, 3), (0, 5), (1, 1), (1, 3), (1, 5)]
    assert sorted((r.request_id, r.src, r.dst) for r in edges.collect()) == [
        (0, 2, 3), (0, 2, 5), (0, 6, 3), (0, 6, 5), (1, 2, 1), (1, 2, 3), (1, 2, 5)]
    none, no_edges = G.expand_network(acc, fr, req.limit(0), shown)
    assert none.count() == 0 and no_edges.count() == 0


def test_star_lays_out_one_affiliation_only(spark):
    """Every friend of a hub expands the hub: rows are those of the viewer's affiliation."""
    acc = spark.range(201).selectExpr("id AS userID", "'F' AS firstName", "string(id) AS lastName",
                                      "string(id % 50) AS affiliation")
    fr = spark.range(1, 201).selectExpr("explode(array(struct(0L AS followerID, id AS followedID), "
                                        "struct(id AS followerID, 0L AS followedID))) AS p").select("p.*")
    req = spark.range(1, 201).selectExpr("id AS request_id", "id AS viewer", "0L AS friend")
    cand = G._candidates(acc, fr, req)
    assert cand.count() == 200 * 4


def test_keep_sourceless_keeps_floor_value(demo, spark):
    # node 5 only points into the graph: it has no in-edge, so it drops out
    # after round 1 by default (D2) and stays at d with keep_sourceless
    e = demo.unionByName(spark.createDataFrame([(5, 1)], "src bigint, dst bigint"))
    default = ranks(G.social_rank(e, max_iters=2, delta=None))
    kept = ranks(G.social_rank(e, max_iters=2, delta=None, keep_sourceless=True))
    assert 5 not in default and kept[5] == pytest.approx(0.15)


def test_top_report_sink(spark, demo, tmp_path):
    from plexus.sources.sinks import write_report

    top = G.top_ranked(G.social_rank(demo, max_iters=3, delta=None), 10)
    write_report(top, str(tmp_path / "report"))
    back = spark.read.schema("node bigint, rank double").json(str(tmp_path / "report"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, top.collect()))
    assert len(list((tmp_path / "report").glob("part-*"))) == 1


def test_top_report_line(demo):
    r = G.social_rank(demo, max_iters=1, delta=None)
    line = G.top_report_line(r.withColumn("rank", F.round("rank", 6)), 3).first().line
    assert line == "top 3 nodes: [(2, 1.283333), (4, 1.283333), (3, 1.0)]"


def test_edges_are_sorted_once_not_in_every_round(spark):
    edges = spark.range(500).selectExpr("id % 50 as src", "id % 73 as dst").distinct()
    for chunk in (1 << 17, 3):
        wedges, fanout, ranks, deg = G._prepare(edges, chunk)
        new = G._round(ranks, wedges, fanout, 0.15, False)
        keys = ["src", "salt"] if fanout is not None else ["src"]
        other = spark.range(50).selectExpr("id as src", "cast(id % 2 as int) as salt")
        plan = wedges.join(other.hint("merge"), keys)._jdf.queryExecution().executedPlan().toString()
        edge_side = plan[plan.index("SortMergeJoin"):plan.index("InMemoryTableScan")]
        assert "Sort [" not in edge_side and "Exchange" not in edge_side, edge_side
        assert new.count() == edges.select("dst").distinct().count()
        for df in (wedges, fanout, deg):
            if df is not None:
                df.unpersist()


def test_common_neighbours_by_lists_and_by_rows(spark, monkeypatch):
    """F8: short lists travel as arrays; hubs, repeated and null friends go by rows."""
    import random

    from plexus.operators import common as C

    rng = random.Random(8)
    rows = [(rng.randrange(30), rng.randrange(30)) for _ in range(300)] + [(0, k) for k in range(1, 60)] + [(1, None), (None, 2), (3, None)]
    f = spark.createDataFrame([(*r, 0) for r in rows], "followerID long, followedID long, ts long").cache()
    pairs = spark.createDataFrame([(a, b) for a in range(12) for b in range(12)] + [(0, 1), (99, 1), (None, 3)], "a long, b long").cache()
    adj = {}
    for a, b in rows:
        adj.setdefault(a, []).append(b)

    def expected(a, b):  # the smaller side's rows count, the other's are looked up
        if a is None or a not in adj or b not in adj:
            return []
        lo, hi = (a, b) if (len(adj[a]), a) <= (len(adj[b]), b) else (b, a)
        return [(a, b, x) for x in adj[lo] if x is not None and x in adj[hi]]

    want = sorted(r for p in pairs.collect() for r in expected(p.a, p.b))
    for limit in (0, 12, 1024):
        monkeypatch.setattr(C, "LIST", limit)
        assert sorted(map(tuple, G.common_neighbours(pairs, f).collect())) == want
        lists = C.item_lists(f, "followerID", "followedID").collect()
        assert {r.followerID for r in lists} == set(adj) - {None}
        assert all((r["items"] is None) == (len(adj[r.followerID]) > limit or None in adj[r.followerID] or len(set(adj[r.followerID])) < len(adj[r.followerID]))
                   for r in lists)


def test_expand_steps_share_what_no_screen_changes(spark):
    """friend lists and candidates are made once, not once per step."""
    import os

    base = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    tables = lambda: [d.rsplit("-", 1)[0] for d in os.listdir(base) if d.startswith("expand-")] if os.path.isdir(base) else []
    before = tables()
    f = spark.createDataFrame([(a, b, b) for a in range(8) for b in range(8) if a != b and (a * b) % 3], "followerID long, followedID long, ts long")
    acc = spark.createDataFrame([(a, f"u{a}", "f", "l", "x") for a in range(8)], "userID long, username string, firstName string, lastName string, affiliation string")
    nodes, edges = G.expand_network_steps(acc, f, G.oldest_friend_clicks(f, 3), 3)
    edges.collect()
    made = tables()
    for x in before:
        made.remove(x)
    assert sorted(made) == ["expand-candidates", "expand-clicks", "expand-friends", "expand-lists", "expand-nodes", "expand-nodes", "expand-nodes", "expand-screen"]
