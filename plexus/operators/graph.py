"""Follower-graph jobs: counts, sinks, back-links, transition weights, the
iterative social rank, top-k reports, ego networks and friend counts.

Edges are ``(src, dst)``: src is the followed node, dst the follower; rank
flows from src to dst.  Every function is DataFrame in, DataFrame out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plexus.operators.common import item_lists, listed_items, stored
from plexus.session import ensure_checkpoint_dir

# Number of out-edges of one source that one task handles in a rank round.
# Sources with more edges are split over ceil(degree / chunk) salted buckets,
# so a hub holding a third of all edges does not land in one task.
DEFAULT_FANOUT_CHUNK = 1 << 17


def node_roles(edges: DataFrame) -> DataFrame:
    """(node, is_source, is_destination, in_degree, out_degree); one scan of
    the edges, one shuffle, partial aggregation keeps hubs cheap."""
    both = F.explode(F.array(F.struct(F.col("src").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")),
                             F.struct(F.col("dst").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i"))))
    sides = edges.select(both.alias("e")).select("e.*")
    return (sides.groupBy("node")
            .agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"))
            .select("node", (F.col("out_degree") > 0).alias("is_source"),
                    (F.col("in_degree") > 0).alias("is_destination"),
                    "in_degree", "out_degree"))


def edge_stats(edges: DataFrame) -> DataFrame:
    """One row of graph counts.  ``n_destinations`` is what the reference
    calls "nodes" (D8); ``n_nodes`` counts sources and destinations."""
    r = node_roles(edges)
    sink = F.col("is_destination") & ~F.col("is_source")
    return r.agg(
        F.sum("out_degree").alias("n_edges"),
        F.count("*").alias("n_nodes"),
        F.count_if("is_source").alias("n_sources"),
        F.count_if("is_destination").alias("n_destinations"),
        F.count_if(sink).alias("n_sinks"),
        F.coalesce(F.sum(F.when(sink, F.col("in_degree"))), F.lit(0)).alias("n_back_links"))


def degree_ranking(edges: DataFrame) -> DataFrame:
    """Out-degree per node, highest first (ties by node id)."""
    return (edges.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("degree"))
            .orderBy(F.desc("degree"), "node"))


def find_sinks(edges: DataFrame) -> DataFrame:
    """Destinations that are never a source (one scan, one shuffle)."""
    return node_roles(edges).where(F.col("is_destination") & ~F.col("is_source")).select("node")


def back_links(edges: DataFrame) -> DataFrame:
    """G5 part: for every edge into a sink, the reverse edge (sink -> pred)."""
    into_sinks = edges.join(find_sinks(edges).withColumnRenamed("node", "dst"), "dst", "left_semi")
    return into_sinks.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def add_back_links(edges: DataFrame) -> DataFrame:
    """Edges plus back-links.  A back-link starts at a sink, which is
    never the source of an input edge, so the union of distinct inputs is
    already distinct: no extra shuffle for ``distinct``."""
    return edges.select("src", "dst").unionByName(back_links(edges))


def transition_weights(edges: DataFrame) -> DataFrame:
    """(src, dst, w) with w = 1 / out-degree(src)."""
    deg = edges.groupBy("src").agg(F.count("*").alias("out_degree"))
    return edges.join(deg, "src").select("src", "dst", (F.lit(1.0) / F.col("out_degree")).alias("w"))


# ------------------------------------------------------------------ rank


@dataclass
class RankResult:
    ranks: DataFrame          # (node, rank)
    rounds: int               # rounds computed
    converged: bool           # stopped by the delta test
    history: DataFrame | None  # (round, node, rank) when requested


def _prepare(edges: DataFrame, chunk: int):
    """Weighted edges keyed for the rank join, persisted once.

    Returns (wedges, fanout, init, deg).  When no source has more than
    ``chunk`` out-edges the edges are hash-partitioned on ``src`` -- the same
    partitioning the per-round aggregate produces on ``node`` -- so the
    rank/edge join needs no exchange on the edge side; they are sorted once, so
    it needs no sort of them in every round either.  Otherwise each hot
    source is split over ``nsalt`` buckets by a hash of dst, and the (small)
    rank vector is replicated to the buckets of its node each round.
    """
    spark = edges.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    deg = edges.groupBy("src").agg(F.count("*").alias("out_degree"))
    deg = deg.withColumn("nsalt", F.ceil(F.col("out_degree") / F.lit(chunk)).cast("int"))
    deg = deg.persist(StorageLevel.MEMORY_AND_DISK)
    max_salt = deg.agg(F.max("nsalt")).first()[0] or 1
    w = edges.join(deg, "src").select(
        "src", "dst", (F.lit(1.0) / F.col("out_degree")).alias("w"),
        F.pmod(F.xxhash64("dst"), F.col("nsalt")).cast("int").alias("salt"))
    if max_salt > 1:
        wedges = w.repartition(parts, "src", "salt").sortWithinPartitions("src", "salt")
        fanout = deg.select(F.col("src").alias("node"), "nsalt").repartition(parts, "node")
        fanout = fanout.persist(StorageLevel.MEMORY_AND_DISK)
    else:
        wedges = w.drop("salt").repartition(parts, "src").sortWithinPartitions("src")
        fanout = None
    wedges = wedges.persist(StorageLevel.MEMORY_AND_DISK)
    wedges.count()  # how they lie is known to the rounds' plans only once they are stored
    init = deg.select(F.col("src").alias("node"), F.lit(1.0).alias("rank"))
    return wedges, fanout, init, deg


def _round(ranks: DataFrame, wedges: DataFrame, fanout: DataFrame | None, d: float,
           keep_sourceless: bool) -> DataFrame:
    if fanout is None:
        contrib = wedges.join(ranks.withColumnRenamed("node", "src"), "src")
    else:
        rep = (ranks.join(fanout, "node")
               .select(F.col("node").alias("src"), "rank",
                       F.explode(F.sequence(F.lit(0), F.col("nsalt") - 1)).alias("salt")))
        contrib = wedges.join(rep, ["src", "salt"])
    new = (contrib.groupBy(F.col("dst").alias("node"))
           .agg(F.sum(F.col("rank") * F.col("w")).alias("s"))
           .select("node", (F.lit(d) + F.lit(1.0 - d) * F.col("s")).alias("rank")))
    if keep_sourceless:
        # nodes that receive nothing keep the floor value d (D2 option)
        missing = ranks.select("node").join(new.select("node"), "node", "left_anti")
        new = new.unionByName(missing.select("node", F.lit(d).alias("rank")))
    return new


def _stop_test(old: DataFrame, new: DataFrame):
    """Largest |new - old| over nodes in both vectors, how many such nodes,
    and the size of the new vector: one shuffle on node (a union and a
    group-by, not a join), then a one-row aggregate."""
    sides = old.select("node", (-F.col("rank")).alias("v"), F.lit(1).alias("o"), F.lit(0).alias("n")) \
        .unionByName(new.select("node", F.col("rank").alias("v"), F.lit(0).alias("o"), F.lit(1).alias("n")))
    per = sides.groupBy("node").agg(F.sum("v").alias("d"), F.max("o").alias("o"), F.max("n").alias("n"))
    both = (F.col("o") == 1) & (F.col("n") == 1)
    return per.agg(F.max(F.when(both, F.abs("d"))).alias("m"), F.count_if(both).alias("c"),
                   F.coalesce(F.sum("n"), F.lit(0)).alias("n_new")).first()


def social_rank_run(edges: DataFrame, d: float = 0.15, max_iters: int = 25,
                    delta: float | None = 30.0, back_links: bool = True,
                    keep_sourceless: bool = False, return_latest: bool = False,
                    keep_history: bool = False, fanout_chunk: int = DEFAULT_FANOUT_CHUNK,
                    checkpoint_interval: int | None = None) -> RankResult:
    """The iterative rank with early stop.

    Each round: rank(node) = d + (1 - d) * sum over in-edges (rank(src) * w).
    Initial vector: 1.0 for every node with an out-edge (after back-links).
    Stops when the largest change over nodes present in both vectors is at
    most ``delta`` and then returns the *previous* vector (D4) unless
    ``return_latest``; ``delta=None`` runs exactly ``max_iters`` rounds.

    Every ``checkpoint_interval``-th round and the returned vector are
    checkpointed to the session's reliable checkpoint folder, so lineage
    never spans more than that many rounds and a lost executor costs at most
    that many.  Default interval: 1 when a stop test runs (each round needs
    a job anyway, and a persisted, un-checkpointed round would drag its whole
    plan into the next), 5 for fixed rounds, whose rounds are simply chained
    (each references the previous once, so the plan stays linear).  The
    stop test is one job per round.
    """
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    # the input is read by back-links, sinks, degrees and weights: once
    edges = edges.select("src", "dst").persist(StorageLevel.MEMORY_AND_DISK)
    g = add_back_links(edges) if back_links else edges
    if checkpoint_interval is None:
        chained = delta is None and not keep_history and not keep_sourceless
        checkpoint_interval = 5 if chained else 1
    wedges, fanout, ranks, deg = _prepare(g, fanout_chunk)
    ranks = ranks.persist(StorageLevel.MEMORY_AND_DISK)
    held = [ranks]                      # persisted vectors still referenced
    written = []                        # checkpointed vectors
    history = []
    converged = False
    done = 0
    for i in range(1, max_iters + 1):
        new = _round(ranks, wedges, fanout, d, keep_sourceless)
        if keep_history or i % checkpoint_interval == 0:
            # persisted first, so writing the checkpoint reads the cache
            # instead of recomputing the round
            cached = new.persist(StorageLevel.MEMORY_AND_DISK)
            new = cached.checkpoint(eager=True)
            cached.unpersist()
            written.append(new)
        elif delta is not None:
            new = new.persist(StorageLevel.MEMORY_AND_DISK)
        # else chained: evaluated once, by the next checkpoint
        held.append(new)
        done = i
        if delta is not None:
            row = _stop_test(ranks, new)
            if row["n_new"] == 0:        # D6: nothing left to propagate
                converged = True
                break
            if row["c"] > 0 and row["m"] <= delta:
                converged = True
                if return_latest:
                    ranks = new
                    if keep_history:
                        history.append(new.withColumn("round", F.lit(i)))
                break
        ranks = new
        if keep_history:
            history.append(new.withColumn("round", F.lit(i)))
        # the vector two rounds back is no longer needed
        if delta is not None and len(held) > 2:
            held.pop(0).unpersist()
    if not any(ranks is w for w in written):
        ranks = ranks.persist(StorageLevel.MEMORY_AND_DISK)
        held.append(ranks)
        ranks = ranks.checkpoint(eager=True)
    hist = None
    if keep_history:
        hist = history[0] if history else spark.createDataFrame([], "node bigint, rank double, round int")
        for h in history[1:]:
            hist = hist.unionByName(h)
        hist = hist.select("round", "node", "rank")
    for h in held:
        h.unpersist()
    for df in (wedges, fanout, deg, edges):
        if df is not None:
            df.unpersist()
    return RankResult(ranks=ranks, rounds=done, converged=converged, history=hist)


def social_rank(edges: DataFrame, d: float = 0.15, max_iters: int = 25, delta: float | None = 30.0,
                back_links: bool = True, **kw) -> DataFrame:
    """G7 convenience: just the (node, rank) vector."""
    return social_rank_run(edges, d=d, max_iters=max_iters, delta=delta,
                           back_links=back_links, **kw).ranks


def rank_history(edges: DataFrame, rounds: int, **kw) -> DataFrame:
    """(round, node, rank) for every computed round, no driver collect."""
    return social_rank_run(edges, max_iters=rounds, delta=None, keep_history=True, **kw).history


def top_ranked(ranks: DataFrame, k: int = 10) -> DataFrame:
    """The k highest ranks; ties broken by node id (top-k is the feature)."""
    return ranks.orderBy(F.desc("rank"), F.asc("node")).limit(k)


def top_report_line(ranks: DataFrame, k: int = 10) -> DataFrame:
    """G9 report: one row, ``line`` = "top <k> nodes: [(node, rank), ...]",
    highest rank first.  Gathers the k report entries only (bounded by k)."""
    top = top_ranked(ranks, k).select(F.struct((-F.col("rank")).alias("o"), "node", "rank").alias("e"))
    items = F.transform(F.sort_array(F.collect_list("e")),
                        lambda e: F.concat(F.lit("("), e["node"].cast("string"), F.lit(", "),
                                           e["rank"].cast("string"), F.lit(")")))
    return top.agg(F.concat(F.lit(f"top {k} nodes: ["), F.array_join(items, ", "), F.lit("]")).alias("line"))


def compare_top(first: DataFrame, second: DataFrame, k: int = 10) -> DataFrame:
    """Membership of the two top-k lists: both / only_first / only_second."""
    a = top_ranked(first, k).select("node", F.lit(True).alias("in_a"))
    b = top_ranked(second, k).select("node", F.lit(True).alias("in_b"))
    j = a.join(b, "node", "full_outer")
    return j.select("node", F.when(F.col("in_a") & F.col("in_b"), "both")
                    .when(F.col("in_a"), "only_first").otherwise("only_second").alias("membership"))


# ------------------------------------------------------------- ego graphs


def _label(prefix: str = "") -> F.Column:
    return F.concat_ws(" ", F.col(f"{prefix}firstName"), F.col(f"{prefix}lastName"))


def ego_network(accounts: DataFrame, friends: DataFrame, users: DataFrame | None = None):
    """For every user (or the given ``users(userID)``): nodes = the user
    and each friend with label "first last" and affiliation; edges = user ->
    friend.  Returns (nodes(ego, id, label, affiliation, is_self),
    edges(ego, src, dst))."""
    acc = accounts.select("userID", "firstName", "lastName", "affiliation")
    f = friends.select("followerID", "followedID")
    if users is not None:
        f = f.join(users.select(F.col("userID").alias("followerID")), "followerID", "left_semi")
        egos = users.select("userID").join(acc, "userID")
    else:
        egos = acc
    self_nodes = egos.select(F.col("userID").alias("ego"), F.col("userID").alias("id"),
                             _label().alias("label"), "affiliation", F.lit(True).alias("is_self"))
    friend_nodes = (f.join(acc, f.followedID == acc.userID)
                    .select(F.col("followerID").alias("ego"), F.col("followedID").alias("id"),
                            _label().alias("label"), "affiliation", F.lit(False).alias("is_self")))
    nodes = self_nodes.unionByName(friend_nodes)
    edges = f.select(F.col("followerID").alias("ego"), F.col("followerID").alias("src"),
                     F.col("followedID").alias("dst"))
    return nodes, edges


def _degrees(f: DataFrame) -> DataFrame:
    return f.groupBy(F.col("followerID").alias("u")).agg(F.count("*").alias("deg"))


def common_neighbours(pairs: DataFrame, friends: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """For rows ``(*keys, a, b)``: one row ``(*keys, a, b, x)`` per x that is a
    friend of both a and b.

    Exact and pair-free: each row expands only the adjacency of its
    lower-degree endpoint (ties by id).  Where both have lists (``item_lists``)
    the shorter one goes to the other endpoint as one array; else every
    (row, neighbour) is probed against the other endpoint's adjacency with an
    equi-join on the (user, friend) key.  Work is the sum over rows of
    min(deg a, deg b), the bound used by triangle counting; no neighbour pairs
    of a hub are built.
    """
    keys = keys or []
    f = friends.select("followerID", "followedID")
    lists = item_lists(f, "followerID", "followedID")
    known = lists.select(F.col("followerID").alias("u"), F.col("n_items").alias("d"), F.col("items").isNotNull().alias("l"))
    p = (pairs.select(*keys, "a", "b")
         .join(known.withColumnsRenamed({"u": "a", "d": "da", "l": "la"}), "a")
         .join(known.withColumnsRenamed({"u": "b", "d": "db", "l": "lb"}), "b"))
    low_is_a = (F.col("da") < F.col("db")) | ((F.col("da") == F.col("db")) & (F.col("a") <= F.col("b")))
    p = p.select(*keys, "a", "b", F.when(low_is_a, F.col("a")).otherwise(F.col("b")).alias("lo"),
                 F.when(low_is_a, F.col("b")).otherwise(F.col("a")).alias("hi"), (F.col("la") & F.col("lb")).alias("listed"))
    listed = listed_items(p.where("listed").drop("listed"), lists.withColumnRenamed("followerID", "lo"),
                          lists.withColumnRenamed("followerID", "hi"), "lo", "hi", "x")
    wedge = p.where("not listed").join(f.select(F.col("followerID").alias("lo"), F.col("followedID").alias("x")), "lo")
    common = wedge.join(f.select(F.col("followerID").alias("hi"), F.col("followedID").alias("x")),
                        ["hi", "x"], "left_semi")
    return listed.select(*keys, "a", "b", "x").union(common.select(*keys, "a", "b", "x"))


def first_friend_requests(friends: DataFrame) -> DataFrame:
    """One "show more" request per user: expand the oldest friendship
    (ties by id).  Partial aggregation; no per-user list is built."""
    f = friends.select("followerID", "followedID", "ts")
    first = f.groupBy("followerID").agg(
        F.min_by("followedID", F.struct("ts", "followedID")).alias("friend"))
    return first.select(F.col("followerID").alias("request_id"),
                        F.col("followerID").alias("viewer"), "friend")


def oldest_friend_clicks(friends: DataFrame, steps: int) -> DataFrame:
    """(request_id, step, viewer, friend): every user expands the oldest
    friendship first, then the next, up to ``steps`` (ties by id)."""
    w = Window.partitionBy("followerID").orderBy("ts", "followedID")
    f = friends.select("followerID", "followedID", F.row_number().over(w).alias("step")).where(F.col("step") <= steps)
    return f.select(F.col("followerID").alias("request_id"), "step",
                    F.col("followerID").alias("viewer"), F.col("followedID").alias("friend"))


def first_screen(friends: DataFrame, requests: DataFrame) -> DataFrame:
    """(request_id, id): what a request shows at first, the viewer and their friends."""
    r = requests.select("request_id", "viewer").distinct()
    theirs = r.join(friends.select(F.col("followerID").alias("viewer"), F.col("followedID").alias("id")), "viewer")
    return r.select("request_id", F.col("viewer").alias("id")).unionByName(theirs.select("request_id", "id"))


def _candidates(accounts: DataFrame, friends: DataFrame, requests: DataFrame, *more: str) -> DataFrame:
    """(request_id, viewer, friend, id, label, *more): the friends of ``friend`` with
    the viewer's affiliation.  Joined on (friend, affiliation), so that a hub's
    friends of other affiliations are never laid out for its viewers."""
    acc = accounts.select("userID", "firstName", "lastName", "affiliation")
    req = requests.select("request_id", "viewer", "friend", *more).join(
        acc.select(F.col("userID").alias("viewer"), "affiliation"), "viewer")
    known = friends.select(F.col("followerID").alias("friend"), F.col("followedID").alias("id")).join(
        acc.select(F.col("userID").alias("id"), "affiliation", _label().alias("label")), "id")
    return req.join(known, ["friend", "affiliation"]).select("request_id", "viewer", "friend", "id", "label", *more)


def _friend_lists(f: DataFrame) -> DataFrame:
    """``item_lists`` of each user's friends, the user as ``id``."""
    return item_lists(f.select(F.col("followerID").alias("id"), "followedID"), "id", "followedID")


def _edges_to_shown(new: DataFrame, shown: DataFrame, f: DataFrame, friends_of: DataFrame) -> DataFrame:
    """(request_id, src, dst): shown node -> new node wherever the new node
    lists the shown one as a friend, ``friend`` itself left out.

    Where both have lists (``item_lists``) the new node's friends go to the
    request as one array.  Any other row expands the smaller of the new node's
    friends and the request's shown nodes and looks each up in the other by an
    equi-join, so the work is the sum of the smaller sides, however large a
    screen or a hub is."""
    screens = item_lists(shown.select("request_id", F.col("id").alias("x")), "request_id", "x")
    known = [t.select(k, F.col("n_items").alias(n), F.col("items").isNotNull().alias(has))
             for t, k, n, has in ((friends_of, "id", "deg", "few_friends"), (screens, "request_id", "n_shown", "few_shown"))]
    rows = new.select("request_id", "friend", "id").join(known[0], "id").join(known[1], "request_id")
    listed = F.col("few_friends") & F.col("few_shown")
    short = listed_items(rows.where(listed).select("request_id", "friend", "id"), friends_of, screens, "id", "request_id", "x")
    rows = rows.where(~listed)
    few_friends = F.col("deg") <= F.col("n_shown")
    adjacent = f.select(F.col("followerID").alias("id"), F.col("followedID").alias("x"))
    on_screen = shown.select("request_id", F.col("id").alias("x"))
    a = rows.where(few_friends).join(adjacent, "id").join(on_screen, ["request_id", "x"], "left_semi")
    b = rows.where(~few_friends).join(on_screen, "request_id").join(adjacent, ["id", "x"], "left_semi")
    all_rows = short.unionByName(a.select("request_id", "friend", "id", "x")).unionByName(b.select("request_id", "friend", "id", "x"))
    return all_rows.where(F.col("x") != F.col("friend")).select("request_id", F.col("x").alias("src"), F.col("id").alias("dst"))


def expand_network(accounts: DataFrame, friends: DataFrame, requests: DataFrame, existing: DataFrame | None = None):
    """G12: "show more friends" for many requests at once.

    ``requests(request_id, viewer, friend)``, one row per request; the nodes on
    screen are those of ``existing(request_id, id)``, or, without it, the
    viewer's ego network (the viewer and their friends).  New nodes are friends
    of ``friend`` not on screen that share the viewer's affiliation; edges go
    friend -> new, and shown node -> new for every shown node other than
    ``friend`` that the new node is friends with.  Membership in the shown set
    is an equi-join, never a materialized list per request.  Repeated rows of
    ``existing`` count once; a request without any has an empty screen, on
    which the viewer is new too where the friend lists them.
    Returns (nodes(request_id, id, label), edges(request_id, src, dst)).
    """
    f = friends.select("followerID", "followedID")
    cand = _candidates(accounts, f, requests)
    if existing is not None:
        shown = existing.select("request_id", "id").distinct()
        new = cand.join(shown, ["request_id", "id"], "left_anti")
        links = _edges_to_shown(new, shown, f, _friend_lists(f))
    else:
        cand = cand.where(F.col("id") != F.col("viewer"))
        new = cand.join(f.select(F.col("followerID").alias("viewer"), F.col("followedID").alias("id")),
                        ["viewer", "id"], "left_anti")
        # shown friends of the viewer that are also friends of the new node
        both = common_neighbours(new.select("request_id", "friend", F.col("id").alias("a"),
                                            F.col("viewer").alias("b")), f, ["request_id", "friend"])
        of_friends = both.where(F.col("x") != F.col("friend")).select(
            "request_id", F.col("x").alias("src"), F.col("a").alias("dst"))
        # the viewer itself, when the new node lists the viewer as a friend
        of_viewer = (new.join(f.select(F.col("followerID").alias("id"), F.col("followedID").alias("viewer")),
                              ["id", "viewer"], "left_semi")
                     .where(F.col("viewer") != F.col("friend"))
                     .select("request_id", F.col("viewer").alias("src"), F.col("id").alias("dst")))
        links = of_friends.unionByName(of_viewer)
    nodes = new.select("request_id", "id", "label")
    first = new.select("request_id", F.col("friend").alias("src"), F.col("id").alias("dst"))
    return nodes, first.unionByName(links)


def expand_network_steps(accounts: DataFrame, friends: DataFrame, clicks: DataFrame, steps: int,
                         existing: DataFrame | None = None):
    """G12 again and again: ``clicks(request_id, step, viewer, friend)`` are
    applied in the order of ``step`` (1 to ``steps``, one click per request and
    step); what a step adds is on screen for those after it.  The screen starts
    as ``existing(request_id, id)``, or as the viewer's ego network, and grows
    as rows.  What doesn't depend on the screen is done once for all steps: the
    friendships, the users' friend lists and the candidates of all clicks are
    stored.  So are each step's new nodes: edges and later steps read them, and
    a lost executor costs one step.
    Returns (nodes(request_id, step, id, label), edges(request_id, step, src, dst)).
    """
    friends = stored(friends.select("followerID", "followedID"), "expand-friends")
    clicks = stored(clicks.select("request_id", "step", "viewer", "friend"), "expand-clicks")
    shown = (first_screen(friends, clicks) if existing is None else existing.select("request_id", "id"))
    shown = stored(shown.distinct(), "expand-screen")
    friends_of = stored(_friend_lists(friends), "expand-lists")
    cand = stored(_candidates(accounts, friends, clicks, "step"), "expand-candidates")
    nodes = edges = None
    for step in range(1, steps + 1):
        now = cand.where(F.col("step") == step).select("request_id", "friend", "id", "label")
        new = stored(now.join(shown, ["request_id", "id"], "left_anti"), "expand-nodes")
        more = new.select("request_id", "id", "label")
        links = new.select("request_id", F.col("friend").alias("src"), F.col("id").alias("dst")).unionByName(
            _edges_to_shown(new, shown, friends, friends_of))
        more_s, links_s = more.withColumn("step", F.lit(step)), links.withColumn("step", F.lit(step))
        nodes = more_s if nodes is None else nodes.unionByName(more_s)
        edges = links_s if edges is None else edges.unionByName(links_s)
        shown = shown.unionByName(more.select("request_id", "id").distinct())
    return nodes.select("request_id", "step", "id", "label"), edges.select("request_id", "step", "src", "dst")


def friend_counts(friends: DataFrame) -> DataFrame:
    """Number of friends per user."""
    return friends.groupBy(F.col("followerID").alias("userID")).agg(F.count("*").alias("n_friends"))


def mutual_friends(friends: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Number of common friends for each pair ``(a, b)`` (default: every
    friendship with a < b); pairs without a common friend get 0."""
    f = friends.select("followerID", "followedID")
    if pairs is None:
        pairs = f.where(F.col("followerID") < F.col("followedID")) \
                 .select(F.col("followerID").alias("a"), F.col("followedID").alias("b"))
    counts = common_neighbours(pairs, f).groupBy("a", "b").agg(F.count("*").alias("n_mutual"))
    return pairs.select("a", "b").join(counts, ["a", "b"], "left").fillna(0, ["n_mutual"])
