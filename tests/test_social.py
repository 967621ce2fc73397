"""Social jobs: hand inputs from FIXTURES section 3 and properties."""

import datetime as dt

from pyspark.sql import functions as F

from plexus.operators import social as S
from plexus.sources.bindings import Bindings
from tests.conftest import SF_SMALL


def test_last_writer_wins(spark):
    log = spark.createDataFrame([(1, "put", 7, 9), (2, "delete", 7, 9), (3, "put", 7, 9), (4, "put", 8, 9),
                                 (5, "delete", 8, 9)], "seq long, op string, postID long, userID long")
    out = S.apply_changes(log, ["postID", "userID"], "seq")
    assert [(r.postID, r.userID) for r in out.collect()] == [(7, 9)]
    # applying the result again as base changes nothing
    again = S.apply_changes(log.limit(0), ["postID", "userID"], "seq", base=out)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))


def test_fan_out(spark):
    posts = spark.createDataFrame([(1, 5, 5), (2, 5, 6)], "postID long, userID long, creatorID long")
    rows = S.fan_out_posts(posts).collect()
    assert sorted((r.postID, r.owner) for r in rows) == [(1, 5), (2, 5), (2, 6)]


def test_friend_request_status(spark):
    friends = spark.createDataFrame([(1, 2), (2, 1)], "followerID long, followedID long")
    req = spark.createDataFrame([(2, 1, 10), (3, 1, 11), (3, 1, 12), (4, 1, 13)],
                                "recipientID long, senderID long, seq long")
    st = {r.seq: r.status for r in S.friend_requests(req, friends).collect()}
    assert st == {10: "already_friends", 11: "sent", 12: "pending", 13: "sent"}


def test_accept_requests_symmetric(spark):
    friends = spark.createDataFrame([(1, 2), (2, 1)], "followerID long, followedID long")
    pending = spark.createDataFrame([(3, 1), (3, 4)], "recipientID long, senderID long")
    acc = spark.createDataFrame([(3, 1), (3, 9)], "recipientID long, senderID long")
    after, left = S.accept_requests(acc, pending, friends)
    rows = {tuple(r) for r in after.collect()}
    assert all((b, a) in rows for a, b in rows)
    assert [tuple(r) for r in left.collect()] == [(3, 4)]


def test_register_accounts(spark):
    accounts = spark.createDataFrame([(1, "taken")], "userID long, username string")
    new = spark.createDataFrame([("x", "A", "B", 1), ("x", "C", "D", 2), ("taken", "E", "F", 3),
                                 ("y", " ", "G", 4)], "username string, firstName string, lastName string, seq long")
    st = {r.seq: r.status for r in S.register_accounts(new, accounts).collect()}
    assert st == {1: "accepted", 2: "duplicate_in_batch", 3: "username_taken", 4: "missing:firstName"}


def test_sign_up_fills_accounts(spark):
    accounts = spark.createDataFrame([(1, "taken", "T", "Mail")], "userID long, username string, firstName string, email string")
    new = spark.createDataFrame([(10, "x", "A", "m", "p", 1), (11, "x", "C", "m", "p", 2), (12, "taken", "E", "m", "p", 3),
                                 (13, "y", "G", "m", None, 4), (14, "z", "H", "  ", "p", 5)],
                                "userID long, username string, firstName string, email string, password string, seq long")
    after, status = S.sign_up(new, accounts, required=("username", "firstName", "email", "password"))
    assert after.columns == accounts.columns
    assert sorted(map(tuple, after.collect())) == [(1, "taken", "T", "Mail"), (10, "x", "A", "m")]
    assert {r.seq: r.status for r in status.collect()} == {
        1: "accepted", 2: "duplicate_in_batch", 3: "username_taken", 4: "missing:password", 5: "missing:email"}


def test_open_chats_names_both_people(spark):
    acc = spark.createDataFrame([(1, "A", "a"), (2, "B", "b")], "userID long, firstName string, lastName string")
    new = spark.createDataFrame([(7, 1, 2, 1), (7, 1, 2, 2), (8, 2, 2, 3), (9, 1, 5, 4), (10, 1, None, 5)],
                                "chatID long, creatorID long, inviteeID long, seq long")
    rooms, members = S.open_chats(new, acc)
    assert sorted(map(tuple, rooms.collect())) == [(1, 7), (1, 9), (1, 10), (2, 7), (2, 8), (5, 9)]
    assert sorted(map(tuple, members.collect()), key=repr) == sorted(
        [(7, 1, "A", "a"), (7, 2, "B", "b"), (8, 2, "B", "b"), (9, 1, "A", "a"), (9, 5, None, None), (10, 1, "A", "a")], key=repr)


def test_positions_of_a_hot_group_span_ranges(spark):
    from plexus.operators.common import number_rows

    df = spark.range(6000).selectExpr("if(id % 3 < 2, 1L, if(id % 2 = 0, id, null)) AS g", "(id * 7919) % 6007 AS v", "id AS pos_in")
    out = number_rows(df.repartition(7), ["g"], [F.desc("v")], "pos")
    got = sorted(((r.g or -1), r.v, r.pos) for r in out.collect())
    groups, want = {}, []
    for r in df.collect():
        groups.setdefault(r.g or -1, []).append(r.v)
    for g, vs in groups.items():
        want += [(g, v, i + 1) for i, v in enumerate(sorted(vs, reverse=True))]
    assert got == sorted(want) and out.columns == ["g", "v", "pos_in", "pos"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number() windowspecdefinition(_range" in plan         # no window over a whole group's rows
    assert number_rows(df.limit(0), ["g"], [F.desc("v")], "pos").count() == 0


def test_update_accounts(spark):
    accounts = spark.createDataFrame([(1, "ann", "Ann", "Lee", "X"), (2, "bob", "Bob", "Ray", "Y")],
                                     "userID long, username string, firstName string, lastName string, "
                                     "affiliation string")
    changes = spark.createDataFrame([(1, "", "Annie", None, "X", 1), (2, "ann", None, None, "", 2)],
                                    "userID long, username string, firstName string, lastName string, "
                                    "affiliation string, seq long")
    after, status, posts = S.update_accounts(changes, accounts)
    a = {r.userID: (r.username, r.firstName, r.lastName) for r in after.collect()}
    assert a == {1: ("ann", "Annie", "Lee"), 2: ("bob", "Bob", "Ray")}
    assert {r.seq: r.status for r in status.collect()} == {1: "updated", 2: "username_taken"}
    # affiliation typed, even though unchanged
    assert [(r.userID, r.content) for r in posts.collect()] == [(1, "ann has updated their affiliation to: X")]


def test_later_edits_keep_other_fields(spark):
    accounts = spark.createDataFrame([(1, "ann", "Ann", "X")], "userID long, username string, firstName string, affiliation string")
    changes = spark.createDataFrame([(1, "", "", "New", 1), (1, "anna", None, None, 2), (1, "", "Anna", "", 3)],
                                    "userID long, username string, firstName string, affiliation string, seq long")
    after = S.update_accounts(changes, accounts)[0]
    assert [tuple(r) for r in after.collect()] == [(1, "anna", "Anna", "New")]


def test_chat_time_labels(spark):
    msgs = spark.createDataFrame(
        [(1, 1, 5, "a", dt.datetime(2024, 1, 2, 0, 5)), (1, 2, 5, "b", dt.datetime(2024, 1, 2, 12, 0)),
         (1, 3, 5, "c", dt.datetime(2024, 1, 2, 13, 7)), (1, 4, 5, "d", dt.datetime(2024, 1, 1, 9, 0)),
         (1, 5, 6, "e", dt.datetime(2024, 1, 2, 9, 0))],
        "chatID long, message_id long, userID long, message string, ts timestamp_ntz")
    out = S.chat_transcripts(msgs, F.lit(dt.date(2024, 1, 2)))
    got = [r.time_label for r in out.collect()]
    assert got == ["1/1/2024", "Today at 12:05 AM", "Today at 9:00 AM", "Today at 12:00 PM", "Today at 1:07 PM"]


def test_only_members_may_open_a_chat(spark):
    members = spark.createDataFrame([(1, 5), (2, 6)], "chatID long, userID long")
    asked = spark.createDataFrame([(5, 1), (5, 1), (5, 2), (6, 2), (None, 1)], "viewer long, chatID long")
    assert sorted(map(tuple, S.may_open_chats(asked, members).collect())) == [(5, 1), (6, 2)]


def test_home_feed_equals_brute_force(spark):
    b = Bindings(spark, SF_SMALL)
    got = {}
    for r in S.home_feed(b.posts, b.friends, b.accounts, k=5).collect():
        got.setdefault(r.viewer, set()).add(r.postID)
    posts = [(r.postID, r.creatorID, r.ts) for r in b.posts.collect()]
    fr = [(r.followerID, r.followedID) for r in b.friends.collect()]
    by_creator = {}
    for p in posts:
        by_creator.setdefault(p[1], []).append(p)
    want = {}
    for v, c in fr:
        want.setdefault(v, []).extend(by_creator.get(c, []))
    want = {v: {p[0] for p in sorted(ps, key=lambda p: (-p[2].timestamp(), p[0]))[:5]} for v, ps in want.items()}
    want = {v: s for v, s in want.items() if s}
    assert got == want


def test_like_summary_flags(spark):
    likes = spark.createDataFrame([(1, 10), (1, 11), (2, 10)], "postID long, userID long")
    views = spark.createDataFrame([(10, 1), (12, 1), (12, 3)], "viewerID long, postID long")
    out = {(r.viewerID, r.postID): (r.n_likes, r.liked) for r in S.like_summary(likes, views).collect()}
    assert out == {(10, 1): (2, True), (12, 1): (2, False), (12, 3): (0, False)}


def test_notification_feed_cap(spark):
    acc = spark.createDataFrame([(1, "ann"), (2, "bob")], "userID long, username string")
    n = spark.createDataFrame(
        [(9, 1, "friendRequest", dt.datetime(2024, 1, d)) for d in range(1, 6)]
        + [(9, 2, "friendRequest", dt.datetime(2024, 1, 9))],
        "recipientID long, senderID long, notificationType string, ts timestamp_ntz")
    assert S.notification_feed(n, acc).count() == 6            # no cap by default (D16)
    top = S.notification_feed(n, acc, k=2).orderBy("pos").collect()
    assert [(r.pos, r.sender_username) for r in top] == [(1, "bob"), (2, "ann")]


def test_json_rows_export(spark):
    import json

    from plexus.sources.sinks import json_rows

    df = spark.createDataFrame([(1, "a b")], "id long, text string")
    assert json.loads(json_rows(df).first().json) == {"id": 1, "text": "a b"}


def test_chat_title_parts(spark):
    acc = spark.createDataFrame([(1, "Ann", "Lee"), (2, "Bob", "Ray"), (3, "Cy", "Fox")],
                                "userID long, firstName string, lastName string")
    members = spark.createDataFrame([(7, 1), (7, 2), (7, 3), (8, 2)], "chatID long, userID long")
    roster = S.chat_roster(members, acc)
    parts = S.chat_title_parts(roster, spark.createDataFrame([(2,)], "userID long")).collect()
    assert [(r.chatID, r.label) for r in parts] == [(7, "Ann Lee"), (7, "you"), (7, "Cy Fox"), (8, "you")]


def _history(asked, said, friends, pending):
    """Requests and acceptances one by one, as the live site does."""
    friends, waiting, status = dict(friends), {(r, s, t): None for r, s, kind, t in pending if kind == "friendRequest"}, {}
    for seq, what in sorted([(r[4], ("ask", *r)) for r in asked] + [(a[4], ("accept", *a)) for a in said]):
        if what[0] == "ask":
            _, r, s, kind, t, _ = what
            if kind != "friendRequest":
                continue
            if (r, s) in friends:
                status[seq] = "already_friends"
            elif any(k[:2] == (r, s) for k in waiting):
                status[seq] = "pending"
            else:
                status[seq] = "sent"
                waiting[r, s, t] = seq
        else:
            _, r, s, t, now, _ = what
            friends[r, s] = friends[s, r] = now
            waiting.pop((r, s, t), None)
    return status, friends, waiting


def test_request_history_equals_a_loop(spark):
    import random

    rng = random.Random(8)
    pair = lambda: tuple(rng.sample(range(9), 2))
    seqs = rng.sample(range(1000), 260)
    asked = [(*pair(), rng.choice(["friendRequest", "friendRequest", "like"]), 10 * q, q) for q in seqs[:200]]
    said = []
    for q in seqs[200:]:
        earlier = [r for r in asked if r[4] < q]
        if earlier:
            r = rng.choice(earlier)
            said.append((r[0], r[1], r[3] + rng.choice([0, 0, 3]), 10 * q + 1, q))
    friends = {(1, 2): 5, (2, 1): 5, (3, 1): 6}
    pending = [(4, 5, "friendRequest", 1), (6, 7, "like", 2), (7, 8, "friendRequest", 3)]
    said.append((7, 8, 3, 5000, 2000))
    status, after, waiting = _history(asked, said, friends, pending)
    a = spark.createDataFrame(asked, "recipientID long, senderID long, notificationType string, ts long, seq long")
    c = spark.createDataFrame(said, "recipientID long, senderID long, requestTs long, ts long, seq long")
    f = spark.createDataFrame([(*k, t) for k, t in friends.items()], "followerID long, followedID long, ts long")
    p = spark.createDataFrame(pending, "recipientID long, senderID long, notificationType string, ts long")
    assert {r.seq: r.status for r in S.friend_requests(a, f, p, c).collect()} == status
    assert len(set(status.values())) == 3
    assert {(r.followerID, r.followedID): r.ts for r in S.accept_requests(c, p, f)[0].collect()} == after
    left = S.pending_requests(a, c, f, p).collect()
    assert sorted((r.recipientID, r.senderID, r.ts, r.seq or -1) for r in left) == sorted((*k, q or -1) for k, q in waiting.items())


def test_likes_are_no_requests(spark):
    req = spark.createDataFrame([(3, 1, "like", 1), (3, 1, "friendRequest", 2)], "recipientID long, senderID long, notificationType string, seq long")
    none = spark.createDataFrame([], "followerID long, followedID long")
    assert [(r.seq, r.status) for r in S.friend_requests(req, none).collect()] == [(2, "sent")]


def test_a_hot_pair_is_no_task_of_its_own(spark):
    """A pair with most requests: first request and status without a window or sort of its rows."""
    req = spark.range(20000).selectExpr("if(id % 3 > 0, 1, id) as recipientID", "if(id % 3 > 0, 2, id + 1) as senderID", "id as seq")
    none = spark.createDataFrame([], "followerID long, followedID long")
    out = S.friend_requests(req, none)
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.where("status = 'sent'").count() == 20000 - 13333 + 1


def test_home_feed_with_ties_nulls_and_busy_friends(spark):
    """whole posts are fanned out only up to each viewer's k-th, found on thin rows first."""
    import random

    rng = random.Random(12)
    posts = [(p, p % 5, rng.randrange(6) if p % 17 else None, f"c{p}", rng.choice([None, 1, 2, 3, 4, 5])) for p in range(150)]
    friends = [(v, c) for v in range(8) for c in range(6) if (v + c) % 3 and v != 7] + [(7, 0), (None, 1)]
    p = spark.createDataFrame(posts, "postID long, userID long, creatorID long, content string, ts long")
    f = spark.createDataFrame(friends, "followerID long, followedID long")
    a = spark.createDataFrame([(k, f"u{k}", "f", "l", "x") for k in range(6)], "userID long, username string, firstName string, lastName string, affiliation string")
    for k in (1, 5, 20, 200):
        out = S.home_feed(p, f, a, k=k, positions=True)
        want = []
        for v in {x for x, _ in friends}:
            theirs = [(r[4] is None, -(r[4] or 0), r[0]) for r in posts if r[2] is not None and (v, r[2]) in friends]
            want += [(str(v), x[2], n) for n, x in enumerate(sorted(theirs)[:k], 1)]
        assert sorted((str(r.viewer), r.postID, r.pos) for r in out.collect()) == sorted(want)
    assert "_full" in out._jdf.queryExecution().optimizedPlan().toString()
