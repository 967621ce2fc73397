"""Social jobs for all users at once: accounts, walls, feeds, comments,
likes, friend requests, notifications and chats.

The reference answers these one user per request with key lookups; here
each is one plan over whole tables.  Ids are whatever type the inputs use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plexus.functions.timefmt import chat_time_label
from plexus.operators.common import number_rows

ACCOUNT_FIELDS = ("username", "firstName", "lastName", "affiliation")

# ---- fixed values: fields that a sign-up form must fill, text of the status post after an affiliation edit -----
SIGN_UP_FIELDS = ("username", "firstName", "lastName", "email", "password", "affiliation", "birthday")
AFFILIATION_POST = " has updated their affiliation to: "
# ---------------------------------------------------------------------------

FEW_SHARE = 5  # a home feed's bound is found among each friend's newest k / FEW_SHARE posts


# ------------------------------------------------------------ S1 / S2


def resolve_users(df: DataFrame, accounts: DataFrame, name_col: str = "username",
                  out_col: str = "userID") -> DataFrame:
    """Add the userID for a username column; null when unknown."""
    acc = accounts.select(F.col("username").alias("_u"), F.col("userID").alias(out_col))
    return df.join(acc, df[name_col] == acc["_u"], "left").drop("_u")


def enrich_users(df: DataFrame, accounts: DataFrame, id_col: str, prefix: str,
                 fields=ACCOUNT_FIELDS) -> DataFrame:
    """Add ``{prefix}{field}`` account attributes for an id column
    (left join: unknown ids keep their row with nulls)."""
    acc = accounts.select(F.col("userID").alias("_id"), *[F.col(f).alias(prefix + f) for f in fields])
    return df.join(acc, df[id_col] == acc["_id"], "left").drop("_id")


# ------------------------------------------------------------ S3 / S4


def missing_fields(cols) -> Column:
    """The names of those of ``cols`` that are null or blank after trimming."""
    blank = [F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "", F.lit(c)) for c in cols]
    return F.filter(F.array(*blank), lambda x: x.isNotNull())


def validate_required(df: DataFrame, cols) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected with ``reason``): a required field that is null or
    blank after trimming rejects the row."""
    tagged = df.withColumn("_missing", missing_fields(cols))
    bad = F.size("_missing") > 0
    valid = tagged.where(~bad).drop("_missing")
    rejected = tagged.where(bad).withColumn(
        "reason", F.concat(F.lit("missing:"), F.array_join("_missing", ","))).drop("_missing")
    return valid, rejected


def register_accounts(new: DataFrame, accounts: DataFrame, seq: str = "seq",
                      required=("username", "firstName", "lastName")) -> DataFrame:
    """S3: sign-ups, one status per row: ``missing:<fields>`` (null or blank
    after trimming), ``username_taken`` (already an account),
    ``duplicate_in_batch`` (an earlier ``seq`` of the batch, with nothing
    missing, claimed the name first), else ``accepted``.  One pass over the
    sign-ups; the first claims are a partial aggregate joined back."""
    tagged = new.withColumn("_missing", missing_fields(required))
    names = accounts.select("username").distinct().withColumn("_taken", F.lit(True))
    first = tagged.where(F.size("_missing") == 0).groupBy("username").agg(F.min(seq).alias("_first"))
    status = (F.when(F.size("_missing") > 0, F.concat(F.lit("missing:"), F.array_join("_missing", ",")))
              .when(F.col("_taken"), "username_taken")
              .when(F.col(seq) != F.col("_first"), "duplicate_in_batch").otherwise("accepted"))
    return (tagged.join(names, "username", "left").join(first, "username", "left")
            .withColumn("status", status).select(*new.columns, "status"))


def sign_up(new: DataFrame, accounts: DataFrame, seq: str = "seq", required=SIGN_UP_FIELDS):
    """S3: accounts after a batch of sign-ups, ``new(userID, ...)`` with an id
    of its own per row.  Every field of ``required`` must be a column; a row
    that lacks one, or whose name is taken or claimed by an earlier row, joins
    nothing.  An account keeps the columns that ``accounts`` has, null where
    the form has no such field.
    Returns (accounts after, status per sign-up)."""
    status = register_accounts(new, accounts, seq, required)
    joined = status.where(F.col("status") == "accepted").select(
        *[(F.col(c) if c in new.columns else F.lit(None)).cast(accounts.schema[c].dataType).alias(c)
          for c in accounts.columns])
    return accounts.unionByName(joined), status


def update_accounts(changes: DataFrame, accounts: DataFrame, seq: str = "seq"):
    """Apply profile edits.  An empty or null field keeps the old value,
    also one that an earlier change of the batch set; a new username must not
    belong to another account at the start of the batch (nor be claimed by
    an earlier change in it).  Returns (accounts after, status per
    change, status posts).  A status post "<old username> has updated their
    affiliation to: <affiliation>" is emitted whenever an affiliation was
    typed, even if unchanged (as the reference), on the user's own wall."""
    fields = [f for f in ("username", "firstName", "lastName", "email", "affiliation", "birthday")
              if f in changes.columns and f in accounts.columns]
    old = accounts.select("userID", *[F.col(f).alias("_old_" + f) for f in fields])
    ch = changes.join(old, "userID")
    typed = {f: F.nullif(F.col(f), F.lit("")) for f in fields}
    for f in fields:
        ch = ch.withColumn("_new_" + f, F.coalesce(typed[f], F.col("_old_" + f)))
    # username rule: a changed name must be free of other users and first in batch
    renamed = F.col("_new_username") != F.col("_old_username")
    others = accounts.select(F.col("username").alias("_new_username"), F.col("userID").alias("_owner"))
    ch = ch.join(others, "_new_username", "left")
    first = (ch.where(renamed).groupBy("_new_username").agg(F.min(seq).alias("_first")))
    ch = ch.join(first, "_new_username", "left")
    conflict = renamed & ((F.col("_owner").isNotNull() & (F.col("_owner") != F.col("userID")))
                          | (F.col(seq) != F.col("_first")))
    ch = ch.withColumn("status", F.when(conflict, "username_taken").otherwise("updated"))
    ok = ch.where(F.col("status") == "updated")
    # per field, the last accepted change that typed it wins
    newvals = ok.groupBy("userID").agg(
        *[F.max_by(typed[f], F.when(typed[f].isNotNull(), F.col(seq))).alias("_upd_" + f) for f in fields])
    after = accounts.join(newvals, "userID", "left").select(
        *[F.coalesce(F.col("_upd_" + c), F.col(c)).alias(c) if c in fields else F.col(c)
          for c in accounts.columns])
    status = ch.select("userID", seq, "status")
    posts = (ok.where(typed.get("affiliation", F.lit(None)).isNotNull())
             .select(F.col("userID"), F.col("userID").alias("creatorID"), F.col(seq).alias("postID"),
                     F.concat(F.col("_old_username"), F.lit(AFFILIATION_POST),
                              F.col("_new_affiliation")).alias("content"))
             if "affiliation" in fields else None)
    return after, status, posts


# ------------------------------------------------------------ walls & feeds


def fan_out_posts(posts: DataFrame) -> DataFrame:
    """One row per (owner, post): the wall owner always, the creator
    too when different.  ``owner`` is the added column."""
    return posts.withColumn("owner", F.explode(F.array_distinct(F.array("userID", "creatorID"))))


def top_k_per_group(df: DataFrame, keys, order: list[Column], k: int | None,
                    pos: str | None = None) -> DataFrame:
    """Rows ranked within each group by ``order`` (unique tie-break expected);
    keep rank <= k, as column ``pos`` when named.  ``row_number() <= k`` is planned as a window group
    limit, ranked partially before the shuffle, so a hot group costs k rows
    per map task."""
    if k is None:
        return number_rows(df, list(keys), order, pos) if pos else df
    w = Window.partitionBy(*keys).orderBy(*order)
    top = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    return top.withColumn(pos, F.col("_rn").cast("long")).drop("_rn") if pos else top.drop("_rn")


def wall_feed(posts: DataFrame, accounts: DataFrame, k: int | None = 20, positions: bool = False) -> DataFrame:
    """Newest k posts on every wall (own posts and posts made on it),
    with separate owner and creator names (the cap is applied before the
    name joins).  ``positions`` adds ``pos``, from 1 for the newest."""
    fan = fan_out_posts(posts)
    top = top_k_per_group(fan, ["owner"], [F.desc("ts"), F.asc("postID")], k, "pos" if positions else None)
    out = enrich_users(top, accounts, "userID", "owner_", ("username", "firstName", "lastName"))
    return enrich_users(out, accounts, "creatorID", "creator_", ("username", "firstName", "lastName"))


def home_feed(posts: DataFrame, friends: DataFrame, accounts: DataFrame, k: int = 20,
              positions: bool = False) -> DataFrame:
    """For every user, the newest k posts created by their friends.

    A user's top k can only hold each friend's own newest k posts, so posts
    are cut to k per creator before the fan-out to followers; the fan-out
    is then at most k rows per friendship.  It is done twice: first with
    nothing but the order's columns of each friend's newest few posts, whose
    k-th is no newer than the user's k-th post; then only posts up to that one
    are fanned out whole.  ``positions`` adds ``pos``."""
    order = [F.desc("ts"), F.asc("postID")]
    own = top_k_per_group(posts, ["creatorID"], order, k)
    f = friends.select(F.col("followerID").alias("viewer"), F.col("followedID").alias("creatorID"))
    few = top_k_per_group(posts.select("creatorID", "ts", "postID"), ["creatorID"], order, -(-k // FEW_SHARE))
    thin = few.join(f, "creatorID").select("viewer", "ts", "postID")
    last = top_k_per_group(thin, ["viewer"], order, k, "_k").where(F.col("_k") == k).select(
        F.col("viewer").alias("_viewer"), F.col("ts").alias("_ts"), F.col("postID").alias("_post"), F.lit(True).alias("_full"))
    # ts falls with nulls last, then postID rises with nulls first
    newer = (F.col("ts") > F.col("_ts")) | (F.col("ts").isNotNull() & F.col("_ts").isNull())
    up_to = F.col("ts").eqNullSafe(F.col("_ts")) & (F.col("postID").isNull() | (F.col("postID") <= F.col("_post")))
    f = f.join(last, F.col("viewer").eqNullSafe(F.col("_viewer")), "left").drop("_viewer")
    cand = own.join(f, "creatorID").where(F.col("_full").isNull() | newer | up_to).drop("_ts", "_post", "_full")
    top = top_k_per_group(cand, ["viewer"], order, k, "pos" if positions else None)
    return enrich_users(top, accounts, "creatorID", "creator_", ("username", "firstName", "lastName"))


def comment_threads(comments: DataFrame, accounts: DataFrame, positions: bool = False) -> DataFrame:
    """Comments with their author, newest first within each post.

    The order is a global sort on (postID, ts desc, commentID): range
    partitioning splits a hot post's comments over many tasks, where a
    per-post window would put them all in one.  ``positions`` adds ``pos``
    within the post (``number_rows``) and leaves the order to it."""
    if positions:
        comments = number_rows(comments, ["postID"], [F.desc("ts"), F.asc("commentID")], "pos")
    out = enrich_users(comments, accounts, "creatorID", "author_", ("username", "firstName", "lastName"))
    return out if positions else out.orderBy("postID", F.desc("ts"), "commentID")


# ------------------------------------------------------------ likes / S10


def last_operations(log: DataFrame, keys, seq: str = "seq", op_col: str = "op") -> DataFrame:
    """One row per key: the operation with the highest ``seq`` (deletes kept
    as tombstones), with its ``seq``, op and payload.  Merging two such
    tables is the same call on their union, in any order of arrival.

    ``max_by`` aggregates partially before the shuffle, so a key with many
    operations costs one row per map task."""
    keys = list(keys)
    payload = [c for c in log.columns if c not in keys and c not in (seq, op_col)]
    last = log.groupBy(*keys).agg(
        F.max_by(F.struct(F.col(seq).alias(seq), F.col(op_col).alias(op_col), *payload), F.col(seq)).alias("_l"))
    return last.select(*keys, *[F.col("_l." + c).alias(c) for c in (seq, op_col, *payload)])


def apply_changes(log: DataFrame, keys, seq: str = "seq", op_col: str = "op",
                  base: DataFrame | None = None) -> DataFrame:
    """Last writer wins over an append-only log of put / delete
    operations.  ``base`` rows (current state) count as puts older than
    every log entry.  Returns the key columns plus the payload of the last
    put, for keys whose last operation is not a delete."""
    keys = list(keys)
    payload = [c for c in log.columns if c not in keys and c not in (seq, op_col)]
    if base is None:  # fixed-width columns only, so that the aggregate hashes
        last = log.groupBy(*keys).agg(F.max_by(F.col(op_col) != "delete", F.col(seq)).alias("_put"),
                                      *[F.max_by(c, seq).alias(c) for c in payload])
        return last.where("_put").select(*keys, *payload)
    entries = log.select(*keys, F.struct(F.lit(1).alias("l"), F.col(seq).alias("s")).alias("_seq"),
                         F.col(op_col).alias("_op"), *payload)
    older = F.struct(F.lit(0).alias("l"), F.lit(None).cast(log.schema[seq].dataType).alias("s"))
    b = base.select(*keys, older.alias("_seq"), F.lit("put").alias("_op"),
                    *[F.col(c) if c in base.columns else F.lit(None).alias(c) for c in payload])
    entries = b.unionByName(entries)
    last = last_operations(entries, keys, "_seq", "_op")
    return last.where(F.col("_op") != "delete").select(*keys, *payload)


def like_summary(likes: DataFrame, views: DataFrame | None = None) -> DataFrame:
    """Like count per post; with ``views(viewerID, postID)`` one row per
    view with the post's count and whether that viewer likes it."""
    counts = likes.groupBy("postID").agg(F.count_distinct("userID").alias("n_likes"))
    if views is None:
        return counts
    mine = likes.select(F.col("postID"), F.col("userID").alias("viewerID"), F.lit(True).alias("_l")).distinct()
    out = views.select("viewerID", "postID").join(counts, "postID", "left").join(mine, ["postID", "viewerID"], "left")
    return out.select("viewerID", "postID", F.coalesce("n_likes", F.lit(0)).cast("bigint").alias("n_likes"),
                      F.coalesce("_l", F.lit(False)).alias("liked"))


# ------------------------------------------------------- friend requests


REQUEST = "friendRequest"
PAIR = ["recipientID", "senderID"]


def _only_requests(notifications: DataFrame) -> DataFrame:
    """Notifications of other types are no requests; without a type all are."""
    if "notificationType" not in notifications.columns:
        return notifications
    return notifications.where(F.col("notificationType") == REQUEST)


def _both_ways(accepts: DataFrame, *more: str) -> DataFrame:
    """Per accepted request the friend rows (followerID, followedID) it makes."""
    return accepts.select(F.explode(F.array(
        F.struct(F.col("recipientID").alias("followerID"), F.col("senderID").alias("followedID"), *more),
        F.struct(F.col("senderID").alias("followerID"), F.col("recipientID").alias("followedID"), *more))).alias("_p")).select("_p.*")


def friend_requests(requests: DataFrame, friends: DataFrame, pending: DataFrame | None = None, accepts: DataFrame | None = None,
                    id_col: str = "seq") -> DataFrame:
    """Each request (recipientID, senderID, ...) with its ``status``, as it
    was when the request was made, in the order of ``id_col``:

    * ``already_friends`` if the recipient follows the sender, in ``friends`` or
      since an earlier row of ``accepts`` (either of the two accepted the other);
    * ``pending`` if a request of the sender waits, from ``pending`` or from an
      earlier row of ``requests``;
    * ``sent`` otherwise.

    Rows whose notificationType isn't a friend request are no requests and wait
    for nothing.  Friendships aren't ended, so all that counts of a pair's
    history is its first request and its first acceptance: two partial
    aggregates, joined back to the requests; no pair's rows are sorted or
    gathered in one task."""
    rows = _only_requests(requests)
    first = rows.groupBy(*PAIR).agg(F.min(id_col).alias("_first"))
    known = friends.select(F.col("followerID").alias("recipientID"), F.col("followedID").alias("senderID")).distinct()
    out = rows.join(first, PAIR).join(known.withColumn("_friends", F.lit(True)), PAIR, "left")
    friend, waits = F.coalesce("_friends", F.lit(False)), F.col(id_col) > F.col("_first")
    if pending is not None:
        held = _only_requests(pending).select(*PAIR).distinct().withColumn("_held", F.lit(True))
        out = out.join(held, PAIR, "left")
        waits = waits | F.coalesce("_held", F.lit(False))
    if accepts is not None:
        made = _both_ways(accepts, id_col).groupBy("followerID", "followedID").agg(F.min(id_col).alias("_accepted"))
        made = made.select(F.col("followerID").alias("recipientID"), F.col("followedID").alias("senderID"), "_accepted")
        out = out.join(made, PAIR, "left")
        friend = friend | F.coalesce(F.col("_accepted") < F.col(id_col), F.lit(False))
    status = F.when(friend, "already_friends").when(waits, "pending").otherwise("sent")
    return out.withColumn("status", status).drop("_first", "_friends", "_held", "_accepted")


def accept_requests(accepted: DataFrame, pending: DataFrame, friends: DataFrame, id_col: str = "seq"):
    """Accepting (recipientID, senderID) writes both directed friend rows
    and removes the pending request only when the sender matches; where
    ``accepted`` has ``requestTs``, only the request of that time.

    Returns (friends after, pending after).  With ``ts`` and ``id_col`` in
    ``accepted`` friend rows carry the time of their last writing, an older one
    being replaced.  With ``id_col`` on both sides an acceptance removes only
    requests made before it."""
    timed = "ts" in accepted.columns and "ts" in friends.columns and id_col in accepted.columns
    if timed:
        last = _both_ways(accepted, "ts", id_col).groupBy("followerID", "followedID").agg(F.max_by("ts", id_col).alias("ts"))
        old = friends.select("followerID", "followedID", "ts").join(last, ["followerID", "followedID"], "left_anti")
        after = old.unionByName(last)
    else:
        after = friends.select("followerID", "followedID").unionByName(_both_ways(accepted)).distinct()
    a = accepted.select(F.col("recipientID").alias("_r"), F.col("senderID").alias("_s"),
                        *([F.col("requestTs").alias("_t")] if "requestTs" in accepted.columns else []),
                        *([F.col(id_col).alias("_n")] if id_col in accepted.columns else []))
    match = (F.col("recipientID") == F.col("_r")) & (F.col("senderID") == F.col("_s"))
    if "requestTs" in accepted.columns:
        match = match & (F.col("ts") == F.col("_t"))
    if id_col in accepted.columns and id_col in pending.columns:
        match = match & (F.coalesce(F.col(id_col) < F.col("_n"), F.lit(True)))
    return after, pending.join(a, match, "left_anti")


def pending_requests(requests: DataFrame, accepts: DataFrame, friends: DataFrame, pending: DataFrame, id_col: str = "seq") -> DataFrame:
    """The pending list (recipientID, senderID, ts, ``id_col``) after a history
    of requests and acceptances: what was pending before (``id_col`` null) and
    what was sent, without what an acceptance of the same sender and time
    removed later on.  An acceptance with another time makes friends, but
    leaves the request."""
    sent = friend_requests(requests, friends, pending, accepts, id_col).where(F.col("status") == "sent")
    waiting = _only_requests(pending).select(*PAIR, "ts", F.lit(None).cast("long").alias(id_col)).unionByName(sent.select(*PAIR, "ts", id_col))
    return accept_requests(accepts, waiting, friends, id_col)[1]


def notification_feed(notifications: DataFrame, accounts: DataFrame, k: int | None = None,
                      positions: bool = False) -> DataFrame:
    """Notifications with the sender's username.  ``pos`` is the place per
    recipient, newest first (ties by sender, then ``seq`` where there is one);
    it is there when capped to k or when ``positions`` asks for it, and without
    it the rows come in no order."""
    order = [F.desc("ts"), F.asc("senderID"), *([F.asc("seq")] if "seq" in notifications.columns else [])]
    n = notifications
    if k is not None:
        w = Window.partitionBy("recipientID").orderBy(*order)
        n = n.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= k)
    elif positions:
        n = number_rows(n, ["recipientID"], order, "pos")
    return enrich_users(n, accounts, "senderID", "sender_", ("username",))


# ------------------------------------------------------------ chats


def chat_roster(members: DataFrame, accounts: DataFrame) -> DataFrame:
    """S14 part: (chatID, userID, label) for every member, label "first last"."""
    m = members.select("chatID", "userID").distinct()
    acc = accounts.select("userID", F.concat_ws(" ", "firstName", "lastName").alias("label"))
    return m.join(acc, "userID", "left").select("chatID", "userID", "label")


def chat_directory(members: DataFrame, accounts: DataFrame) -> DataFrame:
    """One row per (user, chat) membership with the member count and
    the user's own entry labelled "you".  The roster itself stays long
    (``chat_roster``): a title string with every member name per
    (user, chat) would grow with the square of a chat's size."""
    roster = chat_roster(members, accounts)
    sizes = roster.groupBy("chatID").agg(F.count("*").alias("n_members"))
    return (roster.join(sizes, "chatID")
            .select(F.col("userID"), "chatID", "n_members", F.lit("you").alias("self_label")))


def chat_title_parts(roster: DataFrame, viewers: DataFrame) -> DataFrame:
    """S14 title for ``viewers(userID)``: for every chat of each viewer, its
    member labels as rows in display order (``pos``), the viewer as "you";
    the UI joins them with ", ".  Rows, not one gathered string per chat:
    the work and each output row stay bounded however large a chat is.
    Ordered by a global sort, so a huge chat spreads over many tasks."""
    mine = roster.join(viewers.select(F.col("userID").alias("viewer")),
                       roster.userID == F.col("viewer"), "inner").select("chatID", "viewer")
    parts = roster.join(mine, "chatID")
    lab = F.when(F.col("userID") == F.col("viewer"), F.lit("you")).otherwise(F.col("label"))
    return (parts.select("viewer", "chatID", "userID", lab.alias("label"), F.col("label").alias("_sort"))
            .orderBy("viewer", "chatID", "_sort", "userID").drop("_sort"))


def may_open_chats(requests: DataFrame, members: DataFrame) -> DataFrame:
    """The (viewer, chatID) requests whose viewer is a member of the chat."""
    m = members.select(F.col("userID").alias("viewer"), "chatID").distinct()
    return requests.select("viewer", "chatID").distinct().join(m, ["viewer", "chatID"], "left_semi")


def chat_transcripts(messages: DataFrame, as_of: Column | None = None,
                     tz: str = "UTC", order=("chatID", "ts", "message_id"), positions: bool = False) -> DataFrame:
    """All messages of each chat, oldest first, whoever wrote them, with a
    display-time label relative to the ``as_of`` date (when given; needs a
    ``ts`` column).  Who may read a chat is ``may_open_chats``.  ``positions``
    adds ``pos`` within the chat by the rest of ``order`` instead of sorting."""
    msgs = messages
    if as_of is not None:
        msgs = msgs.withColumn("time_label", chat_time_label(F.col("ts"), as_of, tz))
    if positions:
        return number_rows(msgs, [order[0]], [F.asc(c) for c in order[1:]], "pos")
    return msgs.orderBy(*order)


def create_chat_rows(new: DataFrame) -> DataFrame:
    """new(chatID, creatorID, inviteeID) -> membership rows for both
    people, as put operations for ``apply_changes``."""
    rows = new.select("chatID", F.col("creatorID").alias("userID"), "seq") \
        .unionByName(new.select("chatID", F.col("inviteeID").alias("userID"), "seq"))
    return rows.withColumn("op", F.lit("put"))


def open_chats(new: DataFrame, accounts: DataFrame):
    """new(chatID, creatorID, inviteeID, seq) -> (rooms(userID, chatID),
    members(chatID, userID, firstName, lastName)), one row per person and chat,
    also where someone invites themselves or an invitation is repeated; names
    are null for unknown people, and rows without a person are left out."""
    rooms = create_chat_rows(new).where(F.col("userID").isNotNull()).select("userID", "chatID").distinct()
    names = enrich_users(rooms, accounts, "userID", "", ("firstName", "lastName"))
    return rooms, names.select("chatID", "userID", "firstName", "lastName")
