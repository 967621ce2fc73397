"""Views of the social-network data model over the driver's tables.

Each view exists twice, side by side: as a DataFrame (what the library
consumes) and as a DuckDB SQL CTE body (what the oracle queries consume).
Keep the two in step when changing either.

Ids are BIGINT here; the library functions do not assume string ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


class Bindings:
    """Lazily built views for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, events: DataFrame | None = None):
        """``events`` stands for that table, for instance as a stream."""
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.events = events

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ---- n = max(c_custkey) + 1, as a scalar subquery (no driver round trip)
    @property
    def n(self) -> Column:
        return self.table("customer").agg((F.max("c_custkey") + 1).alias("n")).scalar()

    @property
    def edges(self) -> DataFrame:
        """Follower graph (src, dst): src = o_custkey, dst = n/3 + o_orderkey % n."""
        n = self.n
        o = self.table("orders")
        return (o.select(F.col("o_custkey").alias("src"),
                         (F.floor(n / 3) + F.col("o_orderkey") % n).cast("bigint").alias("dst"))
                .distinct())

    @property
    def accounts(self) -> DataFrame:
        c = self.table("customer")
        return c.select(
            F.col("c_custkey").alias("userID"),
            F.col("c_name").alias("username"),
            F.lit("Customer").alias("firstName"),
            F.substring("c_name", 10, 1 << 20).alias("lastName"),
            F.col("c_mktsegment").alias("affiliation"))

    @property
    def friends(self) -> DataFrame:
        """Symmetric friendship rows (followerID, followedID, ts), no self rows;
        ts is the first order date that links the two users."""
        n = self.n
        pairs = (self.table("orders")
                 .select(F.col("o_custkey").alias("a"), (F.col("o_orderkey") % n).alias("b"),
                         F.col("o_orderdate").alias("ts"))
                 .where(F.col("a") != F.col("b")))
        # both directions from one scan
        both = pairs.select(F.explode(F.array(
            F.struct(F.col("a").alias("followerID"), F.col("b").alias("followedID"), "ts"),
            F.struct(F.col("b").alias("followerID"), F.col("a").alias("followedID"), "ts"))).alias("p"))
        return both.select("p.*").groupBy("followerID", "followedID").agg(F.min("ts").alias("ts"))

    @property
    def posts(self) -> DataFrame:
        n = self.n
        return self.table("orders").select(
            F.col("o_orderkey").alias("postID"),
            (F.col("o_orderkey") % n).alias("userID"),
            F.col("o_custkey").alias("creatorID"),
            F.col("o_orderpriority").alias("content"),
            F.col("o_orderdate").alias("ts"))

    @property
    def comments(self) -> DataFrame:
        l = self.table("lineitem")
        return (l.groupBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
                .agg(F.min("l_shipdate").alias("ts"),
                     F.min(F.concat("l_returnflag", "l_linestatus")).alias("content"))
                .select(F.col("l_orderkey").alias("postID"),
                        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("commentID"),
                        F.col("l_suppkey").alias("creatorID"), "content", "ts"))

    def _events_k(self) -> DataFrame:
        events = self.table("events") if self.events is None else self.events
        return events.withColumn(
            "k", F.get_json_object("props", "$.k").cast("bigint"))

    @property
    def like_log(self) -> DataFrame:
        e = self._events_k()
        return e.select(F.col("event_id").alias("seq"),
                        F.when(F.col("event_type") == "error", "delete").otherwise("put").alias("op"),
                        F.col("k").alias("postID"), F.col("user_id").alias("userID"), "ts")

    @property
    def notifications(self) -> DataFrame:
        e = self._events_k().where(F.col("event_type") == "signup")
        return e.select(F.col("user_id").alias("recipientID"), F.col("k").alias("senderID"),
                        F.lit("friendRequest").alias("notificationType"), "ts",
                        F.col("event_id").alias("seq"))

    @property
    def request_log(self) -> DataFrame:
        """Notifications among the first users, so that pairs meet again and again:
        clicks and signups are friend requests, views are other notifications."""
        e = self._events_k().where(F.col("event_type").isin("click", "signup", "view"))
        kind = F.when(F.col("event_type") == "view", "like").otherwise("friendRequest")
        return e.select((F.col("user_id") % 40).alias("recipientID"), (F.col("k") % 40).alias("senderID"), kind.alias("notificationType"),
                        "ts", F.col("event_id").alias("seq")).where("recipientID <> senderID")

    @property
    def pending_before(self) -> DataFrame:
        """Notifications that were there before the log's: errors with an even id are
        requests, those with an odd id are likes."""
        e = self._events_k().where(F.col("event_type") == "error")
        kind = F.when(F.col("event_id") % 2 == 0, "friendRequest").otherwise("like")
        return e.select((F.col("user_id") % 60).alias("recipientID"), (F.col("k") % 60).alias("senderID"), kind.alias("notificationType"),
                        "ts").where("recipientID <> senderID")

    @property
    def first_requests(self) -> DataFrame:
        """The time of each pair's first request in the log."""
        return self.request_log.where("notificationType = 'friendRequest'").groupBy("recipientID", "senderID").agg(
            F.min_by("ts", "seq").alias("_t"))

    @property
    def accepts(self) -> DataFrame:
        return self.accepts_of(self.first_requests)

    def accepts_of(self, first: DataFrame) -> DataFrame:
        """Acceptances: each purchase accepts the pair's first request of the log,
        every fifth with a time that no request has."""
        e = self._events_k().where(F.col("event_type") == "purchase")
        a = e.select((F.col("user_id") % 40).alias("recipientID"), (F.col("k") % 40).alias("senderID"), "ts", F.col("event_id").alias("seq"))
        wrong = F.when(F.col("seq") % 5 == 0, F.expr("_t + interval 1 second")).otherwise(F.col("_t"))
        return a.join(first, ["recipientID", "senderID"]).select("recipientID", "senderID", wrong.alias("requestTs"), "ts", "seq")

    @property
    def old_friends(self) -> DataFrame:
        """The friendships of users 0 to 39 whose ids add up to an even number."""
        return self.friends.where("followerID < 40 and followedID < 40 and (followerID + followedID) % 2 = 0").select(
            "followerID", "followedID", F.col("ts").cast("timestamp_ntz").alias("ts"))

    @property
    def memberships(self) -> DataFrame:
        e = self._events_k().where(F.col("event_type") != "error")
        return e.select(F.col("k").alias("chatID"), F.col("user_id").alias("userID")).distinct()

    @property
    def messages(self) -> DataFrame:
        e = self._events_k()
        return e.select(F.col("k").alias("chatID"), F.col("event_id").alias("message_id"),
                        F.col("user_id").alias("userID"), F.col("event_type").alias("message"), "ts")

    @property
    def messages_text(self) -> DataFrame:
        c = self.table("conversations")
        return c.select(F.col("conv_id").alias("chatID"), F.col("turn").alias("message_id"),
                        F.col("role").alias("author"), F.col("text").alias("message"))

    @property
    def news(self) -> DataFrame:
        """News articles: headline = doc id, authors = source, category = lang,
        short_description = the whole text, link derived from the id."""
        d = self.table("documents")
        return d.select(
            F.col("source").alias("authors"),
            F.col("lang").alias("category"),
            F.lit(None).cast("string").alias("date"),
            F.col("doc_id").cast("string").alias("headline"),
            F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("link"),
            F.col("text").alias("short_description"),
            F.col("doc_id").alias("seq"))

    @property
    def search_queries(self) -> DataFrame:
        """News searches: every user turn of a conversation is one search."""
        c = self.table("conversations").where(F.col("role") == "user")
        return c.select(F.concat_ws(":", "conv_id", "turn").alias("query_id"),
                        F.col("text").alias("query"))

    @property
    def user_searches(self) -> DataFrame:
        """People searches: each customer types the first 16 characters of
        their own name (the feature under test is prefix lookup)."""
        c = self.table("customer")
        return c.select(F.col("c_custkey").alias("query_id"),
                        F.substring("c_name", 1, 16).alias("query"))


# ---------------------------------------------------------------- DuckDB CTEs
_N = "(SELECT max(c_custkey) + 1 FROM customer)"

SQL_VIEWS: dict[str, str] = {
    "edges": f"""SELECT DISTINCT o_custkey AS src,
        CAST(floor({_N} / 3) + o_orderkey % {_N} AS BIGINT) AS dst FROM orders""",
    "accounts": """SELECT c_custkey AS userID, c_name AS username, 'Customer' AS firstName,
        substr(c_name, 10) AS lastName, c_mktsegment AS affiliation FROM customer""",
    "friends": f"""SELECT followerID, followedID, min(ts) AS ts FROM (
        SELECT o_custkey AS followerID, o_orderkey % {_N} AS followedID, o_orderdate AS ts
          FROM orders WHERE o_custkey <> o_orderkey % {_N}
        UNION ALL
        SELECT o_orderkey % {_N}, o_custkey, o_orderdate
          FROM orders WHERE o_custkey <> o_orderkey % {_N}) GROUP BY followerID, followedID""",
    "posts": f"""SELECT o_orderkey AS postID, o_orderkey % {_N} AS userID, o_custkey AS creatorID,
        o_orderpriority AS content, o_orderdate AS ts FROM orders""",
    "comments": """SELECT l_orderkey AS postID,
        concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS commentID,
        l_suppkey AS creatorID, min(l_returnflag || l_linestatus) AS content, min(l_shipdate) AS ts
        FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey""",
    "like_log": """SELECT event_id AS seq, CASE WHEN event_type = 'error' THEN 'delete' ELSE 'put' END AS op,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS postID, user_id AS userID, ts FROM events""",
    "notifications": """SELECT user_id AS recipientID, CAST(json_extract_string(props, '$.k') AS BIGINT) AS senderID,
        'friendRequest' AS notificationType, ts, event_id AS seq FROM events WHERE event_type = 'signup'""",
    "request_log": """SELECT * FROM (SELECT user_id % 40 AS recipientID, CAST(json_extract_string(props, '$.k') AS BIGINT) % 40 AS senderID,
        CASE WHEN event_type = 'view' THEN 'like' ELSE 'friendRequest' END AS notificationType, ts, event_id AS seq
        FROM events WHERE event_type IN ('click', 'signup', 'view')) WHERE recipientID <> senderID""",
    "pending_before": """SELECT * FROM (SELECT user_id % 60 AS recipientID, CAST(json_extract_string(props, '$.k') AS BIGINT) % 60 AS senderID,
        CASE WHEN event_id % 2 = 0 THEN 'friendRequest' ELSE 'like' END AS notificationType, ts
        FROM events WHERE event_type = 'error') WHERE recipientID <> senderID""",
    "accepts": """SELECT recipientID, senderID, CASE WHEN a.seq % 5 = 0 THEN t + INTERVAL 1 SECOND ELSE t END AS requestTs, a.ts, a.seq
        FROM (SELECT user_id % 40 AS recipientID, CAST(json_extract_string(props, '$.k') AS BIGINT) % 40 AS senderID, ts, event_id AS seq
              FROM events WHERE event_type = 'purchase') a
        JOIN (SELECT recipientID, senderID, arg_min(ts, seq) AS t FROM request_log
              WHERE notificationType = 'friendRequest' GROUP BY ALL) USING (recipientID, senderID)""",
    "old_friends": """SELECT followerID, followedID, CAST(ts AS TIMESTAMP) AS ts FROM friends
        WHERE followerID < 40 AND followedID < 40 AND (followerID + followedID) % 2 = 0""",
    "memberships": """SELECT DISTINCT CAST(json_extract_string(props, '$.k') AS BIGINT) AS chatID,
        user_id AS userID FROM events WHERE event_type <> 'error'""",
    "messages": """SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS chatID, event_id AS message_id,
        user_id AS userID, event_type AS message, ts FROM events""",
    "messages_text": """SELECT conv_id AS chatID, turn AS message_id, role AS author, text AS message
        FROM conversations""",
    "news": """SELECT source AS authors, lang AS category, CAST(NULL AS VARCHAR) AS date,
        CAST(doc_id AS VARCHAR) AS headline, 'doc/' || CAST(doc_id AS VARCHAR) AS link,
        text AS short_description, doc_id AS seq FROM documents""",
    "search_queries": """SELECT concat_ws(':', conv_id, turn) AS query_id, text AS query
        FROM conversations WHERE role = 'user'""",
    "user_searches": """SELECT c_custkey AS query_id, substr(c_name, 1, 16) AS query FROM customer""",
}


def with_views(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` prefix for an oracle query."""
    return "WITH " + ",\n".join(f"{n} AS ({SQL_VIEWS[n]})" for n in names) + "\n"
