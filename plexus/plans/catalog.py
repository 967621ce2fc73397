"""Registered queries: each is a function (spark, sf_dir) -> DataFrame over
the driver tables, with an optional DuckDB oracle SQL over the same tables.

Column names match between the Spark result and the SQL; floats are rounded
to 6 places in both so the order-insensitive hash comparison is stable.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plexus.functions.porter import stem_sql
from plexus.operators import graph as G
from plexus.operators import social as S
from plexus.operators import text as T
from plexus.plans import rank_sql
from plexus.session import scratch_path
from plexus.sources.edges import read_edge_list
from plexus.sources.keyword_index import search_stored, store_index
from plexus.sources.name_index import add_names, name_changes, search_stored_users, stored_names
from plexus.sources.news import read_news
from plexus.sources.sinks import write_edge_list, write_news_json, write_report
from plexus.streaming import jobs as X
from plexus.sources.bindings import SQL_VIEWS, Bindings, with_views


@dataclass
class Registered:
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Registered] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = Registered(fn, sql)
        return fn
    return deco


RANK_ROUNDS = 25     # the rank job's most rounds; the queries run them all
TOP_K = 10


def _r6(df: DataFrame, col: str = "rank") -> DataFrame:
    return df.withColumn(col, F.round(col, 6))


def _tied(ranks: DataFrame) -> DataFrame:
    """Ranks that differ by less than the noise of summing in another order are
    ties (by node id); only what is shown is rounded to 6 places."""
    return ranks.withColumn("rank", F.round("rank", rank_sql.TIE_PLACES))


# ------------------------------------------------------------------ graph

@register("edge_stats", with_views("edges") + """,
roles AS (SELECT node, sum(o) AS out_degree, sum(i) AS in_degree FROM (
    SELECT src AS node, 1 AS o, 0 AS i FROM edges UNION ALL SELECT dst, 0, 1 FROM edges) GROUP BY node)
SELECT CAST(sum(out_degree) AS BIGINT) AS n_edges, CAST(count(*) AS BIGINT) AS n_nodes,
  CAST(count_if(out_degree > 0) AS BIGINT) AS n_sources,
  CAST(count_if(in_degree > 0) AS BIGINT) AS n_destinations,
  CAST(count_if(in_degree > 0 AND out_degree = 0) AS BIGINT) AS n_sinks,
  CAST(coalesce(sum(CASE WHEN in_degree > 0 AND out_degree = 0 THEN in_degree END), 0) AS BIGINT) AS n_back_links
FROM roles""".replace("WITH edges", "WITH edges", 1))
def q_edge_stats(spark, sf):
    return G.edge_stats(Bindings(spark, sf).edges)


@register("degree_ranking", with_views("edges") +
          "SELECT src AS node, count(*) AS degree FROM edges GROUP BY src")
def q_degree_ranking(spark, sf):
    return G.degree_ranking(Bindings(spark, sf).edges)


@register("find_sinks", with_views("edges") +
          "SELECT DISTINCT dst AS node FROM edges WHERE dst NOT IN (SELECT src FROM edges)")
def q_find_sinks(spark, sf):
    return G.find_sinks(Bindings(spark, sf).edges)


@register("add_back_links", with_views("edges") + """,
sinks AS (SELECT DISTINCT dst AS node FROM edges WHERE dst NOT IN (SELECT src FROM edges))
SELECT src, dst FROM edges UNION
SELECT e.dst AS src, e.src AS dst FROM edges e JOIN sinks s ON e.dst = s.node""")
def q_add_back_links(spark, sf):
    return G.add_back_links(Bindings(spark, sf).edges)


@register("transition_weights", with_views("edges") + """,
deg AS (SELECT src, count(*) AS c FROM edges GROUP BY src)
SELECT e.src, e.dst, CAST(1.0 AS DOUBLE) / deg.c AS w FROM edges e JOIN deg USING (src)""")
def q_transition_weights(spark, sf):
    return G.transition_weights(Bindings(spark, sf).edges)


@register("social_rank", rank_sql.fixed_rounds_sql(RANK_ROUNDS, True))
def q_social_rank(spark, sf):
    return _r6(G.social_rank(Bindings(spark, sf).edges, max_iters=RANK_ROUNDS, delta=None))


@register("social_rank_no_backlinks", rank_sql.fixed_rounds_sql(RANK_ROUNDS, False))
def q_social_rank_nb(spark, sf):
    return _r6(G.social_rank(Bindings(spark, sf).edges, max_iters=RANK_ROUNDS, delta=None,
                             back_links=False))


@register("social_rank_converged", rank_sql.converged_sql(25, 1e-4, True))
def q_social_rank_conv(spark, sf):
    return _r6(G.social_rank(Bindings(spark, sf).edges, max_iters=25, delta=1e-4))


@register("rank_history", rank_sql.history_sql(RANK_ROUNDS, True))
def q_rank_history(spark, sf):
    return _r6(G.rank_history(Bindings(spark, sf).edges, RANK_ROUNDS))


@register("top_ranked", rank_sql.top_sql(RANK_ROUNDS, TOP_K, True))
def q_top_ranked(spark, sf):
    ranks = G.social_rank(Bindings(spark, sf).edges, max_iters=RANK_ROUNDS, delta=None)
    return _r6(G.top_ranked(_tied(ranks), TOP_K))


@register("compare_top", rank_sql.compare_sql(RANK_ROUNDS, TOP_K))
def q_compare_top(spark, sf):
    e = Bindings(spark, sf).edges
    a = _tied(G.social_rank(e, max_iters=RANK_ROUNDS, delta=None, back_links=True))
    b = _tied(G.social_rank(e, max_iters=RANK_ROUNDS, delta=None, back_links=False))
    return G.compare_top(a, b, TOP_K)


_EGO_SQL = with_views("accounts", "friends")


@register("ego_nodes", _EGO_SQL + """
SELECT userID AS ego, userID AS id, firstName || ' ' || lastName AS label, affiliation, true AS is_self
FROM accounts
UNION ALL
SELECT f.followerID, f.followedID, a.firstName || ' ' || a.lastName, a.affiliation, false
FROM friends f JOIN accounts a ON f.followedID = a.userID""")
def q_ego_nodes(spark, sf):
    b = Bindings(spark, sf)
    return G.ego_network(b.accounts, b.friends)[0]


@register("ego_edges", _EGO_SQL + "SELECT followerID AS ego, followerID AS src, followedID AS dst FROM friends")
def q_ego_edges(spark, sf):
    b = Bindings(spark, sf)
    return G.ego_network(b.accounts, b.friends)[1]


_EXPAND_SQL = with_views("accounts", "friends") + """,
req AS (SELECT followerID AS request_id, followerID AS viewer,
          arg_min(followedID, (ts, followedID)) AS friend FROM friends GROUP BY followerID),
cand AS (SELECT r.request_id, r.viewer, r.friend, f.followedID AS id, v.affiliation AS v_aff
         FROM req r JOIN friends f ON f.followerID = r.friend
         JOIN accounts v ON v.userID = r.viewer
         WHERE f.followedID <> r.viewer
           AND NOT EXISTS (SELECT 1 FROM friends s WHERE s.followerID = r.viewer AND s.followedID = f.followedID)),
new AS (SELECT c.request_id, c.viewer, c.friend, c.id, a.firstName || ' ' || a.lastName AS label
        FROM cand c JOIN accounts a ON a.userID = c.id WHERE a.affiliation = c.v_aff)
"""


@register("expand_nodes", _EXPAND_SQL + "SELECT request_id, id, label FROM new")
def q_expand_nodes(spark, sf):
    b = Bindings(spark, sf)
    return G.expand_network(b.accounts, b.friends, G.first_friend_requests(b.friends))[0]


@register("expand_edges", _EXPAND_SQL + """
SELECT request_id, friend AS src, id AS dst FROM new
UNION ALL
SELECT n.request_id, s.followedID AS src, n.id AS dst
FROM new n JOIN friends s ON s.followerID = n.viewer
JOIN friends t ON t.followerID = n.id AND t.followedID = s.followedID
WHERE s.followedID <> n.friend
UNION ALL
SELECT n.request_id, n.viewer AS src, n.id AS dst
FROM new n JOIN friends t ON t.followerID = n.id AND t.followedID = n.viewer
WHERE n.viewer <> n.friend""")
def q_expand_edges(spark, sf):
    b = Bindings(spark, sf)
    return G.expand_network(b.accounts, b.friends, G.first_friend_requests(b.friends))[1]


EXPAND_STEPS = 3


def _expand_steps_sql() -> str:
    """One set of CTEs per step: the screen before it, its new nodes, its edges."""
    out = with_views("accounts", "friends") + """,
clicks AS (SELECT * FROM (SELECT followerID AS request_id, followedID AS friend,
    row_number() OVER (PARTITION BY followerID ORDER BY ts, followedID) AS step FROM friends) WHERE step <= %d),
shown1 AS (SELECT DISTINCT followerID AS request_id, followerID AS id FROM friends
           UNION SELECT followerID, followedID FROM friends)""" % EXPAND_STEPS
    for i in range(1, EXPAND_STEPS + 1):
        out += f""",
new{i} AS (SELECT c.request_id, c.friend, a.userID AS id, a.firstName || ' ' || a.lastName AS label
  FROM clicks c JOIN friends f ON f.followerID = c.friend JOIN accounts a ON a.userID = f.followedID
  JOIN accounts v ON v.userID = c.request_id AND v.affiliation = a.affiliation
  WHERE c.step = {i} AND NOT EXISTS (SELECT 1 FROM shown{i} s WHERE s.request_id = c.request_id AND s.id = a.userID)),
link{i} AS (SELECT request_id, friend AS src, id AS dst FROM new{i}
  UNION ALL SELECT n.request_id, s.id, n.id FROM new{i} n JOIN shown{i} s ON s.request_id = n.request_id AND s.id <> n.friend
  JOIN friends t ON t.followerID = n.id AND t.followedID = s.id),
shown{i + 1} AS (SELECT * FROM shown{i} UNION SELECT request_id, id FROM new{i})"""
    return out


def _per_step(columns: str, name: str) -> str:
    return " UNION ALL ".join(f"SELECT request_id, CAST({i} AS INTEGER) AS step, {columns} FROM {name}{i}"
                              for i in range(1, EXPAND_STEPS + 1))


def _expand_steps(spark, sf):
    b = Bindings(spark, sf)
    return G.expand_network_steps(b.accounts, b.friends, G.oldest_friend_clicks(b.friends, EXPAND_STEPS), EXPAND_STEPS)


@register("expand_steps_nodes", _expand_steps_sql() + "\n" + _per_step("id, label", "new"))
def q_expand_steps_nodes(spark, sf):
    return _expand_steps(spark, sf)[0]


@register("expand_steps_edges", _expand_steps_sql() + "\n" + _per_step("src, dst", "link"))
def q_expand_steps_edges(spark, sf):
    return _expand_steps(spark, sf)[1]


@register("friend_counts", with_views("friends") +
          "SELECT followerID AS userID, count(*) AS n_friends FROM friends GROUP BY followerID")
def q_friend_counts(spark, sf):
    return G.friend_counts(Bindings(spark, sf).friends)


@register("mutual_friends", with_views("friends") + """
SELECT p.followerID AS a, p.followedID AS b,
  (SELECT count(*) FROM friends x JOIN friends y ON x.followedID = y.followedID
   WHERE x.followerID = p.followerID AND y.followerID = p.followedID) AS n_mutual
FROM friends p WHERE p.followerID < p.followedID""")
def q_mutual_friends(spark, sf):
    return G.mutual_friends(Bindings(spark, sf).friends)


# ------------------------------------------------------------------- text

_STOP_SQL = "('a', 'all', 'any', 'but', 'the')"
# raw (doc, token) rows: letter runs of the three text fields, ASCII words
# that are not stop words (checked before lowercasing), lowercased
_TOKENS_SQL = with_views("news") + f""",
runs AS (SELECT headline, link, unnest(regexp_extract_all(
    coalesce(headline, '') || ' ' || coalesce(authors, '') || ' ' || coalesce(short_description, ''),
    '(\\p{{L}}+)', 1)) AS t FROM news),
toks AS (SELECT DISTINCT headline, link, lower(t) AS token FROM runs
         WHERE regexp_full_match(t, '[a-zA-Z]+') AND t NOT IN {_STOP_SQL})"""
_STEMMED_SQL = _TOKENS_SQL + f""",
stems AS ({stem_sql("SELECT DISTINCT token AS word FROM toks")}),
idx AS (SELECT s.stem AS keyword, t.headline, max(t.link) AS url FROM toks t JOIN stems s ON t.token = s.word GROUP BY 1, 2)"""
_RAW_IDX_SQL = _TOKENS_SQL + """,
idx AS (SELECT token AS keyword, headline, max(link) AS url FROM toks GROUP BY 1, 2)"""


def _queries_sql(stem: bool) -> str:
    words = """,
qsplit AS (SELECT query_id, string_split(query, ' ') AS l FROM search_queries),
qwords AS (SELECT query_id, pos, lower(raw) AS token FROM (
    SELECT query_id, unnest(range(len(l))) AS pos, unnest(l) AS raw FROM qsplit) WHERE raw <> '')"""
    if stem:
        words += f""",
qstems AS ({stem_sql("SELECT DISTINCT token AS word FROM qwords")}),
kw AS (SELECT query_id, s.stem AS keyword, min(pos) AS pos FROM qwords q JOIN qstems s ON q.token = s.word
       GROUP BY query_id, s.stem)"""
    else:
        words += """,
kw AS (SELECT query_id, token AS keyword, min(pos) AS pos FROM qwords GROUP BY query_id, token)"""
    return words


def _search_sql(stem: bool) -> str:
    base = (_STEMMED_SQL if stem else _RAW_IDX_SQL).replace("WITH news AS", "WITH search_queries AS ("
                                                           + SQL_VIEWS["search_queries"] + "),\nnews AS", 1)
    return base + _queries_sql(stem) + """,
hits AS (SELECT k.query_id, k.pos, i.headline, i.url FROM kw k JOIN idx i USING (keyword)),
firsts AS (SELECT query_id, headline, min(pos) AS pos FROM hits GROUP BY query_id, headline),
linked AS (SELECT f.query_id, f.headline, f.pos, min(h.url) AS url FROM firsts f JOIN hits h USING (query_id, headline, pos) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY pos, headline) AS rk FROM linked)
SELECT query_id, CAST(rk AS INTEGER) AS rank, headline, url FROM ranked WHERE rk <= 15"""


@register("news_table", with_views("news") + """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY headline, date ORDER BY seq DESC) AS rn
  FROM news WHERE headline IS NOT NULL) WHERE rn = 1""")
def q_news_table(spark, sf):
    return T.news_table(Bindings(spark, sf).news)


@register("keyword_tokens", _TOKENS_SQL + "\nSELECT headline, token AS keyword FROM toks")
def q_keyword_tokens(spark, sf):
    return T.document_tokens(Bindings(spark, sf).news, stem=False).select("headline", "keyword").distinct()


@register("keyword_index_raw", _RAW_IDX_SQL + "\nSELECT keyword, headline, url FROM idx")
def q_keyword_index_raw(spark, sf):
    return T.build_keyword_index(Bindings(spark, sf).news, stem=False)


@register("keyword_index", _STEMMED_SQL + "\nSELECT keyword, headline, url FROM idx")
def q_keyword_index(spark, sf):
    return T.build_keyword_index(Bindings(spark, sf).news, stem=True)


@register("query_keywords", with_views("search_queries").rstrip() + _queries_sql(True)
          + "\nSELECT query_id, CAST(pos AS BIGINT) AS pos, keyword FROM kw")
def q_query_keywords(spark, sf):
    return T.parse_queries(Bindings(spark, sf).search_queries, stem=True) \
        .select("query_id", F.col("pos").cast("bigint").alias("pos"), "keyword")


@register("search_news_raw", _search_sql(False))
def q_search_news_raw(spark, sf):
    b = Bindings(spark, sf)
    return T.search_news(b.search_queries, T.build_keyword_index(b.news, stem=False), stem=False)


@register("search_news", _search_sql(True))
def q_search_news(spark, sf):
    b = Bindings(spark, sf)
    return T.search_news(b.search_queries, T.build_keyword_index(b.news, stem=True), stem=True)


@register("search_stored_index", _search_sql(True))
def q_search_stored_index(spark, sf):
    """The index is written first, in two parts as it would grow, then searched."""
    b = Bindings(spark, sf)
    path = scratch_path(spark, "keyword_index")
    odd = F.pmod("seq", F.lit(2)) == 1
    store_index(T.build_keyword_index(b.news.where(odd)), path)
    store_index(T.build_keyword_index(b.news.where(~odd)), path, append=True)
    return search_stored(b.search_queries, path)


@register("stem_tokens", _TOKENS_SQL + """,
places AS (SELECT headline, unnest(l) AS t, generate_subscripts(l, 1) AS pos FROM (
    SELECT headline, regexp_extract_all(concat_ws(' ', headline, authors, short_description), '(\\p{L}+)', 1) AS l FROM news)),
kept AS (SELECT headline, lower(t) AS token, pos FROM places WHERE regexp_full_match(t, '[a-zA-Z]+') AND t NOT IN """
          + _STOP_SQL + f"""),
stems AS ({stem_sql("SELECT DISTINCT token AS word FROM kept")}),
firsts AS (SELECT headline, stem, min(pos) AS pos FROM kept JOIN stems ON token = word GROUP BY headline, stem),
lists AS (SELECT headline, string_agg(stem, ' ' ORDER BY pos) AS stems FROM firsts GROUP BY headline)
SELECT n.headline, coalesce(l.stems, '') AS stems FROM news n LEFT JOIN lists l USING (headline)""")
def q_stem_tokens(spark, sf):
    rows = T.stem_tokens(T.tokenize(Bindings(spark, sf).news))
    return rows.select("headline", F.array_join("stems", " ").alias("stems"))


# conversations are mostly no letters-only searches, part names are
_TYPED_SQL = """search_queries AS (SELECT concat_ws(':', conv_id, turn) AS query_id, text AS query FROM conversations
  WHERE role = 'user' AND regexp_full_match(text, '[A-Za-z ]+')
  UNION ALL SELECT 'part:' || p_partkey, p_name FROM part WHERE regexp_full_match(p_name, '[A-Za-z ]+'))"""


@register("query_keywords_letters", "WITH " + _TYPED_SQL + _queries_sql(True)
          + "\nSELECT query_id, CAST(pos AS INTEGER) AS pos, keyword FROM kw")
def q_query_keywords_letters(spark, sf):
    b = Bindings(spark, sf)
    names = b.table("part").select(F.concat(F.lit("part:"), "p_partkey").alias("query_id"), F.col("p_name").alias("query"))
    return T.parse_queries(b.search_queries.unionByName(names), letters_only=True)


@register("search_news_articles", f"""SELECT r.*, n.category, n.authors
FROM ({_search_sql(False)}) r JOIN ({SQL_VIEWS["news"]}) n ON n.headline = r.headline AND n.link = r.url""")
def q_search_news_articles(spark, sf):
    b = Bindings(spark, sf)
    index = T.build_keyword_index(b.news, stem=False)
    return T.search_news(b.search_queries, index, news=b.news, stem=False).select(
        "query_id", "rank", "headline", "url", "category", "authors")


_PREFIX_SQL = with_views("accounts", "user_searches") + """,
pidx AS (SELECT DISTINCT substr(lower(username), 1, n) AS prefix, userID FROM (
    SELECT userID, username, unnest(range(1, length(username) + 1)) AS n FROM accounts
    WHERE length(username) > 0))
"""


@register("prefix_index", _PREFIX_SQL + "SELECT prefix, userID FROM pidx")
def q_prefix_index(spark, sf):
    return T.build_prefix_index(Bindings(spark, sf).accounts)


@register("prefix_sizes", _PREFIX_SQL + "SELECT prefix, count(*) AS n_users FROM pidx GROUP BY prefix")
def q_prefix_sizes(spark, sf):
    return T.prefix_sizes(T.build_prefix_index(Bindings(spark, sf).accounts))


@register("user_search", _PREFIX_SQL + """SELECT q.query_id, p.userID, a.username
FROM user_searches q JOIN pidx p ON lower(q.query) = p.prefix JOIN accounts a ON a.userID = p.userID""")
def q_user_search(spark, sf):
    b = Bindings(spark, sf)
    return T.search_users(b.user_searches, T.build_prefix_index(b.accounts), b.accounts)


# ----------------------------------------------------------------- social

@register("resolve_users", with_views("accounts") + """
SELECT n.username, a.userID FROM (SELECT c_name AS username FROM customer UNION ALL
  SELECT s_name FROM supplier) n LEFT JOIN accounts a USING (username)""")
def q_resolve_users(spark, sf):
    b = Bindings(spark, sf)
    names = b.table("customer").select(F.col("c_name").alias("username")).unionByName(
        b.table("supplier").select(F.col("s_name").alias("username")))
    return S.resolve_users(names, b.accounts)


def _signups(b: Bindings) -> DataFrame:
    """Sign-ups from the tables: every supplier (new names), every customer
    again (names taken) and every part under its brand (claimed many times
    in one batch)."""
    sup = b.table("supplier").select(F.col("s_name").alias("username"), F.lit("Supplier").alias("firstName"),
                                     F.substring("s_name", 10, 1 << 20).alias("lastName"),
                                     F.col("s_suppkey").alias("seq"))
    cus = b.table("customer").select(F.col("c_name").alias("username"), F.lit("Customer").alias("firstName"),
                                     F.substring("c_name", 10, 1 << 20).alias("lastName"),
                                     (F.col("c_custkey") + 1000000000).alias("seq"))
    par = b.table("part").select(F.col("p_brand").alias("username"), F.col("p_type").alias("firstName"),
                                 F.col("p_name").alias("lastName"), (F.col("p_partkey") + 2000000000).alias("seq"))
    return sup.unionByName(cus).unionByName(par)


@register("register_accounts", with_views("accounts") + """,
signups AS (
  SELECT s_name AS username, 'Supplier' AS firstName, substr(s_name, 10) AS lastName, s_suppkey AS seq FROM supplier
  UNION ALL SELECT c_name, 'Customer', substr(c_name, 10), c_custkey + 1000000000 FROM customer
  UNION ALL SELECT p_brand, p_type, p_name, p_partkey + 2000000000 FROM part),
chk AS (SELECT *, list_filter([CASE WHEN coalesce(trim(username), '') = '' THEN 'username' END,
                               CASE WHEN coalesce(trim(firstName), '') = '' THEN 'firstName' END,
                               CASE WHEN coalesce(trim(lastName), '') = '' THEN 'lastName' END],
                              lambda x: x IS NOT NULL) AS miss FROM signups),
valid AS (SELECT * FROM chk WHERE len(miss) = 0),
free AS (SELECT * FROM valid WHERE username NOT IN (SELECT username FROM accounts)),
firsts AS (SELECT username, min(seq) AS f FROM free GROUP BY username)
SELECT seq, username, CASE WHEN seq = f THEN 'accepted' ELSE 'duplicate_in_batch' END AS status
  FROM free JOIN firsts USING (username)
UNION ALL SELECT seq, username, 'username_taken' FROM valid WHERE username IN (SELECT username FROM accounts)
UNION ALL SELECT seq, username, 'missing:' || array_to_string(miss, ',') FROM chk WHERE len(miss) > 0""")
def q_register_accounts(spark, sf):
    b = Bindings(spark, sf)
    return S.register_accounts(_signups(b), b.accounts).select("seq", "username", "status")


_SIGN_UP_SQL = with_views("accounts") + """,
forms AS (SELECT s_name AS username, 'Supplier' AS firstName, substr(s_name, 10) AS lastName,
    CASE WHEN s_suppkey % 7 = 0 THEN ' ' ELSE 'Trade' END AS affiliation, s_suppkey AS seq FROM supplier
  UNION ALL SELECT c_name, 'Customer', substr(c_name, 10), c_mktsegment, c_custkey + 1000000000 FROM customer
  UNION ALL SELECT p_brand, p_type, p_name, CASE WHEN p_size > 10 THEN p_brand END, p_partkey + 2000000000 FROM part),
whole AS (SELECT *, 5000000000 + seq AS userID FROM forms
          WHERE trim(username) <> '' AND trim(firstName) <> '' AND trim(lastName) <> '' AND trim(affiliation) <> ''),
taken AS (SELECT * FROM whole WHERE username NOT IN (SELECT username FROM accounts)),
joined AS (SELECT * FROM taken QUALIFY row_number() OVER (PARTITION BY username ORDER BY seq) = 1),
after AS (SELECT userID, username, firstName, lastName, affiliation FROM accounts
          UNION ALL SELECT userID, username, firstName, lastName, affiliation FROM joined)
"""


def _sign_up(b: Bindings):
    t = {"supplier": "s_suppkey", "customer": "c_custkey", "part": "p_partkey"}
    own = {"supplier": F.when(F.col("s_suppkey") % 7 == 0, " ").otherwise("Trade"), "customer": F.col("c_mktsegment"),
           "part": F.when(F.col("p_size") > 10, F.col("p_brand"))}
    aff = [b.table(n).select((F.col(k) + i * 1000000000).alias("seq"), own[n].alias("affiliation"))
           for i, (n, k) in enumerate(t.items())]
    forms = _signups(b).join(aff[0].unionByName(aff[1]).unionByName(aff[2]), "seq")
    return S.sign_up(forms.withColumn("userID", F.col("seq") + 5000000000), b.accounts,
                     required=("username", "firstName", "lastName", "affiliation"))


@register("sign_up_accounts", _SIGN_UP_SQL + "SELECT * FROM after")
def q_sign_up_accounts(spark, sf):
    return _sign_up(Bindings(spark, sf))[0]


@register("sign_up_prefixes", _SIGN_UP_SQL + """
SELECT DISTINCT lower(substr(username, 1, CAST(n AS INTEGER))) AS prefix, userID
FROM (SELECT username, userID, unnest(range(1, length(username) + 1)) AS n FROM joined)""")
def q_sign_up_prefixes(spark, sf):
    """The name-search rows that the sign-ups add."""
    b = Bindings(spark, sf)
    return T.name_prefixes(_sign_up(b)[0].join(b.accounts.select("userID"), "userID", "left_anti"))


_NEW_NAMES_SQL = _SIGN_UP_SQL + """,
named AS (
  SELECT c.c_custkey AS userID, coalesce(p.c_name, c.c_name) AS username
  FROM customer c LEFT JOIN customer p ON p.c_custkey = CASE WHEN c.c_custkey % 2 = 1 THEN c.c_custkey + 1 ELSE c.c_custkey - 1 END
  UNION ALL SELECT j.userID, j.username || ' ' || CAST(j.userID % 7 AS VARCHAR) FROM joined j ANTI JOIN accounts a USING (userID)),
prefixes AS (SELECT DISTINCT substr(lower(username), 1, CAST(n AS INTEGER)) AS prefix, userID
  FROM (SELECT username, userID, unnest(range(1, length(username) + 1)) AS n FROM named))
"""


def _kept_names(spark, sf) -> tuple[str, DataFrame]:
    """A stored name index after four batches, and the accounts then: all accounts;
    a batch of sign-ups; every two neighbouring customers swap names; who signed
    up takes a longer name."""
    b, path = Bindings(spark, sf), scratch_path(spark, "names")
    start = b.accounts.select("userID", "username")
    joined = _sign_up(b)[0].select("userID", "username")
    joined = joined.join(start.select("userID"), "userID", "left_anti").checkpoint(eager=True)
    k = F.col("userID")
    partner = start.select(F.when(k % 2 == 1, k + 1).otherwise(k - 1).alias("userID"), F.col("username").alias("other"))
    swapped = start.join(partner, "userID", "left").select("userID", F.coalesce("other", "username").alias("username"))
    longer = joined.select("userID", F.concat_ws(" ", "username", (k % 7).cast("string")).alias("username"))
    none = start.limit(0)
    batches = [(none, start, start), (none, joined, joined), (start, swapped, start), (joined, longer, joined)]
    for epoch, (before, after, users) in enumerate(batches):
        add_names(name_changes(before, after, users), path, epoch, fanout=2 if epoch < 3 else 4)
    return path, swapped.unionByName(longer)


@register("name_index_upkeep", _NEW_NAMES_SQL + "SELECT prefix, userID FROM prefixes")
def q_name_index_upkeep(spark, sf):
    return stored_names(spark, _kept_names(spark, sf)[0])


@register("user_search_upkeep", _NEW_NAMES_SQL.rstrip() + f""",
user_searches AS ({SQL_VIEWS["user_searches"]})
SELECT q.query_id, p.userID, a.username
FROM user_searches q JOIN prefixes p ON lower(q.query) = p.prefix JOIN named a ON a.userID = p.userID""")
def q_user_search_upkeep(spark, sf):
    path, accounts = _kept_names(spark, sf)
    return search_stored_users(Bindings(spark, sf).user_searches, path, accounts)


_FAN_SQL = with_views("posts") + """,
fan AS (SELECT userID AS owner, * FROM posts UNION ALL
        SELECT creatorID AS owner, * FROM posts WHERE creatorID <> userID)
"""
_POST_COLS = ["owner", "postID", "userID", "creatorID", "content", "ts"]


@register("fan_out_posts", _FAN_SQL + "SELECT owner, postID, userID, creatorID, content, ts FROM fan")
def q_fan_out_posts(spark, sf):
    return S.fan_out_posts(Bindings(spark, sf).posts).select(*_POST_COLS)


def _names(alias: str, prefix: str) -> str:
    return ", ".join(f"{alias}.{f} AS {prefix}{f}" for f in ("username", "firstName", "lastName"))


@register("wall_feed", with_views("accounts").rstrip() + _FAN_SQL.replace("WITH posts AS", ",\nposts AS", 1) + f"""
SELECT t.owner, t.postID, t.userID, t.creatorID, t.content, t.ts, {_names("o", "owner_")}, {_names("c", "creator_")}
FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY owner ORDER BY ts DESC, postID) AS rn FROM fan)
      WHERE rn <= 20) t
LEFT JOIN accounts o ON o.userID = t.userID LEFT JOIN accounts c ON c.userID = t.creatorID""")
def q_wall_feed(spark, sf):
    b = Bindings(spark, sf)
    return S.wall_feed(b.posts, b.accounts, k=20)


@register("home_feed", with_views("accounts", "friends", "posts") + f"""
SELECT t.viewer, t.postID, t.userID, t.creatorID, t.content, t.ts, {_names("c", "creator_")}
FROM (SELECT * FROM (SELECT f.followerID AS viewer, p.*,
        row_number() OVER (PARTITION BY f.followerID ORDER BY p.ts DESC, p.postID) AS rn
      FROM posts p JOIN friends f ON f.followedID = p.creatorID) WHERE rn <= 20) t
LEFT JOIN accounts c ON c.userID = t.creatorID""")
def q_home_feed(spark, sf):
    b = Bindings(spark, sf)
    return S.home_feed(b.posts, b.friends, b.accounts, k=20).select(
        "viewer", "postID", "userID", "creatorID", "content", "ts",
        "creator_username", "creator_firstName", "creator_lastName")


@register("comment_threads", with_views("accounts", "comments") + f"""
SELECT m.postID, m.commentID, m.creatorID, m.content, m.ts, {_names("a", "author_")}
FROM comments m LEFT JOIN accounts a ON a.userID = m.creatorID""")
def q_comment_threads(spark, sf):
    b = Bindings(spark, sf)
    return S.comment_threads(b.comments, b.accounts)


@register("comment_thread_positions", with_views("comments") + """
SELECT postID, commentID, row_number() OVER (PARTITION BY postID ORDER BY ts DESC, commentID) AS pos FROM comments""")
def q_comment_thread_positions(spark, sf):
    b = Bindings(spark, sf)
    return S.comment_threads(b.comments, b.accounts, positions=True).select("postID", "commentID", "pos")


_LIKES_SQL = with_views("like_log") + """,
cur AS (SELECT postID, userID, ts FROM (SELECT *, row_number() OVER (PARTITION BY postID, userID ORDER BY seq DESC) AS rn
        FROM like_log) WHERE rn = 1 AND op <> 'delete')
"""


@register("current_likes", _LIKES_SQL + "SELECT postID, userID, ts FROM cur")
def q_current_likes(spark, sf):
    return S.apply_changes(Bindings(spark, sf).like_log, ["postID", "userID"], "seq")


@register("like_summary", _LIKES_SQL + """,
views AS (SELECT DISTINCT userID AS viewerID, postID FROM like_log),
cnt AS (SELECT postID, count(DISTINCT userID) AS n FROM cur GROUP BY postID)
SELECT v.viewerID, v.postID, CAST(coalesce(cnt.n, 0) AS BIGINT) AS n_likes,
  EXISTS (SELECT 1 FROM cur c WHERE c.postID = v.postID AND c.userID = v.viewerID) AS liked
FROM views v LEFT JOIN cnt USING (postID)""")
def q_like_summary(spark, sf):
    b = Bindings(spark, sf)
    cur = S.apply_changes(b.like_log, ["postID", "userID"], "seq")
    views = b.like_log.select(F.col("userID").alias("viewerID"), "postID").distinct()
    return S.like_summary(cur, views)


@register("friend_requests", with_views("friends", "notifications") + """
SELECT n.*, CASE WHEN EXISTS (SELECT 1 FROM friends f WHERE f.followerID = n.senderID AND f.followedID = n.recipientID)
  THEN 'already_friends'
  WHEN n.seq <> (SELECT min(m.seq) FROM notifications m WHERE m.recipientID = n.recipientID AND m.senderID = n.senderID)
  THEN 'pending' ELSE 'sent' END AS status
FROM notifications n""")
def q_friend_requests(spark, sf):
    b = Bindings(spark, sf)
    return S.friend_requests(b.notifications, b.friends)


@register("accept_requests", with_views("friends", "notifications") + """
SELECT followerID, followedID FROM friends UNION
SELECT recipientID, senderID FROM notifications UNION
SELECT senderID, recipientID FROM notifications""")
def q_accept_requests(spark, sf):
    b = Bindings(spark, sf)
    return S.accept_requests(b.notifications, b.notifications, b.friends)[0].select("followerID", "followedID")


_HISTORY_SQL = with_views("friends", "old_friends", "request_log", "pending_before", "accepts") + """,
req AS (SELECT * FROM request_log WHERE notificationType = 'friendRequest'),
status AS (SELECT r.*, CASE
    WHEN EXISTS (SELECT 1 FROM old_friends f WHERE f.followerID = r.recipientID AND f.followedID = r.senderID) THEN 'already_friends'
    WHEN EXISTS (SELECT 1 FROM accepts a WHERE a.seq < r.seq AND ((a.recipientID = r.recipientID AND a.senderID = r.senderID)
                 OR (a.recipientID = r.senderID AND a.senderID = r.recipientID))) THEN 'already_friends'
    WHEN EXISTS (SELECT 1 FROM pending_before p WHERE p.notificationType = 'friendRequest' AND p.recipientID = r.recipientID
                 AND p.senderID = r.senderID) THEN 'pending'
    WHEN EXISTS (SELECT 1 FROM req q WHERE q.seq < r.seq AND q.recipientID = r.recipientID AND q.senderID = r.senderID) THEN 'pending'
    ELSE 'sent' END AS status FROM req r)
"""


@register("friend_request_history", _HISTORY_SQL + "SELECT * FROM status")
def q_friend_request_history(spark, sf):
    b = Bindings(spark, sf)
    return S.friend_requests(b.request_log, b.old_friends, b.pending_before, b.accepts)


@register("accept_requests_pending", _HISTORY_SQL + """,
waiting AS (SELECT recipientID, senderID, ts, CAST(NULL AS BIGINT) AS seq FROM pending_before WHERE notificationType = 'friendRequest'
            UNION ALL SELECT recipientID, senderID, ts, seq FROM status WHERE status = 'sent')
SELECT * FROM waiting w WHERE NOT EXISTS (SELECT 1 FROM accepts a WHERE a.recipientID = w.recipientID AND a.senderID = w.senderID
    AND a.requestTs = w.ts AND (w.seq IS NULL OR a.seq > w.seq))""")
def q_accept_requests_pending(spark, sf):
    b = Bindings(spark, sf)
    return S.pending_requests(b.request_log, b.accepts, b.old_friends, b.pending_before)


@register("accept_requests_times", _HISTORY_SQL + """,
made AS (SELECT recipientID AS followerID, senderID AS followedID, ts, seq FROM accepts
         UNION ALL SELECT senderID, recipientID, ts, seq FROM accepts
         UNION ALL SELECT followerID, followedID, ts, -1 FROM old_friends)
SELECT followerID, followedID, arg_max(ts, seq) AS ts FROM made GROUP BY ALL""")
def q_accept_requests_times(spark, sf):
    b = Bindings(spark, sf)
    return S.accept_requests(b.accepts, b.pending_before, b.old_friends)[0]


@register("notification_feed", with_views("accounts", "notifications") + """
SELECT n.*, a.username AS sender_username FROM notifications n LEFT JOIN accounts a ON a.userID = n.senderID""")
def q_notification_feed(spark, sf):
    b = Bindings(spark, sf)
    return S.notification_feed(b.notifications, b.accounts)


@register("notification_positions", with_views("accounts", "notifications") + """
SELECT n.*, a.username AS sender_username, row_number() OVER (
    PARTITION BY n.recipientID ORDER BY n.ts DESC, n.senderID, n.seq) AS pos
FROM notifications n LEFT JOIN accounts a ON a.userID = n.senderID""")
def q_notification_positions(spark, sf):
    b = Bindings(spark, sf)
    return S.notification_feed(b.notifications, b.accounts, positions=True)


@register("wall_positions", _FAN_SQL + """
SELECT owner, postID, pos FROM (
  SELECT owner, postID, row_number() OVER (PARTITION BY owner ORDER BY ts DESC, postID) AS pos FROM fan) WHERE pos <= 20""")
def q_wall_positions(spark, sf):
    b = Bindings(spark, sf)
    return S.wall_feed(b.posts, b.accounts, k=20, positions=True).select("owner", "postID", "pos")


@register("home_positions", with_views("friends", "posts") + """
SELECT viewer, postID, pos FROM (SELECT f.followerID AS viewer, p.postID,
    row_number() OVER (PARTITION BY f.followerID ORDER BY p.ts DESC, p.postID) AS pos
  FROM posts p JOIN friends f ON f.followedID = p.creatorID) WHERE pos <= 20""")
def q_home_positions(spark, sf):
    b = Bindings(spark, sf)
    return S.home_feed(b.posts, b.friends, b.accounts, k=20, positions=True).select("viewer", "postID", "pos")


_ROSTER_SQL = with_views("accounts", "memberships") + """,
roster AS (SELECT m.chatID, m.userID, a.firstName || ' ' || a.lastName AS label
           FROM memberships m LEFT JOIN accounts a USING (userID))
"""


@register("chat_roster", _ROSTER_SQL + "SELECT chatID, userID, label FROM roster")
def q_chat_roster(spark, sf):
    b = Bindings(spark, sf)
    return S.chat_roster(b.memberships, b.accounts)


@register("chat_directory", _ROSTER_SQL + """
SELECT r.userID, r.chatID, s.n AS n_members, 'you' AS self_label
FROM roster r JOIN (SELECT chatID, count(*) AS n FROM roster GROUP BY chatID) s USING (chatID)""")
def q_chat_directory(spark, sf):
    b = Bindings(spark, sf)
    return S.chat_directory(b.memberships, b.accounts)


@register("chat_transcripts", with_views("messages") + """
SELECT g.chatID, g.message_id, g.userID, g.message, g.ts,
  CASE WHEN CAST(g.ts AS DATE) = (SELECT CAST(max(ts) AS DATE) FROM events)
       THEN 'Today at ' || strftime(g.ts, '%-I:%M %p') ELSE strftime(g.ts, '%-m/%-d/%Y') END AS time_label
FROM messages g""")
def q_chat_transcripts(spark, sf):
    b = Bindings(spark, sf)
    as_of = b.table("events").agg(F.to_date(F.max("ts"))).scalar()
    return S.chat_transcripts(b.messages, as_of, "UTC")


@register("chat_transcript_positions", with_views("messages") + """
SELECT chatID, message_id, row_number() OVER (PARTITION BY chatID ORDER BY ts, message_id) AS pos FROM messages""")
def q_chat_transcript_positions(spark, sf):
    return S.chat_transcripts(Bindings(spark, sf).messages, positions=True).select("chatID", "message_id", "pos")


@register("may_open_chats", with_views("memberships", "messages") + """
SELECT DISTINCT g.userID AS viewer, g.chatID FROM messages g
WHERE EXISTS (SELECT 1 FROM memberships m WHERE m.chatID = g.chatID AND m.userID = g.userID)""")
def q_may_open_chats(spark, sf):
    b = Bindings(spark, sf)
    return S.may_open_chats(b.messages.withColumnRenamed("userID", "viewer"), b.memberships)


@register("chat_transcripts_text", with_views("messages_text") +
          "SELECT chatID, message_id, author, message FROM messages_text")
def q_chat_transcripts_text(spark, sf):
    return S.chat_transcripts(Bindings(spark, sf).messages_text, order=("chatID", "message_id"))


@register("create_chat_rows", """
SELECT event_id AS chatID, user_id AS userID, event_id AS seq, 'put' AS op FROM events WHERE event_type = 'purchase'
UNION ALL
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT), event_id, 'put' FROM events
WHERE event_type = 'purchase'""")
def q_create_chat_rows(spark, sf):
    e = Bindings(spark, sf)._events_k().where(F.col("event_type") == "purchase")
    new = e.select(F.col("event_id").alias("chatID"), F.col("user_id").alias("creatorID"),
                   F.col("k").alias("inviteeID"), F.col("event_id").alias("seq"))
    return S.create_chat_rows(new)


_NEW_CHATS_SQL = with_views("accounts") + """,
made AS (SELECT event_id AS chatID, user_id AS userID FROM events WHERE event_type = 'purchase'
  UNION SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) FROM events WHERE event_type = 'purchase')
"""


def _new_chats(b: Bindings):
    e = b._events_k().where(F.col("event_type") == "purchase")
    return S.open_chats(e.select(F.col("event_id").alias("chatID"), F.col("user_id").alias("creatorID"),
                                 F.col("k").alias("inviteeID"), F.col("event_id").alias("seq")), b.accounts)


@register("new_chat_rooms", _NEW_CHATS_SQL + "SELECT userID, chatID FROM made")
def q_new_chat_rooms(spark, sf):
    return _new_chats(Bindings(spark, sf))[0]


@register("new_chat_members", _NEW_CHATS_SQL + """
SELECT m.chatID, m.userID, a.firstName, a.lastName FROM made m LEFT JOIN accounts a USING (userID)""")
def q_new_chat_members(spark, sf):
    return _new_chats(Bindings(spark, sf))[1]


# ---------------------------------------------------------- sources / sinks
# Round trips through the text formats the reference reads: data Spark
# derives from the given tables is written, then read back by the reader.

@register("read_edge_list", with_views("edges") + "SELECT src, dst FROM edges")
def q_read_edge_list(spark, sf):
    path = scratch_path(spark, "edge-list")
    write_edge_list(Bindings(spark, sf).edges, path)
    return read_edge_list(spark, path)


@register("read_news", with_views("news") +
          "SELECT DISTINCT authors, category, date, headline, link, short_description FROM news")
def q_read_news(spark, sf):
    path = scratch_path(spark, "news-json")
    write_news_json(Bindings(spark, sf).news, path)
    return read_news(spark, path)


@register("top_report", rank_sql.top_sql(RANK_ROUNDS, TOP_K, True))
def q_top_report(spark, sf):
    path = scratch_path(spark, "top-report")
    write_report(q_top_ranked(spark, sf), path)
    return spark.read.schema("node bigint, rank double").json(path)


@register("top_report_line", rank_sql.rank_cte(RANK_ROUNDS, True) + f"""
SELECT 'top {TOP_K} nodes: [' || string_agg('(' || CAST(node AS VARCHAR) || ', ' || CAST(r AS VARCHAR) || ')',
    ', ' ORDER BY r DESC, node) || ']' AS line
FROM (SELECT node, round(rank, 6) AS r FROM r{RANK_ROUNDS} ORDER BY {rank_sql.BY_RANK} LIMIT {TOP_K})""")
def q_top_report_line(spark, sf):
    return G.top_report_line(q_top_ranked(spark, sf), TOP_K)


def _account_changes(b: Bindings) -> DataFrame:
    """Profile edits from the tables: every customer types their nation as
    affiliation (other fields blank); every supplier's account tries to take
    the next customer's name (already taken), and later edits its first name
    alone, which must keep the affiliation typed before."""
    c, n = b.table("customer"), b.table("nation")
    aff = c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("userID"), F.lit("").alias("username"), F.lit("").alias("firstName"),
        F.col("n_name").alias("affiliation"), F.col("c_custkey").alias("seq"))
    s = b.table("supplier")
    ren = s.join(c, c.c_custkey == s.s_suppkey + 1).select(
        F.col("s_suppkey").alias("userID"), F.col("c_name").alias("username"), F.lit("").alias("firstName"),
        F.lit(None).cast("string").alias("affiliation"), (F.col("s_suppkey") + 1000000000).alias("seq"))
    first = s.select(F.col("s_suppkey").alias("userID"), F.lit("").alias("username"), F.col("s_name").alias("firstName"),
                     F.lit("").alias("affiliation"), (F.col("s_suppkey") + 2000000000).alias("seq"))
    return aff.unionByName(ren).unionByName(first)


_UPDATE_SQL = with_views("accounts") + """,
changes AS (
  SELECT c.c_custkey AS userID, '' AS username, '' AS firstName, n.n_name AS affiliation, c.c_custkey AS seq
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  UNION ALL
  SELECT s.s_suppkey, c.c_name, '', CAST(NULL AS VARCHAR), s.s_suppkey + 1000000000
    FROM supplier s JOIN customer c ON c.c_custkey = s.s_suppkey + 1
  UNION ALL
  SELECT s_suppkey, '', s_name, '', s_suppkey + 2000000000 FROM supplier),
ch AS (SELECT x.userID, x.seq, nullif(x.affiliation, '') AS typed_aff, nullif(x.username, '') AS typed_name,
         nullif(x.firstName, '') AS typed_first, a.username AS old_username,
         coalesce(nullif(x.username, ''), a.username) AS new_username,
         coalesce(nullif(x.affiliation, ''), a.affiliation) AS new_aff
       FROM changes x JOIN accounts a USING (userID)),
firsts AS (SELECT new_username, min(seq) AS f FROM ch WHERE new_username <> old_username GROUP BY new_username),
st AS (SELECT ch.*, CASE WHEN new_username <> old_username AND (
          EXISTS (SELECT 1 FROM accounts o WHERE o.username = ch.new_username AND o.userID <> ch.userID)
          OR seq <> (SELECT f FROM firsts WHERE firsts.new_username = ch.new_username))
        THEN 'username_taken' ELSE 'updated' END AS status FROM ch)
"""


@register("update_status", _UPDATE_SQL + "SELECT userID, seq, status FROM st")
def q_update_status(spark, sf):
    b = Bindings(spark, sf)
    return S.update_accounts(_account_changes(b), b.accounts)[1]


@register("update_accounts", _UPDATE_SQL + """,
last AS (SELECT userID, arg_max(typed_name, seq) FILTER (typed_name IS NOT NULL) AS u,
           arg_max(typed_first, seq) FILTER (typed_first IS NOT NULL) AS n,
           arg_max(typed_aff, seq) FILTER (typed_aff IS NOT NULL) AS f
         FROM st WHERE status = 'updated' GROUP BY userID)
SELECT a.userID, coalesce(last.u, a.username) AS username, coalesce(last.n, a.firstName) AS firstName, a.lastName,
       coalesce(last.f, a.affiliation) AS affiliation
FROM accounts a LEFT JOIN last USING (userID)""")
def q_update_accounts(spark, sf):
    b = Bindings(spark, sf)
    return S.update_accounts(_account_changes(b), b.accounts)[0]


@register("status_posts", _UPDATE_SQL + """
SELECT userID, userID AS creatorID, seq AS postID,
  old_username || ' has updated their affiliation to: ' || new_aff AS content
FROM st WHERE status = 'updated' AND typed_aff IS NOT NULL""")
def q_status_posts(spark, sf):
    b = Bindings(spark, sf)
    return S.update_accounts(_account_changes(b), b.accounts)[2]


# -------------------------------------------------------------- streaming
# Each runs a Structured Streaming query over the table files (availableNow)
# and returns what its sink holds; the SQL is the batch result it must equal.

@register("stream_message_log", with_views("accounts", "messages") + """
SELECT m.chatID, m.message_id, m.userID, m.message, m.ts, a.firstName, a.lastName
FROM messages m LEFT JOIN accounts a USING (userID) WHERE coalesce(trim(m.message), '') <> ''""")
def q_stream_message_log(spark, sf):
    b = Bindings(spark, sf)
    return X.run_message_log(spark, sf, b.accounts).select(
        "chatID", "message_id", "userID", "message", "ts", "firstName", "lastName")


@register("stream_like_state", _LIKES_SQL + "SELECT postID, userID, ts FROM cur")
def q_stream_like_state(spark, sf):
    files = X.out_of_order_files(spark, sf, "events", "ts")
    return X.run_like_state(spark, files, max_files=1).select("postID", "userID", "ts")


@register("stream_like_counts", _LIKES_SQL + "SELECT postID, count(*) AS n_likes FROM cur GROUP BY postID")
def q_stream_like_counts(spark, sf):
    files = X.out_of_order_files(spark, sf, "events", "ts")
    return X.run_like_counts(spark, files, max_files=1, fanout=2)


@register("stream_friend_requests", with_views("notifications") +
          "SELECT DISTINCT recipientID, senderID FROM notifications")
def q_stream_friend_requests(spark, sf):
    files = X.out_of_order_files(spark, sf, "events", "ts")
    return X.run_friend_requests(spark, files, max_files=1).select("recipientID", "senderID")


@register("stream_pending_requests", _HISTORY_SQL + "SELECT recipientID, senderID, ts, seq FROM status WHERE status = 'sent'")
def q_stream_pending_requests(spark, sf):
    files = X.out_of_order_files(spark, sf, "events", "ts")
    sent = X.run_pending_requests(spark, files, Bindings(spark, sf), max_files=1)[0]
    return sent.select("recipientID", "senderID", F.col("ts").cast("timestamp_ntz").alias("ts"), "seq")


@register("stream_keyword_index", _STEMMED_SQL + "\nSELECT keyword, headline, url FROM idx")
def q_stream_keyword_index(spark, sf):
    files = X.out_of_order_files(spark, sf, "documents", "doc_id")
    return X.run_keyword_index(spark, files, max_files=1).select("keyword", "headline", "url")


# ------------------------------------------------------------ public API

def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v.fn for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v.sql for k, v in REGISTRY.items() if v.sql is not None}
