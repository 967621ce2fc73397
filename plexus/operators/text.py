"""News keyword index and search, and the user-name prefix index.

Tokens: maximal runs of letters; a token is kept when it is ASCII letters
only and not a stop word.  The stop-word test runs *before* lowercasing (so
"The" is kept as "the"), as in the reference; ``case_sensitive_stopwords=False``
tests the lowercased token instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plexus.functions.porter import stem_column
from plexus.operators.common import spread, stored
from plexus.session import ensure_checkpoint_dir

# ---- fixed values: the reference's stop words and fields ----------------
STOPWORDS = ("a", "all", "any", "but", "the")
NEWS_TEXT_FIELDS = ("headline", "authors", "short_description")
# --------------------------------------------------------------------------

LETTER_RUN = r"(\p{L}+)"
ASCII_RUN = r"([a-zA-Z]++)(?!\p{L})|\p{L}+"  # the same runs; group 1 only if all letters are ASCII
ASCII_WORD = r"^[a-zA-Z]+$"
SEARCH_CAP = 15


def token_array(col: Column, stopwords=STOPWORDS, case_sensitive_stopwords: bool = True) -> Column:
    """T3 for one text column: ARRAY of lowercased kept tokens, in order."""
    runs = F.regexp_extract_all(F.coalesce(col, F.lit("")), F.lit(LETTER_RUN), 1)
    stop = F.array(*[F.lit(s) for s in stopwords])

    def keep(x):
        probe = x if case_sensitive_stopwords else F.lower(x)
        return x.rlike(ASCII_WORD) & ~F.array_contains(stop, probe)

    return F.transform(F.filter(runs, keep), F.lower)


def tokenize(df: DataFrame, cols=NEWS_TEXT_FIELDS, stopwords=STOPWORDS,
             case_sensitive_stopwords: bool = True, out: str = "tokens") -> DataFrame:
    """Add ``out`` = distinct tokens of ``cols`` in first-seen order."""
    arrays = [token_array(F.col(c), stopwords, case_sensitive_stopwords) for c in cols]
    return df.withColumn(out, F.array_distinct(F.concat(*arrays)))


def stem_vocabulary(words: DataFrame, word_col: str = "token") -> DataFrame:
    """(_w, _stem) for the distinct words, written to the checkpoint folder.

    The stem chain is a stack of wide CASE projections; materializing the
    small word -> stem table keeps the optimizer from propagating
    constraints through it into the plans that join it back."""
    ensure_checkpoint_dir(words.sparkSession)
    vocab = words.select(F.col(word_col).alias("_w")).distinct()
    return stem_column(vocab, "_w", "_stem").checkpoint(eager=True)


def stem_words(words: DataFrame, word_col: str = "token", out_col: str = "keyword") -> DataFrame:
    """T4: stem a column of words: the distinct vocabulary is stemmed once
    (JVM expressions) and joined back; adaptive execution picks the join from
    the sizes it measures.  ``words`` is read twice (vocabulary, join back), so
    it is checkpointed once first rather than computed twice."""
    ensure_checkpoint_dir(words.sparkSession)
    words = words.checkpoint(eager=True)
    stems = stem_vocabulary(words, word_col)
    return words.join(stems, words[word_col] == stems["_w"]).drop("_w").withColumnRenamed("_stem", out_col)


def stem_tokens(df: DataFrame, key: str = "headline", tokens_col: str = "tokens",
                out: str = "stems") -> DataFrame:
    """T4 array form: add ``out`` = the Porter stems of ``tokens_col``,
    duplicates removed keeping first occurrence.  Stems come from the
    distinct-vocabulary join; each article's array is rebuilt in position
    order (bounded by the article, which is already one row).  ``key``
    must identify a row."""
    pos = df.select(key, F.posexplode(tokens_col).alias("pos", "token"))
    stemmed = stem_words(pos)
    arrays = (stemmed.groupBy(key)
              .agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("pos", "keyword"))),
                                                lambda x: x["keyword"])).alias(out)))
    return (df.join(arrays, key, "left")
            .withColumn(out, F.coalesce(F.col(out), F.array().cast("array<string>"))))


COMMON_WORDS, COMMON_FROM = 50_000, 50  # words stemmed beforehand, looked for in one article of so many


def _token_rows(articles: DataFrame, cols, stopwords, case_sensitive_stopwords: bool) -> DataFrame:
    """(headline, link, token): same tokens as ``tokenize``, with repeats where
    words of an article differ in case.

    An article's different letter runs are exploded first, so the stop-word
    test and lowercasing run as plain (code-generated) column expressions
    instead of per-element lambdas.  Fields are joined by a space, which no
    letter run crosses."""
    probe = F.col("t") if case_sensitive_stopwords else F.lower("t")
    text = F.concat_ws(" ", *[F.coalesce(F.col(f"_f{i}"), F.lit("")) for i in range(len(cols))])
    runs = F.array_distinct(F.regexp_extract_all(text, F.lit(ASCII_RUN), 1))  # '' for runs with other letters
    rows = articles.select("headline", "link", F.explode(runs).alias("t"))
    return rows.where((F.col("t") != "") & ~probe.isin(*stopwords)).select("headline", "link", F.lower("t").alias("token"))


def _common_stems(some: DataFrame) -> DataFrame:
    """(token, _known): the stems of the most frequent words of ``some`` rows, at
    most ``COMMON_WORDS``."""
    ensure_checkpoint_dir(some.sparkSession)
    common = some.groupBy("token").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "token").limit(COMMON_WORDS)
    return stem_column(common.select("token"), "token", "_known").checkpoint(eager=True)


def _stem_in_place(rows: DataFrame, common: DataFrame) -> DataFrame:
    """Replace column ``token`` by its stem ``keyword``, without a shuffle and in
    one pass.

    ``common`` words are broadcast with their stems; any other word is stemmed
    where it stands.  So the choice of ``common`` bears on speed only, and a
    vocabulary that grows with the articles is neither shuffled nor gathered."""
    kept = [c for c in rows.columns if c != "token"]
    rare = F.when(F.col("_known").isNull(), F.col("token")).alias("_rare")  # null, and cheap to stem, for common words
    rows = stem_column(rows.join(F.broadcast(common), "token", "left").select(*kept, "_known", rare), "_rare", "_stem")
    # What an explode gives is no function of the row to the optimizer, which else
    # copies the stem chain into filters and partition pruning of joins by keyword.
    return rows.select(*kept, F.explode(F.array(F.coalesce("_known", "_stem"))).alias("keyword"))


def _keyword_rows(news: DataFrame, stem: bool, cols, stopwords, case_sensitive_stopwords: bool):
    """A function of articles of ``news`` that gives (headline, link, keyword),
    with repeats where words of an article differ in case or share a stem."""
    def taken(articles: DataFrame) -> DataFrame:
        return articles.select("headline", "link", *[F.col(c).alias(f"_f{i}") for i, c in enumerate(cols)])

    def tokens(articles: DataFrame) -> DataFrame:
        return _token_rows(articles, cols, stopwords, case_sensitive_stopwords)

    if not stem:
        return lambda articles, deal=spread: tokens(deal(taken(articles))).withColumnRenamed("token", "keyword")
    some = taken(news).where(F.pmod(F.xxhash64("headline", "link"), F.lit(COMMON_FROM)) == 0)
    common = _common_stems(tokens(some))
    return lambda articles, deal=spread: _stem_in_place(tokens(deal(taken(articles))), common)


def document_tokens(news: DataFrame, stem: bool = True, cols=NEWS_TEXT_FIELDS, stopwords=STOPWORDS,
                    case_sensitive_stopwords: bool = True) -> DataFrame:
    """(headline, link, keyword): one row per distinct keyword of an article."""
    return _keyword_rows(news, stem, cols, stopwords, case_sensitive_stopwords)(news).distinct()


REPEATED = 200_000  # more repeated headlines than this are not told apart from others


def _split_repeated(headlines: DataFrame) -> tuple[int, DataFrame]:
    """The number of the ``headlines(_h)`` and the table itself, stored."""
    again = stored(headlines, "repeated_headlines")
    return again.count(), again


def build_keyword_index(news: DataFrame, stem: bool = True, cols=NEWS_TEXT_FIELDS, stopwords=STOPWORDS,
                        case_sensitive_stopwords: bool = True) -> DataFrame:
    """T5: (keyword, headline, url), one row per (keyword, headline); every
    keyword is indexed (no batch-size loss).  Of several articles with that
    headline and keyword the greatest link is kept, so the result doesn't
    depend on the order in which articles come.

    An article whose headline no other has is dealt as one row, by headline, and
    its keywords made distinct where they are.  The keywords of articles that
    share a headline are dealt one by one."""
    keywords = _keyword_rows(news, stem, cols, stopwords, case_sensitive_stopwords)

    def indexed(rows: DataFrame) -> DataFrame:
        return rows.select("keyword", "headline", F.col("link").alias("url"))

    n, again = _split_repeated(news.groupBy(F.col("headline").alias("_h")).agg(F.count("*").alias("_n")).where("_n > 1").select("_h"))
    if n > REPEATED:
        return merge_index(indexed(keywords(news)))
    same = F.col("headline").eqNullSafe(F.col("_h"))
    once = news.join(F.broadcast(again), same, "left_anti") if n else news
    index = indexed(keywords(once, lambda articles: articles.repartition("headline"))).distinct()
    if n:
        index = index.unionByName(merge_index(indexed(keywords(news.join(F.broadcast(again), same, "left_semi")))))
    return index


def merge_index(rows: DataFrame) -> DataFrame:
    """Index rows, also of several indexes, with one row per (keyword, headline).
    Few rows share a key, so they are dealt by it as they are and sorted once,
    not reduced before the shuffle, which sorts all of them twice."""
    dealt = rows.select("keyword", "headline", "url").repartition("keyword", "headline")
    return dealt.groupBy("keyword", "headline").agg(F.max("url").alias("url"))


def merge_indexes(rows: DataFrame, part: str) -> DataFrame:
    """``merge_index`` for rows of several indexes, each with one row per (keyword,
    headline), which the number in column ``part`` tells apart: rows of a headline
    that only one of them has are kept as they are, not dealt."""
    index = rows.select("keyword", "headline", "url")
    met = rows.groupBy(F.col("headline").alias("_h")).agg(F.min(part).alias("_a"), F.max(part).alias("_b"))
    n, again = _split_repeated(met.where("_a < _b").select("_h"))
    if n == 0:
        return index
    if n > REPEATED:
        return merge_index(index)
    same = F.col("headline").eqNullSafe(F.col("_h"))
    return index.join(F.broadcast(again), same, "left_anti").unionByName(
        merge_index(index.join(F.broadcast(again), same, "left_semi")))


def write_keyword_index(index: DataFrame, path: str, buckets: int | None = None) -> None:
    """T5 text-style sink: parquet partitioned by the keyword's first letter,
    sorted by keyword.  Rows are dealt to ``buckets`` tasks by ranges of
    (letter, keyword, headline), so one keyword's rows may fill many files.
    ``sources/keyword_index.py`` has the layout that searches read."""
    keys = ["k0", "keyword", "headline"]
    out = index.withColumn("k0", F.substring("keyword", 1, 1))
    out = out.repartitionByRange(buckets, *keys) if buckets else out.repartitionByRange(*keys)
    out.sortWithinPartitions(*keys).write.mode("overwrite").partitionBy("k0").parquet(path)


def news_table(news: DataFrame, order_col: str = "seq") -> DataFrame:
    """One row per (headline, date); a later put (higher ``order_col``)
    replaces an earlier one; rows without a headline are skipped.  A
    ``max_by`` aggregate, so a key written many times is reduced before
    the shuffle instead of being sorted in one task."""
    keys = ["headline", "date"]
    rest = [c for c in news.columns if c not in keys]
    last = (news.where(F.col("headline").isNotNull()).groupBy(*keys)
            .agg(F.max_by(F.struct(*rest), F.col(order_col)).alias("_l")))
    return last.select(*[F.col(c) if c in keys else F.col("_l." + c).alias(c) for c in news.columns])


def parse_queries(queries: DataFrame, stem: bool = True, letters_only: bool = False) -> DataFrame:
    """(query_id, pos, keyword): split on one space, lowercase, stem;
    duplicates after stemming keep their first position.  ``letters_only``
    applies the search box's letters-and-spaces check (rejecting the query)."""
    q = spread(queries)
    if letters_only:
        q = q.where(F.col("query").rlike("^[A-Za-z ]+$"))
    words = (q.select("query_id", F.posexplode(F.split(F.col("query"), " ")).alias("pos", "raw"))
             .where(F.col("raw") != "")
             .select("query_id", "pos", F.lower("raw").alias("token")))
    if stem:
        words = stem_words(words)
    else:
        words = words.withColumnRenamed("token", "keyword")
    return words.groupBy("query_id", "keyword").agg(F.min("pos").alias("pos"))


def posting_heads(index: DataFrame, cap: int = SEARCH_CAP) -> DataFrame:
    """(keyword, headline, url): the first ``cap`` entries (by headline,
    then url) of every keyword.

    Exact for capped OR-search: answers are ordered by (keyword position,
    headline, url), so entry number cap+1 of one keyword is never needed.
    ``row_number() <= cap`` is planned as a window group limit that ranks
    partially before the shuffle, so a keyword found in every article costs
    ``cap`` rows per map task rather than one huge group."""
    w = Window.partitionBy("keyword").orderBy("headline", "url")
    return (index.select("keyword", "headline", "url")
            .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= cap).drop("_rn"))


def merged_heads(rows: DataFrame, cap: int = SEARCH_CAP) -> DataFrame:
    """``posting_heads`` of ``merge_index(rows)``: rows of the first ``cap``
    headlines of every keyword are found as there, partially before the shuffle,
    and only those are merged."""
    w = Window.partitionBy("keyword").orderBy("headline")
    first = (rows.select("keyword", "headline", "url")
             .withColumn("_rn", F.dense_rank().over(w)).where(F.col("_rn") <= cap).drop("_rn"))
    return first.groupBy("keyword", "headline").agg(F.max("url").alias("url"))


ASKED = 500_000  # keywords that go to every task, to leave out the rows of others before they are sorted


def asked_heads(kw: DataFrame, index: DataFrame, cap: int = SEARCH_CAP, merged: bool = True) -> DataFrame:
    """``posting_heads`` of the keywords in ``kw``, or ``merged_heads`` if ``index``
    holds rows of several writes."""
    heads = posting_heads if merged else merged_heads
    asked = stored(kw.select("keyword").distinct(), "asked_keywords")
    if asked.count() <= ASKED:
        return heads(index.join(F.broadcast(asked), "keyword", "left_semi"), cap)
    return heads(index, cap).join(asked, "keyword", "left_semi")


def leading_keywords(kw: DataFrame, heads: DataFrame, cap: int = SEARCH_CAP) -> DataFrame:
    """The rows of ``kw(query_id, pos, keyword)`` that bear on the first ``cap``
    answers: those that any article has, up to the query's first keyword with
    ``cap`` different headlines.  Every headline that only a later keyword finds
    comes after that one's, so this leaves no answer out."""
    sizes = heads.groupBy("keyword").agg(F.count_distinct("headline").alias("_n"))
    found = kw.join(sizes, "keyword")
    full = found.where(F.col("_n") >= cap).groupBy(F.col("query_id").alias("_q")).agg(F.min("pos").alias("_last"))
    rows = found.join(full, F.col("query_id").eqNullSafe(F.col("_q")), "left")
    return rows.where(F.col("_last").isNull() | (F.col("pos") <= F.col("_last"))).select(*kw.columns)


def search_news(queries: DataFrame, index: DataFrame, news: DataFrame | None = None,
                cap: int = SEARCH_CAP, stem: bool = True, parsed: bool = False) -> DataFrame:
    """Answer many searches in one plan.

    ``index`` is a (keyword, headline, url) table (T5).  Keywords are OR-ed;
    a headline's position and link are those of its earliest keyword; at most
    ``cap`` different headlines per query, ordered by (position, headline).
    Returns (query_id, rank, headline, url) plus article fields when ``news``
    is given (one row per article with this headline and link).

    ``parsed`` says that ``queries`` are ``parse_queries`` rows, which are read
    several times.  The heads of the keywords asked for are stored once and of
    each query only the keywords joined that its answers can come from.
    """
    ensure_checkpoint_dir(queries.sparkSession)
    kw = queries if parsed else parse_queries(queries, stem=stem).checkpoint(eager=True)
    heads = stored(asked_heads(kw, index, cap), "posting_heads")
    hits = leading_keywords(kw, heads, cap).join(heads, "keyword")
    first = hits.groupBy("query_id", "headline").agg(F.min(F.struct("pos", "url")).alias("f")).select("query_id", "headline", "f.*")
    w = Window.partitionBy("query_id").orderBy("pos", "headline")
    out = (first.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= cap)
           .select("query_id", F.col("rank").cast("int").alias("rank"), "headline", "url"))
    if news is not None:
        art = news.select("headline", F.col("link").alias("url"), "category", "authors", "date", "short_description")
        out = out.join(art, ["headline", "url"], "left")
    return out


# --------------------------------------------------------------- users


def name_prefixes(accounts: DataFrame, name_col: str = "username") -> DataFrame:
    """(prefix, userID): every lowercased prefix of length 1..n of a name."""
    name = F.lower(F.col(name_col))
    return (accounts.where(F.length(name) > 0)
            .select("userID", F.explode(F.sequence(F.lit(1), F.length(name))).alias("_n"), name.alias("_name"))
            .select(F.expr("substring(_name, 1, _n)").alias("prefix"), "userID"))


def fresh_prefixes(names: DataFrame, *others: str) -> DataFrame:
    """(userID, prefix) of every row's ``_name`` but those that one of the names
    in columns ``others`` has too."""
    n = F.col("_n")
    rows = names.where(F.length("_name") > 0).withColumn("_n", F.explode(F.sequence(F.lit(1), F.length("_name"))))
    rows = rows.withColumn("prefix", F.substring(F.col("_name"), F.lit(1), n))
    for o in others:
        rows = rows.where(F.col(o).isNull() | (F.substring(F.col(o), F.lit(1), n) != F.col("prefix")))
    return rows


def build_prefix_index(accounts: DataFrame, name_col: str = "username") -> DataFrame:
    """The prefix index as (prefix, userID) rows, distinct.

    Kept long, not as one set per prefix: the one-letter prefixes hold most
    users, and a set per prefix would gather them into one row.  Names are made
    distinct, not their many prefixes: of a user's names in order, one adds the
    prefixes that the name before it doesn't have."""
    names = accounts.select("userID", F.lower(F.col(name_col)).alias("_name")).repartition("userID").distinct()
    before = F.lag("_name").over(Window.partitionBy("userID").orderBy("_name"))
    return fresh_prefixes(names.withColumn("_before", before), "_before").select("prefix", "userID")


def prefix_sizes(prefix_index: DataFrame) -> DataFrame:
    """(prefix, n_users): size of each prefix's user set."""
    return prefix_index.groupBy("prefix").agg(F.count("*").alias("n_users"))


def search_users(searches: DataFrame, prefix_index: DataFrame, accounts: DataFrame) -> DataFrame:
    """(query_id, userID, username) for every user whose name starts
    with the query (both sides lowercased)."""
    q = searches.select("query_id", F.lower(F.col("query")).alias("prefix"))
    hits = q.join(prefix_index, "prefix")
    return hits.join(accounts.select("userID", "username"), "userID").select("query_id", "userID", "username")
