"""Tokenizer, Porter stemmer, keyword index and capped search."""

from pyspark.sql import functions as F

from plexus.functions.porter import stem_column
from plexus.operators import text as T
from plexus.sources.bindings import Bindings
from tests.conftest import SF_SMALL

# Examples from Porter's paper (1980) and the usual variant (bli -> ble, logi -> log).
PORTER = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat",
    "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor",
    "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
    "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail",
    "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit",
    "rational": "ration", "valenci": "valenc", "digitizer": "digit", "conformabli": "conform",
    "radicalli": "radic", "differentli": "differ", "vileli": "vile", "analogousli": "analog",
    "vietnamization": "vietnam", "predication": "predic", "operator": "oper", "feudalism": "feudal",
    "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous", "formaliti": "formal",
    "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form",
    "formalize": "formal", "electriciti": "electr", "electrical": "electr", "hopeful": "hope",
    "goodness": "good", "revival": "reviv", "allowance": "allow", "inference": "infer",
    "airliner": "airlin", "gyroscopic": "gyroscop", "adjustable": "adjust", "defensible": "defens",
    "irritant": "irrit", "replacement": "replac", "adjustment": "adjust", "dependent": "depend",
    "adoption": "adopt", "homologou": "homolog", "communism": "commun", "activate": "activ",
    "angulariti": "angular", "homologous": "homolog", "effective": "effect", "bowdlerize": "bowdler",
    "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
    "generalizations": "gener", "oscillators": "oscil", "archaeology": "archaeolog", "is": "is",
}


def test_porter_examples(spark):
    df = spark.createDataFrame([(w,) for w in PORTER], "word string")
    got = {r.word: r.stem for r in stem_column(df, "word").collect()}
    assert got == PORTER


def test_tokenizer_hand_input(spark):
    df = spark.createDataFrame(
        [("The Café cats Running running 2 all", "Ann O'Neil", "any But", "u")],
        "headline string, authors string, short_description string, link string")
    toks = T.tokenize(df).first().tokens
    assert toks == ["the", "cats", "running", "ann", "o", "neil", "but"]
    toks_ci = T.tokenize(df, case_sensitive_stopwords=False).first().tokens
    assert "the" not in toks_ci and "but" not in toks_ci


def test_index_is_distinct_and_stemmed(spark):
    news = Bindings(spark, SF_SMALL).news
    idx = T.build_keyword_index(news)
    assert idx.count() == idx.select("keyword", "headline").distinct().count()
    raw = T.build_keyword_index(news, stem=False)
    assert idx.select("keyword").distinct().count() < raw.select("keyword").distinct().count()


def _naive_search(queries, index, cap=15):
    kw = T.parse_queries(queries, stem=False)
    hits = kw.join(index, "keyword").groupBy("query_id", "headline").agg(F.min("pos").alias("pos"))
    rows = {}
    for r in hits.collect():
        rows.setdefault(r.query_id, []).append((r.pos, r.headline))
    return {q: [h for _, h in sorted(v)[:cap]] for q, v in rows.items()}


def test_capped_search_equals_brute_force(spark):
    b = Bindings(spark, SF_SMALL)
    index = T.build_keyword_index(b.news, stem=False)
    got = {}
    for r in T.search_news(b.search_queries, index, stem=False).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.headline))
    got = {q: [h for _, h in sorted(v)] for q, v in got.items()}
    assert got == _naive_search(b.search_queries, index) and got


def test_query_parsing(spark):
    q = spark.createDataFrame([("q", "Running runs  the RUN")], "query_id string, query string")
    kws = {r.keyword: r.pos for r in T.parse_queries(q).collect()}
    assert kws == {"run": 0, "the": 3}
    assert T.parse_queries(q, letters_only=True).count() == 2  # letters and spaces: kept
    q2 = spark.createDataFrame([("q", "run!")], "query_id string, query string")
    assert T.parse_queries(q2, letters_only=True).count() == 0


def test_prefix_index_and_user_search(spark):
    acc = spark.createDataFrame([(1, "Ann"), (2, "anna"), (3, "Bob")], "userID bigint, username string")
    idx = T.build_prefix_index(acc)
    sizes = {r.prefix: r.n_users for r in T.prefix_sizes(idx).collect()}
    assert sizes["a"] == 2 and sizes["ann"] == 2 and sizes["anna"] == 1 and sizes["b"] == 1
    s = spark.createDataFrame([(7, "ANN")], "query_id int, query string")
    assert sorted(r.userID for r in T.search_users(s, idx, acc).collect()) == [1, 2]


def test_news_table_later_put_wins(spark):
    news = spark.createDataFrame([("h", "d", 1, "old"), ("h", "d", 2, "new"), (None, "d", 3, "x")],
                                 "headline string, date string, seq int, short_description string")
    out = T.news_table(news).collect()
    assert [(r.headline, r.short_description) for r in out] == [("h", "new")]


def test_stemmer_matches_reference_on_whole_vocabulary(spark):
    """Every distinct index token and query word of the small tables, against
    a direct loop implementation of the published algorithm."""
    from tests.porter_ref import porter_ref

    b = Bindings(spark, SF_SMALL)
    toks = T.document_tokens(b.news, stem=False).select(F.col("keyword").alias("word"))
    qwords = b.search_queries.select(F.explode(F.split(F.lower("query"), " ")).alias("word")) \
        .where(F.col("word").rlike("^[a-z]+[^a-z]?$"))
    vocab = toks.unionByName(qwords).distinct()
    got = {r.word: r.stem for r in stem_column(vocab, "word").collect()}
    assert len(got) > 5000
    bad = {w: (s, porter_ref(w)) for w, s in got.items() if s != porter_ref(w)}
    assert not bad, list(bad.items())[:10]


def test_keyword_index_sink_round_trip(spark, tmp_path):
    b = Bindings(spark, SF_SMALL)
    idx = T.build_keyword_index(b.news, stem=False)
    T.write_keyword_index(idx, str(tmp_path / "idx"))
    back = spark.read.parquet(str(tmp_path / "idx"))
    one = back.where((F.col("k0") == "c") & (F.col("keyword") == "cat"))
    assert "PartitionFilters: [isnotnull(k0" in one._jdf.queryExecution().executedPlan().toString()
    assert back.drop("k0").exceptAll(idx).count() == 0 and idx.exceptAll(back.drop("k0")).count() == 0


def test_stem_tokens_keeps_first_occurrence_order(spark):
    df = spark.createDataFrame(
        [("1", "Running runs cats", "", "", "u"), ("2", "", "", "", "u")],
        "headline string, authors string, short_description string, category string, link string")
    out = {r.headline: r.stems for r in T.stem_tokens(T.tokenize(df)).collect()}
    assert out == {"1": ["run", "cat"], "2": []}  # digit-only headlines give no tokens


def test_search_with_article_fields_and_news_table_sink(spark, tmp_path):
    from plexus.sources.sinks import write_news_table

    b = Bindings(spark, SF_SMALL)
    index = T.build_keyword_index(b.news, stem=False)
    q = spark.createDataFrame([("q1", "the and")], "query_id string, query string")
    rows = T.search_news(q, index, news=b.news, stem=False).collect()
    assert 0 < len(rows) <= 15 and all(r.category is not None for r in rows)
    assert [r["rank"] for r in sorted(rows, key=lambda r: r["rank"])] == list(range(1, len(rows) + 1))
    table = T.news_table(b.news)
    write_news_table(table, str(tmp_path / "news"))
    assert spark.read.parquet(str(tmp_path / "news")).count() == table.count()


def test_one_headline_under_two_links_is_one_index_row_and_one_hit(spark):
    news = spark.createDataFrame(
        [("Cats run", "x", "cats", "c", "d1", "u1"), ("Cats run", "x", "dogs", "c", "d2", "u2"), ("Dogs", "x", "cats", "c", "d1", "u3")],
        "headline string, authors string, short_description string, category string, date string, link string")
    index = T.build_keyword_index(news, stem=False)
    rows = {(r.keyword, r.headline): r.url for r in index.collect()}
    assert len(rows) == index.count()
    assert rows["cats", "Cats run"] == "u2" and rows["dogs", "Cats run"] == "u2" and rows["cats", "Dogs"] == "u3"
    q = spark.createDataFrame([("q", "cats dogs")], "query_id string, query string")
    got = T.search_news(q, index, stem=False, news=news).orderBy("rank").collect()
    assert [(r["rank"], r.headline, r.url, r.date) for r in got] == [(1, "Cats run", "u2", "d2"), (2, "Dogs", "u3", "d1")]


def _shuffles(df):
    return df._jdf.queryExecution().sparkPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


def test_stems_come_without_a_shuffle_of_words(spark, monkeypatch):
    """Common words are stemmed by broadcast and rare ones in place, whichever are common."""
    b = Bindings(spark, SF_SMALL)
    index = T.build_keyword_index(b.news)
    assert _shuffles(index)[1].count("Exchange hashpartitioning(") == 1
    want = set(map(tuple, index.collect()))
    for words, part in ((5, 1), (50_000, 1), (3, 2)):
        monkeypatch.setattr(T, "COMMON_WORDS", words)
        monkeypatch.setattr(T, "COMMON_FROM", part)
        rows = T.build_keyword_index(b.news).collect()
        assert len(rows) == len(want) and set(map(tuple, rows)) == want


def test_prefixes_are_distinct_before_they_are_spelled_out(spark):
    """No aggregate above the explode; repeated ids, names and nulls as with distinct rows."""
    acc = spark.createDataFrame([(1, "Ann"), (1, "Ann"), (1, "Anna"), (1, "Bo"), (1, "ANNE"), (2, None), (2, ""), (2, "b"), (None, "ab"),
                                 (None, "ac"), (3, "\u00e9t\u00e9"), (3, "\U0001f600a"), (3, "\U0001f600b"), (3, "\uffffb")], "userID long, username string")
    index = T.build_prefix_index(acc)
    plan = _shuffles(index)[0]
    assert "HashAggregate" not in plan[:plan.index("Generate explode")]
    want = T.name_prefixes(acc).distinct()
    assert sorted(map(str, index.collect())) == sorted(map(str, want.collect()))


def test_unique_headlines_are_dealt_as_articles(spark, monkeypatch):
    """Keywords of an article are made distinct without a shuffle of their own; articles that share a
    headline, or have none, give the greatest link of each keyword."""
    rows = [("h1", "Cats ran", "u1"), ("h2", "cats Running runs", "u2"), ("h2", "dogs runs", "u3"), ("h2", "dogs runs", "u3"),
            (None, "the cats", "u4"), (None, "cats the", "u5"), ("h3", None, "u6"), ("h4", "xéy \U0001d400abc abc café Abc2def", None)]
    news = spark.createDataFrame([(h, "me", t, "c", "d", u) for h, t, u in rows],
                                 "headline string, authors string, short_description string, category string, date string, link string")
    want = {}
    for h, t, u in rows:
        words = {"me", "h"} & ({"me", "h"} if h else {"me"})
        words |= {"Cats ran": {"cat", "ran"}, "cats Running runs": {"cat", "run"}, "dogs runs": {"dog", "run"}, "the cats": {"cat"},
                  "cats the": {"cat"}, None: set()}.get(t, {"abc", "cafe", "def"})
        for w in words:
            want[w, h] = max(filter(None, (want.get((w, h)), u)), default=None)
    want = sorted(((w, h, u) for (w, h), u in want.items()), key=repr)
    for most in (T.REPEATED, 1):
        monkeypatch.setattr(T, "REPEATED", most)
        assert sorted(map(tuple, T.build_keyword_index(news).collect()), key=repr) == want
    single = T.build_keyword_index(news.where("headline in ('h1', 'h3')"))
    plan = _shuffles(single)[1]
    assert "Exchange hashpartitioning(headline" in plan and "SortAggregate" not in plan


def test_stem_chain_is_compiled_in_short_methods(spark):
    """The JVM interprets methods of more than 8000 bytes."""
    import io
    import re
    from contextlib import redirect_stdout

    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = io.StringIO()
        with redirect_stdout(out):
            news = Bindings(spark, SF_SMALL).news
            stem_column(spark.range(9).selectExpr("concat('x', id) AS word"), "word").explain("codegen")
            T.asked_heads(news.select(F.col("authors").alias("keyword")), T.build_keyword_index(news)).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
    assert sizes and max(sizes) < 8000


def test_only_keywords_that_answers_come_from_are_joined(spark):
    index = spark.createDataFrame(
        [(w, f"h{i:02d}", f"u{i}") for w, ids in (("common", range(0, 60)), ("mid", range(40, 50)), ("also", range(5, 45)), ("rare", [3])) for i in ids],
        "keyword string, headline string, url string")
    q = spark.createDataFrame([("a", "mid common also rare"), ("b", "rare none mid"), ("c", "common also"), (None, "mid rare"), (None, "also common"),
                               ("d", "none"), ("e", "mid mid rare also common")], "query_id string, query string")
    kw = T.parse_queries(q, stem=False)
    led = {(r.query_id, r.keyword) for r in T.leading_keywords(kw, T.posting_heads(index)).collect()}
    assert led == {("a", "mid"), ("a", "common"), ("b", "rare"), ("b", "mid"), ("c", "common"), (None, "mid"), (None, "also"),
                   ("e", "mid"), ("e", "rare"), ("e", "also")}
    hits = kw.join(index, "keyword").groupBy("query_id", "headline").agg(F.min("pos").alias("pos"), F.first("url").alias("url")).collect()
    want = []
    for k in {r.query_id for r in hits}:
        rows = sorted((r.pos, r.headline, r.url) for r in hits if r.query_id == k)[:15]
        want += [(k, i + 1, h, u) for i, (_, h, u) in enumerate(rows)]
    got = T.search_news(q, index, stem=False).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
