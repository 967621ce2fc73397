"""The stored keyword index: same answers as the index in memory, few folders
read, a hot keyword dealt over many files."""

import io
import re
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from plexus.operators import text as T
from plexus.sources import keyword_index as K


def articles(spark, n):
    rows = spark.range(n).selectExpr("format_string('h%05d', id) AS headline", "'x' AS authors", "'c' AS category",
                                     "string(null) AS date", "concat('l', id) AS link",
                                     "concat('common ', repeat('z', int(id % 40) + 1), ' tail') AS short_description")
    return rows


def queries(spark, *texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "query_id string, query string")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stored_search_equals_search_in_memory(spark, tmp_path):
    news, path = articles(spark, 400), str(tmp_path / "idx")
    index = T.build_keyword_index(news)
    K.store_index(index, path, parts=16)
    q = queries(spark, "common", "zzz tails", "nothing here", "", "  ", "ZZZZ common")
    assert rows(K.search_stored(q, path, parts=16)) == rows(T.search_news(q, index))
    assert rows(K.stored_index(spark, path)) == rows(index.select("keyword", "headline", "url"))


def test_appended_rows_merge_with_those_stored(spark, tmp_path):
    path = str(tmp_path / "idx")
    old = spark.createDataFrame([("a", "h1", "u1"), ("b", "h1", "u1")], "keyword string, headline string, url string")
    K.store_index(old, path, parts=4)
    K.store_index(spark.createDataFrame([("a", "h1", "u2"), ("a", "h0", "u0")], old.schema), path, parts=4, append=True)
    assert rows(K.stored_index(spark, path)) == [("a", "h0", "u0"), ("a", "h1", "u2"), ("b", "h1", "u1")]
    assert rows(K.search_stored(queries(spark, "a b"), path, stem=False, parts=4)) == [
        ("0", 1, "h0", "u0"), ("0", 2, "h1", "u2")]


def test_a_lookup_reads_its_folders_only(spark, tmp_path):
    news, path = articles(spark, 200), str(tmp_path / "idx")
    K.store_index(T.build_keyword_index(news), path, parts=16)
    words = spark.createDataFrame([("zzz",)], "keyword string")
    found = K.stored_postings(words, path, parts=16)
    out = io.StringIO()
    with redirect_stdout(out):
        found.explain()
    part = words.select(K.index_part("keyword", 16)).first()[0]
    line = next(x for x in out.getvalue().splitlines() if "PartitionFilters" in x)
    assert f"part#" in line and f"= {part})" in line.split("PartitionFilters")[1].split("]")[0]
    files = spark.read.schema(K.INDEX_SCHEMA).parquet(path).where(F.col("part") == part).inputFiles()
    assert len(found.collect()) == 5 and len(files) < 16


def test_hot_keyword_fills_many_files(spark, tmp_path):
    path = str(tmp_path / "idx")
    hot = spark.range(30000).selectExpr("if(id % 3 = 0, concat('k', id), 'hot') AS keyword",
                                        "format_string('h%06d', id) AS headline", "'u' AS url")
    K.store_index(hot, path, parts=8, ranges=12)
    per_file = (spark.read.schema(K.INDEX_SCHEMA).parquet(path).where("keyword = 'hot'")
                .groupBy(F.input_file_name()).count().collect())
    assert sum(r["count"] for r in per_file) == 20000 and max(r["count"] for r in per_file) < 20000 / 4


def test_empty_index_and_no_queries(spark, tmp_path):
    path = str(tmp_path / "idx")
    K.store_index(T.build_keyword_index(articles(spark, 0)), path, parts=4)
    assert K.search_stored(queries(spark, "a"), path, parts=4).count() == 0
    K.store_index(T.build_keyword_index(articles(spark, 5)), path, parts=4)
    assert K.search_stored(queries(spark, "a").limit(0), path, parts=4).count() == 0


def test_heads_of_several_writes_are_cut_before_they_are_merged(spark, tmp_path, monkeypatch):
    """Repeated and null headlines and links over three writes: the first headlines of each keyword, with the greatest link."""
    path, found = str(tmp_path / "idx"), []
    for k in range(3):
        rows = [(w, None if i == 7 else f"h{i % 23:02d}", None if (i + k) % 5 == 0 else f"u{k}{i:02d}")
                for w, n in (("a", 40), ("b", 4 + k), ("c", 1)) for i in range(n) if i % 3 != k or w == "c"]
        K.store_index(spark.createDataFrame(rows, "keyword string, headline string, url string"), path, parts=4, append=k > 0)
        found += rows
    want = {}
    for w, h, u in found:
        want[w, h] = max(filter(None, (want.get((w, h)), u)), default=None)
    heads = [(w, h, want[w, h]) for w in ("a", "b") for h in sorted((h for x, h in want if x == w), key=lambda h: h or "")[:5]]
    words = spark.createDataFrame([("a",), ("b",), ("a",), ("nothing",)], "keyword string")
    for most in (T.ASKED, 1):
        monkeypatch.setattr(T, "ASKED", most)
        got = K.stored_postings(words, path, parts=4, cap=5)
        assert rows_of(got) == sorted(heads, key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and not re.search(r"Exchange hashpartitioning\(keyword#\d+, headline", plan)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_index_rows_are_computed_once_when_stored(spark, tmp_path):
    """Dealing by ranges would sample the rows first."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    index = spark.range(5000).selectExpr("concat('k', id % 50) AS keyword", "concat('h', id) AS headline", "'u' AS url")
    index = index.mapInArrow(count, index.schema)
    for ranges in (3, 40, None):
        before = seen.value
        K.store_index(index, str(tmp_path / f"idx{ranges}"), parts=6, ranges=ranges)
        assert seen.value - before == 5000
        assert K.stored_index(spark, str(tmp_path / f"idx{ranges}")).count() == 5000
