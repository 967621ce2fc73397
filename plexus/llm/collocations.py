"""Collocations by set-oriented mining: phrases grow by one word a round.

The occurrence relation R(1) has a row (row, at, id) for every occurrence of a
frequent word, persisted in buckets by document row and sorted by place.  R(k)
holds the occurrences of frequent phrases of k words in the same layout, by the
place after them, so the merge join of R(k) with R(1) at that place needs
neither a shuffle nor a sort (for k = 1, a sort of sorted rows).  The joined rows are grouped and counted by (phrase, next word), frequent
groups are kept in a table of their own, and a semi-join (which fetches the
group's id) leaves R(k + 1).  Only ids and places move, no strings."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plexus.llm import common
from plexus.session import scratch_path

LONGEST, LEAST, TOP, PERCENT = 5, 100, 2000, 100
BUCKET_CHARS = 16 << 20  # text of one bucket, about
BROADCAST = 32 << 20  # bytes of a table of frequent groups that is still broadcast
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed settings of the merge joins: buckets by the document row alone serve a
# join on (row, place), and sorted buckets aren't sorted again.
LAYOUT = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
          "spark.sql.sources.bucketing.enabled": "true"}


@contextmanager
def bucketed_joins(spark: SparkSession) -> Iterator[None]:
    """``LAYOUT`` within the block, the session's own settings after it."""
    before = {k: spark.conf.get(k, None) for k in LAYOUT}
    try:
        for k, v in LAYOUT.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def occurrences(texts: DataFrame) -> DataFrame:
    """(row, lang, at, word) of every word.  A piece's end takes a place of its
    own, so that neighbouring places are neighbours within a piece."""
    marked = F.regexp_replace("text", "[.,;:!?\n\x0b\x0c\r]", " \n ")
    cut = texts.select("row", "lang", F.posexplode(F.split(marked, "[ \t]+")).alias("at", "word"))
    return cut.filter((F.col("word") != "") & (F.col("word") != "\n"))


def word_key() -> Column:
    """The word with A-Z lowered."""
    return F.translate("word", UPPER, LOWER)


class Relations:
    """Writes occurrence relations as bucketed tables; ``drop`` forgets them
    (their files lie in the scratch folder)."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets, self.names = spark, buckets, []

    def persisted(self, rows: DataFrame, place: str, name: str, dealt: bool) -> DataFrame:
        """``rows`` by bucket, row and ``place``; ``dealt`` says that they lie by
        row already."""
        if not dealt:
            rows = rows.repartition(self.buckets, "row")
        table = f"{name}_{uuid.uuid4().hex[:12]}"
        rows.write.bucketBy(self.buckets, "row").sortBy("row", place).option("path", scratch_path(self.spark, name)).saveAsTable(table)
        self.names.append(table)
        return self.spark.table(table)

    def drop(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def semi_joined(rows: DataFrame, groups: DataFrame, on: list[str], small: bool) -> DataFrame:
    """``rows`` whose group is frequent, with the group's id.  A small table of
    groups is broadcast, so that rows stay where they are; a large one is joined
    by shuffles, where adaptive execution splits frequent groups."""
    return rows.join(F.broadcast(groups) if small else groups, on)


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, lang_col: str = "lang", text_col: str = "text",
                     broadcast: int = BROADCAST) -> tuple[DataFrame, DataFrame]:
    """Phrases of up to ``longest`` words that occur ``least`` times or more in
    a language: (lang, words, phrase, f); and (lang, n), the number of words.

    Null texts have no words, a null language is ``und``.  Overlapping
    occurrences count.  Every row counts, repeated ones too."""
    spark = docs.sparkSession
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(1, -(-chars // BUCKET_CHARS))
    held = Relations(spark, buckets)
    counts = occurrences(texts).groupBy("lang", "word").agg(F.count("*").alias("c"))  # spellings first: fewer words to lower
    counts = common.stored(counts.groupBy("lang", word_key().alias("word")).agg(F.sum("c").alias("f")), "word-counts")
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    words = common.stored(counts.filter(F.col("f") >= least).withColumn("id", F.monotonically_increasing_id()), "frequent-words")
    tables = [words.select("lang", F.array("word").alias("words"), "f", "id")]

    def small(table: DataFrame, *strings: str) -> bool:
        size = table.agg(F.coalesce(F.sum(F.lit(48) + sum((F.octet_length(s) for s in strings), F.lit(0))), F.lit(0))).first()[0]
        return size <= broadcast

    keys = words.select("lang", "word", "id")
    fits = small(keys, "word", "lang")
    first = occurrences(texts.repartition(buckets, "row") if fits else texts).withColumn("word", word_key())
    kept = semi_joined(first, keys, ["lang", "word"], fits).select("row", F.col("at").cast("int").alias("at"), "id")
    singles = held.persisted(kept, "at", "setm_1", fits)
    relation = singles.select("row", (F.col("at") + 1).alias("after"), "id")
    with bucketed_joins(spark):
        for size in range(2, longest + 1):
            last = singles.select(F.col("row").alias("last_row"), "at", F.col("id").alias("next"))
            grown = relation.join(last, (F.col("row") == F.col("last_row")) & (F.col("after") == F.col("at"))).select("row", "after", "id", "next")
            groups = grown.groupBy("id", "next").agg(F.count("*").alias("f")).filter(F.col("f") >= least)
            groups = common.stored(groups.withColumnsRenamed({"id": "before"}), f"groups-{size}")
            groups = common.stored(groups.withColumn("id", F.monotonically_increasing_id()), f"frequent-{size}")
            named = groups.join(tables[-1].select(F.col("id").alias("before"), "lang", "words"), "before").join(
                words.select(F.col("id").alias("next"), "word"), "next")
            tables.append(common.stored(named.select("lang", F.concat("words", F.array("word")).alias("words"), "f", "id"), f"phrases-{size}"))
            if size == longest or groups.isEmpty():
                break
            fits = small(groups)
            kept = semi_joined(grown.withColumnRenamed("id", "before"), groups.select("before", "next", "id"), ["before", "next"], fits)
            relation = held.persisted(kept.select("row", (F.col("after") + 1).alias("after"), "id"), "after", f"setm_{size}", fits)
    held.drop()
    found = tables[0]
    for t in tables[1:]:
        found = found.union(t)
    return found.select("lang", "words", F.array_join("words", " ").alias("phrase"), "f"), totals


def scored(phrases: DataFrame, totals: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Candidates (two words and more) with their weakest cut, without those that
    a longer candidate holds with ``percent`` % of their occurrences: lang,
    phrase, a, l, r, n, score.

    A longer phrase holds a shorter one by way of phrases that are one word
    longer each time and occur as often at least, so only those are looked at.
    Scores are exact integers in 38 decimal digits."""
    long = phrases.filter(F.size("words") > 1)
    part = lambda a, n: F.array_join(F.slice("words", a, n), " ")
    cuts = long.select("lang", "phrase", F.size("words").alias("size"), F.col("f").alias("a"), "words",
                       F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    f = phrases.select("lang", "phrase", "f")
    cuts = cuts.join(f.withColumnsRenamed({"phrase": "left", "f": "l"}), ["lang", "left"]).join(
        f.withColumnsRenamed({"phrase": "right", "f": "r"}), ["lang", "right"]).join(totals, "lang")
    whole = lambda c: f"cast({c} as decimal(19, 0))"
    score = F.expr(f"(cast(1000 * {whole('a')} as decimal(22, 0)) * cast(n as decimal(16, 0))) div ({whole('l')} * {whole('r')})")
    worst = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("a").alias("a"), F.first("n").alias("n"))
    inner = phrases.filter(F.size("words") > 2).select("lang", "f", F.explode(F.array(
        F.array_join(F.expr("slice(words, 1, size(words) - 1)"), " "), F.array_join(F.expr("slice(words, 2, size(words) - 1)"), " "))).alias("phrase"))
    held = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = worst.join(held, ["lang", "phrase"], "left").filter("longer is null or 100 * longer < " + f"{percent} * a")
    return kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, percent: int = PERCENT, lang_col: str = "lang",
                 text_col: str = "text", broadcast: int = BROADCAST) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n,
    score; by score, then occurrences ``a``, then phrase (byte order).

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its weakest cut, ``n``
    all words of the language; ties of cuts go to the earlier one.  Null texts
    count nothing, a null language is ``und``, repeated rows count again, other
    columns don't matter; no text or no frequent phrase gives no rows."""
    phrases, totals = frequent_phrases(docs, least, longest, lang_col, text_col, broadcast)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored(phrases, totals, percent).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
