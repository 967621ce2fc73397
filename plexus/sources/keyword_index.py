"""A stored keyword index (T5) that searches (T7) read.

Layout: folders ``part=<hash of the keyword modulo parts>``; within them files
sorted by (keyword, headline).  A search knows the folders of its keywords
beforehand and reads no others.  A folder's rows are dealt by headline to slices,
``SLICES`` per write task and folder, which different tasks write, so a keyword
of a third of all articles fills many files where there are many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plexus.operators import text as T

INDEX_PARTS = 256     # folders of an index; a lookup's list of them is at most so long
SLICES = 5            # slices of a folder, times the write tasks per folder
INDEX_SCHEMA = "keyword string, headline string, url string, part int"


def index_part(keyword: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(keyword), F.lit(parts)).cast("int")


def store_index(index: DataFrame, path: str, parts: int = INDEX_PARTS, ranges: int | None = None,
                append: bool = False) -> None:
    """T5 sink: write (keyword, headline, url) rows in this module's layout.

    ``ranges`` is the number of write tasks (default: the session's shuffle
    partitions).  With at least as many tasks as folders, a folder's rows are cut
    into slices by headline; the slices of all folders are dealt to the tasks in
    turn, so the rows are computed once, not sampled for ranges first.
    ``append`` adds new articles' rows without reading those
    stored; readers merge what several writes hold for one (keyword, headline).
    An empty index makes an empty folder, which readers accept."""
    tasks = ranges or int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(1, SLICES * (tasks // parts))
    rows = index.select("keyword", "headline", "url", index_part("keyword", parts).alias("part"))
    place = (F.col("part") * slices + F.pmod(F.xxhash64("headline"), F.lit(slices))) % tasks
    (rows.repartitionById(tasks, place.cast("int")).sortWithinPartitions("part", "keyword", "headline")
     .write.mode("append" if append else "overwrite").partitionBy("part").parquet(path))


def stored_index(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a stored index, one per (keyword, headline)."""
    return T.merge_index(spark.read.schema(INDEX_SCHEMA).parquet(path))


def stored_postings(keywords: DataFrame, path: str, parts: int = INDEX_PARTS, cap: int | None = None) -> DataFrame:
    """(keyword, headline, url) of the given ``keywords(keyword)`` only.

    Their folders (at most ``parts`` numbers) are fetched first and stand as a
    literal list in the scan's partition filter; rows of other keywords in
    those folders go by a semi-join before anything is grouped.  ``parts``
    must be the number the index was written with.  With ``cap``, only the first
    ``cap`` headlines of each keyword, left over by every task before the rows
    of several writes are merged."""
    spark = keywords.sparkSession
    found = keywords.select(index_part("keyword", parts).alias("part")).distinct().collect()
    rows = spark.read.schema(INDEX_SCHEMA).parquet(path).where(F.col("part").isin([r.part for r in found]))
    asked = keywords.select("keyword").distinct()
    if cap is None:
        return T.merge_index(rows.join(asked, "keyword", "left_semi"))
    return T.asked_heads(asked, rows, cap, merged=False)


def search_stored(queries: DataFrame, path: str, news: DataFrame | None = None, cap: int = T.SEARCH_CAP,
                  stem: bool = True, parts: int = INDEX_PARTS) -> DataFrame:
    """T7 on a stored index: the result of ``search_news``, reading only the
    folders of the queries' keywords.  ``stem`` as the index was built."""
    kw = T.parse_queries(queries, stem=stem).checkpoint(eager=True)
    return T.search_news(kw, stored_postings(kw, path, parts, cap), news, cap, parsed=True)
