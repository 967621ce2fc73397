"""Sinks: reports (G9, G10), the news table (T2) and text exports used to
feed the readers (G1, T1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_report(report: DataFrame, path: str) -> None:
    """Write a small, bounded report (a top-k or its comparison)
    as one JSON file.  Only for results whose size is fixed by k."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_news_table(table: DataFrame, path: str) -> None:
    """The keyed news table as parquet, clustered by headline."""
    table.repartition("headline").sortWithinPartitions("headline", "date") \
        .write.mode("overwrite").parquet(path)


def write_edge_list(edges: DataFrame, path: str, sep: str = " ") -> None:
    """Edges as text lines "src<sep>dst" (the format G1 reads)."""
    edges.select(F.concat_ws(sep, F.col("src").cast("string"), F.col("dst").cast("string")).alias("value")) \
        .write.mode("overwrite").text(path)


def write_news_json(news: DataFrame, path: str) -> None:
    """Articles as JSON lines with the six news fields (the format T1 reads)."""
    news.select("authors", "category", "date", "headline", "link", "short_description") \
        .write.mode("overwrite").json(path)


def json_rows(df: DataFrame, col: str = "json") -> DataFrame:
    """Each row as one JSON object string (the web tier's response shape)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias(col))
