"""Read JSON-lines news with an explicit schema (no inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

NEWS_SCHEMA = T.StructType([
    T.StructField("authors", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("headline", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("short_description", T.StringType()),
])


def read_news(spark: SparkSession, path: str) -> DataFrame:
    """News articles by field name, exact duplicate rows dropped."""
    return spark.read.schema(NEWS_SCHEMA).json(path).distinct()
