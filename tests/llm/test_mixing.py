"""Poisson replication: the distribution, target shares, determinism."""

import math
from collections import Counter

from pyspark.sql import functions as F

from plexus.llm import mixing
from plexus.llm.registry import op8_source_mixing
from tests.conftest import SF_SMALL


def test_poisson_inversion(spark):
    for rate in (0.0, 0.3, 4.0, 900.0):
        got = [r.k for r in spark.range(20000).select(mixing.poisson(F.lit(rate), mixing.uniform(3, F.col("id"))).alias("k")).collect()]
        mean = sum(got) / len(got)
        spread = sum((x - mean) ** 2 for x in got) / len(got)
        assert abs(mean - rate) < 5 * (rate / 20000) ** 0.5 + 1e-9 and abs(spread - rate) < 0.06 * rate + 1e-9
    def inverse(u, rate):
        k, p = 0, math.exp(-rate)
        c = p
        while c < u:
            k += 1
            p *= rate / k
            c += p
        return k
    rows = spark.range(500).select(mixing.uniform(3, F.col("id")).alias("u")).select("u", mixing.poisson(F.lit(2.5), F.col("u")).alias("k")).collect()
    assert all(r.k == inverse(r.u, 2.5) for r in rows)


def test_shares(spark):
    rows = [(i, f"{'w' * 50} {i}", "a" if i % 3 else None) for i in range(6000)] + [(9000, None, "b"), (9001, "", "c"), (None, "x" * 50, "a"), (5, "x" * 50, "a"), (5, "x" * 50, "a")]
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, source string, copy int").drop("copy")
    weights = spark.createDataFrame([("a", 1.0), (None, 3.0), ("z", 5.0)], "source string, weight double")
    got = mixing.replicate(docs.repartition(5), weights).collect()
    share = Counter(r.source for r in got)
    assert abs(share[None] / len(got) - 0.75) < 0.03 and abs(len(got) / 6000 - 1) < 0.06 and set(share) == {"a", None}
    again = mixing.replicate(docs.repartition(2), weights).collect()
    assert Counter(got) == Counter(again)
    places = [r.doc_id for r in got if r.doc_id is not None]
    assert sum(a < b for a, b in zip(places, places[1:], strict=False)) / len(places) < 0.6
    assert mixing.replicate(docs.limit(0)).collect() == []


def test_registered_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = op8_source_mixing(spark, SF_SMALL).collect()
    copies = Counter(r.doc_id for r in got)
    assert all(docs[r.doc_id].text == r.text and r.copy < copies[r.doc_id] for r in got) and len(copies) > 20
    # every document by itself: rate from its source's characters, copies from its own uniform number
    size = Counter()
    for r in docs.values():
        size[r.source] += len(r.text or "")
    root = sum(x ** 0.5 for x in size.values())
    rate = {k: sum(size.values()) * x ** 0.5 / root / x for k, x in size.items()}
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    numbers = {r.doc_id: r.u for r in table.select("doc_id", mixing.uniform(17, F.col("doc_id"), F.xxhash64("text")).alias("u")).collect()}
    for i, r in docs.items():
        k, upto, term = 0, math.exp(-rate[r.source]), math.exp(-rate[r.source])
        while upto < numbers[i]:
            k += 1
            term *= rate[r.source] / k
            upto += term
        assert copies[i] == k


def test_any_column_names(spark):
    names = ["_source", "_rate", "row", "key", "of", "u", "n", "place", "copy", "_n", "_place", "rate"]
    rows = [(i, "text " * 5, "a", *range(len(names))) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} int" for n in names))
    got = mixing.replicate(docs, epochs=3.0).collect()
    assert got and got[0].__fields__ == [c for c in docs.columns if c != "copy"] + ["copy"]
    assert all(r._source == 0 and r._place == 10 and r.row == 2 and r.text == "text " * 5 for r in got) and max(r["copy"] for r in got) > 1
