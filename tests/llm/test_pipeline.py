"""Each stage's decisions, on its own input."""

import corpus_pipeline as cp
from pyspark.sql import functions as F

from plexus.llm import toxicity
from plexus.llm.mixing import replicate
from tests.conftest import SF_SMALL
from tests.llm.test_neardup import brute
from tests.llm.test_secrets import base
from tests.llm.test_tokens import check_places, plain


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*cp.COLUMNS).collect()), key=str)


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = cp.stored(cp.drop_toxic(spark, docs, SF_SMALL), "s1")
    machine = toxicity.fit(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    low = {r.doc_id for r in toxicity.score(docs, machine).filter("toxicity < 0.3").collect()}
    assert rows_of(kept) == rows_of(docs.filter(F.col("doc_id").isin(low)))
    single = cp.stored(cp.drop_near_duplicates(spark, kept, SF_SMALL), "s2")
    wanted = {r[0] for r in brute([(r.doc_id, r.text) for r in kept.collect()], 5) if r[3]}
    assert sorted(r.doc_id for r in single.collect()) == sorted(wanted)
    hidden = cp.stored(cp.hide_secrets(spark, single, SF_SMALL), "s3")
    texts = {r.doc_id: r.text for r in single.collect()}
    for r in hidden.collect():
        assert not base(r.text) and r.n_chars == len(r.text)
        assert r.text == texts[r.doc_id] or "[secret]" in r.text
    assert hidden.count() == len(texts) and hidden.columns == cp.COLUMNS
    mixed = cp.stored(cp.mix_sources(spark, hidden, SF_SMALL), "s4")
    assert rows_of(mixed) == rows_of(replicate(hidden))
    packed = cp.pack_sequences(spark, mixed, SF_SMALL).collect()
    assert sum(r.length for r in packed) == sum(len(plain(r.text, 0)) for r in mixed.collect())
    check_places(packed, 2048)
    assert {tuple(r)[:5] for r in cp.run(spark, SF_SMALL).collect()} == {tuple(r)[:5] for r in packed}


def test_repeated_and_empty_rows(spark):
    rows = [(1, "a b c d e f g", "en", "s", 1), (1, "a b c d e f g", "en", "s", 1), (2, "A b c d e  f g", "en", "s", 1), (3, None, "en", None, 0),
            (4, "", "en", "s", 0), (None, "q r s t u v w", None, "s", 1), (None, "q r s t u v w", None, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("_n", F.lit(1))
    got = cp.drop_near_duplicates(spark, docs, SF_SMALL).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 3, 4]
    assert cp.hide_secrets(spark, docs, SF_SMALL).count() == 7
    assert cp.pack_sequences(spark, cp.mix_sources(spark, docs.limit(0), SF_SMALL), SF_SMALL).collect() == []


def test_one_stays_with_null_and_repeated_ids(spark):
    long = " ".join(f"w{k}" for k in range(60))
    other, third = long.replace("w", "v"), long.replace("w", "u")
    rows = [(5, long), (None, long + " x"), (None, other), (None, other + " x"), (None, other + " y"),
            (7, third), (7, third + " x"), (5, "not like any of them at all"), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.text) for r in cp.drop_near_duplicates(spark, docs, SF_SMALL).collect()]
    assert len(got) == 5 and len([t for i, t in got if i == 7]) == 1 and len([t for i, t in got if i is None and t and t.startswith("v")]) == 1
    assert {(5, long), (5, "not like any of them at all"), (None, None)} <= set(got)
