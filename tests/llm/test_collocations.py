"""Collocations against counting by hand."""

import random
import re
from collections import Counter

import duckdb
import pytest

from plexus.llm import collocations as C
from plexus.llm.registry import OP12_SQL, op12_collocations
from tests.conftest import SF_SMALL


def plain(rows, least, longest=5, top=2000, percent=100):
    """rows: (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            f.update((lang, *words[i:i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    frequent = {p: c for p, c in f.items() if c >= least and len(p) > 2}
    found = []
    for (lang, *words), a in frequent.items():
        score, k = min((1000 * a * n[lang] // (f[lang, *words[:k]] * f[lang, *words[k:]]), k) for k in range(1, len(words)))
        within = any(o == lang and len(long) > len(words) and 100 * c >= percent * a
                     and any(long[i:i + len(words)] == words for i in range(len(long) - len(words) + 1))
                     for (o, *long), c in frequent.items())
        if not within:
            found.append((lang, -score, -a, " ".join(words).encode(), f[lang, *words[:k]], f[lang, *words[k:]], n[lang]))
    out, rank = [], Counter()
    for lang, score, a, phrase, left, right, total in sorted(found):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, left, right, total, -score))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(k % 3, lang, text, 1, "x") for k, (lang, text) in enumerate(rows)],
                                 "doc_id long, lang string, text string, at int, phrase string")


def texts(seed, n, vocabulary):
    rng = random.Random(seed)
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    return [(rng.choice(["en", "de", None]), "".join(w + rng.choice([" "] * 8 + [".", ", ", "\t", "  ", "\n", " . "])
                                                     for w in rng.choices(vocabulary, weights, k=rng.randrange(60)))) for _ in range(n)]


VOCABULARY = ["the", "The", "of", "big", "Größe", "größe", "New", "york", "\x00", "a-b", "日本", "x y", " ", "\x1c", "city", "ÉCOLE"]


@pytest.mark.parametrize("least,longest,percent,broadcast", [(3, 5, 100, C.BROADCAST), (2, 4, 60, 0), (1, 2, 100, C.BROADCAST)])
def test_random_texts(spark, monkeypatch, least, longest, percent, broadcast):
    monkeypatch.setattr(C, "BUCKET_CHARS", 4000)  # several buckets
    rows = texts(least, 120, VOCABULARY) + [("en", "copy of the big city. " * 5)] * 20
    got = C.collocations(frame(spark, rows), least, longest, 2000, percent, broadcast=broadcast).collect()
    assert sorted(map(tuple, got), key=lambda r: (r[0], r[1])) == plain(rows, least, longest, 2000, percent)


def test_odd_rows(spark):
    rows = [(None, None), ("en", ""), ("en", " \t\n.,"), ("und", "a b"), (None, "A  B"), ("fr", "x " * 20000), ("fr", "y"), ("es", "z" * 30000 + " " + "z" * 30000)] + [("es", "one two")] * 3
    assert sorted(map(tuple, C.collocations(frame(spark, rows), 2, top=3).collect())) == sorted(plain(rows, 2, top=3))
    assert C.collocations(frame(spark, rows).limit(0)).collect() == [] and C.collocations(frame(spark, rows[:3]), 1).collect() == []


def test_exact_scores_beyond_64_bits(spark):
    big = 4_000_000_000
    phrases = spark.createDataFrame([("en", ["a", "b"], "a b", big), ("en", ["a"], "a", big + 1), ("en", ["b"], "b", big + 7)],
                                    "lang string, words array<string>, phrase string, f long")
    totals = spark.createDataFrame([("en", 10**13)], "lang string, n long")
    assert C.scored(phrases, totals).first()["score"] == 1000 * big * 10**13 // ((big + 1) * (big + 7))


def test_merge_join_moves_and_sorts_nothing(spark):
    held = C.Relations(spark, 3)
    rows = spark.range(500).selectExpr("id div 50 as row", "cast(id % 50 as int) as at", "id % 7 as id")
    one, two = held.persisted(rows, "at", "one", False), held.persisted(rows.filter("at % 9 < 5").selectExpr("row", "at + 1 as after", "id"), "after", "two", False)
    with C.bucketed_joins(spark):
        joined = two.hint("merge").join(one.selectExpr("row as last_row", "at", "id as next"), [C.F.expr("row = last_row"), C.F.expr("after = at")])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan
        assert joined.count() == sum(1 for k in range(500) if k % 50 % 9 < 5 and k % 50 < 49)
    held.drop()


def test_registered_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    want = sorted(con.execute(OP12_SQL).fetchall())
    assert sorted(map(tuple, op12_collocations(spark, SF_SMALL).collect())) == want and want
    assert want == sorted(plain(con.execute("SELECT lang, text FROM documents").fetchall(), 100))
