"""Near-duplicate components against all pairs."""

import random
import re

import duckdb
import numpy as np
import pytest

from plexus.llm import neardup
from plexus.llm.components import components
from plexus.llm.registry import op2_near_duplicates
from tests.conftest import SF_SMALL
from tests.llm.conftest import ODD


def brute(rows, width, percent=80):
    def shingles(text):
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        return {tuple(words[k:k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if x and sets[j] and 100 * both >= percent * (len(x) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = least.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r)[:4] for r in df.collect()), key=str)


def varied(seed, n=150):
    """Chains of edits, copies and unrelated texts."""
    rng = random.Random(seed)
    rows, vocabulary = [], [f"w{k}" for k in range(300)]
    while len(rows) < n:
        words = rng.choices(vocabulary, k=rng.randint(1, 60))
        for _ in range(rng.choice([1, 1, 2, 6])):
            rows.append((rng.randint(0, 2 * n), " ".join(words).title() if rng.random() < 0.3 else " \t".join(words)))
            words = list(words)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
    seen = {}
    return [(i, t) for i, t in rows if seen.setdefault(i, t) == t]


@pytest.mark.parametrize("width", [2, 5])
def test_against_all_pairs(spark, docs, width):
    rows = varied(width) + [(1000 + k, t) for k, (_, t) in enumerate(ODD)] + [(None, "no id"), (2000, "A b"), (2001, "a  B"), (2002, "a"), (2002, "a")]
    assert got(neardup.near_duplicates(docs(rows).repartition(3), width)) == brute(rows, width)


def test_empty_table(spark, docs):
    assert neardup.near_duplicates(docs([])).collect() == []


def test_registered_query(spark):
    rows = duckdb.execute(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall()
    assert got(op2_near_duplicates(spark, SF_SMALL)) == brute(rows, 2)


def test_posterior_bound():
    least = neardup.least_matches(80, 1e-6)
    draws = np.random.default_rng(1).binomial(64, 0.8, 200_000)
    assert (draws < least[4]).mean() < 1e-4 and least[4] > 20


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(0, 60)]
    star = [(500, 100 + k) for k in range(50)]
    links = spark.createDataFrame(chain + star + [(7, 7)], "a long, b long")
    found = {r.node: r.root for r in components(links).collect()}
    assert found == {k: 0 for k in range(1, 61)} | {k: 100 for k in [*range(101, 150), 500]}


def test_shingles_of_slices():
    import pyarrow as pa

    from plexus.llm.shingles import shingle_sets

    texts = ["Ein Übel à la carte", "ÉTÉ É é", "a B\tc\x0bd", None, "", "à", "x y z"] * 50
    whole = pa.array(texts)
    for a in (0, 3, 5):
        sets, starts = shingle_sets(whole.slice(a, 200), 2)
        want = [r[1] for r in sorted(((k, brute([(0, t)], 2)[0][1]) for k, t in enumerate(texts[a:a + 200])))]
        assert np.diff(starts).tolist() == want


def compared(spark, docs, rows, monkeypatch):
    """The result's rows and how many pairs were compared by signatures."""
    counts, real = [], neardup.bayes_survivors
    monkeypatch.setattr(neardup, "bayes_survivors", lambda pairs, *a: (counts.append(pairs.count()), real(pairs, *a))[1])
    return got(neardup.near_duplicates(docs(rows))), sum(counts)


def test_a_common_passage_brings_no_pairs_of_all_with_all(spark, docs, monkeypatch):
    rng = random.Random(11)
    passage = " ".join(f"p{k}" for k in range(220))
    pairs = []
    for n in (50, 200):
        rows = [(k, " ".join(f"w{rng.randrange(10**9)}" for _ in range(40)) + " " + passage + " " + " ".join(f"w{rng.randrange(10**9)}" for _ in range(45)))
                for k in range(n)]
        found, tested = compared(spark, docs, rows, monkeypatch)
        assert [r[3] for r in found] == [True] * n
        pairs.append(tested)
    assert pairs[1] <= 6 * max(pairs[0], 50)  # four times the texts; all pairs would be sixteen times


def test_a_large_group_of_near_copies_is_compared_about_once_each(spark, docs, monkeypatch):
    rng = random.Random(12)
    words = [f"w{k}" for k in range(300)]

    def copy():
        own = list(words)
        for _ in range(2):
            own[rng.randrange(300)] = f"x{rng.randrange(10**9)}"
        return " ".join(own)

    rows = [(k, copy()) for k in range(300)]
    found, tested = compared(spark, docs, rows, monkeypatch)
    assert {r[2] for r in found} == {0} and tested < 2 * len(rows)


def test_later_links_join_components_found_before(spark):
    import random

    from plexus.llm.components import components, extended

    rng = random.Random(5)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(k, k + 1) for k in range(500, 540)] + [(7, 7), (540, 500)]
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    whole = {tuple(r) for r in components(frame(pairs)).collect()}
    rng.shuffle(pairs)
    roots = components(frame(pairs[:100]))
    for k in range(100, len(pairs), 50):
        roots = extended(roots, frame(pairs[k:k + 50]))
    assert sorted(map(tuple, roots.collect())) == sorted(whole)
    assert sorted(map(tuple, extended(roots, frame([])).collect())) == sorted(whole)
    leads = {}
    for a, b in pairs:  # union-find by the least node
        while a in leads:
            a = leads[a]
        while b in leads:
            b = leads[b]
        if a != b:
            leads[max(a, b)] = min(a, b)

    def lead(x):
        while x in leads:
            x = leads[x]
        return x

    assert whole == {(x, lead(x)) for x in leads}


def test_rounds_on_few_links_leave_few_files(spark, monkeypatch):
    """Every round's table had a file per shuffle partition, however few links there were."""
    import os

    from plexus.llm import components as C

    def parts():
        base = spark.sparkContext.getCheckpointDir().removeprefix("file:")
        return sum(f.startswith("part-") for _, _, files in os.walk(base) for f in files)

    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    links = spark.createDataFrame([(k, k + 1) for k in range(64)], "a long, b long").cache()
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "24")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        before = parts()
        few = C.components(links).collect()
        assert parts() - before <= 24 + 8
        monkeypatch.setattr(C, "FEW", 0)  # the way of large tables gives the same
        assert sorted(C.components(links).collect()) == sorted(few) and len(few) == 64
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
