"""String kernel by hand, training on invented insults, held-out accuracy."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa

from plexus.llm import toxicity as tx
from plexus.llm.registry import op5_toxicity
from tests.conftest import SF_SMALL
from tests.llm.conftest import ODD


def by_hand(s, t):
    three = lambda x: list(itertools.combinations(range(len(x)), 3))
    return sum(tx.DECAY ** (a[2] - a[0] + 1 + b[2] - b[0] + 1) for a in three(s) for b in three(t) if all(s[i] == t[j] for i, j in zip(a, b, strict=True)))


def test_kernel():
    words, marks = ["idiot", "abcab", "aaa", "zz", "ixdxixoxt"], ["i.d.iot", "cabab", "aaaa", "qqqqqqqqqqqq"]
    assert np.allclose(tx.kernel(words, marks), [[by_hand(s, t) for t in marks] for s in words], atol=1e-5)
    assert np.allclose(tx.own(words), [by_hand(s, s) for s in words], atol=1e-5)


def corpus(seed, n=400):
    rng = random.Random(seed)
    syllables = ["ba", "do", "ke", "li", "mu", "ne", "po", "ra", "si", "tu"]
    rows = []
    for k in range(n):
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(20, 80))]
        toxic = int(rng.random() < 0.3)
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["grumpfl", "schnarz", "quiddle"])
        rows.append((k, " ".join(words) + ".", toxic))
    return rows


def test_learns_insults_and_tolerates_letters(spark):
    rows = corpus(1)
    machine = tx.train([t for _, t, _ in rows], [y for _, _, y in rows])
    tops, words = tx._tops(machine, pa.array([t for _, t, _ in corpus(2)] + ["g r u m p f l now", "g.r.u.m.p.f.l", "grumxpfl you", "schnarrz", "", None]))
    p, y = machine.probability(tops), np.array([y for _, _, y in corpus(2)])
    assert ((p[:len(y)] >= 0.3) == y).mean() > 0.98
    assert (p[len(y):len(y) + 4] >= 0.3).all() and not words[-2:].any()


def test_operator(spark, docs):
    rows = corpus(3, 200)
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (1, 0, None)], "doc_id long, quality int, toxic int")
    table = docs([(i, t) for i, t, _ in rows] + [(1000 + (i or 0), t) for i, t in ODD] + [(None, "x")])
    got = tx.toxic_documents(table.repartition(3), labels).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) + len(ODD) + 1
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    assert np.mean([by[i].predicted == y for i, _, y in rows if by[i].held_out]) > 0.95
    assert by[1001].score == 0.0
    used = tx.training_sample(table, labels).collect()
    assert len(used) == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i, _, _ in rows)
    assert tx.toxic_documents(docs([]), labels).collect() == []
    assert {r.score for r in tx.toxic_documents(table, labels.limit(0)).collect()} == {0.0}


def plain_score(machine, text):
    """A text's score from kernels by hand, word by word."""
    words = {u for w in text.split() for u in tx.units(w)} | set(tx.spelled(text.split()))
    if not words:
        return 0.0
    scale = [np.sqrt(by_hand(m, m)) for m in machine.marks]

    def margin(w):
        k = np.array([by_hand(w, m) / c for m, c in zip(machine.marks, scale, strict=True)]) / np.sqrt(by_hand(w, w))
        return float(k @ machine.whiten @ machine.weights + machine.bias)

    margins = {w: margin(w) for w in words}
    units = [u for w in text.split() for u in [max(tx.units(w), key=margins.get, default=None)] if u] + tx.spelled(text.split())
    tops = (sorted((max(margins[u], -2.0) for u in units), reverse=True) + [-2.0] * tx.TOP)[:tx.TOP]
    return float(1 / (1 + np.exp(-(np.array(tops) @ machine.curve[:-1] + machine.curve[-1]))))


def test_registered_query(spark):
    documents, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in op5_toxicity(spark, SF_SMALL).collect()}
    rows = documents.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    machine = tx.fit(documents, labels)
    short = sorted((r for r in rows if r.text), key=lambda r: len(r.text))[:8]
    for r in short:
        assert abs(got[r.doc_id].score - plain_score(machine, r.text)) < 1e-4


def test_folded_weights_equal_kernels():
    rows = corpus(5, 120)
    machine = tx.train([t for _, t, _ in rows], [y for _, _, y in rows])
    words = ["grumpfl", "gr.umpfl", "日本語", "x" * 24, "ba", tx.FIRST + "a" + tx.LAST, "badokelimu"]
    words = [w for w in words if len(w) > 2]
    assert np.allclose(machine.values(words), machine.features(words) @ machine.weights + machine.bias, atol=1e-4)


def insults(seed, texts, marks, put):
    """Half of the texts with an insult put in."""
    rng = random.Random(seed)
    rows = []
    for k, t in enumerate(texts):
        toxic = k % 3 == 0
        rows.append((put(rng, t, rng.choice(marks)) if toxic else t, int(toxic)))
    return rows


def caught(train, test):
    machine = tx.train([t for t, _ in train], [y for _, y in train])
    tops, _ = tx._tops(machine, pa.array([t for t, _ in test]))
    flagged, y = machine.probability(tops) >= 0.3, np.array([y for _, y in test])
    return flagged[y == 1].mean(), flagged[y == 0].mean()


def test_insults_of_two_letters():
    texts = [[t for _, t, _ in corpus(s, 240) if True] for s in (21, 22)]
    texts = [[" ".join(w for w in t.split() if not any(m in w for m in ("grum", "schn", "quid"))) for t in part] for part in texts]
    put = lambda rng, t, m: t.replace(" ", f" {m} ", 1)
    hit, wrong = caught(*(insults(s, part, ["xq", "vz"], put) for s, part in enumerate(texts)))
    assert hit > 0.95 and wrong < 0.05


def test_insults_in_unspaced_text():
    rng = random.Random(31)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 60)]
    texts = [["".join(rng.choices(letters, k=rng.randint(60, 120))) for _ in range(240)] for _ in range(2)]

    def put(rng, t, m):
        at = rng.randrange(len(t))
        return t[:at] + m + t[at:]

    hit, wrong = caught(*(insults(s, part, ["\u5f00\u5f01\u5f02\u5f03", "\u5f04\u5f05\u5f06\u5f07"], put) for s, part in enumerate(texts)))
    assert hit > 0.9 and wrong < 0.1


def test_a_column_called_toxicity(spark, docs):
    rows = corpus(3, 60)
    machine = tx.train([t for _, t, _ in rows], [y for _, _, y in rows])
    table = spark.createDataFrame([(1, "x grumpfl", 9.0)], "toxicity long, text string, score double")
    got = tx.score(table, machine).collect()
    assert len(got) == 1 and 0 <= got[0].toxicity <= 1 and got[0].score == 9.0 and got[0].__fields__ == ["text", "score", "toxicity"]
