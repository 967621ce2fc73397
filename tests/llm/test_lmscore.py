"""Backoff scores against counting by hand."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from plexus.llm import lmscore, registry
from plexus.llm.registry import op6_stupid_backoff
from tests.conftest import SF_SMALL
from tests.llm.conftest import ODD


def by_hand(texts, order):
    docs = [re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for t in texts]
    grams = [Counter(tuple(d[i - n:i]) for n in range(1, order + 1) for i in range(n, len(d) + 1)) for d in docs]
    total, words = sum(grams, Counter()), sum(map(len, docs))
    out = []
    for d, own in zip(docs, grams, strict=True):
        score = 0.0
        for i in range(len(d)):
            longest = min(order, i + 1)
            for n in range(longest, 0, -1):
                gram = tuple(d[i - n + 1:i + 1])
                count = total[gram] - own[gram]
                if count:
                    context = words - len(d) if n == 1 else total[gram[:-1]] - own[gram[:-1]]
                    score += math.log(0.4 ** (longest - n) * count / context)
                    break
            else:
                score += math.log(0.4 ** longest / (words - len(d) + 1))
        out.append((len(d), round(score, 6)))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_counting(spark, docs, order):
    rng = random.Random(order)
    rows = [(100 + k, " ".join(rng.choices(["the", "The", "cat", "sat", "on", "a", "mat\t", "é"], k=rng.randint(0, 30)))) for k in range(60)] + ODD
    got = lmscore.backoff_scores(docs(rows).repartition(3), order, block_chars=700).collect()
    key = lambda x: (x[0] is None, x)
    want = sorted(((i, *s) for (i, _), s in zip(rows, by_hand([t for _, t in rows], order), strict=True)), key=key)
    got_rows = sorted(((r.doc_id, r.n_tokens, r.log_score) for r in got), key=key)
    assert len(got_rows) == len(want)
    assert all(a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-4 for a, b in zip(got_rows, want, strict=True))
    assert all((r.mean_log_score is None) == (r.n_tokens == 0) for r in got)
    assert lmscore.backoff_scores(docs([])).collect() == []


def test_registered_query(spark):
    import duckdb

    rows = duckdb.execute(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet' ORDER BY doc_id").fetchall()
    got = op6_stupid_backoff(spark, SF_SMALL).orderBy("doc_id").collect()
    for r, (n, s) in zip(got, by_hand([t for _, t in rows], 2), strict=True):
        assert r.n_tokens == n and abs(r.log_score - s) < 1e-3


def test_registered_order_reaches_trigrams(spark):
    import duckdb

    rows = duckdb.execute(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet' ORDER BY doc_id").fetchall()
    got = registry.queries()["op6_stupid_backoff"](spark, SF_SMALL).orderBy("doc_id").collect()
    assert len(got) == len(rows) and registry.BACKOFF_ORDER > 2
    for r, (n, s) in zip(got, by_hand([t for _, t in rows], registry.BACKOFF_ORDER), strict=True):
        assert r.n_tokens == n and abs(r.log_score - s) < 1e-3


def test_keys_keep_all_bits():
    keys = np.array([3, 4, 2**40 + 1, 2**40 + 2, 2**63, 2**64 - 1], np.uint64)
    assert lmscore.unpacked(lmscore.packed(keys)).tolist() == keys.tolist()
    assert lmscore.unpacked(lmscore.packed(keys[:0])).tolist() == []
