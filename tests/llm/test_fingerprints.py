"""Order MinHash against a plain computation, and what it is for."""

import hashlib
import random

from plexus.llm import fingerprints as fp
from tests.llm.conftest import ODD


def test_following_documents(spark, docs):
    for rows in (ODD[:3] + ODD[6:], [(4, "alone and long enough")], [(k, f"text number {k} " * (k % 7)) for k in range(300)], []):
        got = {r.doc_id: r for r in fp.fingerprints(docs(rows).repartition(3)).collect()}
        rows = sorted((i, t or "") for i, t in rows)
        assert len(got) == len(rows)
        for k, (i, text) in enumerate(rows):
            following = rows[(k + 1) % len(rows)][1]
            n = len(text) // 4
            changed = text[:len(text) - n] + following[:n]
            r = got[i]
            assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
            a, b, c = map(fp.fingerprint, (text, changed, following))
            assert (r.near_edited, r.near_next) == ((a == b).mean(), (a == c).mean())
            assert r.fingerprint == "".join(f"{x:04x}" for x in a) and r.edited_fingerprint == "".join(f"{x:04x}" for x in b)


def test_ties_and_null_ids(spark, docs):
    got = fp.fingerprints(docs([(2, "b"), (2, "b"), (2, "a"), (None, "x"), (None, None)])).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == [(0, 0), (0, 1), (2, 1), (2, 1), (2, 1)]


def test_sketch_by_hand():
    text = "abracadabra abracadabra"
    seen, ids = {}, fp.numbered_kmers(text)
    for k in range(len(text) - fp.K + 1):
        kmer = text[k:k + fp.K]
        seen.setdefault((kmer, sum(text[j:j + fp.K] == kmer for j in range(k))), ids[k])
    assert len(seen) == len(set(ids.tolist())) == len(ids)
    long = "".join(random.Random(1).choices("abcdef ", k=20_000))  # several chunks
    x = fp.numbered_kmers(long)
    values = (x >> 32).astype("uint32")[None, :] * fp.ODD[:, None]
    two = values.argsort(axis=1, kind="stable")[:, :2]
    two.sort(axis=1)
    want = fp.mix(fp.mix(x[two[:, 0]]) * fp.M1 + x[two[:, 1]]) >> 48
    assert (fp.fingerprint(long) == want.astype("uint16")).all()


def test_likeness_falls_with_edits_and_reordering():
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(400)]
    text = " ".join(words)
    like = lambda t: (fp.fingerprint(text) == fp.fingerprint(t)).mean()
    few, many = list(words), list(words)
    for k in rng.sample(range(400), 10):
        few[k] = "zzzzzz"
    for k in rng.sample(range(400), 150):
        many[k] = "yyyyyy"
    swapped = " ".join(words[200:] + words[:200])
    assert like(text) == 1 and like(" ".join(few)) > like(" ".join(many)) > 0.02 and like(swapped) < 0.8
