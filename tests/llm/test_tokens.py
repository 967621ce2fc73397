"""Token files and packing against a plain encoding of each text."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from plexus.llm import common, packing, tokenfile
from plexus.llm.encode import Encoder
from plexus.llm.registry import TOKENIZER, op1_token_files, op9_best_fit_packing
from tests.conftest import SF_SMALL
from tests.llm.conftest import ODD

PLAIN = Tokenizer.from_file(TOKENIZER)


def plain(text, end):
    return np.array(PLAIN.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


@pytest.mark.parametrize("most", [3, 400_000])
@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_library(most, name):
    texts = [t for _, t in ODD] + ["don't, x' (a) ×÷ ª ĳ Straße.\"", "中文 字 ﬁ ÅK", "\n\n a \x1c b", " "]
    path = public_tokenizers.path(name)
    ids, counts = Encoder(path, 2, most).encode(pa.array(texts))
    ids2, _ = Encoder(path, 2, most).encode(pa.array(texts * 2).slice(len(texts)))
    assert ids.tolist() == ids2.tolist() and counts.sum() == len(ids)
    full, at = Tokenizer.from_file(path), 0
    for text, n in zip(texts, counts, strict=True):
        assert ids[at:at + n].tolist() == [*full.encode(text or "", add_special_tokens=False).ids, 2]
        at += n


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_marks_at_the_end_of_words(name):
    words = ["cafe\u0301", "re\u0301sume\u0301", "voila\u0300", "か\u3099", "ハ\u309a", "\u0627\u0653", "Vie\u0323\u0302t", "\u0958", "\u05d1\ufb1d",
             "\u0130", "\u09dc", "\u0f43", "\u1100\u1161", "가", "нет", "И\u0306", "λόγος", "ŉ", "\u212b", "x\u20dd", "a\u200d", "中", "ªº", "Ⅷ", "a\ufe0f"]
    texts = [f"{w}{end}" for w in words for end in ("", ",", "!)", "\u0301", "\u0301.", "'", "…»", " \u0301", "+\u0338", "\u037e", "\u1fef")]
    texts.append(" ".join(texts))
    path = public_tokenizers.path(name)
    ids, counts = Encoder(path, 2).encode(pa.array(texts))
    full = Tokenizer.from_file(path)
    got = [x[:-1].tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    want = [full.encode(t, add_special_tokens=False).ids for t in texts]
    assert [t for t, a, b in zip(texts, got, want, strict=True) if a != b] == []


def test_token_files_round_trip(spark, docs, tmp_path):
    shards = tokenfile.write_token_files(docs(ODD).repartition(3), TOKENIZER, common.shared_folder(spark, "t"), length=128)
    got = tokenfile.read_documents(shards).orderBy("start").collect()
    texts = dict(ODD) | {2: None}
    start = 0
    assert [r.doc_id for r in got] == [None, 1, 2, 2, 2, 3, 9, 10, 11, 12]
    for r in got:
        assert r.start == start
        start += r.n_tokens
        if r.doc_id != 2:
            ids = plain(texts[r.doc_id], 2)
            assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids))
    flow = []
    for row in shards.orderBy("shard").collect():
        file = tokenfile.TokenFile(row.ids_path)
        assert len(file) == -(-row.n_tokens // 128)
        for i in range(len(file)):
            ids, mask = file[i]
            assert len(ids) == len(mask) == 128 and not ids.flags.owndata
            flow += ids[np.array(mask)].tolist()
    assert len(flow) == start and flow[:len(plain("no id", 2))] == plain("no id", 2).tolist()


def test_token_files_of_an_empty_table(spark, docs):
    shards = tokenfile.write_token_files(docs([]), TOKENIZER, common.shared_folder(spark, "t"))
    assert tokenfile.read_documents(shards).collect() == []


def check_places(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_against_plain(spark, docs):
    rows = packing.pack(docs(ODD * 3).repartition(4), TOKENIZER, 512).collect()
    used = check_places(rows, 512)
    want = []
    for i, t in ODD * 3:
        ids = plain(t, 0)
        want += [(i, k // 512, k, len(ids[k:k + 512]), zlib.crc32(ids[k:k + 512])) for k in range(0, len(ids), 512)]
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted([tuple(r)[:5] for r in rows], key=key) == sorted(want, key=key)
    assert used <= 1.05 * sum(w[3] for w in want) / 512 + 1
    assert packing.pack(docs([]), TOKENIZER).collect() == []


def test_registered_queries(spark):
    import duckdb

    texts = dict(duckdb.execute(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall())
    got, start = op1_token_files(spark, SF_SMALL).orderBy("doc_id").collect(), 0
    assert [r.doc_id for r in got] == sorted(texts)
    for r in got:
        ids = plain(texts[r.doc_id], 2)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids))
        start += len(ids)
    rows = op9_best_fit_packing(spark, SF_SMALL).collect()
    total = sum(len(plain(t, 0)) for t in texts.values())
    assert sum(r.length for r in rows) == total
    assert check_places(rows, 2048) <= 1.02 * total / 2048 + 1
