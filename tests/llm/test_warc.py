"""Archives: round trip, record types, container format."""

import base64
import hashlib
import struct

import duckdb
import zstandard

from plexus.llm import common, warc
from plexus.llm.registry import op10_warc_archives
from tests.conftest import SF_SMALL


def want(pages, least=0):
    largest = {}
    for i, _, html in pages:
        payload = (html or "").encode()
        if i is not None:
            largest[payload] = max(largest.get(payload, i), i)
    out = []
    for i, _, html in pages:
        payload = (html or "").encode()
        keeper = largest.get(payload) if len(payload) >= least else None
        revisit = keeper is not None and keeper != i
        out.append((i, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                    "revisit" if revisit else "response", keeper if revisit else None))
    return sorted(out, key=str)


ODD = [(1, "http://a", None), (2, None, ""), (3, "http://ä b\n", "<p>é</p>"), (4, "u", "<p>é</p>"), (4, "u", "<p>é</p>"),
       (None, "u", "<p>é</p>"), (None, "u", "alone"), (5, "u", "x" * 3_000_000), (6, "u", "\r\n\r\nWARC/1.1\r\n")]


def test_odd_pages(spark):
    for rows in (ODD, []):
        pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, keeper string")
        for least in (0, 5):
            files = warc.write_archives(pages.repartition(3), common.shared_folder(spark, "w"), least)
            got = sorted((tuple(r)[:5] for r in warc.read_archives(files).collect()), key=str)
            assert got == want(rows, least)


def test_container(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<html><head><title>page {i}</title></head><body>{'row ' * 50}{i}</body></html>")
                                   for i in range(500)], "page_id long, url string, html string")
    files = warc.write_archives(pages.coalesce(1), common.shared_folder(spark, "w")).collect()
    plain = sum(len(r.html) for r in pages.collect())
    for f in files:
        data = open(f.file.removeprefix("file:"), "rb").read()
        magic, size = struct.unpack("<II", data[:8])
        assert (magic, data[8:12], len(data)) == (0x184D2A5D, warc.DICTIONARY_MAGIC, f.n_bytes)
        first = zstandard.get_frame_parameters(data[8 + size:])
        assert first.dict_id == zstandard.ZstdCompressionDict(data[8:8 + size]).dict_id() != 0
        assert len(data) - 8 - size < plain
        assert sum(1 for _ in warc.frames(f.file)) == f.n_records


def test_registered_query(spark):
    pages = duckdb.execute(f"SELECT page_id, url, html FROM '{SF_SMALL}/pages.parquet'").fetchall()
    assert sorted((tuple(r) for r in op10_warc_archives(spark, SF_SMALL).collect()), key=str) == want(pages)
