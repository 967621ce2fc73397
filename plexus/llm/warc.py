"""WARC archives compressed with a shared Zstandard dictionary.

A file starts with a skippable frame (magic 0x184D2A5D) that holds the
dictionary; every record after it is a frame of its own, so a record can be
read from its offset with the file's dictionary.  A page whose payload equals
another's is archived as a ``revisit`` of the one with the largest id."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.llm import common

# The container format and the revisit profile.
DICTIONARY_FRAME = 0x184D2A5D
DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DATE = "1970-01-01T00:00:00Z"
FILES = "file string, n_records long, n_bytes long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_types(pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """Pages with ``keeper``: the largest page id with this payload (null where
    the page has it itself, or where the payload is shorter than ``least_bytes``).

    The keepers are counted by payload digest with map-side aggregation and
    written; only payloads seen more than once are joined, as a shuffle join
    that can split a payload shared by very many pages."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html")).withColumn("sha", F.sha1("html"))
    keepers = rows.filter(F.octet_length("html") >= least_bytes).groupBy("sha").agg(
        F.max("page_id").alias("keeper"), F.max_by("url", "page_id").alias("keeper_url"), F.count("*").alias("n"))
    keepers = common.stored(keepers.filter("n > 1").drop("n"), "payload-keepers")
    own = F.col("page_id").eqNullSafe(F.col("keeper"))
    return rows.join(keepers, "sha", "left").select(
        "page_id", "url", "html", F.when(~own, F.col("keeper")).alias("keeper"),
        F.when(~own, F.col("keeper_url")).alias("keeper_url"))


def train_dictionary(pages: DataFrame, size: int = 64 << 10, samples: int = 2000, sample_chars: int = 8192,
                     id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> bytes:
    """A dictionary from a bounded sample of the records to archive, spread over
    the whole table by hash: at most ``samples``, with ``sample_chars`` of
    payload each.  Empty without records; plain content if there are too few to
    train on."""
    picked = pages.select(F.col(id_col).cast("long").alias("i"), F.col(url_col).alias("u"),
                          F.substring(F.coalesce(F.col(html_col), F.lit("")), 1, sample_chars).alias("s"))
    picked = picked.withColumn("h", F.xxhash64("i", "s"))
    # The largest hash taken comes first, from hashes alone, so that tasks send the driver no payloads but these.
    cut = picked.select("h").orderBy("h").limit(samples).agg(F.max("h")).first()[0]
    found = [record(f"sample:{k}", r.i, r.u, r.s.encode(), None, None, DATE)
             for k, r in enumerate(picked.filter(F.col("h") <= F.lit(cut)).orderBy("h", "s").limit(samples).collect())]
    try:
        return zstandard.train_dictionary(size, found).as_bytes()
    except zstandard.ZstdError:
        return b"".join(found)[-size:]


def head(n: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()


def record(name: str, page_id, url, payload: bytes, keeper, keeper_url, date: str) -> bytes:
    """The bytes of one record; a revisit (``keeper`` not null) leaves the payload out."""
    kind = "response" if keeper is None else "revisit"
    block = head(len(payload)) + (payload if keeper is None else b"")
    fields = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>", "WARC-Date": date,
              "WARC-Target-URI": url and _uri(url), "WARC-Payload-Digest": f"sha1:{digest(payload)}",
              "WARC-Profile": keeper and PROFILE, "WARC-Refers-To-Target-URI": keeper_url and _uri(keeper_url),
              "WARC-Page-ID": page_id, "WARC-Refers-To-Page-ID": keeper,
              "Content-Type": "application/http; msgtype=response", "Content-Length": len(block)}
    if keeper is not None:
        fields["WARC-Profile"] = PROFILE
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None and v != "")
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def _uri(url: str) -> str:
    """Control characters, spaces and non-ASCII letters percent-encoded."""
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~-._")


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, level: int = 3,
                   date: str = DATE, **columns) -> DataFrame:
    """Write one archive per partition; one row per file.  Null html is an empty
    payload, null url or id an absent header; repeated rows are records of
    their own (those with the largest id are all responses); an empty table
    gives no files."""
    dictionary = train_dictionary(pages, **columns)
    rows = record_types(pages, least_bytes, **columns)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        name, counts = f"pages-{TaskContext.get().partitionId():05d}.warc.zst", [0, 0]
        own = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compress = zstandard.ZstdCompressor(level=level, dict_data=own, write_content_size=True, write_checksum=True).compress

        def archive(out) -> None:
            if dictionary:
                counts[1] += out.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
            for batch in _all(first, batches):
                for page, url, html, keeper, keeper_url in zip(*(batch.column(k) for k in range(5)), strict=True):
                    payload = html.cast(pa.binary()).as_py()
                    counts[1] += out.write(compress(record(f"{name}:{counts[0]}", page.as_py(), url.as_py(), payload,
                                                           keeper.as_py(), keeper_url.as_py(), date)))
                    counts[0] += 1
        path = common.write_file(folder, name, archive)
        yield pa.RecordBatch.from_pydict({"file": [path], "n_records": [counts[0]], "n_bytes": [counts[1]]})

    return common.stored(rows.mapInArrow(write, FILES), "archives")


def _all(first, rest):
    yield first
    yield from rest


def frames(path: str) -> Iterator[bytes]:
    """The records of an archive, in order; holds one at a time."""
    with common.open_file(path) as f:
        buffer, own = f.read(8), None
        if len(buffer) == 8 and struct.unpack("<I", buffer[:4])[0] == DICTIONARY_FRAME:
            data = f.read(struct.unpack("<I", buffer[4:])[0])
            own, buffer = zstandard.ZstdCompressionDict(data), b""
        reader = zstandard.ZstdDecompressor(dict_data=own)
        while buffer or (buffer := f.read(1 << 16)):
            frame, parts = reader.decompressobj(), []
            while not frame.eof:
                if not buffer and not (buffer := f.read(1 << 16)):
                    raise ValueError(f"{path} ends within a record")
                parts.append(frame.decompress(buffer))
                buffer = b""
            buffer = frame.unused_data
            yield b"".join(parts)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record."""
    top, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = top.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines)
    block = rest[:int(fields["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    return fields, block


def read_archives(files: DataFrame) -> DataFrame:
    """One row per record read back; a response's digest is computed from its
    payload and must equal the header's."""
    tasks = max(1, min(files.sparkSession.sparkContext.defaultParallelism * 4, files.count()))
    names = [x.split()[0] for x in RECORDS.split(", ")]

    def rows(path: str) -> Iterator[tuple]:
        for data in frames(path):
            fields, block = parse(data)
            top, _, payload = block.partition(b"\r\n\r\n")
            size = int(dict(x.split(": ", 1) for x in top.decode().split("\r\n")[1:])["Content-Length"])
            kind, name = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
            if kind == "response" and (digest(payload) != name or len(payload) != size):
                raise ValueError(f"{path}: a payload differs from its digest")
            page, keeper = (fields.get(k) and int(fields[k]) for k in ("WARC-Page-ID", "WARC-Refers-To-Page-ID"))
            yield page, size, name, kind, keeper, fields.get("WARC-Target-URI")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, pa.string() if n in ("payload_digest", "record_type", "url") else pa.int64()) for n in names])
        for batch in batches:
            for path in batch.column("file").to_pylist():
                held = []
                for row in rows(path):
                    held.append(row)
                    if len(held) == 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    return files.select("file").repartition(tasks, "file").mapInArrow(read, RECORDS)
