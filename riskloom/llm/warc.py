"""WARC archives of pages with an index written first, and reads by coalesced byte ranges.

Writing: payload digests decide which record is a response and which a revisit; each task
then writes one archive, a gzip member per record, and returns an index row per record. The
index is settled before any read, so it names only archives of tasks that ended well.
Reading: the selected index rows, sorted by archive and offset, are merged into ranges; each
range is one read, from which the records are cut and parsed.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import CHUNK_BYTES, chunks, pieces, ready, settle
from riskloom.session import scratch_path

SALTS = 16
MIN_REVISIT = 1000
GAP_BYTES = 64 << 10
INDEX = "file string, offset long, length long, page_id long, url string, payload_digest string, record_type string"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def _roles(pages: DataFrame, least: int) -> DataFrame:
    """Pages with payload, digest and the page each revisit refers to."""
    full = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"digest": F.sha1("payload"), "size": F.length("payload")})
    # one row for each payload that occurs twice at least, copied so that a hot digest is dealt out
    keepers = (
        full.where(F.col("size") >= least).groupBy("digest", "size")
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1 and keeper is not null")
        .select("digest", "size", "keeper", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    salted = full.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    joined = salted.join(keepers.hint("shuffle_hash"), ["digest", "size", "salt"], "left")
    return joined.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper"))).select(
        "page_id", "url", "digest", "refers_to", "payload"
    )


def _record_id(page: int | None) -> str:
    return f"<urn:page:{'unknown' if page is None else page}>"


def _record(page: int | None, url: str | None, digest: str, refers_to: int | None, payload: bytes, date: str) -> bytes:
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_record_id(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _write(batches: Iterator[pa.RecordBatch], folder: str, date: str) -> Iterator[pa.RecordBatch]:
    fs, base = pafs.FileSystem.from_uri(folder)
    name, out, offset = f"{uuid.uuid4().hex}.warc.gz", None, 0  # a retried task writes another file
    try:
        for chunk in chunks(batches, "payload"):
            if out is None:
                fs.create_dir(base, recursive=True)
                out = fs.open_output_stream(f"{base}/{name}", compression=None)
            rows = []
            for page, url, digest, refers_to, payload in zip(*(c.to_pylist() for c in chunk.columns)):
                data = _gzip(_record(page, url, digest, refers_to, payload, date))
                out.write(data)
                rows.append((name, offset, len(data), page, url, digest, "response" if refers_to is None else "revisit"))
                offset += len(data)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()))],
                ["file", "offset", "length", "page_id", "url", "payload_digest", "record_type"],
            )
    finally:
        if out is not None:
            out.close()


def write_archives(pages: DataFrame, folder: str | None = None, least: int = MIN_REVISIT, date: str = "1970-01-01T00:00:00Z") -> tuple[DataFrame, str]:
    """Writes an archive per task below ``folder``; returns the settled index and the folder.

    ``pages`` has page_id, url and html; other columns are ignored. Of records with equal
    payloads of at least ``least`` bytes, the one with the largest page_id is the response,
    the others revisit it. A null html is an empty payload, a null url leaves its header out.
    A row without page_id is a response unless its payload belongs to a page that has one;
    rows that repeat the response's page_id and payload are responses too.

    A payload of any length is one record, held by one task. An empty table gives an empty index.
    """
    ready(pages.sparkSession)
    folder = folder or scratch_path(pages.sparkSession, "warc")
    index = _roles(pages, least).mapInArrow(lambda it: _write(it, folder, date), INDEX)
    return settle(index, "warc-index"), folder


_HEAD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")
_PAGE = re.compile(rb"<urn:page:(-?\d+)>")


def _page(value: bytes | None) -> int | None:
    m = _PAGE.fullmatch(value or b"")
    return int(m[1]) if m else None


def parse(record: bytes) -> tuple:
    """The columns of RECORDS from one gzip member."""
    data = zlib.decompress(record, 31)
    head, _, block = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1."):
        raise ValueError("no WARC record at this offset")
    fields = dict(_HEAD.findall(head + b"\r\n"))
    block = block[: int(fields[b"Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(_HEAD.findall(http + b"\r\n"))[b"Content-Length"])
    digest = base64.b32decode(fields[b"WARC-Payload-Digest"].removeprefix(b"sha1:")).hex()
    kind = fields[b"WARC-Type"].decode()
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("payload and digest differ")
    url = fields.get(b"WARC-Target-URI")
    return (
        _page(fields[b"WARC-Record-ID"]), size, digest, kind, _page(fields.get(b"WARC-Refers-To")),
        None if url is None else url.decode(), payload if kind == "response" else None,
    )


def ranges(rows: list[tuple[str, int, int]], gap: int, most: int) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Sorted (file, offset, length) merged: file, from, to and the records inside."""
    held = None
    for file, offset, length in rows:
        if held and held[0] == file and offset - held[2] <= gap and offset + length - held[1] <= most:
            held[3].append((offset, length))
            held = (file, held[1], max(held[2], offset + length), held[3])
        else:
            if held:
                yield held
            held = (file, offset, offset + length, [(offset, length)])
    if held:
        yield held


def _read(batches: Iterator[pa.RecordBatch], folder: str, gap: int, with_payload: bool) -> Iterator[pa.RecordBatch]:
    fs, base = pafs.FileSystem.from_uri(folder)
    name, opened = None, None
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
    for batch in batches:
        rows = list(zip(*(c.to_pylist() for c in batch.columns)))
        for file, start, stop, records in ranges(rows, gap, CHUNK_BYTES):
            if file != name:
                if opened:
                    opened.close()
                name, opened = file, fs.open_input_file(f"{base}/{file}")
            opened.seek(start)
            data = opened.read(stop - start)
            found = [parse(data[o - start : o - start + n]) for o, n in records]
            columns = list(zip(*found))[: 7 if with_payload else 6]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], [x.split()[0] for x in RECORDS.split(", ")][: len(columns)])
    if opened:
        opened.close()


def read_records(selected: DataFrame, folder: str, gap: int = GAP_BYTES, with_payload: bool = True) -> DataFrame:
    """The records of the selected index rows, read in merged byte ranges.

    Ranges at most ``gap`` bytes apart are one read of at most 4 MB; a longer record is read
    alone. Payloads are checked against their digests.

    - A row with a null file, offset or length names no record and gives none. A row given twice
      is read and returned twice. No rows give no records.
    """
    n = pieces(selected.sparkSession)
    named = selected.select("file", "offset", "length").dropna()
    sorted_rows = named.repartitionByRange(n, "file", "offset").sortWithinPartitions("file", "offset")
    schema = RECORDS if with_payload else RECORDS.removesuffix(", payload binary")
    return sorted_rows.mapInArrow(lambda it: _read(it, folder, gap, with_payload), schema)
