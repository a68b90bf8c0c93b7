"""WARC archives: writing with payload de-duplication, reading as chunks.

Tasks write their partition as one archive, record by record, each record
its own gzip member; a payload is digested and written in slices.  Tasks name
archives by attempt and report them in a manifest, and only archives of the
manifest are read, so a repeated or lost task leaves nothing behind that
counts.  Reading streams every archive and returns payloads as (record,
chunk number) rows with the running digest and length, so no task holds more
than a chunk of a record.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.session import scratch_path, written

CHUNK_BYTES = 1 << 20
SLICE_CHARS = 1 << 18
FLUSH_BYTES = 8 << 20  # payload bytes of one batch of chunk rows
# The record identifiers, profile and time stamp that are written.
RECORD_URN = "urn:candlewick:page:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2024-01-01T00:00:00Z"

CHUNK_SCHEMA = ("record_id string, record_type string, target_uri string, refers_to string, "
                "header_digest string, header_length bigint, chunk_no bigint, data binary, "
                "end_offset bigint, running_digest string, last boolean")


def _fs(uri: str):
    """(file system, path) of a folder or file named by any Hadoop-style URI."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "file:///" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _b32(hasher) -> str:
    return base64.b32encode(hasher.digest()).decode()


def _slices(text: str) -> Iterator[bytes]:
    for at in range(0, len(text), SLICE_CHARS):
        yield text[at:at + SLICE_CHARS].encode()


def _header_value(v: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in v)


def write_record(out, page_id: str | None, url: str | None, html: str,
                 refers_to: str | None) -> None:
    """One record as a gzip member; a revisit of ``refers_to`` if that is given."""
    hasher, length = hashlib.sha1(), 0
    for part in _slices(html):
        hasher.update(part)
        length += len(part)
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {length}\r\n\r\n").encode()
    name = lambda i: f"<{RECORD_URN}{'' if i is None else i}>"
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {RECORD_DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_value(url)}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {name(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response",
             f"WARC-Payload-Digest: sha1:{_b32(hasher)}", f"Payload-Length: {length}",
             f"Content-Length: {len(http) + (length if refers_to is None else 0)}"]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    out.write(z.compress(("\r\n".join(head) + "\r\n\r\n").encode() + http))
    if refers_to is None:
        for part in _slices(html):
            out.write(z.compress(part))
    out.write(z.compress(b"\r\n\r\n") + z.flush())


def read_records(stream) -> Iterator[tuple]:
    """Chunk rows (columns of ``CHUNK_SCHEMA``) of an open, decompressed archive."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the start of a WARC record: {line[:60]!r}")
        head = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            key, _, value = line.partition(b":")
            head[key.decode().lower()] = value.strip().decode()
        left = int(head["content-length"])
        if head.get("content-type", "").startswith("application/http"):
            while left:
                line = stream.readline(left)
                left -= len(line)
                if not line.strip():
                    break
        digest = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
        length = head.get("payload-length")
        base = (head["warc-record-id"].strip("<>"), head["warc-type"], head.get("warc-target-uri"),
                head["warc-refers-to"].strip("<>") if "warc-refers-to" in head else None, digest,
                int(length) if length else None)
        hasher, at, no = hashlib.sha1(), 0, 0
        while True:
            data = stream.read(min(left, CHUNK_BYTES))
            if len(data) < min(left, CHUNK_BYTES):
                raise ValueError(f"record {base[0]} is cut short")
            left -= len(data)
            at += len(data)
            hasher.update(data)
            yield (*base, no, data, at, _b32(hasher), left == 0)
            no += 1
            if not left:
                break


def plan_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", *, min_bytes: int = 0) -> DataFrame:
    """(id, url, html, refers_to): rows of equal payloads of at least
    ``min_bytes`` refer to the largest id among them, which itself and all
    rows without a partner refer to nothing.  Digests are counted first,
    combined map-side; only digests that occur twice are written and joined
    back: a broadcast while they are small, else a join whose skewed payloads
    AQE splits, as one that a third of the rows share is one row of that side."""
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                        F.coalesce(payload_col, F.lit("")).alias("html"))
    base = base.withColumn("sha", F.sha1(F.encode("html", "UTF-8")))
    many = (base.where(F.octet_length("html") >= min_bytes).groupBy("sha")
            .agg(F.count("*").alias("n"), F.max("id").alias("top")).where("n > 1")
            .select(F.col("sha").alias("d_sha"), "top"))
    many = written(many, "payload-copies")
    return (base.join(many, F.col("sha") == F.col("d_sha"), "left")
            .select("id", "url", "html",
                    F.when(~F.col("top").eqNullSafe(F.col("id")), F.col("top")).alias("refers_to")))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", *, min_bytes: int = 0) -> DataFrame:
    """Write a record per row into ``folder``; returns the manifest (file,
    records, bytes), one row per archive.

    Null payload: empty; null url: no target; a null id has no number in its
    record id and never is a referred one.  Rows that repeat the largest id of
    a payload are all responses.  An empty table has an empty manifest.
    """
    planned = plan_revisits(pages, id_col, url_col, payload_col, min_bytes=min_bytes)
    planned = planned.select(F.col("id").cast("string"), "url", "html",
                             F.col("refers_to").cast("string"))

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = _fs(folder)
        out, name, records = None, f"part-{uuid.uuid4().hex}.warc.gz", 0
        for f in frames:
            for i, url, html, ref in f.itertuples(index=False):
                if out is None:
                    store.create_dir(path, recursive=True)
                    out = io.BufferedWriter(store.open_output_stream(f"{path}/{name}", compression=None), 1 << 20)
                write_record(out, i, url, html, ref)
                records += 1
        if out is not None:
            out.close()
            size = store.get_file_info(f"{path}/{name}").size
            yield pd.DataFrame({"file": [f"{folder}/{name}"], "records": [records], "bytes": [size]})

    schema = "file string, records bigint, bytes bigint"
    return written(planned.mapInPandas(write, schema), "warc-manifest")


def read_archives(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Chunk rows (``CHUNK_SCHEMA``) of the archives of a manifest."""
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import gzip

        names = [c.split()[0] for c in CHUNK_SCHEMA.split(", ")]
        for f in frames:
            for file in f["file"]:
                store, path = _fs(file)
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as raw, \
                        io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20) as stream:
                    for row in read_records(stream):
                        rows.append(row)
                        held += len(row[7])
                        if held >= FLUSH_BYTES or len(rows) >= 4096:
                            yield pd.DataFrame(rows, columns=names).astype({"header_length": "Int64"})
                            rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names).astype({"header_length": "Int64"})

    # one task per archive: by size alone the few manifest rows would share one
    files = manifest.select("file")
    return files.repartition(max(1, files.count())).mapInPandas(read, CHUNK_SCHEMA)


def op9_warc(spark, sf_dir: str) -> DataFrame:
    manifest = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"),
                              scratch_path(spark, "warc"))
    last = read_archives(spark, manifest).where("last").drop("data")
    number = lambda c: F.nullif(F.regexp_extract(c, r":(-?\d*)$", 1), F.lit("")).cast("long")
    revisit = F.col("record_type") == "revisit"
    return last.select(
        number("record_id").alias("page_id"),
        F.when(revisit, F.col("header_length")).otherwise(F.col("end_offset")).alias("payload_bytes"),
        F.when(revisit, F.col("header_digest")).otherwise(F.col("running_digest"))
         .alias("payload_digest"),
        "record_type", number("refers_to").alias("refers_to"))


OP9_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, max(page_id) OVER (PARTITION BY b) AS top,
             (unhex(sha1(b))::BIT)::VARCHAR AS bits FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + list_sum(list_transform(range(5), lambda j:
           CASE WHEN substr(bits, i * 5 + j + 1, 1) = '1' THEN 16 >> j ELSE 0 END))::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM d
"""
