"""WARC archives as seekable Zstandard bundles, written and read by tasks.

``write`` stores one record per page: records are grouped into independent Zstandard frames of
about ``FRAME_BYTES``, frames are appended to a bundle until it has ``BUNDLE_BYTES``, and a bundle
ends with a footer seek table (a skippable frame holding the sizes of all frames). The returned
index maps each record identifier to its bundle, frame and offset inside the frame, so ``fetch``
reads one frame per record and ``read`` spreads the frames of all bundles over tasks.

Pages with equal payloads of at least ``MIN_REVISIT`` bytes are stored once: that of the largest
page_id is the ``response``, the others are ``revisit`` records that refer to it. Only (page_id,
digest, size) is grouped, with partial maxima before the shuffle; pages meet their decision by page_id,
so that a payload that many pages share does not meet in one task.

Bundles go to the shared folder under names of their own and count only when the index names
them: a task that is run again leaves an unnamed file, never a double record. The folder may be
on any file system that pyarrow opens by URI.

Nulls: null html is an empty payload, null page_id or url leave out their header (and read back as
null); a null page_id is never the one referred to. Repeated rows of one page are all of the same
kind. Empty table: no bundle, no rows.
"""
from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, parallel, scratch_path, ship, table

MIN_REVISIT = 1000
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 512 << 20
# fixed values of the seekable Zstandard format
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "bundle string, frame int, frame_at bigint, frame_bytes int, offset bigint, length bigint, record_id string, page_id bigint"
RECORD = ("bundle string, frame int, offset bigint, record_id string, record_type string, page_id bigint, url string, "
          "payload_bytes bigint, payload_digest string, refers_to bigint")


def _arrow(ddl: str) -> list[tuple]:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
    return [(name, kinds[kind]) for name, kind in map(str.split, ddl.split(", "))]


def payload(html: Column) -> Column:
    return F.encode(F.coalesce(html, F.lit("")), "UTF-8")


def decide(pages: DataFrame) -> DataFrame:
    """``page_id, digest, refers_to`` of the pages to be stored as revisits."""
    p = payload(F.col("html"))
    seen = materialize(pages.sparkSession, pages.select(
        "page_id", F.sha1(p).alias("digest"), F.octet_length(p).alias("size")).where(F.col("size") >= MIN_REVISIT), "digests")
    best = seen.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    shared = best.where((F.col("n") > 1) & F.col("refers_to").isNotNull()).drop("n")
    return (seen.join(shared, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
            .select("page_id", "digest", "refers_to").distinct())


def _record_id(page_id, digest: str) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{digest}')}"


def _record(page_id, url, body: bytes, refers_to, digest: bytes, date: str) -> tuple[str, bytes]:
    rid = _record_id(page_id, digest.hex())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + body
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{rid}>",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
            "Content-Type: application/http; msgtype=response"]
    if url is not None:     # control characters would end the header
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{_record_id(refers_to, digest.hex())}>",
                 f"Refers-To-Page-ID: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return rid, "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _file_system(uri: str):
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


class _Bundle:
    """One bundle being written: a frame in memory, the sizes of those before it, the index rows."""

    def __init__(self, folder: str, level: int, frame_bytes: int):
        import zstandard

        self.uri = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        files, path = _file_system(self.uri)
        files.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out, self.zip = files.open_output_stream(path, compression=None), zstandard.ZstdCompressor(level=level)
        self.frame_bytes = frame_bytes
        self.at, self.frame, self.sizes, self.rows, self.pending = 0, bytearray(), [], [], []

    def add(self, rid: str, page_id, raw: bytes) -> None:
        self.pending.append((len(self.frame), len(raw), rid, page_id))
        self.frame += raw
        if len(self.frame) >= self.frame_bytes:
            self.flush()

    def flush(self) -> None:
        if not self.frame:
            return
        packed = self.zip.compress(bytes(self.frame))
        self.out.write(packed)
        no = len(self.sizes)
        self.rows += [(self.uri, no, self.at, len(packed), *p) for p in self.pending]
        self.sizes.append((len(packed), len(self.frame)))
        self.at += len(packed)
        self.frame, self.pending = bytearray(), []

    def close(self) -> list[tuple]:
        self.flush()
        table_ = b"".join(struct.pack("<II", a, b) for a, b in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table_)) + table_)
        self.out.close()
        return self.rows


def write(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", level: int = 3,
          frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write every row of ``pages`` (page_id, url, html; other columns are ignored) into bundles
    under ``folder``; returns the stored index. ``date`` is the WARC-Date of all records."""
    spark = pages.sparkSession
    ship(spark)
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    a, b = p.withColumn("digest", F.sha1(payload(F.col("html")))).alias("a"), decide(pages).alias("b")
    same = F.col("a.page_id").eqNullSafe(F.col("b.page_id")) & (F.col("a.digest") == F.col("b.digest"))
    rows = a.join(b, same, "left").select("a.page_id", "a.url", "a.html", "b.refers_to")
    schema = pa.schema(_arrow(INDEX))

    def index(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)],
                                          schema=schema)

    def run(batches):
        bundle = None
        for batch in batches:
            for i in range(batch.num_rows):     # one page's text at a time
                page_id, url, html, refers_to = (c[i].as_py() for c in batch.columns)
                body = html.encode()
                bundle = bundle or _Bundle(folder, level, frame_bytes)
                rid, raw = _record(page_id, url, body, refers_to, hashlib.sha1(body).digest(), date)
                bundle.add(rid, page_id, raw)
                if bundle.at >= bundle_bytes:
                    yield index(bundle.close())
                    bundle = None
        if bundle:
            yield index(bundle.close())

    return materialize(spark, rows.mapInArrow(run, INDEX), "warc-index")


def seek_table(uri: str) -> list[tuple[int, int, int, int]]:
    """(frame, at, packed size, size) of every frame, from the footer alone."""
    files, path = _file_system(uri)
    with files.open_input_file(path) as f:
        size = f.size()
        f.seek(size - 9)
        n, _, magic = struct.unpack("<IBI", f.read(9))
        if magic != SEEKABLE:
            raise ValueError(f"{uri}: no seek table")
        f.seek(size - 9 - 8 * n)
        sizes = struct.unpack(f"<{2 * n}I", f.read(8 * n))
    out, at = [], 0
    for i in range(n):
        out.append((i, at, sizes[2 * i], sizes[2 * i + 1]))
        at += sizes[2 * i]
    return out


def _frame(uri: str, at: int, size: int) -> bytes:
    import zstandard

    files, path = _file_system(uri)
    with files.open_input_file(path) as f:
        f.seek(at)
        return zstandard.ZstdDecompressor().decompress(f.read(size))


def _parse(raw: bytes, at: int = 0):
    """(offset, next offset, headers, payload) of the records in a frame from ``at`` on."""
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        lines = raw[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record at this offset")
        head = dict(x.split(": ", 1) for x in lines[1:])
        block = raw[end + 4:end + 4 + int(head["Content-Length"])]
        body = block.index(b"\r\n\r\n") + 4
        head["payload-bytes"] = int(re.search(rb"Content-Length: (\d+)", block[:body])[1])
        after = end + 4 + len(block) + 4
        yield at, after, head, block[body:]
        at = after


def _row(uri, frame, offset, head, body) -> tuple:
    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:"))
    if head["WARC-Type"] == "response" and (hashlib.sha1(body).digest() != digest or len(body) != head["payload-bytes"]):
        raise ValueError(f"{uri}, frame {frame}, offset {offset}: payload differs from its digest")
    number = lambda k: int(head[k]) if k in head else None
    return (uri, frame, offset, head["WARC-Record-ID"][1:-1], head["WARC-Type"], number("Page-ID"),
            head.get("WARC-Target-URI"), head["payload-bytes"], digest.hex(), number("Refers-To-Page-ID"))


def read(spark: SparkSession, bundles: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records of the bundles named in column ``bundle``: their headers, checked digest and
    (``with_payload``) payload, null for revisits. Frames are listed from the seek tables and dealt out."""
    def frames(batches):
        for batch in batches:
            for uri in batch.column("bundle").to_pylist():
                t = seek_table(uri)
                yield pa.RecordBatch.from_pydict({"bundle": pa.array([uri] * len(t)), **{
                    k: pa.array([x[i] for x in t], pa.int64()) for i, k in enumerate(("frame", "at", "packed", "size"))}})

    def records(batches):
        for batch in batches:
            for f in batch.to_pylist():     # a frame at a time
                found = [(_row(f["bundle"], f["frame"], o, h, b), b if h["WARC-Type"] == "response" else None)
                         for o, _, h, b in _parse(_frame(f["bundle"], f["at"], f["packed"]))]
                cols = [*zip(*(r for r, _ in found), strict=True)] + ([[b for _, b in found]] if with_payload else [])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    ship(spark)
    schema = pa.schema([*_arrow(RECORD), *([("payload", pa.binary())] if with_payload else [])])
    listed = (bundles.select("bundle").distinct()
              .mapInArrow(frames, "bundle string, frame bigint, at bigint, packed bigint, size bigint"))
    n = parallel(spark)
    return listed.repartition(n, "bundle", "frame").mapInArrow(records, RECORD + ", payload binary" * with_payload)


def fetch(index: DataFrame, record_ids: DataFrame) -> DataFrame:
    """(record_id, payload) of the wanted identifiers: one ranged read of one frame per record."""
    ship(index.sparkSession)

    def run(batches):
        for batch in batches:
            got = []
            for r in batch.to_pylist():
                raw = _frame(r["bundle"], r["frame_at"], r["frame_bytes"])[r["offset"]:r["offset"] + r["length"]]
                got.append(next(_parse(raw))[3])
            yield pa.RecordBatch.from_arrays([batch.column("record_id"), pa.array(got, pa.binary())], ["record_id", "payload"])

    return (index.join(record_ids.select("record_id").distinct(), "record_id")
            .mapInArrow(run, "record_id string, payload binary"))


def query(spark, sf_dir):
    index = write(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    r = read(spark, index, with_payload=False)
    return r.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT payload_digest, max(page_id) AS top FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND top <> page_id THEN top END AS refers_to
FROM p LEFT JOIN m USING (payload_digest)
"""
