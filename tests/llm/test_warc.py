"""WARC bundles: round trip, seek tables, revisits, record lookup."""
import hashlib

import pytest

from lakeshore.llm import warc
from lakeshore.llm.common import table

from .cases import SF

SCHEMA = "page_id bigint, url string, html string, digest string, extra int"
BIG = "<p>" + "é" * 1500
ROWS = [(1, "http://a/1", BIG, "x", 1), (9, "http://a/9", BIG, "x", 1), (5, None, BIG, "x", 1), (5, None, BIG, "x", 1), (None, "http://n", BIG, "x", 1),
        (2, "http://a/ 2\r\nX: y", "short", "x", 1), (3, "http://a/3", "short", "x", 1), (4, "u", None, None, None), (6, "", "", "x", 1),
        (7, "u7", "a" * 999, "x", 1), (8, "u8", "a" * 999, "x", 1), (10, "u", "a" * 1000, "x", 1), (11, "u", "a" * 1000, "x", 1),
        (12, "http://a/12", "z" * 3_000_000, "x", 1)]


def expected(rows):
    best = {}
    for page, _, html, *_ in rows:
        b = (html or "").encode()
        if page is not None and len(b) >= warc.MIN_REVISIT:
            best[b] = max(page, best.get(b, page))
    out = []
    for page, _, html, *_ in rows:
        b = (html or "").encode()
        to = best.get(b) if best.get(b) != page else None
        out.append((page, len(b), hashlib.sha1(b).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=repr)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def test_edges(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    index = warc.write(pages, str(tmp_path / "w"), frame_bytes=3000, bundle_bytes=1000)
    assert index.count() == len(ROWS)
    records = warc.read(spark, index)
    assert sorted((tuple(r) for r in records.select(*COLUMNS).collect()), key=repr) == expected(ROWS)
    html = {r.page_id: r.payload for r in records.where("record_type = 'response'").collect()}
    assert html[9] == BIG.encode() and html[4] == b"" and html[12] == b"z" * 3_000_000
    urls = {r.page_id: r.url for r in records.collect()}
    assert urls[5] is None and urls[2] == "http://a/%202%0D%0AX:%20y" and urls[1] == "http://a/1"


def test_frames_are_independent(spark, tmp_path):
    zstandard = pytest.importorskip("zstandard")
    index = warc.write(spark.createDataFrame(ROWS, SCHEMA).coalesce(1), str(tmp_path / "w"), frame_bytes=3000)
    for bundle in {r.bundle for r in index.collect()}:
        frames = warc.seek_table(bundle)
        assert len(frames) > 1
        whole = b"".join(warc._frame(bundle, at, packed) for _, at, packed, _ in frames)
        assert [len(warc._frame(bundle, at, packed)) for _, at, packed, _ in frames] == [s for *_, s in frames]
        with open(bundle, "rb") as f:       # a reader that knows nothing of the seek table skips it
            assert zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read() == whole
    wanted = index.where("page_id IN (9, 12)").select("record_id")
    got = {r.record_id: r.payload for r in warc.fetch(index, wanted).collect()}
    assert sorted(map(len, got.values())) == [len(BIG.encode()), 3_000_000]


def test_damage_is_noticed(spark, tmp_path):
    index = warc.write(spark.createDataFrame(ROWS[:1], SCHEMA), str(tmp_path / "w"))
    bundle = index.first().bundle
    data = bytearray(open(bundle, "rb").read())
    data[-1] ^= 1
    with open(bundle, "wb") as f:
        f.write(data)
    with pytest.raises(ValueError):
        warc.seek_table(bundle)


def test_empty_and_tables(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    assert warc.read(spark, warc.write(none, str(tmp_path / "n"))).count() == 0
    rows = [(r.page_id, r.url, r.html) for r in table(spark, SF, "pages").collect()]
    assert sorted((tuple(r) for r in warc.query(spark, SF).select(*COLUMNS).collect()), key=repr) == expected(rows)
