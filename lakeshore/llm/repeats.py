"""Repeated fixed-length windows of a whole corpus, as a chain of Spark jobs around ``anchors``.

1. ``runs``: tasks scan the texts. Runs with equal key and content meet in the task first; the
   earliest stays as an entry, the rest is settled there (its windows all occur earlier). Entries go,
   as packed arrays, to the segment of their key.
2. A segment groups its entries by (key, content). Equal runs are settled. Only where one key
   has several contents can a window of one run equal a window of another: their earliest runs are *asked*.
3. Asked runs fetch their content by document and meet by key once more; the operator compares
   their windows (``settle``).
4. Settled spans are grouped by document and joined to the texts.

Hot keys: what many documents share is one entry per task, not one per document. A key that has more
than ``HOT_CONTENTS`` contents in one task (a frequent line between ever-changing neighbours) is
spread: its entries are dealt out by content, and its asked windows one by one by their own hash,
pre-aggregated per task. Nothing is dropped, and no group has to fit one task.

Rows are told by (doc_id, text hash): a null doc_id sorts before all others, rows that share a
doc_id do not precede one another.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import gather, gram_hashes, merge_spans, scan, window_hashes
from .common import byte_sizes, fresh, materialize, parallel, ship, sub_batches, tidied

HOT_CONTENTS = 64
TASK_BYTES = 16 << 20       # text that a task handles at once (packed text: a quarter of it)
NULL_ID = -(1 << 63)
SPAN, ASK, ASK_TWICE, HOT = 0, 1, 2, 4          # kinds of step 2's rows; HOT is added to the asks
ENTRY = {"key": np.uint64, "content": np.uint64, "doc": np.int64, "th": np.int32, "start": np.int32, "count": np.int32,
         "times": np.uint8, "hot": np.uint8}
CONTEXT = {"key": np.uint64, "doc": np.int64, "th": np.int32, "start": np.int32, "count": np.int32, "times": np.uint8,
           "body": np.uint8}
MARKER = np.uint64(0)                           # content of the entry that tells a segment of a hot key


@dataclass(frozen=True)
class Search:
    """What is searched: how texts become tokens, window length and q, whether the earliest
    window of equals stays, and how asked contexts are settled."""
    tokens: Callable            # list of texts -> (tokens, edges)
    hashed: Callable            # tokens -> 64-bit hashes
    length: int
    q: int
    first_stays: bool
    body: Callable              # (tokens, hashes, start, count) of a run -> bytes kept for settle
    settle: Callable            # contexts -> (index of context, first window, windows) of settled windows
    likely: Callable | None = None      # packed rows of a segment -> mask of entries worth grouping
    hot_contents: int = HOT_CONTENTS


def _pack(rows: dict[str, np.ndarray], seg: np.ndarray, names) -> Iterator[pa.RecordBatch]:
    """One row of packed arrays for each segment."""
    if not len(seg):
        return
    order = np.argsort(seg, kind="stable")
    seg = seg[order]
    first = np.flatnonzero(np.append(True, seg[1:] != seg[:-1]))
    ends = np.append(first[1:], len(seg))
    cols = {k: rows[k][order] for k in names if k != "body"}
    out = {"seg": pa.array(seg[first].astype(np.int32))}
    for k, v in cols.items():
        out[k] = pa.array([v[a:b].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary())
    if "body" in names:
        bodies = [rows["body"][i] for i in order.tolist()]
        out["size"] = pa.array([np.array([len(x) for x in bodies[a:b]], np.int32).tobytes() for a, b in zip(first, ends, strict=True)], pa.binary())
        out["body"] = pa.array([b"".join(bodies[a:b]) for a, b in zip(first, ends, strict=True)], pa.binary())
    yield pa.RecordBatch.from_pydict(out)


def _packed_schema(names) -> str:
    return "seg int, " + ", ".join(f"{k} binary" for k in ([k for k in names if k != "body"] + (["size", "body"] if "body" in names else [])))


def _segments(batches) -> Iterator[list[dict]]:
    """The packed rows of each segment (rows come sorted by segment)."""
    rows = (r for batch in batches for r in batch.to_pylist())
    for _, group in groupby(rows, key=lambda r: r["seg"]):
        yield list(group)


def _column(rows: list[dict], name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(r[name] for r in rows), kind)


def _spans(doc, th, kind, key, start, count) -> pa.RecordBatch:
    full = lambda x, t: pa.array(np.broadcast_to(np.asarray(x), np.shape(doc)).astype(t))
    return pa.RecordBatch.from_pydict({"doc": full(doc, np.int64), "th": full(th, np.int32), "kind": full(kind, np.int32),
                                       "key": full(key.view(np.int64) if isinstance(key, np.ndarray) else key, np.int64),
                                       "start": full(start, np.int32), "count": full(count, np.int32)})


SPANS = "doc bigint, th int, kind int, key bigint, start int, count int"


def _number(seg_of: np.ndarray, n: int) -> np.ndarray:
    return ((seg_of >> np.uint64(20)) % np.uint64(n)).astype(np.int64)


def _by_doc(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row order by document, and the sorted ids and text hashes."""
    doc, th = (np.asarray(batch.column(c)) for c in ("doc", "th"))
    order = np.argsort(doc, kind="stable")
    return order, doc[order], th[order]


def _local(search: Search, runs, doc, th) -> tuple[dict, tuple]:
    """Entries (the earliest run of each key and content, with how often it was seen, 2 at most) and the
    settled spans of the others."""
    group = runs.key * np.uint64(0x9E3779B97F4A7C15) ^ runs.content
    order = np.argsort(group, kind="stable")        # documents and positions stay in order
    g = group[order]
    first = np.append(True, g[1:] != g[:-1])
    rep, nth = order[first], np.cumsum(first) - 1
    times = np.minimum(np.bincount(nth), 2)
    head = rep[nth]
    # the same row given twice is neither earlier nor later
    later = ~first & ~((doc[runs.doc[order]] == doc[runs.doc[head]]) & (runs.start[order] == runs.start[head]))
    rest = order[later]
    spans = merge_spans(runs.doc[rest], runs.start[rest], runs.count[rest])
    d = runs.doc[rep]
    entries = {"key": runs.key[rep], "content": runs.content[rep] | np.uint64(1), "doc": doc[d], "th": th[d],
               "start": runs.start[rep], "count": runs.count[rep], "times": times}
    return entries, spans


def _scan_task(search: Search, segments: int) -> Callable:
    def run(batches):
        for batch in (part for b in batches for part in sub_batches(b, byte_sizes(b, "text"), TASK_BYTES)):
            order, doc, th = _by_doc(batch)
            tokens, edges = search.tokens(batch.column("text").take(pa.array(order)))
            runs = scan(tokens, search.hashed, edges, search.length, search.q)
            e, (sd, ss, sc) = _local(search, runs, doc, th)
            _, inverse, contents = np.unique(e["key"], return_inverse=True, return_counts=True)
            hot = contents[inverse] > search.hot_contents if len(inverse) else np.zeros(0, bool)
            e["hot"] = hot
            seg_of = np.where(hot, e["key"] * np.uint64(0xC2B2AE3D27D4EB4F) ^ e["content"], e["key"])
            if hot.any():
                keys = np.unique(e["key"][hot])
                more = {"key": keys, "content": np.full(len(keys), MARKER), "hot": np.ones(len(keys), bool)}
                e = {k: np.concatenate([v, more.get(k, np.zeros(len(keys), v.dtype))]) for k, v in e.items()}
                seg_of = np.concatenate([seg_of, keys])
            e = {k: v.astype(ENTRY[k]) for k, v in e.items()}
            yield from _pack(e, _number(seg_of, segments), ENTRY)
            if len(sd):     # settled spans travel as entries without a count of their own
                s = {k: np.zeros(len(sd), t) for k, t in ENTRY.items()}
                s |= {"doc": doc[sd], "th": th[sd], "start": ss.astype(np.int32), "count": sc.astype(np.int32)}
                seg = _number(doc[sd].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), segments)
                yield from _pack({k: v.astype(ENTRY[k]) for k, v in s.items()}, seg, ENTRY)
    return run


def _segment_task(search: Search) -> Callable:
    def run(batches):
        for rows in _segments(batches):
            e = {k: _column(rows, k, t) for k, t in ENTRY.items()}
            settled = (e["times"] == 0) & (e["content"] == 0) & (e["hot"] == 0)
            if settled.any():
                yield _spans(*(e[k][settled] for k in ("doc", "th")), SPAN, 0, *(e[k][settled] for k in ("start", "count")))
            use = ~settled
            if search.likely is not None:
                use &= search.likely(rows, e)
            e = {k: v[use] for k, v in e.items()}
            if not len(e["key"]):
                continue
            order = np.lexsort((e["start"], e["doc"], e["content"], e["key"]))
            e = {k: v[order] for k, v in e.items()}
            marker = e["content"] == MARKER
            new_key = np.append(True, e["key"][1:] != e["key"][:-1])
            first = new_key | np.append(True, e["content"][1:] != e["content"][:-1])
            klass, nth_key = np.cumsum(first) - 1, np.cumsum(new_key) - 1
            rep = np.flatnonzero(first)
            total = np.bincount(klass, weights=e["times"])
            hot = np.bincount(nth_key, weights=e["hot"])[nth_key] > 0
            several = (np.bincount(nth_key[rep])[nth_key] > 1) | hot
            head = rep[klass]
            if search.first_stays:
                span = ~first & ((e["doc"] != e["doc"][head]) | (e["start"] != e["start"][head]))
                ask = first & several & ~marker
                kind = np.full(len(first), ASK)
            else:
                span = (total[klass] >= 2) & ~marker
                ask = first & several & ~marker
                kind = np.where(total[klass] >= 2, ASK_TWICE, ASK)
            kind = kind + HOT * hot
            cols = lambda m: [e[k][m] for k in ("doc", "th")]
            if span.any():
                yield _spans(*cols(span), SPAN, 0, e["start"][span], e["count"][span])
            if ask.any():
                yield _spans(*cols(ask), kind[ask], e["key"][ask], e["start"][ask], e["count"][ask])
    return run


def _context_task(search: Search, segments: int) -> Callable:
    """Texts with their asked runs -> contexts, packed by segment."""
    def run(batches):
        for batch in (part for b in batches for part in sub_batches(b, byte_sizes(b, "packed"), TASK_BYTES // 4)):
            order, doc, th = _by_doc(batch)
            batch = batch.take(pa.array(order))
            tokens, edges = search.tokens(unpacked(batch.column("packed")))
            asks = batch.column("asks")
            row = np.repeat(np.arange(batch.num_rows), np.asarray(pc.list_value_length(asks)))
            a = {f.name: np.asarray(c) for f, c in zip(asks.flatten().type, asks.flatten().flatten(), strict=True)}
            order = np.lexsort((a["start"], row))
            row, a = row[order], {k: v[order] for k, v in a.items()}
            c: dict[str, list] = {k: [] for k in CONTEXT}
            windows: dict[str, list] = {"hash": [], "row": [], "start": [], "times": []}
            for r, kind, key, start, count in zip(row.tolist(), *(a[k].tolist() for k in ("kind", "key", "start", "count")), strict=True):
                part = tokens[edges[r] + start:edges[r] + start + count + search.length - 1]
                times = 2 if kind & ASK_TWICE else 1
                if kind & HOT:
                    grams = gram_hashes(search.hashed(part), search.q)
                    windows["hash"].append(window_hashes(grams, np.arange(count), search.length, search.q))
                    windows["row"].append(np.full(count, r))
                    windows["start"].append(start + np.arange(count))
                    windows["times"].append(np.full(count, times))
                else:
                    for k, v in zip(CONTEXT, (key, doc[r], th[r], start, count, times, search.body(part, count)), strict=True):
                        c[k].append(v)
            if windows["hash"]:
                yield from _hot_windows(search, tokens, edges, doc, th, {k: np.concatenate(v) for k, v in windows.items()}, segments)
            if c["key"]:
                packed = {k: np.array(v, np.int64).view(np.uint64) if k == "key" else v if k == "body" else np.array(v, t)
                          for (k, t), v in zip(CONTEXT.items(), c.values(), strict=True)}
                yield from _pack(packed, _number(packed["key"], segments), CONTEXT)
    return run


def _hot_windows(search, tokens, edges, doc, th, w, segments) -> Iterator[pa.RecordBatch]:
    """Windows of hot keys one by one, pre-aggregated: of equal windows the earliest goes on with
    their count; the others are settled here (packed as contexts of count 0 windows to compare)."""
    order = np.argsort(w["hash"], kind="stable")
    w = {k: v[order] for k, v in w.items()}
    first = np.append(True, w["hash"][1:] != w["hash"][:-1])
    nth = np.cumsum(first) - 1
    total = np.bincount(nth, weights=w["times"])
    rep = np.flatnonzero(first)
    head = rep[nth]
    same = (doc[w["row"]] == doc[w["row"][head]]) & (w["start"] == w["start"][head])
    later = ~first & ~same if search.first_stays else (total[nth] >= 2) & (w["times"] < 2)
    sd, ss, sc = merge_spans(w["row"][later], w["start"][later], np.ones(later.sum(), np.int64))
    bodies = [search.body(tokens[edges[r] + s:edges[r] + s + search.length], 1) for r, s in zip(w["row"][rep].tolist(), w["start"][rep].tolist(), strict=True)]
    rows = {"key": w["hash"][rep], "doc": doc[w["row"][rep]], "th": th[w["row"][rep]], "start": w["start"][rep].astype(np.int32),
            "count": np.ones(len(rep), np.int32), "times": np.minimum(total, 2).astype(np.uint8), "body": bodies}
    yield from _pack(rows, _number(rows["key"], segments), CONTEXT)
    if len(sd):
        rows = {"key": np.zeros(len(sd), np.uint64), "doc": doc[sd], "th": th[sd], "start": ss.astype(np.int32),
                "count": sc.astype(np.int32), "times": np.zeros(len(sd), np.uint8), "body": [b""] * len(sd)}
        seg = _number(doc[sd].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), segments)
        yield from _pack(rows, seg, CONTEXT)


def _settle_task(search: Search) -> Callable:
    def run(batches):
        for rows in _segments(batches):
            c = {k: _column(rows, k, t) for k, t in CONTEXT.items()}
            c["size"] = _column(rows, "size", np.int32)
            done = c["times"] == 0
            if done.any():
                yield _spans(*(c[k][done] for k in ("doc", "th")), SPAN, 0, c["start"][done], c["count"][done])
            open_ = np.flatnonzero(~done)       # settled ones have no body
            c = {k: v if k == "body" else v[open_] for k, v in c.items()}
            if len(open_):
                at, start, count = search.settle(c)
                if len(at):
                    i, s, n = merge_spans(at, start, count)
                    yield _spans(c["doc"][i], c["th"][i], SPAN, 0, c["start"][i] + s, n)
    return run


def packed(texts: pa.Array) -> pa.Array:
    import zstandard

    z = zstandard.ZstdCompressor(level=1)
    return pa.array([z.compress(x.as_buffer()) if x.is_valid else None for x in texts], pa.binary())


def unpacked(col: pa.Array) -> pa.Array:
    import zstandard

    z = zstandard.ZstdDecompressor()
    return pa.array([z.decompress(x.as_buffer()) if x.is_valid else None for x in col], pa.binary())


def with_identity(docs: DataFrame) -> DataFrame:
    """``doc, th, packed`` of every row: the identity, and the text in a form that shuffles small."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), packed(b.column(2))], ["doc", "th", "packed"])

    return identity(docs).mapInArrow(tidied(run), "doc bigint, th int, packed binary")


def identity(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc"), F.hash("text").alias("th"),
                       F.col("text"))


def find(docs: DataFrame, search: Search) -> DataFrame:
    """``doc, th, spans``: for each row with settled windows, an array of (start, count) in tokens."""
    spark = docs.sparkSession
    ship(spark)
    n = parallel(spark)
    segments = 4 * n
    entries = identity(docs).mapInArrow(tidied(_scan_task(search, segments)), _packed_schema(ENTRY))
    found = materialize(spark, entries.repartition(n, "seg").sortWithinPartitions("seg")
                        .mapInArrow(tidied(_segment_task(search)), SPANS), "runs")
    asks = (found.where(F.col("kind") > SPAN).groupBy("doc", "th")
            .agg(F.collect_list(F.struct("kind", "key", "start", "count")).alias("asks")))   # at most the document's runs
    contexts = (with_identity(docs).join(asks, ["doc", "th"])
                .mapInArrow(tidied(_context_task(search, segments)), _packed_schema(CONTEXT)))
    more = (contexts.repartition(n, "seg").sortWithinPartitions("seg").mapInArrow(tidied(_settle_task(search)), SPANS))
    return (found.where(F.col("kind") == SPAN).select("doc", "th", "start", "count")
            .unionByName(more.select("doc", "th", "start", "count")).groupBy("doc", "th")
            .agg(F.collect_list(F.struct("start", "count")).alias("spans")))


def covered(spans: pa.ListArray, row: int, length: int) -> list[tuple[int, int]]:
    """Token ranges covered by the windows of row ``row``, merged and in order."""
    got = spans[row].as_py() if spans[row].is_valid else None
    if not got:
        return []
    start = np.array([g["start"] for g in got], np.int64)
    count = np.array([g["count"] for g in got], np.int64)
    _, s, n = merge_spans(np.zeros(len(start), np.int64), start, count + length - 1)
    return list(zip(s.tolist(), (s + n).tolist(), strict=True))


def apply(docs: DataFrame, spans: DataFrame, cut: Callable, schema: str) -> DataFrame:
    """Rows of ``docs`` joined to their spans; ``cut`` gets (text bytes, spans column, row number) and gives the
    values of ``schema``. Columns: those of ``docs`` without text, then ``schema``."""
    names = [c for c in docs.columns if c != "text"]
    d, t, z, sp = (fresh(docs, f"__{c}") for c in ("doc", "th", "z", "spans"))
    kept = docs.select(*[F.col(f"`{c}`") for c in names], F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias(d),
                       F.hash("text").alias(t), F.col("text").alias(z))
    from pyspark.sql.types import BinaryType, StructField, StructType, _parse_datatype_string
    small = StructType([*kept.schema.fields[:-1], StructField(z, BinaryType())])

    def shrink(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], packed(b.columns[-1])], small.names)

    sides = spans.select(F.col("doc").alias(d), F.col("th").alias(t), F.col("spans").alias(sp))
    joined = kept.mapInArrow(tidied(shrink), small).join(sides, [d, t], "left").select(*[F.col(f"`{c}`") for c in names], z, sp)
    out = _parse_datatype_string(schema)
    arrow = pa.schema([(f.name, {"bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}[f.dataType.simpleString()])
                       for f in out])

    def run(batches):
        for b in (part for x in batches for part in sub_batches(x, byte_sizes(x, z), TASK_BYTES // 4)):
            texts = unpacked(b.column(z))
            rows = [cut(texts[i].as_py() or b"", b.column(sp), i) for i in range(b.num_rows)]
            cols = zip(*rows, strict=True) if rows else [[] for _ in arrow]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *(pa.array(v, f.type) for v, f in zip(cols, arrow, strict=True))],
                                             [*names, *arrow.names])

    return joined.mapInArrow(tidied(run), StructType([*docs.select(*[F.col(f"`{c}`") for c in names]).schema.fields, *out.fields]))
