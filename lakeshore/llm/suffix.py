"""Suffix-array dedup by bucket-pointer refinement.

A byte goes if a ``LENGTH``-byte string covering it also starts earlier in the corpus (smaller doc_id, or
the same document and an earlier start). ``repeats`` brings the contexts in which such strings can
lie to one place, by the smallest q-gram hash in them; there their suffixes are sorted as far
as ``LENGTH`` bytes: initial buckets are those of the ``GRAM``-byte prefixes, each suffix points to its
bucket, and buckets are refined by sorting on the pointers ``GRAM`` bytes later; the refined pointers
serve the next round, which looks twice as far. Suffixes alone in their bucket drop out. Equal
strings end in one bucket, whose earliest stays.

Nulls: null text is empty; a null doc_id sorts first. Rows sharing a doc_id do not precede each
other, so repeated rows get equal results. Matches never cross documents. Empty tables give no rows.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats
from .anchors import gather, gram_hashes
from .common import fresh, table

LENGTH = 100
ANCHOR = 32              # bytes of an anchor's q-gram
GRAM = LENGTH // 4       # initial buckets; two rounds of doubling reach LENGTH
_TABLE = np.random.default_rng(20260101).integers(0, 1 << 64, 256, dtype=np.uint64)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 bytes in one array, and where each text ends."""
    raw = pc.fill_null(texts.cast(pa.binary()), b"")
    sizes = np.asarray(pc.binary_length(raw)).astype(np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    data = raw.buffers()[2]
    first = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset] if len(raw) else 0
    flat = np.frombuffer(data, np.uint8)[first:first + edges[-1]] if data is not None and edges[-1] else np.zeros(0, np.uint8)
    return flat, edges


def hashed(flat: np.ndarray) -> np.ndarray:
    return _TABLE[flat]


def _buckets(order_by: np.ndarray) -> np.ndarray:
    """Pointer of each suffix to its bucket: the first place of the bucket in sorted order, or -1 for
    a suffix that is alone."""
    order = np.argsort(order_by, kind="stable")
    s = order_by[order]
    new = np.append(True, s[1:] != s[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(s)))
    pointer = np.empty(len(s), np.int64)
    pointer[order] = np.repeat(np.where(size > 1, first, -1), size)
    return pointer


def refine(body: np.ndarray, sizes: np.ndarray, counts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Bucket pointer at depth ``length`` of the first ``counts[i]`` suffixes of each context, one after
    the other (-1: no equal among them). The last round overlaps where ``length`` is no power."""
    starts = np.cumsum(sizes) - sizes
    depth = max(1, min(GRAM, length))
    pointer = np.full(len(body), -1, np.int64)
    at = gather(starts, np.maximum(sizes - depth + 1, 0))
    grams = gram_hashes(hashed(body), depth)
    pointer[at] = _buckets(grams[at])
    while depth < length:
        step = min(depth, length - depth)
        at = gather(starts, np.maximum(sizes - depth - step + 1, 0))
        at = at[(pointer[at] >= 0) & (pointer[at + step] >= 0)]
        later = np.full(len(body), -1, np.int64)
        if len(at):
            later[at] = _buckets(pointer[at] * np.int64(len(body)) + pointer[at + step])
        pointer, depth = later, depth + step
    return pointer[gather(starts, counts)]


def settle(c: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, first window, windows) of all windows that an equal one precedes."""
    counts = c["count"].astype(np.int64)
    bucket = refine(c["body"], c["size"].astype(np.int64), counts)
    context = np.repeat(np.arange(len(counts)), counts)
    offset = gather(np.zeros(len(counts), np.int64), counts)
    has = np.flatnonzero(bucket >= 0)
    bucket, context, offset = bucket[has], context[has], offset[has]
    doc, start = c["doc"][context], c["start"][context] + offset
    order = np.lexsort((start, doc, bucket))
    b = bucket[order]
    first = np.flatnonzero(np.append(True, b[1:] != b[:-1])) if len(b) else np.zeros(0, np.int64)
    head = order[np.repeat(first, np.diff(np.append(first, len(b))))]
    later = (doc[order] != doc[head]) | (start[order] != start[head])
    gone = order[later]
    return context[gone], offset[gone], np.ones(len(gone), np.int64)


SEARCH = repeats.Search(tokens=tokens, hashed=hashed, length=LENGTH, q=ANCHOR, first_stays=True,
                        body=lambda part, count: part.tobytes(), settle=settle)


def cut(raw: bytes, spans: pa.Array, row: int) -> tuple[int, int, int, bytes]:
    ranges = repeats.covered(spans, row, LENGTH)
    kept, at = [], 0
    for a, b in ranges:
        kept.append(raw[at:a])
        at = b
    kept = b"".join([*kept, raw[at:]])
    return len(raw), len(raw) - len(kept), len(ranges), kept


def dedup(docs: DataFrame, search: repeats.Search = SEARCH) -> DataFrame:
    """``docs`` without text, plus n_bytes, n_removed, n_spans and the remaining bytes (``kept``)."""
    return repeats.apply(docs, repeats.find(docs, search), cut, "n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def clean(docs: DataFrame, search: repeats.Search = SEARCH) -> DataFrame:
    """``docs`` with the repeated bytes cut from column text; a character cut in half goes too, null
    becomes the empty text, and n_chars, if there, is the new length. Columns and their order stay."""
    n, removed, spans, kept = (fresh(docs, f"__{c}") for c in ("n", "removed", "spans", "kept"))
    d = repeats.apply(docs, repeats.find(docs.select("doc_id", "text"), search), _cut_text,
                      f"{n} bigint, {removed} bigint, {spans} bigint, {kept} string")
    new = {"text": F.col(kept).alias("text"), "n_chars": F.length(kept).cast("long").alias("n_chars")}
    return d.select(*[new.get(c, F.col(f"`{c}`")) for c in docs.columns])


def _cut_text(raw: bytes, spans: pa.Array, row: int) -> tuple[int, int, int, str]:
    n, removed, count, kept = cut(raw, spans, row)
    return n, removed, count, kept.decode("utf-8", "ignore")


def query(spark, sf_dir):
    d = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
