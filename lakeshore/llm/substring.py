"""Substring dedup on windows of words with a count-min prefilter.

A word goes if a window of ``LENGTH`` consecutive words that covers it also starts anywhere else in the
corpus. Windows are counted by their anchors (``anchors``): an anchor's key occurs at least as often
as any of its windows. Each partition's keys fill a count-min sketch (``DEPTH`` rows of counters
that saturate at 2); the sketches of a segment are merged by adding, and only runs whose estimate is 2 or
more are grouped exactly, by content, in a second pass. A sketch never underestimates, so no
repeated window is lost; what it overestimates the exact pass tells apart.

Nulls: null text has no words. Rows given twice repeat each other. Empty tables give no rows.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats, suffix
from .anchors import gather, gram_hashes, join_hashes, window_hashes
from .common import table

LENGTH = 35
ANCHOR = 8               # words of an anchor's q-gram
DEPTH, WIDTH = 2, 1 << 18    # count-min sketch of one segment; segments grow with the partitions
WORD_BYTES = 1 << 20      # bytes of words hashed at once
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MULTIPLIER = 0x9E3779B97F4A7C15
_SEEDS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _powers(n: int) -> np.ndarray:
    p = np.ones(n, np.uint64)
    have = 1
    while have < n:
        more = min(have, n - have)
        p[have:have + more] = p[:more] * np.uint64(pow(_MULTIPLIER, have, 1 << 64))
        have += more
    return p


def word_hashes(flat: np.ndarray, word: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (runs of bytes with mask ``word``) of the texts, and where each
    text's words end: a polynomial over the hashes of a word's bytes, mixed with its length."""
    # a word starts at a letter after a space or at a text's start
    start = word.copy()
    start[1:] &= ~word[:-1]
    heads = edges[:-1][edges[:-1] < len(flat)]
    start[heads] = word[heads]
    first = np.flatnonzero(start)
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(len(edges), np.int64)
    ends = np.flatnonzero(word & np.append(~word[1:] | start[1:], True))
    sizes = ends - first + 1
    # bytes are widened to hashes for a bounded number of words at a time
    h, total = np.empty(len(first), np.uint64), np.cumsum(sizes)
    powers = _powers(int(sizes.max()))
    cuts = np.unique(np.append(np.searchsorted(total, np.arange(WORD_BYTES, total[-1], WORD_BYTES)), [0, len(first)]))
    for a, b in zip(cuts, cuts[1:], strict=False):
        n = sizes[a:b]
        value = suffix.hashed(flat[gather(first[a:b], n)]) * powers[gather(np.zeros(b - a, np.int64), n)]
        h[a:b] = np.add.reduceat(value, np.cumsum(n) - n)
    return join_hashes(h, sizes.astype(np.uint64)), np.searchsorted(first, edges)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words between white space, and where each text's words end."""
    flat, edges = suffix.tokens(texts)
    return word_hashes(flat, ~_SPACE[flat], edges)


class CountMin:
    """Count-min sketch whose counters saturate at 2: is a key seen twice or more?"""

    def __init__(self):
        self.cells = np.zeros((DEPTH, WIDTH), np.uint8)

    def _at(self, keys: np.ndarray) -> list[np.ndarray]:
        return [(join_hashes(keys, np.full(1, seed)) % np.uint64(WIDTH)).astype(np.int64) for seed in _SEEDS[:DEPTH]]

    def add(self, keys: np.ndarray, times: np.ndarray) -> CountMin:
        for row, at in zip(self.cells, self._at(keys), strict=True):
            row[:] = np.minimum(np.bincount(at, weights=times, minlength=WIDTH) + row, 2)
        return self

    def merge(self, other: CountMin) -> CountMin:
        self.cells = np.minimum(self.cells + other.cells, 2)
        return self

    def estimate(self, keys: np.ndarray) -> np.ndarray:
        return np.min([row[at] for row, at in zip(self.cells, self._at(keys), strict=True)], axis=0)


def likely(rows: list[dict], entries: dict) -> np.ndarray:
    """Which entries of a segment may repeat: the merged sketches of its partitions estimate 2 or
    more for their key (hot keys, told by their markers, always may)."""
    sketch = CountMin()
    at = 0
    for r in rows:
        n = len(r["times"])
        k, t = entries["key"][at:at + n], entries["times"][at:at + n] + 2 * entries["hot"][at:at + n]
        at += n
        sketch.merge(CountMin().add(k, t))
    return sketch.estimate(entries["key"]) >= 2


def body(part: np.ndarray, count: int) -> bytes:
    return window_hashes(gram_hashes(part, ANCHOR), np.arange(count), LENGTH, ANCHOR).tobytes()


def settle(c: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows, of the contexts not yet known to repeat, that occur twice or more under their key."""
    counts = c["count"].astype(np.int64)
    context = np.repeat(np.arange(len(counts)), counts)
    group = join_hashes(c["key"][context], c["body"].view(np.uint64))
    _, inverse = np.unique(group, return_inverse=True)
    total = np.bincount(inverse, weights=c["times"][context])
    gone = (total[inverse] >= 2) & (c["times"][context] < 2)
    offset = gather(np.zeros(len(counts), np.int64), counts)
    return context[gone], offset[gone], np.ones(int(gone.sum()), np.int64)


SEARCH = repeats.Search(tokens=tokens, hashed=lambda words: words, length=LENGTH, q=ANCHOR, first_stays=False,
                        body=body, settle=settle, likely=likely)


def cut(raw: bytes, spans: pa.Array, row: int) -> tuple[int, int, bytes]:
    words = raw.split()         # bytes: splits at \\x20 and \\x09-\\x0D, as the tokens do
    kept, at = [], 0
    for a, b in repeats.covered(spans, row, LENGTH):
        kept += words[at:a]
        at = b
    kept += words[at:]
    return len(words), len(words) - len(kept), b" ".join(kept)


def dedup(docs: DataFrame, search: repeats.Search = SEARCH) -> DataFrame:
    """``docs`` without text, plus n_words, n_removed and the kept words joined by blanks (``kept``)."""
    return repeats.apply(docs, repeats.find(docs, search), cut, "n_words bigint, n_removed bigint, kept binary")


def query(spark, sf_dir):
    d = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
