"""Anchored windows: the numpy part that both searches for repeated fixed-length windows share.

A window of ``length`` tokens is told by its *anchor*: the q-gram inside it with the smallest hash
(the rightmost of equals). Equal windows have equal anchors at equal offsets, so a window can only
repeat if its anchor's hash (the *key*) occurs at two anchors. Consecutive windows with one anchor
form a *run* of at most ``length - q + 1`` windows; a text has far fewer runs than windows, and runs
are what is counted and shuffled.

Hashes are built by doubling over flat arrays: the hash of 2k tokens joins two of k tokens. The hash
of a window joins its q-grams side by side; that of a run's whole content joins its first and
last window, which overlap.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np

CHUNK_BITS = 17                     # tokens handled at once: the arrays stay in the processor's cache
POSITION = np.uint64((1 << CHUNK_BITS) - 1)
# odd multipliers of the hash steps
K1, K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def join_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = a * K1
    h ^= h >> np.uint64(31)
    h += b
    h *= K2
    h ^= h >> np.uint64(29)
    return h


def gram_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all ``size``-grams from token hashes: powers of two by doubling, other sizes as two
    overlapping grams of the power below."""
    have = 1
    while have * 2 <= size:
        h = join_hashes(h[:-have], h[have:])
        have *= 2
    return join_hashes(h[:-(size - have)], h[size - have:]) if have < size else h


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        v = np.minimum(v[:-have], v[have:])
        have *= 2
    return np.minimum(v[:-(width - have)], v[width - have:]) if have < width else v


def window_hashes(grams: np.ndarray, at: np.ndarray, length: int, q: int) -> np.ndarray:
    """Hashes of the windows that start at positions ``at``, from the q-grams of all positions."""
    out = grams[at]
    for offset in [*range(q, length - q, q), length - q]:
        out = join_hashes(out, grams[at + offset])
    return out


def gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of all slices, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def merge_spans(doc: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple:
    """Spans sorted by (doc, start), with those that touch or overlap joined."""
    if not len(doc):
        return doc, start, count
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], (start + count)[order]
    # the furthest end so far, within a document: documents are set apart by a large step
    step = np.int64(1) << 40
    nth = np.cumsum(np.append(0, doc[1:] != doc[:-1]))
    reach = np.maximum.accumulate(end + nth * step) - nth * step
    new = np.append(True, (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], reach[last] - start[first]


@dataclass
class Runs:
    """Runs of windows: document number, first window (a token position in the document), number of
    windows, key, hash of the whole content."""
    doc: np.ndarray
    start: np.ndarray
    count: np.ndarray
    key: np.ndarray
    content: np.ndarray


def chunks(edges: np.ndarray, length: int) -> Iterator[list[tuple[int, int, int]]]:
    """Groups of (document, first token, end) of at most 2**CHUNK_BITS tokens; a longer document is
    cut into parts that overlap by ``length - 1`` tokens, so that each window is in one part."""
    most, group, held = 1 << CHUNK_BITS, [], 0
    for doc in np.flatnonzero(np.diff(edges) >= length).tolist():
        at, end = int(edges[doc]), int(edges[doc + 1])
        while end - at >= length:
            if held and held + min(end - at, most) > most:
                yield group
                group, held = [], 0
            stop = min(end, at + most)
            group.append((doc, at, stop))
            held += stop - at
            at = stop - (length - 1)
    if group:
        yield group


def scan(tokens: np.ndarray, hashed: Callable, edges: np.ndarray, length: int, q: int) -> Runs:
    """Runs of all documents (tokens ``edges[i]:edges[i + 1]``), in text order; ``hashed`` turns
    tokens into 64-bit hashes."""
    width = length - q + 1
    found: list[tuple] = []
    for group in chunks(edges, length):
        h = hashed(np.concatenate([tokens[a:b] for _, a, b in group]) if len(group) > 1 else tokens[group[0][1]:group[0][2]])
        sizes = np.array([b - a for _, a, b in group])
        ends = np.cumsum(sizes)
        grams = gram_hashes(h, q)
        v = (grams & ~POSITION) | (POSITION - np.arange(len(grams), dtype=np.uint64))
        anchor = (POSITION - (sliding_min(v, width) & POSITION)).astype(np.int64)
        edge = np.zeros(len(h) + 1, np.int8)        # windows must lie inside one document
        edge[ends[:-1] - (length - 1)] += 1
        edge[ends[:-1]] -= 1
        at = np.flatnonzero(np.cumsum(edge[:len(anchor)], dtype=np.int8) == 0)
        a = anchor[at]
        first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (at[1:] != at[:-1] + 1)))
        count = np.diff(np.append(first, len(at)))
        start = at[first]
        content = join_hashes(window_hashes(grams, start, length, q), window_hashes(grams, start + count - 1, length, q))
        part = np.searchsorted(ends, start, side="right")
        origin = np.array([x - edges[d] for d, x, _ in group]) - (ends - sizes)
        found.append((np.array([d for d, _, _ in group])[part], start + origin[part], count, grams[a[first]],
                      content + count.astype(np.uint64)))
    if not found:
        return Runs(*(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64)))
    return Runs(*(np.concatenate([f[i] for f in found]) for i in range(5)))
