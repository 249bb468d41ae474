"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A text is halved until a leaf has at most ``LEAF_CHARS`` characters, and neighbouring halves are joined by coding
again a window around their seam that grows until everything outside it is proved stable. Three monoids work so:

- *units* of a text begin at blanks after a character that is no white space, where a match of the pattern always
  ends. Two characters tell such a place, so the window is one unit on each side;
- *matches* of a unit: the window begins at the first match of the left half that its end may have shaped and grows
  into the right half until a boundary of both meets. The pattern never looks back, and ahead at most three
  characters past what it took, so the matches on both sides of the window stand;
- *tokens* of a match: its bytes are halved, and the window of tokens grows on both sides until each token at its edges is
  compatible with the one outside: the pair, merged alone from bytes, gives itself again. A token sequence whose
  adjacent pairs are all compatible is the encoding of its bytes (the first merge across a boundary would also be
  the first one there with only that pair in sight). A match that is a token itself is that token, as in the
  ranks' own library.

Distinct units are coded once and remembered. Decoding concatenates the bytes of halves up the tree.

No shuffle: texts are handled whole inside the scan, in sub-batches of about ``BATCH_BYTES`` (a longer text by
itself); a task remembers ``CACHE_UNITS`` units at most beside those of one sub-batch and forgets them at its end. Null text encodes to no
tokens, null ids decode to no bytes, ids outside the ranks are skipped. Repeated rows get equal results, an
empty table none. ``out`` must be a new column; other columns pass through.
"""
from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from .bpe import _gather
from .common import byte_sizes, ship, sub_batches, table, tidied

BATCH_BYTES = 2_000_000
CACHE_CHARS = 12_000_000        # of the units a task remembers
CACHE_UNITS = 1_000_000
LEAF_CHARS = 4096
LEAF_TOKENS = 1 << 18
LOOK_AHEAD = 3                  # characters the pattern may look at from a match's start: 'll, 're, 've
SHORT = 16                      # bytes of strings whose tokens are remembered
REMEMBERED = 400_000            # matches, pairs and short byte strings


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken file: one base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Merger:
    """The token monoid: sequences of ranks, joined by re-encoding around the seam."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.fits: dict[tuple[int, int], bool] = {}
        self.windows: dict[bytes, tuple[int, ...]] = {}
        self.short: dict[bytes, tuple[int, ...]] = {}

    def merged(self, raw: bytes) -> tuple[int, ...]:
        """Tokens of a window by merging its lowest-ranked neighbours, leftmost first."""
        known = self.windows.get(raw)
        if known is not None:
            return known
        rank, none, n = self.ranks.get, 1 << 60, len(raw)
        edges = list(range(n + 1))                                  # where the parts begin, and the end
        pairs = [rank(raw[i:i + 2], none) for i in range(n - 1)]    # of each part and the next
        while pairs:
            low = min(pairs)
            if low == none:
                break
            i = pairs.index(low)
            del edges[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = rank(raw[edges[i]:edges[i + 2]], none)
            if i:
                pairs[i - 1] = rank(raw[edges[i - 1]:edges[i + 1]], none)
        out = tuple([self.ranks[raw[a:b]] for a, b in zip(edges, edges[1:], strict=False)])
        if n <= SHORT:
            if len(self.windows) > REMEMBERED:
                self.windows.clear()
            self.windows[raw] = out
        return out

    def compatible(self, a: int, b: int) -> bool:
        """Whether tokens a, b stand side by side after merging their bytes alone."""
        known = self.fits.get((a, b))
        if known is None:
            if len(self.fits) > REMEMBERED:
                self.fits.clear()
            known = self.fits[a, b] = self.merged(self.bytes_of[a] + self.bytes_of[b]) == (a, b)
        return known

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of both halves' bytes together."""
        if not left or not right:
            return left + right
        fits = self.fits.get((left[-1], right[0]))
        if fits or (fits is None and self.compatible(left[-1], right[0])):
            return left + right
        i, j, grow = len(left) - 1, 1, 1
        while True:
            window = self.merged(b"".join([self.bytes_of[t] for t in left[i:] + right[:j]]))
            left_holds = i == 0 or self.compatible(left[i - 1], window[0])
            right_holds = j == len(right) or self.compatible(window[-1], right[j])
            if left_holds and right_holds:
                return left[:i] + window + right[j:]
            grow *= 2
            if not left_holds:
                i = max(0, i - grow)
            if not right_holds:
                j = min(len(right), j + grow)

    def tree(self, raw: bytes) -> tuple[int, ...]:
        """Tokens of bytes merged as one match, by halves."""
        known = self.short.get(raw)
        if known is not None:
            return known
        if len(raw) <= 1:
            return tuple(self.ranks[raw[i:i + 1]] for i in range(len(raw)))
        half = len(raw) // 2
        out = self.join(self.tree(raw[:half]), self.tree(raw[half:]))
        if len(raw) <= SHORT // 2:
            if len(self.short) > REMEMBERED:
                self.short.clear()
            self.short[raw] = out
        return out

    def encode(self, raw: bytes) -> tuple[int, ...]:
        """Tokens of one match of the pattern."""
        whole = self.ranks.get(raw)
        return self.tree(raw) if whole is None else (whole,)


class Decoder:
    """Bytes of tokens from flat tables."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values(), default=-1) + 1
        raw = [b""] * (size + 1)                                # the last one stands for ids outside the ranks
        for token, rank in ranks.items():
            raw[rank] = token
        self.lengths = np.array([len(b) for b in raw], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(raw), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of one text's tokens, concatenated up the tree of halves."""
        if len(ids) > LEAF_TOKENS:
            half = len(ids) // 2
            return self.decode(ids[:half]) + self.decode(ids[half:])
        known = np.where((ids >= 0) & (ids < len(self.lengths)), ids, len(self.lengths) - 1)
        return self.flat[_gather(self.starts[known], self.lengths[known])].tobytes()


class Numbers(dict):
    """Numbers of the distinct strings met, given in order; ``names`` leads back and may be shared."""

    def __init__(self, names: list[str], before: str = ""):
        self.names, self.before = names, before

    def __missing__(self, string: str) -> int:
        n = self[string] = len(self.names)
        self.names.append(self.before + string)
        return n


class Splitter:
    """The match monoid: matches of a string, joined by splitting anew around the seam."""

    def __init__(self, pattern: str):
        import regex

        self.find = regex.compile(pattern).findall

    def stable(self, lengths: list[int]) -> int:
        """How many leading matches, of the given lengths, hold whatever text follows."""
        end = total = sum(lengths)
        for k in range(len(lengths) - 1, -1, -1):
            start = end - lengths[k]
            if end < total and start <= total - LOOK_AHEAD:
                return k + 1
            end = start
        return 0

    def join(self, left: list[str], right: list[str]) -> list[str]:
        if not left or not right:
            return left + right
        # matches are never empty: those LOOK_AHEAD + 1 from the end are settled by their distance alone
        tail = left[-(LOOK_AHEAD + 1):]
        kept = len(left) - len(tail) + self.stable([len(m) for m in tail])
        before, take = "".join(left[kept:]), 1
        while True:
            take = min(take, len(right))
            window = self.find(before + "".join(right[:take]))
            if take == len(right):
                return left[:kept] + window
            lengths = [len(m) for m in window]
            ends = np.cumsum(lengths[:self.stable(lengths)])
            theirs = len(before) + np.concatenate([[0], np.cumsum([len(m) for m in right[:take]])])
            met = np.intersect1d(np.append(0, ends), theirs)
            if len(met):
                upto, frm = int(np.searchsorted(ends, met[0], "right")), int(np.searchsorted(theirs, met[0]))
                return left[:kept] + window[:upto] + right[frm:]
            take *= 2

    def tree(self, text: str) -> list[str]:
        if len(text) <= LEAF_CHARS:
            return self.find(text)
        half = len(text) // 2
        return self.join(self.tree(text[:half]), self.tree(text[half:]))


class Units:
    """The unit monoid: a text as numbers of its units, which begin at blanks after a character that is no white
    space. A match always ends there, and two characters tell the place: at a seam only the last
    unit of the left and the first of the right half can change."""

    def __init__(self):
        import re

        self.names: list[str] = []
        self.led, self.blank = Numbers(self.names), Numbers(self.names, " ")       # without and with a leading blank
        self.odd = re.compile(r"\s ").search
        self.cut = re.compile(r"(?<=\S) ").split

    def numbers(self, text: str) -> list[int]:
        first, *rest = self.cut(text) if self.odd(text) else text.split(" ")
        # a text that begins with a blank (and no white space after it) is split into "" and its units
        lead = [self.led[first]] if first or not rest else []
        return lead + list(map(self.blank.__getitem__, rest))

    def tree(self, text: str) -> list[int]:
        if len(text) <= LEAF_CHARS:
            return self.numbers(text)
        half = len(text) // 2
        left, right = self.tree(text[:half]), self.tree(text[half:])
        return left[:-1] + self.numbers(self.names[left[-1]] + self.names[right[0]]) + right[1:]


class Encoder:
    """One task's encoder: units met so far and their tokens in one growing flat array."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.merger, self.splitter = Merger(ranks), Splitter(pattern)
        self.reset()

    def reset(self) -> None:
        self.units, self.chars = Units(), 0
        self.matches: dict[str, tuple[int, ...]] = {}
        self.tokens = np.zeros(0, np.int32)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self) -> None:
        """Tokens of the units not met before."""
        flat, sizes, known = [], [], self.matches
        for unit in self.units.names[len(self.sizes):]:
            self.chars += len(unit)
            before = len(flat)
            # letters, after a blank or not, are one match, as most units are
            one = unit[1:].isalpha() and (unit[0] == " " or unit[0].isalpha())
            for match in (unit,) if one else self.splitter.tree(unit):
                coded = known.get(match)
                if coded is None:
                    if len(known) > REMEMBERED:
                        known.clear()
                    coded = known[match] = self.merger.encode(match.encode())
                flat.extend(coded)
            sizes.append(len(flat) - before)
        sizes = np.array(sizes, np.int64)
        self.starts = np.concatenate([self.starts, len(self.tokens) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.tokens = np.concatenate([self.tokens, np.array(flat, np.int32)])

    def encode(self, texts: pa.Array) -> pa.ListArray:
        if self.chars > CACHE_CHARS or len(self.sizes) > CACHE_UNITS:
            self.reset()
        numbers = [np.array(self.units.tree(t) if t else [], np.int64) for t in texts.to_pylist()]
        self.learn()
        flat = np.concatenate([*numbers, np.zeros(0, np.int64)])
        sizes = self.sizes[flat]
        ids = self.tokens[_gather(self.starts[flat], sizes)]
        edge = np.cumsum([0, *map(len, numbers)])
        edge = np.concatenate([[0], np.cumsum(sizes)])[edge].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(edge), pa.array(ids, pa.int32()))


def _added(rows: DataFrame, field: StructField, weigh, most: int, make) -> DataFrame:
    """``rows`` plus one column that ``make()``, called once a task, computes for sub-batches of about ``most`` in weight."""
    if field.name.lower() in [c.lower() for c in rows.columns]:
        raise ValueError(f"column {field.name!r} exists")
    ship(rows.sparkSession)

    def run(batches):
        column = make()
        for batch in batches:
            for part in sub_batches(batch, weigh(batch), most):
                yield pa.RecordBatch.from_arrays([*part.columns, column(part)], [*part.schema.names, field.name])

    return rows.mapInArrow(tidied(run), StructType([*rows.schema.fields, field]))


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` plus ``out``: the ranks of column ``text``, each match of ``pattern`` by itself."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(path))      # a vocabulary, a few MB

    def make():
        coder = Encoder(shared.value, pattern)
        return lambda part: coder.encode(part.column(text).cast(pa.string()))

    return _added(docs, StructField(out, ArrayType(IntegerType())), lambda b: byte_sizes(b, text), BATCH_BYTES, make)


def list_sizes(col: pa.Array) -> np.ndarray:
    return np.asarray(pc.fill_null(pc.list_value_length(col), 0)).astype(np.int64)


def _each(col: pa.ListArray):
    """The ids of each row; null ids are -1, a null row has none."""
    flat, ends = np.asarray(pc.fill_null(col.flatten(), -1)), np.cumsum([0, *list_sizes(col)])
    return (flat[a:b] for a, b in zip(ends, ends[1:], strict=False))


def decode(rows: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` plus ``out``: the bytes of the ranks in column ``ids``."""
    shared = rows.sparkSession.sparkContext.broadcast(read_ranks(path))

    def make():
        decoder = Decoder(shared.value)
        return lambda part: pa.array([decoder.decode(i) for i in _each(part.column(ids))], pa.binary())

    return _added(rows, StructField(out, BinaryType()), lambda b: list_sizes(b.column(ids)), BATCH_BYTES // 8, make)


def packed(rows: DataFrame, ids: str = "ids", out: str = "packed") -> DataFrame:
    """``rows`` plus ``out``: the ids as little-endian unsigned 32-bit integers, one after the other."""
    def make():
        return lambda part: pa.array([i.astype("<u4").tobytes() for i in _each(part.column(ids))], pa.binary())

    return _added(rows, StructField(out, BinaryType()), lambda b: list_sizes(b.column(ids)), BATCH_BYTES // 8, make)


def query(spark, sf_dir, path: str | None = None):
    import public_tokenizers

    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, public_tokenizers.PATTERN).drop("text")
    return packed(decode(ids, path)).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
