"""Byte-level BPE encoding and decoding in batched numpy merge rounds.

A batch of texts is cut at blanks that follow a non-space character (a pre-token always ends
there), and the pieces are dictionary-encoded. Only pieces not met before by the task are split into pre-tokens and merged:
the symbols of all their distinct words lie in one flat array, and each round finds the rank of
every adjacent pair by binary search over the sorted pair keys, takes the lowest rank of each word,
merges all its occurrences left to right and drops finished words. Texts are handled whole, in
sub-batches of about ``BATCH_CHARS`` characters, and a task remembers about ``CACHE_PIECES``
pieces at most (then it starts anew), so memory does not grow with the input. No shuffle.

Results equal those of the vocabulary's own library with special tokens recognised in texts and
none added. Null text encodes to no tokens; null ids decode to the empty text; ids outside the
vocabulary are skipped. Repeated rows get equal results, an empty table none.
"""
from __future__ import annotations

import json
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import byte_sizes, fresh, ship, sub_batches, table, tidied

BATCH_CHARS = 4_000_000
CACHE_PIECES = 400_000
# fixed value: the pattern of the byte-level pre-tokenizer
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of_char() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary file: printable Latin-1 bytes stand for
    themselves, the others for code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tables of one byte-level BPE file, small enough (a few MB) to travel with the tasks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, byte = spec["model"], _byte_of_char()
        self.path = path
        ids = model["vocab"]
        size = max([*ids.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        raw = [b""] * size
        for token, i in ids.items():
            raw[i] = bytes(byte[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.special.items():
            raw[i] = content.encode()
        self.lengths = np.array([len(b) for b in raw], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.flat = np.frombuffer(b"".join(raw), np.uint8)
        self.of_byte = np.zeros(256, np.int64)
        for char, b in byte.items():
            self.of_byte[b] = ids[char]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([ids[a] << 20 | ids[b] for a, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        self.order = np.argsort(keys)           # rank of the i-th sorted key
        self.keys, self.made = keys[self.order], made[self.order]


NO_RANK = np.int64(1) << 40


def merge_words(v: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words in one flat array, and the number of tokens of each."""
    lengths = np.array([len(w) for w in words], np.int64)
    sym = v.of_byte[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), lengths)
    rank, made = np.full(len(sym), NO_RANK), np.zeros(len(sym), np.int64)
    changed = np.arange(len(sym))           # pairs to look up: all at first, then those beside a merge
    done_sym, done_word = [], []
    while len(sym):
        rank[changed] = NO_RANK
        left = changed[changed < len(sym) - 1]
        left = left[word[left] == word[left + 1]]
        pair = (sym[left] << 20) | sym[left + 1]
        at = np.minimum(np.searchsorted(v.keys, pair), len(v.keys) - 1)
        hit = v.keys[at] == pair
        rank[left[hit]], made[left[hit]] = v.order[at[hit]], v.made[at[hit]]
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        best = np.minimum.reduceat(rank, first)
        best = np.repeat(best, np.diff(np.append(first, len(sym))))
        stays = best < NO_RANK
        if not stays.all():                                  # words without a pair are finished
            done_sym.append(sym[~stays])
            done_word.append(word[~stays])
        places = np.flatnonzero(stays & (rank == best))
        # of overlapping occurrences (a a a), every other one counted from the left
        run = np.flatnonzero(np.append(True, np.diff(places) != 1)) if len(places) else places
        nth = np.arange(len(places)) - np.repeat(run, np.diff(np.append(run, len(places))))
        places = places[nth % 2 == 0]
        sym[places] = made[places]
        stays[places + 1] = False
        moved = (np.cumsum(stays) - 1)[places]
        sym, word, rank, made = sym[stays], word[stays], rank[stays], made[stays]
        near = np.zeros(len(sym) + 1, bool)
        near[moved], near[moved - 1] = True, True           # index -1 is the spare last element
        changed = np.flatnonzero(near[:-1])
    flat_sym = np.concatenate(done_sym) if done_sym else np.zeros(0, np.int64)
    flat_word = np.concatenate(done_word) if done_word else np.zeros(0, np.int64)
    order = np.argsort(flat_word, kind="stable")
    return flat_sym[order].astype(np.int32), np.bincount(flat_word, minlength=len(words))


class _Encoder:
    """One task's encoder: pieces met so far, and their tokens in one growing flat array."""

    def __init__(self, v: Vocabulary):
        import re

        import regex

        self.v, self.split = v, regex.compile(PATTERN).findall
        # a blank after white space lies inside a run of it: such texts are cut more carefully
        self.odd = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "
        self.special = re.compile("(" + "|".join(map(re.escape, v.special)) + ")") if v.special else None
        self.cut = re.compile(r"(?<=\S) ").split
        self.reset()

    def reset(self) -> None:
        self.known: dict[str, int] = {}
        self.tokens = np.zeros(0, np.int32)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def lookup(self, pieces: list[str]) -> np.ndarray:
        """Numbers of the pieces; new ones are split, merged and remembered first."""
        at = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            names = [pieces[i] for i in missing.tolist()]
            new = list(dict.fromkeys(names))
            self.learn(new)
            at[missing] = np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))
        return at

    def learn(self, new: list[str]) -> None:
        """Add the tokens of distinct pieces not met before."""
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        words: dict[str, int] = {}
        index, count = [], []
        for p in new:
            if p in self.v.special:
                index.append(-1 - self.v.special[p])
                count.append(1)
                continue
            if p[1:].isalpha() and (p[0] == " " or p[0].isalpha()):     # one pre-token, as most are
                index.append(words.setdefault(p, len(words)))
                count.append(1)
                continue
            ws = self.split(p)
            index.extend([words.setdefault(w, len(words)) for w in ws])
            count.append(len(ws))
        index = np.array(index, np.int64)
        tok, n = merge_words(self.v, [w.encode() for w in words])
        # special tokens join the flat array after the words
        spec = index < 0
        tok = np.concatenate([tok, (-1 - index[spec]).astype(np.int32)])
        start = np.concatenate([[0], np.cumsum(n)])[:-1]
        at = np.where(spec, len(tok) - spec.sum() + np.cumsum(spec) - 1, start[np.where(spec, 0, index)] if len(start) else 0)
        size = np.where(spec, 1, n[np.where(spec, 0, index)] if len(n) else 0)
        flat = tok[_gather(at, size)]
        count = np.array(count, np.int64)
        ends = np.concatenate([[0], np.cumsum(size)])
        edge = np.concatenate([[0], np.cumsum(count)])
        sizes = ends[edge[1:]] - ends[edge[:-1]]
        self.starts = np.concatenate([self.starts, len(self.tokens) + ends[edge[:-1]]])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.tokens = np.concatenate([self.tokens, flat])

    def pieces_slowly(self, text: str) -> list[str]:
        out = []
        for part in self.special.split(text) if self.special else [text]:
            if part in self.v.special:
                out.append(part)
            elif part:
                first, *rest = self.cut(part)
                out += [first, *(" " + r for r in rest)]
        return out

    def encode(self, texts: pa.Array) -> pa.ListArray:
        if len(self.known) > CACHE_PIECES:
            self.reset()
        texts = pc.fill_null(texts.cast(pa.string()), "")
        odd = pc.match_substring_regex(texts, self.odd)
        for s in self.v.special:
            odd = pc.or_(odd, pc.match_substring(texts, s))
        plain = pc.if_else(odd, "", texts)
        parts = pc.split_pattern(plain, " ")
        edge = np.asarray(parts.offsets).astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        code = np.asarray(coded.indices).astype(np.int64)
        leads = np.zeros(len(code), bool)
        leads[edge[:-1][edge[:-1] < edge[1:]]] = True         # no blank before the first piece
        slow = np.flatnonzero(np.asarray(odd))
        slow_pieces = [self.pieces_slowly(texts[int(i)].as_py()) for i in slow]
        names = coded.dictionary.to_pylist()
        lead_codes = np.unique(code[leads])
        spaced = [" " + x for x in names]
        of_code = self.lookup(spaced)
        of_lead = np.zeros(len(names), np.int64)
        of_lead[lead_codes] = self.lookup([names[c] for c in lead_codes.tolist()])
        piece = np.where(leads, of_lead[code], of_code[code]) if len(code) else code
        if len(slow):       # an odd text was replaced by "", which is one empty piece
            per = np.diff(edge)
            chunks, at = [], 0
            for i, ps in zip(slow, slow_pieces, strict=True):
                chunks += [piece[at:edge[i]], self.lookup(ps)]
                at, per[i] = edge[i + 1], len(ps)
            piece = np.concatenate([*chunks, piece[at:]])
            edge = np.concatenate([[0], np.cumsum(per)])
        size = self.sizes[piece]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = self.tokens[_gather(self.starts[piece], size)]
        return pa.ListArray.from_arrays(pa.array(ends[edge].astype(np.int32)), pa.array(ids, pa.int32()))


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of all slices, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` plus ``out``: the token ids of column ``text`` (an existing ``out`` is an error)."""
    if out in docs.columns:
        raise ValueError(f"column {out!r} exists")
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def run(batches):
        coder = _Encoder(shared.value)          # the task's own: nothing stays in a worker that lives on
        for batch in batches:
            for part in sub_batches(batch, byte_sizes(batch, text), BATCH_CHARS):
                yield pa.RecordBatch.from_arrays([*part.columns, coder.encode(part.column(text))],
                                                 [*part.schema.names, out])

    return docs.mapInArrow(tidied(run), StructType([*docs.schema.fields, StructField(out, ArrayType(IntegerType()))]))


def decode(rows: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` plus ``out``: the text of the token ids; bytes that are no UTF-8 become U+FFFD."""
    if out in rows.columns:
        raise ValueError(f"column {out!r} exists")
    ship(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def texts(v: Vocabulary, col: pa.ListArray) -> pa.Array:
        sizes = np.asarray(pc.fill_null(pc.list_value_length(col), 0)).astype(np.int64)
        flat = np.asarray(pc.fill_null(col.flatten(), -1)).astype(np.int64)
        good = (flat >= 0) & (flat < len(v.lengths))
        size = np.where(good, v.lengths[np.where(good, flat, 0)], 0)
        ends = np.concatenate([[0], np.cumsum(size)])
        raw = v.flat[_gather(v.starts[np.where(good, flat, 0)], size)].tobytes()
        edge = ends[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        return pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(edge, edge[1:], strict=False)], pa.string())

    def run(batches):
        for batch in batches:
            n = np.asarray(pc.fill_null(pc.list_value_length(batch.column(ids)), 0)).astype(np.int64)
            for part in sub_batches(batch, n, BATCH_CHARS // 4):
                yield pa.RecordBatch.from_arrays([*part.columns, texts(shared.value, part.column(ids))],
                                                 [*part.schema.names, out])

    return rows.mapInArrow(tidied(run), StructType([*rows.schema.fields, StructField(out, StringType())]))


def tokenize(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``ids`` and ``n_tokens``, and as text what the ids decode to. A column of ``docs`` with one of
    these names gives way; null text becomes the empty text."""
    names = [c for c in docs.columns if c.lower() not in ("ids", "n_tokens")]
    out = fresh(docs, "__decoded")
    ids = encode(docs.select(*[F.col(f"`{c}`") for c in names]), path).drop("text")
    new = {"text": F.col(out).alias("text")}
    return decode(ids, path, out=out).select(*[new.get(c, F.col(f"`{c}`")) for c in names],
                                             F.size("ids").cast("long").alias("n_tokens"), "ids")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(spark, sf_dir, path: str | None = None):
    path = path or default_path()
    ids = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path).drop("text")
    return decode(ids, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
