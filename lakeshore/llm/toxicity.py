"""Toxicity scores on texts restored by a noisy-channel decoder.

Letters written as digits or signs, stretched, or spread with blanks, dots or the like are undone by a
Viterbi search: each character of a suspicious word offers what it may stand for (itself, a letter
it imitates, nothing for separators and repeats), and the path of the smallest channel cost plus
character-language-model cost is read off. The language model is a table of trigram counts over
``LETTERS`` of all documents, summed per task and then by cell: its work grows with the input, its size
does not.

Terms (words and word beginnings) get log-odds from labelled documents, at most ``TRAIN_ROWS`` of them (those
with the smallest hash of their doc_id); a logistic regression turns a text's largest log-odds into
its score. Rows with ``crc32(doc_id) % 3 == 1`` are held out of all that looks at labels.

Null and empty texts get the score of a text without known terms. Repeated rows get equal scores. Without
labels of both kinds every score is the share of toxic labels seen (0 without any). An empty table
gives no rows.
"""
from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship, table

TRAIN_ROWS = 20_000
LEAST_DOCS, LEAST_ODDS = 4, 2.0     # a term's toxic documents, and its log-odds
PREFIXES = (4, 5, 6)
THRESHOLD = 0.7
KNOWN_WORDS = 400_000               # distinct words a task remembers before it starts anew
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâäæçèéêëìíîïñòóôöœùúûüß"
BASE = 64                           # cells per position: 0 is a word's edge, the last any other letter
# fixed values: what signs and digits imitate
IMITATES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
            "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou", "#": "h", "%": "x"}
# several signs that draw one letter
DRAWS = {"(_)": "u", "|_|": "u", "|>": "p", "|)": "d", "|<": "k", "|3": "b", "|-|": "h", "()": "o", "[]": "o", "><": "x", "|_": "l",
         "\\/": "v", "\\/\\/": "w", "/\\": "a", "|\\|": "n", "|\\/|": "m"}
SEPARATORS = frozenset(".-_*~'·•/\\,:; \t")
DROP_SIGN, IMITATE, SKIP, SKIP_REPEAT = 12.0, 0.7, 0.3, 0.7

_CODE = {c: i + 1 for i, c in enumerate(LETTERS)}
_CELL = np.zeros(0x10000, np.int64)
for _c in range(0x10000):
    _l = chr(_c).lower()
    _CELL[_c] = _CODE.get(_l, BASE - 1 if len(_l) == 1 and _l.isalpha() else 0)
LETTER_RUN = re.compile(r"[^\W\d_]+")
SPACED = re.compile(r"(?<!\S)(?:\S\s+){2,}\S(?!\S)")
WIDE_GAP = re.compile(r"\s{2,}|[\r\n]")
DOUBLED = re.compile(r"([^\W\d_])\1", re.I)
NUMBER = re.compile(r"(?=.*\d\d)\d+(?:[-./:,]\d+)+")        # dates, addresses and the like are no words
DRAWN = re.compile("|".join(map(re.escape, sorted(DRAWS, key=len, reverse=True))))
INSIDE = re.compile(r"[^\W\d_]['’]?[^\w\s'’]+[^\W\d_]|[^\W\d_]\d|\d[^\W\d_]|[@$|!+€£][^\W\d_]|[^\W\d_][@$|!+€£*][^\W\d_]|_")


def cells(text: str) -> np.ndarray:
    """Letter numbers of a text; 0 for everything that is no letter."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(code < 0x10000, _CELL[np.minimum(code, 0xFFFF)], 0)


class LanguageModel:
    """Costs (negative log probabilities) of a letter after two others, with add-one smoothing that
    backs off to letter pairs."""

    def __init__(self, counts: dict[int, int]):
        tri = np.zeros(BASE ** 3)
        for cell, n in counts.items():
            tri[cell] = n
        tri = tri.reshape(BASE, BASE, BASE)
        # a word's first letter is told by the edge before it, whatever stood there
        two = tri.sum(axis=0)
        pair = (two + 0.1) / (two + 0.1).sum(axis=1, keepdims=True)
        strength = 5.0
        self.cost = -np.log((tri + strength * pair[None]) / (tri.sum(axis=2, keepdims=True) + strength))
        self.start = -np.log(pair[0])

    def decode(self, word: str, repeats: bool = True) -> str:
        """The likeliest letters behind ``word``; ``repeats``: a repeated character may stand for one."""
        # state: last two letters and the last observed character's own letter -> (cost, text)
        states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        previous, word = "", word.lower()
        ahead: dict[int, dict] = {}             # states that several signs at once have led to, by position
        drawn = DRAWN.search(word) is not None
        for i, char in enumerate(word):
            options = [*self._options(char, previous if repeats else "")]
            after = ahead.pop(i + 1, {})
            for n in (2, 3, 4) if drawn else ():
                if letter := DRAWS.get(word[i:i + n]):
                    c, later = _CODE[letter], ahead.setdefault(i + n, {})
                    for (a, b), (cost, text) in states.items():
                        new = cost + IMITATE + (self.start[c] if b == 0 else self.cost[a, b, c])
                        if (b, c) not in later or new < later[b, c][0]:
                            later[b, c] = (new, text + letter)
            for (a, b), (cost, text) in states.items():
                for letter, channel in options:
                    if letter == "":
                        key, new, out = (a, b), cost + channel, text
                    else:
                        c = _CODE.get(letter, BASE - 1)
                        lm = self.start[c] if b == 0 else self.cost[a, b, c]
                        key, new, out = (b, c), cost + channel + lm, text + letter
                    if key not in after or new < after[key][0]:
                        after[key] = (new, out)
            states = after or states
            previous = char
        return min(((cost + self.cost[a, b, 0] if b else cost, text) for (a, b), (cost, text) in states.items()),
                   default=(0, ""))[1]

    @staticmethod
    def _options(char: str, previous: str):
        if char.isalpha():
            yield char, 0.0
            if char == previous:
                yield "", SKIP_REPEAT
            return
        for letter in IMITATES.get(char, ""):
            yield letter, IMITATE
        if char == previous and char in IMITATES:
            yield "", SKIP_REPEAT
        if char in SEPARATORS or not char.isalnum() and char not in IMITATES:
            yield "", SKIP
        else:
            yield "", DROP_SIGN


def count_trigrams(docs: DataFrame) -> dict[int, int]:
    """Trigram counts of all texts: one array per task, summed by cell. A word is led by one edge."""
    def run(batches):
        total = np.zeros(BASE ** 3, np.int64)

        def add(texts: list[str]) -> None:
            c = cells(f" {' '.join(texts)} ")
            c = c[(c > 0) | np.append(True, c[:-1] > 0)]            # one edge between words
            if len(c) > 2:
                total[:] += np.bincount((c[:-2] * BASE + c[1:-1]) * BASE + c[2:], minlength=BASE ** 3)

        held, size = [], 0
        for batch in batches:
            for x in batch.column(0):
                held.append(x.as_py() or "")
                size += len(held[-1])
                if size > 500_000:      # many short texts at once
                    add(held)
                    held, size = [], 0
        add(held)
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])

    ship(docs.sparkSession)
    summed = docs.select("text").mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    return {r.cell: r.n for r in summed.collect()}      # at most BASE ** 3 cells


def terms_of(word: str) -> list[str]:
    return [word, *("^" + word[:n] for n in PREFIXES if len(word) > n)]


EDGES = "\"'.,;:?()[]{}<>%&#~`=^/\\*-_…«»“”‘’"


class Reader:
    """Texts as the terms in them, after restoring; remembers what it has found in a token. With
    ``only``, other terms are left out."""

    def __init__(self, counts: dict[int, int], only=None):
        self.model, self.only = LanguageModel(counts), only
        self.seen: dict[str, tuple[str, ...]] = {}

    def restored(self, token: str) -> tuple[str, ...]:
        """The readings of a suspicious token: with repeated characters as one, and each for itself."""
        bare = token.strip(EDGES)
        if bare.isalpha():
            return (self.model.decode(bare), bare.lower()) if len(bare) >= 3 and DOUBLED.search(bare) else ()
        if not any(map(str.isalpha, bare)):
            if len(token) < 3 or NUMBER.fullmatch(bare) or not any(c in IMITATES for c in token):
                return ()
            forms = {token, bare, token.rstrip("!"), bare.rstrip("!" + EDGES)}
        elif len(bare) >= 3 and (INSIDE.search(bare) or DOUBLED.search(bare)):
            forms = {bare, bare.rstrip("!" + EDGES)}
            if DRAWN.search(token):
                forms.add(token)
        else:
            return ()
        return tuple(self.model.decode(f, repeats) for f in sorted(forms) if len(f) >= 3 for repeats in (True, False))

    def words(self, text: str) -> set[str]:
        """Distinct lower-case words of a text, with those that decoding restores."""
        tokens = set(text.split())
        out = {w for t in tokens for w in LETTER_RUN.findall(t.lower())}
        for t in tokens:
            out.update(self.restored(t))
        out.update(self.spread(text, tokens))
        return out

    def spread(self, text: str, tokens: set[str]) -> set[str]:
        """Words read from three letters or more with white space between, two of them different at least."""
        if sum([len(t) == 1 for t in tokens]) < 2:
            return set()
        out = set()
        for m in SPACED.finditer(text):     # a one-letter word may stand before or after the spread one
            for run in {m[0], *WIDE_GAP.split(m[0])}:       # a wide gap may part two spread words
                letters = "".join(run.split())
                for part in {letters, letters[1:], letters[:-1], letters[1:-1]}:
                    if len(part) >= 3:
                        out.add(self.model.decode(part))
        return out

    def found(self, token: str) -> tuple[str, ...]:
        words = {token.lower()} if token.isalpha() else {*LETTER_RUN.findall(token.lower())}
        words.update(self.restored(token))
        return tuple({t for w in words for t in terms_of(w) if self.only is None or t in self.only})

    def terms(self, text: str) -> set[str]:
        if len(self.seen) > KNOWN_WORDS:
            self.seen.clear()
        tokens = set(text.split())
        for t in tokens.difference(self.seen):
            self.seen[t] = self.found(t)
        out = set().union(*filter(None, map(self.seen.__getitem__, tokens)))
        for w in self.spread(text, tokens):
            out.update(t for t in terms_of(w) if self.only is None or t in self.only)
        return out


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 3 == 1


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of the training rows; their number is bounded by TRAIN_ROWS ids."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    ids = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "text", "toxic")


def _term_counts(train: DataFrame, counts: dict, toxic: int, only: frozenset | None) -> dict[str, int]:
    shared = train.sparkSession.sparkContext.broadcast((counts, only))

    def run(batches):
        counts_, only_ = shared.value
        reader, total = Reader(counts_, only_), Counter()
        for batch in batches:
            for x in batch.column("text"):
                total.update(reader.terms(x.as_py() or ""))
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array(list(total.values()), pa.int64())], ["term", "n"])

    summed = (train.where(F.col("toxic") == toxic).mapInArrow(run, "term string, n bigint").groupBy("term")
              .agg(F.sum("n").alias("n")))
    if only is None:
        summed = summed.where(F.col("n") >= LEAST_DOCS)
    return {r.term: r.n for r in summed.collect()}      # terms of at most TRAIN_ROWS documents


def features(terms: set[str], odds: dict[str, float]) -> tuple[float, float, float]:
    """Largest and second largest log-odds of a text, and their number."""
    got = sorted((odds[t] for t in terms if t in odds), reverse=True)
    return got[0] if got else 0.0, got[1] if len(got) > 1 else 0.0, math.log1p(len(got))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 30) -> np.ndarray:
    """Weights (the constant first) of a ridge-penalised logistic regression, by Newton steps."""
    a = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(a.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = a.T @ (a * (p * (1 - p))[:, None]) + penalty
        step = np.linalg.solve(h, a.T @ (y - p) - penalty @ w)
        w = w + np.clip(step, -3, 3)
    return w


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Language model counts, log-odds of terms and regression weights."""
    spark = docs.sparkSession
    ship(spark)
    counts = count_trigrams(docs)
    train = materialize(spark, _labelled(docs, labels), "toxic-train")
    size = {r.toxic: r["count"] for r in train.groupBy("toxic").count().collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1 or not n0:
        return {"counts": counts, "odds": {}, "weights": None, "rate": float(bool(n1))}
    bad = _term_counts(train, counts, 1, None)
    good = _term_counts(train, counts, 0, frozenset(bad))
    odds = {t: math.log((n + 0.5) / (n1 + 1)) - math.log((good.get(t, 0) + 0.5) / (n0 + 1)) for t, n in bad.items()}
    odds = {t: round(v, 6) for t, v in odds.items() if v >= LEAST_ODDS}
    model = {"counts": counts, "odds": odds, "weights": None, "rate": n1 / (n1 + n0)}
    rows = _featured(train.select("doc_id", "toxic", "text"), model, ["doc_id", "toxic"]).orderBy("doc_id").collect()
    x = np.array([r["f"] for r in rows], float)
    model["weights"] = logistic(x, np.array([r.toxic for r in rows], float)).tolist()
    return model


def _featured(docs: DataFrame, model: dict, keep: list[str]) -> DataFrame:
    from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

    shared = docs.sparkSession.sparkContext.broadcast((model["counts"], model["odds"]))

    def run(batches):
        counts, odds = shared.value
        reader = Reader(counts, odds)
        for batch in batches:
            f = [features(reader.terms(x.as_py() or ""), odds) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(f, pa.list_(pa.float64()))], [*keep, "f"])

    return docs.mapInArrow(run, StructType([*docs.select(*keep).schema.fields, StructField("f", ArrayType(DoubleType()))]))


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id, score`` of every row."""
    if model["weights"] is None:
        return docs.select("doc_id", F.lit(model["rate"]).alias("score"))
    w0, *w = model["weights"]
    f = _featured(docs.select("doc_id", "text"), model, ["doc_id"])
    z = F.lit(w0)
    for i, v in enumerate(w):
        z = z + F.col("f")[i] * v
    return f.select("doc_id", (1 / (1 + F.exp(-z))).alias("score"))


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    s = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return s.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                    F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
