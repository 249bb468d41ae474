"""Phrase collocations of 2 to ``LONGEST`` words by SON partitioning.

ASCII letters are lower-cased, texts are cut at ``.,;:!?`` and line ends into pieces, pieces at blanks and tabs into
words. Everything is per language (null: ``und``). Candidates are phrases that occur, overlaps included, at least
``SUPPORT`` times.

**SON.** A shard is some ``SHARD_BYTES`` of neighbouring texts of one language, mined whole in a task's memory. It
reports each phrase that reaches its proportional share of the support, ``ceil(SUPPORT * shard bytes / language bytes)``: a phrase that
falls short in every shard falls short in all, so the union of what shards report has every candidate. What a
phrase can still have in shards that do not report it is known (their shares less one, summed), and
phrases that cannot reach the support with it are dropped from the union. Then all of the union is counted again in all
texts, exactly. Lengths follow one another: one scan counts the union of length k and mines length k + 1 from phrases
whose parts of k words are in that union (parts occur at least as often); ``LONGEST`` scans in all. What is mined goes out as 64-bit
hashes, which only say what to count; counts are of texts. Every shard of a scan stands for itself,
so another cutting of the input into tasks, or a task run again, changes nothing. Once a language has
more than ``SUPPORT`` shards its share is 1, and shards report all they have.

**Filter.** Tasks learn a union as a Bloom filter of ``FILTER_BITS`` (a fixed size, whatever the data), built
by partial aggregation. A false positive only costs a count that the exact join with the support drops again.

**Plan.** Tasks send one row per (phrase, shard), pre-aggregated before the shuffle. Scores, containment and the
top rows are joins and a limited ranking over the candidates alone. All products are decimals of 38 digits.

A cut after k words scores ``floor(2000000 * a / (l + r))``; the lowest-scoring cut counts, ties to the smallest k. A
candidate inside a longer candidate with at least 80 % of its count is dropped. Ranks go by score, count (both
falling), then phrase in UTF-8 byte order. Null texts are empty; repeated rows count each; an empty table
gives no rows; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshore.session import materialize

from .common import byte_sizes, ship, sub_batches, table

SUPPORT = 30
LONGEST = 4
TOP = 2000
SCALE = 2_000_000
COVERED = 80                    # per cent of a phrase's count that a longer one must have to replace it
SHARD_BYTES = 500_000
ROWS_OUT = 20_000               # rows of a batch that a task hands on
FILTER_BITS = 1 << 26           # 8 MB a filter
LANGUAGES = 10_000              # languages whose size is sent to the tasks; the shards of others report everything

# the two kinds of separators, as bytes
BLANKS, CUTS = b" \t", b".,;:!?\n\x0b\x0c\r"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_KIND = np.zeros(256, np.uint8)                     # 0 part of a word, 1 blank, 2 cut
_KIND[list(BLANKS)] = 1
_KIND[list(CUTS)] = 2

# Counted phrases go out as text, mined ones as a hash (of language and words) and the language's number; a shard's
# own row has a language and no phrase.
REPORT = "words int, hash bigint, lang string, phrase string, number int, n bigint, spare bigint"
ARROW = pa.schema([("words", pa.int32()), ("hash", pa.int64()), ("lang", pa.string()), ("phrase", pa.string()),
                   ("number", pa.int32()), ("n", pa.int64()), ("spare", pa.int64())])


# --- a shard in memory ------------------------------------------------------------------------------------

def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def word_hashes(words: pa.Array, lang: str) -> np.ndarray:
    """Hashes of a binary array's values, cut from its bytes: an object of Arrow's for each costs several times the hash."""
    from xxhash import xxh3_64_intdigest

    seed = xxh3_64_intdigest(lang.encode())
    _, edges, raw = words.buffers()
    raw = b"" if raw is None else raw.to_pybytes()
    edges = np.frombuffer(edges, np.int32, len(words) + 1, words.offset * 4).tolist() if len(words) else [0]
    return np.array([xxh3_64_intdigest(raw[a:b], seed) for a, b in pairwise(edges)], np.uint64)


def seen(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the filter holds each hash (two places of a hash)."""
    return _bit(bits, hashes) & _bit(bits, hashes >> np.uint64(32))


def _bit(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(len(bits) * 8 - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


class Shard:
    """Words of some texts as numbers, with the places where a phrase of k words may begin."""

    def __init__(self, texts: list[pa.Array], lang: str):
        col = pa.concat_arrays(texts)
        edges = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
        raw = np.frombuffer(col.buffers()[2], np.uint8)[edges[0]:edges[-1]] if col.buffers()[2] is not None else np.zeros(0, np.uint8)
        edges = edges - edges[0]
        kind = _KIND[raw]
        inside = kind == 0
        opens = np.zeros(len(raw) + 1, bool)                # a word that touches a text's edge ends there
        opens[edges] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | opens[1:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | opens[1:-1]
        begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        opens[:-1] |= kind == 2
        piece = np.searchsorted(np.flatnonzero(opens), begins, "right")     # equal numbers: no cut between
        sizes = np.concatenate([[0], np.cumsum(ends - begins)]).astype(np.int32)
        kept = _LOWER[raw[inside]]
        coded = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(sizes), pa.py_buffer(kept)]).dictionary_encode()
        self.word = np.asarray(coded.indices).astype(np.int64)
        self.names = coded.dictionary
        self.next = np.zeros(len(self.word), bool)          # the next word follows in the same piece
        self.next[:-1] = piece[1:] == piece[:-1]
        self.of_word = word_hashes(self.names, lang)
        self.hash = [self.of_word[self.word]] if len(self.word) else [np.zeros(0, np.uint64)]

    def hashes(self, k: int) -> np.ndarray:
        """Hash of the phrase of k words from each place (nonsense where it does not fit)."""
        while len(self.hash) < k:
            last, w = self.hash[-1], self.hash[0]
            self.hash.append(_mixed(last * np.uint64(0x100000001B3) + _ahead(w, len(self.hash))))
        return self.hash[k - 1]

    def fits(self, k: int, j: int, bits: np.ndarray | None) -> np.ndarray:
        """Places of phrases of k words that stay in a piece and of which the filter holds each stretch of j words."""
        ok = np.ones(len(self.word), bool)
        for step in range(k - 1):
            ok &= _ahead(self.next, step)
        if bits is not None:
            held = seen(bits, self.hashes(j))
            for step in range(k - j + 1):
                ok &= _ahead(held, step)
        return np.flatnonzero(ok)

    def counted(self, k: int, places: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(a place of, number of) each distinct phrase of k words at ``places`` that occurs ``least`` times."""
        key = self.word[places] if len(places) else places
        for j in range(1, k):
            if j > 1:       # numbers of distinct shorter phrases, so that a key stays within 64 bits
                key = np.unique(key, return_inverse=True)[1]
            key = key * (len(self.names) + 1) + self.word[places + j]
        _, at, n = np.unique(key, return_index=True, return_counts=True)
        return places[at[n >= least]], n[n >= least]

    def rows(self, k: int, places: np.ndarray, n: np.ndarray, spare: int = 0, number: int = -1,
             lang: str | None = None) -> Iterator[pa.RecordBatch]:
        """The phrases at ``places``, as text if ``lang`` is given."""
        for at in range(0, len(places), ROWS_OUT):
            here = places[at:at + ROWS_OUT]
            size = len(here)
            if lang is None:
                text = [pa.nulls(size, pa.string())] * 2
            else:
                parts = [self.names.take(pa.array(self.word[here + j])) for j in range(k)]
                phrase = parts[0] if k == 1 else pc.binary_join_element_wise(*parts, b" ")
                text = [pa.repeat(lang, size).cast(pa.string()), phrase.cast(pa.string())]
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(k, pa.int32()), size), pa.array(self.hashes(k)[here].view(np.int64)), *text,
                 pa.repeat(pa.scalar(number, pa.int32()), size), pa.array(n[at:at + ROWS_OUT].astype(np.int64)),
                 pa.repeat(pa.scalar(spare, pa.int64()), size)], schema=ARROW)


def _ahead(flags: np.ndarray, by: int) -> np.ndarray:
    """What lies ``by`` places on; 0 past the end."""
    if not by:
        return flags
    out = np.zeros_like(flags)
    out[:max(0, len(flags) - by)] = flags[by:]
    return out


def share(support: int, part: int, whole: int) -> int:
    """A shard's share of the support, at least 1."""
    return max(1, -(-support * part // whole)) if whole else 1


# --- scans -----------------------------------------------------------------------------------------------

def _shards(batches, most: int) -> Iterator[tuple[str, list[pa.Array], int]]:
    """(lang, texts, bytes) of about ``most`` bytes, all languages of a task together."""
    held: dict[str, list[pa.Array]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        for part in sub_batches(batch, byte_sizes(batch, "text"), most):
            langs = part.column("lang")
            for lang in pc.unique(langs).to_pylist():
                own = part.filter(pc.equal(langs, lang)) if lang is not None else part
                held.setdefault(lang, []).append(own.column("text").cast(pa.string()))
                sizes[lang] = sizes.get(lang, 0) + int(byte_sizes(own, "text").sum())
            if sum(sizes.values()) >= most:
                yield from ((lang, held.pop(lang), sizes[lang]) for lang in list(held))
                sizes = {}
    yield from ((lang, held.pop(lang), sizes[lang]) for lang in list(held))


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(lang), F.lit("und")).alias("lang"))


def _sizes(texts: DataFrame) -> dict[str, tuple[int, int]]:
    """(number, bytes) of the largest languages, at most ``LANGUAGES`` rows; a language left out has share 1 everywhere."""
    of = texts.groupBy("lang").agg(F.sum(F.octet_length("text").cast("long")).alias("n"))
    return {r.lang: (i, r.n) for i, r in enumerate(of.orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect())}


def _scan(texts: DataFrame, support: int, sizes, count: int, mine: int, known) -> DataFrame:
    """One pass: exact shard counts of the phrases of ``count`` words that the filter ``known`` holds (all, without one), and
    the phrases of ``mine`` words (none if 0) of parts that it holds and that reach the shard's share, with the share less
    one; and for each shard what any unreported phrase may have there."""
    shared = texts.sparkSession.sparkContext.broadcast(sizes)
    shard_bytes = SHARD_BYTES

    def run(batches):
        bits = None if known is None else np.frombuffer(known.value, np.uint8)
        for lang, parts, size in _shards(batches, shard_bytes):
            shard = Shard(parts, lang)
            yield from shard.rows(count, *shard.counted(count, shard.fits(count, count, bits), 1), lang=lang)
            if mine:
                number, whole = shared.value.get(lang, (-1, 0))
                least = share(support, size, whole)
                yield from shard.rows(mine, *shard.counted(mine, shard.fits(mine, count, bits), least), least - 1, number)
                yield pa.RecordBatch.from_pylist([{"words": mine, "hash": 0, "lang": lang, "number": number, "n": 0, "spare": least - 1}], ARROW)
            del shard, parts
            pa.default_memory_pool().release_unused()

    return texts.mapInArrow(run, REPORT)


def _union(reports: DataFrame, support: int) -> DataFrame:
    """Hashes of phrases that can reach the support: reported counts plus the spare of the shards that did not report."""
    spare = reports.filter("lang IS NOT NULL").groupBy("number").agg(F.sum("spare").alias("all_spare"))
    return (reports.filter("lang IS NULL").join(spare, "number")
            .filter(F.col("n") + F.col("all_spare") - F.col("spare") >= support).select("hash"))


def bloom(spark: SparkSession, hashes: DataFrame, bits: int) -> bytes:
    """A filter of ``bits`` bits (a power of two) over the column ``hash``: rows set bits in partial aggregates of
    4 KB, and at most ``bits / 32768`` of those reach the driver."""
    places = hashes.select(F.explode(F.array(F.col("hash"), F.shiftrightunsigned("hash", 32))).alias("h"))
    at = places.select(F.col("h").bitwiseAND(F.lit(bits - 1)).alias("at"))
    maps = at.groupBy(F.floor(F.col("at") / 32768).alias("bucket")).agg(
        F.bitmap_construct_agg((F.col("at") % 32768).cast("long")).alias("map"))
    out = bytearray(bits // 8)
    for r in maps.toLocalIterator():
        out[r.bucket * 4096:r.bucket * 4096 + len(r.map)] = r.map
    return bytes(out)


def frequent(docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT,
             longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """``(phrases, totals)``: exact counts ``n`` of every phrase of 1 to ``longest`` words that occurs ``support``
    times (columns lang, phrase, words, n), and per language the number ``n`` of all words."""
    spark = docs.sparkSession
    ship(spark)
    texts = _texts(docs, text, lang)
    sizes = _sizes(texts)
    found, totals, known = [], None, None
    for k in range(1, longest + 1):
        rows = _scan(texts, support, sizes, k, k + 1 if k < longest else 0, known)
        sums = materialize(spark, rows.groupBy("words", "hash", "lang", "phrase").agg(
            F.sum("n").alias("n"), F.sum("spare").alias("spare"), F.min("number").alias("number")), f"phrases-{k}")
        found.append(sums.filter((F.col("words") == k) & (F.col("n") >= support)).select("lang", "phrase", "words", "n"))
        mined = sums.filter(F.col("words") == k + 1)
        if k == 1:
            totals = sums.filter(F.col("words") == 1).groupBy("lang").agg(F.sum("n").alias("n"))
        if k < longest:
            known = spark.sparkContext.broadcast(bloom(spark, _union(mined, support), FILTER_BITS))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out, totals


# --- scores -----------------------------------------------------------------------------------------------

def _stretch(first, last) -> F.Column:
    """Words ``first`` to ``last`` (from 1) of the array column ``w`` as a phrase."""
    return F.array_join(F.slice("w", first, last - first + 1), " ")


def scored(phrases: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Candidates of :func:`frequent`'s phrases with their lowest-scoring cut: lang, phrase, words, a, l, r, score."""
    parts = phrases.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    whole = phrases.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = F.array(*[F.when(F.col("words") > k, F.struct(
        F.lit(k).alias("k"), _stretch(1, k).alias("first"),
        F.array_join(F.slice("w", k + 1, longest), " ").alias("rest"))) for k in range(1, longest)])
    cut = whole.select("lang", "phrase", "words", "a", F.explode(F.array_compact(cuts)).alias("cut")) \
        .select("lang", "phrase", "words", "a", "cut.k", F.col("cut.first").alias("first"), F.col("cut.rest").alias("rest"))
    for side, count in (("first", "l"), ("rest", "r")):
        cut = cut.join(parts.withColumnRenamed("part", side).withColumnRenamed("f", count), ["lang", side])
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    exact = F.expr(f"CAST(CAST({SCALE} AS DECIMAL(10,0)) * CAST(a AS DECIMAL(20,0)) AS DECIMAL(38,0)) div CAST(total AS DECIMAL(38,0))")
    best = F.min(F.struct("score", "k", "l", "r")).alias("b")
    return (cut.withColumn("total", wide("l") + wide("r")).withColumn("score", exact)
            .groupBy("lang", "phrase", "words", "a").agg(best).select("lang", "phrase", "words", "a", "b.l", "b.r", "b.score"))


def uncovered(candidates: DataFrame, phrases: DataFrame, covered: int = COVERED, longest: int = LONGEST) -> DataFrame:
    """``candidates`` without those inside a longer phrase that has ``covered`` per cent of their count."""
    longer = phrases.filter("words > 2").select("lang", "words", "n", F.split("phrase", " ").alias("w"))
    inner = F.array(*[F.when(F.col("words") >= at + size - 1, _stretch(at, at + size - 1))
                      for size in range(2, longest) for at in range(1, longest - size + 2)])
    shorter = F.filter(inner, lambda p: p.isNotNull() & (p != F.array_join("w", " ")))
    held = (longer.select("lang", "n", F.explode(F.array_distinct(shorter)).alias("phrase"))
            .groupBy("lang", "phrase").agg(F.max("n").alias("most")))
    ten = lambda c, by: F.col(c).cast("decimal(20,0)") * by
    return (candidates.join(held, ["lang", "phrase"], "left")
            .filter(F.col("most").isNull() | (ten("most", 100) < ten("a", covered))).drop("most"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT, longest: int = LONGEST,
                 covered: int = COVERED) -> DataFrame:
    """All scored candidates that no longer one covers: lang, phrase, words, a, l, r, n, score."""
    phrases, totals = frequent(docs, text, lang, support, longest)
    return uncovered(scored(phrases, longest), phrases, covered, longest).join(totals, "lang")


def top(scored_phrases: DataFrame, most: int = TOP) -> DataFrame:
    """The first ``most`` of each language with their ``rank``; tasks keep no more than that before the shuffle."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return scored_phrases.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def query(spark, sf_dir):
    return top(collocations(table(spark, sf_dir, "documents"))).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", *[F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")])


ORACLE = r"""
WITH pieces AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM (
    SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
  FROM w, (VALUES (1), (2), (3), (4)) AS ks(k) WHERE len(w) >= k),
counts AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
frequent AS (SELECT *, string_split(phrase, ' ') AS p FROM counts WHERE f >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.k, c.f AS a, cut, l.f AS l, r.f AS r, (2000000::HUGEINT * c.f) // (l.f + r.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM frequent WHERE k > 1) c
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.p[1:cut], ' ') AND l.k = cut
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.p[cut + 1:], ' ') AND r.k = c.k - cut),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, array_to_string(p[i:i + s - 1], ' ') AS phrase, max(f) AS most
  FROM (SELECT *, unnest(range(2, k)) AS s FROM frequent WHERE k > 2) q, unnest(range(1, q.k - q.s + 2)) AS t(i) GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE i.most IS NULL OR 100 * i.most < 80 * b.a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, encode(k.phrase))::BIGINT AS rank, k.phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, t.n, score::BIGINT AS score
FROM kept k JOIN totals t ON t.lang = k.lang QUALIFY rank <= 2000
"""
