"""Near-duplicate documents by Order MinHash, verified by banded alignment.

Words are runs of ASCII letters (lower-cased), digits and non-ASCII characters. A document's ``K``-word
shingles are labelled with their occurrence number; each of ``SKETCHES`` hash functions samples its ``MINIMA`` smallest labelled
shingles, and their hashes in text order form a bucket key, so that equal keys tell shared shingles
in shared order; neighbouring keys joined give finer buckets, which part large ones into the likes of
each other. At a similarity of 0.8 a single key of long texts agrees with probability about 0.41 if the shared shingles stand
in the same order; a text of four shingles and one of five agree with 0.2 only. So texts of at most ``SHORT`` shingles are
compared with all that an exact prefix filter leaves possible, whatever their keys; pairs of longer texts with that order all
``SKETCHES`` miss with less than 4e-5, with another order more often. In each bucket documents are compared with its *hub*, the document that meets most others
in its buckets (of near-copies, the text they derive from). Documents of buckets that then still hold several
components are compared further, where an exact prefix filter leaves a pair possible. A pair is linked if the Jaccard similarity of the labelled shingles and the share of
words matched by a banded alignment both reach ``SIMILARITY``; classes are the connected components.

Exact copies are grouped first and only their first document is compared, so a bucket holds each text
once. Hubs are maxima per key (partial before the shuffle) and a document meets a hub once: no bucket
is collected and no bucket's pairs are formed.

Rows with one doc_id count as one document. Rows without doc_id are not compared: their class is null.
Null, empty and word-free texts equal each other only if the same. An empty table gives no rows.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats, suffix
from .anchors import gram_hashes, join_hashes
from .common import byte_sizes, materialize, ship, sub_batches, table, tidied
from .components import components
from .substring import word_hashes

K, SIMILARITY = 5, 0.8
SKETCHES, MINIMA = 20, 4
SHORT = 40                          # shingles; shorter texts need no shared key
PARTNER = int(SHORT / SIMILARITY)   # the most shingles a partner of a short text has
CELLS = 1 << 20                     # counters of shingle frequencies (8 MB, sent to the tasks)
TASK_BYTES = 8 << 20                # text handled at once by a task (packed text: a quarter)
WIDE = 200_000                      # labelled shingles times functions hashed at once
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEEDS = np.random.default_rng(7).integers(1, 1 << 63, (SKETCHES, 2), dtype=np.uint64) | np.uint64(1)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    flat, edges = suffix.tokens(texts)
    return word_hashes(_LOWER[flat], _LETTER[flat], edges)


def labelled(words: np.ndarray) -> np.ndarray:
    """Hashes of the shingles with their occurrence numbers, in text order; a text of fewer than K
    words is one shingle, one without words has none."""
    if not len(words):
        return words
    s = gram_hashes(words, K) if len(words) >= K else join_hashes(gram_hashes(words, len(words)), np.full(1, len(words), np.uint64))
    order = np.argsort(s, kind="stable")
    first = np.append(True, s[order][1:] != s[order][:-1])
    at = np.arange(len(s))
    nth = np.empty(len(s), np.uint64)
    nth[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    return join_hashes(s, nth)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The bucket keys of a document: its first hash functions' smallest shingles, in text order."""
    take = min(MINIMA, len(shingles))
    keys = np.empty(SKETCHES, np.uint64)
    step = max(1, WIDE // len(shingles))
    for a in range(0, SKETCHES, step):
        seeds = _SEEDS[a:a + step]
        h = (shingles[None] ^ seeds[:, :1]) * seeds[:, 1:]
        h ^= h >> np.uint64(32)
        h *= seeds[:, 1:]
        at = np.argpartition(h, take - 1, axis=1)[:, :take] if take < len(shingles) else np.tile(np.arange(take), (len(seeds), 1))
        low = shingles[np.sort(at, axis=1)]             # text order
        key = np.arange(a, a + len(seeds)).astype(np.uint64)
        for i in range(take):
            key = join_hashes(key, low[:, i])
        keys[a:a + len(seeds)] = key
    return keys


def _scan(batches):
    """doc, digest of the words, bucket keys (null for all but the first of equal texts in a batch), and whether the
    text is short or may be like a short one."""
    for batch in (part for b in batches for part in sub_batches(b, byte_sizes(b, "text"), TASK_BYTES)):
        doc = np.asarray(batch.column("doc"))
        order = np.argsort(doc, kind="stable")
        words, edges = tokens(batch.column("text").take(pa.array(order)))
        seen: set[bytes] = set()
        digests, keys, short = [], [], []
        for i in range(len(order)):
            w = words[edges[i]:edges[i + 1]]
            digest = hashlib.blake2b(w.tobytes(), digest_size=16).digest()
            digests.append(digest)
            short.append(0 < len(w) < PARTNER + K)
            if digest in seen or not len(w):
                keys.append(None)
                continue
            seen.add(digest)
            k = sketch(labelled(w))
            keys.append(np.concatenate([k, join_hashes(k, np.roll(k, -1))]).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(doc[order]), pa.array(digests, pa.binary()), pa.array(keys, pa.binary()),
                                          pa.array(short)], ["doc", "digest", "keys", "short"])


def _unpack(batches):
    for batch in batches:
        keys = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("keys")]
        if keys:
            doc = np.repeat(np.asarray(batch.column("doc")), [len(k) for k in keys])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(doc)], ["key", "doc"])


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sets of labelled shingles (labels make repeated ones distinct)."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / max(1, len(a) + len(b) - shared)


def aligned(a: list, b: list, least: float) -> bool:
    """Whether an alignment matches a share of at least ``least`` of both texts' words: the furthest
    reach on each diagonal is advanced edit by edit, inside the band that ``least`` leaves."""
    most = int((1 - least) * (len(a) + len(b)) + 1e-9)       # insertions and deletions
    if abs(len(a) - len(b)) > most:
        return False
    lead = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        lead += 1
    a, b = a[lead:], b[lead:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
        if len(a) > 64 and len(b) > 64 and a[-64:] == b[-64:]:
            a, b = a[:-63], b[:-63]
    n, m = len(a), len(b)
    reach = {1: 0}
    for d in range(most + 1):
        for k in range(-d, d + 1, 2):
            if k < -m or k > n:
                continue
            down, right = reach.get(k + 1, -1), reach.get(k - 1, -1) + 1
            x = down if k == -d or (k != d and down >= right) else right
            if x < 0:
                continue
            y = x - k
            while x < n and y < m and a[x] == b[y]:
                x, y = x + 1, y + 1
            reach[k] = x
            if x >= n and y >= m:
                return True
    return False


def _verify(batches):
    for batch in (part for b in batches for part in sub_batches(b, byte_sizes(b, "za", "zb"), TASK_BYTES // 4)):
        ta, ea = tokens(repeats.unpacked(batch.column("za")))
        tb, eb = tokens(repeats.unpacked(batch.column("zb")))
        good = np.zeros(batch.num_rows, bool)
        for i in range(batch.num_rows):
            a, b = ta[ea[i]:ea[i + 1]], tb[eb[i]:eb[i + 1]]
            if min(len(a), len(b)) < SIMILARITY * max(len(a), len(b)) - 2 * K:
                continue
            if jaccard(labelled(a), labelled(b)) >= SIMILARITY:
                good[i] = aligned(a.tolist(), b.tolist(), SIMILARITY)
        keep = pa.array(good)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])


def _buckets(spark, seen: DataFrame, alone: DataFrame) -> DataFrame:
    """``key, doc, weight`` of all keys that several documents have. The weight of a document is the
    number of meetings in its buckets: of near-copies it is largest for the text the others derive from."""
    keyed = (seen.where("keys IS NOT NULL").join(alone, "doc", "left_semi").select("doc", "keys")
             .mapInArrow(tidied(_unpack), "key bigint, doc bigint"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialize(spark, keyed.join(sizes, "key"), "shared-keys")
    weight = shared.groupBy("doc").agg(F.sum("n").alias("weight"))
    return materialize(spark, shared.select("key", "doc").join(weight, "doc"), "buckets")


def _checked(spark, pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """The pairs (a, b) that verification links."""
    both = (pairs.join(texts.select(F.col("doc").alias("a"), F.col("z").alias("za")), "a")
            .join(texts.select(F.col("doc").alias("b"), F.col("z").alias("zb")), "b"))
    return materialize(spark, both.mapInArrow(tidied(_verify), "a bigint, b bigint"), name)


def _components_of(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` plus the component of each doc: its root, or itself where it has no link."""
    root = components(links).toDF("doc", "root")
    return rows.join(root, "doc", "left").withColumn("comp", F.coalesce("root", "doc")).drop("root")


def _links(spark, named: DataFrame, buckets: DataFrame, short: DataFrame) -> DataFrame:
    """Verified links: of every document with the hubs of its buckets, then (``_rest``) of what the buckets
    still hold in several components and of the ``short`` documents."""
    wanted = buckets.select("doc").unionByName(short.select("doc")).distinct()
    texts = materialize(spark, named.mapInArrow(tidied(_shrink), "doc bigint, z binary").join(wanted, "doc", "left_semi")
                        .dropDuplicates(["doc"]), "candidates")
    hubs = buckets.groupBy("key").agg(F.max(F.struct("weight", (-F.col("doc")).alias("minus"))).alias("top"))
    met = buckets.join(hubs.select("key", (-F.col("top.minus")).alias("hub")), "key").where("doc <> hub")
    pairs = met.select(F.least("hub", "doc").alias("a"), F.greatest("hub", "doc").alias("b")).distinct()
    first = _checked(spark, pairs, texts, "hub-links")
    held = buckets.select("key", "doc").unionByName(short.select(F.lit(None).cast("long").alias("key"), "doc"))
    inside = materialize(spark, _components_of(held, first), "bucket-components")
    open_ = (inside.where("key IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high"))
             .where("n > 2 AND low <> high").select("key"))
    undecided = (inside.join(open_, "key", "left_semi").select("doc", "comp")
                 .unionByName(inside.where("key IS NULL").select("doc", "comp")).distinct())
    rest = materialize(spark, texts.join(undecided, "doc"), "undecided")
    return first.unionByName(_rest(spark, rest, texts))


def _frequencies(batches):
    """How many documents have a shingle, by hashed cell: sums of a task."""
    total = np.zeros(CELLS, np.int64)
    for batch in (part for b in batches for part in sub_batches(b, byte_sizes(b, "z"), TASK_BYTES // 4)):
        t, e = tokens(repeats.unpacked(batch.column("z")))
        for a, b in zip(e, e[1:], strict=False):
            np.add.at(total, (labelled(t[a:b]) % np.uint64(CELLS)).astype(np.int64), 1)
    at = np.flatnonzero(total)
    if len(at):
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])


def _rest(spark, rest: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between components among ``rest`` (doc, z, comp), by an exact prefix filter: with all
    shingles in one global order, rare first, two documents of similarity s share one among the first
    n - o + 1 of each, where o = s / (1 + s) * (n1 + n2) is the overlap that s takes. Rarity is
    counted in a fixed number of cells; the order only has to be the same everywhere. Per shingle,
    only documents outside the component that is most frequent there look for partners."""
    cells = rest.select("z").mapInArrow(tidied(_frequencies), "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = np.zeros(CELLS, np.int64)
    got = cells.toArrow()                   # CELLS rows at most
    counts[np.asarray(got["cell"])] = np.asarray(got["n"])
    shared = spark.sparkContext.broadcast(counts)

    def prefixes(batches):
        for batch in (part for b in batches for part in sub_batches(b, byte_sizes(b, "z"), TASK_BYTES // 4)):
            t, e = tokens(repeats.unpacked(batch.column("z")))
            parts: list[list] = [[], [], [], [], []]
            for i, (doc, comp) in enumerate(zip(batch.column("doc").to_pylist(), batch.column("comp").to_pylist(), strict=True)):
                s = labelled(t[e[i]:e[i + 1]])
                n = len(s)
                take = n - int(np.ceil(SIMILARITY * n - 1e-9)) + 1 if n else 0
                order = np.lexsort((s, shared.value[(s % np.uint64(CELLS)).astype(np.int64)]))[:take]
                for part, v in zip(parts, (s[order].view(np.int64), np.full(len(order), doc), np.full(len(order), comp),
                                           np.arange(len(order)), np.full(len(order), n)), strict=True):
                    part.append(v)
            if parts[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in parts],
                                                 ["shingle", "doc", "comp", "pos", "n"])

    rows = materialize(spark, rest.mapInArrow(tidied(prefixes), "shingle bigint, doc bigint, comp bigint, pos bigint, n bigint"), "prefixes")
    by_comp = rows.groupBy("shingle", "comp").agg(F.count(F.lit(1)).alias("m"))
    main = (by_comp.groupBy("shingle").agg(F.max(F.struct("m", "comp")).alias("top"), F.count(F.lit(1)).alias("comps"))
            .where("comps > 1").select("shingle", F.col("top.comp").alias("main")))
    open_ = rows.join(main, "shingle")
    x, y = open_.where("comp <> main").alias("x"), open_.alias("y")
    overlap = F.ceil((F.col("x.n") + F.col("y.n")) * (SIMILARITY / (1 + SIMILARITY)) - 1e-9)
    near = ((F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.comp") != F.col("y.comp"))
            & ((F.col("y.comp") == F.col("y.main")) | (F.col("x.doc") < F.col("y.doc")))
            & (F.col("x.pos") <= F.col("x.n") - overlap) & (F.col("y.pos") <= F.col("y.n") - overlap))
    pairs = x.join(y, near).select(F.least("x.doc", "y.doc").alias("a"), F.greatest("x.doc", "y.doc").alias("b")).distinct()
    return _checked(spark, pairs, texts, "rest-links")


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id`` of every row: the smallest doc_id of its class."""
    spark = docs.sparkSession
    ship(spark)
    named = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc"), "text")
    seen = materialize(spark, named.mapInArrow(tidied(_scan), "doc bigint, digest binary, keys binary, short boolean"), "omh")
    firsts = seen.groupBy("digest").agg(F.min("doc").alias("rep"))
    # a document whose text was seen before stands behind that text's first document
    member = materialize(spark, seen.join(firsts, "digest").groupBy("doc").agg(F.min("rep").alias("rep")), "members")
    alone = member.where("doc = rep").select("doc")
    short = seen.where("short").select("doc").join(alone, "doc", "left_semi")
    root = components(_links(spark, named, _buckets(spark, seen, alone), short))
    named_class = member.join(root, member.rep == root.node, "left").select(
        F.col("doc").alias("__doc"), F.coalesce("root", "rep").alias("class_id"))
    return docs.select("doc_id").join(named_class, F.col("doc_id").cast("long") == F.col("__doc"), "left").select("doc_id", "class_id")


def _shrink(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("doc"), repeats.packed(b.column("text"))], ["doc", "z"])


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class: the one with the smallest doc_id. Rows without
    doc_id stay; of rows that share the doc_id that stays, all stay."""
    gone = classes(docs.select("doc_id", "text")).where("class_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir):
    return classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
