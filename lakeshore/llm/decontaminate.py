"""Benchmark decontamination with a broadcast hash set of normalised test n-grams.

Words are maximal runs of digits, a-z and non-ASCII characters after A-Z is lower-cased. A
benchmark item gives a window for each 10 consecutive words, or one window of all its words if
it has fewer. Each document's window hashes are computed as arrays by doubling (1, 2, 4, 8 words)
and tested against the set of benchmark window hashes; the few positions that match are verified
by comparing the words themselves, and only those leave the row. Nothing of a text is shuffled.

The set travels with the tasks, so its size is counted first: up to ``MAX_SET`` windows as a hash set in the
expression. A larger benchmark is dealt by hash into slices of ``SLICE_BYTES`` (measured), each broadcast as the hash table of a
join that runs where the documents are read, one slice after another. Either way only places that match leave a
task, and a hit stands only if the document's words are the window's.

Nulls: null text has no words, neither in documents nor in items. Repeated rows get equal
results. Empty tables: no items means no hits; no documents means no rows.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize, once, table

N = 10                      # words of a window
MAX_SET = 50_000            # windows that the tasks may carry in the expression itself
SLICE_BYTES = 64 << 20      # windows of one broadcast slice: their words and ENTRY_BYTES each
ENTRY_BYTES = 64
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def item_words(text: Column) -> Column:
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(low, SEPARATORS + "+"), lambda w: w != "")


def _joined(a: Column, b: Column, at: int, size: Column) -> Column:
    """Hashes of a window and the one ``at`` words further on."""
    return F.zip_with(a, F.slice(b, at + 1, F.greatest(size, F.lit(1))), lambda x, y: F.xxhash64(x, y))


def _window_of(powers: dict, size: Column, length: int) -> Column:
    """Hashes of all windows of ``length`` words from those of 1, 2, 4 and 8 words (columns or their
    names): the window of 10 joins its first 2 words with the 8 that follow."""
    col = lambda p: F.col(powers[p]) if isinstance(powers[p], str) else powers[p]
    out, done = None, 0
    for p in (1, 2, 4, 8):
        if length & p:
            out, done = (col(p), p) if out is None else (_joined(out, col(p), done, size), done + p)
    return F.slice(out, 1, F.greatest(size - (length - 1), F.lit(0)))


def _hashes(hashes: Column, size: Column, length: int) -> Column:
    """The same within one expression, for small tables."""
    powers = {1: hashes}
    for p in (2, 4, 8):
        powers[p] = _joined(powers[p // 2], powers[p // 2], p // 2, size)
    return _window_of(powers, size, length)


def benchmark_windows(items: DataFrame) -> DataFrame:
    """(item_id, length, h, win): every window of every item with its hash; ``win`` is its words, blank-joined."""
    w = items.select(F.col("item_id").cast("string").alias("item_id"), item_words(F.col("text")).alias("w"))
    w = (w.withColumn("n", F.size("w")).where("n > 0")
         .withColumn("hw", F.transform("w", lambda x: F.xxhash64(x)))
         .withColumn("length", F.least(F.col("n"), F.lit(N))))
    hashes = reduce(lambda a, k: a.when(F.col("length") == k, _hashes(F.col("hw"), F.col("n"), k)),
                    range(2, N + 1), F.when(F.col("length") == 1, F.col("hw")))
    return (w.select("item_id", "length", "w", F.posexplode(hashes).alias("p", "h"))
            .select("item_id", "length", "h", F.array_join(F.expr("slice(w, p + 1, length)"), " ").alias("win"))
            .distinct())


def _set_of(windows: DataFrame) -> dict[int, tuple[list[int], list[str]]] | None:
    """Hashes and words of all distinct windows, by length; None if they are too many to send."""
    unique = windows.select("length", "h", "win").distinct()
    if unique.count() > MAX_SET:
        return None
    out: dict[int, tuple[list[int], list[str]]] = {}
    for r in unique.collect():      # at most MAX_SET rows
        out.setdefault(r.length, ([], []))[0].append(r.h)
        out[r.length][1].append(r.win)
    return out


def _in_list(values) -> str:
    # words hold neither quotes nor backslashes, hashes are 64-bit integers
    return ",".join(f"'{v}'" if isinstance(v, str) else f"{v}L" if v > -2**63 else "-1L - 9223372036854775807L"
                    for v in values)


HITS = "array<struct<pos:int,length:int,win:string>>"


def find(docs: DataFrame, windows: DataFrame, out: str, keep: list[Column]) -> DataFrame:
    """``keep`` plus ``out`` = struct(n_words, hits: array of (pos, length, win)) for every row: all
    places at which one of the stored ``windows`` occurs."""
    w, hw, n = (fresh(docs, f"__{c}") for c in ("w", "hw", "n"))
    base = (docs.withColumn(w, item_words(F.col("text"))).withColumn(n, F.size(w))
            .withColumn(hw, F.transform(w, lambda x: F.xxhash64(x))))
    sent = _set_of(windows)
    if sent is None:
        return _find_in_slices(base, windows, out, keep, (w, hw, n))
    base, columns = _with_hashes(base, hw, n, sorted(sent))
    arrays = [F.expr(f"cast(array() as {HITS})")]
    for k, (hashes, wins) in sorted(sent.items()):
        arrays.append(F.expr(f"""filter(
            transform({columns[k]}, (h, i) -> if(h IN ({_in_list(dict.fromkeys(hashes))}),
                struct(i AS pos, {k} AS length, array_join(slice({w}, i + 1, {k}), ' ') AS win), NULL)),
            c -> c IS NOT NULL AND c.win IN ({_in_list(dict.fromkeys(wins))}))"""))
    return base.select(*keep, F.struct(F.col(n).cast("long").alias("n_words"), F.concat(*arrays).alias("hits"),
                                       F.monotonically_increasing_id().alias("row")).alias(out))


def _with_hashes(base: DataFrame, hw: str, n: str, lengths: list[int]) -> tuple[DataFrame, dict[int, str]]:
    """``base`` with the window hashes of each of the ``lengths``, and their columns."""
    columns = {k: fresh(base, f"__h{k}") for k in lengths}
    # one projection per doubling: nested in one expression, each half would be computed anew
    powers = {1: hw}
    for p in (2, 4, 8):
        if p <= max(lengths, default=1):
            powers[p] = fresh(base, f"__p{p}")
            base = base.withColumn(powers[p], _joined(F.col(powers[p // 2]), F.col(powers[p // 2]), p // 2, F.col(n)))
    return base.withColumns({c: _window_of(powers, F.col(n), k) for k, c in columns.items()}), columns


def slices(windows: DataFrame) -> tuple[DataFrame, int]:
    """Distinct (length, h, win) with their ``slice``, and the number of slices that keeps each at some ``SLICE_BYTES``."""
    unique = windows.select("length", "h", "win").distinct()
    size = unique.agg(F.sum(F.octet_length("win").cast("long") + ENTRY_BYTES)).first()[0] or 0
    parts = max(1, -(-size // SLICE_BYTES))
    return materialize(windows.sparkSession, unique.withColumn("slice", F.pmod(F.xxhash64("h"), F.lit(parts)).cast("int")), "slices"), parts


def _find_in_slices(base: DataFrame, windows: DataFrame, out: str, keep: list[Column], names: tuple[str, str, str]) -> DataFrame:
    w, hw, n = names
    lengths = sorted(r.length for r in windows.select("length").distinct().collect())        # N at most
    rows, columns = _with_hashes(base, hw, n, lengths)

    def places(k: int) -> Column:
        return F.transform(columns[k], lambda h, i: F.struct(i.alias("pos"), F.lit(k).alias("length"), h.alias("h")))

    key, th, hit = (fresh(base, f"__{c}") for c in ("id", "th", "hits"))
    placed = rows.select(F.col("doc_id").alias(key), F.xxhash64("text").alias(th), F.inline(F.concat(*map(places, lengths))))
    dealt, parts = slices(windows)
    found = None
    for i in range(parts):          # one after another, so that the tasks hold one slice at a time
        part = F.broadcast(dealt.where(F.col("slice") == i).drop("slice"))
        met = materialize(base.sparkSession, placed.join(part, ["length", "h"]).select(key, th, "pos", "length", "win"), "met")
        found = met if found is None else found.unionByName(met)
    hits = found.groupBy(key, th).agg(F.collect_set(F.struct("pos", "length", "win")).alias(hit))   # places of one text
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.xxhash64("text") == F.col(th))
    true = F.expr(f"filter({hit}, c -> array_join(slice({w}, c.pos + 1, c.length), ' ') = c.win)")
    return base.join(hits, same, "left").select(*keep, F.struct(
        F.col(n).cast("long").alias("n_words"), F.coalesce(true, F.expr(f"cast(array() as {HITS})")).alias("hits"),
        F.monotonically_increasing_id().alias("row")).alias(out))


def covered(hits: Column) -> Column:
    """Sorted positions of the words inside any occurrence."""
    return F.array_sort(F.array_distinct(F.flatten(
        F.transform(hits, lambda c: F.sequence(c["pos"], c["pos"] + c["length"] - 1)))))


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, n_words, positions, item_ids) of every row: the hit words and, as an array sorted as
    strings, the items of which a window occurs."""
    spark = docs.sparkSession
    windows = materialize(spark, benchmark_windows(items), "benchmark-windows")
    # item texts may repeat, so a window has any number of items; a row is told by id and text
    found = materialize(spark, find(docs, windows, "f", [F.col("doc_id"), F.xxhash64("text").alias("th")]),
                        "hits")
    wins = (found.where(F.size("f.hits") > 0).select("doc_id", "th", F.explode(F.array_distinct("f.hits.win")).alias("win"))
            .distinct())
    of_row = (wins.join(windows.select("win", "item_id").distinct(), "win").groupBy("doc_id", "th")
              .agg(F.array_sort(F.collect_set("item_id")).alias("item_ids")))
    a, b = found.alias("a"), of_row.alias("b")
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & F.col("a.th").eqNullSafe(F.col("b.th"))
    return a.join(b, same, "left").select(
        "a.doc_id", F.col("a.f.n_words").alias("n_words"), covered(F.col("a.f.hits")).alias("positions"),
        F.coalesce(F.col("b.item_ids"), F.array().cast("array<string>")).alias("item_ids"))


def remove(docs: DataFrame, items: DataFrame, what: str = "documents") -> DataFrame:
    """``docs`` without contaminated documents, or (``what='spans'``) with the hit words and the
    separators after them cut from their texts. Columns and clean rows stay as they are."""
    if what not in ("documents", "spans"):
        raise ValueError(f"what: {what!r}")
    out = fresh(docs, "__found")
    names = [F.col(f"`{c}`") for c in docs.columns]
    windows = materialize(docs.sparkSession, benchmark_windows(items), "benchmark-windows")
    found = find(docs, windows, out, names)
    clean = F.size(F.col(out)["hits"]) == 0
    if what == "documents":
        return found.where(once(clean, F.col(out)["row"])).select(*names)
    # a word with the separators after it, in the original spelling
    pieces = F.regexp_extract_all("text", F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)([\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)"), 0)
    head = F.regexp_extract("text", r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", 0)
    hit, cut = fresh(found, "__hit"), fresh(found, "__pieces")
    marked = found.withColumn(hit, covered(F.col(out)["hits"])).withColumn(cut, pieces)
    left = F.concat(head, F.array_join(F.filter(F.transform(
        F.col(cut), lambda p, i: F.when(~F.array_contains(F.col(hit), i), p)), lambda p: p.isNotNull()), ""))
    text = F.when(clean, F.col("text")).otherwise(left)
    return marked.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir):
    c = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return c.select("doc_id", "n_words", F.size("positions").cast("long").alias("n_hit"),
                    F.size("item_ids").cast("long").alias("n_items"),
                    F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                    (F.size("positions") > 0).alias("contaminated"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(ws), 10) AS k, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS win
        FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT k FROM win),
pos AS (SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS win
        FROM (SELECT doc_id, k, ws, unnest(range(1, len(ws) - k + 2)) AS i FROM d CROSS JOIN lens WHERE len(ws) >= k)),
hit AS (SELECT doc_id, i, pos.k, win.item_id FROM pos JOIN win USING (win)),
ids AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id COLLATE C) AS s
        FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(cov.n, 0)::BIGINT AS n_hit, coalesce(ids.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids.s, '')) AS items_sha256, cov.n IS NOT NULL AS contaminated
FROM d LEFT JOIN ids USING (doc_id) LEFT JOIN cov USING (doc_id)
"""
