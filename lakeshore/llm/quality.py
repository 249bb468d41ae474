"""Quality rules with adaptive thresholds.

Every document is measured with built-in functions. Per (language, source) the measures feed a
mergeable quantile sketch: a value keeps its ``SKETCH_BITS`` leading bits, and the sketch is the
count of each such rounded value (relative error below 2**-(SKETCH_BITS - 1)). Sketches of
sources add up to the sketch of their language and of the corpus, which serve groups of fewer
than ``MIN_GROUP`` measured documents. A document is rejected when a measure lies beyond a
fence derived from its group's quantiles: above the 90 % quantile by more than ``SPREAD`` times its distance from
the median and a margin, or so below the 10 % quantile. The margin alone is the fence only of a group in which nine in
ten have none of what is measured. The fence is joined to the rows.

Nulls: null text has no words (and fails the base rule); null lang or source is a group of its
own. Repeated rows are judged alike. An empty table gives an empty result.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize, once, shifted, words

MIN_WORDS = 50           # base rule: fewer words fail
MAX_REPEATED = 50        # base rule: per cent of words in repeated 3-word windows
SYMBOLS = "#*$%&|<>"
SKETCH_BITS = 6
MIN_GROUP = 50
SPREAD = 2               # fence = 90 % quantile + SPREAD * (90 % quantile - median) + margin, and so below
#: measure -> (margin above, margin below or None); in the measure's unit
RULES: dict[str, tuple[int, int | None]] = {
    "word_len": (100, 150),       # characters per 100 words
    "symbols": (50, None),        # per 1000 words
    "dup_lines": (250, None),     # per 1000 lines
    "repeats": (250, None),       # words in repeated windows, per 1000 words
}
LEVELS = (("lang", "source"), ("lang",), ())


def _repeat_words(tri: Column) -> Column:
    """Number of words inside 3-word windows that occur twice or more (first ones included)."""
    at = F.sort_array(F.transform(tri, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    pairs = F.zip_with(at, F.slice(at, 2, F.greatest(F.size(tri), F.lit(1))),
                       lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    starts = F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull())))
    covered = F.array_distinct(F.flatten(F.transform(starts, lambda p: F.array(p, p + 1, p + 2))))
    # most texts repeat nothing: a distinct count (hash set) decides before anything is sorted
    return F.when(F.size(F.array_distinct(tri)) == F.size(tri), F.lit(0)).otherwise(F.size(covered))


def measure(docs: DataFrame, out: str = "quality", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` (default: all) plus struct ``out`` with the measures."""
    keep = docs.columns if keep is None else keep
    w, n, h, tri, lines = (fresh(docs, f"__{c}") for c in ("w", "n", "h", "tri", "lines"))
    src = fresh(docs, "__text")
    text = F.col(src)
    df = (docs.withColumn(src, F.coalesce(F.col("text"), F.lit("")))
          .withColumn(w, words(text))
          .withColumn(n, F.size(w))
          .withColumn(h, F.transform(F.col(w), lambda x: F.xxhash64(x))))
    two = F.zip_with(F.col(h), shifted(F.col(h), 1, F.col(n)), lambda a, b: F.xxhash64(a, b))
    three = F.zip_with(two, shifted(F.col(h), 2, F.col(n)), lambda a, b: F.xxhash64(a, b))
    df = df.withColumn(tri, F.slice(three, 1, F.greatest(F.col(n) - 2, F.lit(0)))).withColumn(
        lines, F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    base = df.select(*[F.col(f"`{c}`") for c in keep], F.struct(
        F.col(n).cast("long").alias("n_words"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(lines).cast("long").alias("n_lines"),
        _repeat_words(F.col(tri)).cast("long").alias("n_repeat_words"),
    ).alias(out))
    q = F.col(out)
    some, some_lines = F.greatest(q["n_words"], F.lit(1)), F.greatest(q["n_lines"], F.lit(1))
    ratio = lambda a, b, unit: F.floor(a * unit / b)
    return base.withColumn(out, F.struct(
        f"{out}.*",
        ((q["n_words"] < MIN_WORDS) | (100 * q["n_repeat_words"] > MAX_REPEATED * q["n_words"])).alias("base_failed"),
        ratio(q["word_chars"], some, 100).alias("word_len"),
        ratio(q["n_symbols"], some, 1000).alias("symbols"),
        ratio(q["n_dup_lines"], some_lines, 1000).alias("dup_lines"),
        ratio(q["n_repeat_words"], some, 1000).alias("repeats"),
        F.monotonically_increasing_id().alias("row"),
    ))


def sketch(measured: DataFrame, col: str = "quality") -> DataFrame:
    """(lang, source, measure, value, n): the quantile sketches of the documents that pass the
    base rule. Partial counts per task merge in the shuffle; size is bounded per group."""
    q = F.col(col)
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), q[m].alias("v")) for m in RULES])
    rows = (measured.where(once(~q["base_failed"], q["row"]))
            .select("lang", "source", F.inline(pairs)))
    drop_bits = F.greatest(F.length(F.bin("v")) - SKETCH_BITS, F.lit(0)).cast("int")
    return (rows.select("lang", "source", "measure", drop_bits.alias("s"), "v")
            .withColumn("value", F.expr("shiftleft(shiftright(v, s), s)"))
            .groupBy("lang", "source", "measure", "value").agg(F.count(F.lit(1)).alias("n")))


def fences(sketches: DataFrame) -> DataFrame:
    """One row per (level, lang, source): the low and high fence of each measure and the
    number of documents behind it. Level 0 is (lang, source), 1 the language, 2 the corpus."""
    levels = None
    for level, keys in enumerate(LEVELS):
        part = (sketches.groupBy(*keys, "measure", "value").agg(F.sum("n").alias("n"))
                .select(F.lit(level).alias("level"),
                        *[(F.col(k) if k in keys else F.lit(None).cast("string")).alias(k) for k in ("lang", "source")],
                        "measure", "value", "n"))
        levels = part if levels is None else levels.unionByName(part)
    group = ["level", "lang", "source", "measure"]
    # one window row per distinct rounded value of a group: bounded by the sketch, not the rows
    from pyspark.sql import Window
    win = Window.partitionBy(*group)
    run = win.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = levels.withColumn("cum", F.sum("n").over(run)).withColumn("total", F.sum("n").over(win))
    at = lambda p: F.min(F.when(F.col("cum") * 100 >= F.col("total") * p, F.col("value")))
    q = cum.groupBy(*group).agg(F.first("total").alias("total"), at(10).alias("q10"), at(50).alias("q50"),
                                at(90).alias("q90"))
    out = q.groupBy("level", "lang", "source").agg(F.max("total").alias("n"), *[
        F.max(F.when(F.col("measure") == m, F.col("q90") + SPREAD * (F.col("q90") - F.col("q50")) + up)).alias(f"hi_{m}")
        for m, (up, _) in RULES.items()], *[
        F.max(F.when(F.col("measure") == m, F.col("q10") - SPREAD * (F.col("q50") - F.col("q10")) - down)).alias(f"lo_{m}")
        for m, (_, down) in RULES.items() if down is not None])
    return out


def judge(measured: DataFrame, limits: DataFrame, col: str = "quality", verdict: str = "kept") -> DataFrame:
    """Join each row to the fences of its group (or, where that has under ``MIN_GROUP``
    documents, of its language, else of the corpus) and add the boolean ``verdict``."""
    names = [f"hi_{m}" for m in RULES] + [f"lo_{m}" for m, (_, d) in RULES.items() if d is not None]
    base = measured
    picks = []
    for level, keys in enumerate(LEVELS):
        big = F.col("n") >= MIN_GROUP if level < 2 else F.lit(True)
        pick = fresh(measured, f"__f{level}")
        side = limits.where((F.col("level") == level) & big).select(
            *[F.col(k).alias(f"{pick}_{k}") for k in keys], F.struct(*names).alias(pick))
        on = F.lit(True)
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"{pick}_{k}"))
        # the fences of a level: at most one row per group; the corpus level is one row
        base = base.join(side if keys else F.broadcast(side), on, "left").drop(*[f"{pick}_{k}" for k in keys])
        picks.append(pick)
    f, q = F.coalesce(*[F.col(p) for p in picks]), F.col(col)
    ok = ~q["base_failed"]
    for m, (_, down) in RULES.items():
        ok = ok & F.coalesce(q[m] <= f[f"hi_{m}"], F.lit(True))
        if down is not None:
            ok = ok & F.coalesce(q[m] >= f[f"lo_{m}"], F.lit(True))
    return base.withColumn(verdict, once(ok, q["row"])).drop(*picks)


def annotate(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, quality, kept) of every row. The measures are computed once and
    stored in the shared scratch folder, since both the sketch and the verdict read them."""
    m = materialize(docs.sparkSession, measure(docs, "quality", ["doc_id", "lang", "source"]), "quality")
    limits = materialize(docs.sparkSession, fences(sketch(m)), "fences")
    return judge(m, limits)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (same columns) that pass. Rows are measured once, into a table with their measures; the sketch
    reads its measures alone, and the verdict is joined while it is read again."""
    m, verdict = fresh(docs, "__quality"), fresh(docs, "__kept")
    spark = docs.sparkSession
    measured = materialize(spark, measure(docs, m), "measured")
    limits = materialize(spark, fences(sketch(measured, m)), "fences")
    return judge(measured, limits, m, verdict).where(F.col(verdict)).select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir):
    from .common import table
    q = F.col("quality")
    return annotate(table(spark, sf_dir, "documents")).select(
        "doc_id", *[q[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                            "base_failed")], "kept")


ORACLE = r"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
tri AS (SELECT doc_id, i, ws[i:i+2] AS t FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) AS c FROM tri) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY 1),
m AS (SELECT w.doc_id, lang, source, len(ws)::BIGINT AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, greatest(len(ls), 1) AS nl,
        coalesce(cov.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN cov USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        word_chars * 100 // greatest(n_words, 1) AS word_len, n_symbols * 1000 // greatest(n_words, 1) AS symbols,
        n_dup_lines * 1000 // nl AS dup_lines, n_repeat_words * 1000 // greatest(n_words, 1) AS repeats FROM m),
v AS (SELECT lang, source, u.m AS m, u.v::BIGINT AS v FROM (SELECT lang, source, unnest([
        {'m': 'word_len', 'v': word_len}, {'m': 'symbols', 'v': symbols}, {'m': 'dup_lines', 'v': dup_lines},
        {'m': 'repeats', 'v': repeats}]) AS u FROM f WHERE NOT base_failed)),
r AS (SELECT lang, source, m, (v >> s) << s AS v FROM (SELECT *, greatest(length(bin(v)) - 6, 0)::BIGINT AS s FROM v)),
lv AS (SELECT 0 AS level, lang, source, m, v, count(*) AS n FROM r GROUP BY ALL
       UNION ALL SELECT 1, lang, NULL, m, v, count(*) FROM r GROUP BY ALL
       UNION ALL SELECT 2, NULL, NULL, m, v, count(*) FROM r GROUP BY ALL),
cu AS (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, m ORDER BY v) AS cum,
              sum(n) OVER (PARTITION BY level, lang, source, m) AS total FROM lv),
q AS (SELECT level, lang, source, m, max(total) AS total, min(v) FILTER (cum * 100 >= total * 10) AS q10,
             min(v) FILTER (cum * 100 >= total * 50) AS q50, min(v) FILTER (cum * 100 >= total * 90) AS q90
      FROM cu GROUP BY ALL),
b AS (SELECT level, lang, source, max(total) AS n,
        max(q90 + 2 * (q90 - q50) + 100) FILTER (m = 'word_len') AS hw,
        max(q10 - 2 * (q50 - q10) - 150) FILTER (m = 'word_len') AS lw,
        max(q90 + 2 * (q90 - q50) + 50) FILTER (m = 'symbols') AS hs,
        max(q90 + 2 * (q90 - q50) + 250) FILTER (m = 'dup_lines') AS hd,
        max(q90 + 2 * (q90 - q50) + 250) FILTER (m = 'repeats') AS hr FROM q GROUP BY ALL)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(
    word_len <= coalesce(a.hw, l.hw, g.hw) AND word_len >= coalesce(a.lw, l.lw, g.lw)
    AND symbols <= coalesce(a.hs, l.hs, g.hs) AND dup_lines <= coalesce(a.hd, l.hd, g.hd)
    AND repeats <= coalesce(a.hr, l.hr, g.hr), true) AS kept
FROM f
LEFT JOIN b a ON a.level = 0 AND a.n >= 50 AND a.lang IS NOT DISTINCT FROM f.lang AND a.source IS NOT DISTINCT FROM f.source
LEFT JOIN b l ON l.level = 1 AND l.n >= 50 AND l.lang IS NOT DISTINCT FROM f.lang
LEFT JOIN b g ON g.level = 2
"""
