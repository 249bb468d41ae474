"""Phrase mining against a plain count of every phrase, at shard sizes from one text to all."""
import random
import re
from collections import Counter

import duckdb
import pytest

from lakeshore.llm import phrases
from lakeshore.llm.common import table

from .cases import SCHEMA, SF, edge_rows, no_docs

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, support=phrases.SUPPORT, longest=phrases.LONGEST, covered=80, most=phrases.TOP):
    counts = {}
    for text, lang in rows:
        of = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            for k in range(1, longest + 1):
                of.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        cand = {p: v for p, v in f.items() if len(p) > 1 and v >= support}
        best = {}
        for p, a in cand.items():
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            best[p] = (a, f[p[:k]], f[p[k:]], score)
        drop = {p[i:i + s] for p, a in cand.items() for s in range(2, len(p)) for i in range(len(p) - s + 1)
                if p[i:i + s] in cand and 100 * a >= covered * cand[p[i:i + s]]}
        kept = sorted(((-s, -a, " ".join(p).encode(), lst, r) for p, (a, lst, r, s) in best.items() if p not in drop))
        out += [(lang, i + 1, p.decode(), -a, lst, r, n, -s) for i, (s, a, p, lst, r) in enumerate(kept[:most])]
    return sorted(out)


def mined(docs, most=phrases.TOP, **kw):
    cols = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r) for r in phrases.top(phrases.collocations(docs, **kw), most).select(*cols).collect())


def fuzz(n, seed):
    rnd = random.Random(seed)
    vocabulary = ["A", "b", "C", "dé", "É", "x\x00", "a\xa0b", "the", "ß", "-"]
    seps = [" ", "  ", "\t", " ", " ", ". ", ",", "\n", "\x0b"]
    texts = ["".join(rnd.choice(vocabulary) + rnd.choice(seps) for _ in range(rnd.randint(0, 60))) for _ in range(n)]
    return [(i, t, rnd.choice(["en", "en", "de", None, "und", ""]), "s", 1) for i, t in enumerate(texts)]


@pytest.mark.parametrize("size", [40, 1500, 10_000_000])
@pytest.mark.parametrize("bits", [1 << 15, 1 << 20])
def test_fuzz(spark, monkeypatch, size, bits):
    monkeypatch.setattr(phrases, "SHARD_BYTES", size)
    monkeypatch.setattr(phrases, "FILTER_BITS", bits)
    rows = fuzz(120, size) + [(None, None, None, None, None), (7, "", "fr", "s", 1), *edge_rows()]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert mined(docs, support=7) == brute([(r[1], r[2]) for r in rows], support=7)
    assert mined(docs, most=5, support=3, longest=2, covered=50) == brute([(r[1], r[2]) for r in rows], 3, 2, 50, 5)


def test_languages_beyond_those_sent(spark, monkeypatch):
    monkeypatch.setattr(phrases, "LANGUAGES", 1)
    rows = fuzz(60, 9)
    assert mined(spark.createDataFrame(rows, SCHEMA), support=4) == brute([(r[1], r[2]) for r in rows], 4)


def test_query_is_the_plain_count_and_the_sql(spark):
    rows = [(r.text, r.lang) for r in table(spark, SF, "documents").collect()]
    cols = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = sorted(tuple(r) for r in phrases.query(spark, SF).select(cols).collect())
    assert got == brute(rows) and len(got) > 20
    with duckdb.connect() as con:
        con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
        assert sorted(con.sql(phrases.ORACLE).fetchall()) == got


def test_words_at_edges_of_texts(spark):
    # words of neighbouring texts neither grow together nor make phrases
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(["ab", "ab", "cd", "ab cd", "", "ab cd", " ", "ab", "cd ab cd"])]
    got = {r.phrase: r.n for r in phrases.frequent(spark.createDataFrame(rows, SCHEMA).coalesce(1), support=1)[0].collect()}
    assert got == {"ab": 6, "cd": 5, "ab cd": 3, "cd ab": 1, "cd ab cd": 1}


def test_huge_counts_stay_exact(spark):
    big = 2**62
    rows = [("en", "a", 1, big), ("en", "b", 1, big), ("en", "a b", 2, big - 1), ("en", "c", 1, big), ("en", "a b c", 3, 30), ("en", "b c", 2, 31)]
    df = spark.createDataFrame(rows, "lang string, phrase string, words int, n bigint")
    got = {r.phrase: (r.l, r.r, r.score) for r in phrases.scored(df).collect()}
    assert got["a b"] == (big, big, 2_000_000 * (big - 1) // (2 * big))
    assert got["a b c"] == min((((big, 31, 2_000_000 * 30 // (big + 31))), (big - 1, big, 2_000_000 * 30 // (2 * big - 1))), key=lambda x: x[2])
    kept = {r.phrase for r in phrases.uncovered(phrases.scored(df), df).collect()}
    assert kept == {"a b", "a b c"}


def test_no_rows(spark):
    assert mined(no_docs(spark)) == []


def test_words_are_hashed_from_an_arrow_array(spark):
    import pyarrow as pa
    from xxhash import xxh3_64_intdigest

    words = [b"", b"the", "dé".encode(), b"the end", b"a\x00"]
    seed = xxh3_64_intdigest(b"en")
    want = [xxh3_64_intdigest(w, seed) for w in words]
    assert phrases.word_hashes(pa.array(words, pa.binary()), "en").tolist() == want
    assert phrases.word_hashes(pa.array(words, pa.binary())[2:], "en").tolist() == want[2:]
    assert phrases.word_hashes(pa.array([], pa.binary()), "en").tolist() == []
