"""Substring and suffix dedup against brute force."""
import dataclasses
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lakeshore.llm import anchors, substring, suffix
from lakeshore.llm.common import table

from .cases import SCHEMA, SF, edge_docs, edge_rows, no_docs, sentence, shas

ID = lambda d: -(1 << 63) if d is None else d


def brute_bytes(rows, length=suffix.LENGTH):
    """First start (doc, position) of each string; rows that share a doc_id share their starts."""
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            at = (ID(d), i)
            first[b[i:i + length]] = min(at, first.get(b[i:i + length], at))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < (ID(d), i):
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), len(b) - len(kept), spans, *shas(kept)))
    return sorted(out, key=repr)


def brute_words(rows, length=substring.LENGTH):
    words = [(d, (t or "").encode().split()) for d, t in rows]
    seen = Counter(tuple(w[i:i + length]) for _, w in words for i in range(len(w) - length + 1))
    out = []
    for d, w in words:
        gone = bytearray(len(w))
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i:i + length])] > 1:
                gone[i:i + length] = b"\1" * length
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((d, len(w), len(w) - len(kept), *shas(b" ".join(kept))))
    return sorted(out, key=repr)


def got(df, *cols):
    from pyspark.sql import functions as F

    return sorted((tuple(r) for r in df.select(*cols, F.sha2("kept", 256)).collect()), key=repr)


def pairs(rows):
    return [r[:2] for r in rows]


def test_suffix_edges(spark):
    df = suffix.dedup(edge_docs(spark))
    assert got(df, "doc_id", "n_bytes", "n_removed", "n_spans") == brute_bytes(pairs(edge_rows()))


def test_substring_edges(spark):
    assert got(substring.dedup(edge_docs(spark)), "doc_id", "n_words", "n_removed") == brute_words(pairs(edge_rows()))


def corpus(seed, n=60):
    """Near copies with edits, a frequent line between ever-changing neighbours, periodic texts."""
    rnd = random.Random(seed)
    base, line = sentence(rnd, 150).split(), sentence(rnd, 45)
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rnd.randint(0, 4)):
            w[rnd.randrange(len(w))] = sentence(rnd, 1)
        rows.append((i, rnd.choice([" ".join(w), f"{sentence(rnd, 9)} {line} {sentence(rnd, 9)}", "ab ab c " * rnd.randint(1, 60)])))
    return rows


@pytest.mark.parametrize("hot", [1, 64])
def test_hot_keys_and_near_copies(spark, hot):
    """``hot=1`` makes every key with two contents in a task a hot one: same result, other way."""
    rows = corpus(5)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    s = dataclasses.replace(suffix.SEARCH, hot_contents=hot)
    assert got(suffix.dedup(df, s), "doc_id", "n_bytes", "n_removed", "n_spans") == brute_bytes(rows)
    s = dataclasses.replace(substring.SEARCH, hot_contents=hot)
    assert got(substring.dedup(df, s), "doc_id", "n_words", "n_removed") == brute_words(rows)


def test_tables(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    docs = table(spark, SF, "documents").select("doc_id", "text")
    assert got(suffix.dedup(docs), "doc_id", "n_bytes", "n_removed", "n_spans") == brute_bytes(rows)
    assert got(substring.dedup(docs), "doc_id", "n_words", "n_removed") == brute_words(rows)


def test_empty_and_clashing_columns(spark):
    assert suffix.dedup(no_docs(spark)).count() == 0
    assert substring.dedup(no_docs(spark)).count() == 0
    df = edge_docs(spark).selectExpr("*", "1 AS kept", "2 AS spans", "'x' AS __z", "3 AS th")
    out = suffix.clean(df)
    assert out.columns == df.columns and out.count() == df.count()
    texts = {r.doc_id: (r.text, r.n_chars) for r in out.where("doc_id IS NOT NULL").collect()}
    assert texts[0] == ("", 0)
    assert all(n == len(t) for t, n in texts.values())


def test_scan_covers_every_window_once():
    rnd = np.random.default_rng(1)
    sizes = [0, 5, 99, 100, 101, 1000, (1 << anchors.CHUNK_BITS) + 500, 3 * (1 << anchors.CHUNK_BITS)]
    edges = np.concatenate([[0], np.cumsum(sizes)])
    flat = rnd.integers(0, 3, edges[-1]).astype(np.uint8)
    r = anchors.scan(flat, suffix.hashed, edges, 100, 32)
    seen = [np.zeros(max(0, n - 99), int) for n in sizes]
    for d, s, c in zip(r.doc, r.start, r.count, strict=True):
        seen[d][s:s + c] += 1
    assert all((x == 1).all() for x in seen)
    assert r.count.max() <= 100 - 32 + 1


def test_bucket_pointers_are_equality_of_strings():
    rnd = random.Random(2)
    parts = ["".join(rnd.choice("ab") for _ in range(rnd.randint(100, 130))) * 2 for _ in range(20)]
    body = np.frombuffer("".join(parts).encode(), np.uint8)
    sizes = np.array([len(p) for p in parts])
    for length in (1, 7, 25, 60, 100):
        counts = sizes - length + 1
        p = suffix.refine(body, sizes, counts, length)
        strings = [t[i:i + length] for t, n in zip(parts, counts, strict=True) for i in range(n)]
        seen = Counter(strings)
        assert [x >= 0 for x in p] == [seen[s] > 1 for s in strings]
        of = {}
        assert all(of.setdefault(s, x) == x for s, x in zip(strings, p.tolist(), strict=True))


def test_count_min_never_underestimates():
    rnd = np.random.default_rng(0)
    keys = rnd.integers(0, 1 << 62, 400_000).astype(np.uint64)
    keys[:1000] = keys[1000:2000]
    a = substring.CountMin().add(keys[:200_000], np.ones(200_000))
    a.merge(substring.CountMin().add(keys[200_000:], np.ones(200_000)))
    assert (a.estimate(keys[:1000]) == 2).all()
    assert a.estimate(keys).min() >= 1 and a.estimate(rnd.integers(0, 1 << 62, 1000).astype(np.uint64)).min() == 0


def test_tokens_match_words():
    texts = [r[1] for r in edge_rows()]
    h, edges = substring.tokens(pa.array(texts, pa.string()))
    per = [h[a:b].tolist() for a, b in zip(edges, edges[1:], strict=False)]
    of = {}
    for t, hs in zip(texts, per, strict=True):
        words = (t or "").encode().split()
        assert len(words) == len(hs)
        assert all(of.setdefault(w, x) == x for w, x in zip(words, hs, strict=True))
    assert len(set(of.values())) == len(of)
    assert SCHEMA.startswith("doc_id")
