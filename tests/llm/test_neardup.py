"""Near-duplicate classes against all pairs, components against union-find."""
import random
import re
from collections import Counter

import pytest

from lakeshore.llm import neardup
from lakeshore.llm.common import table
from lakeshore.llm.components import components

from .cases import SF, edge_docs, edge_rows, no_docs, sentence


def shingles(text):
    w = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    seen, out = Counter(), set()
    for i in range(max(1, len(w) - 4) if w else 0):
        g = tuple(w[i:i + 5])
        out.add((g, seen[g]))
        seen[g] += 1
    return tuple(w), out


class Groups(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def brute(rows):
    """Smallest doc_id of the component of each doc_id, by all pairs."""
    s = [(d, *shingles(t)) for d, t in rows if d is not None]
    g = Groups()
    for i, (d, w, x) in enumerate(s):
        g.find(d)
        for e, v, y in s[:i]:
            both = len(x & y)
            if w == v or (x and y and both >= 0.8 * (len(x) + len(y) - both)):
                g.join(d, e)
    return {d: g.find(d) for d, _ in rows if d is not None}


def classes(df):
    return {r.doc_id: r.class_id for r in neardup.classes(df).collect() if r.doc_id is not None}


def test_tables(spark):
    docs = table(spark, SF, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows)
    assert len(set(want.values())) < len(want)
    assert classes(docs) == want


def test_edges(spark):
    df = edge_docs(spark)
    assert classes(df) == brute([r[:2] for r in edge_rows()])
    out = neardup.classes(df)
    assert out.count() == df.count()
    assert out.where("doc_id IS NULL AND class_id IS NOT NULL").count() == 0
    assert neardup.classes(no_docs(spark)).count() == 0


def test_a_group_of_near_copies(spark):
    rnd = random.Random(4)
    base = sentence(rnd, 300).split()
    rows = []
    for i in range(80):
        w = list(base)
        for _ in range(rnd.randint(0, 5)):
            w[rnd.randrange(300)] = f"new{rnd.randrange(1000)}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, sentence(rnd, 200)) for i in range(40)]
    assert classes(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)) == brute(rows)


def test_short_texts_need_no_shared_key(spark):
    """A text of 8 words and the same with a word more, which 20 keys miss in 1.2 per cent of the pairs."""
    rnd = random.Random(6)
    rows = []
    for i in range(0, 1600, 2):
        w = [f"{rnd.choice('abcdef')}{rnd.randrange(10 ** 6)}" for _ in range(rnd.choice([8, 8, 8, 9, 12]))]
        rows += [(i, " ".join(w)), (i + 1, " ".join([*w, "more"] if i % 4 else ["more", *w]))]
    rows += [(5000 + i, f"the same few words that many short texts begin with and then number {i}") for i in range(60)]
    want = brute(rows)
    assert sum(d != c for d, c in want.items()) > 800
    assert classes(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)) == want


def test_keep_first(spark):
    df = edge_docs(spark).selectExpr("*", "1 AS key", "2 AS doc", "'k' AS class_id")
    out = neardup.keep_first(df)
    assert out.columns == df.columns
    kept = {r.doc_id for r in out.collect()}
    want = brute([r[:2] for r in edge_rows()])
    assert kept - {None} == {d for d, c in want.items() if d == c}
    assert out.where("doc_id IS NULL").count() == df.where("doc_id IS NULL").count()


def test_alignment():
    a = list(range(100))
    assert neardup.aligned(a, a, 0.8) and neardup.aligned([], [], 0.8)
    assert neardup.aligned(a, a[:50] + [-1] * 10 + a[60:], 0.8)
    assert not neardup.aligned(a, a[:50] + [-1] * 30 + a[80:], 0.8)
    assert not neardup.aligned(a, a[50:] + a[:50], 0.8)         # the same words, another order
    assert not neardup.aligned(a, [], 0.8)


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rnd = random.Random(seed)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(30)] + [(7, 7)]
    links += [(5000, 5000 + i) for i in range(1, 40)]
    g = Groups()
    for a, b in links:
        g.join(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = {x: g.find(x) for a, b in links if a != b for x in (a, b)}
    assert got == want
