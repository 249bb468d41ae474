"""Toxicity: restoring obfuscated words, held-out accuracy, edge rows."""
import random
import zlib

import pytest

from lakeshore.llm import toxicity
from lakeshore.llm.common import table

from .cases import edge_docs, no_docs, sentence

BIG = "/root/testdata/sf0.01"
BAD = ["grumblefink", "snotterwax", "blightpatch"]


def corpus(n=600, seed=1):
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w = sentence(rnd, 60).split()
        toxic = int(rnd.random() < 0.3)
        if toxic:
            w[rnd.randrange(60)] = rnd.choice(BAD)
        rows.append((i, " ".join(w)))
        labels.append((i, toxic))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    return toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))


def test_restores(model):
    reader = toxicity.Reader(model["counts"])
    for w in ("gr0mblefink".replace("0", "u"), "grumb1efink", "gruuuumblefink", "g.r.u.m.b.l.e.f.i.n.k", "sn0tterw@x", "bl1ghtp4tch"):
        assert set(BAD) & reader.words(f"well {w}, said she"), w
    assert "grumblefink" in reader.words("you a g r u m b l e f i n k you")
    assert reader.restored("plain") == () and reader.restored("2024-10-12") == ()


def test_restores_all_forms(model):
    """Letters doubled, signs only, several signs for a letter, any white space, a trailing exclamation mark."""
    reader = toxicity.Reader(model["counts"])
    for w in ("grruummbblleeffiinnkk", "snootterwax", "GrRumblefink", "grumb1efink!", "grumb1efink!!!", "sn0tterw@x!\"", "b1ightp4tch!.",
              "g  r  u  m  b  l  e  f  i  n  k", "\n".join("snotterwax"), "b l i g h t p a t c h   s n o t t e r w a x", "(grumb1efink!)"):
        assert set(BAD) & reader.words(f"well {w} , said she"), w
    counts = dict(model["counts"])
    edge = 0
    for word in ("stupid", "tit", "ass"):
        c = [edge, *toxicity.cells(word).tolist(), edge]
        for i in range(len(c) - 2):
            cell = (c[i] * toxicity.BASE + c[i + 1]) * toxicity.BASE + c[i + 2]
            counts[cell] = counts.get(cell, 0) + 20_000
        first = c[1]
        counts[first] = counts.get(first, 0) + 20_000
    reader = toxicity.Reader(counts)
    for text, word in (("$7(_)|>1|)", "stupid"), ("$7(_)|>1|)!", "stupid"), ("455", "ass"), ("455!", "ass"), ("a s s", "ass"), ("a\ns\ns", "ass"), ("717", "tit")):
        assert word in reader.words(f"well {text}"), text
    assert reader.restored("10.20.30.40") == ()


def test_scores(spark, model):
    rows, labels = corpus(200, seed=9)
    hidden = {i: t.replace(b, b.replace("e", "3").replace("a", "@")) for i, t in rows for b in BAD if b in t}
    df = spark.createDataFrame([(i, hidden.get(i, t)) for i, t in rows], "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    assert all((got[i] >= toxicity.THRESHOLD) == bool(y) for i, y in labels)
    assert all(0 <= s <= 1 for s in got.values())


def test_edges(spark, model):
    df = edge_docs(spark).selectExpr("*", "1 AS score", "2 AS f", "3 AS toxic")
    out = toxicity.score(df, model).collect()
    assert len(out) == df.count() and all(r.score is not None and 0 <= r.score <= 1 for r in out)
    assert toxicity.score(no_docs(spark), model).count() == 0
    none = spark.createDataFrame([(0, None), (None, 1)], "doc_id bigint, toxic int")
    empty = toxicity.fit(df, none)
    assert {r.score for r in toxicity.score(df, empty).collect()} == {0.0}
    assert toxicity.fit(no_docs(spark), none)["weights"] is None


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in table(spark, BIG, "labels").collect()}
    rows = {r.doc_id: r for r in toxicity.query(spark, BIG).collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in rows.items())
    test = [(rows[d].score, y, rows[d].predicted) for d, y in labels.items() if rows[d].held_out]
    bad, good = [s for s, y, _ in test if y], [s for s, y, _ in test if not y]
    auc = sum((a > b) + (a == b) / 2 for a in bad for b in good) / (len(bad) * len(good))
    assert auc > 0.8 and sum(p for _, y, p in test if not y) <= 0.03 * len(good)
