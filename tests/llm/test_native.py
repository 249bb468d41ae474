"""Quality rules, decontamination and licence scans: DuckDB twins, brute force and edge rows."""
import re
from collections import Counter

import duckdb
import pytest

from lakeshore.llm import decontaminate, licenses, quality
from lakeshore.llm.queries import oracle_sql, queries

from .cases import SCHEMA, SF, edge_docs, edge_rows, no_docs


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_twins(spark, duck, key):
    from tools.oracle_check import compare

    res = compare(spark, duck, key, queries()[key], oracle_sql()[key], SF)
    assert res["status"] == "OK" and "type_mismatch" not in res, res


@pytest.mark.parametrize("key", ["op6_quality_rules", "op10_license_scans"])
def test_twins_on_edge_rows(spark, key, tmp_path):
    """The same statements over the edge rows (without the rows that share a doc_id: the twins join by it)."""
    seen, rows = set(), []
    for r in edge_rows():
        if r[0] is not None and r[0] not in seen and "\x00" not in (r[1] or ""):
            seen.add(r[0])
            rows.append(r)
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    from tools.oracle_check import compare

    res = compare(spark, con, key, queries()[key], oracle_sql()[key], str(tmp_path))
    assert res["status"] == "OK", res


def test_quality_edges(spark):
    df = edge_docs(spark).selectExpr("*", "1 AS kept", "2 AS quality", "'x' AS __w")
    out = quality.keep_good(df)
    assert out.columns == df.columns
    kept = [r.doc_id for r in out.collect()]
    assert None not in [r.text for r in out.collect()] and 15 not in kept and 14 not in kept and 10 in kept
    assert quality.keep_good(no_docs(spark)).count() == 0
    assert quality.annotate(no_docs(spark)).count() == 0


def test_fences_follow_their_group(spark):
    """Symbols are normal in one language's sources and junk in the other's."""
    word = [f"word{i}" for i in range(60)]
    rows = [(i, " ".join(w + "$" for w in word) + f" n{i}", "xx", "a", 0) for i in range(60)]
    rows += [(100 + i, " ".join(word) + f" n{i}", "yy", f"s{i % 30}", 0) for i in range(60)]
    rows += [(200, " ".join(w + "$" for w in word), "yy", "s1", 0)]
    got = {r.doc_id: r.kept for r in quality.annotate(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(v for k, v in got.items() if k != 200) and not got[200]


def test_fences_of_minorities(spark):
    """A fifth of a group that uses symbols stays; where nobody does, a few are junk."""
    word = [f"word{i}" for i in range(100)]
    some = " ".join(w + ("$" if i % 7 == 0 else "") for i, w in enumerate(word))         # 150 per 1000
    rows = [(i, (some if i % 5 == 0 else " ".join(word)) + f" n{i}", "xx", "a", 0) for i in range(200)]
    rows += [(1000 + i, " ".join(word) + f" n{i}", "yy", "b", 0) for i in range(200)]
    rows += [(2000, " ".join(w + ("$" if i % 16 == 0 else "") for i, w in enumerate(word)), "yy", "b", 0)]     # 70 per 1000
    got = {r.doc_id: r.kept for r in quality.annotate(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [k for k, v in got.items() if not v] == [2000]


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_hits(docs, items):
    wins = Counter()
    for _, t in items:
        w = item_words(t)
        k = min(10, len(w))
        wins.update({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if k else ())
    out = []
    for d, t in docs:
        w, hit = item_words(t), set()
        for k in range(1, 11):
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in wins:
                    hit.update(range(i, i + k))
        out.append((d, len(w), sorted(hit)))
    return out


ITEMS = [("q1", "Alpha beta, GAMMA delta epsilon zeta eta theta iota kappa lambda mu"), ("q2", "short item"), ("q3", None), ("q4", "..."),
         ("q5", "short item"), ("q6", "été À la plage")]
TEXTS = [(1, "so alpha beta gamma delta epsilon zeta eta theta iota kappa lambda done"), (2, "a SHORT   item; short item"), (3, None),
         (4, ""), (5, "beta gamma delta epsilon zeta eta theta iota kappa"), (6, "l'été À LA plage"), (2, "a SHORT   item; short item"),
         (None, "short item here")]


@pytest.mark.parametrize("most", [1, 50_000])
def test_hits(spark, monkeypatch, most):
    """``most=1`` is too few for the windows: they are broadcast in slices (several, as these are small)."""
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", 200)
    monkeypatch.setattr(decontaminate, "MAX_SET", most)
    docs = spark.createDataFrame(TEXTS, "doc_id bigint, text string")
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    got = sorted(((r.doc_id, r.n_words, list(r.positions)) for r in decontaminate.contamination(docs, items).collect()), key=repr)
    assert got == sorted(brute_hits(TEXTS, ITEMS), key=repr)


@pytest.mark.parametrize("most", [1, 50_000])
def test_removal(spark, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "MAX_SET", most)
    docs = spark.createDataFrame([(*r, 7) for r in TEXTS], "doc_id bigint, text string, w int")
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    left = decontaminate.remove(docs, items)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [3, 4, 5]
    spans = {r.doc_id: r.text for r in decontaminate.remove(docs, items, "spans").collect()}
    assert spans[1] == "so lambda done" or spans[1] == "so done"
    assert spans[2] == "a " and spans[3] is None and spans[5] == TEXTS[4][1]
    none = spark.createDataFrame([], "item_id string, text string")
    assert decontaminate.remove(docs, none).count() == len(TEXTS)
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
    with pytest.raises(ValueError):
        decontaminate.remove(docs, items, "rows")


@pytest.mark.parametrize("n", [1, 60_000])
def test_large_benchmarks(spark, n):
    """As many windows as need several slices, some of them very frequent; nothing of a text is shuffled by word."""
    def text(i, size=10):
        return " ".join(f"w{(i * 7919 + j * j) % 99_991}" for j in range(size))

    items = [(f"q{i}", text(i)) for i in range(n)] + [("stop", "the of and")]
    docs = [(i, f"{text(i, 40)} the of and {text(i + n, 9)} " * 3) for i in range(0, 2 * n, max(1, n // 20))]
    docs += [(-1, "the of and " * 5000), (-2, None), (-3, text(5, 9)), (docs[0][0], docs[0][1])]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id string, text string")
    windows = decontaminate.benchmark_windows(b)
    if n > decontaminate.MAX_SET:
        before, decontaminate.SLICE_BYTES = decontaminate.SLICE_BYTES, 4 << 20
        try:
            assert decontaminate.slices(windows)[1] > 1
            got = decontaminate.contamination(d, b).collect()
        finally:
            decontaminate.SLICE_BYTES = before
    else:
        got = decontaminate.contamination(d, b).collect()
    assert sorted((r.doc_id, r.n_words, list(r.positions)) for r in got) == sorted(brute_hits(docs, items))


def found(spark, text):
    return list(licenses.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()["licence"]["licenses"])


def test_licences(spark):
    mit = ["The MIT License (MIT)", "Copyright (c) 2020 Nobody", "", *(licenses.SENTENCES[i] for i in (13, 14, 15))]
    wrapped = "\n".join("\n".join(" ".join(x.split()[i:i + 9]) for i in range(0, max(1, len(x.split())), 9)) for x in mit)
    assert found(spark, "\n".join(mit)) == ["MIT"] and found(spark, wrapped) == ["MIT"]
    assert found(spark, "Some text.\nReleased under the MIT license.\nLicensed under CC BY-NC 4.0.") == ["CC-BY-NC-4.0", "MIT"]
    three = [licenses.SENTENCES[i] for i in (40, 41, 42, 43)]
    assert found(spark, "\n".join(three)) == ["BSD-3-Clause"] and found(spark, "\n".join(three[:3])) == ["BSD-2-Clause"]
    assert found(spark, "\n".join([three[0], three[2], three[1]])) == []      # out of order
    # two notices in one text: the longer rule hides the shorter one at its own place only
    assert found(spark, "\n".join(three[:3] + ["Another file."] + three)) == ["BSD-2-Clause", "BSD-3-Clause"]
    for tag in ("Apache-2.0", "MIT", "GPL-3.0-or-later", "BSD-3-Clause", "MPL-2.0"):
        assert found(spark, f"#!/bin/sh\n# SPDX-License-Identifier: {tag}\n\necho") == [tag]
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public\n License, v. 2.0. If a copy of the MPL was not distributed"
    assert found(spark, mpl) == ["MPL-2.0"]


def test_every_known_sentence_is_found_in_itself(spark):
    rows = [(i, s) for i, s in licenses.SENTENCES.items()]
    got = {r.doc_id: r.licence for r in licenses.scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    for i, parts in licenses.DEFAULT.parts.items():
        assert tuple(got[i].by_line) == tuple(got[i].by_sentence) == parts
    own = licenses.Catalogue({1: "Use it as you like: no warranty."}, {"Own": [(1,)]}, ["warranty"])
    df = spark.createDataFrame([(1, "use it as you like: no WARRANTY."), (2, "MIT License")], "doc_id int, text string")
    assert [r.licence.licenses for r in licenses.scan(df, book=own).collect()] == [["Own"], []]
    with pytest.raises(ValueError):
        licenses.Catalogue({1: "No anchor here."}, {}, ["warranty"])


def test_licences_of_odd_rows(spark):
    assert found(spark, None) == [] and found(spark, "") == [] and found(spark, "all about licensing") == []
    df = edge_docs(spark).selectExpr("*", "1 AS by_line", "2 AS __low")
    out = licenses.scan(df)
    assert out.columns == [*df.columns, "licence"] and out.count() == df.count()
    assert licenses.scan(no_docs(spark)).count() == 0
