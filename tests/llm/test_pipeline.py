"""The pipeline's stages against brute force on the driver's small tables and the edge rows."""
import re

import corpus_pipeline
from lakeshore.llm import bpe
from lakeshore.llm.common import scratch_path, table
from lakeshore.llm.queries import oracle_sql

from .cases import SF, edge_docs, no_docs
from .test_native import brute_hits
from .test_neardup import brute
from .test_repeats import ID, suffix


def cut(rows):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - suffix.LENGTH + 1):
            s = b[i:i + suffix.LENGTH]
            first[s] = min((ID(d), i), first.get(s, (ID(d), i)))
    out = {}
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - suffix.LENGTH + 1):
            if first[b[i:i + suffix.LENGTH]] < (ID(d), i):
                gone[i:i + suffix.LENGTH] = b"\1" * suffix.LENGTH
        out[d] = bytes(x for x, g in zip(b, gone, strict=True) if not g).decode("utf-8", "ignore")
    return out


def test_run(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    good = {r[0] for r in con.execute(f"SELECT doc_id FROM ({oracle_sql()['op6_quality_rules']}) WHERE kept").fetchall()}
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect() if r.doc_id in good]
    of = brute(rows)
    texts = cut([(d, t) for d, t in rows if of[d] == d])
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    want = {d: texts[d] for d, _, hit in brute_hits(list(texts.items()), items) if not hit}
    out = corpus_pipeline.run(spark, SF)
    got = {r.doc_id: (r.text, r.n_chars, r.n_tokens, list(r.ids)) for r in out.collect()}
    assert {d: g[0] for d, g in got.items()} == want and 0 < len(want) < len(good)
    import tokenizers

    library = tokenizers.Tokenizer.from_file(bpe.default_path())
    assert all(g[1] == len(g[0]) and g[2] == len(g[3]) and g[3] == library.encode(g[0], add_special_tokens=False).ids
               for g in got.values())


def test_stages_keep_the_columns(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "minhash_near_dedup", "suffix_dedup",
                                                      "benchmark_decontamination", "bpe"]
    for docs in (edge_docs(spark), no_docs(spark)):
        columns, n = docs.columns, docs.count()
        for name, stage in corpus_pipeline.STAGES:
            path = scratch_path(spark, f"test-{name}")
            stage(spark, docs, SF).write.parquet(path)
            docs = spark.read.parquet(path)
            assert docs.columns[:len(columns)] == columns and docs.count() <= n, name
            assert name == "bpe" or docs.columns == columns
    assert re.match("doc_id", columns[0])
