"""BPE against the vocabulary's own library, and the exact round trip."""
import random

import pyarrow as pa
import pytest

from lakeshore.llm import bpe
from lakeshore.llm.common import table

from .cases import SF, edge_docs, edge_rows, no_docs, shas

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(bpe.default_path())


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.default_path())


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_fuzz(library, vocabulary):
    rnd = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "\t", "é", "ß", "'s", "'", "1", "²", "!", "<|endoftext|>", "\x1c", "\xa0", "　", "the", "中",
             "😀", " \n", "xxxxx", "\r\n", "\x0b", "\x00", " "]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(4000)]
    texts += [None, "", "a" * 5000, " " * 900, "<|endoftext|>", "ab" * 3000, *(r[1] for r in edge_rows())]
    coder = bpe._Encoder(vocabulary)
    for at in range(0, len(texts), 700):
        part = texts[at:at + 700]
        assert coder.encode(pa.array(part, pa.string())).to_pylist() == [ids(library, t) for t in part]


def test_small_cache_gives_the_same(library, vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 5)
    coder, texts = bpe._Encoder(vocabulary), [r[1] for r in edge_rows()]
    for _ in range(3):
        assert coder.encode(pa.array(texts, pa.string())).to_pylist() == [ids(library, t) for t in texts]


def test_tables_and_edges(spark, library):
    docs = table(spark, SF, "documents").select("doc_id", "text").unionByName(edge_docs(spark).select("doc_id", "text"))
    coded = bpe.decode(bpe.encode(docs, bpe.default_path()), bpe.default_path())
    rows = coded.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.ids == ids(library, r.text)
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False) == (r.text or "")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.query(spark, SF).collect()}
    for r in rows:
        if r.doc_id in got and r.text is not None and r.doc_id > 50:
            want = ids(library, r.text)
            assert got[r.doc_id] == (len(want), *shas(",".join(map(str, want)), r.text))


def test_decoding_other_ids(spark, library):
    cases = [(1, [0, 1, 50256]), (2, []), (3, None), (4, [ids(library, "é")[0]]), (5, [-1, 99999999, 5]), (6, [None, 7])]
    df = spark.createDataFrame(cases, "i int, ids array<int>")
    got = {r.i: r.decoded for r in bpe.decode(df, bpe.default_path()).collect()}
    assert got[1] == library.decode([0, 1, 50256], skip_special_tokens=False) and got[2] == got[3] == ""
    assert got[4] == library.decode(cases[3][1], skip_special_tokens=False)
    assert got[5] == library.decode([5]) and got[6] == library.decode([7])


def test_columns(spark):
    df = edge_docs(spark).selectExpr("*", "1 AS ids", "2 AS n_tokens", "3 AS __decoded")
    out = bpe.tokenize(df, bpe.default_path())
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "__decoded", "n_tokens", "ids"]
    assert out.count() == df.count() and bpe.tokenize(no_docs(spark), bpe.default_path()).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(df, bpe.default_path())
