"""The tree encoder against the ranks' own library, at every leaf size, and the exact round trip."""
import random

import numpy as np
import pyarrow as pa
import pytest

from lakeshore.llm import treebpe
from lakeshore.llm.common import table

from .cases import SF, edge_docs, edge_rows, no_docs, shas

tiktoken = pytest.importorskip("tiktoken")
tokenizers = pytest.importorskip("public_tokenizers")
PATH = tokenizers.path("byte_bpe_50k.tiktoken")
MULTI = tokenizers.path("byte_bpe_multi_50k.tiktoken")


def library(path):
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=treebpe.read_ranks(path), special_tokens={})


def fuzz_texts(n, seed=2):
    rnd = random.Random(seed)
    parts = ["a", "b", " ", "  ", "\n", "\t", "é", "ß", "'s", "'", "'r", "e", "'l", "l", "1", "²", "!", "<|endoftext|>", "\x1c", "\xa0",
             "　", "the", "中", "😀", " \n", "a \n", "\n a", "  x", "xxxxx", "\r\n", "\x0b", "\x00", "ing", "ation", "==", "----", "aaaaaaa", "ö"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(n)]
    return texts + ["", "a" * 5000, " " * 900, "ab" * 3000, "é" * 999, "=" * 777, "x" * 4095 + "'" + "ll", *(r[1] or "" for r in edge_rows())]


@pytest.mark.parametrize("path", [PATH, MULTI])
@pytest.mark.parametrize("leaf", [1, 3, 7, 4096])
def test_fuzz_at_every_leaf_size(path, leaf, monkeypatch):
    monkeypatch.setattr(treebpe, "LEAF_CHARS", leaf)
    own = library(path)
    coder = treebpe.Encoder(treebpe.read_ranks(path), tokenizers.PATTERN)
    texts = [t for t in fuzz_texts(500, leaf) if leaf > 3 or len(t) < 6000]
    for at in range(0, len(texts), 300):
        part = texts[at:at + 300]
        assert coder.encode(pa.array(part, pa.string())).to_pylist() == [own.encode_ordinary(t) for t in part]


def test_joining_is_associative_and_right_at_every_cut():
    merger = treebpe.Merger(treebpe.read_ranks(PATH))
    for raw in [b"internationalization", b"aaaaaaaaaaaaaaaaaaaa", "straßenbahnhöfe".encode(), b"=================", b"abababababab"]:
        whole = merger.merged(raw)
        for i in range(len(raw) + 1):
            assert merger.join(merger.merged(raw[:i]), merger.merged(raw[i:])) == whole
            for j in range(i, len(raw) + 1, 3):
                a, b, c = (merger.merged(x) for x in (raw[:i], raw[i:j], raw[j:]))
                assert merger.join(merger.join(a, b), c) == merger.join(a, merger.join(b, c)) == whole


def test_small_caches_give_the_same(monkeypatch):
    monkeypatch.setattr(treebpe, "CACHE_UNITS", 5)
    monkeypatch.setattr(treebpe, "REMEMBERED", 3)
    coder, own, texts = treebpe.Encoder(treebpe.read_ranks(PATH), tokenizers.PATTERN), library(PATH), fuzz_texts(50)
    for _ in range(2):
        assert coder.encode(pa.array(texts, pa.string())).to_pylist() == [own.encode_ordinary(t) for t in texts]


def test_tables_and_edges(spark):
    own = library(PATH)
    docs = table(spark, SF, "documents").select("doc_id", "text").unionByName(edge_docs(spark).select("doc_id", "text"))
    coded = treebpe.packed(treebpe.decode(treebpe.encode(docs, PATH, tokenizers.PATTERN), PATH)).collect()
    assert len(coded) == docs.count()
    for r in coded:
        want = own.encode_ordinary(r.text or "")
        assert r.ids == want and bytes(r.decoded) == (r.text or "").encode()
        assert bytes(r.packed) == np.array(want, "<u4").tobytes()
    texts = {r.doc_id: r.text or "" for r in table(spark, SF, "documents").collect()}
    for r in treebpe.query(spark, SF).collect():
        want = own.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(want), *shas(np.array(want, "<u4").tobytes(), texts[r.doc_id]))


def test_decoding_other_ids(spark, monkeypatch):
    df = spark.createDataFrame([(1, [0, 1]), (2, []), (3, None), (4, [-1, 99999999, 5]), (5, [None, 7])], "i int, ids array<int>")
    got = {r.i: bytes(r.decoded) for r in treebpe.decode(df, PATH).collect()}
    own = library(PATH)
    assert got == {1: own.decode_bytes([0, 1]), 2: b"", 3: b"", 4: own.decode_bytes([5]), 5: own.decode_bytes([7])}
    ids = list(range(9000))
    monkeypatch.setattr(treebpe, "LEAF_TOKENS", 100)
    assert treebpe.Decoder(treebpe.read_ranks(PATH)).decode(np.array(ids)) == own.decode_bytes(ids)


def test_columns_and_empty_table(spark):
    df = edge_docs(spark).selectExpr("*", "1 AS IDS")
    with pytest.raises(ValueError):
        treebpe.encode(df, PATH, tokenizers.PATTERN)
    out = treebpe.encode(df, PATH, tokenizers.PATTERN, out="tokens")
    assert out.columns == [*df.columns, "tokens"] and out.count() == df.count()
    assert treebpe.encode(no_docs(spark), PATH, tokenizers.PATTERN).count() == 0
