import zlib
from collections import defaultdict

import numpy as np
import pytest

from folioforge.llm import packing, tokens
from folioforge.llm.queries import digest, tokenizer

PATH, RANKS = tokenizer()


def ids_of(text):
    return [*tokens.reference(PATH).encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, pieces, window):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length == len(p.ids) // 4 > 0
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    for i, text in rows:
        got, at = [], 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert p.start == at
            at += p.length
            got += np.frombuffer(p.ids, "<u4").tolist()
        assert got == ids_of(text) and {p.doc_tokens for p in by_doc[i]} == {len(got)}
    short = 0
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
        short += at < window
    return short


@pytest.mark.parametrize("window", [1024, 64])
def test_round_trip(spark, sf_dir, monkeypatch, window):
    monkeypatch.setattr(packing, "SHARD", 20_000)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    pieces = packing.pack(spark, docs, PATH, ranks=RANKS, window=window).collect()
    tails = sum(p.length for p in pieces if p.sequence_id >= packing.MIXED)
    assert check(rows, pieces, window) <= tails // 20_000 + 1


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " "), (4, "a <|endoftext|> b"), (5, "日本語    ẞ\U0001f600"), (6, "word " * 40_000), (7, "x\r\n\x0b y"), (8, "don't  stop\n\n\n  now")]
    df = spark.createDataFrame([(i, t, "k", 3) for i, t in rows], "doc_id long, text string, ids string, n int")
    check(rows, packing.pack(spark, df, PATH, ranks=RANKS).collect(), 1024)
    assert packing.pack(spark, spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
    twice = packing.pack(spark, spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string"), PATH).collect()
    assert len(twice) == 3


def test_digest(spark):
    out = digest(packing.pack(spark, spark.createDataFrame([(1, "hello there")], "doc_id long, text string"), PATH)).head()
    assert out.ids_crc32 == zlib.crc32(np.array(ids_of("hello there"), "<u4").tobytes())


def test_ranks_give_the_same_ids(spark, sf_dir):
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect():
        assert tokens.encode(r.text, PATH, RANKS).tolist() == tokens.encode(r.text, PATH).tolist()


def index_of(texts):
    df = np.bincount(np.concatenate([np.unique(t) for t in texts]))
    return packing.Index(texts, packing.idf_of(df, len(texts)), np.mean([len(t) for t in texts])), df


def topics():
    rng = np.random.default_rng(0)
    return [(rng.integers(0, 30, 60) + 100 * (i % 12)).astype(np.uint32) for i in range(120)]


def test_neighbours_share_a_window():
    texts, seqs = topics(), defaultdict(list)
    for i, *_, seq, _ in packing.order_and_cut(index_of(texts)[0], texts, 256):
        seqs[seq].append(i % 12)
    assert np.mean([len(set(v)) for v in seqs.values()]) < 2


def test_many_small_neighbours_follow_one_seed():
    texts = [np.array([k, 7, 100 + 2 * i + k], np.uint32) for i in range(100) for k in (1, 2)]
    seqs = defaultdict(list)
    for i, *_, seq, _ in packing.order_and_cut(index_of(texts)[0], texts, 300):
        seqs[seq].append(i % 2)
    assert [len(set(v)) for v in seqs.values()] == [1, 1]  # 100 texts of three ids each, far more than are ranked at once


def test_keys_bring_like_texts_together():
    """Texts of one topic share a first key far more often than texts of two."""
    texts = topics()
    df = index_of(texts)[1]
    value = packing.routes(df, len(texts))
    key = np.array([np.unique(t)[value[0][np.unique(t)].argmin()] for t in texts])
    same = np.equal.outer(key, key)
    topic = np.equal.outer(np.arange(120) % 12, np.arange(120) % 12)
    assert same[topic].mean() > 0.3 > 0.01 > same[~topic].mean()


@pytest.mark.parametrize("many", [25, 60])
def test_index_scores_match_plain_bm25(many):
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 40, rng.integers(3, 30)).astype(np.uint32) for _ in range(many)]
    n, avg = len(texts), np.mean([len(t) for t in texts])
    want = np.zeros(n)
    for t in set(texts[0].tolist()):
        df = sum(t in x for x in texts)
        if df > 1:
            for d, x in enumerate(texts):
                tf = (x == t).sum()
                want[d] += np.log1p((n - df + 0.5) / (df + 0.5)) * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(x) / avg))
    assert np.allclose(index_of(texts)[0].scores(texts[0]), want, rtol=1e-5)
