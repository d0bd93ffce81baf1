import numpy as np
import pytest

from folioforge.llm import decontaminate as dc


def plain_alignment(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            s = dc.MATCH if a[i - 1] == b[j - 1] else dc.MISMATCH
            h[i, j] = max(0, h[i - 1, j - 1] + s, h[i - 1, j] + dc.GAP, h[i, j - 1] + dc.GAP)
    return h.max()


def test_alignment_matches_plain_recursion():
    rng = np.random.default_rng(0)
    n, w, m = 40, 30, 12
    a, b = rng.integers(2, 6, (n, w)).astype(np.uint64), rng.integers(2, 6, (n, m)).astype(np.uint64)
    lengths = rng.integers(3, m + 1, n)
    best, first, last = dc.smith_waterman(a, b, lengths)
    for r in range(n):
        item = b[r, : lengths[r]]
        assert best[r] == plain_alignment(item, a[r]) == plain_alignment(item, a[r, first[r] : last[r]])


def words(rng, n):
    return [f"w{k}" for k in rng.integers(0, 3000, n)]


def edited(rng, item, share):
    out = []
    for w in item:
        x = rng.random()
        out += [] if x < share / 3 else [f"e{rng.integers(9**9)}"] if x < 2 * share / 3 else [w, f"e{rng.integers(9**9)}"] if x < share else [w]
    return out


def brute(docs, bench):
    got = set()
    for d, t in docs:
        for i, b in bench:
            x, y = (t or "").lower().split(), (b or "").lower().split()
            if len(y) >= dc.LEAST and x and plain_alignment(y, x) >= dc.SHARE * dc.MATCH * len(y):
                got.add((d, i))
    return got


def test_finds_what_alignment_of_all_pairs_finds(spark, monkeypatch):
    rng = np.random.default_rng(4)
    bench = [(i, " ".join(words(rng, rng.integers(12, 50)))) for i in range(12)]
    docs = []
    for d in range(60):
        text = words(rng, rng.integers(0, 120))
        if d % 3 == 0:
            at = rng.integers(0, len(text) + 1)
            text[at:at] = edited(rng, bench[d % 12][1].split(), (d % 5) * 0.05)
        docs.append((d, " ".join(text).upper() if d % 2 else " ".join(text)))
    b, f = spark.createDataFrame(bench, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    want = brute(docs, bench)
    assert {(r.doc_id, r.item_id) for r in dc.contaminated(spark, f, b).collect()} == want and len(want) > 15
    monkeypatch.setattr(dc, "ITEMS", 5)
    assert {(r.doc_id, r.item_id) for r in dc.contaminated(spark, f, b).collect()} == want
    assert {r.doc_id for r in dc.decontaminate(spark, f, b).collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_item_in_every_document_is_found(spark):
    rng = np.random.default_rng(5)
    item = words(rng, 30)
    docs = [(d, " ".join(words(rng, 20) + item + words(rng, 20))) for d in range(200)]
    got = dc.contaminated(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()
    assert len(got) == 200 and all((r.start, r.length, r.score) == (20, 30, 1.0) for r in got)


@pytest.mark.parametrize("copies", [50, 51, 1000])
def test_edited_and_partial_copies_are_found_however_many(spark, copies):
    rng = np.random.default_rng(6)
    item = [f"i{k}" for k in range(36)]
    fifth = [f"e{k}" if k % 5 == 4 else w for k, w in enumerate(item)]
    fourth = [f"e{k}" if k % 4 == 3 else w for k, w in enumerate(item)]
    parts = (fifth, fourth, item[:20])
    for part in parts:
        docs = [(d, " ".join(words(rng, 20) + part + words(rng, 20))) for d in range(copies)] + [(-1, " ".join(item)), (-2, " ".join(item[19:]))]
        got = dc.contaminated(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"))
        assert {r.doc_id for r in got.collect()} == {d for d, _ in docs if d != -2}


def test_each_place_is_one_row():
    item = [f"i{k}" for k in range(36)]
    items = dc.Items([1], [" ".join(item)])
    text = item[:3] + [f"a{k}" for k in range(25)] + item + item[:20] + ["b"] * 60 + item[10:] + item[:3]
    h = dc.word_hashes([w.encode() for w in text], dc.WordHashes())
    got = sorted((s, n) for *_, s, n in dc.align(items, [(0, i, a, h[a:b]) for i, a, b in items.windows(h)]))
    assert got == [(28, 36), (64, 20), (144, 26)]


def test_whole_small_table(spark):
    d = "/root/testdata/sf0.01"
    docs, bench = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in dc.contaminated(spark, docs, bench).collect()}
    text = {i: " ".join(t.lower().split()) for i, t in docs.select("doc_id", "text").collect()}
    exact = {(i, b) for i, t in text.items() for b, x in bench.collect() if " ".join(x.lower().split()) in t}
    assert exact and exact <= got and len(got) < 2 * len(exact)


@pytest.mark.parametrize("bench", [[], [(None, "a b c d e f"), (1, None), (2, ""), (3, "a b c")], [(1, "a b c d e f"), (1, "a b c d e f")]])
def test_edge_cases(spark, bench):
    docs = spark.createDataFrame([(1, None, 1, "x"), (2, "", 1, "x"), (3, "a b c d e f", 2, "y"), (3, "a b c d e f", 2, "y"), (None, "a b c d e f", 0, "z"), (4, "q " * 40_000, 1, "x")], "doc_id long, text string, item_id int, hits string")
    b = spark.createDataFrame(bench, "item_id long, text string")
    assert len(dc.contaminated(spark, docs, b).collect()) == (3 if len(bench) == 2 else 0)
    left = dc.decontaminate(spark, docs, b)
    assert left.columns == docs.columns and left.count() == (3 if len(bench) == 2 else 6)
    assert dc.contaminated(spark, docs.limit(0), b).collect() == []
