from itertools import combinations

import numpy as np
import pytest

from folioforge.llm import sketch
from folioforge.llm.near_dedup import near_duplicates
from folioforge.llm.words import WordHashes, shingles, split_words, word_hashes


def shingle_set(text):
    w = split_words(text)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    up = {i: i for i, _ in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for (i, a), (j, b) in combinations([(r[0], s) for r, s in zip(rows, sets)], 2):
        if a and b and 100 * len(a & b) >= 75 * len(a | b):
            x, y = sorted((find(i), find(j)))
            up[y] = x
    return {i: (len(s), find(i)) for (i, _), s in zip(rows, sets)}


def run(spark, rows, schema="doc_id long, text string"):
    got = near_duplicates(spark, spark.createDataFrame(rows, schema)).collect()
    return {r.doc_id: (r.n_shingles, r.component_id) for r in got}, got


def corpus(n_groups=12, copies=9, seed=3):
    rng = np.random.default_rng(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, k = [], 0
    for _ in range(n_groups):
        base = list(rng.choice(vocab, rng.integers(20, 200)))
        for c in range(copies):
            words = list(base)
            for at in rng.integers(0, len(words), int(len(words) * c * 0.008)):
                words[at] = "x" + str(rng.integers(10**6))
            rows.append((k, " ".join(words)))
            k += 1
    return rows


def test_matches_brute_force(spark):
    rows = corpus()
    got, out = run(spark, rows)
    assert got == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_whole_small_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert run(spark, rows)[0] == brute(rows)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "ONE  two"), (6, "one two three four five"), (7, "x " * 30000), (8, "x " * 5), (9, None)]
    assert run(spark, rows)[0] == brute(rows)
    assert run(spark, [])[0] == {}


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b", 5, "k", 2), (2, "a b", 6, "k", 3)], "doc_id long, text string, n long, sid string, component_id long")
    assert [(r.doc_id, r.component_id) for r in near_duplicates(spark, df).orderBy("doc_id").collect()] == [(1, 1), (2, 1)]


def test_null_id_and_repeated_rows(spark):
    got = near_duplicates(spark, spark.createDataFrame([(None, "a b c"), (4, "a b c"), (4, "a b c")], "doc_id long, text string")).collect()
    assert sorted([(r.doc_id or 0, r.component_id or 0, r.kept) for r in got])[-2:] == [(4, 4, True)] * 2 and len(got) == 3


@pytest.mark.parametrize("overlap", [0.3, 0.6, 0.8])
def test_joint_estimate_is_close(overlap):
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(60):
        pool = rng.integers(0, 2**63, 1500, dtype=np.uint64)
        k = int(1000 * overlap)
        a, b = pool[:1000], pool[1000 - k : 1000 - k + 700]
        j = k / (1000 + 700 - k) if k <= 700 else 700 / 1000
        inter = len(np.intersect1d(a, b))
        j = inter / (1700 - inter)
        est = sketch.joint_estimate(sketch.set_sketch(a)[None], sketch.set_sketch(b)[None], np.array([1000]), np.array([700]))[0]
        errors.append(est - j)
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06


def test_sketches_merge():
    sh = np.random.default_rng(0).integers(0, 2**63, 500, dtype=np.uint64)
    assert (np.maximum(sketch.set_sketch(sh[:200]), sketch.set_sketch(sh[150:])) == sketch.set_sketch(sh)).all()


def test_shingles_of_short_and_long():
    k = WordHashes()
    assert len(shingles(word_hashes([b"a"], k))) == 1 and len(shingles(word_hashes([], k))) == 0
    assert len(shingles(word_hashes([b"a"] * 9, k))) == 1
