import numpy as np
import pytest

from folioforge.llm import embedding_dedup as ed


def brute(rows, least=0.95):
    ok = {}
    for i, (v, e) in enumerate(rows):
        if e and all(x is not None and np.isfinite(x) for x in e) and any(e):
            x = np.array(e, float)
            x = x / np.abs(x).max()
            ok[i] = x / np.linalg.norm(x)
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    n = [0] * len(rows)
    for i in ok:
        for j in ok:
            if i < j and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= least:
                n[i] += 1
                n[j] += 1
                up[find(j)] = find(i)
    small = {}
    for i, (v, _) in enumerate(rows):
        small[find(i)] = min(small.get(find(i), v), v)
    return sorted((v, n[i], small[find(i)], v == small[find(i)]) for i, (v, _) in enumerate(rows))


def run(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    return sorted(map(tuple, ed.near_vectors(spark, df).collect()))


def sample(n, dim, seed, spread):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 8 + 1, dim))
    x = (base[rng.integers(0, len(base), n)] + spread * rng.normal(size=(n, dim))).astype(np.float32)
    x[5] = x[3]
    x[6] = 4 * x[3]
    return [(int(i), list(map(float, v))) for i, v in zip(rng.permutation(n), x)]


@pytest.mark.parametrize("dim,spread", [(16, 0.2), (64, 0.16), (3, 0.3)])
def test_matches_brute_force(spark, monkeypatch, dim, spread):
    monkeypatch.setattr(ed, "TILE", 40)
    monkeypatch.setattr(ed, "STRIP", 16)
    rows = sample(300, dim, dim, spread)
    assert run(spark, rows) == brute(rows)


def test_whole_table(spark, sf_dir):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert run(spark, rows) == brute(rows)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [1e300, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [-0.0, 1e-300]), (12, [0.0, 5.0])]
    assert run(spark, rows, "double") == brute(rows)
    assert run(spark, []) == []


def test_repeated_ids_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 3, "x"), (1, [0.0, 1.0], 3, "x"), (2, [0.0, 1.0], 3, "y"), (None, [1.0, 0.0], 1, "y")], "vec_id long, embedding array<float>, n long, node string")
    got = sorted(((r.vec_id or -1), r.n_links, r.component_id, r.kept) for r in ed.near_vectors(spark, df).collect())
    assert got == [(-1, 0, None, True), (1, 0, 1, True), (1, 1, 1, True), (2, 1, 1, False)]


def test_bound_holds():
    rng = np.random.default_rng(2)
    x = ed.unit(rng.normal(size=(200, 32)) * rng.exponential(size=(200, 32)))
    q, s, n, e = ed.quantise(x)
    true, code = x @ x.T, (q.astype(float) @ q.T.astype(float)) * np.outer(s, s)
    bound = np.outer(n, e) + np.outer(e, n) + np.outer(e, e)
    assert (np.abs(true - code) <= bound + 1e-12).all() and bound.max() < 0.1


def test_no_more_than_a_few_pairs_in_a_million_share_no_cell():
    """At the threshold, for the partitions of 200 and of 50,000 vectors."""
    rng = np.random.default_rng(4)
    for dim in (3, 8, 64, 200):
        x = ed.unit(rng.normal(size=(4000, dim)))
        r = rng.normal(size=x.shape)
        r = ed.unit(r - (r * x).sum(axis=1, keepdims=True) * x)
        y = 0.95 * x + np.sqrt(1 - 0.95**2) * r
        for total in (200, 50_000):
            a, b = (ed.cells(v, *ed.partitions(total)) for v in (x, y))
            shared = (a == b).mean(axis=1)
            assert shared.min() > 0 and abs(np.corrcoef((a == b)[:, :2].T)[0, 1]) < 0.2
            assert shared.mean() >= ed.SHARED ** ed.partitions(total)[0]


def test_codes_rule_out_no_pair_above_the_threshold():
    rng = np.random.default_rng(6)
    x = ed.unit(rng.normal(size=(300, 24)))
    y = ed.unit(x + 0.07 * rng.normal(size=x.shape))
    c = ed.Codes(0.95)
    close = c.close(c.table(ed.Codes.pack(x)), c.table(ed.Codes.pack(y)), np.ones(300), np.ones(300))
    true = (x * y).sum(axis=1) >= 0.95
    assert (close >= true).all() and 0 < close.sum() < 300
