import numpy as np
import pytest

from folioforge.llm import lsh, sketch
from folioforge.llm.store import Scratch


@pytest.mark.parametrize("bucket", [1000, 2])
@pytest.mark.parametrize("kind", ["joint", "plain"])
def test_pair_in_a_bucket_whose_hubs_are_unlike_it(spark, monkeypatch, kind, bucket):
    """Nodes 10 to 13 are a chain at 0.8; the bucket's hubs 0 and 99 and its other members are like none of them."""
    monkeypatch.setattr(lsh, "BUCKET", bucket)
    rng = np.random.default_rng(8)
    draw = lambda n: rng.integers(0, 1 << 63, n).astype(np.uint64)
    sets = {k: draw(200) for k in (0, 3, 50, 51, 99)}
    sets[10] = draw(200)
    for k in (11, 12, 13):
        sets[k] = np.concatenate([sets[k - 1][22:], draw(22)])
    sets = {k: np.unique(x) for k, x in sets.items()}
    regs = {k: (sketch.set_sketch(x) if kind == "joint" else sketch.min_hash_segments(x, np.array([0]), 48)[0]).tobytes() for k, x in sets.items()}
    rows = spark.createDataFrame([(k, 7) for k in sets] + [(0, 8), (99, 8)], "node long, key long")
    sketches = spark.createDataFrame([(k, len(x), regs[k]) for k, x in sets.items()], "node long, n long, regs binary")
    full = spark.createDataFrame([(k, x.tobytes()) for k, x in sets.items()], "node long, sh binary")
    options = {} if kind == "joint" else {"estimate": sketch.plain_estimate, "slack": 0.25}
    got = lsh.similar(Scratch(spark, "lsh-test"), rows, sketches, lambda nodes: full.join(nodes, "node", "left_semi"), **options)
    assert {(r.node, r.component) for r in got.collect()} == {(k, 10) for k in (10, 11, 12, 13)}


@pytest.mark.parametrize("block", [60_000, 700])
def test_clusters_of_many_blocks_give_the_same_components(spark, monkeypatch, block):
    """Two families near a common core, chains that miss the core, and copies of a core, against all pairs."""
    monkeypatch.setattr(lsh, "BLOCK", block)
    monkeypatch.setattr(lsh, "BUCKET", 5)
    rng = np.random.default_rng(5)
    draw = lambda n: rng.integers(0, 1 << 63, n).astype(np.uint64)
    core = draw(100)
    sets = {i: np.unique(np.concatenate([core[: 100 - int(rng.integers(0, 45))], draw(int(rng.integers(0, 12)))])) for i in range(60)}
    sets |= {100 + i: np.unique(np.concatenate([core[10 * (i % 6) :], draw(10 * (i % 6))])) for i in range(30)}
    regs = {k: sketch.set_sketch(x).tobytes() for k, x in sets.items()}
    rows = spark.createDataFrame([(k, 7) for k in sets], "node long, key long")
    sketches = spark.createDataFrame([(k, len(x), regs[k]) for k, x in sets.items()], "node long, n long, regs binary")
    full = spark.createDataFrame([(k, x.tobytes()) for k, x in sets.items()], "node long, sh binary")
    got = lsh.similar(Scratch(spark, "lsh-test"), rows, sketches, lambda nodes: full.join(nodes, "node", "left_semi"))
    up = {k: k for k in sets}

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    for i in sets:
        for j in sets:
            both = len(np.intersect1d(sets[i], sets[j]))
            if i < j and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                up[b] = a
    want = {(k, find(k)) for k in sets}
    alone = {k for k in sets if sum(find(j) == find(k) for j in sets) == 1}
    assert {(r.node, r.component) for r in got.collect()} == {w for w in want if w[0] not in alone}
