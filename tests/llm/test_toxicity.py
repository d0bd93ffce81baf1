import zlib

import numpy as np
import pytest

from folioforge.llm import toxicity as tx


def plain_ftrl(data, size):
    """The published update, a coordinate at a time."""
    z, n = [0.0] * size, [0.0] * size

    def weight(i):
        if abs(z[i]) <= tx.L1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * tx.L1) / ((tx.BETA + n[i] ** 0.5) / tx.ALPHA + tx.L2)

    for x, y in data:
        w = {i: weight(i) for i in x}
        g = 1 / (1 + np.exp(-sum(w.values()))) - y
        for i in x:
            sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / tx.ALPHA
            z[i] += g - sigma * w[i]
            n[i] += g * g
    return [weight(i) for i in range(size)]


def test_fit_matches_the_published_update(monkeypatch):
    monkeypatch.setattr(tx, "BITS", 6)
    monkeypatch.setattr(tx, "L1", 0.4)
    rng = np.random.default_rng(0)
    data = [(rng.choice(63, 8, replace=False), int(rng.random() < 0.4)) for _ in range(60)]
    order = np.random.default_rng(7).permutation(60)
    want = plain_ftrl([([*data[k][0], 63], data[k][1]) for k in order], 64)
    at, w = tx.fit(iter(data), passes=1)
    got = np.zeros(64)
    got[at] = w
    assert np.allclose(got, want, atol=1e-6) and 0 < len(at) < 64


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in tx.toxicity(spark, docs, labels).collect()}
    held = [(r.toxic, got[r.doc_id].predicted) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for i, r in got.items())
    toxic = [p for y, p in held if y]
    clean = [p for y, p in held if not y]
    assert np.mean(toxic) > 0.8 and np.mean(clean) < 0.01


def test_held_out_labels_and_other_columns_have_no_effect(spark):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(["a1", "b2", "c3", "d4"], 6)) + (" foulword" if i % 2 else ""), "x", 0.5) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    labels = [(i, 1, i % 2) for i in range(200)]
    turned = [(i, 0, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, _, t in labels]
    runs = []
    for lab, d in ((labels, docs), (turned, docs.withColumn("lang", docs.text).drop("score"))):
        runs.append({r.doc_id: r.score for r in tx.toxicity(spark, d, spark.createDataFrame(lab, "doc_id long, quality int, toxic int")).collect()})
    assert runs[0] == runs[1] and all((s >= 0.5) == (i % 2 == 1) for i, s in runs[0].items())


@pytest.mark.parametrize("labels", [[], [(1, 1, None), (None, 1, 1), (2, 0, 0)]])
def test_edge_cases(spark, labels):
    rows = [(1, None), (2, ""), (2, ""), (None, "x"), (3, "w " * 50_000)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = tx.toxicity(spark, spark.createDataFrame(rows, "doc_id long, text string"), lab).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert tx.toxicity(spark, spark.createDataFrame([], "doc_id long, text string"), lab).collect() == []


def test_features():
    known = tx.Stems()
    assert len(tx.features(None, known)) == len(tx.features(" ", known)) == 0
    assert set(tx.features("Bad, dog", known)) == set(tx.features("bad DOG!", known))
    assert len(tx.features("a b c", known)) == 3 * 3 + 2 + 1
