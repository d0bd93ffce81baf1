from collections import defaultdict

import numpy as np
import pytest

from folioforge.llm import quality
from folioforge.llm.quality import BOUND, ORDER, SIZE, Model, grams, judge, symbols


def plain_kneser_ney(gram, count):
    """The textbook recursion over dictionaries."""
    top = {}
    for g, c in zip(gram.tolist(), count.tolist()):
        key = []
        for _ in range(ORDER):
            key.append(g % SIZE)
            g //= SIZE
        top[tuple(reversed(key))] = c
    counts = {ORDER: top}
    for k in range(ORDER - 1, 0, -1):
        seen = defaultdict(set)
        for g in counts[k + 1]:
            seen[g[1:]].add(g[0])
        counts[k] = {g: len(s) for g, s in seen.items()}
    discount = {}
    for k, c in counts.items():
        n = [max(1, sum(v == i for v in c.values())) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        discount[k] = [0] + [min(0.95 * i, max(0.05, i - (i + 1) * y * n[i] / n[i - 1])) for i in (1, 2, 3)]

    def p(context, w):
        if context is None:
            return 1 / SIZE
        k = len(context) + 1
        low = p(context[1:] if context else None, w)
        rows = [v for g, v in counts[k].items() if g[:-1] == context]
        if not rows:
            return low
        c = counts[k].get((*context, w), 0)
        left = sum(discount[k][min(v, 3)] for v in rows)
        return (c - discount[k][min(c, 3)] + left * low) / sum(rows)

    return p


def test_tables_match_the_recursion():
    text = "the cat sat on the mat. the cat ran; The hat sat on a CAT CAT 99 é"
    g, c = np.unique(grams(symbols(text)), return_counts=True)
    table, p = Model(g, c).cost(np.arange(SIZE**ORDER)).reshape((SIZE,) * ORDER), plain_kneser_ney(g, c)
    rng = np.random.default_rng(0)
    s = symbols(text)
    for i in range(3, len(s)):
        assert np.isclose(table[tuple(s[i - 3 : i + 1])], -np.log(p(tuple(s[i - 3 : i].tolist()), int(s[i]))), rtol=1e-4)
    for _ in range(100):
        k = tuple(rng.integers(0, SIZE, 4).tolist())
        assert np.isclose(table[k], -np.log(p(k[:3], k[3])), rtol=1e-4)
    assert np.allclose(np.exp(-table[s[0], s[1], s[2]].astype(float)).sum(), 1, atol=1e-3)


def test_symbols():
    assert symbols(None).tolist() == symbols("").tolist() == [BOUND] * 4
    assert symbols("aa  b\n").tolist()[3:-1] == [0, 0, quality.SPACE, 1]
    assert symbols("A a a").tolist()[3:-1] == [quality.CAPITAL, 0, quality.SPACE, 0, quality.REPEAT]


def test_no_two_characters_share_symbols():
    every = [c for c in map(chr, [*range(0x3100), *range(0x4E00, 0xA000, 7), *range(0x10000, 0x110000, 997)]) if not c.isspace()]
    found = {tuple(symbols(c).tolist()) for c in every}
    assert len(found) == len(every) and all(max(x) < SIZE for x in found)
    assert symbols("4я漢%").tolist()[3:-1] == [x for c in "4я漢%" for x in symbols(c).tolist()[3:-1]]
    assert symbols("é😀é").tolist()[3:-1] == [x for c in "é😀é" for x in symbols(c).tolist()[3:-1]]
    assert symbols("\x04 a").tolist() != symbols("a a").tolist()


def test_letters_that_shared_a_class_are_told_apart(spark):
    """Trusted text of one half of the alphabet, and junk of the letters that stand LETTERS code points on."""
    rng = np.random.default_rng(3)
    text = lambda first: "".join(map(chr, first + rng.integers(0, 12, 400)))
    rows = [(i, "zh", text(0x4E00)) for i in range(40)] + [(100 + i, "zh", text(0x4E00 + quality.LETTERS)) for i in range(5)]
    labels = spark.createDataFrame([(i, 1) for i in range(30)], "doc_id long, quality int")
    got = {r.doc_id: r for r in judge(spark, spark.createDataFrame(rows, "doc_id long, lang string, text string"), labels).collect()}
    assert not any(got[100 + i].accepted for i in range(5)) and min(got[100 + i].perplexity for i in range(5)) > 1.5 * max(got[i].perplexity for i in range(40))


def shuffled(spark):
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    found = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return sum(found.apply(i).shuffleWriteBytes() for i in range(found.size()))


def test_texts_are_dealt_once(spark, tmp_path):
    """Texts that do not compress: what is written to be dealt is little more than they are."""
    rng = np.random.default_rng(4)
    rows = [(i, "en", "".join(map(chr, rng.integers(33, 127, 20_000)))) for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(4).write.parquet(str(tmp_path / "d"))
    docs, labels = spark.read.parquet(str(tmp_path / "d")), spark.createDataFrame([(i, 1) for i in range(5)], "doc_id long, quality int")
    before = shuffled(spark)
    out = judge(spark, docs, labels)
    assert out.count() == 200
    assert 200 * 20_000 < shuffled(spark) - before < 1.8 * 200 * 20_000
    assert out.select("doc_id", "lang", "text").exceptAll(docs).isEmpty()


def test_junk_is_rejected_and_trusted_text_kept(spark, sf_dir):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r.doc_id: r.accepted for r in judge(spark, docs, labels).collect()}
    want = {r.doc_id: r.quality for r in labels.collect()}
    good, bad = [got[i] for i, q in want.items() if q == 1], [got[i] for i, q in want.items() if q == 0]
    assert len(got) == docs.count() and np.mean(good) > 0.99 and np.mean(bad) < 0.25


def test_perplexities_and_thresholds_match_the_recursion(spark, monkeypatch):
    """Each row's perplexity from counts of dictionaries, and each language's threshold from sorted costs, in several groups."""
    monkeypatch.setattr(quality, "GROUP", 3000)
    rng = np.random.default_rng(1)
    alphabet = {"en": "abcde .", "ru": "абвг ,", "xx": "xyz é"}
    rows = [(i, lang, "".join(rng.choice(list(alphabet[lang]), rng.integers(0, 60)))) for i in range(90) for lang in [("en", "ru", "xx")[i % 3]]]
    rows += [(200, None, "abc de"), (201, "en", None), (202, "ru", "a" * 300)]
    trusted = {i for i, lang, _ in rows if lang in ("en", "ru") and i % 2 == 0 and i < 200}
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = {r.doc_id: r for r in judge(spark, docs, spark.createDataFrame([(i, 1) for i in trusted], "doc_id long, quality int")).collect()}
    models = {}
    for name in ("en", "ru", ""):
        some = [t for i, lang, t in rows if i in trusted and name in ("", lang)]
        g, c = np.unique(np.concatenate([grams(symbols(t)) for t in some]), return_counts=True)
        p = plain_kneser_ney(g, c)
        parts = lambda x: [x // SIZE**k % SIZE for k in (3, 2, 1, 0)]
        cost = {x: -np.log(p(tuple(parts(x)[:3]), parts(x)[3])) for x in {int(v) for _, _, t in rows for v in grams(symbols(t))} | set(g.tolist())}
        models[name] = cost, sum(cost[x] * n for x, n in zip(g.tolist(), c.tolist())) / c.sum()
    want = {}
    for i, lang, t in rows:
        cost, mean = models[lang if lang in ("en", "ru") else ""]
        own = [cost[int(x)] for x in grams(symbols(t))]
        want[i] = (sum(own) + quality.PRIOR * mean) / (len(own) + quality.PRIOR)
    assert got.keys() == want.keys() and all(np.isclose(np.log(got[i].perplexity), want[i], rtol=1e-4) for i in want)
    cut = {k: max(want[i] for i, lang, _ in rows if i in trusted and lang == k) for k in ("en", "ru")}
    for i, lang, _ in rows:
        assert np.isclose(np.log(got[i].threshold), cut.get(lang, max(cut.values())), rtol=1e-4)
        assert got[i].accepted == (got[i].perplexity <= got[i].threshold)


@pytest.mark.parametrize("labelled", [True, False])
def test_edge_cases(spark, labelled):
    rows = [(1, None, None, "k", 1.0), (2, "en", "", "k", 1.0), (3, "en", "plain words here", "k", 2.0), (3, "en", "plain words here", "k", 2.0), (4, "xx", "%" * 50_000, "k", 1.0), (None, "en", "plain", "k", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string, source string, threshold double")
    labels = spark.createDataFrame([(3, 1, 0), (None, 1, 0)] if labelled else [], "doc_id long, quality int, toxic int")
    out = judge(spark, docs, labels)
    got = out.collect()
    assert len(got) == 6 and out.columns == ["doc_id", "lang", "text", "source", "perplexity", "threshold", "accepted"]
    verdict = {r.doc_id: r.accepted for r in got}
    assert verdict[3] and (verdict[4] != labelled)
    assert judge(spark, docs.limit(0), labels).collect() == []
