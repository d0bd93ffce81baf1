from itertools import combinations

import numpy as np
import pytest

from folioforge.llm import sketch
from folioforge.llm import substring_dedup as sd
from folioforge.llm.words import WordHashes


def sentence(rng, n):
    return " ".join(f"w{k}" for k in rng.integers(0, 5000, n)).capitalize() + "."


def passage(rng, n):
    out = []
    while sum(len(s.split()) for s in out) < n:
        out.append(sentence(rng, rng.integers(6, 16)))
    return " ".join(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def cut(spark, rows):
    return {r.doc_id: r.text for r in sd.without_passages(spark, frame(spark, rows)).collect()}


def words(rng, n):
    return [f"w{k}" for k in rng.integers(0, 10**9, n)]


@pytest.mark.parametrize("size", [51, 60, 130])
def test_passages_go_to_the_word_and_nothing_else_does(spark, size):
    """Passages of words that begin and end anywhere in lines of any length, without marks, against their known places."""
    rng = np.random.default_rng(size)
    shared = [words(rng, size) for _ in range(5)]
    rows, want = [], {}
    for d in range(70):
        a, b = words(rng, rng.integers(0, 60)), words(rng, rng.integers(0, 60))
        p = shared[d % 5] if d < 50 else []
        glue = [" " if rng.random() < 0.8 or d % 3 else "\n" for _ in range(len(a + p + b))]
        if d % 4 == 1:  # lines of four words
            glue = ["\n" if k % 4 == 3 else " " for k in range(len(glue))]
        text = "".join(w + g for w, g in zip(a + p + b, glue))
        rows.append((d, text))
        if 5 <= d < 50:
            start = sum(len(w) + 1 for w in a)
            want[d] = (start, len(" ".join(p)), len(p), d % 5)
    got = {r.doc_id: tuple(r)[1:] for r in sd.repeated_passages(spark, frame(spark, rows)).collect()}
    assert got == want
    texts, left = dict(rows), cut(spark, rows)
    for d, t in texts.items():
        if d not in want:
            assert left[d] == t
        elif (rest := t[: want[d][0]].split() + t[want[d][0] + want[d][1] :].split()):
            assert left[d].split() == rest
        else:
            assert d not in left


def test_similar_paragraphs_match_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = []
    for g in range(8):
        base = [f"w{k}" for k in rng.integers(0, 5000, 90)]
        for c in range(6):
            w = list(base)
            for at in rng.integers(0, 90, c):
                w[at] = f"e{rng.integers(9**9)}"
            rows.append((g * 10 + c, passage(rng, 30) + "\n" + " ".join(w)))
    sets = {}
    for d, t in rows:
        for i, line in enumerate(t.split("\n")):
            w = line.lower().split()
            if len(w) >= sd.LINE:
                sets[d, i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    up = {k: k for k in sets}

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    for a, b in combinations(sets, 2):
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            up[y] = x
    want = {d for d, i in sets if find((d, i))[0] < d}
    found = sd.repeated_passages(spark, frame(spark, rows)).collect()
    # a document without a similar line can share a window with another of its group, but with no other
    assert {r.doc_id for r in found} >= want and want and all(r.doc_id // 10 == r.kept_doc_id // 10 for r in found)


def test_repeats_inside_one_document_and_short_lines_stay(spark):
    rng = np.random.default_rng(2)
    p, line = passage(rng, 60), sentence(rng, 9)
    rows = [(1, f"{p}\n{p}"), *((d, f"{line}\n{passage(rng, 40)}") for d in range(2, 30))]
    assert cut(spark, rows) == dict(rows)


def test_edge_cases(spark):
    rng = np.random.default_rng(3)
    p, long = passage(rng, 60), "x " * 40_000
    rows = [(1, None, 1, "a"), (2, "", 1, "b"), (3, " \n\t", 1, "c"), (4, p, 1, "d"), (5, p, 2, "e"), (None, p, 2, "f"), (6, long, 2, "g"), (7, long, 2, "h"), (4, p, 1, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, place int, _id string")
    df = df.withColumnRenamed("_id", "node")
    out = sd.without_passages(spark, df)
    got = out.collect()
    assert out.columns == df.columns
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 2, 3, 4, 4, 6]
    assert sd.repeated_passages(spark, df.limit(0)).collect() == [] and sd.without_passages(spark, df.limit(0)).collect() == []


def test_any_fifty_words_hold_a_window_that_does_not_depend_on_what_stands_around():
    rng = np.random.default_rng(4)
    known = WordHashes()
    for _ in range(300):
        p = words(rng, 50)
        a, b = (sd.Text(" ".join(words(rng, rng.integers(0, 40)) + p + words(rng, rng.integers(0, 40))), known) for _ in range(2))
        assert set(a.nodes().tolist()) & set(b.nodes().tolist())


def test_repeated_words_have_few_windows():
    x = sd.Text("a b " * 5000, WordHashes())
    assert len(x.start) < 10_000 / sd.ANCHOR + 10 and all(len(s) <= 2 for s in x.sets())


@pytest.mark.parametrize("sizes", [[3], [1, 9000, 2], [20_000], [5000, 5000, 5000]])
def test_segment_registers(sizes):
    rng = np.random.default_rng(5)
    segs = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in sizes]
    got = sketch.min_hash_segments(np.concatenate(segs), np.cumsum([0, *sizes])[:-1], 48)
    assert (got == np.stack([sketch.min_hash(s)[:48] for s in segs])).all()


def test_a_task_gives_the_bands_of_equal_paragraphs_once(spark):
    """Copies cost no band keys in their task, and all rows of the bands are dealt once."""
    import pyarrow as pa

    rng = np.random.default_rng(8)
    text = " ".join(f"w{k}" for k in rng.integers(0, 900, 120))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(1, 401)), "text": [text] * 400})
    out = pa.Table.from_batches(sd._scan(iter([batch])))
    keys = [sum(map(len, x)) for x in out.column("keys").to_pylist()]
    assert out.num_rows == 400 and keys[0] > 0 and sum(keys[1:]) == 0
    assert len({tuple(x) for x in out.column("node").to_pylist()}) == 1
    remembered = sd.Remembered(10)
    assert all(remembered.fresh([7]).tolist() == [i == 0] and remembered.fresh([100 + i]).all() for i in range(100))


def mixed_texts(rng):
    """Texts of every length, in several scripts, with repeats, long words, odd white space and none."""
    out = [None, "", " \n\t", "a b " * 300, "x " * 900, "A\x0bB\x0cc c\rd\x1ce\x85f g " * 20, "\n".join(["w" * 70 + " " + "w" * 71] * 40)]
    for n, most in zip(rng.integers(1, 300, 200), rng.choice([3, 40, 10**9], 200)):
        out.append(" ".join(f"w{k}" for k in rng.integers(0, most, n)))
    for n in rng.integers(1, 90, 60):
        out.append("".join("é" * int(k % 9) + "文" * int(k % 23) + "Zz"[: k % 3] + " \n"[int(k % 7 == 0)] for k in rng.integers(0, 99, n)))
    return out


def test_a_scan_costs_less_than_a_look_at_every_word_in_python():
    """The figure behind the seconds a GB: words are split, hashed and banded together, not one after another or text by text."""
    import time

    import pyarrow as pa

    rng = np.random.default_rng(9)
    vocabulary = np.array([f"w{k}" for k in range(50_000)])
    texts = ["\n".join(" ".join(x) for x in rng.choice(vocabulary, (8, 60))) for _ in range(1200)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})

    def by_word():
        known = WordHashes()
        return [[known[w] for w in t.encode().lower().split()] for t in texts]

    def seconds(f):
        s = time.process_time()
        f()
        return time.process_time() - s

    scan, words_alone = (min(seconds(f) for _ in range(3)) for f in (lambda: list(sd._scan(iter([batch]))), by_word))
    assert scan < 1.5 * words_alone


def test_words_of_many_texts_are_those_of_each():
    from folioforge.llm.words import Words

    texts = [(t or "").encode() for t in mixed_texts(np.random.default_rng(10))]
    x, hashes = Words(texts, WordHashes()), {}
    points = x.code_points()
    for d, t in enumerate(texts):
        want = t.lower().split()
        at = range(x.first[d], x.first[d + 1])
        assert [x.data[x.start[i] : x.stop[i]] for i in at] == want
        for i, w in zip(at, want):
            assert hashes.setdefault(w, x.h[i]) == x.h[i]
            assert points[x.start[i]] - points[x.begin[d]] == len(t[: x.start[i] - x.begin[d]].decode())
    assert len(set(hashes.values())) == len(hashes)


def test_texts_together_have_the_paragraphs_of_each_alone():
    """Lines, then windows at the anchors of the text's own three-word hashes; nodes, keys and sets do not depend on neighbours."""
    from folioforge.llm.words import mix, ngrams

    texts, known = mixed_texts(np.random.default_rng(11)), WordHashes()
    x = sd.Texts([(t or "").encode() for t in texts], known)
    nodes, (keys, count), sets = x.nodes(), x.keys(), x.sets()
    order, n, flat = x.packed(np.arange(len(nodes)))
    packed = dict(zip(order.tolist(), np.split(flat, np.cumsum(n)[:-1])))
    ends = np.cumsum(count)
    for d, t in enumerate(texts):
        one, at, first = sd.Text(t, known), np.flatnonzero(x.doc == d), x.first[d]
        lines, p = [], 0
        for line in (t or "").encode().split(b"\n"):
            p += (k := len(line.split()))
            lines += [(p - k, p)] * (k >= sd.LINE)
        room = len(one.h) - sd.WINDOW + 1
        windows = [(i, i + sd.WINDOW) for i in sd.anchors(mix(ngrams(one.h, 3))[:room]).tolist()] if room > 0 else []
        assert [(a - first, b - first) for a, b in zip(x.start[at], x.stop[at])] == lines + windows
        assert (nodes[at] == one.nodes()).all() and (np.concatenate([keys[:0], *(keys[ends[i] - count[i] : ends[i]] for i in at)]) == one.keys()[0]).all()
        for i, s in zip(at.tolist(), one.sets()):
            assert (packed[i] == s).all() and (sets[i] == s).all()
    window = ~x.is_line
    regs = sketch.min_hash_windows(x.g, x.start[window], sd.WINDOW - 4, 6)
    assert all((r == sketch.min_hash(x.g[a : a + sd.WINDOW - 4])[:6]).all() for r, a in zip(regs[:200], x.start[window]))


def test_full_sets_compare_like_python_sets():
    rng = np.random.default_rng(12)
    pool = rng.integers(0, 2**64 - 1, 40, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool, k, replace=False)) for k in rng.integers(1, 40, 300)]
    exact, n = sd.FullSets(), np.array([len(s) for s in sets])
    table = exact.table([s.tobytes() for s in sets])
    want = np.array([[100 * len(a & b) >= 75 * len(a | b) for b in map(set, sets)] for a in map(set, sets)])
    assert 0 < want.sum() < want.size
    for i in range(len(sets)):
        assert (exact.close(table[i : i + 1], table, n[i : i + 1], n) == want[i]).all()
        other = rng.permutation(len(sets))
        assert (exact.close(table, table[other], n, n[other]) == want[np.arange(len(sets)), other]).all()


def test_spans_count_code_points():
    import pyarrow as pa

    words = [f"é{k}文" for k in range(60)]
    text = "ä ö ü  " + " ".join(words) + " 𝔘 end"
    run = {"run": 0, "first": 2, "last": 62, "kept": 7, "left_words": None, "right_words": None}
    batch = pa.RecordBatch.from_pydict({"row": [1, 2], "text": ["x", text], "runs": [[], [run]]})
    got = next(sd._cut(iter([batch]))).column("spans").to_pylist()
    assert got == [[], [{"start": text.index(words[0]), "length": len(" ".join(words)), "n_words": 60, "kept_doc_id": 7}]]
    assert sd.cut_texts([text.encode()], [[run]], WordHashes())[0].decode() == "ä ö ü  𝔘 end"
