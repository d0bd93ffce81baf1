"""Work that must grow no faster than its input."""

import random
import re
import time

import pyarrow as pa
from pyspark.sql import functions as F

from folioforge import catalogue
from folioforge.functions import text as X
from folioforge.operators import clean, maps


def seconds(f):
    start = time.perf_counter()
    f()
    return time.perf_counter() - start


def test_repeated_lines_of_a_long_text(spark):
    rows = [f"  line {i // 2} \t" for i in range(8000)]
    df = spark.createDataFrame([("\n".join(rows),)], "x string").select(X.collapse_repeats(F.col("x")).alias("y"))
    assert seconds(lambda: df.count()) < 60 and seconds(lambda: df.head()) < 20
    assert df.head().y == "\n".join(rows[::2])


def test_repeated_lines_and_other_line_ends(spark):
    got = spark.createDataFrame([("",), (None,), ("\n\na\n a\n\na\nb  \nb ",)], "x string").select(X.collapse_repeats(F.col("x")).alias("y")).collect()
    assert [r.y for r in got] == ["", None, "\n\na\n\na\nb  \nb "]
    assert spark.createDataFrame([("\x00 a \u2028",)], "x string").select(X.trim_controls(F.col("x")).alias("y")).head().y == "a \u2028"


def test_unread_members_are_not_computed(spark, sf_dir):
    plan = lambda name: catalogue.queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "magic item" not in plan("encounter_fields") and plan("stat_f1").count("Widgets") == 1


def test_word_bounds_beside_words():
    for pattern in (r"\b(attack|flee)\b", r"\bAC\b", r"\b(?:gp|pp x)\b", r"\b(ab|)\b", r"\b(a )\b", r"\b(ab)?\b", r"\ba?"):
        short, full = re.compile(X.ascii_words(pattern), re.A), re.compile(pattern, re.A)
        for t in ("attack", "xattack flee", "flee_", "AC 5", "éAC", "gp pp x", "a b ab", "ab-a ", ""):
            assert [m.span() for m in short.finditer(t)] == [m.span() for m in full.finditer(t)], (pattern, t)


def test_votes_are_counted_where_an_images_points_are(spark):
    rng = random.Random(0)
    rows = [(k, rng.randrange(w), rng.randrange(w)) for k, n, w in [("a", 25_000, 300), ("b", 1, 3), (None, 40, 9), *((f"i{i}", 30, 8) for i in range(900))] for _ in range(n)]
    points = spark.createDataFrame(rows, "k string, x int, y int").repartition(3).cache()
    votes = maps.hough_votes(points, "k").cache()
    rho = F.floor(F.col("x") * F.col("cos") + F.col("y") * F.col("sin") + 0.5).cast("int")
    joined = points.crossJoin(maps.angles(spark)).groupBy("k", "theta", rho.alias("rho")).agg(F.count(F.lit(1)).alias("votes"))
    assert votes.exceptAll(joined).count() == 0 == joined.exceptAll(votes).count()
    for got, want in (
        (maps.hough_peaks(points, 5, "k"), maps.suppress(votes, 5, "k")),
        (maps.hough_top(points, 20, "k"), maps.top_lines(votes, 20, "k")),
        (maps.hough_angles(points, 5, "k"), maps.angle_histogram(votes.where("votes >= 5"), "k").select("k", "theta", "strength")),
    ):
        assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count() and want.count()
    exchanges = re.findall(r"Exchange [^\n]*", maps.hough_peaks(points, 5, "k")._jdf.queryExecution().executedPlan().toString())
    assert not any("theta" in x for x in exchanges), exchanges


def test_joined_pieces_of_a_long_line():
    c = clean.Cleaner({"damage": 1, "guard": 2})
    line = " ".join(["da mage", "zz"] * 6000)
    assert seconds(lambda: c.join_pieces(line)) < 5
    assert c.join_pieces(line) == line.replace("da mage", "damage") and c.join_pieces("x da mage gu ar d") == "x damage guard"


def test_few_texts_at_once():
    seen = []
    texts = pa.array(["a", None, "b"] * 400)
    got = X.by_few(lambda t: seen.append(t) or t * 2, texts)
    assert got.to_pylist() == ["aa", None, "bb"] * 400 and len(seen) == 800 and X.by_few(str, texts[:0]).to_pylist() == []
