import string

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioforge.functions import text as X
from folioforge.operators import fencing, lines
from folioforge.operators.clean import Cleaner, cleaner_column
from folioforge.operators.markdown import collapse_blank_lines, promote_headings, rewrap

RANKS = {w: i + 1 for i, w in enumerate("the of a is in damage age door guard room wand wandering dam goblin attack with scattered word".split())}
C = Cleaner(RANKS)


def test_segment_prefers_long_common_words():
    assert C.segment("theguardroom") == "the guard room"
    assert C.segment("TheDoor") == "The Door"
    assert C.segment("wandering") == "wandering" and C.segment("") == ""


@given(st.text(alphabet=string.ascii_letters, max_size=40))
def test_segment_keeps_letters(s):
    assert C.segment(s).replace(" ", "") == s


@given(st.text(alphabet=string.ascii_letters + " .,'-*\n#>", max_size=200))
@settings(max_examples=200, deadline=None)
def test_clean_keeps_letters_in_order(s):
    keep = lambda t: [c for c in t if c.isalpha()]
    assert keep(C.clean(s)) == keep(s)


def test_steps():
    assert C.rebuild_lines("th e gu ard ro om is in th e d oor") == "the guard room is in the door"
    assert C.join_letters("1 2 3 and w o r d") == "123 and word"
    assert C.join_pieces("da mage in") == "damage in" and C.join_pieces("the age") == "the age"
    assert C.merge_bold("a**b** **c**d") == "a **b c** d" and C.merge_bold("**1 2**x") == "**12** x"
    assert C.join_hyphens("the gob-\n\nlin\nend") == "the goblin\nend"
    assert C.tighten("it ' s a guard - room") == "it's a guard-room"
    assert C.drop_blanks("a\n\nb.\n\nc") == "a\nb.\n\nc\n"
    assert C.join_bold("**gob lin.**") == "**goblin.**"


def test_columns_match_the_cleaner(spark):
    rows = [("a\n\nb.\n\nc\n\n\nd\n# e\n\nf",), ("one two three " * 30 + "\nand it runs-\non\n---\n> q",), ("",)]
    df = spark.createDataFrame(rows, "x string")
    got = df.select("x", collapse_blank_lines(F.col("x")).alias("a"), rewrap(F.col("x")).alias("b")).collect()
    assert all(r.a == C.drop_blanks(r.x) and r.b == C.rewrap(r.x) for r in got)
    words = lines.dictionary(spark.createDataFrame(list(RANKS.items()), "word string, rank int"))
    assert df.select(cleaner_column(spark, words)(F.col("x")).alias("y")).collect()[2].y == C.clean("")


def test_dictionary_lines(spark):
    df = spark.createDataFrame([("# c\nThe\t3\n\nDoor\nthe\t9",)], "text string")
    assert {(r.word, r["rank"]) for r in lines.dictionary_lines(df).collect()} == {("the", 3), ("door", 4)}


def test_fences():
    text = "Prose; with; semicolons.\n\nBugbear\nFREQUENCY: Rare\n# APPEARING: 2\nSIZE: L\n\n3 orcs. AL CE; MV 9; AC 6\n\n> Orc: MV 9; hp 3; AC 6; HD 1\n\n10 Men (LI) 4 hp\n5 Riders (HC) 8 hp"
    got = fencing.mark(text)
    assert "```stat\nBugbear\nFREQUENCY: Rare\n# APPEARING: 2\nSIZE: L\n```" in got
    assert "```stat\n3 orcs. AL CE; MV 9; AC 6\n```" in got and "```stat\nOrc: MV 9; hp 3; AC 6; HD 1\n```" in got
    assert "```stat\n10 Men (LI) 4 hp\n5 Riders (HC) 8 hp\n```" in got and got.count("```stat") == 4 and got.startswith("Prose;")


def test_bracketed_fences():
    text = "They wait. Goblin (AC 6, HD 1,\nhp 3, #AT 1, MV 9) and more.\nEnd"
    got = fencing.mark(text)
    assert "They wait." in got.split("```stat")[0] and "```stat\nGoblin (AC 6, HD 1,\nhp 3, #AT 1, MV 9)\n```" in got and "and more." in got.split("```")[-1]
    assert fencing.mark("A very long name of it (AC 5 hp 3 MV 2)").count("```") == 0


def test_promotion(spark):
    text = "See 1. OLD ROOM beyond\nTHE OLD HALL\n1 2 3\n> QUOTED LINE HERE\n```stat\nTHIS IS KEPT\n```\n**2a. KEEP'S GATE**"
    got = spark.createDataFrame([(text,)], "x string").select(promote_headings(F.col("x")).alias("y")).head().y
    assert got == "See\n### 1. OLD ROOM\nbeyond\n## THE OLD HALL\n## 1 2 3\n> QUOTED LINE HERE\n```stat\nTHIS IS KEPT\n```\n### 2a. KEEP'S GATE\n"


def test_post_process(spark):
    text = "a \x93quoted\x94 exam-\nple\n 12 \nsame\nsame\n\nsame\n\n\n\nend"
    got = spark.createDataFrame([(text,)], "x string").select(X.post_process(F.col("x")).alias("y")).head().y
    assert "“quoted”" in got and "example" in got and "12" not in got and got.count("same") == 2


def test_islands_and_merge(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([0, 0, 1, 0, 1, 1, 1, 0, 0])], "k int, pos int, v int")
    isl = lines.islands(df, ["k"], "pos", F.col("v") == 0)
    assert sorted((r.start, r.end) for r in isl.collect()) == [(0, 2), (3, 4), (7, 9)]
    assert sorted((r.start, r.end) for r in lines.merge_gaps(isl, ["k"], 1).collect()) == [(0, 4), (7, 9)]
