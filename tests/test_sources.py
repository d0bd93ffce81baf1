import io
import json
import zipfile
import zlib

from pyspark.sql import functions as F

from folioforge.operators import glyphs as G
from folioforge.operators import geometry
from folioforge.plans import cli, pipelines
from folioforge.sources import files, pdf, sinks
from folioforge.streaming import ingest

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def docx():
    p = lambda t, s="": f'<w:p><w:pPr><w:pStyle w:val="{s}"/></w:pPr><w:r><w:t>{t}</w:t></w:r></w:p>'
    cell = lambda t: f"<w:tc>{p(t)}</w:tc>"
    body = p("Title", "Heading1") + p("Words here") + f"<w:tbl><w:tr>{cell('a|b')}{cell('c')}</w:tr><w:tr>{cell('1')}{cell('2')}</w:tr></w:tbl>" + p("1. ROOM", "heading 2")
    f = io.BytesIO()
    with zipfile.ZipFile(f, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{body}</w:body></w:document>")
    return f.getvalue()


def make_pdf(pages, compress=True):
    objects = {1: b"<</Type/Catalog/Pages 2 0 R>>", 2: f"<</Type/Pages/Kids[{' '.join(f'{10 + 2 * i} 0 R' for i in range(len(pages)))}]/Count {len(pages)}/MediaBox[0 0 612 792]/Resources<</Font<</F1 3 0 R/F2 4 0 R>>>>>>".encode(), 3: b"<</Type/Font/Subtype/Type1/BaseFont/Times-Roman>>", 4: b"<</Type/Font/Subtype/Type1/BaseFont/Times-BoldItalic>>"}
    for i, content in enumerate(pages):
        raw = zlib.compress(content.encode("cp1252")) if compress else content.encode("cp1252")
        objects[10 + 2 * i] = f"<</Type/Page/Parent 2 0 R/Contents {11 + 2 * i} 0 R>>".encode()
        objects[11 + 2 * i] = f"<</Length {len(raw)}{'/Filter/FlateDecode' if compress else ''}>>\nstream\n".encode() + raw + b"\nendstream"
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (n, b) for n, b in objects.items())


PAGE = "q 50 40 200 100 re S Q BT /F1 10 Tf 14 TL 72 720 Td (Plain \\(a\\) words) Tj T* /F2 10 Tf [(Bo) -20 (ld)] TJ ET"


def test_scans_and_formats(spark, tmp_path):
    for name, data in {"a.md": b"# A", "b.txt": "é".encode(), "bad.txt": b"\xff\xfe", "d.docx": docx(), "broken.docx": b"x", "e.xyz": b"z"}.items():
        (tmp_path / name).write_bytes(data)
    names = lambda df: sorted(r.name for r in df.select("name").collect())
    d = str(tmp_path)
    assert names(files.files(spark, f"{d}/a.md")) == ["a.md"] and names(files.files(spark, f"{d}/*.txt")) == ["b.txt", "bad.txt"]
    assert names(files.files(spark, d, regex="[ab]\\..*")) == ["a.md", "b.txt"]
    got = {r.name: (r.text, r.error) for r in files.documents(files.files(spark, d)).collect()}
    assert got["a.md"] == ("# A", None) and got["b.txt"] == ("é", None) and got["bad.txt"][1] == "not UTF-8" and got["broken.docx"][1] and got["e.xyz"][1] == "unsupported format"
    assert got["d.docx"][0] == "# Title\n\nWords here\n\n| a\\|b | c |\n| --- | --- |\n| 1 | 2 |\n\n## 1. ROOM"


def test_pdf_letters(spark, tmp_path):
    for k, compress in enumerate((True, False)):
        d = pdf.Document(make_pdf([PAGE, PAGE], compress))
        pages = list(d.pages())
        assert len(pages) == 2
        letters, frames, w, h = pdf.read_page(d, pages[0])
        assert "".join(x[0] for x in letters) == "Plain(a)wordsBold" and (w, h) == (612.0, 792.0) and frames == [(50.0, 652.0, 200.0, 100.0)]
        assert not letters[0][4] and letters[-1][4] and letters[-1][5] and letters[-1][2] - letters[0][2] == 14
        (tmp_path / f"{k}.pdf").write_bytes(make_pdf([PAGE], compress))
    (tmp_path / "x.pdf").write_bytes(b"no")
    g = pdf.glyphs(files.files(spark, str(tmp_path)))
    assert g.where("error is not null").count() == 1
    text = {r.text for r in G.pages_text(g.where("error is null"), ["path", "page_no"]).collect()}
    assert text == {"Plain (a) words\n***Bold***"}
    assert pdf.frames(files.files(spark, str(tmp_path))).count() == 2


def letters(rows):
    out = []
    for y, x, text in rows:
        for i, ch in enumerate(text):
            if ch != " ":
                out.append((x + 5.0 * i, y, ch, 10.0, False, False))
    return out


def test_columns_and_sidebar_text():
    rows = [(50.0, 60.0, "A heading that runs over both of the columns of this page, and on")]
    for k in range(12):
        rows += [(80.0 + 12 * k, 60.0, f"left line {k} is long enough here"), (80.0 + 12 * k, 330.0, f"right line {k} is long enough too")]
    got = G.page_text(letters(rows), 612.0, False)
    assert got.index("left line 11") < got.index("right line 0") and got.startswith("A heading")
    rows = [r for k in range(12) for r in ((80.0 + 12 * k, 20.0, f"side {k} of it all here"), (80.0 + 12 * k, 200.0, f"main text {k} which is much wider than the side and goes on"))]
    assert "side 3" in G.sidebar_text(letters(rows), 612.0) and "main" not in G.sidebar_text(letters(rows), 612.0)


def test_text_by_layout_and_titles(spark):
    from folioforge.operators import tables

    rows = [(1, 0, s, t, x, y, h, b, i, 612.0) for s, (x, y, t, h, b, i) in enumerate(letters([(50.0, 60.0, "Wandering Monsters"), (80.0, 60.0, "left"), (80.0, 330.0, "right")]))]
    g = spark.createDataFrame(rows, "doc int, page_no int, seq int, text string, x double, y double, height double, bold boolean, italic boolean, page_width double")
    zone = lambda x0, x1: {"x_left": x0, "x_right": x1, "sub_zones": [{"y_top": 140, "y_bottom": 300, "type": "TEXT", "horiz_gaps": []}]}
    lay = {"type": "TWO_COLUMN", "margins": {"top": 0, "bottom": 300, "left": 0, "right": 1275}, "zones": [{"y_top": 140, "y_bottom": 300, "type": "TEXT", "columns": [zone(0, 600), zone(650, 1275)]}], "width": 1275, "height": 1650}
    from folioforge.operators.layout import LAYOUT

    pages = pipelines.pages_by_layout(g, spark.createDataFrame([(1, 0, lay)], f"doc int, page_no int, layout {LAYOUT}"))
    assert [(r.seq, r.text) for r in pages.orderBy("seq").collect()] == [(0, "left"), (1, "right")]
    found = spark.createDataFrame([(1, 0, 0, 1275, 130, 300, None, None, 90, 120, "DIE_ROLL"), (1, 0, 0, 1275, 400, 500, None, None, None, None, "RULE_BASED")], "doc int, page_no int, x_left int, x_right int, y_top int, y_bottom int, rule_top int, rule_bottom int, title_top int, title_bottom int, style string")
    got = sorted((r.y_top, r.title, r.type) for r in tables.with_titles(found, g, ["doc", "page_no"]).collect())
    assert got == [(130, "Wandering Monsters", "WANDERING_MONSTER_TABLE"), (400, None, "UNKNOWN_TABLE")]


def test_fonts(spark):
    df = spark.createDataFrame([("Times-BoldItalic", None, None, None), ("X", True, 0.0, 0.0), ("X", False, -12.0, 0.0), ("X", False, 0.0, 0.2), ("Arial", None, None, None)], "f string, flag boolean, a double, s double")
    got = df.select(G.is_bold(F.col("f")).alias("b"), G.is_italic(F.col("f"), F.col("flag"), F.col("a"), F.col("s")).alias("i"), G.boxed_as_quotes(F.lit("a\nb")).alias("q")).collect()
    assert [(r.b, r.i) for r in got] == [(True, True), (False, True), (False, True), (False, True), (False, False)] and got[0].q == "> a\n> b"


def test_boxes(spark):
    e = spark.createDataFrame([(1, 1, 10.0, 10.0, 100.0), (1, 2, 12.0, 90.0, 99.0), (1, 3, 11.0, 300.0, 100.0), (2, 4, 10.0, 60.0, 100.0)], "page int, id int, x double, y double, w double")
    assert sorted((r.y, r.h) for r in geometry.boxes_from_edges(e, "page").collect()) == [(10.0, 80.0), (90.0, 210.0)]
    h = spark.createDataFrame([(1, 1, 0.0, 100.0, 50.0), (1, 2, 0.0, 400.0, 50.0)], "page int, id int, x0 double, x1 double, y double")
    v = spark.createDataFrame([(1, 5.0, 0.0, 90.0), (1, 95.0, 0.0, 90.0)], "page int, x double, y0 double, y1 double")
    assert [r.id for r in geometry.framed(h, v, "page").collect()] == [1]
    t = spark.createDataFrame([(1, 178)], "k int, target int")
    p = spark.createDataFrame([(1, 2, 0.5), (1, 174, 0.9), (1, 90, 1.0)], "k int, theta int, strength double")
    assert geometry.closest_angle(t, p, "k", 8).head().theta == 174


def test_whole_pipeline(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.md").write_text("# 1. GUARD ROOM\n> Look.\n3 trolls wait.")
    (src / "b.txt").write_text("plain")
    (src / "c.pdf").write_bytes(make_pdf(["BT /F1 10 Tf 14 TL 72 720 Td (1. OLD ROOM) Tj 0 -40 Td (Three orcs. AL CE; MV 9;) Tj T* (AC 6; HD 1;) Tj T* (hp 3) Tj ET"]))
    words = spark.createDataFrame([("old", 1), ("room", 2)], "word string, rank int")
    md = {r.source: r for r in pipelines.convert(spark, str(src), words).collect()}
    assert md["a.md"].markdown.startswith("# 1.") and "ruleset: unknown" in md["b.txt"].markdown
    assert "### 1. OLD ROOM" in md["c.pdf"].markdown and "```stat\n" in md["c.pdf"].markdown
    docs = {json.loads(r.json)["metadata"]["source"]: json.loads(r.json) for r in pipelines.run_all(spark, str(src)).collect()}
    assert docs["a.md"]["components"][0]["fields"]["monsters"] == ["3 trolls"] and set(docs) == {"a.md", "b.txt", "c.pdf"}
    out = tmp_path / "out"
    assert cli.main(["all", str(src), str(out)]) == 0
    assert len(list(out.glob("document=*/part-*"))) == 3
    assert cli.main(["parse", f"{src}/*.md", str(tmp_path / "p")]) == 0


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.md").write_text("# A\nx\n# B\ny")
    q = ingest.stream_components(spark, str(src)).writeStream.format("memory").queryName("parts").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [r.section for r in spark.sql("select section from parts order by sec_no").collect()] == ["A", "B"]
    q = ingest.for_each_batch(ingest.arriving_markdown(spark, str(src)), pipelines.parse, str(tmp_path / "o"), str(tmp_path / "c"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2


def test_json_lines(spark, tmp_path):
    sinks.write_json_lines(pipelines.parse(spark.createDataFrame([("a", "# A\nx")], "source string, markdown string")), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 1
    assert sinks.grid_json(spark.createDataFrame([(2, 1, [0, 1])], "width int, height int, grid array<int>")).select(F.col("json")).head()[0] == '{"width":2,"height":1,"grid":[0,1]}'
