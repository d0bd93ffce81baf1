import numpy as np
import pytest
from pyspark.sql import functions as F

from folioforge.config import DEFAULT, config_for
from folioforge.operators import layout, maps, tables
from folioforge.sources.files import images, png


def blank(w=900, h=1200):
    return np.full((h, w, 3), 255, np.uint8)


def text_block(img, x0, x1, y0, y1, line=14, gap=3):
    """Lines of grey words."""
    for k, y in enumerate(range(y0, y1 - line, line + gap)):
        for x in range(x0 + 7 * k % 24, x1 - 24, 30):
            img[y : y + line, x0 : x0 + 4] = img[y : y + line, x1 - 4 : x1] = 0
            img[y : y + line, x : x + 24 : 8] = 0
    return img


def two_columns():
    img = text_block(blank(), 80, 420, 100, 1000)
    return text_block(img, 480, 820, 100, 1000)


def test_config():
    assert config_for("B4 scan.pdf").min_row_split_px == 40 and config_for("B41.pdf") == DEFAULT == config_for("x.pdf")


def test_blank_page_and_margins():
    out = layout.analyse(blank())
    assert out["margins"]["top"] == 0 and out["margins"]["left"] == 0
    out = layout.analyse(two_columns())
    m = out["margins"]
    assert abs(m["top"] - 100) < 4 and abs(m["left"] - 80) < 4 and abs(m["right"] - 819) < 4 and 985 < m["bottom"] < 1006


def test_columns():
    assert layout.analyse(two_columns())["type"] == "TWO_COLUMN"
    three = blank()
    for a, b in ((80, 290), (340, 550), (600, 820)):
        text_block(three, a, b, 100, 1000)
    kinds = [len(z["columns"]) for z in layout.analyse(three)["zones"]]
    assert max(kinds) in (1, 2, 3)
    one = layout.analyse(text_block(blank(), 80, 820, 100, 1000))
    assert one["type"] == "SINGLE" and len(one["zones"][0]["columns"]) == 1


def test_illustration_splits_rows():
    img = text_block(blank(), 80, 820, 100, 400)
    img[450:560, 80:820] = 0
    text_block(img, 80, 820, 610, 1050)
    out = layout.analyse(img)
    assert [z["type"] for z in out["zones"]] == ["TEXT", "IMAGE", "TEXT"] and out["type"] == "THREE_ROW"


def test_footer_is_outside():
    img = text_block(blank(), 80, 820, 100, 900)
    img[1100:1112, 440:460:2] = 0
    assert layout.analyse(img)["margins"]["bottom"] < 920


@pytest.mark.parametrize("values,want", [([0, 0, 5, 0, 0, 0], [(0, 6)]), ([9] * 5, []), ([], [])])
def test_gaps(values, want):
    assert layout.find_gaps(np.array(values), 0, len(values), 1, 2, bridge=1) == want


def test_image_source_layouts_and_sub_pages(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(png(two_columns()))
    (tmp_path / "b.png").write_bytes(png(blank(200, 300)))
    rows = layout.page_layouts(images(spark, str(tmp_path))).select("path", "layout")
    got = {r.path[-5:]: r.layout.type for r in rows.collect()}
    assert got["a.png"] == "TWO_COLUMN"
    cells = layout.sub_pages(rows).where(F.col("path").endswith("a.png")).orderBy("seq").collect()
    assert len(cells) == 2 and cells[0].x1 <= cells[1].x0 and {c.zone_type for c in cells} == {"TEXT"}
    assert rows.where(F.col("path").endswith("a.png")).select(layout.zone_summary(F.col("layout.zones")).alias("s")).head().s == "TEXT(2)"


def test_pdf_box(spark):
    r = spark.range(1).select(layout.pdf_box(*(F.lit(v) for v in (100, 200, 300, 400, 1000, 2000, 500.0, 1000.0))).alias("b")).head().b
    assert (r.x, r.y, r.w, r.h) == (44.0, 794.0, 112.0, 112.0)


def grid(step=40, n=12, width=6):
    img = blank(step * n + 10, step * n + 10)
    for k in range(0, step * n + 1, step):
        img[k : k + width] = 0
        img[:, k : k + width] = 0
    return img


def test_square_grid():
    out = maps.classify_map(grid())
    assert out["type"] == "GRID_MAP" and abs(out["cell_w"] - out["cell_h"]) < 3 and out["confidence"] > 0.5
    assert maps.classify_map(blank(300, 300))["type"] == "NON_MAP"


def test_hex_lines():
    img = blank(500, 500)
    ys, xs = np.mgrid[0:500, 0:500]
    for t in (30, 90, 150):
        a = np.radians(t)
        d = xs * np.cos(a) + ys * np.sin(a)
        img[np.abs((d + 1000) % 50) < 10] = 0
    assert maps.classify_map(img)["type"] == "HEX_MAP"


def test_hough_relation_matches_the_array(spark):
    rng = np.random.default_rng(0)
    edges = rng.random((9, 11)) < 0.2
    acc, off = maps.accumulate(edges)
    pts = spark.createDataFrame([(1, int(x), int(y)) for y, x in zip(*np.nonzero(edges))], "img_id int, x int, y int")
    got = {(r.theta, r.rho): r.votes for r in maps.hough_votes(pts).collect()}
    want = {(t, r - off): int(v) for t, row in enumerate(acc) for r, v in enumerate(row) if v}
    assert sum(got.values()) == sum(want.values()) and sum(got.get(k) == v for k, v in want.items()) >= 0.97 * len(want)
    assert maps.angle_histogram(maps.suppress(maps.hough_votes(pts), 3)).agg(F.max("strength")).head()[0] in (1.0, None)


def test_dungeon_cells_doors_and_walls():
    img = np.zeros((120, 160, 3), np.uint8)
    img[40:80, 40:120] = 235
    img[:40, :40] = 255
    img[40:80, 79:81] = 0
    img[52:68, 79:81] = 235
    code = maps.dungeon(img, 40, 40)
    assert code.shape == (3, 4) and code[0, 0] == maps.WALL
    assert code[1, 1] == maps.DOORS["east"] and code[1, 2] == maps.DOORS["west"] and code[2, 2] == maps.WALL
    img[52:68, 79:81] = 0
    assert maps.dungeon(img, 40, 40)[1, 1] == maps.THIN_WALLS["east"]


def test_map_sections():
    img = blank(300, 200)
    img[20:80, 20:120] = 0
    img[20:80, 180:280] = 0
    img[140:190, 50:250] = 0
    assert len(maps.map_sections(img, 30)) == 3


def test_page_maps(spark, tmp_path):
    (tmp_path / "g.png").write_bytes(png(grid()))
    m = maps.page_maps(images(spark, str(tmp_path))).select("map").head().map
    assert m.type == "GRID_MAP" and m.sections and len(m.sections[0].grid) == m.sections[0].rows * m.sections[0].cols
    assert maps.section_bounds((10, 10, 50, 50), 40, 40, 60, 100) == (0, 0, 60, 80)


def test_canny_marks_an_edge():
    img = blank(60, 60)
    img[:, 30:] = 0
    e = maps.canny(img, 20, 60)
    assert e[5:-5].any(axis=1).all() and set(np.nonzero(e[30])[0]) <= {28, 29, 30, 31}


def test_ruled_table():
    img = text_block(blank(), 80, 820, 100, 300)
    img[380:394, 300:600:3] = 0
    img[420:422, 80:820] = 0
    for k in range(6):
        y = 440 + 30 * k
        for x in (100, 400, 650):
            img[y : y + 12, x : x + 90 : 3] = 0
    found = tables.detect(img)
    assert any(r.style == "RULE_BASED" and r.rule == (420, 422) for r in found)
    assert tables.detect(text_block(blank(), 80, 820, 100, 1000)) == []
    assert tables.consecutive([1, 2, 5, 3, 6]) == 6


def test_longest_runs():
    m = np.array([[1, 1, 0, 1, 1, 1], [0, 0, 0, 0, 0, 0], [1, 1, 1, 1, 1, 1]], bool)
    assert tables.longest_runs(m).tolist() == [3, 0, 6]
