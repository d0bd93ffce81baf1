"""Named queries over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import arrays as A
from folioforge.functions import text as X
from folioforge.operators import components as P
from folioforge.operators import extract as E
from folioforge.operators import geometry as G
from folioforge.operators import layout as Y
from folioforge.operators import lines as L
from folioforge.operators import maps as M
from folioforge.operators import markdown as D
from folioforge.operators import rules as R
from folioforge.operators import sections as S
from folioforge.operators import statblocks as B

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
TRIM = r"regexp_replace({0}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"
NL = "chr(10)"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def trim(x: str) -> str:
    return TRIM.format(x)


# ---- sections -------------------------------------------------------------------------------------------


def sections_sql(source: str, more: str = "") -> str:
    """Sections of ``id, md`` rows by lines, running sums and groups."""
    return rf"""
src AS ({source}),
ln AS (SELECT id, unnest(string_split(md, {NL})) AS line, generate_subscripts(string_split(md, {NL}), 1) AS pos FROM src),
fl AS (SELECT *, regexp_full_match(line, '#{{1,3}}[^\S\n]+.+') AS h FROM ln),
nu AS (SELECT *, sum(h::INT) OVER (PARTITION BY id ORDER BY pos) AS sec FROM fl),
gr AS (SELECT id, sec, max(line) FILTER (h) AS head, coalesce(string_agg(line, {NL} ORDER BY pos) FILTER (NOT h), '') AS raw FROM nu GROUP BY id, sec),
tr AS (SELECT id, sec, CASE WHEN sec = 0 THEN 'Preamble' ELSE {trim("regexp_extract(head, '^#{1,3}[ ]+(.+)$', 1)")} END AS heading, CASE WHEN sec = 0 THEN 0 ELSE length(regexp_extract(head, '^(#+)', 1)) END AS level, {trim('raw')} AS body FROM gr),
sections AS (SELECT id, (row_number() OVER (PARTITION BY id ORDER BY sec) - 1)::INT AS sec_no, heading, level::INT AS level, body FROM tr WHERE NOT (sec = 0 AND body = '')){more}"""


def page_markdown(spark: SparkSession, sf: str) -> DataFrame:
    html = F.col("html")
    paragraphs = F.regexp_extract_all(html, F.lit("<p>([^<]+)"), F.lit(1))
    return table(spark, sf, "pages").select(F.col("page_id").alias("id"), F.concat(F.lit("# "), F.regexp_extract(html, "<h1>([^<]*)", 1), F.lit("\n\n"), F.array_join(paragraphs, "\n\n")).alias("markdown"))


PAGE_MD = f"SELECT page_id AS id, '# ' || regexp_extract(html, '<h1>([^<]*)', 1) || {NL} || {NL} || array_to_string(regexp_extract_all(html, '<p>([^<]+)', 1), {NL} || {NL}) AS md FROM pages"
DOC_MD = f"SELECT doc_id AS id, array_to_string(list_transform(string_split(text, {NL}), lambda x, i: CASE WHEN i % 5 = 3 THEN '## ' || x ELSE x END), {NL}) AS md FROM documents"


@query(f"WITH {sections_sql(PAGE_MD)} SELECT * FROM sections")
def sections(spark: SparkSession, sf: str) -> DataFrame:
    return S.split_sections(page_markdown(spark, sf))


@query(f"WITH {sections_sql(DOC_MD)} SELECT * FROM sections")
def preamble_sections(spark: SparkSession, sf: str) -> DataFrame:
    md = X.unlines(F.transform(X.lines(F.col("text")), lambda x, i: F.when((i + 1) % 5 == 3, F.concat(F.lit("## "), x)).otherwise(x)))
    return S.split_sections(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), md.alias("markdown")))


# ---- classifiers ----------------------------------------------------------------------------------------

BODIES = [
    "AC 5; HD 2; hp 9; #AT 1", "a stat block", "a wandering monster", "| die roll | Monster |", "a Spell Alteration", "the gate is shut", "old doorway", "nothing here", "an adventure hook",
    "the trap springs", "a riddle", "the treasure is 10 gp", "contains water", "her secret", "roll for surprise", "entrap no one", "hooked fish",
]
HEADS = ["{0}. Hall", "Introduction", "Chapter {0}", "Room {0}", "Partly done"]
MARKS = [
    "Advanced Dungeons & Dragons Second Edition, revised", "ADVANCED DUNGEONS & DRAGONS 2nd edition", "Advanced Dungeons & Dragons", "Wizards of the Coast essentials", "Wizards of the Coast 4e rules", "Wizards of the Coast 14e6",
    "Wizards of the Coast Copyright 2024", "Wizards of the Coast copyright 2014, 5th Edition", "wizards of the coast v.3.5", "Wizards of the Coast", "Dungeons & Dragons Rules Cyclopedia", "dungeons and dragons masters set",
    "Dungeons & Dragons expert set", "Dungeons & Dragons Basic Set", "Dungeons & Dragons Tactical Studies Rules", "dungeons & dragons tsr", "Daggerheart by Darrington Press", "a cook book",
]
TITLES = [
    "Wandering Things", "Random Encounters", "Encounter Table", "Rumours heard", "Saving Throws", "Save table", "Magic Items", "Spells known", "Weapon damage", "Armour", "Gear", "Treasure", "XP needed", "Gains of xp here", "Ability", "Hirelings",
    "Morale", "Character Class", "Other", "  ",
]


def pick(values: list[str], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (n % len(values) + 1).cast("int"))


def pick_sql(values: list[str], n: str) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + f"][({n}) % {len(values)} + 1]"


@query(f"""WITH s AS (SELECT p_partkey, replace({pick_sql(HEADS, 'p_partkey')}, '{{0}}', p_partkey::VARCHAR) AS heading, {pick_sql(BODIES, 'p_partkey // 5')} AS body FROM part)
SELECT p_partkey, heading, {R.first_sql(R.COMPONENT_RULES, 'UNKNOWN')} AS component_type FROM s""")
def component_types(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("p_partkey")
    s = table(spark, sf, "part").select(n, F.replace(pick(HEADS, n), F.lit("{0}"), n.cast("string")).alias("heading"), pick(BODIES, F.floor(n / 5)).alias("body"))
    return s.select(n, "heading", R.component_type(F.col("heading"), F.col("body")).alias("component_type"))


@query(f"""WITH s AS (SELECT c_custkey, {pick_sql(MARKS, 'c_custkey')} || ' ' || c_mktsegment AS raw FROM customer),
t AS (SELECT c_custkey, lower(raw) AS text, coalesce(try_cast(nullif(regexp_extract(regexp_extract(raw, '[©Cc]opyright\\s+\\d{{4}}|©\\d{{4}}'), '(\\d{{4}})$', 1), '') AS INT), 0) AS year FROM s)
SELECT c_custkey, replace({R.first_sql(R.RULESET_RULES, 'unknown')}, '_default', '') AS ruleset FROM t""")
def ruleset(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select("c_custkey", R.ruleset(F.concat(pick(MARKS, F.col("c_custkey")), F.lit(" "), "c_mktsegment"))["id"].alias("ruleset"))


@query(f"""WITH s AS (SELECT p_partkey, lower({pick_sql(TITLES, 'p_partkey')}) AS title FROM part)
SELECT p_partkey, CASE WHEN trim(title) = '' THEN 'UNKNOWN_TABLE' ELSE {R.first_sql(R.TABLE_RULES, 'GENERIC_TABLE')} END AS table_type FROM s""")
def table_titles(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", R.table_type(pick(TITLES, F.col("p_partkey"))).alias("table_type"))


@query(rf"""WITH s AS (SELECT c_custkey, c_name || CASE WHEN c_custkey % 3 = 0 THEN ': "x\y"' ELSE '' END AS name FROM customer),
e AS (SELECT c_custkey, name, CASE WHEN regexp_matches(name, '[:#"''&]') THEN '"' || replace(replace(name, '\', '\\'), '"', '\"') || '"' ELSE name END AS quoted FROM s)
SELECT c_custkey, quoted, regexp_replace(quoted, '^"|"$', '', 'g') AS name_read, 'Unknown' AS publisher FROM e""")
def front_matter(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    name = F.concat("c_name", F.when(F.col("c_custkey") % 3 == 0, ': "x\\y"').otherwise(""))
    md = F.concat(F.lit("---\nsource: s\nruleset_name: "), X.yaml_escape(name), F.lit("\n---\n\nbody"))
    parsed, _ = S.front_matter(F.col("md"))
    return c.select("c_custkey", X.yaml_escape(name).alias("quoted"), md.alias("md")).select("c_custkey", "quoted", parsed["name"].alias("name_read"), parsed["publisher"].alias("publisher"))


# ---- lines ----------------------------------------------------------------------------------------------

RUNNING = f"""
ln AS (SELECT source, doc_id, unnest(string_split(text, {NL})) AS raw FROM documents),
each AS (SELECT DISTINCT source, doc_id, {trim('raw')} AS line FROM ln WHERE length({trim('raw')}) > 3),
seen AS (SELECT source, line, count(*) AS pages FROM each GROUP BY source, line),
many AS (SELECT source, count(DISTINCT doc_id) AS n FROM documents GROUP BY source),
running AS (SELECT source, line, pages FROM seen JOIN many USING (source) WHERE n >= 3 AND pages >= greatest(3, n // 4))"""


@query(f"WITH {RUNNING} SELECT * FROM running")
def running_lines(spark: SparkSession, sf: str) -> DataFrame:
    return L.running_lines(table(spark, sf, "documents"), "source", "doc_id")


@query(f"""WITH {RUNNING}, num AS (SELECT source, doc_id, text, unnest(string_split(text, {NL})) AS raw, generate_subscripts(string_split(text, {NL}), 1) AS pos FROM documents),
kept AS (SELECT n.doc_id, string_agg(raw || {NL}, '' ORDER BY pos) FILTER (r.line IS NULL) AS text FROM num n LEFT JOIN running r ON n.source = r.source AND {trim('n.raw')} = r.line GROUP BY n.doc_id)
SELECT d.source, d.doc_id, CASE WHEN d.source IN (SELECT source FROM running) THEN coalesce(k.text, '') ELSE d.text END AS text FROM documents d LEFT JOIN kept k USING (doc_id)""")
def strip_running(spark: SparkSession, sf: str) -> DataFrame:
    return L.strip_running(table(spark, sf, "documents"), "source", "doc_id")


ALPHA = "list_filter(list_transform(string_split_regex({0}, '[ \\t\\x0B\\f\\r]+'), lambda w: length(regexp_replace(w, '[^a-zA-Z]', '', 'g'))), lambda n: n > 0)"
FRAGMENTED = f"""(t <> '' AND NOT (starts_with(t, '#') OR starts_with(t, '>') OR starts_with(t, '```') OR t = '---') AND len(string_split_regex(t, '\\s+')) >= 5 AND len({ALPHA.format('t')}) >= 5
AND len(list_filter({ALPHA.format('t')}, lambda n: n <= 3)) / len({ALPHA.format('t')}) >= 0.6 AND list_sum({ALPHA.format('t')}) / len({ALPHA.format('t')}) < 3.5)"""
DOC_LINES = f"ln AS (SELECT doc_id, unnest(string_split(text, {NL})) AS line, (generate_subscripts(string_split(text, {NL}), 1) - 1)::INT AS line_no FROM documents), tr AS (SELECT *, {trim('line')} AS t FROM ln)"


@query(f"WITH {DOC_LINES} SELECT doc_id, line_no, line FROM tr WHERE {FRAGMENTED}")
def fragmented_lines(spark: SparkSession, sf: str) -> DataFrame:
    return L.to_lines(table(spark, sf, "documents").select("doc_id", "text")).where(X.is_fragmented(F.col("line")))


@query(f"""WITH {DOC_LINES}, w AS (SELECT doc_id, unnest(string_split_regex(replace(line, '*', ' '), '[^a-zA-Z]+')) AS word FROM tr WHERE NOT {FRAGMENTED}),
dict AS (SELECT DISTINCT lower(unnest(string_split_regex(text, '[^a-zA-Z]+'))) AS word FROM benchmark)
SELECT DISTINCT doc_id, lower(word) AS word FROM w WHERE length(word) >= 4 AND lower(word) NOT IN (SELECT word FROM dict)""")
def unknown_words(spark: SparkSession, sf: str) -> DataFrame:
    words = table(spark, sf, "benchmark").select(F.explode(F.split("text", "[^a-zA-Z]+")).alias("word"))
    return L.unknown_words(table(spark, sf, "documents"), words, "doc_id")


@query(f"""WITH {DOC_LINES.replace('FROM documents)', "FROM (SELECT doc_id, text || chr(10) || text AS text FROM documents))")}, lg AS (SELECT *, lag(t) OVER (PARTITION BY doc_id ORDER BY line_no) AS before FROM tr)
SELECT doc_id, string_agg(line, {NL} ORDER BY line_no) AS text FROM lg WHERE t = '' OR before IS NULL OR t <> before GROUP BY doc_id""")
def dedupe_consecutive(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", X.collapse_repeats(F.concat("text", F.lit("\n"), "text")).alias("text"))


BLANKED = f"SELECT doc_id, replace(text, '.' || {NL}, '.' || {NL} || {NL} || {NL}) || {NL} || {NL} || replace(text, ', ', ',' || {NL} || {NL}) AS text FROM documents"


@query(f"""WITH d AS ({BLANKED}), {DOC_LINES.replace('FROM documents)', 'FROM d)')},
nb AS (SELECT *, lag(t) OVER w AS p, lead(t) OVER w AS n, max(line_no) OVER (PARTITION BY doc_id) AS last FROM tr WINDOW w AS (PARTITION BY doc_id ORDER BY line_no))
SELECT doc_id, string_agg(line || {NL}, '' ORDER BY line_no) AS text FROM nb
WHERE t <> '' OR line_no = 0 OR line_no = last OR p = '' OR n = '' OR regexp_matches(p, '^(#|>|```)|^---$|[.!?]$') OR regexp_matches(n, '^(#|>|```)|^---$') GROUP BY doc_id""")
def blank_collapse(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("text")
    blanked = F.concat(F.replace(t, F.lit(".\n"), F.lit(".\n\n\n")), F.lit("\n\n"), F.replace(t, F.lit(", "), F.lit(",\n\n")))
    return table(spark, sf, "documents").select("doc_id", blanked.alias("text")).select("doc_id", D.collapse_blank_lines(F.col("text")).alias("text"))


@query(f"""WITH {DOC_LINES.replace('FROM documents)', "FROM (SELECT conv_id * 1000 + turn AS doc_id, text FROM conversations))")}, pl AS (SELECT *, NOT (t = '' OR regexp_matches(t, '^(#|>|```)|^---$')) AS plain FROM tr),
gr AS (SELECT *, sum((NOT plain)::INT) OVER (PARTITION BY doc_id ORDER BY line_no) AS g FROM pl)
SELECT doc_id AS turn_id, g::BIGINT AS par, string_agg(t, ' ' ORDER BY line_no) AS text, count(*) AS n FROM gr WHERE plain GROUP BY doc_id, g""")
def paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("turn_id"), F.posexplode(D.paragraphs(F.col("text"))).alias("i", "p"))
    from pyspark.sql import Window

    par = F.sum((~F.col("p.plain")).cast("long")).over(Window.partitionBy("turn_id").orderBy("i"))
    return c.withColumn("par", par).where("p.plain").select("turn_id", "par", F.array_join("p.rows", " ").alias("text"), F.size("p.rows").cast("long").alias("n"))


@query(f"""WITH RECURSIVE w AS (SELECT item_id, string_split(replace(text, {NL}, ' '), ' ') AS ws FROM benchmark),
f AS (SELECT item_id, ws, 1 AS i, ws[1] AS done, length(ws[1]) AS col FROM w UNION ALL
SELECT item_id, ws, i + 1, done || CASE WHEN col = 0 THEN '' WHEN col + 1 + length(ws[i + 1]) <= 60 THEN ' ' ELSE {NL} END || ws[i + 1], CASE WHEN col > 0 AND col + 1 + length(ws[i + 1]) <= 60 THEN col + 1 + length(ws[i + 1]) ELSE length(ws[i + 1]) END FROM f WHERE i < len(ws))
SELECT item_id, done AS text FROM f WHERE i = len(ws)""")
def word_wrap(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select("item_id", X.wrap(F.replace("text", F.lit("\n"), F.lit(" ")), 60).alias("text"))


@query(r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, ' '' s\b', '''s', 'g'), ' '' t\b', '''t', 'g'), '([A-Za-z0-9_]) '' ([A-Za-z0-9_])', '\1''\2', 'g'), '([a-zA-Z]) - ([a-zA-Z])', '\1-\2', 'g') AS text
FROM (SELECT doc_id, replace(replace(replace(text, ' the ', ' '' s '), ' of ', ' - '), ', ', ' '' t') AS t FROM documents)""")
def tighten_apostrophes(spark: SparkSession, sf: str) -> DataFrame:
    t = F.replace(F.replace(F.replace("text", F.lit(" the "), F.lit(" ' s ")), F.lit(" of "), F.lit(" - ")), F.lit(", "), F.lit(" ' t"))
    return table(spark, sf, "documents").select("doc_id", X.tighten_apostrophes(t).alias("text"))


@query(f"SELECT doc_id, translate(translate(text, 'abceghij', {' || '.join(f'chr({c})' for c in (128, 129, 130, 133, 145, 146, 150, 159))}), {' || '.join(f'chr({c})' for c in X.WIN1252_CODES)}, '{X.WIN1252_CHARS}') AS text FROM documents")
def win1252(spark: SparkSession, sf: str) -> DataFrame:
    marks = "".join(map(chr, (128, 129, 130, 133, 145, 146, 150, 159)))
    return table(spark, sf, "documents").select("doc_id", X.fix_win1252(F.translate("text", "abceghij", marks)).alias("text"))


@query(r"SELECT o_orderkey, 'no ' || array_to_string(string_split(o_orderkey::VARCHAR, ''), '') || ' 42 ok' AS text FROM orders")
def scattered_digits(spark: SparkSession, sf: str) -> DataFrame:
    spaced = F.concat(F.lit("no "), F.array_join(F.filter(F.split(F.col("o_orderkey").cast("string"), ""), lambda c: c != ""), " "), F.lit(" 42 ok"))
    return table(spark, sf, "orders").select("o_orderkey", X.join_scattered_digits(spaced).alias("text"))


@query(r"""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'See ' || chr(10) || '### ' || p_partkey || '. OLD ROOM' || chr(10) || 'beyond.' ELSE '## ' || upper(p_name) || ' OF THREE' END || chr(10) || '> QUOTED LINES STAY' || chr(10) AS markdown FROM part""".replace("'See ' ||", "'See' ||"))
def room_headings(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("p_partkey")
    t = F.concat(F.when(n % 2 == 0, F.concat(F.lit("See **"), n.cast("string"), F.lit(". OLD ROOM** beyond."))).otherwise(F.concat(F.upper("p_name"), F.lit(" OF THREE"))), F.lit("\n> QUOTED LINES STAY"))
    return table(spark, sf, "part").select(n, D.promote_headings(t).alias("markdown"))


# ---- stat blocks and extractors ---------------------------------------------------------------------------


@query("""SELECT l_orderkey, l_linenumber, l_quantity::INT AS n, 'Widgets ' || l_linenumber AS name, l_returnflag AS kind, CASE l_returnflag WHEN 'N' THEN 'LN' ELSE 'CE' END AS al, '9' AS mv, l_partkey::VARCHAR AS hp, (l_linenumber % 7)::VARCHAR AS ac, l_linenumber || '+1' AS hd, '1-' || l_linenumber AS dmg FROM lineitem""")
def stat_f1(spark: SparkSession, sf: str) -> DataFrame:
    c = lambda x: F.col(x).cast("string")
    text = F.concat(
        F.col("l_quantity").cast("int").cast("string"), F.lit(" Widgets "), c("l_linenumber"), F.lit(" ("), "l_returnflag", F.lit("). AL "), F.when(F.col("l_returnflag") == "N", "LN").otherwise("CE"), F.lit("; MV 9; hp "), c("l_partkey"),
        F.lit("; AC "), (F.col("l_linenumber") % 7).cast("string"), F.lit("; HD "), c("l_linenumber"), F.lit("+1; #AT 1; Dmg 1-"), c("l_linenumber"),
    )
    b = B.inline_semicolon(F.col("t"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", text.alias("t")).select("l_orderkey", "l_linenumber", b["count"].alias("n"), b["name"].alias("name"), b["type"].alias("kind"), *(b[k].alias(k) for k in ("al", "mv", "hp", "ac", "hd", "dmg")))


@query("""SELECT p_partkey, 'labeled_block' AS format, p_name AS name, p_brand AS frequency, p_size::VARCHAR AS ac, (p_size % 9) || '+2' AS hd, CASE WHEN p_size % 2 = 0 THEN p_type END AS special_attacks FROM part""")
def stat_f2(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size").cast("int")
    text = F.concat_ws("\n", "p_name", F.concat(F.lit("FREQUENCY: "), "p_brand"), F.concat(F.lit("ARMOR CLASS: "), size.cast("string")), F.concat(F.lit("Hit Dice: "), (size % 9).cast("string"), F.lit("+2")), F.concat(F.lit("SPECIAL ATTACKS: "), F.when(size % 2 == 0, F.col("p_type")).otherwise("Nil")))
    b = F.col("b")
    return table(spark, sf, "part").select("p_partkey", B.parse_block(text).alias("b")).select("p_partkey", *(b[k].alias(k) for k in ("format", "name", "frequency", "ac", "hd", "special_attacks")))


@query("""SELECT s_suppkey, 2::BIGINT AS n, (s_suppkey * 10 + s_nationkey)::BIGINT AS hp, 'Foot/HC' AS kinds FROM supplier""")
def stat_f6(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(F.col("s_suppkey").cast("string"), F.lit(" Foot soldiers (Foot) 10 hp each\n1 Riders (HC) "), F.col("s_nationkey").cast("string"), F.lit(" hp"))
    u = F.col("b.units")
    total = F.aggregate(u, F.lit(0).cast("long"), lambda a, x: a + x["count"].cast("long") * x["hp"].cast("long"))
    return table(spark, sf, "supplier").select("s_suppkey", B.parse_block(text).alias("b")).select("s_suppkey", F.size(u).cast("long").alias("n"), total.alias("hp"), F.array_join(F.transform(u, lambda x: x["category"]), "/").alias("kinds"))


ORDER_TEXT = """'The ' || o_orderpriority || ' room. It holds ' || o_orderkey || ' gp! ' || (o_orderkey % 5 + 1) || ' trolls and 1 Ogre attack the ' || CASE WHEN o_orderkey % 2 = 0 THEN 'door' ELSE 'guard' END || '. They flee? End'"""
TREASURE_SQL = r"""[^.!?]*(?:\b(?:gp|pp|sp|ep|cp)\b|magic item|potion|scroll|sword|ring|staff|wand)[^.!?]*[.!?]"""


def order_text() -> Column:
    k = F.col("o_orderkey")
    return F.concat(F.lit("The "), "o_orderpriority", F.lit(" room. It holds "), k.cast("string"), F.lit(" gp! "), (k % 5 + 1).cast("string"), F.lit(" trolls and 1 Ogre attack the "), F.when(k % 2 == 0, "door").otherwise("guard"), F.lit(". They flee? End"))


@query(f"SELECT o_orderkey, array_to_string(list_transform(regexp_extract_all(t, '(?i){TREASURE_SQL}'), lambda x: trim(x)), ' ') AS treasure FROM (SELECT o_orderkey, {ORDER_TEXT} AS t FROM orders)")
def treasure_sentences(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", F.array_join(E.treasure_sentences(order_text()), " ").alias("treasure"))


@query("SELECT o_orderkey, (o_orderkey % 5 + 1) || ' troll' || CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 's' END || ',1 Ogre' AS monsters FROM orders")
def currency_monsters(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", F.array_join(E.monsters(order_text()), ",").alias("monsters"))


@query(f"""WITH s AS (SELECT o_orderkey, {ORDER_TEXT} AS t FROM orders), p AS (SELECT o_orderkey, t, regexp_extract_all(t || ' ', '[^.!?]+[.!?]|[^.!?]+$') AS parts FROM s)
SELECT o_orderkey, coalesce(array_to_string(list_transform(list_filter(parts, lambda x: regexp_matches(x, '(?i)\\b(attack|flee|charge|retreat|melee)\\b')), lambda x: trim(x)), '|'), '') AS tactics,
coalesce(array_to_string(list_transform(list_filter(parts, lambda x: regexp_matches(x, '(?i)\\b(floor|ceiling|wall|door|room|corridor)\\b')), lambda x: trim(x)), '|'), '') AS terrain FROM p""")
def encounter_fields(spark: SparkSession, sf: str) -> DataFrame:
    e = E.encounter(F.col("t"))  # members are taken from the expression, so that the struct's others are not computed
    return table(spark, sf, "orders").select("o_orderkey", order_text().alias("t")).select("o_orderkey", *(F.coalesce(F.array_join(e[a], "|"), F.lit("")).alias(b) for a, b in (("tactics", "tactics"), ("terrain_notes", "terrain"))))


@query("""SELECT o_orderkey, 'Look.' || chr(10) || 'A wind.' AS read_aloud, 'Notes ' || o_orderkey || ' here.' AS dm_notes FROM orders""")
def location_fields(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(F.lit("> Look.\nNotes "), F.col("o_orderkey").cast("string"), F.lit(" here.\n*A wind.*\n"))
    return table(spark, sf, "orders").select("o_orderkey", E.location(text).alias("f")).select("o_orderkey", "f.read_aloud", "f.dm_notes")


@query("""SELECT c_custkey, 'Old Gerald' AS name, 'AC 5, hp ' || c_custkey AS stat_line, 'web|fly' AS spells, 'Old Gerald of ' || c_mktsegment || chr(10) || 'Spells: web (2x), fly' AS description FROM customer""")
def npc_fields(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(F.lit("Old Gerald of "), "c_mktsegment", F.lit("\nAC 5, hp "), F.col("c_custkey").cast("string"), F.lit("\nSpells: web (2x), fly"))
    f = E.npc(F.col("t"))
    return table(spark, sf, "customer").select("c_custkey", text.alias("t")).select("c_custkey", f["name"].alias("name"), f["stat_line"].alias("stat_line"), F.array_join(f["spells"], "|").alias("spells"), f["description"].alias("description"))


@query()
def components_json(spark: SparkSession, sf: str) -> DataFrame:
    docs = page_markdown(spark, sf).select(F.col("id").cast("string").alias("source"), "markdown")
    return P.json_documents(P.components(docs))


# ---- intervals, margins and maps -------------------------------------------------------------------------

VEC = "v AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)"
ISLES = "WITH {vec}, f AS (SELECT vec_id, pos, pos - row_number() OVER (PARTITION BY vec_id ORDER BY pos) AS g FROM v WHERE {flag}), isl AS (SELECT vec_id, min(pos) AS s, max(pos) + 1 AS e FROM f GROUP BY vec_id, g)"
QUIET = ISLES.format(vec=VEC, flag="x <= 0")


def gap_rows(df: DataFrame, gaps: Column, key: str = "vec_id") -> DataFrame:
    return df.select(key, F.explode(gaps).alias("g")).select(key, F.col("g.start").cast("long").alias("start"), F.col("g.end").cast("long").alias("end"))


@query(f'{QUIET} SELECT vec_id, s AS start, e AS "end" FROM isl WHERE e - s >= 2')
def ink_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return gap_rows(table(spark, sf, "embeddings"), A.long_runs(F.transform("embedding", lambda x: x <= 0), 2))


MERGED = QUIET + ", ok AS (SELECT * FROM isl WHERE e - s >= 2), st AS (SELECT *, (s - lag(e) OVER (PARTITION BY vec_id ORDER BY s) > 1)::INT AS b FROM ok), gr AS (SELECT *, sum(coalesce(b, 0)) OVER (PARTITION BY vec_id ORDER BY s) AS g FROM st), mg AS (SELECT vec_id, min(s) AS s, max(e) AS e FROM gr GROUP BY vec_id, g)"


@query(f'{MERGED} SELECT vec_id, s AS start, e AS "end" FROM mg WHERE e - s >= 4')
def merged_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return gap_rows(table(spark, sf, "embeddings"), A.find_gaps(F.col("embedding"), 0.0, 4, bridge=1, raw_least=2))


@query(f"""{MERGED}, w AS (SELECT * FROM mg WHERE e - s >= 4), n AS (SELECT vec_id, e AS start, coalesce(lead(s) OVER (PARTITION BY vec_id ORDER BY s), 64) AS "end" FROM w),
h AS (SELECT vec_id, 0 AS start, min(s) AS "end" FROM w GROUP BY vec_id), o AS (SELECT vec_id, 0 AS start, 64 AS "end" FROM embeddings WHERE vec_id NOT IN (SELECT vec_id FROM w))
SELECT vec_id, start::BIGINT AS start, "end"::BIGINT AS "end" FROM (SELECT * FROM n UNION ALL SELECT * FROM h UNION ALL SELECT * FROM o) WHERE "end" > start""")
def bands(spark: SparkSession, sf: str) -> DataFrame:
    gaps = A.find_gaps(F.col("embedding"), 0.0, 4, bridge=1, raw_least=2)
    return gap_rows(table(spark, sf, "embeddings"), A.bands(gaps, F.size("embedding"), 1))


@query(f'{ISLES.format(vec=VEC, flag="x > 0")} SELECT vec_id, s AS start, e AS "end" FROM isl WHERE e - s >= 5')
def dense_runs(spark: SparkSession, sf: str) -> DataFrame:
    return gap_rows(table(spark, sf, "embeddings"), A.long_runs(F.transform("embedding", lambda x: x > 0), 5))


@query(f'{ISLES.format(vec=VEC, flag="x > 0")}, r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY e - s DESC, s) AS k FROM isl) SELECT vec_id, s AS start, e AS "end" FROM r WHERE k = 1')
def longest_run(spark: SparkSession, sf: str) -> DataFrame:
    g = A.longest(A.runs(F.transform("embedding", lambda x: x > 0)))
    return table(spark, sf, "embeddings").select("vec_id", g.alias("g")).where("g is not null").select("vec_id", F.col("g.start").cast("long").alias("start"), F.col("g.end").cast("long").alias("end"))


@query(f"WITH {VEC} SELECT vec_id, pos, round(avg(x::DOUBLE) OVER (PARTITION BY vec_id ORDER BY pos ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING), 4) + 0.0 AS smooth FROM v")
def moving_valley(spark: SparkSession, sf: str) -> DataFrame:
    smooth = A.moving_average(F.transform("embedding", lambda x: x.cast("double")), 4)
    return table(spark, sf, "embeddings").select("vec_id", F.posexplode(smooth).alias("pos", "s")).select("vec_id", F.col("pos").cast("long").alias("pos"), (F.round("s", 4) + 0.0).alias("smooth"))


@query("""WITH g AS (SELECT user_id, ts, epoch_us(ts) - epoch_us(lag(ts) OVER w) AS gap FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, count(gap) AS gaps, round(stddev_pop(gap) / avg(gap), 6) AS cv FROM g WHERE gap > 0 GROUP BY user_id""")
def regular_gaps(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    g = table(spark, sf, "events").select("user_id", (us - F.lag(us).over(w)).alias("gap")).where("gap > 0")
    return g.groupBy("user_id").agg(F.count("gap").alias("gaps"), F.round(F.stddev_pop("gap") / F.avg("gap"), 6).alias("cv"))


@query("""SELECT l_orderkey, list_sort(list(l_extendedprice))[(count(*) // 2 + 1)::INT]::DOUBLE AS median, list_sort(list(l_extendedprice))[(count(*) // 10 + 1)::INT]::DOUBLE AS decile FROM lineitem GROUP BY l_orderkey""")
def upper_median(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_extendedprice").alias("v"))
    return p.select("l_orderkey", A.upper_median(F.col("v")).cast("double").alias("median"), A.low_decile(F.col("v")).cast("double").alias("decile"))


MARGINS = "SELECT source, CASE WHEN doc_id % 7 = 0 THEN 'MAP' ELSE 'SINGLE' END AS type, n_chars % 11 = 0 AS full_bleed, (n_chars % 97)::DOUBLE AS top, (n_chars % 53)::DOUBLE AS bottom FROM documents"


@query(f"""WITH p AS (SELECT *, type = 'MAP' OR full_bleed AS excluded FROM ({MARGINS}))
SELECT source, count(*) FILTER (NOT excluded) AS included, count(*) FILTER (excluded) AS excluded, min(top) FILTER (NOT excluded) AS min_top, max(top) FILTER (NOT excluded) AS max_top, round(avg(top) FILTER (NOT excluded), 6) AS avg_top,
min(bottom) FILTER (NOT excluded) AS min_bottom, max(bottom) FILTER (NOT excluded) AS max_bottom, round(avg(bottom) FILTER (NOT excluded), 6) AS avg_bottom FROM p GROUP BY ROLLUP (source)""")
def margin_rollup(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("n_chars")
    p = table(spark, sf, "documents").select("source", F.when(F.col("doc_id") % 7 == 0, "MAP").otherwise("SINGLE").alias("type"), (n % 11 == 0).alias("full_bleed"), (n % 97).cast("double").alias("top"), (n % 53).cast("double").alias("bottom"))
    out = Y.margin_report(p, "source", "type", ("top", "bottom"))
    return out.withColumns({c: F.round(c, 6) for c in ("avg_top", "avg_bottom")})


@query("""SELECT source, doc_id, CASE WHEN doc_id = min(doc_id) OVER (PARTITION BY source) THEN 'FRONT_COVER' WHEN doc_id = max(doc_id) OVER (PARTITION BY source) THEN 'BACK_COVER' ELSE lang END AS type FROM documents""")
def cover_override(spark: SparkSession, sf: str) -> DataFrame:
    return Y.with_covers(table(spark, sf, "documents").select("source", "doc_id", F.col("lang").alias("type")), "source", "doc_id")


POINTS = "pt AS (SELECT vec_id AS img_id, (i % 8)::INT AS x, (i // 8)::INT AS y FROM (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings) WHERE v > 0)"
THETA = "th(theta, c, s) AS (VALUES " + ", ".join(f"({t}, {c!r}::DOUBLE, {s!r}::DOUBLE)" for t, c, s in M.ANGLES) + ")"
VOTES = f"WITH {THETA}, {POINTS}, votes AS (SELECT img_id, theta::INT AS theta, floor(x * c + y * s + 0.5)::INT AS rho, count(*) AS votes FROM pt, th GROUP BY img_id, theta, rho)"


def edge_points(spark: SparkSession, sf: str) -> DataFrame:
    v = table(spark, sf, "embeddings").select(F.col("vec_id").alias("img_id"), F.posexplode("embedding").alias("i", "v")).where("v > 0")
    return v.select("img_id", (F.col("i") % 8).alias("x"), F.floor(F.col("i") / 8).cast("int").alias("y"))


@query(f"{VOTES} SELECT * FROM votes")
def hough_votes(spark: SparkSession, sf: str) -> DataFrame:
    return M.hough_votes(edge_points(spark, sf))


@query(f"""{VOTES}, w AS (SELECT *, greatest(coalesce(max(votes) OVER (PARTITION BY img_id, theta ORDER BY rho RANGE BETWEEN 5 PRECEDING AND 1 PRECEDING), 0), coalesce(max(votes) OVER (PARTITION BY img_id, theta ORDER BY rho RANGE BETWEEN 1 FOLLOWING AND 5 FOLLOWING), 0)) AS m FROM votes)
SELECT img_id, theta, rho, votes FROM w WHERE votes >= 5 AND votes > m""")
def hough_nms(spark: SparkSession, sf: str) -> DataFrame:
    return M.hough_peaks(edge_points(spark, sf), 5)


@query(f"{VOTES}, r AS (SELECT *, row_number() OVER (PARTITION BY img_id ORDER BY votes DESC, theta, rho) AS k FROM votes) SELECT img_id, theta, rho, votes FROM r WHERE k <= 20")
def hough_topk(spark: SparkSession, sf: str) -> DataFrame:
    return M.hough_top(edge_points(spark, sf), 20)


CELLS = "cells AS (SELECT vec_id, (i // 16)::INT AS r, ((i % 8) // 2)::INT AS c, list_sort(list(v)) AS vs FROM (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings) GROUP BY vec_id, r, c)"


def cells(spark: SparkSession, sf: str) -> DataFrame:
    v = table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "v"))
    g = v.groupBy("vec_id", F.floor(F.col("i") / 16).cast("int").alias("r"), F.floor(F.col("i") % 8 / 2).cast("int").alias("c")).agg(F.collect_list("v").alias("vs"))
    floor = A.upper_median(F.col("vs")) >= 0
    return g.select("vec_id", "r", "c", F.when(floor, 0).otherwise(1).alias("cell"), (floor & (A.low_decile(F.col("vs")) >= -0.1)).alias("blank"))


CELL_SQL = "CASE WHEN vs[3] >= 0 THEN 0 ELSE 1 END AS cell, vs[3] >= 0 AND vs[1] >= -0.1::FLOAT AS blank"


@query(f"WITH {CELLS} SELECT vec_id, r, c, {CELL_SQL} FROM cells")
def grid_cells(spark: SparkSession, sf: str) -> DataFrame:
    return cells(spark, sf)


@query(f"""WITH RECURSIVE {CELLS}, g AS (SELECT vec_id, r, c, {CELL_SQL} FROM cells), b AS (SELECT * FROM g WHERE blank),
f AS (SELECT vec_id, r, c FROM b WHERE r IN (0, 3) OR c IN (0, 3) UNION SELECT b.vec_id, b.r, b.c FROM b JOIN f ON b.vec_id = f.vec_id AND abs(b.r - f.r) + abs(b.c - f.c) = 1)
SELECT vec_id, count(*) AS outside FROM f GROUP BY vec_id""")
def grid_exterior(spark: SparkSession, sf: str) -> DataFrame:
    import numpy as np

    g = cells(spark, sf).groupBy("vec_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "c", "cell", "blank"))), lambda x: F.when(x["blank"], 2).otherwise(x["cell"])).alias("grid"))

    @F.pandas_udf("long")
    def outside(grids):  # noqa: ANN001, ANN202
        import pandas as pd

        def one(x) -> int:  # noqa: ANN001
            a = np.array(x).reshape(4, 4)
            return int((M.fill_exterior(np.where(a == 1, 1, 0), a == 2) == M.WALL).sum() - (a == 1).sum())

        return pd.Series([one(x) for x in grids])

    return g.select("vec_id", outside("grid").alias("outside")).where("outside > 0")


@query("""SELECT o_custkey, (list_reduce([1::BIGINT] || list(o_orderkey % 12 ORDER BY o_orderkey), lambda e, n: CASE WHEN n >= e THEN n + 1 ELSE e END) - 1)::BIGINT AS last FROM orders GROUP BY o_custkey""")
def die_roll(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda k: (k % 12).cast("int")).alias("v"))
    return o.select("o_custkey", A.consecutive_from_one(F.col("v")).cast("long").alias("last"))


@query("""WITH e AS (SELECT l_orderkey AS page, l_linenumber AS id, (l_partkey % 20)::DOUBLE AS x, (l_suppkey % 10 * 20 + l_linenumber)::DOUBLE AS y, l_quantity::DOUBLE AS w FROM lineitem),
p AS (SELECT a.page, a.id, b.id AS below, row_number() OVER (PARTITION BY a.page, a.id ORDER BY b.y - a.y, b.id) AS k FROM e a JOIN e b ON a.page = b.page AND abs(b.x - a.x) <= 8 AND abs(b.w - a.w) <= 8 AND b.y - a.y >= 30)
SELECT page, id, below FROM p WHERE k = 1""")
def nearest_edge(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col
    e = table(spark, sf, "lineitem").select(n("l_orderkey").alias("page"), n("l_linenumber").alias("id"), (n("l_partkey") % 20).cast("double").alias("x"), (n("l_suppkey") % 10 * 20 + n("l_linenumber")).cast("double").alias("y"), n("l_quantity").cast("double").alias("w"))
    return G.nearest_below(e, "page")


@query("""WITH r AS (SELECT l_orderkey AS page, l_linenumber AS id, l_partkey % 100 AS top, l_partkey % 100 + l_quantity::INT % 9 AS bottom FROM lineitem)
SELECT page, id FROM r a WHERE id % 2 = 1 AND NOT EXISTS (FROM r b WHERE b.page = a.page AND b.id % 2 = 0 AND a.top < b.bottom AND a.bottom > b.top)""")
def region_overlap(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col
    r = table(spark, sf, "lineitem").select(n("l_orderkey").alias("page"), n("l_linenumber").alias("id"), (n("l_partkey") % 100).alias("top"), (n("l_partkey") % 100 + n("l_quantity").cast("int") % 9).alias("bottom"))
    return G.overlapping(r.where("id % 2 = 1"), r.where("id % 2 = 0"), "page", keep=False).select("page", "id")


@query("""WITH p AS (SELECT o_orderkey AS page, o_custkey % 100 AS x, o_orderkey % 100 AS y FROM orders), r AS (SELECT l_orderkey AS page, l_linenumber AS id, l_partkey % 60 AS x0, l_partkey % 60 + 30 AS x1, l_suppkey % 50 AS y0, l_suppkey % 50 + 40 AS y1 FROM lineitem)
SELECT page, id FROM p JOIN r USING (page) WHERE x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1""")
def glyph_regions(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col
    p = table(spark, sf, "orders").select(n("o_orderkey").alias("page"), (n("o_custkey") % 100).alias("x"), (n("o_orderkey") % 100).alias("y"))
    r = table(spark, sf, "lineitem").select(n("l_orderkey").alias("page"), n("l_linenumber").alias("id"), (n("l_partkey") % 60).alias("x0"), (n("l_partkey") % 60 + 30).alias("x1"), (n("l_suppkey") % 50).alias("y0"), (n("l_suppkey") % 50 + 40).alias("y1"))
    return G.within(p, r, "page").select("page", "id")


@query("""WITH p AS (SELECT source, doc_id AS page, CASE WHEN n_chars % 3 > 0 THEN 1 END AS gap, n_chars % 100 AS r FROM documents),
s AS (SELECT *, (page - min(page) OVER w) % greatest((max(page) OVER w - min(page) OVER w + 1) // 20, 1) = 0 AS k FROM p WINDOW w AS (PARTITION BY source))
SELECT source, count(*) AS sampled, count(*) FILTER (gap IS NOT NULL AND r >= 0.78 * 100) AS votes, count(*) FILTER (gap IS NOT NULL AND r >= 0.78 * 100) >= greatest(2, count(*) // 3) AS two_column FROM s WHERE k GROUP BY source""")
def two_column_vote(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("n_chars")
    p = table(spark, sf, "documents").select("source", F.col("doc_id").alias("page"), F.when(n % 3 > 0, 1).alias("gap"), (n % 100).alias("right"), F.lit(100).alias("width"))
    return G.two_column_documents(p, "source")


# ---- more aggregates, joins and repairs -------------------------------------------------------------------


@query("""WITH v AS (SELECT o_custkey, o_totalprice::DOUBLE AS v, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i FROM orders),
c AS (SELECT a.o_custkey, a.i, a.v, count(*) AS n FROM v a JOIN v b ON a.o_custkey = b.o_custkey AND b.v / a.v BETWEEN 0.8 AND 1.2 GROUP BY a.o_custkey, a.i, a.v),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, i) AS k FROM c) SELECT o_custkey, v AS mode FROM r WHERE k = 1""")
def modal_gap(spark: SparkSession, sf: str) -> DataFrame:
    v = F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", F.col("o_totalprice").cast("double").alias("v")))), lambda x: x["v"])
    return table(spark, sf, "orders").groupBy("o_custkey").agg(v.alias("v")).select("o_custkey", A.modal_gap(F.col("v")).alias("mode"))


@query("""SELECT l_orderkey, round(stddev_pop(l_quantity::DOUBLE) / avg(l_quantity::DOUBLE), 6) AS cv FROM lineitem GROUP BY l_orderkey""")
def row_regularity(spark: SparkSession, sf: str) -> DataFrame:
    v = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.col("l_quantity").cast("double")).alias("v"))
    return v.select("l_orderkey", F.round(A.variation(F.col("v")), 6).alias("cv"))


@query("""SELECT o_custkey % 10 AS page, greatest(0, least(63, floor(o_totalprice / 1000)::INT - 20)) AS bin, count(*) AS letters FROM orders GROUP BY ALL""")
def x_histogram(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select((F.col("o_custkey") % 10).alias("page"), (F.floor(F.col("o_totalprice") / 1000).cast("int") - 20).alias("x"))
    return o.groupBy("page", F.greatest(F.lit(0), F.least(F.lit(63), "x")).alias("bin")).agg(F.count(F.lit(1)).alias("letters"))


@query("""SELECT l_orderkey % 10 AS page, l_linenumber AS band, count(*) FILTER (l_quantity < 17) AS "left", count(*) FILTER (l_quantity >= 17 AND l_quantity < 34) AS middle, count(*) FILTER (l_quantity >= 34) AS "right" FROM lineitem GROUP BY ALL""")
def band_histogram(spark: SparkSession, sf: str) -> DataFrame:
    q = F.col("l_quantity")
    zones = {"left": q < 17, "middle": (q >= 17) & (q < 34), "right": q >= 34}
    return table(spark, sf, "lineitem").groupBy((F.col("l_orderkey") % 10).alias("page"), F.col("l_linenumber").alias("band")).agg(*(F.count_if(c).alias(n) for n, c in zones.items()))


@query(f"{VOTES}, l AS (SELECT img_id, theta, count(*) AS n FROM votes WHERE votes >= 5 GROUP BY img_id, theta) SELECT img_id, theta, round(n / max(n) OVER (PARTITION BY img_id), 6) AS strength FROM l")
def angle_histogram(spark: SparkSession, sf: str) -> DataFrame:
    h = M.hough_angles(edge_points(spark, sf), 5)
    return h.withColumn("strength", F.round("strength", 6))


@query(f"""{VOTES}, l AS (SELECT img_id, theta, count(*) AS n FROM votes WHERE votes >= 5 GROUP BY img_id, theta), p AS (SELECT img_id, theta, n, abs(img_id % 180 - theta) AS d FROM l),
q AS (SELECT *, row_number() OVER (PARTITION BY img_id ORDER BY least(d, 180 - d), n DESC, theta) AS k FROM p WHERE least(d, 180 - d) <= 8) SELECT img_id, (img_id % 180)::INT AS target, theta FROM q WHERE k = 1""")
def closest_angle(spark: SparkSession, sf: str) -> DataFrame:
    peaks = M.hough_angles(edge_points(spark, sf), 5)
    targets = table(spark, sf, "embeddings").select(F.col("vec_id").alias("img_id"), (F.col("vec_id") % 180).cast("int").alias("target"))
    return G.closest_angle(targets, peaks, "img_id", 8)


LINES_SQL = "h AS (SELECT l_orderkey AS page, l_linenumber AS id, l_partkey % 40 AS x0, l_partkey % 40 + 20 AS x1, l_suppkey % 30 AS y FROM lineitem WHERE l_linenumber % 2 = 1), v AS (SELECT l_orderkey AS page, l_partkey % 60 AS x, 0 AS y0, l_quantity::INT AS y1 FROM lineitem WHERE l_linenumber % 2 = 0)"


@query(f"WITH {LINES_SQL} SELECT h.page, h.id FROM h JOIN v ON h.page = v.page AND y BETWEEN y0 - 12 AND y1 + 12 GROUP BY h.page, h.id HAVING bool_or(abs(x - x0) <= 12) AND bool_or(abs(x - x1) <= 12)")
def framed_lines(spark: SparkSession, sf: str) -> DataFrame:
    n, li = F.col, table(spark, sf, "lineitem")
    h = li.where("l_linenumber % 2 = 1").select(n("l_orderkey").alias("page"), n("l_linenumber").alias("id"), (n("l_partkey") % 40).alias("x0"), (n("l_partkey") % 40 + 20).alias("x1"), (n("l_suppkey") % 30).alias("y"))
    v = li.where("l_linenumber % 2 = 0").select(n("l_orderkey").alias("page"), (n("l_partkey") % 60).alias("x"), F.lit(0).alias("y0"), n("l_quantity").cast("int").alias("y1"))
    return G.framed(h, v, "page")


@query(f"""WITH w AS (SELECT item_id, unnest(string_split_regex(text, '[^a-zA-Z]+')) AS word, generate_subscripts(string_split_regex(text, '[^a-zA-Z]+'), 1) AS rank FROM benchmark)
SELECT lower(word) AS word, min(rank)::INT AS rank FROM w WHERE word <> '' GROUP BY lower(word)""")
def dictionary(spark: SparkSession, sf: str) -> DataFrame:
    w = table(spark, sf, "benchmark").select(F.posexplode(F.split("text", "[^a-zA-Z]+")).alias("i", "word")).select("word", (F.col("i") + 1).alias("rank"))
    return L.dictionary(w)


@query(r"""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 3 = 1 THEN c_name || '.v2' ELSE '.' || c_mktsegment END AS stem FROM customer""")
def file_stems(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey") % 3
    name = F.when(k == 0, F.concat("c_name", F.lit(".pdf"))).when(k == 1, F.concat("c_name", F.lit(".v2.md"))).otherwise(F.concat(F.lit("."), "c_mktsegment"))
    return table(spark, sf, "customer").select("c_custkey", X.strip_extension(name).alias("stem"))


def _words(spark: SparkSession, sf: str) -> DataFrame:
    return dictionary(spark, sf)


@query()
def word_segment(spark: SparkSession, sf: str) -> DataFrame:
    from folioforge.operators.clean import cleaner_column

    segment = cleaner_column(spark, _words(spark, sf), method="segment")
    return table(spark, sf, "benchmark").select("item_id", segment(F.regexp_replace("text", "[^a-zA-Z]", "")).alias("text"))


@query()
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    from folioforge.operators.clean import cleaner_column

    return table(spark, sf, "documents").select("doc_id", cleaner_column(spark, _words(spark, sf))(F.col("text")).alias("text"))


@query()
def fence_text(spark: SparkSession, sf: str) -> DataFrame:
    from folioforge.operators.fencing import with_fences

    orc = F.concat(F.lit("\n\n3 orcs. AL CE; MV 9; hp "), F.col("doc_id").cast("string"), F.lit("; AC 6\n\n"))
    return table(spark, sf, "documents").select("doc_id", with_fences(F.replace("text", F.lit("\n"), orc)).alias("text"))
