import json

from pyspark.sql import functions as F

from folioforge.operators import extract, rules, sections, statblocks
from folioforge.operators.components import components, json_documents


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).head().y


MD = """
lead in

# 1. GUARD ROOM
> You see a hall.
3 trolls wait. They hold 50 gp in a chest.
*A cold wind.*
## Overview of it
text
#### four is no heading
### 
###  Spaced
```stat
10 Hobgoblins (orc) [Advanced Troop]. AL LE; MV 9"; hp 2, 3x3; AC 5; HD 1+1; #AT 1; Dmg 1-8
```
"""


def test_sections(spark):
    got = [(s.heading, s.level, s.body) for s in one(spark, MD, sections.sections)]
    assert [g[:2] for g in got] == [("Preamble", 0), ("1. GUARD ROOM", 1), ("Overview of it", 2), ("Spaced", 3)]
    assert got[0][2] == "lead in" and got[2][2] == "text\n#### four is no heading\n###"
    assert one(spark, "", sections.sections) == [] == one(spark, None, sections.sections)
    assert [s.heading for s in one(spark, "# A\n# B", sections.sections)] == ["A", "B"]


def test_fence_aware(spark):
    md = "# H\n```stat\nOrc\n# APPEARING: 3\n# ATTACKS: 1\n```\nend"
    assert [s.heading for s in one(spark, md, sections.sections)] == ["H", "APPEARING: 3", "ATTACKS: 1"]
    got = one(spark, md, lambda c: sections.sections(c, fence_aware=True))
    assert [s.heading for s in got] == ["H"] and "# APPEARING: 3" in got[0].body


def test_inline_block(spark):
    b = one(spark, "10 Hobgoblins (orc) [Advanced Troop]. AL LE; MV 9; hp 2, 3x3, 5, 3x6, 7,9; AC 5; HD 1+1; #AT 1; Dmg 1-8", statblocks.parse_block)
    assert (b.format, b["count"], b.name, b.type, b.descriptor) == ("inline_semicolon", 10, "Hobgoblins", "orc", "Advanced Troop")
    assert (b.al, b.mv, b.hp, b.ac, b.hd, b.at, b.dmg) == ("LE", "9", "2, 3x3, 5, 3x6, 7,9", "5", "1+1", "1", "1-8")


def test_notes_of_the_last_field(spark):
    text = "Orc. AC 5; hp 3; dmg 1-8"
    assert one(spark, text, statblocks.parse_block).notes is None
    assert one(spark, text, lambda c: statblocks.parse_block(c, compat=True)).notes == "dmg 1-8"
    assert one(spark, "Orc. AC 5; hp 3; carries a horn", statblocks.inline_semicolon).notes == "carries a horn"


def test_other_blocks(spark):
    b = one(spark, "Bugbear\nFREQUENCY: Rare\n# APPEARING: 2-8\nARMOR CLASS: 5\nMAGIC RESISTANCE: nil\nXP VALUE: 135", statblocks.parse_block)
    assert (b.format, b.name, b.frequency, b.appearing, b.ac, b.magic_resistance, b.xp) == ("labeled_block", "Bugbear", "Rare", "2-8", "5", None, "135")
    b = one(spark, "Gerald\nthe Bold\n5th level fighter\nStrength 17 Dexterity 12 THAC0 16\nHit Points 30\nChain mail and shield", statblocks.parse_block)
    assert (b.format, b.name, b.title, b.class_level, b.str, b.dex, b.thac0, b.hp, b.equipment) == ("narrative_character", "Gerald", "the Bold", "5th level fighter", "17", "12", "16", "30", "Chain mail and shield")
    b = one(spark, "20 Foot soldiers (LI) 5 hp each\n10 Riders (HC) 9 hp each", statblocks.parse_block)
    assert [(u["count"], u.name, u.category, u.hp) for u in b.units] == [(20, "Foot soldiers", "LI", 5), (10, "Riders", "HC", 9)]
    b = one(spark, "Zed\nSTR 12 INT 9 WIS 10 DEX 11 CON 13", statblocks.parse_block)
    assert (b.format, b.name) == ("compact_card", "Zed")
    assert one(spark, " ", statblocks.parse_block) is None and one(spark, None, statblocks.parse_block) is None


def test_location(spark):
    f = one(spark, "> Look.\n3 trolls and 1 Ogre. 50 gp lie here!\n*Wind.*\nRead aloud: hello\nmore\n\nafter", extract.location)
    assert f.read_aloud == "Look.\nWind.\nmore" and f.monsters == ["3 trolls", "1 Ogre"]
    assert f.dm_notes == "3 trolls and 1 Ogre. 50 gp lie here!\nafter" and f.treasure_summary == "50 gp lie here!"


def test_npc_and_encounter(spark):
    f = one(spark, "The wise Gerald Stone lives here.\nAC 5, HD 2\nSpells: sleep (2x), web; fly\n", extract.npc)
    assert f.name == "The" and f.stat_line == "AC 5, HD 2" and f.spells == ["sleep", "web", "fly"] and "AC 5" not in f.description
    f = one(spark, "Two orcs (AC 6) guard the door. They attack at once! 3 goblins flee. 3 goblins flee. 9 gp.", extract.encounter)
    assert f.enemies == ["Two orcs (AC 6)", "3 goblins flee", "9 gp"] and f.tactics[0] == "They attack at once!" and f.terrain_notes == ["Two orcs (AC 6) guard the door."] and f.treasure.endswith("9 gp.")
    f = one(spark, "\nOgre\nAC 5 HD 4+1 hp 20\nALIGNMENT: chaotic evil\nSPECIAL ATTACKS: two\nlines\nSIZE: L", extract.stat_section)
    assert (f.name, f.ac, f.hd, f.hp, f.alignment, f.special_attacks) == ("Ogre", "5", "4+1", "20", "chaotic evil", "two\nlines")


def test_classifier_order(spark):
    cases = [("1. Room", "stat block", "LOCATION"), ("x", "AC 1 HD 2 hp 3 #AT 1", "STAT_BLOCK"), ("x", "| die roll | monster |", "WANDERING_MONSTER_TABLE"), ("x", "a gate", "ALTERNATE_WORLD"), ("Preface", "", "OVERVIEW"), ("x", "the hook", "HOOK"), ("x", "für trapé", "TRAP"), ("x", "contains 5 gp", "TREASURE"), ("x", "secret", "NPC"), ("x", "surprise", "ENCOUNTER"), ("Part 2", "", "STORY_ARC"), (None, None, "UNKNOWN")]
    got = spark.createDataFrame(cases, "h string, b string, w string").select(rules.component_type(F.col("h"), F.col("b")).alias("g"), "w").collect()
    assert [r.g for r in got] == [r.w for r in got]


def test_rulesets_and_titles(spark):
    cases = {"ADVANCED DUNGEONS & DRAGONS 2nd Edition": "adnd2e", "Wizards of the Coast, 5e": "dnd5e", "Wizards of the Coast copyright 2024": "dnd55", "Dungeons & Dragons Basic Set and Expert Set": "dnd_bx", "dungeons and dragons TSR": "dnd_basic", "Wizards of the Coast": "dnd3e", "poem": "unknown"}
    for text, want in cases.items():
        r = one(spark, text, rules.ruleset)
        assert r.id == want and (r.name, r.publisher) == rules.RULESETS[want]
    for title, want in {"Wandering Monsters": "WANDERING_MONSTER_TABLE", "Legends": "RUMOR_TABLE", " ": "UNKNOWN_TABLE", "XP per level": "EXPERIENCE_TABLE", "Other": "GENERIC_TABLE"}.items():
        assert one(spark, title, rules.table_type) == want


def test_front_matter_round_trip(spark):
    df = spark.createDataFrame([('a: "b"', "dnd5e", "D&D", "W")], "s string, id string, name string, publisher string")
    r = F.struct("id", "name", "publisher")
    md = df.select(sections.with_front_matter(F.col("s"), r, F.lit("# A\nbody")).alias("m"))
    parsed, body = sections.front_matter(F.col("m"))
    row = md.select("m", parsed.alias("r"), body.alias("b")).head()
    assert row.m.startswith('---\nsource: "a: \\"b\\""\nruleset: dnd5e\n') and tuple(row.r) == ("dnd5e", "D&D", "W") and row.b.strip() == "# A\nbody"
    assert tuple(one(spark, "none", lambda c: sections.front_matter(c)[0])) == ("unknown", "Unknown", "Unknown")


def test_json_document(spark):
    docs = spark.createDataFrame([("m.md", MD)], "source string, markdown string")
    doc = json.loads(json_documents(components(docs)).head().json)
    assert doc["metadata"] == {"source": "m.md", "ruleset": "unknown", "ruleset_name": "Unknown", "publisher": "Unknown"}
    assert [c["component_type"] for c in doc["components"]] == ["UNKNOWN", "LOCATION", "OVERVIEW", "STAT_BLOCK"] and "fields" not in doc["components"][0]
    assert doc["components"][1]["fields"]["monsters"] == ["3 trolls"]
