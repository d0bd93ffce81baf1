"""Typed fields of locations, characters, encounters and stat-block sections."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioforge.functions.text import ascii_words, entirely_italic, group, lines, matches, once, trim_controls, unless_empty

from .sections import stat_fences, without_fences
from .statblocks import SCHEMA as STAT
from .statblocks import parse_block

# Creatures that a count may precede, treasure words, verbs of tactics and words of terrain.
MONSTERS = (
    "troll|gnoll|demon|devil|orc|goblin|kobold|hobgoblin|bugbear|ogre|giant|dragon|undead|zombie|skeleton|vampire|ghost|wraith|specter|wight|ghoul|lich|mummy|golem|elemental|djinn|efreeti|succubus|"
    "incubus|balor|pit fiend|illithid|mind flayer|beholder|aboleth|yuan-ti|drow|duergar|troglodyte|lizardman|sahuagin|merrow|harpy|medusa|basilisk|gorgon|manticore|owlbear|displacer beast|"
    "rust monster|gelatinous cube|mimic|minotaur|centaur|griffon|hippogriff|pegasus|unicorn|wyvern|hydra|chimera|sphinx"
)
MONSTER_COUNT = rf"(?i)\b(\d+)\s+({MONSTERS})s?\b"
TREASURE = r"(?i)[^.!?]*(?:\b(?:gp|pp|sp|ep|cp)\b|magic item|potion|scroll|sword|ring|staff|wand)[^.!?]*[.!?]"
TACTICS = r"(?i)\b(attack|flee|charge|retreat|melee)\b"
TERRAIN = r"(?i)\b(floor|ceiling|wall|door|room|corridor)\b"
ENEMY = r"(?i)\b(?:\d+|one|two|three|four|five|six|seven|eight|nine|ten|a\s)\s+[A-Za-z][a-z]+(?:\s+[a-z]+)?(?:\s*\([^)]*\))?"
PROPER_NOUN = r"(?<![.!?]\s)\b([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)\b"
STAT_SECTION = {
    "ac": r"(?i)AC (\S+)", "hd": r"(?i)HD ([\d+]+)", "hp": r"(?i)hp (\d+)", "movement": r'(?i)MV ([\d"]+)', "attacks": r"(?i)#AT (\d+)", "damage": r"(?i)D ([0-9\-/]+)", "magic_resistance": r"(?i)MR (\d+%)",
    "special_attacks": r"(?is)SPECIAL ATTACKS?:\s*(.+?)(?=\n[A-Z ]+:|$)", "special_defenses": r"(?is)SPECIAL DEFENSES?:\s*(.+?)(?=\n[A-Z ]+:|$)", "alignment": r"(?i)ALIGNMENT:\s*(\S.*?)(?=\n|$)",
}

STRINGS = "read_aloud dm_notes treasure_summary name stat_line description treasure raw_stat_block".split()
LISTS = "monsters spells enemies tactics terrain_notes".split()
SCHEMA = f"struct<{','.join(f'{f}:string' for f in STRINGS)},{','.join(f'{f}:array<string>' for f in LISTS)},{','.join(f'{f}:string' for f in STAT_SECTION)},stat_blocks:array<{STAT}>>"


def _fields(**values: Column) -> Column:
    """The union of all types' fields; empty lists and strings are absent."""
    text = {f: unless_empty(values[f]) if f in values else F.lit(None).cast("string") for f in [*STRINGS, *STAT_SECTION]}
    many = {f: once(values[f], lambda v: F.when(F.size(v) > 0, v)) if f in values else F.lit(None).cast(f"array<{STAT}>" if f == "stat_blocks" else "array<string>") for f in [*LISTS, "stat_blocks"]}
    return F.struct(*(text[f].alias(f) for f in STRINGS), *(many[f].alias(f) for f in LISTS), *(text[f].alias(f) for f in STAT_SECTION), many["stat_blocks"].alias("stat_blocks"))


def all_matches(c: Column, pattern: str, n: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(ascii_words(pattern)), F.lit(n))


def treasure_sentences(text: Column) -> Column:
    return F.transform(all_matches(text, TREASURE), trim_controls)


def monsters(text: Column) -> Column:
    """``3 trolls``: the count, the creature as written, and an ``s`` unless the count is 1."""
    pairs = F.arrays_zip(all_matches(text, MONSTER_COUNT, 1).alias("n"), all_matches(text, MONSTER_COUNT, 2).alias("m"))
    return F.transform(pairs, lambda p: F.concat(p["n"], F.lit(" "), p["m"], F.when(p["n"] == "1", "").otherwise("s")))


def blocks(body: Column) -> Column:
    return F.transform(stat_fences(body), lambda x: parse_block(x))


def location(body: Column) -> Column:
    text = without_fences(body)
    quoted = F.array_join(F.transform(all_matches(text, r"(?m)^>\s?(.*)$", 1), lambda x: F.concat(x, F.lit("\n"))), "")
    spoken = trim_controls(F.regexp_extract(text, r"(?is)read aloud:\s*(.+?)(?=\n\n|$)", 1))
    empty = F.struct(F.when(quoted != "", quoted).otherwise(spoken).alias("aloud"), F.lit("").alias("notes"), F.lit(False).alias("skip"))

    def step(acc: Column, line: Column) -> Column:
        t = trim_controls(line)
        starts = F.lower(t).startswith("read aloud:")
        inside = acc["skip"] & (t != "")
        new = inside & ~F.contains(acc["aloud"], t)
        italic = ~acc["skip"] & entirely_italic(t)
        quote = t.startswith(">")
        aloud = F.when(quote | starts, acc["aloud"]).when(new, F.concat(acc["aloud"], t, F.lit("\n"))).when(italic, F.concat(acc["aloud"], F.regexp_replace(t, "[*_]", ""), F.lit("\n"))).otherwise(acc["aloud"])
        notes = F.when(quote | starts | acc["skip"] | italic, acc["notes"]).otherwise(F.concat(acc["notes"], line, F.lit("\n")))
        skip = F.when(quote, acc["skip"]).when(starts, F.lit(True)).otherwise(acc["skip"] & (t != ""))
        return F.struct(aloud.alias("aloud"), notes.alias("notes"), skip.alias("skip"))

    told = F.aggregate(lines(text), empty, step)
    found = blocks(body)
    return _fields(
        read_aloud=trim_controls(told["aloud"]), dm_notes=trim_controls(told["notes"]), monsters=F.when(F.size(found) == 0, monsters(text)), treasure_summary=F.array_join(treasure_sentences(text), " "), stat_blocks=found
    )


def npc(body: Column) -> Column:
    text = without_fences(body)
    rows = lines(text)
    stat_at = F.array_position(F.transform(rows, lambda x: matches(x, r"(?i)AC \d")), True)
    left = F.filter(rows, lambda x, i: i + 1 != stat_at)
    first = trim_controls(F.get(F.filter(left, lambda x: trim_controls(x) != ""), F.lit(0)))
    label = F.regexp_extract(text, r"(?i)spells:\s*(.+?)(?=\n|$)", 1)
    spells = F.transform(F.split(trim_controls(F.regexp_replace(label, r"\(\d+\w*\)", "")), r"[,;/]\s*"), trim_controls)
    description = F.array_join(F.transform(left, lambda x: F.when(trim_controls(x) == "", "").otherwise(x)), "\n")
    return _fields(
        name=F.coalesce(group(first, PROPER_NOUN), first), stat_line=F.when(stat_at > 0, trim_controls(F.get(rows, (stat_at - 1).cast("int")))),
        spells=F.filter(spells, lambda x: x != ""), description=trim_controls(description), stat_blocks=blocks(body),
    )


def encounter(body: Column) -> Column:
    text = without_fences(body)
    parts = F.split(text, r"(?<=[.!?])\s+")
    about = lambda words: F.filter(F.transform(F.filter(parts, lambda x: matches(x, words)), trim_controls), lambda x: x != "")
    return _fields(
        enemies=F.array_distinct(F.transform(all_matches(text, ENEMY), trim_controls)), tactics=about(TACTICS), terrain_notes=about(TERRAIN),
        treasure=F.array_join(treasure_sentences(text), " "), stat_blocks=blocks(body),
    )


def stat_section(body: Column) -> Column:
    name = F.get(F.filter(F.transform(lines(body), trim_controls), lambda x: x != ""), F.lit(0))
    return _fields(name=name, raw_stat_block=body, **{k: trim_controls(group(body, p)) for k, p in STAT_SECTION.items()})


EXTRACTORS = {"LOCATION": location, "NPC": npc, "ENCOUNTER": encounter, "STAT_BLOCK": stat_section}


def fields(kind: Column, body: Column, extractors=EXTRACTORS) -> Column:
    """The fields of a section of the given type, null for types without an extractor."""
    out = None
    for name, f in extractors.items():
        out = F.when(kind == name, f(body)) if out is None else out.when(kind == name, f(body))
    return out
