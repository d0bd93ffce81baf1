"""Ordered rules as data: component types, rulesets and table types, for Spark and for SQL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioforge.functions.text import matches

#: A condition is (field, test, value), or ("all"|"any", [conditions]); tests: has, like, is, from.
Condition = tuple
Rule = tuple[str, Condition]


def has(field: str, text: str) -> Condition:
    return (field, "has", text)


def like(field: str, pattern: str) -> Condition:
    return (field, "like", pattern)


def all_of(*c: Condition) -> Condition:
    return ("all", list(c))


def any_of(*c: Condition) -> Condition:
    return ("any", list(c))


def column(cond: Condition, fields: Mapping[str, Column]) -> Column:
    if cond[0] in ("all", "any"):
        parts = [column(c, fields) for c in cond[1]]
        out = parts[0]
        for p in parts[1:]:
            out = out & p if cond[0] == "all" else out | p
        return out
    field, test, value = cond
    c = fields[field]
    return {"has": lambda: F.contains(c, F.lit(value)), "like": lambda: matches(c, value), "from": lambda: c >= value}[test]()


def sql(cond: Condition) -> str:
    if cond[0] in ("all", "any"):
        return "(" + f" {'AND' if cond[0] == 'all' else 'OR'} ".join(sql(c) for c in cond[1]) + ")"
    field, test, value = cond
    quoted = str(value).replace("'", "''")
    return {"has": f"contains({field}, '{quoted}')", "like": f"regexp_matches({field}, '{quoted}')", "from": f"{field} >= {value}"}[test]


def first(rules: Sequence[Rule], fields: Mapping[str, Column], default: str) -> Column:
    """The name of the first rule that holds; later conditions are not evaluated."""
    out = None
    for name, cond in rules:
        hit = F.coalesce(column(cond, fields), F.lit(False))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(default)


def first_sql(rules: Sequence[Rule], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {sql(c)} THEN '{n}'" for n, c in rules) + f" ELSE '{default}' END"


# Component types and the key words of their rules, in order of priority.
COMPONENT_RULES: list[Rule] = [
    ("LOCATION", like("heading", r"(?i)^\d+[A-Z]?\.\s+")),
    ("STAT_BLOCK", any_of(like("heading", "(?i)stat block"), like("body", "(?i)stat block"))),
    ("STAT_BLOCK", all_of(like("body", r"(?i)AC \d"), like("body", r"(?i)HD \d"), like("body", r"(?i)hp \d"), like("body", "(?i)#AT"))),
    ("WANDERING_MONSTER_TABLE", any_of(like("heading", "(?i)wandering monster"), like("body", "(?i)wandering monster"))),
    ("WANDERING_MONSTER_TABLE", all_of(has("body", "|"), like("body", "(?i)die roll"), like("body", r"(?i)\bmonster\b"))),
    ("RULES_VARIANT", any_of(like("heading", "(?i)spell alteration|magic item alteration"), like("body", "(?i)spell alteration|magic item alteration"))),
    ("ALTERNATE_WORLD", like("body", r"(?i)\bgate\b|\bdoorway\b|prime material plane|alternate world")),
    ("OVERVIEW", like("heading", "(?i)background|synopsis|overview|preface|introduction")),
    ("HOOK", any_of(like("heading", r"(?i)adventure hook|\bhook\b"), like("body", r"(?i)adventure hook|\bhook\b"))),
    ("TRAP", like("body", r"(?i)\btrap\b|\btrigger\b|glyph of warding|disable device")),
    ("PUZZLE", like("body", r"(?i)\bpuzzle\b|\briddle\b")),
    ("TREASURE", all_of(like("body", r"(?i)\btreasure\b|\bcontains\b"), like("body", r"(?i)\b(?:gp|pp|sp|ep|cp)\b"))),
    ("NPC", like("body", r"(?i)\b(?:personality|motivation|secret)\b")),
    ("ENCOUNTER", like("body", r"(?i)\b(?:encounter|initiative|surprise)\b")),
    ("STORY_ARC", like("heading", r"(?i)\b(?:act|chapter|part)\b")),
]
COMPONENT_TYPES = [*dict.fromkeys(n for n, _ in COMPONENT_RULES), "READ_ALOUD", "UNKNOWN"]

# Ruleset ids, names, publishers, and the marks of each in front text, in order of priority.
_ADND, _WOTC = has("text", "advanced dungeons & dragons"), has("text", "wizards of the coast")
_DND = any_of(has("text", "dungeons & dragons"), has("text", "dungeons and dragons"))
_SECOND = any_of(has("text", "2nd edition"), has("text", "second edition"))
RULESET_RULES: list[Rule] = [
    ("adnd2e_revised", all_of(_ADND, _SECOND, any_of(has("text", "revised"), has("text", "player's option")))),
    ("adnd2e", all_of(_ADND, _SECOND)),
    ("adnd1e", _ADND),
    ("dnd4e_essentials", all_of(_WOTC, any_of(has("text", "essentials"), has("text", "heroes of the")))),
    ("dnd4e", all_of(_WOTC, any_of(has("text", "4th edition"), like("text", r"\b4e\b")))),
    ("dnd55", all_of(_WOTC, any_of(has("text", "v5.5"), has("text", "one d&d"), ("year", "from", 2024)))),
    ("dnd5e", all_of(_WOTC, any_of(has("text", "5th edition"), has("text", "d&d beyond"), like("text", r"\b5e\b")))),
    ("dnd35", all_of(_WOTC, any_of(has("text", "3.5"), has("text", "revised edition")))),
    ("dnd3e", _WOTC),
    ("dnd_rc", all_of(_DND, has("text", "rules cyclopedia"))),
    ("dnd_becmi", all_of(_DND, any_of(has("text", "companion set"), has("text", "masters set"), has("text", "immortals set")))),
    ("dnd_bx", all_of(_DND, has("text", "expert set"))),
    ("dnd_basic", all_of(_DND, has("text", "basic set"))),
    ("dnd_og", all_of(_DND, has("text", "tactical studies rules"))),
    ("dnd_basic_default", all_of(_DND, has("text", "tsr"))),
    ("daggerheart", all_of(has("text", "daggerheart"), has("text", "darrington press"))),
]
RULESETS = {
    "adnd2e_revised": ("AD&D 2nd Edition Revised", "TSR, Inc."),
    "adnd2e": ("AD&D 2nd Edition", "TSR, Inc."),
    "adnd1e": ("AD&D 1st Edition", "TSR, Inc."),
    "dnd4e_essentials": ("DnD Essentials", "Wizards of the Coast"),
    "dnd4e": ("DnD 4th Edition", "Wizards of the Coast"),
    "dnd55": ("DnD v5.5", "Wizards of the Coast"),
    "dnd5e": ("DnD 5th Edition", "Wizards of the Coast"),
    "dnd35": ("DnD v3.5", "Wizards of the Coast"),
    "dnd3e": ("DnD 3rd Edition", "Wizards of the Coast"),
    "dnd_rc": ("DnD Rules Cyclopedia", "TSR, Inc."),
    "dnd_becmi": ("DnD BECMI", "TSR, Inc."),
    "dnd_bx": ("DnD B/X", "TSR, Inc."),
    "dnd_basic": ("DnD Basic", "TSR"),
    "dnd_og": ("DnD Original", "TSR"),
    "daggerheart": ("Daggerheart", "Darrington Press"),
    "unknown": ("Unknown", "Unknown"),
}

# Table types and the key words of their titles, in order of priority.
TABLE_RULES: list[Rule] = [
    ("WANDERING_MONSTER_TABLE", any_of(has("title", "wandering"), all_of(has("title", "random"), has("title", "encounter")))),
    ("ENCOUNTER_TABLE", all_of(has("title", "encounter"), has("title", "table"))),
    ("RUMOR_TABLE", any_of(*(has("title", w) for w in ("rumor", "rumour", "legend", "lore")))),
    ("SAVING_THROW_TABLE", any_of(has("title", "saving throw"), all_of(has("title", "save"), has("title", "table")))),
    ("MAGIC_ITEM_TABLE", has("title", "magic item")),
    ("SPELL_TABLE", has("title", "spell")),
    ("WEAPON_TABLE", any_of(has("title", "weapon"), has("title", "damage"))),
    ("ARMOR_TABLE", any_of(has("title", "armor"), has("title", "armour"))),
    ("EQUIPMENT_TABLE", any_of(*(has("title", w) for w in ("equipment", "pack", "gear")))),
    ("TREASURE_TABLE", has("title", "treasure")),
    ("EXPERIENCE_TABLE", any_of(has("title", "experience"), has("title", " xp "), like("title", "^xp "))),
    ("ABILITY_SCORE_TABLE", any_of(*(has("title", w) for w in ("ability", "pregen", "pre-gen", "strength", "prerolled")))),
    ("HENCHMAN_TABLE", any_of(*(has("title", w) for w in ("henchm", "hireling", "retainer")))),
    ("NPC_TRAIT_TABLE", any_of(*(has("title", w) for w in ("personality", "morale", "loyalty")))),
    ("CHARACTER_CLASS_TABLE", has("title", "character class")),
]


def component_type(heading: Column, body: Column) -> Column:
    """The type of a section, null parts being empty."""
    return first(COMPONENT_RULES, {"heading": F.coalesce(heading, F.lit("")), "body": F.coalesce(body, F.lit(""))}, "UNKNOWN")


def copyright_year(text: Column) -> Column:
    """The first year after the word or the sign, 0 without one."""
    pattern = r"[©Cc]opyright\s+(\d{4})|©(\d{4})"
    hit = F.regexp_substr(text, F.lit(pattern))
    return F.coalesce(F.try_to_number(F.regexp_extract(hit, r"(\d{4})$", 1), F.lit("9999")).cast("int"), F.lit(0))


def ruleset_id(front: Column) -> Column:
    found = first(RULESET_RULES, {"text": F.lower(front), "year": copyright_year(front)}, "unknown")
    return F.when(front.isNull(), "unknown").when(found == "dnd_basic_default", "dnd_basic").otherwise(found)


def ruleset(front: Column) -> Column:
    """``STRUCT<id, name, publisher>`` of the text of the first pages."""
    code = ruleset_id(front)
    table = F.create_map(*(F.lit(x) for k, (n, p) in RULESETS.items() for x in (k, f"{n}\t{p}")))
    both = F.split(F.element_at(table, code), "\t")
    return F.struct(code.alias("id"), both[0].alias("name"), both[1].alias("publisher"))


def table_type(title: Column) -> Column:
    t = F.coalesce(title, F.lit(""))
    return F.when(t.rlike(r"^\s*$"), "UNKNOWN_TABLE").otherwise(first(TABLE_RULES, {"title": F.lower(t)}, "GENERIC_TABLE"))
