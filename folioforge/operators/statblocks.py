"""Embedded stat blocks: format dispatch and typed fields, one struct of nullable members."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioforge.functions.text import ascii_words, group, lines, matches, once, trim_controls, unless_empty

# Labels of a labelled block and the fields they fill; patterns of the other formats.
LABELS = {
    "frequency": r"FREQUENCY", "appearing": r"#\s*APPEARING", "ac": r"ARMOR\s+CLASS", "move": r"MOVE", "hd": r"HIT\s+DICE", "in_lair": r"%\s*IN\s+LAIR",
    "treasure_type": r"TREASURE\s+TYPE", "attacks": r"#\s*ATTACKS?", "damage": r"DAMAGE", "special_attacks": r"SPECIAL\s+ATTACKS?", "special_defenses": r"SPECIAL\s+DEFENSES?",
    "magic_resistance": r"MAGIC\s+RESISTANCE", "intelligence": r"INTELLIGENCE", "alignment": r"ALIGNMENT", "size": r"SIZE", "psionic_ability": r"PSIONIC\s+ABILITY", "xp": r"XP\s+VALUE",
}
LABEL_LINE = "(?i)^(?:" + "|".join(LABELS.values()) + r")[:\s]"
ABILITY = r"(?i)\b(?:Strength|Intelligence|Wisdom|Dexterity|Constitution|Charisma)\s+\d"
THAC0 = r"(?i)\bTHAC0\s+\d"
COMPACT_LINE = r"(?i)\bSTR\s+\d+\b.*\b(?:WIS|DEX)\s+\d+\b.*\b(?:CON|CHR|INT)\s+\d+\b"
UNIT_LINE = r"(?i)^\d+\s+[A-Z][a-z]+.*\([A-Za-z/]+\)\s+\d+\s+hp\b"
UNIT = r"(?i)^(\d+)\s+(.+?)\s+\(([A-Za-z/]+)\)\s+(\d+)\s+hp"
HEADER = r"^(\d+\s+)?([A-Z][^\.(\[]+?)(?:\s*\(([^)]+)\))?(?:\s*\[([^\]]+)\])?[.:]"
INLINE = {"al": r"AL\s+([A-Za-z]+)", "mv": r"MV\s+([^;,\n\r]+)", "hp": r"hp\s+([\d,x\s]+)", "ac": r"AC\s+(\d+)", "hd": r"HD\s+([\d+/]+)", "at": r"#AT\s+([^;]+)", "dmg": r"Dmg\s+([^;]+)", "thac0": r"THAC0\s+(\d+)"}
CHARACTER = {
    "str": r"Strength[:\s]+(\S+)", "dex": r"Dexterity[:\s]+(\S+)", "con": r"Constitution[:\s]+(\S+)", "int": r"Intelligence[:\s]+(\S+)", "wis": r"Wisdom[:\s]+(\S+)", "cha": r"Charisma[:\s]+(\S+)",
    "thac0": r"THAC0[:\s]+(\d+)", "hp": r"Hit\s+Points?[:\s]+(\d+)", "ac": r"Armor\s+Class[:\s]+(\S+)", "mv": r"Movement[:\s]+(\S+)",
}
CLASS_LEVEL = r"(?i)(\d+(?:st|nd|rd|th)[- ]level[^\n]*)"
COMPACT_TAIL = {"hp", "at", "dmg"}

FIELDS = [
    "format", "name", "title", "type", "descriptor", "class_level", "al", "mv", "hp", "ac", "hd", "at", "dmg", "thac0", "notes", "str", "dex", "con", "int", "wis", "cha", "equipment", "raw",
    *(k for k in LABELS if k not in ("ac", "hd")),
]
SCHEMA = "struct<format:string,count:int," + ",".join(f"{f}:string" for f in FIELDS[1:]) + ",units:array<struct<count:int,name:string,category:string,hp:int>>>"


def squeezed(c: Column) -> Column:
    """Single spaces; blank and ``nil`` are absent."""
    return F.get(F.filter(F.array(F.regexp_replace(trim_controls(c), r"\s+", " ")), lambda x: (x != "") & (F.lower(x) != "nil")), F.lit(0))


def present(c: Column) -> Column:
    return unless_empty(trim_controls(c))


def filled(block: Column) -> Column:
    return F.filter(F.transform(lines(block), trim_controls), lambda x: x != "")


def _struct(values: dict[str, Column]) -> Column:
    nothing = F.lit(None).cast("string")
    units = values.get("units", F.lit(None)).cast("array<struct<count:int,name:string,category:string,hp:int>>")
    return F.struct(values["format"].alias("format"), values.get("count", F.lit(None)).cast("int").alias("count"), *(values.get(f, nothing).alias(f) for f in FIELDS[1:]), units.alias("units"))


def inline_semicolon(block: Column, *, compat: bool = False) -> Column:
    """``10 Orcs (type) [rank]. AL CE; MV 9; ...; notes``. ``compat`` keeps a last field as notes as well."""
    head = trim_controls(block)
    out = {"format": F.lit("inline_semicolon")}
    out["count"] = F.try_to_number(trim_controls(group(head, HEADER, 1)), F.lit("9999999999")).cast("int")
    out |= {k: present(group(head, HEADER, n)) for k, n in (("name", 2), ("type", 3), ("descriptor", 4))}
    for k, p in INLINE.items():
        label, rest = p.split(r"\s+", 1)  # what stands before a label is looked at where the label is found
        out[k] = (squeezed if k in COMPACT_TAIL else present)(group(block, rf"(?i){label}(?<![^;:\s]{label})\s+{rest}"))
    last = trim_controls(F.substring_index(block, ";", -1))
    label = r"^[A-Z]+\s+.*$" if compat else r"^(?:[A-Z]+\s+.*|(?i:AL|MV|hp|AC|HD|#AT|Dmg|THAC0)\s.*)$"
    out["notes"] = F.when(block.contains(";") & (F.length(F.substring_index(block, ";", -1)) > 1) & (last != "") & ~last.rlike(label), last)
    return _struct(out)


def _first_like(rows: Column, pattern: str) -> Column:
    return F.get(F.filter(rows, lambda x: x.rlike(pattern)), F.lit(0))


def labelled(rows: Column) -> Column:
    """Lines of ``LABEL: value``; the name is the first other line."""
    name = F.get(F.filter(rows, lambda x: ~x.rlike(LABEL_LINE)), F.lit(0))
    out = {"format": F.lit("labeled_block"), "name": name}
    for k, p in LABELS.items():
        one = _first_like(rows, rf"(?i){p}[:\s]+\S")
        out[k] = present(group(one, rf"(?i){p}[:\s]+(\S+)")) if k == "ac" else squeezed(group(one, rf"(?i){p}[:\s]+(.+)"))
    return _struct(out)


def character(block: Column, rows: Column) -> Column:
    """A narrated character with abilities spelt out."""
    second = F.get(rows, F.lit(1))
    out = {"format": F.lit("narrative_character"), "name": F.get(rows, F.lit(0)), "title": F.when(~second.rlike(CLASS_LEVEL), second), "class_level": present(group(block, CLASS_LEVEL))}
    out |= {k: present(group(block, "(?i)" + p)) for k, p in CHARACTER.items()}
    gear = F.filter(rows, lambda x: x.contains(" ") & ~matches(x, r"\b(STR|DEX|CON|INT|WIS|CHA|THAC0|AC|MV)\b"))
    out["equipment"] = F.get(gear, F.size(gear) - 1)
    return _struct(out)


def compact_card(block: Column, rows: Column) -> Column:
    return _struct({"format": F.lit("compact_card"), "name": F.get(rows, F.lit(0)), "raw": trim_controls(block)})


def army_units(rows: Column) -> Column:
    part = lambda x, n: trim_controls(F.regexp_extract(x, UNIT, n))
    units = F.transform(F.filter(rows, lambda x: x.rlike(UNIT)), lambda x: F.struct(part(x, 1).cast("int").alias("count"), part(x, 2).alias("name"), part(x, 3).alias("category"), part(x, 4).cast("int").alias("hp")))
    return _struct({"format": F.lit("army_unit"), "units": once(units, lambda u: F.when(F.size(u) > 0, u))})


def parse_block(block: Column, *, compat: bool = False) -> Column:
    """One struct for a fence's content: labelled block, compact card, character, army units, else inline fields.

    Null for null and blank content.
    """

    def parsed(block: Column, rows: Column) -> Column:
        is_label = F.size(F.filter(rows, lambda x: x.rlike(LABEL_LINE))) >= 3
        is_army = (F.size(rows) >= 1) & (F.size(lines(trim_controls(block))) >= 2) & F.forall(rows, lambda x: x.rlike(ascii_words(UNIT_LINE)))
        out = F.when(is_label, labelled(rows)).when(matches(block, COMPACT_LINE), compact_card(block, rows)).when(matches(block, THAC0) & matches(block, ABILITY), character(block, rows))
        return F.when(F.size(rows) > 0, out.when(is_army, army_units(rows)).otherwise(inline_semicolon(block, compat=compat)))

    return once(block, lambda b: once(filled(b), lambda rows: parsed(b, rows)))
