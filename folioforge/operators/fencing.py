"""Stat blocks put into fences: each format marks the lines or paragraphs it owns, the rest stays.

A text is scanned once for each format in a fixed order, what is fenced is no longer looked at.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from folioforge.functions.text import by_few

from .statblocks import ABILITY, COMPACT_LINE, LABEL_LINE, THAC0, UNIT_LINE

# Marks of inline blocks.
ALIGNMENT = re.compile(r"(?i)\.\s+AL\s+(LE|LG|LN|NE|NG|N|CE|CG|CN|TN)\b")
INLINE_LABELS = [re.compile("(?i)[;:]\\s*" + p) for p in (r"MV\s+", r"hp\s+", r"AC\s+\d", r"HD\s+", r"#AT\s+", r"Dmg\s+", r"THAC0\s+")]
CAPSULE = re.compile(r"(?i)^NPC\s+Capsule\s*$")
LABEL, UNIT, COMPACT = re.compile(LABEL_LINE), re.compile(UNIT_LINE, re.A), re.compile(COMPACT_LINE, re.A)
NARRATED = re.compile(THAC0, re.A), re.compile(ABILITY, re.A)
BRACKETED = re.compile(r"(?is)\bAC\s+\d+\b.*\bhp\s+\d+\b.*(?:#AT|\b(?:ML|MV|D\s+\d+-\d+)\b)")
ARMOUR = re.compile(r"(?i)\bAC\b")
SENTENCE_START = re.compile(r"[.!?]\s+(?=[A-Z])")
Span = tuple[int, int]


def fenced(rows: list[str]) -> list[bool]:
    inside, out = False, []
    for x in rows:
        mark = x.strip().startswith("```")
        out.append(inside or mark)
        inside ^= mark
    return out


def spans_of(flags: Iterable[bool]) -> list[Span]:
    out, start = [], None
    flags = [*flags, False]
    for i, f in enumerate(flags):
        if f and start is None:
            start = i
        elif not f and start is not None:
            out.append((start, i))
            start = None
    return out


def put_fences(rows: list[str], blocks: list[tuple[int | None, Span]]) -> list[str]:
    """Rows with each block (a name's row, and a span) as a fence; a row belongs to the first block that takes it."""
    starts: dict[int, list[int]] = {}
    taken: set[int] = set()
    for name, (a, b) in blocks:
        own = [*([] if name is None else [name]), *range(a, b)]
        if own[0] not in starts:
            starts[own[0]] = own
            taken |= set(own)
    out: list[str] = []
    for i, x in enumerate(rows):
        if i in starts:
            out += ["", "```stat", *(rows[k].strip() for k in starts[i]), "```", ""]
        elif i not in taken:
            out.append(x)
    return out


def name_above(rows: list[str], closed: list[bool], at: int, reach: int, stop: Callable[[str], bool], skip: Callable[[str], bool]) -> int | None:
    for k in range(at - 1, max(-1, at - 1 - reach), -1):
        t = rows[k].strip()
        if stop(t):
            return None
        if not closed[k] and not skip(t):
            return k
    return None


def capsules(rows: list[str]) -> list[str]:
    closed = fenced(rows)
    blocks, i = [], 0
    while i < len(rows):
        if not closed[i] and CAPSULE.match(rows[i].strip()):
            j = i + 1
            while j < len(rows) and (t := rows[j].strip()) and not t.startswith("##") and t != "---":
                j += 1
            blocks.append((None, (i, j)))
            i = j
        else:
            i += 1
    return put_fences(rows, blocks)


def labelled_blocks(rows: list[str]) -> list[str]:
    closed = fenced(rows)
    is_label = [not c and bool(LABEL.search(x.strip())) for c, x in zip(closed, rows)]
    stop = lambda t: not t or t == "---" or t.startswith(("```", "##"))
    runs = [s for s in spans_of(is_label) if s[1] - s[0] >= 3]
    return put_fences(rows, [(name_above(rows, closed, a, 4, stop, lambda t: bool(LABEL.search(t))), (a, b)) for a, b in runs])


def compact_cards(rows: list[str]) -> list[str]:
    closed = fenced(rows)
    open_rows = [not c and bool(x.strip()) for c, x in zip(closed, rows)]
    blocks = []
    for i, x in enumerate(rows):
        if open_rows[i] and COMPACT.search(x.strip()):
            end = next(b for a, b in spans_of(open_rows) if a <= i < b)
            blocks.append((name_above(rows, closed, i, 3, lambda t: not t, lambda t: t.startswith("##")), (i, end)))
    return put_fences(rows, blocks)


def army_lists(rows: list[str]) -> list[str]:
    closed = fenced(rows)
    runs = spans_of(not c and bool(UNIT.search(x.strip())) for c, x in zip(closed, rows))
    return put_fences(rows, [(None, s) for s in runs if s[1] - s[0] >= 2])


def part_quotes(rows: list[str]) -> list[str]:
    """A blank line where quoted and plain lines meet."""
    out: list[str] = []
    before: bool | None = None
    for c, x in zip(fenced(rows), rows):
        t = x.strip()
        now = None if c or not t or t == "---" else t.startswith(">")
        if before is not None and now is not None and before != now:
            out.append("")
        out.append(x)
        before = now
    return out


def paragraphs(text: str, detect: Callable[[str], str | None]) -> str:
    """Paragraphs that a detector takes become fences; quoted ones are tested without their signs."""
    parts = re.split(r"\n{2,}", text.replace("\r\n", "\n").replace("\r", "\n"))
    while len(parts) > 1 and not parts[-1]:
        parts.pop()
    for k, part in enumerate(parts):
        t = part.strip()
        if t and not t.startswith("```") and t != "---" and "```stat" not in part:
            plain = re.sub(r"(?m)^> ?", "", t) if t.startswith(">") else t
            if (found := detect(plain)) is not None:
                parts[k] = f"```stat\n{found}\n```"
    return "\n\n".join(parts)


def narrated(text: str) -> str | None:
    thac0, ability = NARRATED
    return text if thac0.search(text) and len(ability.findall(text)) >= 2 else None


def inline(text: str) -> str | None:
    one = " ".join(filter(None, map(str.strip, text.split("\n"))))
    return one if ALIGNMENT.search(one) or sum(bool(p.search(one)) for p in INLINE_LABELS) >= 3 else None


def closes(text: str) -> bool:
    """Whether the first bracket has been closed."""
    depth = 0
    for ch in text:
        depth += (ch == "(") - (ch == ")")
        if ch == ")" and depth <= 0:
            return True
    return depth <= 0


def split_prose(line: str) -> tuple[str, str]:
    """What stands before an entry, and the entry: a short name and its bracket."""
    before = line[: line.index("(")].strip()
    if before and (not re.search("[a-zA-Z0-9]", before) or re.fullmatch(r"(?s).*[a-zA-Z]\.", before)):
        return before, line[line.index("(") :]
    starts = [m.end() for m in SENTENCE_START.finditer(before)]
    if starts:
        at = line.find(before[starts[-1] :])
        return line[:at].strip(), line[at:]
    return "", line


def has_short_name(line: str) -> bool:
    name = line[: line.index("(")].strip()
    name = re.sub(r"^\*+", "", name.rpartition(": ")[2].strip()).strip()
    return len(name.split()) <= 3


def bracketed_blocks(rows: list[str]) -> list[str]:
    """Entries ``Name (AC 5; hp 9; ... MV 9)``, also over several lines; neighbours share a fence, prose around them stays."""
    closed = fenced(rows)
    entries: list[dict] = []
    i = 0
    while i < len(rows):
        t = rows[i].strip()
        if closed[i] or "(" not in t or not (t.startswith("(") or ARMOUR.search(t)):
            i += 1
            continue
        prose, entry = split_prose(t)
        if not has_short_name(entry):
            i += 1
            continue
        own, j, blank = [entry], i + 1, False
        while not closes(" ".join(own)) and j < len(rows) and not closed[j]:
            nxt = rows[j].strip()
            if not nxt and blank:
                break
            blank = not nxt
            own += [nxt] if nxt else []
            j += 1
        if not BRACKETED.search(" ".join(own)):
            i += 1
            continue
        cut = own[-1].rfind(")") + 1
        tail = own[-1][cut:].strip() if cut else ""
        own[-1] = own[-1][:cut] if cut else own[-1]
        entries.append({"from": i, "to": j, "prose": prose, "rows": own, "tail": tail})
        i = j
    groups: list[list[dict]] = []
    for e in entries:
        last = groups[-1][-1] if groups else None
        if last and not last["tail"] and not e["prose"] and all(x.strip() for x in rows[last["to"] : e["from"]]) and e["from"] == last["to"]:
            groups[-1].append(e)
        else:
            groups.append([e])
    out, at = [], 0
    for g in groups:
        out += rows[at : g[0]["from"]] + ([g[0]["prose"]] if g[0]["prose"] else [])
        out += ["", "```stat", *(x for e in g for x in e["rows"]), "```", ""] + ([g[-1]["tail"]] if g[-1]["tail"] else [])
        at = g[-1]["to"]
    return out + rows[at:]


def mark(text: str) -> str:
    """The text with every stat block in a fence."""
    on_rows = lambda f, t: "\n".join(f(t.split("\n")))
    text = on_rows(labelled_blocks, on_rows(capsules, text))
    text = on_rows(compact_cards, paragraphs(text, narrated))
    text = on_rows(army_lists, paragraphs(on_rows(part_quotes, text), inline))
    return on_rows(bracketed_blocks, text)


def with_fences(c: Column) -> Column:
    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return by_few(mark, texts)

    return run(c.cast("string"))
