"""Repair of fragmented text: words cut by spaces, split by markers or broken across lines, by a ranked dictionary.

The steps depend on each other's output, so they are one Arrow function over whole documents.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.text import by_few

#: The longest word that is tried, and what a letter that no word covers costs.
LONGEST, LOOSE, SINGLE = 30, -20.0, 0.5
#: Dictionaries are broadcast up to this many words.
MAX_WORDS = 2_000_000
#: Tokens that are kept with their ranks.
PIECES = 100_000
RULE = ("#", ">", "```")


def structural(line: str) -> bool:
    return line.startswith(RULE) or line == "---"


class Cleaner:
    """Cleaning by one dictionary of lower-case words and ranks (1: commonest)."""

    def __init__(self, ranks: Mapping[str, int], width: int = 120):
        self.ranks, self.width, self.pieces = ranks, width, {}
        self.bonus = {w: len(w) ** 2 + math.log((len(ranks) + 1) / max(1, r)) for w, r in ranks.items() if 1 < len(w) <= LONGEST}

    def known(self, word: str) -> bool:
        return word.lower() in self.ranks

    # -- segmentation

    def segment(self, run: str) -> str:
        """The best cut of a run of letters: squared lengths plus the logarithm of inverse ranks."""
        low = run.lower()
        n = len(low)
        best, came = [0.0] + [-math.inf] * n, [0] * (n + 1)
        for end in range(1, n + 1):
            one = low[end - 1]
            best[end], came[end] = best[end - 1] + (SINGLE if one in self.ranks else LOOSE), end - 1
            for start in range(max(0, end - LONGEST), end - 1):
                gain = self.bonus.get(low[start:end])
                if gain is not None and best[start] + gain > best[end]:
                    best[end], came[end] = best[start] + gain, start
        cuts = [n]
        while cuts[-1]:
            cuts.append(came[cuts[-1]])
        cuts.reverse()
        return " ".join(run[a:b] for a, b in zip(cuts, cuts[1:]))

    def sentence(self, text: str) -> str:
        """Marks at the ends stay, commas between letters part clauses."""
        m = re.match(r"(?s)^([^\w]*|_*)(.*?)([\W_]*)$", text)
        head, core, tail = m.groups()
        return head + ", ".join(self.segment(p) if p else p for p in re.split(r"(?<=[^\W\d_]),(?=[^\W\d_])", core)) + tail

    def rebuild(self, text: str) -> str:
        joined = text.replace(" ", "")
        return " ".join(self.sentence(s) for s in re.split(r"(?<=[.!?])(?=[A-ZÀ-Þ])", joined))

    # -- tests

    @staticmethod
    def letters(token: str) -> str:
        return re.sub("[^a-zA-Z]", "", token)

    def fragmented(self, line: str) -> bool:
        t = line.strip()
        tokens = t.split()
        if len(tokens) < 5:
            return False
        sizes = [n for n in (len(x) if x.isascii() and x.isalpha() else len(self.letters(x)) for x in tokens) if n]
        return bool(t) and not structural(t) and len(tokens) >= 5 and len(sizes) >= 5 and sum(n <= 3 for n in sizes) >= 0.6 * len(sizes) and sum(sizes) < 3.5 * len(sizes)

    def broken(self, text: str) -> bool:
        return any(0 < len(a) <= 3 and not self.known(a) for a in map(self.letters, text.split()))

    # -- steps

    @staticmethod
    def merge_bold(text: str) -> str:
        """Interleaved markers joined, digits inside bold closed up, spaces outside bold but not inside its end."""
        while "** **" in text:
            text = text.replace("** **", " ")
        text = re.sub(r"\*\*([\d ]+)\*\*", lambda m: "**" + m[1].replace(" ", "") + "**", text)
        parts = text.split("**")
        out = parts[0]
        for k, part in enumerate(parts[1:]):
            opening = k % 2 == 0
            if opening and out and out[-1].isalnum():
                out += " "
            out += "**" + (" " if not opening and part[:1].isalnum() else "") + part
        out = re.sub(" {2,}", " ", out)
        return re.sub(r" +\*\*(?=[\s),.:;!?]|$)", "**", out)

    @staticmethod
    def join_hyphens(text: str) -> str:
        """A line that ends in a letter and a hyphen runs on into the next line that is not blank."""
        out: list[str] = []
        carry = ""
        blanks: list[str] = []
        for line in text.split("\n"):
            t = line.strip()
            if carry and not t:
                blanks.append(line)
                continue
            line = carry + t if carry else line
            carry, blanks = "", []
            if re.search(r"[^\W\d_]-$", line.strip()[-2:]):
                carry = line.strip()[:-1]
            else:
                out.append(line)
        if carry:
            out += [carry + "-", *blanks]
        return "\n".join(out)

    def rebuild_lines(self, text: str) -> str:
        return "\n".join(self.rebuild_line(x.strip()) if self.fragmented(x) else x for x in text.split("\n"))

    def rebuild_line(self, line: str) -> str:
        if "**" not in line:
            return self.rebuild(line)
        parts = (p.strip() for p in line.split("**"))
        return "**".join(self.rebuild(p) if p and (self.fragmented(p) or " " in p and self.broken(p)) else p for p in parts)

    def join_letters(self, text: str) -> str:
        """Digits that stand alone close up; letters that stand alone do if they make a word."""
        text = re.sub(r"(?<!\d)(?:\d )+\d(?!\d)", lambda m: m[0].replace(" ", ""), text)
        return re.sub(r"(?<![a-zA-Z])(?:[a-zA-Z] ){2,}[a-zA-Z](?![a-zA-Z])", lambda m: w if self.known(w := m[0].replace(" ", "")) else m[0], text)

    def join_pieces(self, line: str) -> str:
        """Neighbouring pieces joined until nothing changes: three that make a word, then two; of known words only by a far commoner one."""
        parts = re.split("( +)", line)
        lead = parts[0] == "" and len(parts) > 2
        tokens, gaps = parts[2 if lead else 0 :: 2], parts[3 if lead else 1 :: 2]
        front = parts[1] if lead else ""
        pieces = [self._piece(t) for t in tokens]
        i = 0
        while i < len(tokens) - 1:
            k = self._joinable(pieces, i)
            if k:
                tokens[i : i + k] = ["".join(tokens[i : i + k])]
                pieces[i : i + k] = [self._piece(tokens[i])]
                del gaps[i : i + k - 1]
                i = max(0, i - 2)  # what comes before does not reach the new piece
            else:
                i += 1
        return front + "".join(t + g for t, g in zip(tokens, [*gaps, ""]))

    def _piece(self, token: str) -> tuple[bool, str, int | None, str, int | None]:
        """Whether it is letters only, its lower case and rank; the letters it begins with if it has no others, and their rank."""
        got = self.pieces.get(token)
        if got is None:
            low, head = token.lower(), self.letters(token)
            start = head.lower() if token.startswith(head) else ""
            if len(self.pieces) >= PIECES:
                self.pieces.clear()
            got = self.pieces[token] = (token.isascii() and token.isalpha(), low, self.ranks.get(low), start, self.ranks.get(start))
        return got

    def _joinable(self, pieces: list[tuple], i: int) -> int:
        alpha, low, ra, _, _ = pieces[i]
        if not alpha:
            return 0
        alpha_b, low_b, rank_b, head, rb = pieces[i + 1]
        if alpha_b and i + 2 < len(pieces):
            alpha_c, low_c, rank_c, _, _ = pieces[i + 2]
            if alpha_c and low + low_b + low_c in self.ranks and (ra is None or rank_b is None or rank_c is None):
                return 3
        rank = self.ranks.get(low + head) if head else None
        if rank is None:
            return 0
        return 0 if ra is not None and rb is not None and (rank == 0 or max(ra, rb) < 2 * rank) else 2

    def join_all_pieces(self, text: str) -> str:
        return "\n".join(map(self.join_pieces, text.split("\n")))

    def join_bold(self, text: str) -> str:
        def one(m: re.Match) -> str:
            inner = m[1].strip()
            if " " not in inner or not self.broken(inner):
                return m[0]
            core = re.sub(r"[\W_]+$", "", inner)
            tail, joined = inner[len(core) :], core.replace(" ", "")
            if self.known(joined):
                return f"**{joined}{tail}**"
            new = self.rebuild(core)
            return m[0] if new == joined or re.search(r"\b[a-zA-Z]\b", new) else f"**{new}{tail}**"

        return re.sub(r"\*\*([^*]+)\*\*", one, text)

    @staticmethod
    def tighten(text: str) -> str:
        for pattern, new in ((r" ' s\b", "'s"), (r" ' t\b", "'t"), (r"([A-Za-z0-9_]) ' ([A-Za-z0-9_])", r"\1'\2"), (r"([a-zA-Z]) - ([a-zA-Z])", r"\1-\2")):
            text = re.sub(pattern, new, text, flags=re.A)
        return text

    @staticmethod
    def drop_blanks(text: str) -> str:
        rows = text.split("\n")
        t = [x.strip() for x in rows]
        last = len(t) - 1
        stays = lambda i: i in (0, last) or not t[i - 1] or not t[i + 1] or structural(t[i - 1]) or structural(t[i + 1]) or t[i - 1][-1] in ".!?"
        return "".join(x + "\n" for i, x in enumerate(rows) if t[i] or stays(i))

    def rewrap(self, text: str) -> str:
        out: list[str] = []
        par = ""
        for line in [*text.split("\n"), None]:
            t = line.strip() if line is not None else ""
            if line is None or not t or structural(t):
                if par:
                    out.append(self.wrap(par))
                par = ""
                if line is not None:
                    out.append(line)
            else:
                par = par[:-1] + t if re.search(r"[^\W\d_]-$", par[-2:]) else f"{par} {t}" if par else t
        return "".join(x + "\n" for x in out)

    def wrap(self, text: str) -> str:
        rows = [""]
        for w in text.split(" "):
            if not rows[-1]:
                rows[-1] = w
            elif len(rows[-1]) + 1 + len(w) <= self.width:
                rows[-1] += " " + w
            else:
                rows.append(w)
        return "\n".join(rows)

    def clean(self, text: str) -> str:
        steps: tuple[Callable[[str], str], ...] = (
            self.merge_bold, self.join_hyphens, self.rebuild_lines, self.join_letters, self.join_all_pieces, self.join_bold, self.tighten, self.drop_blanks, self.rewrap, self.join_all_pieces, self.merge_bold,
        )
        for step in steps:
            text = step(text)
        return text

    def clean_outside_fences(self, text: str) -> str:
        """Stat fences stay as they are."""
        return "".join(p if p.startswith("```stat") else self.clean(p) for p in re.split(r"(?s)(```stat\n.*?\n```)", text))


def cleaner_column(spark: SparkSession, words: DataFrame, *, width: int = 120, around_fences: bool = True, method: str | None = None) -> Callable[[Column], Column]:
    """A function ``Column -> Column`` that cleans texts by ``words`` (word, rank), whose size is checked before it is sent out."""
    rows = words.limit(MAX_WORDS + 1).collect()
    if len(rows) > MAX_WORDS:
        raise ValueError(f"a dictionary of more than {MAX_WORDS} words")
    sent = spark.sparkContext.broadcast({r.word: r.rank for r in rows})
    name = method or ("clean_outside_fences" if around_fences else "clean")

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return by_few(getattr(Cleaner(sent.value, width), name), texts)

    return lambda c: run(c.cast("string"))
