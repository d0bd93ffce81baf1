"""Characters and frames of text PDFs, by the standard library alone.

Unencrypted files with plain or Flate streams; fonts by their encodings or ToUnicode maps. Pages are not drawn:
the layout operators take page images.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


TOKEN = re.compile(rb"\s*(?:%[^\r\n]*[\r\n])*\s*(<<|>>|\[|\]|/[^\s<>\[\]()/%]*|\(|<[0-9A-Fa-f\s]*>|[-+]?\d*\.?\d+|[A-Za-z'\"*]+\d?)", re.S)
ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
GLYPHS = "doc long, page_no int, seq int, text string, x float, y float, height float, bold boolean, italic boolean, page_width float, page_height float"
BOXES = "doc long, page_no int, x float, y float, w float, h float"


class Name(str):
    pass


class Ref(tuple):
    pass


def literal(data: bytes, at: int) -> tuple[bytes, int]:
    """A string in brackets that begins behind ``at``."""
    out, depth = bytearray(), 1
    while at < len(data) and depth:
        c = data[at : at + 1]
        if c == b"\\":
            nxt = data[at + 1 : at + 2]
            digits = re.match(rb"[0-7]{1,3}", data[at + 1 : at + 4])
            if digits:
                out.append(int(digits[0], 8) & 255)
                at += 1 + len(digits[0])
            else:
                out += ESCAPES.get(nxt, b"" if nxt in b"\r\n" else nxt)
                at += 2
            continue
        depth += (c == b"(") - (c == b")")
        if depth:
            out += c
        at += 1
    return bytes(out), at


def tokens(data: bytes, at: int = 0) -> Iterator[tuple[object, int]]:
    """Values and operators of a stream or an object."""
    while m := TOKEN.match(data, at):
        t, at = m[1], m.end()
        if t == b"(":
            value, at = literal(data, at)
            yield value, at
        elif t[:1] == b"/":
            yield Name(re.sub(rb"#([0-9A-Fa-f]{2})", lambda h: bytes([int(h[1], 16)]), t[1:]).decode("latin-1")), at
        elif t[:1] == b"<" and t != b"<<":
            h = re.sub(rb"[\s<>]", b"", t)
            yield bytes.fromhex((h + b"0" * (len(h) % 2)).decode()), at
        elif re.fullmatch(rb"[-+]?\d+", t):
            yield int(t), at
        elif re.fullmatch(rb"[-+]?\d*\.\d+", t):
            yield float(t), at
        else:
            yield t.decode("latin-1"), at


def parse(data: bytes, at: int = 0) -> tuple[object, int]:
    """One value: dictionaries, arrays, references, names, numbers and strings."""
    stack: list[list] = [[]]
    kinds: list[str] = []
    for t, end in tokens(data, at):
        if isinstance(t, str) and not isinstance(t, Name):
            if t in ("<<", "["):
                kinds.append(t)
                stack.append([])
                continue
            if t in (">>", "]") and kinds:
                items = stack.pop()
                value = dict(zip(items[::2], items[1::2])) if kinds.pop() == "<<" else items
            elif t == "R" and len(stack[-1]) >= 2:
                gen, num = stack[-1].pop(), stack[-1].pop()
                value = Ref((num, gen))
            elif t in ("stream", "endobj"):
                break
            else:
                value = {"true": True, "false": False}.get(t)
        else:
            value = t
        stack[-1].append(value)
        if len(stack) == 1 and not (isinstance(value, int) and not isinstance(value, bool)):
            return stack[0][-1], end
    return (stack[0][0] if stack[0] else None), at


class Document:
    """Objects of a file, found by their headers, also inside object streams."""

    def __init__(self, data: bytes):
        if not data.lstrip()[:5].startswith(b"%PDF"):
            raise ValueError("not a PDF")
        self.data = data
        self.at = {int(m[1]): m.end() for m in re.finditer(rb"(?:^|[\s>])(\d+)\s+\d+\s+obj\b", data)}
        self.made: dict[int, object] = {}
        if b"/Encrypt" in data:
            raise ValueError("encrypted")
        for m in re.finditer(rb"/ObjStm", data):
            num = max((n for n, p in self.at.items() if p <= m.start()), key=lambda n: self.at[n])
            head = self.get(Ref((num, 0)))
            raw = self.stream(num)
            pairs = [int(x) for x in raw[: head["First"]].split()]
            for n, off in zip(pairs[::2], pairs[1::2]):
                self.made.setdefault(n, parse(raw, head["First"] + off)[0])

    def get(self, value: object) -> object:
        while isinstance(value, Ref):
            if value[0] not in self.made:
                self.made[value[0]] = parse(self.data, self.at[value[0]])[0] if value[0] in self.at else None
            value = self.made[value[0]]
        return value

    def stream(self, value: object) -> bytes:
        num = value[0] if isinstance(value, Ref) else value
        head = self.get(Ref((num, 0))) or {}
        m = re.compile(rb"stream\r?\n").search(self.data, self.at[num])
        size = self.get(head.get("Length"))
        raw = self.data[m.end() : m.end() + size] if isinstance(size, int) else self.data[m.end() : self.data.index(b"endstream", m.end())]
        filters = self.get(head.get("Filter")) or []
        for f in filters if isinstance(filters, list) else [filters]:
            if self.get(f) != "FlateDecode":
                raise ValueError(f"filter {f}")
            raw = zlib.decompressobj().decompress(raw)
        return raw

    def pages(self) -> Iterator[dict]:
        root = next((v for n in self.at if isinstance(v := self.get(Ref((n, 0))), dict) and v.get("Type") == "Catalog"), None) or next((v for v in self.made.values() if isinstance(v, dict) and v.get("Type") == "Catalog"), {})

        def walk(node: dict, own: dict) -> Iterator[dict]:
            own = own | {k: node[k] for k in ("Resources", "MediaBox", "CropBox") if k in node}
            if "Kids" in node:
                for kid in self.get(node["Kids"]):
                    yield from walk(self.get(kid), own)
            else:
                yield own | node

        yield from walk(self.get(root["Pages"]), {}) if "Pages" in root else ()


class Font:
    def __init__(self, doc: Document, spec: dict):
        name = str(doc.get(spec.get("BaseFont")) or "")
        self.bold = bool(re.search("(?i)bold|black|heavy|demi", name))
        down = doc.get((doc.get(spec.get("DescendantFonts")) or [None])[0]) or spec
        note = doc.get(down.get("FontDescriptor")) or {}
        angle = doc.get(note.get("ItalicAngle")) or 0
        self.italic = bool(re.search("(?i)italic|oblique", name)) or bool((doc.get(note.get("Flags")) or 0) & 64) or angle < -5
        self.wide = spec.get("Subtype") == "Type0"
        self.first, self.widths = doc.get(spec.get("FirstChar")) or 0, [doc.get(w) for w in doc.get(spec.get("Widths")) or []]
        self.map: dict[int, str] = {}
        if "ToUnicode" in spec:
            self.read_map(doc.stream(spec["ToUnicode"]))

    def read_map(self, data: bytes) -> None:
        hexes = rb"<([0-9A-Fa-f\s]+)>"
        text = lambda h: bytes.fromhex(h.decode().replace(" ", "")).decode("utf-16-be", "replace")
        for part in re.findall(rb"beginbfchar(.*?)endbfchar", data, re.S):
            for a, b in re.findall(hexes + rb"\s*" + hexes, part):
                self.map[int(a, 16)] = text(b)
        for part in re.findall(rb"beginbfrange(.*?)endbfrange", data, re.S):
            for a, b, c in re.findall(hexes + rb"\s*" + hexes + rb"\s*" + hexes, part):
                for k in range(int(a, 16), min(int(b, 16), int(a, 16) + 65535) + 1):
                    self.map[k] = text(c)[:-1] + chr(ord(text(c)[-1]) + k - int(a, 16))

    def codes(self, raw: bytes) -> Iterator[tuple[str, float]]:
        step = 2 if self.wide else 1
        for i in range(0, len(raw) - step + 1, step):
            code = int.from_bytes(raw[i : i + step], "big")
            w = self.widths[code - self.first] if 0 <= code - self.first < len(self.widths) else 500
            yield self.map.get(code) or (chr(code) if self.wide else bytes([code]).decode("cp1252", "replace")), (w or 0) / 1000


def times(a: tuple, b: tuple) -> tuple:
    return (a[0] * b[0] + a[1] * b[2], a[0] * b[1] + a[1] * b[3], a[2] * b[0] + a[3] * b[2], a[2] * b[1] + a[3] * b[3], a[4] * b[0] + a[5] * b[2] + b[4], a[4] * b[1] + a[5] * b[3] + b[5])


def read_page(doc: Document, page: dict) -> tuple[list[tuple], list[tuple], float, float]:
    """Letters ``text, x, y, height, bold, italic``, stroked frames ``x, y, w, h``, and the page's width and height; y grows downwards."""
    x0, y0, x1, y1 = (float(doc.get(v)) for v in doc.get(page.get("CropBox") or page.get("MediaBox") or [0, 0, 612, 792]))
    fonts = {k: Font(doc, doc.get(v)) for k, v in (doc.get((doc.get(page.get("Resources")) or {}).get("Font")) or {}).items()}
    contents = page.get("Contents")
    parts = doc.get(contents) if isinstance(doc.get(contents), list) else [contents] if contents else []
    data = b"\n".join(doc.stream(p) for p in parts)
    unit = (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)
    ctm, saved, tm, tlm = unit, [], unit, unit
    font, size, lead, extra, gap, scale = None, 1.0, 0.0, 0.0, 0.0, 1.0
    letters, frames, path, stack = [], [], [], []

    def show(raw: bytes) -> None:
        nonlocal tm
        for text, w in font.codes(raw) if font else ():
            m = times(tm, ctm)
            italic = font.italic or abs(m[2] / (abs(m[3]) or 1)) > 0.1
            if text.strip():
                letters.append((text, m[4] - x0, y1 - m[5], size * (abs(m[3]) or abs(m[1])), font.bold, italic))
            tm = times((1, 0, 0, 1, (w * size + extra + (gap if text == " " else 0)) * scale, 0), tm)

    def move(x: float, y: float) -> None:
        nonlocal tm, tlm
        tm = tlm = times((1, 0, 0, 1, x, y), tlm)

    for t, _ in tokens(data):
        if not isinstance(t, str) or isinstance(t, Name):
            stack.append(t)
            continue
        if t in ("[", "]", "<<", ">>"):
            stack.append(t)
            continue
        n = [v for v in stack if isinstance(v, (int, float))]
        if t == "q":
            saved.append(ctm)
        elif t == "Q" and saved:
            ctm = saved.pop()
        elif t == "cm" and len(n) >= 6:
            ctm = times(tuple(n[-6:]), ctm)
        elif t == "BT":
            tm = tlm = unit
        elif t == "Tf" and len(stack) >= 2:
            font, size = fonts.get(stack[-2]), float(stack[-1])
        elif t == "TL":
            lead = n[-1]
        elif t == "Tc":
            extra = n[-1]
        elif t == "Tw":
            gap = n[-1]
        elif t == "Tz":
            scale = n[-1] / 100
        elif t in ("Td", "TD") and len(n) >= 2:
            lead = -n[-1] if t == "TD" else lead
            move(n[-2], n[-1])
        elif t == "Tm" and len(n) >= 6:
            tm = tlm = tuple(n[-6:])
        elif t == "T*":
            move(0, -lead)
        elif t in ("Tj", "'", '"') and stack:
            if t != "Tj":
                move(0, -lead)
            show(stack[-1])
        elif t == "TJ":
            for v in stack:
                if isinstance(v, bytes):
                    show(v)
                elif isinstance(v, (int, float)):
                    tm = times((1, 0, 0, 1, -v / 1000 * size * scale, 0), tm)
        elif t == "re" and len(n) >= 4:
            a, b = times((1, 0, 0, 1, n[-4], n[-3]), ctm), times((1, 0, 0, 1, n[-4] + n[-2], n[-3] + n[-1]), ctm)
            path.append((min(a[4], b[4]) - x0, y1 - max(a[5], b[5]), abs(a[4] - b[4]), abs(a[5] - b[5])))
        elif t in ("S", "s", "B", "b", "f", "F", "f*", "n"):
            if t != "n":
                frames += [p for p in path if t in "SsBb" or min(p[2:]) <= 3]
            path = []
        stack = []
    return letters, frames, x1 - x0, y1 - y0


def glyphs(found: DataFrame, doc: str = "path") -> DataFrame:
    """``doc, page_no, seq, text, x, y, height, bold, italic, page_width, page_height`` of PDF files (``content``); unreadable files have a row of nulls with ``error``."""
    kind = dict(found.dtypes)[doc]
    names = [x.split()[0] for x in GLYPHS.split(", ")][1:]
    types = {"int": pa.int32(), "string": pa.string(), "float": pa.float32(), "boolean": pa.bool_()}
    fields = [(x.split()[0], types[x.split()[1]]) for x in GLYPHS.split(", ")[1:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, content in zip(b.column(doc), b.column("content").to_pylist()):
                rows, error = [], None
                try:
                    d = Document(content)
                    for p, page in enumerate(d.pages()):
                        letters, _, w, h = read_page(d, page)
                        rows += [(p, s, text, x, y, size, bold, italic, w, h) for s, (text, x, y, size, bold, italic) in enumerate(letters)]
                except (ValueError, KeyError, IndexError, TypeError, zlib.error, StopIteration) as e:
                    rows, error = [(None,) * len(names)], f"{type(e).__name__}: {e}"[:200]
                cols = list(zip(*rows)) if rows else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array([key.as_py()] * len(rows), key.type), *(pa.array(c, t) for c, (_, t) in zip(cols, fields)), pa.array([error] * len(rows), pa.string())], names=[doc, *names, "error"])

    return found.select(doc, "content").mapInArrow(run, f"{doc} {kind}, " + GLYPHS.partition(", ")[2] + ", error string")


def frames(found: DataFrame, doc: str = "path") -> DataFrame:
    """``doc, page_no, x, y, w, h`` of stroked rectangles: boxes of 30 points or more, and thin pieces of borders of 40 or more."""
    kind = dict(found.dtypes)[doc]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, content in zip(b.column(doc), b.column("content").to_pylist()):
                rows = []
                try:
                    d = Document(content)
                    rows = [(p, *map(float, f)) for p, page in enumerate(d.pages()) for f in read_page(d, page)[1] if min(f[2:]) >= 30 or (min(f[2:]) <= 3 and max(f[2:]) >= 40)]
                except (ValueError, KeyError, IndexError, TypeError, zlib.error):
                    pass
                cols = list(zip(*rows)) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array([key.as_py()] * len(rows), key.type), pa.array(cols[0], pa.int32()), *(pa.array(c, pa.float32()) for c in cols[1:])], names=[doc, "page_no", "x", "y", "w", "h"])

    return found.select(doc, "content").mapInArrow(run, f"{doc} {kind}, " + BOXES.partition(", ")[2])


