"""Files as rows, by literal path, glob or regular expression, and their text by format."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = ("pdf", "docx", "txt", "md")
WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def files(spark: SparkSession, path: str, *, regex: str | None = None) -> DataFrame:
    """``path, name, format, length, content``, to be sorted by path where order matters.

    A ``*`` or ``?`` in the last part is a glob, which does not descend; ``regex`` must match the whole name of
    a file of the folder ``path``. Only listing decides, so contents of other files are never read.
    """
    reader = spark.read.format("binaryFile")
    folder, _, last = path.rpartition("/")
    if regex is None and re.search(r"[*?]", last):
        df = reader.option("pathGlobFilter", last).load(folder or "/")
    else:
        df = reader.load(path)
    name = file_name(F.col("path"))
    if regex is not None:
        df = df.where(name.rlike(f"^(?:{regex})$"))
    return df.select("path", name.alias("name"), F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)).alias("format"), "length", "content")


def docx_text(content: bytes) -> str:
    """Paragraphs and tables of a document in order: headings by style, tables as pipe tables."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{WORD}body")
    text_of = lambda e: "".join(t.text or "" if t.tag == f"{WORD}t" else "\t" if t.tag == f"{WORD}tab" else "\n" for t in e.iter() if t.tag in (f"{WORD}t", f"{WORD}tab", f"{WORD}br"))
    out = []
    for e in body if body is not None else ():
        if e.tag == f"{WORD}p":
            text = text_of(e).strip()
            style = e.find(f"{WORD}pPr/{WORD}pStyle")
            level = re.match(r"(?i)heading\s*([123])", style.get(f"{WORD}val", "") if style is not None else "")
            if text:
                out.append("#" * int(level[1]) + " " + text if level else text)
        elif e.tag == f"{WORD}tbl":
            rows = [["\n".join(text_of(p) for p in c.iter(f"{WORD}p")).strip().replace("|", "\\|").replace("\n", " ") for c in r.findall(f"{WORD}tc")] for r in e.findall(f"{WORD}tr")]
            table = ["| " + " | ".join(r) + " |" for r in rows]
            if table:
                table.insert(1, "|" + " --- |" * len(rows[0]))
            out.append("\n".join(table))
    return "\n\n".join(out)


def _docx(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        text, error = [], []
        for c in b.column("content").to_pylist():
            try:
                text.append(docx_text(c))
                error.append(None)
            except (zipfile.BadZipFile, KeyError, ElementTree.ParseError) as e:
                text.append(None)
                error.append(f"{type(e).__name__}: {e}"[:200])
        yield pa.RecordBatch.from_arrays([b.column("path"), b.column("name"), b.column("format"), pa.array(text, pa.string()), pa.array(error, pa.string())], names=["path", "name", "format", "text", "error"])


def documents(found: DataFrame) -> DataFrame:
    """``path, name, format, text, error`` of files; a file that cannot be read has an error instead of stopping the rest.

    Text and Markdown must be valid UTF-8; PDF pages come from ``sources.pdf``; other formats are errors.
    """
    plain = found.where(F.col("format").isin("txt", "md")).select("path", "name", "format", F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string")).alias("text"))
    plain = plain.withColumn("error", F.when(F.col("text").isNull(), "not UTF-8"))
    word = found.where(F.col("format") == "docx").select("path", "name", "format", "content").mapInArrow(_docx, "path string, name string, format string, text string, error string")
    other = found.where(~F.col("format").isin(*FORMATS)).select("path", "name", "format", F.lit(None).cast("string").alias("text"), F.lit("unsupported format").alias("error"))
    return plain.unionByName(word).unionByName(other)


def images(spark: SparkSession, path: str) -> DataFrame:
    """``path, image`` of PNG and JPEG page images."""
    return spark.read.format("image").load(path).select(F.col("image.origin").alias("path"), "image")


def word_lists(spark: SparkSession, *paths: str) -> DataFrame:
    """``text`` of whole word-list files."""
    return spark.read.text(list(paths), wholetext=True).select(F.col("value").alias("text"))


def png(image: np.ndarray) -> bytes:
    """An RGB array as a PNG file."""
    import struct
    import zlib

    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    h, w = image.shape[:2]
    raw = b"".join(b"\0" + row.tobytes() for row in image.astype(np.uint8))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
