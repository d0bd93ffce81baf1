"""Quality classifier: modified Kneser-Ney models of trusted text, thresholds by language."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import Scratch

#: Symbols: a-z, the sign before a digit, a space, twelve marks, LETTERS first symbols of other characters, the sign before
#: other printable ASCII and before what is rare, the text's bounds, the sign before a capital letter, and the sign for a
#: word that repeats the one before.
MARKS, LETTERS = ".,'-!?:;()\"|", 20
DIGIT, SPACE, LETTER = 26, 27, 40
OTHER, BOUND, CAPITAL, REPEAT, SIZE = (LETTER + LETTERS + k for k in range(5))
ORDER = 4
#: The name of the model of all trusted text, for languages without trusted text, and null.
POOLED = ""
#: Bytes of text that one task scores on average.
GROUP = 6_000_000
#: A text's mean is drawn to its language's as if it had this many more symbols of that mean.
PRIOR = 60
#: The share of trusted texts of a language that pass.
QUANTILE = 0.999
#: Labelled ids, and languages, are broadcast only up to this many.
BROADCAST_IDS = 2_000_000
#: Stands for a repeated word; no stored text has half of a surrogate pair.
REPEATED = "\udfff"
#: Of the LETTERS first symbols so many begin two symbols, the next so many three, and the last one four.
TWO, THREE = 17, 2
#: Symbols that can follow a first one, the longest code with its capital sign, and what fills up shorter ones.
NEXT, LONGEST, NONE = LETTER + LETTERS, 5, 255
ASCII_REST = "#$%&*+/<=>@[\\]^_`{}~"


def digits(n: int, k: int) -> tuple[int, ...]:
    return tuple(n // NEXT**i % NEXT for i in reversed(range(k)))


@functools.lru_cache(1 << 16)
def code(cp: int) -> tuple[int, ...]:
    """The symbols of a code point: no two have the same, and none begins with another's."""
    c = chr(cp)
    if "a" <= c <= "z":
        return (cp - 97,)
    if c in MARKS:
        return (28 + MARKS.index(c),)
    if "0" <= c <= "9":
        return (DIGIT, LETTER + int(c))
    if c == " ":
        return (SPACE,)
    if c == REPEATED:
        return (REPEAT,)
    if c in ASCII_REST:
        return (OTHER, LETTER + ASCII_REST.index(c))
    low = c.lower()
    if len(low) == 1 and low != c and low.upper() == c:
        return (CAPITAL, *code(ord(low)))
    n = cp - 0x80
    if n >= 0:
        for first, many, k in ((0, TWO, 1), (TWO, THREE, 2), (TWO + THREE, LETTERS - TWO - THREE, 3)):
            if n < many * NEXT**k:
                return (LETTER + first + n // NEXT**k, *digits(n, k))
            n -= many * NEXT**k
    return (OTHER, cp // NEXT**3, *digits(cp, 3))  # the second is below LETTER, unlike those of ASCII_REST


@functools.cache
def codes() -> tuple[np.ndarray, np.ndarray]:
    """For each code point below U+10000 its symbols, filled up with NONE, and their number."""
    sym = np.full((0x10000, LONGEST), NONE, np.uint8)
    for cp in range(0x10000):
        x = code.__wrapped__(cp)
        sym[cp, : len(x)] = x
    return sym, (sym != NONE).sum(axis=1)


def symbols(text: str | None) -> np.ndarray:
    """The text's symbols between three bounds and one. Only kinds and lengths of white space, and repeated words, are not
    told apart."""
    sym, size = codes()
    words = text.split() if text else []
    if any(map(str.__eq__, words, words[1:])):
        words = words[:1] + [REPEATED if a == b else b for a, b in zip(words, words[1:])]
    joined = " ".join(words).replace(" " + REPEATED, REPEATED)
    cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    if cps.max(initial=0) < 0x10000:
        s = sym[:, : size[cps].max(initial=1)][cps]
        s = s[s != NONE]
    else:
        s = np.array([x for cp in cps.tolist() for x in code(cp)], np.uint8)
    return np.concatenate([np.full(ORDER - 1, BOUND, np.uint8), s, np.full(1, BOUND, np.uint8)])


def grams(s: np.ndarray) -> np.ndarray:
    x = s.astype(np.int32)
    return ((x[:-3] * SIZE + x[1:-2]) * SIZE + x[2:-1]) * SIZE + x[3:]


class Model:
    """Costs (-ln P) by interpolated modified Kneser-Ney smoothing of the given 4-gram counts, and the counted text's mean.

    Rows of the table are contexts of three symbols that occur and, after them, all contexts of two, which stand for the
    contexts of three that do not occur.
    """

    def __init__(self, gram: np.ndarray, count: np.ndarray):
        gram = gram.astype(np.int64)
        tables: list[np.ndarray] = []
        seen, at = np.unique(gram // SIZE, return_inverse=True)
        top = np.zeros((len(seen), SIZE))
        top[at, gram % SIZE] = count
        grams_of = np.unique(gram)
        for _ in range(ORDER - 1):  # below the highest order: number of distinct symbols that precede
            suffix, n = np.unique(grams_of % SIZE ** (ORDER - 1 - len(tables)), return_counts=True)
            table = np.zeros(SIZE ** (ORDER - 1 - len(tables)))
            table[suffix] = n
            tables.append(table.reshape(-1, SIZE))
            grams_of = suffix
        p = np.full((1, SIZE), 1.0 / SIZE)
        for c in reversed(tables):
            p = smooth(c, np.tile(p, (len(c) // len(p), 1)))
        p3 = p.reshape(-1, SIZE)
        self.table = -np.log(np.concatenate([smooth(top, p3[seen % SIZE**2]), p3])).astype(np.float32)
        self.row = (len(seen) + np.arange(SIZE**3) % SIZE**2).astype(np.int32)
        self.row[seen] = np.arange(len(seen))
        self.mean = float((self.cost(gram) * count).sum() / count.sum()) if len(gram) else 0.0

    def cost(self, gram: np.ndarray) -> np.ndarray:
        return self.table[self.row[gram // SIZE], gram % SIZE]

    def costs(self, texts: list[str | None]) -> np.ndarray:
        """Mean cost of each text's symbols, drawn to the model's own mean."""
        out = np.empty(len(texts))
        for i, t in enumerate(texts):
            c = self.cost(grams(symbols(t)))
            out[i] = (float(c.sum(dtype=np.float64)) + PRIOR * self.mean) / (len(c) + PRIOR)
        return out


def smooth(c: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Rows of discounted shares of counts, with what is taken off given to the lower order; that alone without counts."""
    n = [max(1, int(np.count_nonzero(c == k))) for k in (1, 2, 3, 4)]
    y = n[0] / (n[0] + 2 * n[1])
    d = np.array([0.0] + [min(0.95 * k, max(0.05, k - (k + 1) * y * n[k] / n[k - 1])) for k in (1, 2, 3)])
    off = d[np.minimum(c, 3).astype(np.int8)]
    total = c.sum(axis=1, keepdims=True)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(total > 0, (c - off + off.sum(axis=1, keepdims=True) * low) / total, low)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each batch's languages, one language at a time in one table."""
    total, one = np.zeros(SIZE**ORDER, np.int32), np.int32(1)
    for b in batches:
        langs = np.array(b.column("lang").to_pylist(), object)
        for lang in sorted(set(langs.tolist())):
            for t in b.column("text").take(pa.array(np.flatnonzero(langs == lang))).to_pylist():
                np.add.at(total, grams(symbols(t)), one)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(total[at].astype(np.int64))], names=["lang", "gram", "n"])
            total[at] = 0


def few(df: DataFrame) -> DataFrame:
    """``df`` as the side of a join that is sent to all tasks, if it is small, so that the other side is not dealt."""
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def judge(spark: SparkSession, docs: DataFrame, labels: DataFrame, scratch: Scratch | None = None, *, keep: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` (of its columns those in ``keep``, if given) with ``perplexity``, ``threshold`` and ``accepted`` added.

    ``docs`` has doc_id, lang, text and any other columns (one named like an added column is replaced);
    ``labels`` has doc_id and quality. A character model of order 4 is trained for each language on all rows
    labelled with quality 1, by interpolated modified Kneser-Ney smoothing; rows of languages without such rows, and
    with a null language, use the model of all languages together. A word that repeats the one before is one
    special symbol, so that runs of copies are as unlikely as they are in trusted text; all characters are told apart, rare
    ones by several symbols. The perplexity is
    a symbol's geometric mean, drawn to the language's mean for short texts; a row is accepted if it is at most
    the language's quantile of trusted texts (equal ones pass). Null and empty texts are judged by their bounds alone;
    very long texts are judged whole; repeated rows are judged alike. Without any trusted text all rows are
    accepted with a null threshold. An empty table gives an empty result.

    Counts stay sharded by language and n-gram. Rows meet their language's counts in groups of bounded size: a
    language of many rows is dealt to many groups, each with a copy of the counts (SIZE**4 at most).
    """
    scratch = scratch or Scratch(spark, "quality")
    docs = docs.drop("perplexity", "threshold", "accepted")
    keep = [c for c in docs.columns if keep is None or c in keep]
    ids = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("_id")).distinct().withColumn("_trusted", F.lit(True))
    text, lang = F.col("text").cast("string"), F.coalesce(F.col("lang").cast("string"), F.lit(POOLED))
    # a text is dealt once: it is put back among the other columns after it was read
    plain = ("text", "string") in docs.dtypes
    rest = F.struct(F.col("doc_id"), *[F.col(c) for c in keep if c != "doc_id" and not (plain and c == "text")])
    row = docs.select(rest.alias("row"), F.col("doc_id").cast("long").alias("_id"), lang.alias("lang"), text.alias("text"))
    marked = row.join(few(ids), "_id", "left").select("row", "lang", "text", F.col("_trusted").isNotNull().alias("trusted"))
    counted = scratch.save(marked.where("trusted").select("lang", "text").mapInArrow(_counts, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    own = counted.where(F.col("lang") != POOLED)
    counts = own.unionByName(counted.groupBy("gram").agg(F.sum("n").alias("n")).select(F.lit(POOLED).alias("lang"), "gram", "n")).withColumnRenamed("lang", "model")

    known = own.select("lang").distinct().withColumn("model", F.col("lang"))
    judged = marked.join(few(known), "lang", "left").withColumn("model", F.coalesce("model", F.lit(POOLED))).drop("lang")
    groups = judged.groupBy("model").agg(F.ceil(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 200) / GROUP).cast("long").alias("groups"))
    groups = scratch.save(groups)
    dealt = judged.join(few(groups), "model").withColumn("part", F.pmod(F.xxhash64("row.doc_id", "text"), F.col("groups"))).drop("groups")
    copies = counts.join(few(groups), "model").select("model", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("part"), "gram", "n")
    again = ["row", "trusted", "model", *(["text"] if plain and "text" in keep else [])]
    schema = T.StructType([*[dealt.schema[c] for c in again], T.StructField("cost", T.DoubleType())])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        model = Model(right.column("gram").to_numpy(), right.column("n").to_numpy())
        cost = [model.costs(left.column("text").slice(s, 2000).to_pylist()) for s in range(0, left.num_rows, 2000)]
        out = left.select(again)
        return out.append_column("cost", pa.array(np.concatenate(cost) if cost else np.empty(0)))

    scored = dealt.groupBy("model", "part").cogroup(copies.groupBy("model", "part")).applyInArrow(lambda a, b: score(a, b), schema)
    scored = scratch.save(scored, "zstd")
    cuts = scored.where("trusted").groupBy("model").agg(F.expr(f"percentile_approx(cost, {QUANTILE}, 20000)").alias("cut"))
    cuts = scratch.save(cuts)
    everyone = cuts.agg(F.max("cut")).head()[0]
    columns = [F.col("text") if plain and c == "text" else F.col("row")[c].alias(c) for c in keep]
    out = scored.join(few(cuts), "model", "left").select(*columns, F.exp("cost").alias("perplexity"), F.exp(F.coalesce("cut", F.lit(everyone).cast("double"))).alias("threshold"))
    return out.withColumn("accepted", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))
