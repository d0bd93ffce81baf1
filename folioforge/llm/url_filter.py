"""URL filter: host and path rules, else the ratio of two character language models.

Built from DataFrame functions only. The models are variable-order Markov models over 42 symbols with
contexts of up to two symbols, so a model is a dense array of 42^3 log ratios whatever the input's size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Symbols 1 to 39; 0 stands before the start, 40 for any other character, 41 for the end.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789./-"
OTHER, END, SIZE = 40, 41, 42
#: Weight of the shorter context's estimate when two are interpolated.
BACKOFF = 4.0

Rule = tuple[str, str]


def host_of(url: Column) -> Column:
    at = F.locate("://", url)
    rest = url.substr(at + 3, F.length(url))
    return F.when(at > 0, F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    at = F.locate("://", url)
    rest = url.substr(at + 3, F.length(url))
    return F.when(at > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule in sorted(rules, key=lambda r: len(r[1])):
        at, _, tail = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + tail)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def symbols(text: Column) -> Column:
    """Two start symbols, a symbol for each character, the end symbol."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    codes = F.transform(chars, lambda c: F.coalesce(F.nullif(F.call_function("instr", F.lit(ALPHABET), c), F.lit(0)), F.lit(OTHER)))
    return F.concat(F.array(F.lit(0), F.lit(0)), codes, F.array(F.lit(END)))


def windows(codes: Column) -> Column:
    """Index of each run of three symbols in the dense model."""
    return F.transform(F.sequence(F.lit(3), F.size(codes)), lambda i: F.get(codes, i - 3) * (SIZE * SIZE) + F.get(codes, i - 2) * SIZE + F.get(codes, i - 1))


def log_ratios(judged: DataFrame) -> DataFrame:
    """``g, r``: ln P(symbol | context) of accepted over rejected texts for each of the 42^3 triples.

    ``judged`` has ``codes ARRAY<INT>`` and ``verdict``. Counts are summed before the shuffle; what follows
    works on the fixed grid of triples, so each broadcast table here has 74,088 rows at most. Without
    texts of a class its estimates are uniform.
    """
    kinds = {"yes": "allow", "no": "block"}
    seen = judged.select("verdict", F.explode(windows(F.col("codes"))).alias("g")).groupBy("g").agg(*(F.sum((F.col("verdict") == v).cast("long")).alias(k) for k, v in kinds.items()))
    grid = judged.sparkSession.range(0, SIZE**3, 1, 1).select(F.col("id").cast("int").alias("g")).join(F.broadcast(seen), "g", "left")
    grid = grid.select("g", F.floor(F.col("g") / SIZE).cast("int").alias("ab"), (F.col("g") % (SIZE * SIZE)).alias("bc"), (F.floor(F.col("g") / SIZE) % SIZE).cast("int").alias("b"), (F.col("g") % SIZE).alias("c"), *(F.coalesce(k, F.lit(0)).cast("double").alias(k) for k in kinds))
    sums = grid
    for key in ("ab", "bc", "b", "c"):
        sums = sums.join(F.broadcast(grid.groupBy(key).agg(*(F.sum(k).alias(f"{k}_{key}") for k in kinds))), key)

    def p(k: str) -> Column:
        p1 = (F.col(f"{k}_c") + 1.0) / (grid.agg(F.sum(k)).scalar() + float(SIZE))
        p2 = (F.col(f"{k}_bc") + BACKOFF * p1) / (F.col(f"{k}_b") + BACKOFF)
        return (F.col(k) + BACKOFF * p2) / (F.col(f"{k}_ab") + BACKOFF)

    return sums.select("g", (F.log(p("yes")) - F.log(p("no"))).alias("r"))


def filter_urls(pages: DataFrame, rules: Sequence[Rule], *, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """``id, host, path, rule, verdict, score`` for each row.

    The host stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path
    follows up to ``?``, ``#`` or the end; null urls and urls without ``://`` have neither. The longest rule
    that fits decides; it fits its host and all subdomains if the url's path starts with the rule's. Other
    urls are allowed if the character models trained on the rules' accepted and rejected urls give a
    length-normalised score of at least the calibrated threshold, the point between both classes' mean
    scores weighted by their deviations (0 where a class is missing). Repeated rows are judged alike;
    extra columns of any name are ignored; an empty table gives an empty result.
    """
    base = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).cast("string").alias("url"))
    base = base.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).select("page_id", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    keys = ["row", "page_id", "host", "path", "rule", "verdict"]
    coded = base.select(F.monotonically_increasing_id().alias("row"), "page_id", "host", "path", name.alias("rule"), verdict.alias("verdict"), symbols(F.concat("host", "path")).alias("codes"))
    model = log_ratios(coded.where("verdict is not null").select("codes", "verdict"))
    scored = coded.select(*keys, F.explode(windows(F.col("codes"))).alias("g")).join(F.broadcast(model), "g").groupBy(*keys).agg(F.avg("r").alias("score"))

    def of(v: str) -> tuple[Column, Column]:
        x = F.when(F.col("verdict") == v, F.col("score"))
        return F.avg(x), F.stddev_pop(x) + 1e-6

    (ma, sa), (mb, sb) = of("allow"), of("block")
    cut = scored.where("verdict is not null").agg(F.coalesce((ma * sb + mb * sa) / (sa + sb), F.lit(0.0)).alias("cut")).scalar()
    judged = F.coalesce("verdict", F.when(F.col("score") >= cut, F.lit("allow")).otherwise(F.lit("block")))
    return scored.select("page_id", "host", "path", "rule", judged.alias("verdict"), "score")
