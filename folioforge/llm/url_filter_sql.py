"""The URL filter in DuckDB SQL."""

from .url_filter import ALPHABET, BACKOFF, LOWER, OTHER, END, SIZE, UPPER


def oracle(rules) -> str:
    fits, names = [], []
    for what, rule in sorted(rules, key=lambda r: -len(r[1])):
        at, _, tail = rule.partition("/")
        cond = f"(host = '{at}' OR ends_with(host, '.{at}')) AND starts_with(path, '/{tail}')"
        names.append(f"WHEN {cond} THEN '{rule}'")
        fits.append(f"WHEN {cond} THEN '{what}'")

    def p(k):
        p1 = f"(({k}_c + 1.0) / (({'SELECT sum(' + k + ') FROM grid'}) + {SIZE}.0))"
        p2 = f"(({k}_bc + {BACKOFF} * {p1}) / ({k}_b + {BACKOFF}))"
        return f"(({k} + {BACKOFF} * {p2}) / ({k}_ab + {BACKOFF}))"

    over = ", ".join(f"sum({k}) OVER (PARTITION BY {key}) AS {k}_{key}" for k in ("yes", "no") for key in ("ab", "bc", "b", "c"))
    return f"""
WITH split AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
base AS (SELECT row_number() OVER () AS row_no, page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM split),
ruled AS (SELECT *, CASE {' '.join(names)} END AS rule, CASE {' '.join(fits)} END AS verdict FROM base),
coded AS (SELECT *, [0, 0] || list_transform(string_split(host || path, ''), lambda c: CASE WHEN c = '' THEN NULL WHEN strpos('{ALPHABET}', c) = 0 THEN {OTHER} ELSE strpos('{ALPHABET}', c) END) || [{END}] AS raw FROM ruled),
clean AS (SELECT * EXCLUDE (raw), list_filter(raw, lambda x: x IS NOT NULL) AS codes FROM coded),
grams AS (SELECT row_no, verdict, unnest(list_transform(range(3, len(codes) + 1), lambda i: codes[i - 2] * {SIZE * SIZE} + codes[i - 1] * {SIZE} + codes[i])) AS g FROM clean),
seen AS (SELECT g, count(*) FILTER (verdict = 'allow') AS yes, count(*) FILTER (verdict = 'block') AS no FROM grams WHERE verdict IS NOT NULL GROUP BY g),
grid AS (SELECT r.g, r.g // {SIZE} AS ab, r.g % {SIZE * SIZE} AS bc, (r.g // {SIZE}) % {SIZE} AS b, r.g % {SIZE} AS c, coalesce(yes, 0)::DOUBLE AS yes, coalesce(no, 0)::DOUBLE AS no FROM range({SIZE**3}) r(g) LEFT JOIN seen USING (g)),
sums AS (SELECT *, {over} FROM grid),
model AS (SELECT g, ln({p('yes')}) - ln({p('no')}) AS r FROM sums),
scores AS (SELECT row_no, avg(r) AS score FROM grams JOIN model USING (g) GROUP BY row_no),
scored AS (SELECT * FROM clean JOIN scores USING (row_no)),
means AS (SELECT avg(score) FILTER (verdict = 'allow') AS ma, stddev_pop(score) FILTER (verdict = 'allow') + 1e-6 AS sa, avg(score) FILTER (verdict = 'block') AS mb, stddev_pop(score) FILTER (verdict = 'block') + 1e-6 AS sb FROM scored)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN score >= coalesce((ma * sb + mb * sa) / (sa + sb), 0.0) THEN 'allow' ELSE 'block' END) AS verdict
FROM scored, means"""
