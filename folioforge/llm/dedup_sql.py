"""Near-duplicate documents and vectors in DuckDB SQL: all pairs that share a shingle, all pairs of vectors."""

from .url_filter import LOWER, UPPER

COMPONENTS = """
reach AS (SELECT id, id AS root FROM nodes UNION SELECT e.b, r.root FROM reach r JOIN links e ON e.a = r.id),
components AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)"""

NEAR_DOCUMENTS = rf"""
WITH RECURSIVE words AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
nodes AS (SELECT doc_id AS id FROM documents),{COMPONENTS}
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM documents LEFT JOIN sizes USING (doc_id) JOIN components ON id = doc_id"""

NEAR_VECTORS = f"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings WHERE len(list_filter(embedding, lambda f: f IS NULL OR NOT isfinite(f))) = 0 AND len(list_filter(embedding, lambda f: f <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= 0.95),
nodes AS (SELECT vec_id AS id FROM embeddings), many AS (SELECT a, count(*) AS n FROM links GROUP BY a),{COMPONENTS}
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings LEFT JOIN many ON a = vec_id JOIN components ON id = vec_id"""
