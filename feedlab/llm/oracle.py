"""SQL of the queries that SQL can express, for an independent check."""

LINE_DEDUP = """
WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
w AS (SELECT doc_id, pos, lines[pos + 1] || chr(10) || lines[pos + 2] || chr(10) || lines[pos + 3] AS body
      FROM (SELECT doc_id, lines, unnest(range(0, len(lines) - 2)) AS pos FROM l)),
f AS (SELECT doc_id, pos, first_value(doc_id) OVER o AS first_doc, first_value(pos) OVER o AS first_at
      FROM w WINDOW o AS (PARTITION BY body ORDER BY doc_id, pos)),
gone AS (SELECT DISTINCT doc_id, unnest(range(CASE WHEN doc_id = first_doc THEN greatest(pos, first_at + 3) ELSE pos END,
                                              pos + 3)) AS place
         FROM f WHERE doc_id <> first_doc OR pos > first_at),
rest AS (SELECT e.doc_id, string_agg(e.line, chr(10) ORDER BY e.place) AS text
         FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(0, len(lines))) AS place FROM l) e
         ANTI JOIN gone USING (doc_id, place) GROUP BY e.doc_id)
SELECT l.doc_id, len(l.lines)::BIGINT AS n_lines, count(gone.place)::BIGINT AS n_removed,
       coalesce(any_value(rest.text), '') AS text
FROM l LEFT JOIN gone USING (doc_id) LEFT JOIN rest USING (doc_id) GROUP BY l.doc_id, l.lines
"""

DECONTAMINATION = """
WITH t AS (SELECT 'd' AS side, doc_id AS id, regexp_split_to_array(trim(lower(text), ' ' || chr(9) || chr(10) || chr(13)),
                  '[ \\t\\n\\r]+') AS w FROM documents
           UNION ALL
           SELECT 'b', item_id, regexp_split_to_array(trim(lower(text), ' ' || chr(9) || chr(10) || chr(13)),
                  '[ \\t\\n\\r]+') FROM benchmark),
g AS (SELECT DISTINCT side, id, array_to_string(w[pos:pos + 4], ' ') AS shingle
      FROM (SELECT side, id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS pos FROM t)
      WHERE array_to_string(w, ' ') <> ''),
n AS (SELECT id, count(*) AS n FROM g WHERE side = 'b' GROUP BY id),
m AS (SELECT d.id AS doc_id, b.id AS item_id, count(*) AS shared
      FROM g d JOIN g b ON d.shingle = b.shingle AND d.side = 'd' AND b.side = 'b' GROUP BY d.id, b.id)
SELECT doc_id, item_id, n::BIGINT AS n_shingles, shared::BIGINT AS n_shared, round(shared / n, 6) AS containment
FROM m JOIN n ON n.id = item_id WHERE shared >= 0.8 * n
"""


#: Rows (vec_id, label, i, v) of the vectors kept, a component each; v is the whole number.
_COMPONENTS = """
WITH kept AS (SELECT vec_id, label, embedding FROM embeddings
              WHERE embedding IS NOT NULL {only}
                AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
c AS MATERIALIZED (SELECT vec_id, label, i, floor(1024 * e::DOUBLE)::BIGINT AS v
      FROM (SELECT vec_id, label, unnest(embedding) AS e, unnest(range(0, len(embedding))) AS i FROM kept))"""


def floored(total: str, count: str) -> str:
    """SQL of the exact floor of a quotient of whole numbers."""
    return f"CAST(({total} - (({total} % {count}) + {count}) % {count}) // {count} AS BIGINT)"


def codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4, dims: int = 64) -> str:
    """Codebooks refined round by round, then codes and errors."""
    width = dims // parts
    sql = _COMPONENTS.format(only="") + f""",
p AS MATERIALIZED (SELECT vec_id, label, i // {width} AS part, i % {width} AS j, v FROM c),
b0 AS MATERIALIZED (SELECT part, dense_rank() OVER (ORDER BY vec_id) - 1 AS entry, j, v FROM p
       WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries}))"""
    for k in range(rounds + 1):
        sql += f""",
d{k} AS (SELECT p.vec_id, p.part, b.entry, sum((p.v - b.v) * (p.v - b.v)) AS apart
         FROM p JOIN b{k} b ON p.part = b.part AND p.j = b.j GROUP BY p.vec_id, p.part, b.entry),
a{k} AS MATERIALIZED (SELECT vec_id, part, entry, apart FROM (
         SELECT *, row_number() OVER (PARTITION BY vec_id, part ORDER BY apart, entry) AS place FROM d{k}) WHERE place = 1)"""
        if k < rounds:
            sql += f""",
s{k} AS (SELECT a.part, a.entry, p.j, sum(p.v)::BIGINT AS total, count(*)::BIGINT AS n
         FROM a{k} a JOIN p ON a.vec_id = p.vec_id AND a.part = p.part GROUP BY a.part, a.entry, p.j),
b{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.j, coalesce({floored("s.total", "s.n")}, b.v) AS v
         FROM b{k} b LEFT JOIN s{k} s ON b.part = s.part AND b.entry = s.entry AND b.j = s.j)"""
    return sql + f""",
r AS (SELECT vec_id, string_agg(printf('%02x', entry::INTEGER), '' ORDER BY part) AS code, sum(apart)::BIGINT AS error
      FROM a{rounds} GROUP BY vec_id),
l AS (SELECT r.*, label FROM r JOIN kept USING (vec_id))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, j)) FROM b{rounds}) AS codebooks_sha256
FROM l"""


def centroids_sql(clusters: int = 8, rounds: int = 10, dims: int = 64, seed: int = 3) -> str:
    """Centroids refined round by round, then clusters and distances."""
    sql = _COMPONENTS.format(only=f"AND len(embedding) = {dims}") + f""",
b0 AS MATERIALIZED (SELECT entry, i, v FROM c JOIN (
       SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS entry FROM kept) USING (vec_id)
       WHERE entry < {clusters})"""
    for k in range(rounds + 1):
        sql += f""",
d{k} AS (SELECT c.vec_id, b.entry, sum((c.v - b.v) * (c.v - b.v)) AS apart
         FROM c JOIN b{k} b ON c.i = b.i GROUP BY c.vec_id, b.entry),
a{k} AS MATERIALIZED (SELECT vec_id, entry, apart FROM (
         SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY apart, entry) AS place FROM d{k}) WHERE place = 1)"""
        if k < rounds:
            sql += f""",
s{k} AS (SELECT a.entry, c.i, sum(c.v)::BIGINT AS total, count(*)::BIGINT AS n
         FROM a{k} a JOIN c ON a.vec_id = c.vec_id GROUP BY a.entry, c.i),
b{k + 1} AS MATERIALIZED (SELECT b.entry, b.i, coalesce({floored("s.total", "s.n")}, b.v) AS v
         FROM b{k} b LEFT JOIN s{k} s ON b.entry = s.entry AND b.i = s.i)"""
    return sql + f""",
h AS (SELECT entry, sha256(string_agg(v::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM b{rounds} GROUP BY entry)
SELECT vec_id, entry::INTEGER AS cluster, apart::BIGINT AS distance,
       (sum(apart) OVER (PARTITION BY entry))::BIGINT AS cluster_inertia, (sum(apart) OVER ())::BIGINT AS inertia,
       centroid_sha256
FROM a{rounds} JOIN h USING (entry)"""
