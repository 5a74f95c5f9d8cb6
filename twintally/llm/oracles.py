"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from twintally.llm.depth_bands import BASE, HEAD
from twintally.llm.grid_join import THRESHOLD
from twintally.llm.line_dedup import MIN_PAGES, RATIO
from twintally.llm.sharded_lloyd import DIMS, K, ROUNDS, SCALE, SEED

LINE_DEDUP = rf"""
WITH lines AS (
  SELECT rowid AS r, doc_id, source, t.i, t.l AS line, trim(t.l, ' ' || chr(9) || chr(13)) AS k
  FROM (SELECT row_number() OVER () AS rowid, * FROM documents) d,
       LATERAL (SELECT unnest(string_split(d.text, chr(10))) AS l,
                       unnest(range(1, len(string_split(d.text, chr(10))) + 1)) AS i) t),
hosts AS (SELECT source, count(DISTINCT coalesce(text, '')) AS host_pages FROM documents GROUP BY source),
one AS (SELECT min(rowid) AS r FROM (SELECT row_number() OVER () AS rowid, * FROM documents) d GROUP BY source, coalesce(text, '')),
bad AS (   -- rows of a source with equal texts are one page
  SELECT l.source, l.k FROM (SELECT DISTINCT r, source, k FROM lines JOIN one USING (r) WHERE k <> '') l
  JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
  GROUP BY l.source, l.k, h.host_pages
  HAVING count(*) >= {MIN_PAGES} AND count(*) > {RATIO} * h.host_pages),
marked AS (
  SELECT l.*, b.k IS NOT NULL AS gone FROM lines l LEFT JOIN bad b ON l.source IS NOT DISTINCT FROM b.source AND l.k = b.k),
clean AS (
  SELECT r, string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone) AS text,
         count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped FROM marked GROUP BY r)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(c.text, '') END AS text, d.source,
       coalesce(c.n_lines, 0) AS n_lines, coalesce(c.n_dropped, 0) AS n_dropped
FROM (SELECT row_number() OVER () AS rowid, * FROM documents) d LEFT JOIN clean c ON c.r = d.rowid
"""

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS s FROM sized GROUP BY source),
ranked AS (
  SELECT source, s, 2 * s AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w
  FROM per),
filled AS (   -- sources in the order in which a rising level meets their cap
  SELECT *, coalesce(sum(cap) OVER o, 0) AS held, coalesce(sum(w) OVER o, 0) AS gone,
         sum(w) OVER () AS all_w, sum(s) OVER () * 1.5::DOUBLE AS total
  FROM ranked
  WINDOW o AS (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT arg_min((total - held) / (all_w - gone), gone) FILTER ((total - held) / (all_w - gone) * w <= cap) AS level
  FROM filled),
targets AS (SELECT source, s, least(cap::DOUBLE, w * level) AS target FROM filled, level),
budget AS (
  SELECT *, CASE WHEN s > 0 THEN floor(target / s)::INTEGER ELSE 0 END AS f FROM targets),
run AS (
  SELECT d.*, b.s, b.target, b.f, b.target - b.f * b.s AS r,
         sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE UNBOUNDED PRECEDING) AS incl,
         sum(size) OVER (PARTITION BY d.source, h) AS own
  FROM sized d JOIN budget b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, s AS source_size, target,
       size * (f + CASE WHEN incl + (incl - own) <= 2 * r THEN 1 ELSE 0 END) AS taken
FROM run
"""

HAMMING = """
WITH q AS (SELECT vec_id, embedding FROM embeddings WHERE vec_id % 20 = 0),
pairs AS (
  SELECT q.vec_id AS query_id, e.vec_id AS neighbour_id,
         list_sum(list_transform(range(1, 65), lambda i: CASE WHEN (q.embedding[i] > 0) <> (e.embedding[i] > 0) THEN 1 ELSE 0 END))
           ::INTEGER AS distance
  FROM q JOIN embeddings e ON e.vec_id <> q.vec_id
  WHERE len(q.embedding) = 64 AND len(e.embedding) = 64),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id)::INTEGER AS rank FROM pairs)
SELECT query_id, rank, neighbour_id, distance FROM ranked WHERE rank <= 10
"""

NEAR_VECTORS = f"""
WITH RECURSIVE vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
good AS MATERIALIZED (
  SELECT * FROM vectors
  WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: isfinite(x))) = len(e)
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM good a JOIN good b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
  WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
reach AS (
  SELECT r AS a, r AS b FROM vectors UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT reach.a, min(v.vec_id) AS component_id FROM reach JOIN vectors v ON v.r = reach.b GROUP BY reach.a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, v.vec_id IS NOT DISTINCT FROM component_id AS kept
FROM vectors v JOIN least ON least.a = v.r LEFT JOIN degree d ON d.a = v.r
"""


def lloyd_sql(k: int = K, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS, scale: int = SCALE) -> str:
    """Lloyd's rounds written out, one pair of tables a round."""
    far = f"list_sum(list_transform(range(1, {dims + 1}), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT"

    def assigned(i: int) -> str:
        return f"""
a{i} AS MATERIALIZED (
  SELECT r, min({far}) AS distance, arg_min(cluster, {{'d': {far}, 'c': cluster}}) AS cluster
  FROM vectors v, c{i} c GROUP BY r)"""

    steps = [assigned(0)]
    for i in range(1, rounds + 1):
        steps += [f"""
s{i} AS (
  SELECT cluster, i, sum(x[i])::BIGINT AS s, count(*) AS n
  FROM a{i - 1} JOIN vectors USING (r), range(1, {dims + 1}) t(i) GROUP BY cluster, i)""", f"""
c{i} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{i - 1} c LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM s{i} GROUP BY cluster) m USING (cluster))""", assigned(i)]
    return f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda v: floor({scale} * v::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda v: isfinite(v))) = {dims}),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')), x) - 1)::INTEGER AS cluster, x
  FROM vectors QUALIFY cluster < {k}),{",".join(steps)},
per AS (SELECT cluster, sum(distance)::BIGINT AS cluster_inertia FROM a{rounds} GROUP BY cluster)
SELECT vec_id, cluster, distance, cluster_inertia, (SELECT sum(distance)::BIGINT FROM a{rounds}) AS inertia,
       sha256(array_to_string(c{rounds}.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN vectors USING (r) JOIN per USING (cluster) JOIN c{rounds} USING (cluster)
"""


PREFIX_TRIE = rf"""
WITH turns AS MATERIALIZED (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))[:32] AS h,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))[:32]) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS MATERIALIZED (   -- the head's length from the unsigned crc32 of the decimal id
  SELECT c, c - c % {BASE} AS base, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda u, v: CASE WHEN u % 2 = 1 THEN xor(u // 2, 3988292384) ELSE u // 2 END)),
    4294967295) % {HEAD + 1} AS head
  FROM (SELECT DISTINCT c FROM turns)),
rebuilt AS (
  SELECT v.c, 0 AS part, pos, h, text FROM convs v JOIN turns t ON t.c = v.base AND pos <= head
  UNION ALL SELECT v.c, 1, pos, h, text FROM convs v JOIN turns t ON t.c = v.c AND pos > head),
paths AS MATERIALIZED (
  SELECT c, row_number() OVER o AS d, string_agg(h, '') OVER o AS k, len(regexp_extract_all(text, '[^ 	-
]+')) AS words
  FROM rebuilt WINDOW o AS (PARTITION BY c ORDER BY part, pos ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT c, 0, '', 0 FROM convs),
nodes AS MATERIALIZED (
  SELECT d, k, min(c) AS c, count(*) AS n, any_value(words) AS words FROM paths GROUP BY d, k),
children AS (SELECT d - 1 AS d, left(k, (d - 1)::INTEGER * 32) AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
known AS MATERIALIZED (
  SELECT v.d, v.k, v.c, v.n, coalesce(ch.n, 0) AS n_children, up.c AS parent, (v.n - 1) * v.words AS saved
  FROM nodes v LEFT JOIN children ch USING (d, k) LEFT JOIN nodes up ON up.d = v.d - 1 AND up.k = left(v.k, (v.d - 1)::INTEGER * 32)),
totals AS (   -- a node adds to every prefix of its smallest member, up to its own depth
  SELECT p.d, p.k, sum(saved)::BIGINT AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM known v JOIN paths p ON p.c = v.c AND p.d <= v.d GROUP BY p.d, p.k),
ends AS (
  SELECT d, k, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM paths JOIN (SELECT c, max(d) AS d FROM paths GROUP BY c) USING (c, d) GROUP BY d, k)
SELECT v.c AS conv_id, v.d AS depth, parent AS parent_conv_id, v.n AS n_convs, n_children, leaves AS n_leaves, t.saved AS saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM known v JOIN totals t USING (d, k) LEFT JOIN ends USING (d, k)
"""

ORACLES = {"op1_hamming_topk": HAMMING, "op4_line_dedup": LINE_DEDUP, "op6_mixing": MIXING, "op11_grid_join": NEAR_VECTORS,
           "op12_sharded_lloyd": lloyd_sql(), "op13_depth_bands": PREFIX_TRIE}
