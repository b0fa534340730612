"""SQL for a second engine: what op11 and op12 return, from the given tables."""

from __future__ import annotations

from wardmill.llm.centroids import CLUSTERS, LIMIT, ROUNDS, SCALE, SIZE

TRIE = r"""
WITH conv AS (
  SELECT DISTINCT conv_id AS c, conv_id - conv_id % 20 AS source, CAST(conv_id AS VARCHAR) AS name
  FROM conversations WHERE conv_id IS NOT NULL
), hashed AS (
  SELECT c, source, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, len(name) + 1), lambda i: ord(name[i])::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, bit: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)
  ), 4294967295::BIGINT) % 4 AS h
  FROM conv
), turn AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), taken AS (
  SELECT c, 0 AS part, k, role, text FROM hashed JOIN turn ON conv_id = source WHERE k <= h
  UNION ALL SELECT c, 1, k, role, text FROM hashed JOIN turn ON conv_id = c WHERE k > h
), placed AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, k) AS d,
         sha256(len(role) || ':' || role || text) AS step, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS tokens
  FROM taken
), prefix AS (
  SELECT c, d, tokens, sha256(string_agg(step, '') OVER (PARTITION BY c ORDER BY d)) AS node FROM placed
  UNION ALL SELECT c, 0, 0, 'root' FROM conv
), member AS (
  SELECT p.c, p.d, p.tokens, p.node, u.node AS parent, p.d = max(p.d) OVER (PARTITION BY p.c) AS ends
  FROM prefix p LEFT JOIN prefix u ON u.c = p.c AND u.d = p.d - 1
), node AS (
  SELECT node, any_value(d) AS depth, any_value(parent) AS parent, min(c) AS conv_id, count(*) AS n_convs,
         any_value(tokens) AS tokens,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM member GROUP BY node
), child AS (
  SELECT parent, count(*) AS n FROM node GROUP BY parent
), below AS (
  SELECT a.node AS top, sum((n_convs - 1) * n.tokens) AS saved, count(*) FILTER (k.n IS NULL) AS leaves
  FROM node n JOIN prefix a ON a.c = n.conv_id AND a.d <= n.depth LEFT JOIN child k ON k.parent = n.node GROUP BY a.node
)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
       b.leaves AS n_leaves, b.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM node n LEFT JOIN node u ON u.node = n.parent LEFT JOIN child k ON k.parent = n.node JOIN below b ON b.top = n.node
"""


def _clusters() -> str:
    finite = "list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)"
    whole = f"floor(least(greatest({SCALE} * x::DOUBLE, -{LIMIT}), {LIMIT}))::BIGINT"
    parts = [
        f"""vec AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: {whole}) AS v
  FROM embeddings WHERE len(embedding) = {SIZE} AND {finite}
)""",
        f"""cent0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS cluster, v FROM vec
  QUALIFY cluster < {CLUSTERS}
)""",
    ]
    for r in range(ROUNDS + 1):
        parts.append(
            f"""near{r} AS MATERIALIZED (
  SELECT row, vec_id, vec.v, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance
  FROM (SELECT row, vec_id, vec.v, c.cluster,
               list_sum(list_transform(list_zip(vec.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
        FROM vec, cent{r} c) vec
  GROUP BY row, vec_id, vec.v
)"""
        )
        if r < ROUNDS:
            parts.append(
                f"""cent{r + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.v, c.v) AS v FROM cent{r} c LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v
    FROM (SELECT cluster, i, sum(x)::BIGINT AS s, count(*) AS n
          FROM (SELECT cluster, unnest(v) AS x, unnest(range({SIZE})) AS i FROM near{r}) GROUP BY cluster, i)
    GROUP BY cluster) m USING (cluster)
)"""
            )
    return f"""WITH {", ".join(parts)}
SELECT vec_id, n.cluster::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY n.cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM near{ROUNDS} n JOIN cent{ROUNDS} c USING (cluster)
"""


CLUSTER = _clusters()
