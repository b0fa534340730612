"""SQL that fits the tree ensembles again and walks their nodes, for a check by a second engine."""

from __future__ import annotations

FEATURES = [
    "age", "department_enc", "appointment_weekday", "days_since_registration", "prior_no_shows",
    "prior_total_appointments", "prior_no_show_rate",
]
UNIT = 1 << 20
BINS = 32
DEPTH = 3
TREES = 3
#: The boosted trees that score: all rounds, in full depth.
WHOLE_BINS, WHOLE_DEPTH, WHOLE_TREES, WHOLE_RATE = 64, 6, 200, 0.05


def _prepared(bins: int) -> str:
    return f"""
feat AS MATERIALIZED (
  SELECT appointment_id AS id, no_show AS y, train, CAST([
      greatest(1, least(age, 100)), dense_rank() OVER (ORDER BY department) - 1, appointment_weekday,
      greatest(0, least(days_since_registration, 3650)), least(prior_no_shows, 20), prior_total_appointments,
      prior_no_show_rate] AS DOUBLE[]) AS x
  FROM ml),
shares AS (SELECT count(*) AS n, sum(y) AS pos, count(*) - sum(y) AS neg FROM feat WHERE train),
held AS MATERIALIZED (
  SELECT id, y, x, CASE WHEN y = 1 THEN CAST(neg AS DOUBLE) / pos ELSE 1.0 END AS w,
         CAST(floor(CAST(n AS DOUBLE) / (2 * CASE WHEN y = 1 THEN pos ELSE neg END) * {UNIT} + 0.5) AS BIGINT) AS balanced
  FROM feat, shares WHERE train),
cell AS MATERIALIZED (SELECT id, unnest(range({len(FEATURES)})) AS f, unnest(x) AS x FROM held),
per_value AS (SELECT f, x, count(*) AS n FROM cell GROUP BY f, x),
numbered AS (
  SELECT f, x, ((sum(n) OVER (PARTITION BY f ORDER BY x) - n) * {bins}) // (sum(n) OVER (PARTITION BY f)) AS b FROM per_value),
upper_end AS MATERIALIZED (
  SELECT f, b, max(x) AS x, row_number() OVER (PARTITION BY f ORDER BY max(x)) - 1 AS bin FROM numbered GROUP BY f, b),
binned AS MATERIALIZED (
  SELECT id, list(bin ORDER BY f) AS bins
  FROM cell JOIN numbered USING (f, x) JOIN (SELECT f, b, bin FROM upper_end) USING (f, b) GROUP BY id)"""


def _grown(p: str, penalty: float, least_weight: float, least_rows: int, rate: float, choose: int | None) -> list[str]:
    """Tables that grow the trees of ``{p}rows`` (tree, id, bins, g, h, n); the last is ``{p}node``."""
    offered = "" if choose is None else (
        f" QUALIFY dense_rank() OVER (PARTITION BY tree, node ORDER BY md5('42:' || tree || ':' || node || ':' || f)) <= {choose}"
    )
    score = f"({{0}} / {UNIT}.0) * ({{0}} / {UNIT}.0) / ({{1}} / {UNIT}.0 + {penalty})"
    out = [f"{p}at0 AS (SELECT tree, id, 1 AS node, bins, g, h, n FROM {p}rows)"]
    for level in range(DEPTH):
        at, split = f"{p}at{level}", f"{p}split{level}"
        out.append(
            f"""{split} AS MATERIALIZED (
  SELECT *, {score.format('gl', 'hl')} + {score.format('(g - gl)', '(h - hl)')} - {score.format('g', 'h')} AS gain FROM (
    SELECT tree, node, f, bin, sum(g) OVER a AS gl, sum(h) OVER a AS hl, sum(n) OVER a AS nl,
           sum(g) OVER w AS g, sum(h) OVER w AS h, sum(n) OVER w AS n
    FROM (SELECT tree, node, f, bin, sum(g)::BIGINT AS g, sum(h)::BIGINT AS h, sum(n)::BIGINT AS n
          FROM (SELECT tree, node, g, h, n, unnest(range({len(FEATURES)})) AS f, unnest(bins) AS bin FROM {at})
          GROUP BY tree, node, f, bin{offered})
    WINDOW a AS (PARTITION BY tree, node, f ORDER BY bin), w AS (PARTITION BY tree, node, f))
  WHERE least(nl, n - nl) >= {least_rows} AND least(hl, h - hl) > 0 AND least(hl, h - hl) / {UNIT}.0 >= {least_weight} AND gain > 1e-6
  QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY gain DESC, f, bin) = 1)"""
        )
        out.append(
            f"""{p}at{level + 1} AS MATERIALIZED (
  SELECT a.tree, a.id, 2 * a.node + CAST(a.bins[s.f + 1] > s.bin AS INTEGER) AS node, a.bins, a.g, a.h, a.n
  FROM {at} a JOIN {split} s USING (tree, node))"""
        )
    every = " UNION ALL ".join(f"SELECT * FROM {p}split{k}" for k in range(DEPTH))
    out.append(f"{p}split AS MATERIALIZED ({every})")
    out.append(
        f"""{p}node AS MATERIALIZED (
  SELECT t.tree, t.node, s.f, u.x AS threshold, (-{rate} * (t.g / {UNIT}.0)) / (t.h / {UNIT}.0 + {penalty}) AS value,
         coalesce(s.gain, 0.0) AS gain, t.n AS n_rows
  FROM (SELECT tree, 1 AS node, sum(g) AS g, sum(h) AS h, sum(n) AS n FROM {p}rows GROUP BY tree
        UNION ALL SELECT tree, 2 * node, gl, hl, nl FROM {p}split
        UNION ALL SELECT tree, 2 * node + 1, g - gl, h - hl, n - nl FROM {p}split) t
  LEFT JOIN {p}split s USING (tree, node) LEFT JOIN upper_end u ON u.f = s.f AND u.bin = s.bin)"""
    )
    return out


def _walked(p: str, out: str, given: str, depth: int = DEPTH) -> list[str]:
    """The rows of ``given`` (id, x) down all trees of ``{p}node``: (id, tree, value)."""
    steps = [f"{out}0 AS (SELECT id, x, tree, node, f, threshold, value FROM {given}, {p}node WHERE node = 1)"]
    for level in range(depth):
        steps.append(
            f"""{out}{level + 1} AS MATERIALIZED (
  SELECT a.id, a.x, a.tree, n.node, n.f, n.threshold, n.value FROM {out}{level} a JOIN {p}node n ON n.tree = a.tree
    AND n.node = CASE WHEN a.f IS NULL THEN a.node ELSE 2 * a.node + CAST(a.x[a.f + 1] > a.threshold AS INTEGER) END)"""
        )
    return steps


def _boosted() -> tuple[list[str], str]:
    tables, nodes, margin = [], [], "SELECT id, 0.0::DOUBLE AS m FROM held"
    for t in range(TREES):
        tables.append(f"margin{t} AS MATERIALIZED ({margin})")
        tables.append(
            f"""b{t}rows AS MATERIALIZED (
  SELECT {t} AS tree, id, bins, CAST(floor((p - y) * w * {UNIT} + 0.5) AS BIGINT) AS g,
         CAST(floor(p * (1 - p) * w * {UNIT} + 0.5) AS BIGINT) AS h, 1 AS n
  FROM (SELECT *, 1 / (1 + exp(-m)) AS p FROM held JOIN binned USING (id) JOIN margin{t} USING (id)))"""
        )
        tables += _grown(f"b{t}", 1.0, 1.0, 1, 0.3, None) + _walked(f"b{t}", f"b{t}walk", "held")
        margin = f"SELECT id, m + value AS m FROM margin{t} JOIN b{t}walk{DEPTH} USING (id)"
        nodes.append(f"SELECT * FROM b{t}node")
    tables.append(f"enode AS MATERIALIZED ({' UNION ALL '.join(nodes)})")
    return tables, "1 / (1 + exp(-sum(value)))"


def _all_rounds() -> list[str]:
    """Tables that grow all boosted trees, one in each step of a recursion: its rows hold the margins of the training
    rows after a tree, and the tree's nodes. The last table is ``enode``."""
    score = f"({{0}} / {UNIT}.0) * ({{0}} / {UNIT}.0) / ({{1}} / {UNIT}.0 + 1.0)"
    steps = [
        f"""given AS MATERIALIZED (
      SELECT t, id, bins, m, CAST(floor((p - y) * w * {UNIT} + 0.5) AS BIGINT) AS g,
             CAST(floor(p * (1 - p) * w * {UNIT} + 0.5) AS BIGINT) AS h
      FROM (SELECT t + 1 AS t, id, bins, y, w, m, 1 / (1 + exp(-m)) AS p
            FROM boosted JOIN started USING (id) WHERE node IS NULL AND t + 1 < {WHOLE_TREES}))""",
        "at0 AS (SELECT t, id, bins, m, g, h, 1 AS node FROM given)",
    ]
    for level in range(WHOLE_DEPTH):
        steps.append(
            f"""split{level} AS MATERIALIZED (
      SELECT *, {score.format('gl', 'hl')} + {score.format('(g - gl)', '(h - hl)')} - {score.format('g', 'h')} AS gain FROM (
        SELECT node, f, bin, sum(g) OVER a AS gl, sum(h) OVER a AS hl, sum(g) OVER w AS g, sum(h) OVER w AS h
        FROM (SELECT node, f, bin, sum(g)::BIGINT AS g, sum(h)::BIGINT AS h
              FROM (SELECT node, g, h, unnest(range({len(FEATURES)})) AS f, unnest(bins) AS bin FROM at{level} WHERE node >= {1 << level})
              GROUP BY node, f, bin)
        WINDOW a AS (PARTITION BY node, f ORDER BY bin), w AS (PARTITION BY node, f))
      WHERE least(hl, h - hl) > 0 AND least(hl, h - hl) / {UNIT}.0 >= 1.0 AND gain > 1e-6
      QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, bin) = 1)"""
        )
        steps.append(
            f"""at{level + 1} AS MATERIALIZED (
      SELECT a.t, a.id, a.bins, a.m, a.g, a.h,
             CASE WHEN s.f IS NULL THEN a.node ELSE 2 * a.node + CAST(a.bins[s.f + 1] > s.bin AS INTEGER) END AS node
      FROM at{level} a LEFT JOIN split{level} s USING (node))"""
        )
    every = " UNION ALL ".join(f"SELECT node, f, bin, g, h, gl, hl FROM split{k}" for k in range(WHOLE_DEPTH))
    steps += [
        f"split AS MATERIALIZED ({every})",
        f"""grown AS MATERIALIZED (
      SELECT n.t, n.node, s.f, s.bin, (-{WHOLE_RATE} * (n.g / {UNIT}.0)) / (n.h / {UNIT}.0 + 1.0) AS value
      FROM (SELECT t, 1 AS node, sum(g)::BIGINT AS g, sum(h)::BIGINT AS h FROM given GROUP BY t
            UNION ALL SELECT t, 2 * node, gl, hl FROM split, (SELECT DISTINCT t FROM given)
            UNION ALL SELECT t, 2 * node + 1, g - gl, h - hl FROM split, (SELECT DISTINCT t FROM given)) n
      LEFT JOIN split s USING (node))""",
    ]
    inner = ",\n    ".join(steps)
    return [
        "started AS MATERIALIZED (SELECT id, bins, y, w FROM held JOIN binned USING (id))",
        f"""boosted(t, id, m, node, f, bin, value) AS (
  SELECT -1, id, 0.0::DOUBLE, NULL::INTEGER, NULL::BIGINT, NULL::BIGINT, NULL::DOUBLE FROM held
  UNION ALL (
    WITH {inner}
    SELECT a.t, a.id, a.m + n.value, NULL, NULL, NULL, NULL FROM at{WHOLE_DEPTH} a JOIN grown n USING (node)
    UNION ALL SELECT t, NULL, NULL, node, f, bin, value FROM grown))""",
        """enode AS MATERIALIZED (
  SELECT t AS tree, node, b.f, u.x AS threshold, value
  FROM boosted b LEFT JOIN upper_end u ON u.f = b.f AND u.bin = b.bin WHERE node IS NOT NULL)""",
    ]


def _forest() -> tuple[list[str], str]:
    total, term, shares = 0.0, 0.36787944117144233, []
    for k in range(1, 8):
        total += term
        term /= k
        shares.append(int(total * 2**32))
    draw = "CAST('0x' || substr(md5('42:' || tree || ':' || id), 1, 8) AS BIGINT)"
    n = " + ".join(f"CAST(d >= {s} AS BIGINT)" for s in shares)
    rows = f"""frows AS MATERIALIZED (
  SELECT tree, id, bins, -n * balanced * y AS g, n * balanced AS h, n
  FROM (SELECT *, {n} AS n FROM (SELECT *, {draw} AS d FROM held JOIN binned USING (id), (SELECT unnest(range({TREES})) AS tree)))
  WHERE n > 0)"""
    return [rows, *_grown("f", 0.0, 0.0, 10, 1.0, 2), "enode AS (SELECT * FROM fnode)"], f"sum(value) / {TREES}"


NAME = f"{FEATURES!r}[f + 1]"
NODES = f"""
  SELECT CAST(tree AS INTEGER) AS tree, CAST(node AS INTEGER) AS node, {NAME} AS feature, threshold,
         CAST(CASE WHEN f IS NOT NULL THEN 2 * node END AS INTEGER) AS "left",
         CAST(CASE WHEN f IS NOT NULL THEN 2 * node + 1 END AS INTEGER) AS "right",
         round(value, 9) AS value, round(gain, 9) AS gain, CAST(n_rows AS BIGINT) AS n_rows
  FROM enode"""
SCORES = f"""
  SELECT id AS appointment_id, any_value(y) AS label, CAST({{0}} >= 0.5 AS INTEGER) AS prediction, round({{0}}, 9) AS score
  FROM walk{{1}} JOIN (SELECT id, y FROM feat) USING (id) GROUP BY id"""
MEAN_GAIN = "SELECT f, avg(gain) AS g FROM enode WHERE f IS NOT NULL GROUP BY f"
SHARE_OF_GAIN = """SELECT f, sum(gain / whole) AS g FROM enode JOIN (
    SELECT tree, sum(gain) AS whole FROM enode WHERE f IS NOT NULL GROUP BY tree) USING (tree) WHERE f IS NOT NULL GROUP BY f"""
IMPORTANCES = f"""
  SELECT {NAME} AS feature, round(coalesce(g, 0) / (SELECT sum(g) FROM ({{0}})), 9) AS importance
  FROM (SELECT unnest(range({len(FEATURES)})) AS f) LEFT JOIN ({{0}}) USING (f)"""


def queries() -> dict[str, tuple[str, str]]:
    """By name the tables that follow the feature view, and the query over them."""
    out = {}
    for kind, (tables, score), gains in (("boosted", _boosted(), MEAN_GAIN), ("forest", _forest(), SHARE_OF_GAIN)):
        fitted = ",\n".join([_prepared(BINS).strip(), *tables])
        out[f"ml_{kind}_nodes"] = fitted, NODES
        out[f"ml_{kind}_importances"] = fitted, IMPORTANCES.format(gains)
        depth = DEPTH
        if kind == "boosted":
            fitted, depth = ",\n".join([_prepared(WHOLE_BINS).strip(), *_all_rounds()]), WHOLE_DEPTH
        walked = ",\n".join(_walked("e", "walk", "(SELECT id, x FROM feat WHERE NOT train)", depth))
        out[f"ml_{kind}_scores"] = f"{fitted},\n{walked}", SCORES.format(score, depth)
    return out
