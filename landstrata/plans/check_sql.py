"""SQL that the registered queries are checked against, composed from named parts.

The curve is walked bit by bit and groups are cut row by row, both as recursive queries, so nothing
here shares a method with the operators it checks.
"""

from __future__ import annotations

from landstrata.plans.features import FEATURES_SQL

FEATURES = f"features AS MATERIALIZED ({FEATURES_SQL})"

# Features with frequent wide boxes in some partitions, so that layouts fail the order check.
WIDE_TEST = "fid % 8 < 2 * (CAST(part_key AS INT) % 4)"
VARIED = f"""varied AS MATERIALIZED (
  SELECT fid, part_key, huc12, gap_sts, area_km2, tohuc,
         CASE WHEN {WIDE_TEST} THEN xmin - 2e1 ELSE xmin END AS xmin,
         CASE WHEN {WIDE_TEST} THEN ymin - 2e1 ELSE ymin END AS ymin,
         CASE WHEN {WIDE_TEST} THEN xmax + 2e1 ELSE xmax END AS xmax,
         CASE WHEN {WIDE_TEST} THEN ymax + 2e1 ELSE ymax END AS ymax
  FROM features)"""

# Estimated bytes of a row without its shape, in 1/8 byte: two 8-byte columns, four text columns
# with 4-byte offsets, a box of four doubles, and one bit for each of the six nullable columns.
EIGHTHS = """(8 * (8 + 8 + octet_length(encode(part_key)) + octet_length(encode(huc12)) + octet_length(encode(gap_sts))
  + octet_length(encode(tohuc)) + 16 + 32) + 6)"""


def extent(base: str) -> str:
    return f"""extent AS MATERIALIZED (
  SELECT part_key, count(*) AS row_count, count(*) FILTER (WHERE xmin IS NULL) AS empties,
         min(xmin) AS w, min(ymin) AS s, max(xmax) AS e, max(ymax) AS n
  FROM {base} GROUP BY part_key)"""


def curve(base: str) -> list[str]:
    def cell(low: str, high: str, a: str, z: str) -> str:
        scaled = f"CAST(floor((({low} + {high}) / 2e0 - {a}) * (65535e0 / ({z} - {a}))) AS BIGINT)"
        return f"CASE WHEN {low} IS NULL THEN NULL WHEN {z} > {a} THEN greatest(0, least(65535, {scaled})) ELSE 0 END"

    return [
        extent(base),
        f"""cells AS MATERIALIZED (
  SELECT fid, {cell('xmin', 'xmax', 'w', 'e')} AS x, {cell('ymin', 'ymax', 's', 'n')} AS y
  FROM {base} JOIN extent USING (part_key))""",
        """walk AS (
  SELECT fid, 15 AS k, x, y, CAST(0 AS BIGINT) AS h FROM cells WHERE x IS NOT NULL
  UNION ALL
  SELECT fid, k - 1,
         CASE WHEN ry = 1 THEN x WHEN rx = 1 THEN 65535 - y ELSE y END,
         CASE WHEN ry = 1 THEN y WHEN rx = 1 THEN 65535 - x ELSE x END,
         h * 4 + xor(3 * rx, ry)
  FROM (SELECT *, (x >> k) & 1 AS rx, (y >> k) & 1 AS ry FROM walk WHERE k >= 0) q)""",
        f"""placed AS MATERIALIZED (
  SELECT b.*, walk.h AS curve, greatest(xmax - xmin, ymax - ymin) AS size, greatest(e - w, n - s) AS span
  FROM {base} b JOIN extent USING (part_key) LEFT JOIN walk ON walk.fid = b.fid AND walk.k = -1)""",
    ]


def attempts(rows: list[tuple[int, int, float]]) -> str:
    values = ", ".join(f"({n}, {budget}, CAST({fraction!r} AS DOUBLE))" for n, budget, fraction in rows)
    return f"attempts AS MATERIALIZED (SELECT * FROM (VALUES {values}) v(attempt, budget, fraction))"


def search_attempts(budget: int, fraction: float, unit: int) -> str:
    budgets = [budget, budget // 2, budget // 4]
    fractions = [fraction / 2**k for k in range(4)] if fraction > 0 else [0.0]
    return attempts(
        [(len(fractions) * i + j, b * unit, f) for i, b in enumerate(budgets) for j, f in enumerate(fractions)]
    )


def cut(cost: str, max_rows: int) -> list[str]:
    """Rows of `placed` ordered and cut for every attempt."""
    new = f"(c.acc + o.cost > o.budget OR c.held >= {max_rows} OR o.is_large <> c.is_large)"
    return [
        f"""ordered AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY part_key, attempt ORDER BY is_large, curve NULLS LAST, fid) AS rn
  FROM (SELECT p.*, attempt, budget, coalesce(fraction > 0 AND size > fraction * span, false) AS is_large,
               CAST({cost} AS BIGINT) AS cost FROM placed p CROSS JOIN attempts) q)""",
        f"""steps AS (
  SELECT part_key, attempt, rn, cost AS acc, 1 AS held, 0 AS group_id, is_large FROM ordered WHERE rn = 1
  UNION ALL
  SELECT o.part_key, o.attempt, o.rn, CASE WHEN {new} THEN o.cost ELSE c.acc + o.cost END,
         CASE WHEN {new} THEN 1 ELSE c.held + 1 END, c.group_id + CASE WHEN {new} THEN 1 ELSE 0 END, o.is_large
  FROM steps c JOIN ordered o ON o.part_key = c.part_key AND o.attempt = c.attempt AND o.rn = c.rn + 1)""",
        """laid AS MATERIALIZED (
  SELECT o.*, s.group_id FROM ordered o JOIN steps s ON s.part_key = o.part_key AND s.attempt = o.attempt AND s.rn = o.rn)""",
        """grouped AS MATERIALIZED (
  SELECT part_key, attempt, group_id, count(*) AS row_count, CAST(sum(cost) AS BIGINT) AS cost, bool_or(is_large) AS is_large,
         min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax
  FROM laid GROUP BY part_key, attempt, group_id)""",
    ]


def verdict() -> list[str]:
    """The order check of every attempt, and the attempt each partition keeps."""
    return [
        """parts AS (
  SELECT part_key, attempt, 'rows' AS level, i // step AS seq,
         min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax
  FROM (SELECT *, row_number() OVER (PARTITION BY part_key, attempt ORDER BY rn) - 1 AS i,
               CAST(ceil(count(*) OVER (PARTITION BY part_key, attempt) / 10e0) AS BIGINT) AS step,
               count(*) OVER (PARTITION BY part_key, attempt) AS present
        FROM laid WHERE xmin IS NOT NULL) q
  WHERE present >= 200 GROUP BY part_key, attempt, i // step
  UNION ALL
  SELECT part_key, attempt, 'groups', group_id, xmin, ymin, xmax, ymax
  FROM (SELECT *, count(*) OVER (PARTITION BY part_key, attempt) AS groups FROM grouped WHERE xmin IS NOT NULL) q
  WHERE groups >= 5)""",
        """tests AS MATERIALIZED (
  SELECT part_key, attempt, level, count(*) AS boxes, count(*) - 1 AS pairs, count(*) FILTER (WHERE overlap) AS overlapping,
         avg(area) AS mean_area, (max(xmax) - min(xmin)) * (max(ymax) - min(ymin)) AS extent_area
  FROM (SELECT *, (xmax - xmin) * (ymax - ymin) AS area,
               least(xmax, lag(xmax) OVER w) > greatest(xmin, lag(xmin) OVER w)
               AND least(ymax, lag(ymax) OVER w) > greatest(ymin, lag(ymin) OVER w)
               AND lag(xmax) OVER w IS NOT NULL AS overlap
        FROM parts WINDOW w AS (PARTITION BY part_key, attempt, level ORDER BY seq)) q
  GROUP BY part_key, attempt, level)""",
        """judged AS MATERIALIZED (
  SELECT p.part_key, a.attempt, coalesce(bool_and(
           overlapping / CAST(pairs AS DOUBLE) < 0.3 OR extent_area = 0 OR mean_area / extent_area < 0.3), true) AS ok
  FROM (SELECT DISTINCT part_key FROM placed) p CROSS JOIN attempts a
  LEFT JOIN tests t ON t.part_key = p.part_key AND t.attempt = a.attempt
  GROUP BY p.part_key, a.attempt)""",
        """chosen AS MATERIALIZED (
  SELECT part_key, coalesce(min(attempt) FILTER (WHERE ok), 0) AS attempt, bool_or(ok) AS order_ok
  FROM judged GROUP BY part_key)""",
    ]


def mean_cost(base: str, unit: int) -> str:
    """Each partition's mean attribute cost, in cost units."""
    return f"""attribute_cost AS MATERIALIZED (
  SELECT part_key, (CAST(sum({EIGHTHS}) AS BIGINT) * {unit // 8}) // count(*) AS attribute_cost FROM {base} GROUP BY part_key)"""


def compose(body: str, *parts: str | list[str]) -> str:
    listed = []
    for part in parts:
        listed += [part] if isinstance(part, str) else part
    return f"WITH RECURSIVE {', '.join([FEATURES, *listed])} {body}"
