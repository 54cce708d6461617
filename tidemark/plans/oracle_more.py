"""DuckDB SQL of the queries in ``stored`` and ``analyses``."""

from __future__ import annotations

from tidemark.plans.oracle import (DISPERSION_CTE, EVENTS_CTE, NATION_CTE, ORACLE, PART_CTE, RAW_CTE,
                                   nsql, r)

# --- incremental trend: the newest value of each key, in cents --------------------
ORACLE["incremental_trend"] = RAW_CTE + f""",
newest AS (
  SELECT entity, metric, period, CAST(round(value * 100) AS HUGEINT) AS y, period - 1995 AS x
  FROM raw WHERE period BETWEEN 1995 AND 2001
  QUALIFY row_number() OVER (PARTITION BY entity, metric, period ORDER BY batch_id DESC) = 1),
m AS (
  SELECT entity, metric, count(y) AS n, sum(x) AS sx, sum(x * x) AS sxx, sum(y) AS sy, sum(x * y) AS sxy,
         max(CASE WHEN period = 1995 THEN y END) / 100.0 AS gap_start,
         max(CASE WHEN period = 2001 THEN y END) / 100.0 AS gap_end
  FROM newest GROUP BY entity, metric),
s AS (
  SELECT *, CASE WHEN n * sxx - sx * sx > 0 THEN
              CAST(n * sxy - sx * sy AS DOUBLE) / CAST(n * sxx - sx * sx AS DOUBLE) / 100 END AS slope FROM m)
SELECT entity, metric, {r('slope')} AS slope,
       {r('(CAST(sy AS DOUBLE) / 100 - slope * sx) / n - slope * 1995', 4)} AS intercept, n AS n_points,
       {r('gap_start')} AS gap_start, {r('gap_end')} AS gap_end, {r('gap_end - gap_start')} AS gap_change
FROM s"""

ORACLE["bucketed_trend"] = PART_CTE + f"""
SELECT entity, metric, {r('slope')} AS slope, {r('intercept', 4)} AS intercept, n_points,
       {r('gap_start')} AS gap_start, {r('gap_end')} AS gap_end, {r('gap_end - gap_start')} AS gap_change
FROM trend"""

ORACLE["bucketed_agreement"] = ORACLE["classifier_agreement"]

_MARTS = {"gap": (ORACLE["gap_enriched"], 12), "stuck": (ORACLE["stuck_matrix"], 13),
          "closing": (ORACLE["years_to_close"], 15), "dispersion": (ORACLE["dispersion"], 6),
          "descriptive": (ORACLE["descriptive_panel"], 10)}
ORACLE["mart_catalog"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS \"table\", (SELECT count(*) FROM ({sql})) AS n_rows, CAST({n} AS INTEGER) AS n_columns"
    for t, (sql, n) in _MARTS.items())


# --- best breaks: every split, by its squared residuals ------------------------------
def sse(kind: str, lo: str, hi: str) -> str:
    """Squared residuals (in squared hundredths) of the points lo .. hi - 1
    of a series, from prefix moments p(i)."""
    def d(c):
        return f"({hi}.{c} - {lo}.{c})"
    a = f"({d('n')} * {d('yy')} - {d('y')} * {d('y')})"
    b = f"({d('n')} * {d('xy')} - {d('x')} * {d('y')})"
    c = f"({d('n')} * {d('xx')} - {d('x')} * {d('x')})"
    level = f"greatest({a} / {d('n')}, 0)"
    if kind == "level":
        return level
    return f"(CASE WHEN {c} > 0 THEN greatest(({a} - {b} * {b} / {c}) / {d('n')}, 0) ELSE {level} END)"


def breaks_sql(kind: str, cte: str, start: int, end: int, least: int = 2) -> str:
    one = f"{sse(kind, 'z', 'i')} + {sse(kind, 'i', 't')}"
    two = f"{sse(kind, 'z', 'i')} + {sse(kind, 'i', 'j')} + {sse(kind, 'j', 't')}"
    both = "USING (entity, metric)"
    return cte + f""",
pt AS (
  SELECT entity, metric, period, CAST(round(gap * 100) AS DOUBLE) AS v FROM gap
  WHERE gap IS NOT NULL AND period BETWEEN {start} AND {end}),
pc AS (
  SELECT entity, metric, period, CAST(period - first_value(period) OVER q AS DOUBLE) AS x,
         v - first_value(v) OVER q AS y, row_number() OVER q AS k
  FROM pt WINDOW q AS (PARTITION BY entity, metric ORDER BY period)),
pre AS (
  SELECT entity, metric, period, k, CAST(count(*) OVER q AS DOUBLE) AS n, sum(x) OVER q AS x, sum(y) OVER q AS y,
         sum(x * x) OVER q AS xx, sum(x * y) OVER q AS xy, sum(y * y) OVER q AS yy,
         lead(period) OVER (PARTITION BY entity, metric ORDER BY k) AS after,
         count(*) OVER (PARTITION BY entity, metric) AS len
  FROM pc WINDOW q AS (PARTITION BY entity, metric ORDER BY k)),
z AS (SELECT DISTINCT entity, metric, CAST(0 AS DOUBLE) AS n, CAST(0 AS DOUBLE) AS x, CAST(0 AS DOUBLE) AS y,
             CAST(0 AS DOUBLE) AS xx, CAST(0 AS DOUBLE) AS xy, CAST(0 AS DOUBLE) AS yy FROM pre),
t AS (SELECT * FROM pre WHERE k = len),
b0 AS (SELECT entity, metric, t.len AS n, {sse(kind, 'z', 't')} AS sse0 FROM z JOIN t {both}),
b1 AS (
  SELECT entity, metric, i.after AS break1, {one} AS sse1 FROM z JOIN t {both} JOIN pre i {both}
  WHERE i.k >= {least} AND t.len - i.k >= {least}
  QUALIFY row_number() OVER (PARTITION BY entity, metric ORDER BY {one}, i.k) = 1),
b2 AS (
  SELECT entity, metric, i.after AS break2a, j.after AS break2b, {two} AS sse2
  FROM z JOIN t {both} JOIN pre i {both} JOIN pre j {both}
  WHERE i.k >= {least} AND j.k - i.k >= {least} AND t.len - j.k >= {least}
  QUALIFY row_number() OVER (PARTITION BY entity, metric ORDER BY {two}, i.k, j.k) = 1)
SELECT entity, metric, n, {r('sse0 / 10000')} AS sse0, break1, {r('sse1 / 10000')} AS sse1, break2a, break2b,
       {r('sse2 / 10000')} AS sse2
FROM b0 LEFT JOIN b1 {both} LEFT JOIN b2 {both}"""


ORACLE["best_breaks"] = breaks_sql("line", PART_CTE, 1995, 2001)
ORACLE["best_level_breaks"] = breaks_sql("level", "WITH " + NATION_CTE.strip(), 1995, 2000)

# --- the keyed stream: newest value per key ---------------------------------------
ORACLE["keyed_stream"] = f"SELECT metric, entity, period, value FROM ({ORACLE['latest_per_key']})"

# --- balanced sub-panels: every metric set and window -------------------------------
BALANCED_CTE = EVENTS_CTE + """,
bit AS (SELECT metric, CAST(row_number() OVER (ORDER BY metric) - 1 AS INTEGER) AS i FROM ev_metrics),
mask AS (
  SELECT entity, i, bit_or(CASE WHEN value IS NOT NULL THEN 1::BIGINT << (period - 1) ELSE 0::BIGINT END) AS m
  FROM ev_cells JOIN bit USING (metric) WHERE period BETWEEN 1 AND 30 GROUP BY entity, i),
sets AS (SELECT CAST(range AS INTEGER) AS s FROM range(1, 32)),
joint AS (
  SELECT s, entity, bit_and(m) AS m FROM mask, sets WHERE (s >> i) & 1 = 1
  GROUP BY s, entity HAVING count(*) = bit_count(s)),
win AS (SELECT CAST(a.range AS INTEGER) AS a, CAST(b.range AS INTEGER) AS b
        FROM range(1, 31) a, range(1, 31) b WHERE a.range <= b.range),
full_ AS (
  SELECT s, a, b, count(*) AS n FROM joint, win
  WHERE (m >> (a - 1)) & ((1::BIGINT << (b - a + 1)) - 1) = (1::BIGINT << (b - a + 1)) - 1
  GROUP BY s, a, b),
best AS (
  SELECT *, CAST(bit_count(s) AS INTEGER) AS n_metrics, b - a + 1 AS n_periods FROM full_
  QUALIFY row_number() OVER (PARTITION BY bit_count(s), b - a ORDER BY n DESC, s, a) = 1),
frontier AS (
  SELECT n_metrics, n_periods,
         (SELECT string_agg(metric, '+' ORDER BY i) FROM bit WHERE (s >> i) & 1 = 1) AS metrics,
         a AS start, b AS "end", n AS n_entities, n * n_metrics * n_periods AS n_cells
  FROM best)
"""
ORACLE["balanced_frontier"] = BALANCED_CTE + "SELECT * FROM frontier"
ORACLE["largest_balanced"] = BALANCED_CTE + """
SELECT * FROM frontier ORDER BY n_cells DESC, n_entities DESC, n_metrics DESC LIMIT 1"""

# --- SQL functions: what the DataFrame operators give --------------------------------
ORACLE["sql_years_to_close"] = f"""
SELECT entity, metric, slope, status, closure_status, gap_ref, years_to_close,
  CASE WHEN status IN ('no_data', 'diverging', 'stalled') THEN replace(status, '_', ' ')
       WHEN years_to_close IS NULL THEN 'unknown' WHEN years_to_close = 0 THEN 'already closed'
       WHEN years_to_close < 20 THEN 'under 20 yrs' WHEN years_to_close <= 50 THEN '20-50 yrs'
       WHEN years_to_close <= 100 THEN '50-100 yrs' ELSE '100+ yrs' END AS years_bucket
FROM ({ORACLE['part_years_to_close']})"""
ORACLE["sql_stuck"] = f"SELECT entity, metric, status FROM ({ORACLE['part_stuck_matrix']})"

# --- drifting records --------------------------------------------------------------
ORACLE["drift_report"] = """
WITH n AS (SELECT event_type AS t, count(*) AS n FROM events GROUP BY 1),
f AS (
  SELECT '$.k' AS path, 'BIGINT' AS type, 'known' AS verdict, ['click', 'purchase'] AS ts
  UNION ALL SELECT '$.k', 'STRING', 'retyped', ['error']
  UNION ALL SELECT '$.extra', 'OBJECT<paid: BOOLEAN>', 'unknown', ['purchase']
  UNION ALL SELECT '$.extra.paid', 'BOOLEAN', 'unknown', ['purchase']
  UNION ALL SELECT '$.kk', 'BIGINT', 'unknown', ['signup']
  UNION ALL SELECT NULL, NULL, 'unreadable', ['view'])
SELECT path, type, CAST(sum(n) AS BIGINT) AS n_rows, verdict FROM f JOIN n ON list_contains(ts, t)
GROUP BY path, type, verdict"""

ORACLE["land_drifted"] = """
SELECT event_id, event_type <> 'view' AS readable,
       CASE WHEN event_type NOT IN ('view', 'signup') THEN TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k
FROM events"""

# --- documents that span lines and pages ---------------------------------------------
ORACLE["land_pages"] = f"""
SELECT metric, entity, period, value FROM ({ORACLE['latest_batch']})
WHERE NOT (metric = '5-LOW' AND period % 3 + 1 = 2)"""
ORACLE["page_report"] = RAW_CTE + """
SELECT DISTINCT metric AS request, CAST(period % 3 + 1 AS BIGINT) AS page,
       CASE metric WHEN '5-LOW' THEN 'missing' ELSE 'repeated' END AS fault
FROM raw WHERE batch_id = (SELECT max(batch_id) FROM raw)
  AND ((metric = '5-LOW' AND period % 3 + 1 = 2) OR (metric = '2-HIGH' AND period % 3 + 1 = 3))"""

# --- seeds, baskets, stamps -----------------------------------------------------------
ORACLE["seed_dim"] = nsql("SELECT *, CAST(length(entity) AS VARCHAR) AS name_length FROM entity_dim")
ORACLE["entity_basket"] = RAW_CTE + """,
b(entity, "group", pos) AS (VALUES
  ('NATION_3', 'subject', 0), ('NATION_8', 'subject', 1), ('NATION_13', 'subject', 2), ('NATION_18', 'subject', 3),
  ('NATION_23', 'subject', 4), ('NATION_2', 'entrant', 5), ('NATION_7', 'entrant', 6), ('NATION_12', 'entrant', 7),
  ('NATION_17', 'entrant', 8), ('NATION_22', 'entrant', 9), ('NATION_8', 'extra', 10), ('NATION_99', 'extra', 11))
SELECT b.*, (SELECT count(*) FROM raw r WHERE r.entity = b.entity AND r.batch_id = (SELECT max(batch_id) FROM raw)) AS n_rows
FROM b"""
ORACLE["metric_basket"] = RAW_CTE + """,
b(code, name, coverage, category) AS (VALUES
  ('1-URGENT', 'Urgent orders', 'full', 'fast'), ('2-HIGH', 'High priority', NULL, 'fast'),
  ('5-LOW', 'Low priority', 'partial', 'slow'), ('9-NONE', 'Not a priority', NULL, 'slow'))
SELECT b.*, (SELECT count(*) FROM raw r WHERE r.metric = b.code AND r.batch_id = (SELECT max(batch_id) FROM raw)) AS n_rows
FROM b"""
ORACLE["batch_stamp"] = """
SELECT 'evt_' || strftime(date_trunc('day', ts), '%Y%m%d') || 'T093354Z' AS batch_id, count(*) AS n_rows
FROM events GROUP BY 1"""

# --- plain table operators ---------------------------------------------------------
ORACLE["complete_rows"] = f"""
SELECT entity, period, AOV, LOW_AOV FROM ({ORACLE['to_wide']}) WHERE AOV IS NOT NULL AND LOW_AOV IS NOT NULL"""
ORACLE["coverage_total"] = EVENTS_CTE + """
SELECT count(*) AS total_rows, count(value) AS non_null, count(*) - count(value) AS nulls FROM ev_complete"""
ORACLE["transposed"] = "WITH " + NATION_CTE.strip() + DISPERSION_CTE + "SELECT CAST(period AS VARCHAR) AS period, " + ", ".join(
    f"{r(f'max(CASE WHEN metric = {chr(39)}{m}{chr(39)} THEN mean_gap END)')} AS {m}"
    for m in ("AOV", "URGENT_SHARE", "LOW_AOV")) + " FROM disp_cv GROUP BY period"
