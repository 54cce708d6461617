"""Independent SQL for each registered query, runnable by DuckDB over views
named after the driver's Parquet tables.  Written from the operator
definitions, not generated from the Spark plans.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def r(x: str, d: int = 6) -> str:
    """Output rounding, same rule as ``finish`` on the Spark side."""
    return f"CAST(round(round(CAST({x} AS DECIMAL(38,12)), 9), {d}) AS DOUBLE)"


def dround(x: str, d: int) -> str:
    """round(x::numeric, d) as double."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {d}) AS DOUBLE)"


def nonan(x: str) -> str:
    return f"(CASE WHEN isnan({x}) THEN NULL ELSE {x} END)"


def exact_slope_terms(y: str = "gap", x: str = "period") -> str:
    """Numerator (in cents) and denominator of the OLS slope as exact
    128-bit integers; the gap has 2 decimals, so gap * 100 is an integer."""
    yc = f"CAST(round({y} * 100) AS HUGEINT)"
    xi = f"CASE WHEN {y} IS NOT NULL THEN CAST({x} AS HUGEINT) END"
    n = f"CAST(count({y}) AS HUGEINT)"
    return (f"{n} * sum({xi} * {yc}) - sum({xi}) * sum({yc}) AS num_c,\n"
            f"         {n} * sum({xi} * {xi}) - sum({xi}) * sum({xi}) AS den")


# --- nation panel ------------------------------------------------------------
NATION_CTE = """
nation_base AS (
  SELECT n.n_name, CAST(year(o.o_orderdate) AS INTEGER) AS period,
         o.o_totalprice, o.o_orderpriority
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE o.o_orderdate >= TIMESTAMP '1995-01-01 00:00:00'
    AND o.o_orderdate < TIMESTAMP '2001-01-01 00:00:00'
),
nation_cells AS (
  SELECT CASE WHEN GROUPING(n_name) = 1 THEN 'ALL' ELSE n_name END AS entity, period,
         avg(o_totalprice) AS aov,
         avg(CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(100 AS DOUBLE)
                  ELSE CAST(0 AS DOUBLE) END) AS urgent_share,
         avg(CASE WHEN o_orderpriority = '5-LOW' AND n_name <> 'NATION_3'
                  THEN o_totalprice END) AS low_aov,
         CAST(count(*) AS DOUBLE) AS orders_n
  FROM nation_base
  GROUP BY GROUPING SETS ((n_name, period), (period))
),
panel AS (
  SELECT entity, 'AOV' AS metric, period, aov AS value FROM nation_cells
  UNION ALL SELECT entity, 'URGENT_SHARE', period, urgent_share FROM nation_cells
  UNION ALL SELECT entity, 'LOW_AOV', period, low_aov FROM nation_cells
  UNION ALL SELECT entity, 'ORDERS', period, orders_n FROM nation_cells
),
entity_dim AS (
  SELECT n.n_name AS entity, 'Nation ' || CAST(n.n_nationkey AS VARCHAR) AS entity_name,
         CASE r.r_name WHEN 'EUROPE' THEN 'subject' WHEN 'ASIA' THEN 'entrant'
              WHEN 'AMERICA' THEN 'success' WHEN 'AFRICA' THEN 'core'
              WHEN 'MIDDLE EAST' THEN 'core' END AS role,
         r.r_name IN ('EUROPE', 'AMERICA') AS western, r.r_name AS region
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  UNION ALL
  SELECT 'ALL', 'All nations', 'benchmark', CAST(NULL AS BOOLEAN), CAST(NULL AS VARCHAR)
),
metric_dim AS (
  SELECT * FROM (VALUES
    ('AOV', 'Average order value', 'convergence'),
    ('URGENT_SHARE', 'Urgent order share (%)', 'context_inverted'),
    ('LOW_AOV', 'Average low-priority order value', 'convergence'),
    ('ORDERS', 'Orders placed', 'context')) AS t(metric, friendly_name, bucket)
),
bench AS (
  SELECT metric, period, value AS bench_value FROM panel WHERE entity = 'ALL'
),
gap AS (
  SELECT p.entity, p.metric, p.period, p.value, b.bench_value,
         CASE WHEN b.bench_value IS NULL OR b.bench_value = 0 THEN NULL
              ELSE """ + dround("p.value / b.bench_value * 100", 2) + """ END AS gap
  FROM panel p LEFT JOIN bench b ON p.metric = b.metric AND p.period = b.period
),
gap_mart AS (
  SELECT g.entity, d.entity_name, d.role, d.western, d.region,
         g.metric, m.friendly_name, m.bucket, g.period, g.value, g.bench_value, g.gap
  FROM gap g
  LEFT JOIN entity_dim d ON g.entity = d.entity
  LEFT JOIN metric_dim m ON g.metric = m.metric
),
trend AS (
  SELECT entity, metric,
         """ + nonan("regr_slope(gap, period)") + """ AS slope,
         """ + nonan("regr_intercept(gap, period)") + """ AS intercept,
         count(gap) AS n_points,
         max(CASE WHEN period = 1995 THEN gap END) AS gap_start,
         max(CASE WHEN period = 2000 THEN gap END) AS gap_end,
         max(CASE WHEN period = 2000 THEN gap END) AS gap_ref,
         """ + exact_slope_terms() + """
  FROM gap WHERE period BETWEEN 1995 AND 2000
  GROUP BY entity, metric
)
"""

ENTITY_COLS = "d.entity_name, d.role, d.western, d.region"
METRIC_COLS = "m.friendly_name, m.bucket"


def with_nation(body: str) -> str:
    return "WITH " + NATION_CTE.strip() + "\n" + body


def stuck_case(slope: str = "slope", bucket: str = "bucket", t: str = "t") -> str:
    """Stuck labels; band tests on the exact slope terms of alias ``t``
    (slope > 0.2 <=> num_c > 20 * den, slope > 2.0 <=> num_c > 200 * den)."""
    num, den = f"{t}.num_c", f"{t}.den"
    return f"""CASE
      WHEN {slope} IS NULL THEN 'no_data'
      WHEN {bucket} = 'context' THEN 'not_classified'
      WHEN {bucket} = 'context_inverted' THEN
        CASE WHEN {num} < -200 * {den} THEN 'catching_up'
             WHEN {num} > 200 * {den} THEN 'falling_behind' ELSE 'stuck' END
      WHEN {bucket} = 'convergence' THEN
        CASE WHEN {num} > 20 * {den} THEN 'catching_up'
             WHEN {num} < -20 * {den} THEN 'falling_behind' ELSE 'stuck' END
      ELSE 'not_classified' END"""


def trajectory_case(slope: str = "slope", bucket: str = "bucket", t: str = "t") -> str:
    num, den = f"{t}.num_c", f"{t}.den"
    return f"""CASE
      WHEN {slope} IS NULL THEN 'no_data'
      WHEN {bucket} = 'convergence' THEN
        CASE WHEN {num} > 20 * {den} THEN 'catching_up'
             WHEN {num} < -20 * {den} THEN 'diverging' ELSE 'stalled' END
      WHEN {bucket} = 'context_inverted' THEN
        CASE WHEN {num} < -200 * {den} THEN 'catching_up'
             WHEN {num} > 200 * {den} THEN 'diverging' ELSE 'stalled' END
      ELSE 'not_classified' END"""


# --- core marts --------------------------------------------------------------
ORACLE["gap_to_benchmark"] = with_nation(f"""
SELECT entity, metric, period, {r('value')} AS value, {r('bench_value')} AS bench_value,
       {r('gap')} AS gap
FROM gap""")

ORACLE["gap_enriched"] = with_nation(f"""
SELECT entity, entity_name, role, western, region, metric, friendly_name, bucket, period,
       {r('value')} AS value, {r('bench_value')} AS bench_value, {r('gap')} AS gap
FROM gap_mart""")

ORACLE["trend_slope"] = with_nation(f"""
SELECT entity, metric, {r('slope')} AS slope, {r('intercept', 4)} AS intercept, n_points,
       {r('gap_start')} AS gap_start, {r('gap_end')} AS gap_end,
       {r('gap_end - gap_start')} AS gap_change
FROM trend""")

ORACLE["stuck_matrix"] = with_nation(f"""
SELECT t.entity, {ENTITY_COLS}, t.metric, {METRIC_COLS},
       {r('t.gap_start')} AS gap_start, {r('t.gap_end')} AS gap_end,
       {r('t.gap_end - t.gap_start')} AS gap_change, {r('t.slope')} AS slope,
       {stuck_case('t.slope', 'm.bucket')} AS status
FROM trend t
LEFT JOIN entity_dim d ON t.entity = d.entity
LEFT JOIN metric_dim m ON t.metric = m.metric""")

CLOSING_CTE = f""",
closing_trend AS (
  SELECT g.entity, g.metric,
         {nonan('regr_slope(g.gap, g.period)')} AS slope,
         {nonan('regr_intercept(g.gap, g.period)')} AS intercept,
         count(g.gap) AS n_points,
         max(CASE WHEN g.period = 2000 THEN g.gap END) AS gap_ref,
         {exact_slope_terms('g.gap', 'g.period')}
  FROM gap g
  JOIN entity_dim d ON g.entity = d.entity
  JOIN metric_dim m ON g.metric = m.metric
  WHERE g.period BETWEEN 1995 AND 2000
    AND m.bucket IN ('convergence', 'context_inverted')
    AND d.role IN ('subject', 'entrant', 'success')
  GROUP BY g.entity, g.metric
),
classified AS (
  SELECT t.*, {ENTITY_COLS}, {METRIC_COLS},
         {trajectory_case('t.slope', 'm.bucket')} AS status
  FROM closing_trend t
  LEFT JOIN entity_dim d ON t.entity = d.entity
  LEFT JOIN metric_dim m ON t.metric = m.metric
),
closing AS (
  SELECT *,
    CASE WHEN bucket = 'convergence' AND gap_ref >= 100 THEN 'already_closed'
         WHEN bucket = 'context_inverted' AND gap_ref <= 100 THEN 'already_closed'
         ELSE status END AS closure_status,
    CASE WHEN status = 'no_data' THEN NULL
         WHEN gap_ref IS NULL THEN NULL
         WHEN bucket = 'convergence' AND gap_ref >= 100 THEN 0
         WHEN bucket = 'context_inverted' AND gap_ref <= 100 THEN 0
         WHEN status <> 'catching_up' THEN NULL
         WHEN bucket = 'convergence' THEN {dround('(100 - gap_ref) / slope', 1)}
         WHEN bucket = 'context_inverted' THEN {dround('(gap_ref - 100) / abs(slope)', 1)}
    END AS years_to_close
  FROM classified
)
"""

ORACLE["years_to_close"] = (
    "WITH " + NATION_CTE.strip() + CLOSING_CTE + f"""
SELECT entity, entity_name, role, western, region, metric, friendly_name, bucket,
       n_points, {r('slope')} AS slope, {r('intercept', 4)} AS intercept, status,
       closure_status, {r('gap_ref')} AS gap_ref, {r('years_to_close')} AS years_to_close
FROM closing""")

DISPERSION_CTE = """,
disp_base AS (
  SELECT g.metric, g.period, g.gap
  FROM gap g JOIN entity_dim d ON g.entity = d.entity
  WHERE d.role = 'subject' AND g.metric IN ('AOV', 'URGENT_SHARE', 'LOW_AOV')
    AND g.period BETWEEN 1995 AND 2000
),
disp AS (
  SELECT metric, period, count(gap) AS n, avg(CAST(gap AS DOUBLE)) AS mean_gap,
         stddev_samp(CAST(gap AS DOUBLE)) AS sd_gap
  FROM disp_base GROUP BY metric, period
),
disp_cv AS (
  SELECT *, CASE WHEN mean_gap IS NULL OR mean_gap = 0 THEN NULL
                 ELSE sd_gap / mean_gap END AS cv_gap
  FROM disp
)
"""

ORACLE["dispersion"] = "WITH " + NATION_CTE.strip() + DISPERSION_CTE + f"""
SELECT metric, period, n, {r('mean_gap')} AS mean_gap, {r('sd_gap')} AS sd_gap,
       {r('cv_gap')} AS cv_gap
FROM disp_cv"""

ORACLE["descriptive_panel"] = with_nation(f"""
SELECT p.entity, {ENTITY_COLS}, p.metric, {METRIC_COLS}, p.period, {r('p.value')} AS value
FROM panel p
JOIN entity_dim d ON p.entity = d.entity
JOIN metric_dim m ON p.metric = m.metric
WHERE p.period BETWEEN 1995 AND 2000 AND d.role IN ('subject', 'entrant', 'success')""")


def nsql(body: str, *extra: str) -> str:
    """Nation-panel CTEs, extra CTE blocks (each starting with ',\\n'), body."""
    return "WITH " + NATION_CTE.strip() + "".join(extra) + "\n" + body


STUCK_CTE = f""",
stuck AS (
  SELECT t.entity, {ENTITY_COLS}, t.metric, {METRIC_COLS},
         t.gap_start, t.gap_end, t.gap_end - t.gap_start AS gap_change, t.slope,
         {stuck_case('t.slope', 'm.bucket')} AS status
  FROM trend t
  LEFT JOIN entity_dim d ON t.entity = d.entity
  LEFT JOIN metric_dim m ON t.metric = m.metric
)"""

RAW_CTE = """WITH raw AS (
  SELECT 'ORD' AS source, o.o_orderpriority AS metric, n.n_name AS entity,
         CAST(year(o.o_orderdate) AS INTEGER) AS period, avg(o.o_totalprice) AS value,
         CASE o.o_orderstatus WHEN 'F' THEN 'b1' WHEN 'O' THEN 'b2' WHEN 'P' THEN 'b3' END
           AS batch_id
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY ALL
)"""

EVENTS_CTE = """WITH ev_cells AS (
  SELECT CAST(user_id AS VARCHAR) AS entity, event_type AS metric,
         CAST(dayofyear(ts) AS INTEGER) AS period, sum(value) AS value
  FROM events GROUP BY ALL
),
ev_users AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS entity FROM events),
ev_metrics AS (
  SELECT * FROM (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) AS t(metric)
),
ev_periods AS (SELECT CAST(range AS INTEGER) AS period FROM range(1, 31)),
ev_grid AS (
  SELECT u.entity, m.metric, p.period
  FROM ev_users u CROSS JOIN ev_metrics m CROSS JOIN ev_periods p
),
ev_complete AS (
  SELECT g.entity, g.metric, g.period, c.value
  FROM ev_grid g LEFT JOIN ev_cells c
    ON g.entity = c.entity AND g.metric = c.metric AND g.period = c.period
)"""

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
NATION_METRIC_CODES = ("AOV", "URGENT_SHARE", "LOW_AOV", "ORDERS")


def span_text(first: str, last: str, n: str) -> str:
    return (f"CAST({first} AS VARCHAR) || '–' || CAST({last} AS VARCHAR) || ' (' || "
            f"CAST({n} AS VARCHAR) || ')'")


# --- display tables ------------------------------------------------------------
ORACLE["years_bucket"] = "WITH " + NATION_CTE.strip() + CLOSING_CTE + f"""
SELECT entity, metric, status, {r('years_to_close')} AS years_to_close,
  CASE WHEN status IN ('no_data', 'diverging', 'stalled') THEN replace(status, '_', ' ')
       WHEN years_to_close IS NULL THEN 'unknown'
       WHEN years_to_close = 0 THEN 'already closed'
       WHEN years_to_close < 20 THEN 'under 20 yrs'
       WHEN years_to_close <= 50 THEN '20-50 yrs'
       WHEN years_to_close <= 100 THEN '50-100 yrs'
       ELSE '100+ yrs' END AS years_bucket
FROM closing"""

ORACLE["status_grid"] = nsql("""
SELECT entity,
  CAST(max(CASE WHEN metric = 'AOV' THEN code END) AS INTEGER) AS AOV,
  CAST(max(CASE WHEN metric = 'URGENT_SHARE' THEN code END) AS INTEGER) AS URGENT_SHARE,
  CAST(max(CASE WHEN metric = 'LOW_AOV' THEN code END) AS INTEGER) AS LOW_AOV
FROM coded GROUP BY entity""", STUCK_CTE, """,
coded AS (
  SELECT entity, metric,
         CASE status WHEN 'catching_up' THEN 0 WHEN 'stuck' THEN 1
              WHEN 'falling_behind' THEN 2 WHEN 'no_data' THEN 3 END AS code
  FROM stuck
)""")

ORACLE["dispersion_shape"] = "WITH " + NATION_CTE.strip() + DISPERSION_CTE + f""",
dd AS (
  SELECT metric, period, cv_gap,
         cv_gap - lag(cv_gap) OVER (PARTITION BY metric ORDER BY period) AS d
  FROM disp_cv WHERE period BETWEEN 1995 AND 2000
),
agg AS (
  SELECT metric, max(CASE WHEN period = 1995 THEN cv_gap END) AS cv_start,
         max(CASE WHEN period = 2000 THEN cv_gap END) AS cv_end,
         max(cv_gap) AS cv_peak, min(cv_gap) AS cv_trough,
         coalesce(bool_and(d <= 0), true) AS monotone_down
  FROM dd GROUP BY metric
)
SELECT a.metric, {r('cv_start')} AS cv_start, {r('cv_end')} AS cv_end,
  {r('cv_peak')} AS cv_peak, {r('cv_trough')} AS cv_trough,
  (SELECT min(period) FROM dd WHERE dd.metric = a.metric AND dd.cv_gap = a.cv_peak) AS peak_period,
  (SELECT min(period) FROM dd WHERE dd.metric = a.metric AND dd.cv_gap = a.cv_trough)
    AS trough_period,
  monotone_down,
  {r('CASE WHEN cv_start IS NULL OR cv_start = 0 THEN NULL ELSE (cv_end - cv_start) / cv_start * 100 END')}
    AS change_pct
FROM agg a"""

ORACLE["balanced_panel"] = "WITH " + NATION_CTE.strip() + DISPERSION_CTE + """
SELECT metric, min(n) AS min_n, max(n) AS max_n, count(*) AS n_periods,
       min(n) = max(n) AS balanced
FROM disp_cv GROUP BY metric"""

# --- raw batches -------------------------------------------------------------------
ORACLE["latest_batch"] = RAW_CTE + f"""
SELECT metric, entity, period, {r('value')} AS value
FROM raw JOIN (SELECT source, max(batch_id) AS batch_id FROM raw GROUP BY source)
  USING (source, batch_id)"""

ORACLE["latest_per_key"] = RAW_CTE + f"""
SELECT metric, entity, period, {r('value')} AS value, batch_id
FROM (SELECT *, row_number() OVER (PARTITION BY metric, entity, period
                                   ORDER BY batch_id DESC) AS rn FROM raw)
WHERE rn = 1"""

# What lands through envelopes is the newest batch again; the stream numbers
# its batches from 0.
ORACLE["land_envelope"] = ORACLE["latest_batch"]

ORACLE["land_stream"] = f"""
SELECT metric, entity, period, value,
       'rec_' || lpad(CAST(CAST(substr(batch_id, 2) AS INTEGER) - 1 AS VARCHAR), 12, '0') AS batch_id
FROM ({ORACLE["latest_per_key"]})
"""

ORACLE["landing_rejects"] = RAW_CTE + """
SELECT CASE WHEN metric = '5-LOW' THEN 'no entity' ELSE 'unreadable period' END AS reject_reason,
       count(*) AS n_rows
FROM raw WHERE metric = '5-LOW' OR period = 1996
GROUP BY 1
"""

ORACLE["batch_conflicts"] = RAW_CTE + f"""
SELECT metric, entity, period, count(*) AS n_rows, count(value) AS n_values,
       {r('min(value)')} AS min_value, {r('max(value)')} AS max_value
FROM raw GROUP BY metric, entity, period
HAVING min(value) < max(value) OR (count(value) > 0 AND count(value) < count(*))"""

ORACLE["landing_report"] = RAW_CTE + """,
basket AS (
  SELECT * FROM (VALUES ('ORD', '1-URGENT'), ('ORD', '2-HIGH'), ('ORD', '3-MEDIUM'),
                        ('ORD', '4-NOT SPECIFIED'), ('ORD', '5-LOW')) AS t(source, metric)
),
batches AS (SELECT DISTINCT source, batch_id FROM raw),
counts AS (SELECT source, metric, batch_id, count(*) AS n FROM raw GROUP BY ALL)
SELECT b.source, b.metric, bt.batch_id, coalesce(c.n, 0) AS "rows",
       coalesce(c.n, 0) = 0 AS warn_empty
FROM basket b
JOIN batches bt ON b.source = bt.source
LEFT JOIN counts c ON c.source = b.source AND c.metric = b.metric AND c.batch_id = bt.batch_id"""

# --- events coverage ---------------------------------------------------------------
ORACLE["complete_grid"] = EVENTS_CTE + f"""
SELECT entity, metric, period, {r('value')} AS value FROM ev_complete"""

ORACLE["missing_cells"] = EVENTS_CTE + """
SELECT g.entity, g.metric, g.period FROM ev_grid g
WHERE NOT EXISTS (SELECT 1 FROM ev_cells c
                  WHERE c.entity = g.entity AND c.metric = g.metric AND c.period = g.period)"""

for _by in ("metric", "entity"):
    ORACLE[f"coverage_by_{_by}"] = EVENTS_CTE + f"""
SELECT {_by}, count(*) AS total_rows, count(value) AS non_null,
       count(*) - count(value) AS nulls
FROM ev_complete GROUP BY {_by}"""

ORACLE["coverage_span"] = EVENTS_CTE + """,
sp AS (
  SELECT entity, metric,
         min(CASE WHEN value IS NOT NULL THEN period END) AS first_period,
         max(CASE WHEN value IS NOT NULL THEN period END) AS last_period,
         count(value) AS n
  FROM ev_complete GROUP BY entity, metric
)
SELECT entity, metric, first_period, last_period, n,
       CASE WHEN n = 0 THEN 'NONE' ELSE """ + span_text("first_period", "last_period", "n") + """ END
         AS span
FROM sp"""

ORACLE["coverage_matrix"] = EVENTS_CTE + "\nSELECT entity, " + ", ".join(
    f"count(CASE WHEN metric = '{m}' THEN value END) AS {m}" for m in EVENT_TYPES
) + "\nFROM ev_complete GROUP BY entity"

ORACLE["wide_mean"] = EVENTS_CTE + "\nSELECT entity, period, " + ", ".join(
    f"{r(f'avg(CASE WHEN metric = {chr(39)}{m}{chr(39)} THEN value END)')} AS {m}"
    for m in EVENT_TYPES) + "\nFROM ev_cells GROUP BY entity, period"

ORACLE["candidate_screen"] = EVENTS_CTE + """,
per AS (SELECT metric, entity, count(value) AS nn FROM ev_complete GROUP BY metric, entity)
SELECT metric, count(*) AS n_entities,
       CAST(sum(CASE WHEN nn = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_empty,
       min(nn) AS min_non_null,
       sum(CASE WHEN nn = 0 THEN 1 ELSE 0 END) = 0 AS keep
FROM per GROUP BY metric"""

# --- profiles --------------------------------------------------------------------------
ORACLE["profile"] = nsql(f"""
SELECT metric, {dround('min(gap)', 1)} AS "min", {dround('max(gap)', 1)} AS "max",
       {dround('avg(gap)', 1)} AS mean, count(gap) AS "count"
FROM gap GROUP BY metric""")

ORACLE["nulls_by_metric"] = nsql("""
SELECT metric, CAST(sum(CASE WHEN gap IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls
FROM gap GROUP BY metric HAVING sum(CASE WHEN gap IS NULL THEN 1 ELSE 0 END) > 0""")

ORACLE["rows_per_entity"] = nsql("""
SELECT entity, count(*) AS "rows" FROM gap GROUP BY entity""")

ORACLE["distinct_keys"] = nsql("SELECT DISTINCT entity FROM gap")

ORACLE["axis_range"] = nsql(f"""
SELECT {r('min(gap)')} AS axis_min, {r('max(gap)')} AS axis_max FROM gap""")

# --- cohorts and tiers --------------------------------------------------------------
ORACLE["cohort_means"] = nsql(f"""
SELECT western, {r('avg(gap_change)')} AS mean, count(gap_change) AS "count"
FROM stuck
WHERE role IN ('subject', 'entrant', 'success') AND metric = 'AOV'
GROUP BY western""", STUCK_CTE)

_ta = "avg(CASE WHEN d.role = 'subject' THEN g.gap END)"
_tb = "avg(CASE WHEN d.role = 'entrant' THEN g.gap END)"
ORACLE["tier_gap"] = nsql(f"""
SELECT g.metric, g.period, {r(_ta)} AS mean_a, {r(_tb)} AS mean_b,
       {r(f'{_tb} - {_ta}')} AS tier_gap
FROM gap g JOIN entity_dim d ON g.entity = d.entity
WHERE g.metric = 'AOV' AND g.period BETWEEN 1995 AND 2000
GROUP BY g.metric, g.period""")

ORACLE["mean_gain"] = nsql(f"""
SELECT metric, {r('avg(gap_change)')} AS mean_gain, count(gap_change) AS n
FROM stuck WHERE role IN ('subject') AND metric IN ('AOV', 'LOW_AOV')
GROUP BY metric""", STUCK_CTE)

# --- ordered operators --------------------------------------------------------------
ORACLE["delta"] = nsql(f"""
SELECT entity, metric, period, {r('gap1')} AS gap,
       {r('gap1 - lag(gap1) OVER (PARTITION BY entity, metric ORDER BY period)')} AS delta
FROM g1""", f""",
g1 AS (SELECT entity, metric, period, {dround('gap', 1)} AS gap1 FROM gap)""")

ORACLE["spikes"] = nsql(f"""
SELECT entity, metric, period, {r('gap')} AS gap, {r('delta_in')} AS delta_in,
       {r('delta_out')} AS delta_out
FROM sp
WHERE sign(delta_in) * sign(delta_out) < 0 AND abs(delta_in) > 5.0 AND abs(delta_out) > 5.0""",
                        """,
sp AS (
  SELECT entity, metric, period, gap,
         gap - lag(gap) OVER (PARTITION BY entity, metric ORDER BY period) AS delta_in,
         lead(gap) OVER (PARTITION BY entity, metric ORDER BY period) - gap AS delta_out
  FROM gap_mart
)""")

SHAPE_CTE = """,
ss AS (
  SELECT entity, metric, period, gap,
         gap - lag(gap) OVER (PARTITION BY entity, metric ORDER BY period) AS d
  FROM gap WHERE period BETWEEN 1995 AND 2000
),
sa AS (
  SELECT entity, metric, max(gap) AS peak, min(gap) AS trough,
         coalesce(bool_and(d >= 0), true) AS never_falls,
         coalesce(bool_and(d <= 0), true) AS never_rises
  FROM ss GROUP BY entity, metric
)"""

ORACLE["series_shape"] = nsql(f"""
SELECT sa.entity, sa.metric, {r('peak')} AS peak,
  (SELECT min(period) FROM ss WHERE ss.entity = sa.entity AND ss.metric = sa.metric
     AND ss.gap = sa.peak) AS peak_period,
  {r('trough')} AS trough,
  (SELECT min(period) FROM ss WHERE ss.entity = sa.entity AND ss.metric = sa.metric
     AND ss.gap = sa.trough) AS trough_period,
  CASE WHEN peak IS NOT NULL THEN never_falls END AS never_falls,
  CASE WHEN peak IS NOT NULL THEN never_rises END AS never_rises
FROM sa""", SHAPE_CTE)

ORACLE["last_value"] = nsql(f"""
SELECT lv.entity, lv.metric, lv.last_period, {r('g.gap')} AS last_value
FROM (SELECT entity, metric, max(period) AS last_period FROM gap GROUP BY entity, metric) lv
JOIN gap g ON g.entity = lv.entity AND g.metric = lv.metric AND g.period = lv.last_period""")


def _txt(x: str) -> str:
    return (f"coalesce(CAST(CAST(round(CAST({x} AS DECIMAL(28,10)), 1) AS DECIMAL(28,1)) "
            f"AS VARCHAR), 'NA')")


_va = "max(CASE WHEN period = 1995 THEN gap END)"
_vb = "max(CASE WHEN period = 2000 THEN gap END)"
ORACLE["endpoints"] = nsql(f"""
SELECT entity, metric, {r(_va)} AS value_a, {r(_vb)} AS value_b,
       {_txt(_va)} AS text_a, {_txt(_vb)} AS text_b
FROM gap GROUP BY entity, metric""")

_after_y = "CASE WHEN s.period >= p.peak_period THEN s.gap END"
_after_x = "CASE WHEN s.period >= p.peak_period THEN s.period END"
ORACLE["slope_since_peak"] = nsql(f"""
SELECT p.entity, p.metric, p.peak_period, {r('p.peak')} AS peak,
       {r(nonan(f'regr_slope({_after_y}, {_after_x})'))} AS slope_since_peak,
       count({_after_y}) AS n_since_peak
FROM pkp p JOIN sp0 s ON s.entity = p.entity AND s.metric = p.metric
GROUP BY p.entity, p.metric, p.peak_period, p.peak""", """,
sp0 AS (SELECT entity, metric, period, gap FROM gap WHERE period BETWEEN 1995 AND 2000),
pk AS (SELECT entity, metric, max(gap) AS peak FROM sp0 GROUP BY entity, metric),
pkp AS (
  SELECT pk.entity, pk.metric, pk.peak,
         (SELECT min(period) FROM sp0 WHERE sp0.entity = pk.entity AND sp0.metric = pk.metric
            AND sp0.gap = pk.peak) AS peak_period
  FROM pk
)""")

ORACLE["to_wide"] = nsql("SELECT entity, period, " + ", ".join(
    f"{r(f'max(CASE WHEN metric = {chr(39)}{m}{chr(39)} THEN gap END)')} AS {m}"
    for m in NATION_METRIC_CODES) + " FROM gap GROUP BY entity, period")

_next = ("(SELECT min(s2.value) FROM snap s2 WHERE s2.metric = s.metric "
         "AND s2.value > s.value)")
ORACLE["snapshot_rank"] = nsql(f"""
SELECT entity, metric, period, {r('value')} AS value,
       CAST(rank() OVER (PARTITION BY metric ORDER BY value) AS INTEGER) AS rank,
       {r('percent_rank() OVER (PARTITION BY metric ORDER BY value)')} AS percent_rank,
       {r(_next)} AS next_value, {r(f'{_next} - s.value')} AS margin_to_next
FROM snap s""", """,
snap AS (
  SELECT entity, metric, period, value FROM panel
  WHERE period = 2000 AND value IS NOT NULL AND entity <> 'ALL'
)""")

ORACLE["top_extremes"] = nsql(f"""
SELECT entity, metric, period, {r('gap')} AS gap, rnk AS rank
FROM (SELECT entity, metric, period, gap,
             CAST(row_number() OVER (PARTITION BY metric ORDER BY gap DESC, entity, period)
                  AS INTEGER) AS rnk
      FROM gap WHERE gap IS NOT NULL AND entity <> 'ALL')
WHERE rnk <= 3""")

ORACLE["last_n_periods"] = nsql(f"""
SELECT p.entity, p.metric, p.period, {r('p.value')} AS value
FROM (SELECT *, dense_rank() OVER (PARTITION BY metric ORDER BY period DESC) AS n FROM panel) p
WHERE n <= 3""")

# --- trend analyses --------------------------------------------------------------------
ORACLE["loo_slope"] = nsql(f"""
SELECT a.entity, a.metric, a.period AS left_out, {r('a.gap')} AS gap,
       {r(nonan('regr_slope(b.gap, b.period)'))} AS loo_slope,
       count(b.gap) AS n_remaining
FROM pts a LEFT JOIN pts b
  ON a.entity = b.entity AND a.metric = b.metric AND b.period <> a.period
GROUP BY a.entity, a.metric, a.period, a.gap""", """,
pts AS (SELECT entity, metric, period, gap FROM gap
        WHERE period BETWEEN 1995 AND 2000 AND gap IS NOT NULL)""")

_ratio = "CASE WHEN slope * 5 = 0 THEN NULL ELSE gap_change / (slope * 5) END"
ORACLE["endpoint_vs_trend"] = nsql(f"""
SELECT entity, metric, {r('gap_change')} AS gap_change, {r('slope')} AS slope,
       {r('slope * 5')} AS trend_change, {r(_ratio)} AS ratio,
       {r(f'({dround(_ratio, 6)} - 1) * 100')} AS pct_diff
FROM stuck""", STUCK_CTE)

ORACLE["abs_slope_stats"] = nsql(f"""
SELECT bucket, count(*) AS n, {r('avg(abs(slope))')} AS mean_abs_slope,
       {r('min(abs(slope))')} AS min_abs_slope
FROM stuck WHERE bucket IN ('convergence', 'context_inverted') AND slope IS NOT NULL
GROUP BY bucket""", STUCK_CTE)

_band = ("CASE bucket WHEN 'convergence' THEN CAST(0.2 AS DOUBLE) "
         "WHEN 'context_inverted' THEN CAST(2.0 AS DOUBLE) END")
ORACLE["band_margin"] = nsql(f"""
SELECT entity, metric, bucket, {r('slope')} AS slope, status, {r(_band)} AS band,
       {r(f'abs(slope) - {_band}')} AS margin
FROM stuck WHERE bucket IN ('convergence', 'context_inverted') AND slope IS NOT NULL""",
                             STUCK_CTE)

PAIR_CTE = """,
mp AS (
  SELECT entity,
         max(CASE WHEN metric = 'AOV' THEN gap_ref END) AS gap_ref_a,
         max(CASE WHEN metric = 'AOV' THEN years_to_close END) AS years_a,
         max(CASE WHEN metric = 'LOW_AOV' THEN gap_ref END) AS gap_ref_b,
         max(CASE WHEN metric = 'LOW_AOV' THEN years_to_close END) AS years_b
  FROM closing WHERE metric IN ('AOV', 'LOW_AOV') GROUP BY entity
)"""
_pair_cols = (f"entity, {r('gap_ref_a')} AS gap_ref_a, {r('years_a')} AS years_a, "
              f"{r('gap_ref_b')} AS gap_ref_b, {r('years_b')} AS years_b")
_scen = ("CASE WHEN (100 - gap_ref_a) = 0 THEN NULL "
         "ELSE (100 - gap_ref_b) * years_a / (100 - gap_ref_a) END")
ORACLE["scenario_years"] = "WITH " + NATION_CTE.strip() + CLOSING_CTE + PAIR_CTE + f"""
SELECT {_pair_cols}, {r(dround(_scen, 1))} AS scenario_years
FROM mp WHERE years_b IS NOT NULL"""

ORACLE["metric_ratio"] = "WITH " + NATION_CTE.strip() + CLOSING_CTE + PAIR_CTE + f"""
SELECT {_pair_cols},
       {r('CASE WHEN years_a = 0 THEN NULL ELSE years_b / years_a END')} AS ratio
FROM mp"""

ORACLE["classifier_agreement"] = ("WITH " + NATION_CTE.strip() + STUCK_CTE + CLOSING_CTE + """
SELECT s.entity, s.metric, s.status AS status_stuck, c.status AS status_trajectory,
       (CASE s.status WHEN 'falling_behind' THEN 'diverging' WHEN 'stuck' THEN 'stalled'
             ELSE s.status END) = c.status AS agree
FROM stuck s JOIN closing c ON s.entity = c.entity AND s.metric = c.metric""")

# --- comparisons -------------------------------------------------------------------------
ORACLE["dominance"] = nsql("""
SELECT metric,
       CASE WHEN count(*) FILTER (above = 0) > 0 THEN FALSE
            WHEN count(above) = count(*) THEN TRUE END AS always_above,
       min(CASE WHEN above = 1 AND before = 0 THEN period END) AS first_overtake,
       count(*) AS n_periods
FROM (SELECT *, last_value(above IGNORE NULLS) OVER (
               PARTITION BY metric ORDER BY period
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM both_sides)
GROUP BY metric""", """,
both_sides AS (
  SELECT metric, period,
         sign(max(CASE WHEN entity = 'NATION_8' THEN gap END)
              - max(CASE WHEN entity = 'NATION_2' THEN gap END)) > 0 AS is_above,
         CAST(is_above AS INTEGER) AS above
  FROM gap WHERE entity IN ('NATION_8', 'NATION_2') GROUP BY metric, period)""")

ORACLE["rank_reversal"] = nsql("""
SELECT a.entity, a.rk AS rank_a, b.rk AS rank_b, b.rk - a.rk AS rank_shift
FROM rk a JOIN rk b ON a.entity = b.entity
WHERE a.metric = 'AOV' AND b.metric = 'URGENT_SHARE'""", """,
snap AS (
  SELECT entity, metric, value FROM panel
  WHERE period = 2000 AND value IS NOT NULL AND metric IN ('AOV', 'URGENT_SHARE')
    AND entity <> 'ALL'
),
rk AS (SELECT entity, metric,
              CAST(rank() OVER (PARTITION BY metric ORDER BY value) AS INTEGER) AS rk
       FROM snap)""")

_below = ("(SELECT count(*) FROM tp r WHERE r.role = 'core' AND r.metric = s.metric "
          "AND r.period = s.period AND r.value < s.value)")
_refn = ("(SELECT count(*) FROM tp r WHERE r.role = 'core' AND r.metric = s.metric "
         "AND r.period = s.period)")
ORACLE["tier_position"] = nsql(f"""
SELECT s.entity, s.role, s.metric, s.period, {r('s.value')} AS value,
       {_below} AS ref_below, {_refn} AS ref_n,
       {r(f'CASE WHEN {_refn} > 0 THEN {_below} / {_refn} END')} AS ref_share_below
FROM tp s WHERE s.role IN ('subject', 'entrant', 'success')""", """,
tp AS (
  SELECT p.entity, d.role, p.metric, p.period, p.value
  FROM panel p JOIN entity_dim d ON p.entity = d.entity
  WHERE p.value IS NOT NULL AND d.role IN ('core', 'subject', 'entrant', 'success')
)""")

ORACLE["benchmark_breaks"] = nsql(f"""
SELECT metric, period, {r('value')} AS value, {r('prv')} AS prev, {r('nxt')} AS "next"
FROM bb WHERE value - prv < 0 AND nxt >= prv""", """,
bb AS (
  SELECT metric, period, value,
         lag(value) OVER (PARTITION BY metric ORDER BY period) AS prv,
         lead(value) OVER (PARTITION BY metric ORDER BY period) AS nxt
  FROM panel WHERE entity = 'ALL'
)""")

# --- landing / functions ----------------------------------------------------------------
ORACLE["parse_period"] = f"""
SELECT 'AOV' AS metric, n.n_name AS entity, CAST(year(o.o_orderdate) AS INTEGER) AS period,
       {r('avg(o.o_totalprice)')} AS value, true AS period_ok
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name, year(o.o_orderdate)"""

ORACLE["flatten_props"] = """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"""

ORACLE["label_search"] = """
SELECT n.n_name, r.r_name, regexp_replace(n.n_name, '^NATION_', '') AS code,
       concat_ws(' / ', r.r_name, n.n_name) AS label
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE lower(r.r_name) LIKE '%europ%' OR n.n_name IN ('NATION_0', 'NATION_1')"""

# --- data quality ---------------------------------------------------------------------------
_GAP_MART_COLS = ("entity, entity_name, role, western, region, metric, friendly_name, bucket, "
                  f"period, {r('value')} AS value, {r('bench_value')} AS bench_value, "
                  f"{r('gap')} AS gap")
_STUCK_COLS = ("entity, entity_name, role, western, region, metric, friendly_name, bucket, "
               f"{r('gap_start')} AS gap_start, {r('gap_end')} AS gap_end, "
               f"{r('gap_change')} AS gap_change, {r('slope')} AS slope, status")
_CLOSING_COLS = ("entity, entity_name, role, western, region, metric, friendly_name, bucket, "
                 f"n_points, {r('slope')} AS slope, {r('intercept', 4)} AS intercept, status, "
                 f"closure_status, {r('gap_ref')} AS gap_ref, "
                 f"{r('years_to_close')} AS years_to_close")
_NAT_ALL = "WITH " + NATION_CTE.strip() + STUCK_CTE + CLOSING_CTE

DQ_SQL = {
    "dq_not_null": (_NAT_ALL, f"SELECT {_GAP_MART_COLS} FROM gap_mart WHERE gap IS NULL"),
    "dq_accepted_values": (_NAT_ALL, """SELECT status, count(*) AS n_rows FROM closing
WHERE status IS NOT NULL AND status NOT IN
  ('catching_up', 'falling_behind', 'stuck', 'no_data', 'not_classified')
GROUP BY status"""),
    "dq_unique": (_NAT_ALL, """SELECT role, count(*) AS n_rows FROM entity_dim
WHERE role IS NOT NULL GROUP BY role HAVING count(*) > 1"""),
    "dq_grain_unique": (RAW_CTE, """SELECT metric, entity, period, count(*) AS n_rows FROM raw
GROUP BY metric, entity, period HAVING count(*) > 1"""),
    "dq_row_count": (RAW_CTE, """SELECT count(*) AS n_rows FROM raw
WHERE batch_id = (SELECT max(batch_id) FROM raw) HAVING count(*) <> 875"""),
    "dq_only_known_nulls": (_NAT_ALL, f"""SELECT entity, metric, period, {r('value')} AS value
FROM panel WHERE period BETWEEN 1995 AND 2000 AND value IS NULL
  AND NOT (entity = 'NATION_3' AND metric = 'LOW_AOV')"""),
    "dq_status_scoping": (_NAT_ALL, f"""SELECT {_STUCK_COLS} FROM stuck WHERE
  (bucket = 'context' AND status <> 'not_classified')
  OR (bucket IN ('convergence', 'context_inverted')
      AND status NOT IN ('catching_up', 'falling_behind', 'stuck', 'no_data'))
  OR (status = 'no_data' AND slope IS NOT NULL)
  OR (status <> 'no_data' AND bucket <> 'context' AND slope IS NULL)"""),
    "dq_closing_time_valid": (_NAT_ALL, f"""SELECT {_CLOSING_COLS} FROM closing WHERE
  years_to_close < 0
  OR (closure_status = 'already_closed' AND years_to_close IS DISTINCT FROM 0)"""),
    "dq_closing_time_null_scoping": (_NAT_ALL, f"""SELECT {_CLOSING_COLS} FROM closing WHERE
  (years_to_close = 0 AND closure_status <> 'already_closed')
  OR (closure_status <> 'already_closed' AND status IN ('stalled', 'diverging', 'no_data')
      AND years_to_close IS NOT NULL)
  OR (closure_status <> 'already_closed' AND status = 'catching_up'
      AND years_to_close IS NULL)"""),
}
for _k, (_with, _body) in DQ_SQL.items():
    ORACLE[_k] = _with + "\n" + _body

_GM_COLS = ("entity", "entity_name", "role", "western", "region", "metric", "friendly_name",
            "bucket", "period", "value", "bench_value", "gap")
ORACLE["dq_null_counts"] = nsql("\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM gap_mart"
    for c in _GM_COLS))

_DQ_TABLES = {"dq_not_null": ("not_null", "gap"), "dq_accepted_values": ("accepted_values", "closing"),
              "dq_unique": ("unique", "entity_dim"), "dq_grain_unique": ("grain_unique", "raw"),
              "dq_row_count": ("row_count", "latest_batch"),
              "dq_only_known_nulls": ("only_known_nulls", "panel"),
              "dq_status_scoping": ("status_scoping", "stuck"),
              "dq_closing_time_valid": ("closing_time_valid", "closing"),
              "dq_closing_time_null_scoping": ("closing_time_null_scoping", "closing")}
_RAW_BODY = RAW_CTE[len("WITH "):]
ORACLE["dq_report"] = ("WITH " + NATION_CTE.strip() + STUCK_CTE + CLOSING_CTE + ",\n"
                       + _RAW_BODY + "\n" + "\nUNION ALL\n".join(
                           f"SELECT '{chk}' AS \"check\", '{tab}' AS \"table\", "
                           f"count(*) AS n_violations FROM ({DQ_SQL[k][1]})"
                           for k, (chk, tab) in _DQ_TABLES.items()))


# --- many-entity panels --------------------------------------------------------------
PART_CTE = """WITH li AS (
  SELECT l_partkey, CAST(year(l_shipdate) AS INTEGER) AS period, l_extendedprice,
         l_discount, l_returnflag
  FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '1995-01-01 00:00:00'
    AND l_shipdate < TIMESTAMP '2002-01-01 00:00:00'
),
pcells AS (
  SELECT CASE WHEN GROUPING(l_partkey) = 1 THEN 'ALL' ELSE CAST(l_partkey AS VARCHAR) END
           AS entity, period,
         avg(l_extendedprice) AS avg_price,
         avg(CASE WHEN l_returnflag = 'R' THEN CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)
           AS return_share,
         avg(l_discount * 100) AS discount
  FROM li GROUP BY GROUPING SETS ((l_partkey, period), (period))
),
panel AS (
  SELECT entity, 'AVG_PRICE' AS metric, period, avg_price AS value FROM pcells
  UNION ALL SELECT entity, 'RETURN_SHARE', period, return_share FROM pcells
  UNION ALL SELECT entity, 'DISCOUNT', period, discount FROM pcells
),
metric_dim AS (
  SELECT * FROM (VALUES
    ('AVG_PRICE', 'Average line price', 'convergence'),
    ('RETURN_SHARE', 'Returned line share (%)', 'context_inverted'),
    ('DISCOUNT', 'Average discount (%)', 'context')) AS t(metric, friendly_name, bucket)
),""" + NATION_CTE[NATION_CTE.index("bench AS ("):NATION_CTE.index("gap_mart AS (")] + """
trend AS (
  SELECT entity, metric,
         """ + nonan("regr_slope(gap, period)") + """ AS slope,
         """ + nonan("regr_intercept(gap, period)") + """ AS intercept,
         count(gap) AS n_points,
         max(CASE WHEN period = 1995 THEN gap END) AS gap_start,
         max(CASE WHEN period = 2001 THEN gap END) AS gap_end,
         max(CASE WHEN period = 2001 THEN gap END) AS gap_ref,
         """ + exact_slope_terms() + """
  FROM gap WHERE period BETWEEN 1995 AND 2001
  GROUP BY entity, metric
)"""

ORACLE["dq_nulls_unlisted"] = nsql("SELECT * FROM panel WHERE value IS NULL")

ORACLE["dq_spoilt_status"] = "WITH " + NATION_CTE.strip() + STUCK_CTE + """
SELECT entity, metric FROM stuck
WHERE (entity = 'NATION_0' AND bucket <> 'context')
   OR (entity = 'NATION_1' AND (slope IS NOT NULL OR bucket = 'context'))
"""

ORACLE["dq_spoilt_time"] = "WITH " + NATION_CTE.strip() + CLOSING_CTE + """
SELECT entity, metric FROM closing
WHERE closure_status = 'already_closed' OR years_to_close > 0
"""

ORACLE["dq_spoilt_nulls"] = "WITH " + NATION_CTE.strip() + CLOSING_CTE + """
-- a row without a reference gap has no figure to begin with
SELECT entity, metric FROM closing
WHERE closure_status <> 'already_closed' AND (status = 'catching_up') = (years_to_close IS NOT NULL)
"""

ORACLE["part_gap"] = PART_CTE + f"""
SELECT entity, metric, period, {r('value')} AS value, {r('bench_value')} AS bench_value,
       {r('gap')} AS gap
FROM gap"""

ORACLE["part_stuck_matrix"] = PART_CTE + f"""
SELECT t.entity, t.metric, m.friendly_name, m.bucket,
       {r('t.gap_start')} AS gap_start, {r('t.gap_end')} AS gap_end,
       {r('t.gap_end - t.gap_start')} AS gap_change, {r('t.slope')} AS slope,
       {stuck_case('t.slope', 'm.bucket')} AS status
FROM trend t LEFT JOIN metric_dim m ON t.metric = m.metric"""

_pyc = "(100 - t.gap_ref)"
ORACLE["part_years_to_close"] = PART_CTE + f""",
pc AS (
  SELECT t.entity, t.metric, m.friendly_name, m.bucket, t.n_points, t.slope, t.intercept,
         t.gap_ref, {trajectory_case('t.slope', 'm.bucket')} AS status
  FROM trend t JOIN metric_dim m ON t.metric = m.metric
  WHERE m.bucket IN ('convergence', 'context_inverted')
)
SELECT entity, metric, friendly_name, bucket, n_points, {r('slope')} AS slope,
  {r('intercept', 4)} AS intercept, status,
  CASE WHEN bucket = 'convergence' AND gap_ref >= 100 THEN 'already_closed'
       WHEN bucket = 'context_inverted' AND gap_ref <= 100 THEN 'already_closed'
       ELSE status END AS closure_status,
  {r('gap_ref')} AS gap_ref,
  {r(f'''CASE WHEN status = 'no_data' THEN NULL
       WHEN gap_ref IS NULL THEN NULL
       WHEN bucket = 'convergence' AND gap_ref >= 100 THEN 0
       WHEN bucket = 'context_inverted' AND gap_ref <= 100 THEN 0
       WHEN status <> 'catching_up' THEN NULL
       WHEN bucket = 'convergence' THEN {dround('(100 - gap_ref) / slope', 1)}
       WHEN bucket = 'context_inverted' THEN {dround('(gap_ref - 100) / abs(slope)', 1)}
  END''')} AS years_to_close
FROM pc"""

ORACLE["part_dispersion"] = PART_CTE + f"""
SELECT metric, period, count(gap) AS n, {r('avg(gap)')} AS mean_gap,
       {r('stddev_samp(gap)')} AS sd_gap,
       {r('CASE WHEN avg(gap) IS NULL OR avg(gap) = 0 THEN NULL ELSE stddev_samp(gap) / avg(gap) END')}
         AS cv_gap
FROM gap
WHERE entity <> 'ALL' AND metric IN ('AVG_PRICE', 'RETURN_SHARE') AND period BETWEEN 1995 AND 2001
GROUP BY metric, period"""

ORACLE["events_gap"] = f"""WITH ev_cells AS (
  SELECT CAST(user_id AS VARCHAR) AS entity, event_type AS metric,
         CAST(dayofyear(ts) AS INTEGER) AS period, sum(value) AS value
  FROM events GROUP BY ALL
),
panel AS (
  SELECT * FROM ev_cells
  UNION ALL
  SELECT 'ALL', metric, period, avg(value) FROM ev_cells GROUP BY metric, period
),
bench AS (SELECT metric, period, value AS bench_value FROM panel WHERE entity = 'ALL'),
gap AS (
  SELECT p.entity, p.metric, p.period, p.value, b.bench_value,
         CASE WHEN b.bench_value IS NULL OR b.bench_value = 0 THEN NULL
              ELSE {dround('p.value / b.bench_value * 100', 2)} END AS gap
  FROM panel p LEFT JOIN bench b ON p.metric = b.metric AND p.period = b.period
)
SELECT entity, metric, period, {r('value')} AS value, {r('bench_value')} AS bench_value,
       {r('gap')} AS gap
FROM gap"""


ORACLE["snapshot_top"] = nsql("SELECT entity, " + ", ".join(
    f"{r(f'max(CASE WHEN metric = {chr(39)}{m}{chr(39)} THEN gap END)')} AS {m}"
    for m in NATION_METRIC_CODES) + """
FROM gap WHERE period = 2000 GROUP BY entity
ORDER BY max(CASE WHEN metric = 'AOV' THEN gap END) DESC NULLS LAST, entity
LIMIT 5""")

ORACLE["superseded_keys"] = RAW_CTE + """,
newest AS (SELECT metric, entity, period FROM raw WHERE batch_id = (SELECT max(batch_id) FROM raw)),
older AS (SELECT DISTINCT metric, entity, period FROM raw
          WHERE batch_id <> (SELECT max(batch_id) FROM raw))
SELECT o.metric, o.entity, o.period FROM older o
WHERE NOT EXISTS (SELECT 1 FROM newest n WHERE n.metric = o.metric AND n.entity = o.entity
                  AND n.period = o.period)"""

ORACLE["scope_to_basket"] = RAW_CTE + f"""
SELECT r.metric, r.entity, r.period, {r('r.value')} AS value
FROM raw r
JOIN nation n ON r.entity = n.n_name
JOIN region g ON n.n_regionkey = g.r_regionkey
WHERE r.batch_id = (SELECT max(batch_id) FROM raw)
  AND g.r_name IN ('EUROPE', 'ASIA')
  AND r.metric IN ('1-URGENT', '5-LOW')
  AND r.period BETWEEN 1996 AND 1999"""


ORACLE["abs_slope_ratio"] = nsql(f"""
SELECT {r("avg(CASE WHEN bucket = 'context_inverted' THEN abs(slope) END)")} AS mean_num,
       {r("avg(CASE WHEN bucket = 'convergence' THEN abs(slope) END)")} AS mean_den,
       {r("min(CASE WHEN bucket = 'context_inverted' THEN abs(slope) END)")} AS min_num,
       {r('''CASE WHEN avg(CASE WHEN bucket = 'convergence' THEN abs(slope) END) = 0 THEN NULL
             ELSE avg(CASE WHEN bucket = 'context_inverted' THEN abs(slope) END)
                  / avg(CASE WHEN bucket = 'convergence' THEN abs(slope) END) END''')} AS ratio
FROM stuck""", STUCK_CTE)

_ga = "avg(CASE WHEN metric = 'AOV' THEN gap_change END)"
_gb = "avg(CASE WHEN metric = 'LOW_AOV' THEN gap_change END)"
ORACLE["mean_gain_ratio"] = nsql(f"""
SELECT {r(_ga)} AS mean_a, {r(_gb)} AS mean_b,
       {r(f'CASE WHEN {_gb} = 0 THEN NULL ELSE {_ga} / {_gb} END')} AS ratio
FROM stuck WHERE role = 'subject'""", STUCK_CTE)

ORACLE["top_abs_extremes"] = nsql(f"""
SELECT entity, metric, period, {r('gap')} AS gap, rnk AS rank
FROM (SELECT entity, metric, period, gap,
             CAST(row_number() OVER (PARTITION BY metric ORDER BY abs(gap - 100) DESC, entity, period)
                  AS INTEGER) AS rnk
      FROM gap WHERE gap IS NOT NULL AND entity <> 'ALL')
WHERE rnk <= 6""")

ORACLE["level_shift"] = nsql(f"""
SELECT metric, {r('avg(CASE WHEN period < 1998 THEN value END)')} AS mean_before,
       {r('avg(CASE WHEN period >= 1998 THEN value END)')} AS mean_after,
       {r('avg(CASE WHEN period >= 1998 THEN value END) - avg(CASE WHEN period < 1998 THEN value END)')}
         AS shift
FROM panel WHERE entity = 'ALL' GROUP BY metric""")
