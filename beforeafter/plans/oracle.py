"""SQL that answers the registered queries, for comparison in DuckDB."""

from __future__ import annotations


def r4(expr: str) -> str:
    return f"floor(round({expr}, 8) * 10000 + 0.5) / 10000"


def _cents(col: str) -> str:
    return f"CAST(round({col} * 100) AS BIGINT)"


_BUYERS = "buyers AS (SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey)"

_P_ORD = f"""p_ord AS (
  SELECT 'ORD' AS source, n_name AS entity, o_orderpriority AS indicator,
         CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INTEGER) AS time,
         CAST(sum({_cents('o_totalprice')}) AS DOUBLE) / 100.0 AS value
  FROM orders JOIN buyers ON o_custkey = c_custkey GROUP BY ALL)"""


def _p_items(name: str, code: str) -> str:
    return f"""{name} AS (
  SELECT 'LI' AS source, n_name AS entity, {code} AS indicator,
         CAST(year(l_shipdate) * 12 + month(l_shipdate) AS INTEGER) AS time,
         CAST(sum({_cents('l_extendedprice')}) AS DOUBLE) / 100.0 / count(l_extendedprice) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN buyers ON o_custkey = c_custkey
       JOIN part ON l_partkey = p_partkey GROUP BY ALL)"""


_P_LI = _p_items("p_li", "'B.' || p_brand")
_P_FLAG = _p_items("p_flag", "'B.' || p_brand || '.' || l_returnflag")
_PANEL = f"{_BUYERS}, {_P_ORD}, {_P_LI}, panel AS (SELECT * FROM p_ord UNION ALL SELECT * FROM p_li)"

_P_RAW = """p_raw AS (
  SELECT 'EV' AS source, CAST(user_id AS VARCHAR) AS entity, event_type AS indicator,
         CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS time, value FROM events)"""
_P_EV = f"""{_P_RAW}, p_ev AS (
  SELECT source, entity, indicator, time, CAST(sum({_cents('value')}) AS DOUBLE) / 100.0 AS value
  FROM p_raw GROUP BY ALL)"""

_E_NAT = "ev AS (SELECT n_name AS entity, CAST(1998 * 12 + n_nationkey AS INTEGER) AS event_at FROM nation)"
_E_USR = """ev AS (
  SELECT CAST(user_id AS VARCHAR) AS entity,
         CAST(min(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE))) AS INTEGER) AS event_at
  FROM events WHERE event_type = 'signup' GROUP BY user_id)"""


def _window(panel: str) -> str:
    return f"""win AS (
  SELECT p.entity, event_at, time - event_at AS "offset", time, indicator, source, value
  FROM {panel} p JOIN ev ON p.entity = ev.entity AND time BETWEEN event_at - 6 AND event_at + 6)"""


def _change(keys: str = "entity, event_at, source, indicator", panel: str = "panel") -> str:
    on = " AND ".join(f"w.{k} = b.{k}" for k in keys.split(", "))
    return f"""{_window(panel)}, base AS (
  SELECT {keys}, avg(value) AS baseline_value FROM win WHERE "offset" IN (-3, -2, -1) GROUP BY {keys}),
change AS (
  SELECT w.entity, w.event_at, "offset", time, w.indicator, w.source, value, baseline_value,
         CASE WHEN baseline_value <> 0 THEN (value - baseline_value) / abs(baseline_value) * 100.0 END AS pct_change
  FROM win w LEFT JOIN base b ON {on})"""


_CHANGE_COLUMNS = f"""entity, event_at, "offset", time, indicator, source, {r4('value')} AS value,
       {r4('baseline_value')} AS baseline_value, {r4('pct_change')} AS pct_change"""


def _means(panel: str, before: int) -> str:
    return f"""means AS (
  SELECT ev.entity, event_at, indicator, avg(value) AS avg_value, count(value) AS n_values
  FROM {panel} p JOIN ev ON p.entity = ev.entity AND time BETWEEN event_at - {before} AND event_at - 1
  GROUP BY ev.entity, event_at, indicator)"""


_MISSING = """n AS (SELECT count(*) AS n_rows FROM (SELECT DISTINCT entity, event_at FROM means)),
missing AS (SELECT indicator, n_rows, n_rows - count(avg_value) AS n_missing FROM means, n GROUP BY indicator, n_rows)"""
_DENSE = f"""{_BUYERS}, {_P_FLAG}, {_E_NAT}, {_means('p_flag', 2)}, {_MISSING},
dense AS (SELECT * FROM means WHERE indicator IN (SELECT indicator FROM missing WHERE n_missing <= 0.5 * n_rows))"""
_PAIRS = f"""{_DENSE}, moments AS (
  SELECT x.indicator AS a, y.indicator AS b, count(*) AS n_rows, covar_pop(x.avg_value, y.avg_value) AS c,
         stddev_pop(x.avg_value) AS sx, stddev_pop(y.avg_value) AS sy
  FROM dense x JOIN dense y ON x.entity = y.entity AND x.event_at = y.event_at AND x.indicator < y.indicator
  WHERE x.avg_value IS NOT NULL AND y.avg_value IS NOT NULL GROUP BY ALL),
pairs AS (SELECT a, b, n_rows, c / (sx * sy) AS r FROM moments WHERE n_rows >= 2 AND sx > 0 AND sy > 0)"""

_AT_EVENT = """at_event AS (
  SELECT p.entity, event_at, indicator, value FROM panel p JOIN ev ON p.entity = ev.entity AND time = event_at)"""
_PER_SOURCE = """per_source AS (
  SELECT entity, indicator, value FROM panel p
  JOIN (SELECT source, max(time) AS time FROM panel GROUP BY source) l ON p.source = l.source AND p.time = l.time)"""
_SIDES = f"{_PANEL}, {_E_NAT}, {_AT_EVENT}, {_PER_SOURCE}"
_COMMON = "common AS (SELECT indicator FROM at_event INTERSECT SELECT indicator FROM per_source)"

_SIGNUPS = f"""{_P_EV}, {_E_USR},
at_event AS (SELECT p.entity, event_at, indicator, value FROM p_ev p JOIN ev ON p.entity = ev.entity AND p.time = ev.event_at),
per_source AS (SELECT entity || '@' || time AS entity, indicator, value FROM p_ev)"""


def _scaled(sides: str) -> str:
    """Signed logs, filled and scaled by the reference side: ``scaled`` (side, keys, indicator, z)."""
    return f"""{sides}, {_COMMON},
both_sides AS (
  SELECT 'r' AS side, entity, event_at, indicator, sign(value) * ln(1 + abs(value)) AS x FROM at_event
  UNION ALL SELECT 'c', entity, NULL, indicator, sign(value) * ln(1 + abs(value)) FROM per_source),
keys AS (SELECT DISTINCT side, entity, event_at FROM both_sides),
med AS (SELECT indicator, median(x) AS med FROM both_sides JOIN common USING (indicator) WHERE side = 'r' GROUP BY indicator),
filled AS (
  SELECT k.side, k.entity, k.event_at, m.indicator, coalesce(x, med) AS x
  FROM keys k CROSS JOIN med m LEFT JOIN both_sides b
    ON b.side = k.side AND b.entity = k.entity AND b.event_at IS NOT DISTINCT FROM k.event_at AND b.indicator = m.indicator),
stats AS (SELECT indicator, avg(x) AS m, stddev_pop(x) AS s FROM filled WHERE side = 'r' GROUP BY indicator),
scaled AS (SELECT side, entity, event_at, indicator, (x - m) / CASE WHEN s > 0 THEN s ELSE 1 END AS z
           FROM filled JOIN stats USING (indicator)),
zs AS (SELECT side, entity, event_at, list(z ORDER BY indicator) AS z FROM scaled GROUP BY side, entity, event_at)"""


def _squared(m: str) -> str:
    return f"list_transform({m}, lambda r: list_transform({m}, lambda c: list_dot_product(r, c)))"


def _leading(name: str, start: str) -> str:
    """Leading eigenvector of the symmetric matrix in ``start(m)`` by repeated squaring: each
    squaring doubles the power, and the longest column of a high power is the vector."""
    return f"""{name}_power AS (
  SELECT 0 AS k, m FROM {start} UNION ALL
  SELECT k + 1, list_transform(q, lambda r: list_transform(r, lambda x: x / scale)) FROM (
    SELECT k, q, list_max(list_transform(q, lambda r: list_max(list_transform(r, lambda x: abs(x))))) AS scale
    FROM (SELECT k, {_squared('m')} AS q FROM {name}_power WHERE k < 22))),
{name}_column AS (SELECT unnest(m) AS v FROM {name}_power WHERE k = 22),
{name}_unit AS (SELECT list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v
                FROM {name}_column ORDER BY list_dot_product(v, v) DESC LIMIT 1),
{name} AS (SELECT list_transform(v, lambda x: x * sign(v[list_position(list_transform(v, lambda y: round(abs(y), 12)),
                  list_max(list_transform(v, lambda y: round(abs(y), 12))))])) AS v FROM {name}_unit)"""


_AXES = f"""pairs AS (
  SELECT a.indicator AS i, b.indicator AS j, covar_samp(a.z, b.z) AS c FROM scaled a
  JOIN scaled b ON a.entity = b.entity AND a.event_at = b.event_at WHERE a.side = 'r' AND b.side = 'r' GROUP BY i, j),
cov AS (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(c ORDER BY j) AS r FROM pairs GROUP BY i)),
{_leading('first', 'cov')},
rest AS (SELECT list_transform(m, lambda r, i: list_transform(r, lambda x, j: x - l * v[i] * v[j])) AS m
         FROM (SELECT m, v, list_dot_product(v, list_transform(m, lambda r: list_dot_product(r, v))) AS l FROM cov, first)),
{_leading('second', 'rest')},
flat AS (SELECT side, entity, list_dot_product(z, f.v) AS axis_1, list_dot_product(z, s.v) AS axis_2 FROM zs, first f, second s),
turn AS (SELECT CASE WHEN max(axis_1) FILTER (entity = 'NATION_1') < max(axis_1) FILTER (entity = 'NATION_2') THEN -1 ELSE 1 END AS t
         FROM flat WHERE side = 'c'),
placed AS (SELECT side, entity, t * axis_1 AS axis_1, axis_2 FROM flat, turn)"""

# Weights of the shortest mean in the kernel's space: each step moves weight from the worst
# place that has some to the best that has room, until they are 1e-12 apart.
def _descent(cap: str) -> str:
    return """refs AS (SELECT row_number() OVER (ORDER BY entity, event_at) AS i, z FROM zs WHERE side = 'r'),
size AS (SELECT count(*) AS n, """ + cap + """ AS cap, 1.0 / max(len(z)) AS gamma FROM refs),
gram AS (SELECT list(r ORDER BY i) AS g FROM (
  SELECT a.i, list(exp(-gamma * list_distance(a.z, b.z) ** 2) ORDER BY b.i) AS r FROM refs a, refs b, size GROUP BY a.i)),
descent AS (
  SELECT 0 AS k, list_transform(g, lambda r: 1.0 / n) AS a, list_transform(g, lambda r: list_sum(r) / n) AS s, 1e0 AS gap FROM gram, size
  UNION ALL
  SELECT k + 1, list_transform(a, lambda x, p: x + CASE WHEN p = i THEN t WHEN p = j THEN -t ELSE 0 END),
         list_transform(s, lambda x, p: x + t * (g[p][i] - g[p][j])), gap
  FROM (SELECT *, least((s[j] - s[i]) / greatest(g[i][i] + g[j][j] - 2 * g[i][j], 1e-15), cap - a[i], a[j]) AS t, s[j] - s[i] AS gap
        FROM (SELECT k, a, s, g, cap, list_position(up, list_min(up)) AS i, list_position(down, list_max(down)) AS j
              FROM (SELECT k, a, s, g, cap,
                           list_transform(s, lambda x, p: CASE WHEN a[p] < cap - 1e-14 THEN x ELSE 1e300 END) AS up,
                           list_transform(s, lambda x, p: CASE WHEN a[p] > 1e-14 THEN x ELSE -1e300 END) AS down
                    FROM descent, gram, size WHERE gap > 1e-12)))),
fitted AS (SELECT a FROM descent ORDER BY k DESC LIMIT 1),
own AS (SELECT i, a[i] AS w, list_dot_product(g[i], a) AS score FROM refs, fitted, gram)"""


_BOUNDARY = f"""{_descent('1.0 / (0.05 * count(*))')},
ends AS (SELECT avg(score) FILTER (w > cap * 1e-8 AND w < cap * (1 - 1e-8)) AS free,
                max(score) FILTER (w >= cap * (1 - 1e-8)) AS top, min(score) FILTER (w <= cap * 1e-8) AS bottom FROM own, size),
threshold AS (SELECT coalesce(free, (coalesce(top, bottom) + coalesce(bottom, top)) / 2) AS limit_at FROM ends),
decided AS (
  SELECT c.entity, sum(w * exp(-gamma * list_distance(c.z, r.z) ** 2)) - any_value(limit_at) AS decision
  FROM (SELECT entity, z FROM zs WHERE side = 'c') c, refs r JOIN own USING (i), size, threshold GROUP BY c.entity)"""

# The shortest mean without a cap is the centre of the smallest ball.
_BALL = f"""{_descent('1.0')},
self_product AS (SELECT sum(w * score) AS own, sqrt(1 - sum(w * score)) AS radius FROM own),
decided AS (
  SELECT c.entity, any_value(radius) AS radius,
         sqrt(greatest(1 + any_value(own) - 2 * sum(w * exp(-gamma * list_distance(c.z, r.z) ** 2)), 0)) AS distance
  FROM (SELECT entity, z FROM zs WHERE side = 'c') c, refs r JOIN own USING (i), size, self_product GROUP BY c.entity)"""

_GIVEN = f"""spent AS (SELECT o_custkey, sum({_cents('o_totalprice')}) AS c, count(*) AS n FROM orders GROUP BY o_custkey),
custs AS (SELECT CAST(c_custkey AS VARCHAR) AS entity, c_nationkey, CAST(c AS DOUBLE) AS c, CAST(n AS DOUBLE) AS n,
          CASE WHEN c_acctbal < 0 THEN -1 ELSE 1 END AS anomaly_label FROM customer JOIN spent ON c_custkey = o_custkey),
cand AS (SELECT entity, anomaly_label, c / 1e8 AS axis_1, n / 10.0 AS axis_2 FROM custs),
ref AS (SELECT sum(c) / count(c) / 1e8 AS axis_1, sum(n) / count(n) / 10.0 AS axis_2 FROM custs GROUP BY c_nationkey),
figures AS (SELECT avg(axis_1) AS centre, min(1.5 * axis_1 + axis_2) AS lo, avg(1.5 * axis_1 + axis_2) AS mid,
            max(1.5 * axis_1 + axis_2) AS hi FROM ref),
raw AS (SELECT entity, anomaly_label, axis_1 - centre AS lead, 1.5 * axis_1 + axis_2 - mid AS raw_score,
        lo - mid AS a, hi - mid AS b FROM cand, figures),
given AS (SELECT entity, anomaly_label, lead, raw_score,
          CASE WHEN a = b THEN 50.0 WHEN raw_score >= b THEN 95.0 WHEN raw_score < a THEN 20.0
               WHEN raw_score >= 0 THEN 50.0 + 45.0 * raw_score / b
               ELSE 20.0 + 30.0 * (raw_score - a) / (0 - a) END AS readiness FROM raw)"""

_STATUS = """CASE WHEN anomaly_label = -1 AND lead > 0 THEN 'ELITE CANDIDATE'
     WHEN anomaly_label = 1 THEN 'STANDARD VIABLE' ELSE 'HIGH RISK / DEVELOPING' END"""

_CATALOGUE = """entities AS (
  SELECT CAST(c_custkey AS VARCHAR) AS entity, c_name AS name, coalesce(r_name, '') AS region,
         CASE WHEN c_acctbal > 0 THEN coalesce(c_mktsegment, '') ELSE '' END AS income_group
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT * FROM region WHERE r_name <> 'ASIA') ON n_regionkey = r_regionkey)"""

_LANDED = """landed AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS price,
         CASE WHEN o_orderstatus = 'F' THEN 'many' ELSE '3' END AS lines, o_orderstatus AS status FROM orders)"""

_CODES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", *(f"B.Brand#{n}" for n in range(1, 26))]

ORACLE = {
    "panel_union": f"WITH {_PANEL} SELECT source, entity, indicator, time, {r4('value')} AS value FROM panel",
    "panel_profile": f"""WITH {_PANEL}
SELECT source, count(*) AS n_rows, count(DISTINCT indicator) AS n_indicators, count(DISTINCT entity) AS n_entities,
       min(time) AS first_time, max(time) AS last_time, count(*) FILTER (value IS NULL) AS n_valueless
FROM panel WHERE time BETWEEN 1996 * 12 + 1 AND 2000 * 12 + 12 GROUP BY source""",
    "unpivot_wide_months": f"""WITH {_BUYERS}, {_P_ORD}
SELECT entity, indicator, time, {r4('value')} AS value FROM p_ord WHERE value IS NOT NULL""",
    "json_large_documents": """WITH sums AS (
  SELECT event_type, user_id, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day,
         sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS k FROM events GROUP BY ALL)
SELECT CAST(user_id AS VARCHAR) AS entity, event_type AS indicator, count(*) AS n, CAST(sum(k) AS DOUBLE) AS total,
       CAST(min(day) AS INTEGER) AS first, CAST(max(day) AS INTEGER) AS last FROM sums GROUP BY ALL""",
    "json_props_flatten": """
SELECT CAST(user_id AS VARCHAR) AS entity, event_type AS indicator,
       CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS time,
       count(*) AS n, sum(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS total
FROM events WHERE TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) IS NOT NULL GROUP BY ALL""",
    "json_catalogue_labels": """
SELECT event_type || '/' || user_id AS code,
       CASE WHEN event_type <> 'click' THEN 'kind ' || event_type ELSE event_type || '/' || user_id END AS label,
       count(*) AS n FROM events GROUP BY ALL""",
    "iso_like_filter": """
SELECT code, count(*) AS n FROM (
  SELECT upper(lang) || CASE WHEN lang = 'en' THEN upper(substr(source, 1, 1)) ELSE source END AS code FROM documents)
WHERE regexp_full_match(code, '[A-Z]{3}') GROUP BY code""",
    "entity_filter_fallback": f"""
SELECT CAST(c_custkey AS VARCHAR) AS id, count(*) AS n, CAST(sum({_cents('o_totalprice')}) AS DOUBLE) / 100.0 AS spent
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE NOT (c_acctbal < 2000) OR c_mktsegment = 'MACHINERY'
   OR (SELECT count(*) FROM customer WHERE NOT (c_acctbal < 2000) OR c_mktsegment = 'MACHINERY') < 50
GROUP BY c_custkey
UNION ALL SELECT n_name, 0, 0.0 FROM nation
WHERE n_regionkey <= 0 OR (SELECT count(*) FROM nation WHERE n_regionkey <= 0) < 50""",
    "event_window": f"""WITH {_PANEL}, {_E_NAT}, {_window('panel')}
SELECT entity, event_at, "offset", time, indicator, source, {r4('value')} AS value FROM win""",
    "event_window_users": f"""WITH {_P_EV}, {_E_USR}, {_window('p_ev')}
SELECT entity, event_at, "offset", time, indicator, source, {r4('value')} AS value FROM win""",
    "event_window_dense": f"""WITH {_PANEL}, {_E_NAT}, {_window('panel')},
series AS (SELECT DISTINCT entity, event_at, source, indicator FROM win),
grid AS (SELECT s.*, o."offset", event_at + o."offset" AS time FROM series s, (SELECT CAST(unnest(range(-6, 7)) AS INTEGER) AS "offset") o)
SELECT entity, event_at, "offset", time, indicator, source, {r4('value')} AS value
FROM grid LEFT JOIN win USING (entity, event_at, source, indicator, "offset", time)""",
    "event_window_change": f"WITH {_PANEL}, {_E_NAT}, {_change()} SELECT {_CHANGE_COLUMNS} FROM change",
    "event_window_change_raw": f"WITH {_P_RAW}, {_E_USR}, {_change(panel='p_raw')} SELECT {_CHANGE_COLUMNS} FROM change",
    "event_window_change_mixed": f"""WITH {_PANEL}, {_E_NAT}, shared AS (
  SELECT source, entity, CASE WHEN source = 'ORD' OR indicator = 'B.Brand#1' THEN 'SALES' ELSE indicator END AS indicator,
         time, value FROM panel),
{_change('entity, event_at, indicator', 'shared')} SELECT {_CHANGE_COLUMNS} FROM change""",
    "event_window_sample": f"""WITH {_PANEL}, {_E_NAT}, {_change()},
first_key AS (SELECT entity, event_at, indicator FROM change ORDER BY entity, event_at, indicator LIMIT 1)
SELECT {_CHANGE_COLUMNS} FROM change JOIN first_key USING (entity, event_at, indicator)""",
    "pre_event_mean": f"""WITH {_PANEL}, {_E_NAT}, {_means('panel', 6)}
SELECT entity, event_at, indicator, {r4('avg_value')} AS avg_value, n_values FROM means""",
    "feature_missing_counts": f"WITH {_DENSE} SELECT indicator, n_rows, n_missing FROM missing",
    "feature_null_filter": f"WITH {_DENSE} SELECT entity, event_at, indicator, {r4('avg_value')} AS avg_value, n_values FROM dense",
    # A view needs the columns spelled out: five priorities and 25 brands.
    "feature_matrix_wide": f"""WITH {_PANEL}, {_E_NAT}, {_means('panel', 6)}
SELECT * FROM (PIVOT (SELECT entity, event_at, indicator, {r4('avg_value')} AS v FROM means)
               ON indicator IN ({", ".join(f"'{c}'" for c in _CODES)}) USING any_value(v) GROUP BY entity, event_at)""",
    "events_from_csv": f"""WITH {_PANEL}, ev AS (
  SELECT n_name AS entity, CAST(1998 * 12 + n_nationkey AS INTEGER) AS event_at FROM nation WHERE n_regionkey <> 2),
{_means('panel', 6)}
SELECT entity, event_at, indicator, {r4('avg_value')} AS avg_value, n_values FROM means""",
    "activity_around_purchase": f"""
SELECT p.event_id AS purchase, a.event_type, count(*) AS n, CAST(sum({_cents('a.value')}) AS DOUBLE) / 100.0 AS total,
       max(epoch_us(a.ts) - epoch_us(p.ts)) FILTER (WHERE a.ts < p.ts) AS nearest_before
FROM events p JOIN events a ON a.user_id = p.user_id AND a.ts BETWEEN p.ts - INTERVAL 1 DAY AND p.ts + INTERVAL 6 HOUR
WHERE p.event_type = 'purchase' GROUP BY p.event_id, a.event_type""",
    "activity_between_signups": f"""WITH spans AS (
  SELECT user_id, event_id AS signup, epoch_us(ts) AS start_at,
         coalesce(lead(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id), epoch_us(ts) + 86400000000) - 1 AS end_at
  FROM events WHERE event_type = 'signup')
SELECT signup, count(*) AS n, CAST(sum({_cents('value')}) AS DOUBLE) / 100.0 AS total, max(end_at) AS "end"
FROM spans s JOIN events a ON a.user_id = s.user_id AND epoch_us(a.ts) BETWEEN start_at AND end_at AND event_type <> 'signup'
GROUP BY signup""",
    "correlation_pairs": f"WITH {_PAIRS} SELECT a, b, n_rows, {r4('r')} AS r FROM pairs",
    "correlation_above": f"WITH {_PAIRS} SELECT a, b, n_rows, {r4('r')} AS r FROM pairs WHERE abs(r) > 0.9",
    "correlation_kept": f"""WITH {_PAIRS}
SELECT entity, event_at, indicator, {r4('avg_value')} AS avg_value, n_values FROM dense
WHERE indicator NOT IN (SELECT b FROM pairs WHERE abs(r) > 0.9)""",
    "snapshot_latest": f"""WITH {_PANEL}
SELECT entity, indicator, {r4('value')} AS value FROM panel WHERE time = (SELECT max(time) FROM panel)""",
    "snapshot_latest_per_source": f"""WITH {_PANEL}, {_PER_SOURCE}
SELECT entity, indicator, {r4('value')} AS value FROM per_source""",
    "snapshot_at_event": f"""WITH {_PANEL}, {_E_NAT}, {_AT_EVENT}
SELECT entity, event_at, indicator, {r4('value')} AS value FROM at_event""",
    "common_indicators": f"WITH {_SIDES}, {_COMMON} SELECT indicator FROM common",
    "signed_log_scaled": f"""WITH {_scaled(_SIDES)}
SELECT entity, event_at, indicator, {r4('z')} AS scaled FROM scaled""",
    "pca_axes": f"""WITH RECURSIVE {_scaled(_SIDES)}, {_AXES}
SELECT entity, {r4('axis_1')} AS axis_1, {r4('axis_2')} AS axis_2 FROM placed WHERE side = 'c'""",
    "one_class_score": f"""WITH RECURSIVE {_scaled(_SIDES)}, {_BOUNDARY}
SELECT entity, {r4('decision')} AS decision, CASE WHEN decision > 1e-9 THEN 1 ELSE -1 END AS anomaly_label FROM decided""",
    "one_class_score_features": f"""WITH RECURSIVE {_scaled(_SIGNUPS)}, {_BOUNDARY}
SELECT entity, {r4('decision')} AS decision, CASE WHEN decision > 1e-9 THEN 1 ELSE -1 END AS anomaly_label FROM decided""",
    "enclosing_ball": f"""WITH RECURSIVE {_scaled(_SIGNUPS)}, {_BALL}
SELECT entity, {r4('distance')} AS distance, CASE WHEN distance <= radius + 1e-9 THEN 1 ELSE -1 END AS anomaly_label FROM decided""",
    "candidate_scores": f"""WITH RECURSIVE {_scaled(_SIDES)}, {_AXES}, {_BOUNDARY},
figures AS (SELECT avg(1.5 * axis_1 + axis_2) AS mid, min(1.5 * axis_1 + axis_2) AS lo, max(1.5 * axis_1 + axis_2) AS hi
            FROM placed WHERE side = 'r'),
raw AS (SELECT entity, 1.5 * axis_1 + axis_2 - mid AS x, lo - mid AS a, hi - mid AS b FROM placed, figures WHERE side = 'c'),
complete AS (SELECT entity, count(DISTINCT indicator) FILTER (value IS NOT NULL AND indicator IN (SELECT indicator FROM common))
                    / (SELECT count(*) FROM common) AS data_completeness FROM per_source GROUP BY entity)
SELECT entity, CASE WHEN decision > 1e-9 THEN 1 ELSE -1 END AS anomaly_label, round(data_completeness, 4) AS data_completeness,
       round(CASE WHEN x >= b THEN 95.0 WHEN x < a THEN 20.0 WHEN x >= 0 THEN 50.0 + 45.0 * x / b
                  ELSE 20.0 + 30.0 * (x - a) / (0 - a) END, 2) AS readiness_score
FROM raw JOIN decided USING (entity) JOIN complete USING (entity)""",
    "infer_schema": """SELECT column_name AS name, CAST(row_number() OVER () - 1 AS INTEGER) AS position,
       CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'DATE' THEN 'date'
            WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE column_type END AS type,
       (SELECT count(*) FROM lineitem) AS n_rows, n_values
FROM (DESCRIBE lineitem) JOIN (
  SELECT column_name, n_values FROM (SELECT count(COLUMNS(*)) FROM lineitem) UNPIVOT (n_values FOR column_name IN (COLUMNS(*))))
  USING (column_name)""",
    "readiness_score": f"""WITH {_GIVEN},
complete AS (SELECT CAST(o_custkey AS VARCHAR) AS entity, count(DISTINCT o_orderpriority) /
             (SELECT count(DISTINCT o_orderpriority) FROM orders) AS data_completeness FROM orders GROUP BY o_custkey)
SELECT entity, anomaly_label, round(data_completeness, 4) AS data_completeness, round(readiness, 2) AS readiness_score
FROM given LEFT JOIN complete USING (entity)""",
    "status_report": f"""WITH {_GIVEN},
asked AS (SELECT CAST(c_custkey AS VARCHAR) AS entity FROM customer UNION SELECT s_name FROM supplier),
labelled AS (SELECT a.entity, anomaly_label, readiness, CASE WHEN readiness IS NOT NULL THEN {_STATUS} END AS status
             FROM asked a LEFT JOIN given g ON a.entity = g.entity)
SELECT entity, anomaly_label, round(readiness, 2) AS readiness_score, status,
       CASE WHEN readiness IS NULL THEN entity || ': not found'
            ELSE entity || ': ' || status || ', viability index ' || printf('%.1f', readiness) || ' / 100' END AS report
FROM labelled""",
    "dim_indicator": f"""WITH {_PANEL}, {_E_NAT}, {_window('panel')}
SELECT indicator,
       CASE WHEN EXISTS (SELECT 1 FROM part WHERE 'B.' || p_brand = indicator) THEN 'The ''' || substr(indicator, 3) || ''' mean price'
            WHEN indicator < '4' THEN 'Orders ' || indicator ELSE indicator END AS name,
       CASE WHEN EXISTS (SELECT 1 FROM part WHERE 'B.' || p_brand = indicator) THEN 'LI'
            WHEN indicator < '4' THEN 'ORD' ELSE 'Unknown' END AS source
FROM (SELECT DISTINCT indicator FROM win)""",
    "dim_entity": f"WITH {_CATALOGUE} SELECT * FROM entities",
    "score_by_region": f"""WITH {_GIVEN}, {_CATALOGUE}
SELECT entity, anomaly_label, {r4('readiness')} AS readiness_score, name, region, income_group
FROM given JOIN entities USING (entity) WHERE region IN ('AFRICA', 'EUROPE', '')""",
    "top_ranked": f"""WITH {_GIVEN}, best AS (
  SELECT entity, {r4('raw_score')} AS readiness_score FROM given ORDER BY readiness_score DESC, entity LIMIT 25)
SELECT entity, readiness_score, CAST(rank() OVER (ORDER BY readiness_score DESC) AS INTEGER) AS rank FROM best""",
    "indicator_over_event_time": f"""WITH {_PANEL}, {_E_NAT}, {_change()}
SELECT {_CHANGE_COLUMNS}, CASE WHEN indicator = '1-URGENT' THEN 'Orders 1-URGENT' ELSE indicator END AS indicator_name
FROM change WHERE indicator IN ('1-URGENT', '5-LOW', 'B.Brand#7')""",
    "entity_over_event_time": f"""WITH {_PANEL}, {_E_NAT}, {_change()}
SELECT {_CHANGE_COLUMNS}, CASE WHEN indicator < '4' THEN 'Orders ' || indicator
       WHEN source = 'LI' THEN 'The ''' || substr(indicator, 3) || ''' mean price' ELSE indicator END AS indicator_name
FROM change WHERE entity IN ('NATION_3', 'NATION_11')""",
    "conform_rows": f"""WITH {_LANDED}
SELECT TRY_CAST(order_id AS BIGINT) AS order_id, TRY_CAST(price AS DOUBLE) AS price, TRY_CAST(lines AS INTEGER) AS lines,
       CAST(NULL AS VARCHAR) AS note
FROM landed WHERE TRY_CAST(price AS DOUBLE) IS NOT NULL AND TRY_CAST(lines AS INTEGER) IS NOT NULL""",
    "rejected_rows": f"""WITH {_LANDED}
SELECT order_id, lines, status,
       concat_ws(',', CASE WHEN TRY_CAST(price AS DOUBLE) IS NULL THEN 'price' END,
                 CASE WHEN TRY_CAST(lines AS INTEGER) IS NULL THEN 'lines' END) AS rejected
FROM landed WHERE TRY_CAST(price AS DOUBLE) IS NULL OR TRY_CAST(lines AS INTEGER) IS NULL""",
    "load_report": f"""WITH {_LANDED}, good AS (
  SELECT count(*) AS n FROM landed WHERE TRY_CAST(price AS DOUBLE) IS NOT NULL AND TRY_CAST(lines AS INTEGER) IS NOT NULL)
SELECT n AS n_loaded, (SELECT count(*) FROM landed) - n AS n_rejected, 'note' AS missing, 'status' AS extra, n AS n_read
FROM good""",
    "ingest_faults": f"""WITH {_LANDED}, faults AS (
  SELECT CASE WHEN order_id IS NULL OR status IS NULL THEN 'key' WHEN TRY_CAST(lines AS INTEGER) IS NULL THEN 'time'
              WHEN price IS NULL THEN 'none' WHEN TRY_CAST(price AS DOUBLE) IS NULL THEN 'bad'
              WHEN NOT isfinite(TRY_CAST(price AS DOUBLE)) THEN 'infinite' ELSE 'usable' END AS f FROM landed)
SELECT count(*) AS n_rows, count_if(f = 'usable') AS n_usable, count_if(f = 'key') AS n_no_key, count_if(f = 'time') AS n_bad_time,
       count_if(f = 'none') AS n_no_value, count_if(f = 'bad') AS n_bad_value, count_if(f = 'infinite') AS n_not_finite FROM faults""",
    "event_fault_rows": f"""WITH {_LANDED}
SELECT CASE WHEN order_id IS NULL THEN 'no entity' WHEN lines IS NULL THEN 'no time' ELSE 'bad time' END AS rejected, count(*) AS n_rows
FROM landed WHERE order_id IS NULL OR TRY_CAST(lines AS INTEGER) IS NULL GROUP BY 1""",
    "fact_in_file_order": f"""WITH {_PANEL}, {_E_NAT}, {_window('panel')}
SELECT count(*) AS n_rows, 0 AS n_behind FROM win""",
    "input_report_orders": """
SELECT 'orders' AS input, 'O_ORDERKEY' AS name, true AS present, true AS type_ok, count(*) AS n_rows, count(o_orderkey) AS n_values FROM orders
UNION ALL SELECT 'orders', 'o_totalprice', true, true, count(*), count(o_totalprice) FROM orders
UNION ALL SELECT 'orders', 'o_orderpriority', true, true, count(*), count(o_orderpriority) FROM orders""",
    "publish_manifest": f"""WITH {_PANEL}, {_E_NAT}, {_window('panel')}, {_GIVEN}
SELECT 'fact' AS name, count(*) AS n_rows FROM win
UNION ALL SELECT 'scores', count(*) FROM given
UNION ALL SELECT 'entities', count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "profile_from_slices": f"""WITH {_P_RAW}
SELECT indicator, count(*) AS n_rows, min(time) AS first_time, max(time) AS last_time, count(*) - count(value) AS n_valueless,
       count(DISTINCT entity) AS exact_entities, TRUE AS within_error FROM p_raw GROUP BY indicator""",
    "orders_of_versions": f"""WITH o AS (
  SELECT o_orderstatus, o_orderkey, CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice) ELSE o_totalprice END AS price,
         CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS priority,
         CASE WHEN o_orderstatus = 'O' THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) WHEN o_orderstatus = 'P' THEN o_orderdate END AS placed
  FROM orders WHERE o_orderstatus IN ('F', 'O', 'P'))
SELECT o_orderstatus, count(o_orderkey) AS n, CAST(sum({_cents('price')}) AS DOUBLE) / 100.0 AS total, count(priority) AS n_priorities,
       strftime(max(placed), '%Y-%m-%d %H:%M:%S') AS last_placed, 'bigint,double,timestamp_ntz' AS types FROM o GROUP BY o_orderstatus""",
    "published_after_rollback": f"""WITH {_GIVEN}
SELECT count(*) + count(*) FILTER (readiness < 60) AS n_rows, 2 AS n_cleared, count(*) FILTER (readiness < 60) AS n_live,
       {r4('max(readiness) FILTER (readiness < 60)')} AS highest FROM given""",
}
ORACLE["candidate_scores_sparse"] = ORACLE["candidate_scores"]
ORACLE["event_window_bucketed"] = ORACLE["event_window"]
