"""The same results in DuckDB SQL, straight from the benchmark tables.

Each entry is a final SELECT plus the named parts it builds on. Text that Spark lands, types and cleans
is recomputed here by another engine; averages and rates are rounded in integers.
"""

from wardbook.schema import CRIME_CATEGORIES, LINES, PROFILE_METRICS

LOADED = "cast(1706767200 as bigint)"  # the adapters' load time in epoch seconds
_POP, _INC, _HH = (PROFILE_METRICS[m] for m in ("population_2021", "median_income_2020", "households_2021"))
_WEATHER = "temperature_2m, precipitation, snowfall, wind_speed_10m"
_CATEGORIES = ", ".join(f"'{c}'" for c in CRIME_CATEGORIES)
_LINES = ", ".join(f"'{x}'" for x in LINES)


def _list(values):
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


def _half_up(total, count, places):
    """round(total / count, places), half away from zero, without floating point until the end."""
    scale = 10**places
    return (
        f"cast(sign({total}) * ((2 * abs({total}) * {scale} + {count}) // (2 * {count})) as double) / {scale}"
    )


_RAW_LINES = _list(["YU", " yus ", "YU/BD", "BD ", "Line 2 Bloor", "SHP", "LINE 4 SHEPPARD", "SRT"])
_OCC = "cast(cast(o_orderdate as date) + interval 216 month as date)"


def _code(n):
    return f"'E' || (['U', 'R', 'X'])[{n} % 3 + 1] || lpad(cast({n} as varchar), 2, '0')"


def _clean(col):
    name = f"lower(regexp_replace(regexp_replace({col}, '[^0-9a-zA-Z]+', '_', 'g'), '^_+|_+$', '', 'g'))"
    return f"CASE WHEN {name} = '' THEN 'col' WHEN regexp_matches({name}, '^[0-9]') THEN 'c_' || {name} ELSE {name} END"


def _raw_delays(clean):
    minutes = "cast(floor(value) as bigint)"
    shown = minutes if clean else f"CASE WHEN event_id % 97 = 0 THEN -{minutes} ELSE {minutes} END"
    return f"""
  SELECT event_id AS id, strftime(ts, '%Y-%m-%d') AS "date", strftime(ts, '%H:%M') AS "time",
    strftime(ts, '%A') AS day, ' Station ' || (user_id % 75) || ' ' AS station,
    lower({_code('(event_id % 60 + 1)')}) || ' ' AS code,
    CASE WHEN event_id % 17 = 0 THEN '' ELSE cast({shown} as varchar) END AS min_delay,
    CASE WHEN event_id % 19 = 0 THEN '' ELSE cast({minutes} + 2 as varchar) END AS min_gap,
    (['n', 's ', 'E', 'W', ''])[event_id % 5 + 1] AS bound,
    CASE WHEN event_id % 101 <> 0 THEN ({_RAW_LINES})[event_id % 8 + 1] END AS line,
    CASE WHEN event_id % 11 = 0 THEN '  ' ELSE cast(user_id as varchar) END AS vehicle
  FROM event_log"""


def _raw_crime(clean):
    place = "cast(floor(o_custkey / 15.0) as bigint)"
    category = "(['Assault', 'Auto Theft', 'Break and Enter', 'Robbery', 'Theft Over'])[cast(left(o_orderpriority, 1) as int)]"
    lag, occ = "o_orderkey % 45", _OCC
    if not clean:
        place = f"CASE WHEN o_orderkey % 97 = 0 THEN {place} + 1000000 ELSE {place} END"
        category = f"CASE WHEN o_orderkey % 307 = 0 THEN 'Vandalism' ELSE {category} END"
        lag = "CASE WHEN o_orderkey % 211 = 0 THEN -1 ELSE o_orderkey % 45 END"
        occ = f"CASE WHEN o_orderkey % 401 <> 0 THEN {_OCC} END"
    return f"""
  SELECT o_orderkey AS id, 'GO-' || (o_orderkey // 2) AS event_id, {occ} AS occ_date,
    cast({_OCC} + cast({lag} as int) as date) AS report_date,
    CASE WHEN o_orderkey % 31 <> 0 THEN year({_OCC}) END AS occ_year,
    CASE WHEN o_orderkey % 29 <> 0 THEN o_orderkey % 24 END AS occ_hour,
    strftime({_OCC}, '%A') AS occ_dow, (o_orderkey + 5) % 24 AS report_hour,
    'D' || (o_custkey % 17) AS division,
    (['House', 'Apartment', 'Commercial', 'Outside'])[o_orderkey % 4 + 1] AS location_type,
    (['House', 'Apartment', 'Commercial', 'Outside', 'Transit', 'Other'])[o_orderkey % 6 + 1] AS premises_type,
    cast(1000 + o_orderkey % 7 as varchar) AS ucr_code, cast(o_orderkey % 3 * 100 as varchar) AS ucr_ext,
    {category} AS mci_category,
    CASE WHEN o_orderkey % 50 = 0 THEN 'NSA' WHEN o_orderkey % 53 = 0 THEN '' ELSE cast({place} as varchar) END AS hood_158,
    'Place ' || ({place}) AS hood_name,
    CASE WHEN o_orderkey % 37 <> 0 THEN '-79.' || lpad(cast(o_orderkey % 10000 as varchar), 4, '0') END AS lon,
    CASE WHEN o_orderkey % 37 <> 0 THEN '43.' || lpad(cast(o_orderkey * 7 % 10000 as varchar), 4, '0') END AS lat
  FROM orders"""


def _raw_profiles(clean):
    place, j = "(c_custkey // 15)", "(c_custkey % 15)"
    number = place if clean else f"CASE WHEN ({place} + 1) % 29 = 0 THEN {place} + 1000000 ELSE {place} END"
    population = f"cast({j} * 100 + {place} * 37 % 500 + 3 as varchar) || CASE WHEN {j} = 10 THEN '.5' ELSE '' END"
    if not clean:
        population = f"CASE WHEN ({place} + 1) % 23 = 0 THEN '0' WHEN ({place} + 1) % 19 = 0 THEN '' ELSE {population} END"
    return f"""
  SELECT {number} AS neighbourhood_id,
    CASE WHEN {j} IN (0, 5, 10) THEN '{_POP}' WHEN {j} IN (1, 6) THEN '{_INC}' WHEN {j} = 2 THEN '{_HH}'
      ELSE 'Other metric ' || {j} END AS metric,
    CASE WHEN {j} IN (0, 5, 10) THEN {population} WHEN {j} IN (1, 6) THEN cast(30000 + {place} * 113 % 50000 + {j} as varchar)
      WHEN {j} = 2 THEN cast(100 + {place} * 7 % 400 as varchar) ELSE c_mktsegment END AS value
  FROM customer"""


def _pivot(alias, metric):
    # The values hold at most one decimal, so halves are exact and round() goes away from zero.
    return f"cast(round(max(CASE WHEN metric = '{metric}' THEN cast(nullif(value, '') as decimal(18, 3)) END), 0) as int) AS {alias}"


def _parts(clean):
    pivots = ", ".join(_pivot(a, m) for a, m in PROFILE_METRICS.items())
    return {
        "event_log": "SELECT * REPLACE (ts - to_days(cast(user_id // 15 % 100 * 30 as int)) AS ts) FROM events",
        "raw_delays": _raw_delays(clean),
        "raw_crime": _raw_crime(clean),
        "raw_profiles": _raw_profiles(clean),
        "codes": f"""
  SELECT {_code('p_size')} AS delay_code, 'Cause ' || (p_size % 20) AS delay_description,
    CASE WHEN p_size % 3 = 0 THEN 'srt' ELSE 'subway' END AS system
  FROM (SELECT DISTINCT p_size FROM part)""",
        "stg_delays": """
  SELECT id AS source_row_id, cast("date" as date) AS delay_date, cast("date" || ' ' || "time" as timestamp) AS delay_at,
    trim(day) AS day_of_week, upper(trim(station)) AS station, upper(trim(code)) AS delay_code,
    cast(nullif(min_delay, '') as int) AS delay_minutes, cast(nullif(min_gap, '') as int) AS gap_minutes,
    nullif(upper(trim(bound)), '') AS bound, upper(trim(line)) AS line,
    CASE WHEN upper(trim(line)) LIKE 'YU%' OR upper(trim(line)) LIKE 'LINE 1%' THEN 'YU'
      WHEN upper(trim(line)) LIKE 'BD%' OR upper(trim(line)) LIKE 'LINE 2%' THEN 'BD'
      WHEN upper(trim(line)) LIKE 'SHP%' THEN 'SHP' ELSE 'OTHER' END AS line_group,
    nullif(trim(vehicle), '') AS vehicle
  FROM raw_delays""",
        "stg_crime": """
  SELECT id AS source_row_id, event_id, report_date, occ_date AS occurrence_date, cast(occ_year as int) AS occurrence_year,
    cast(occ_hour as int) AS occurrence_hour, occ_dow AS occurrence_day_of_week, cast(report_hour as int) AS report_hour,
    division AS police_division, location_type, premises_type, ucr_code, ucr_ext,
    mci_category || ' ' || (id % 4) AS offence, mci_category,
    CASE WHEN hood_158 NOT IN ('NSA', '') THEN cast(hood_158 as int) END AS neighbourhood_id,
    hood_name AS neighbourhood_name_raw, cast(lon as double) AS longitude, cast(lat as double) AS latitude
  FROM raw_crime""",
        "stg_n": """
  SELECT cast(s_suppkey as int) AS neighbourhood_id, s_name AS neighbourhood_name,
    CASE WHEN s_nationkey % 3 = 0 THEN 'Neighbourhood Improvement Area' WHEN s_nationkey % 3 = 1 THEN 'Emerging Neighbourhood'
      WHEN s_nationkey <> 2 THEN 'Not an NIA or Emerging Neighbourhood' END AS tsns_classification,
    CASE WHEN s_nationkey % 3 = 0 THEN true WHEN s_nationkey % 3 = 1 OR s_nationkey <> 2 THEN false END AS is_improvement_area,
    '{"type": "Point", "coordinates": [-79.' || s_suppkey || ', 43.7]}' AS geometry_geojson
  FROM supplier""",
        "stg_p": f"SELECT cast(neighbourhood_id as int) AS neighbourhood_id, {pivots} FROM raw_profiles GROUP BY 1",
        "dim_n": """
  SELECT n.neighbourhood_id, neighbourhood_name, tsns_classification, is_improvement_area, population_2021,
    median_income_2020, households_2021, geometry_geojson
  FROM stg_n n LEFT JOIN stg_p p ON n.neighbourhood_id = p.neighbourhood_id""",
        "dim_code": """
  SELECT *, CASE WHEN substr(delay_code, 2, 1) IN ('U', 'R') THEN 'Equipment' ELSE 'Other' END AS code_family_hint FROM codes""",
        "fct_crime": """
  SELECT source_row_id AS crime_incident_key, event_id, cast(strftime(occurrence_date, '%Y%m%d') as int) AS occurrence_date_key,
    occurrence_date, occurrence_hour, cast(strftime(report_date, '%Y%m%d') as int) AS report_date_key, report_date,
    cast(report_date - occurrence_date as int) AS days_to_report, neighbourhood_id, police_division, mci_category, offence,
    location_type, premises_type, longitude, latitude
  FROM stg_crime WHERE occurrence_date >= DATE '2014-01-01'""",
        "fct_delays": """
  SELECT source_row_id AS ttc_delay_key, cast(strftime(delay_date, '%Y%m%d') as int) AS delay_date_key, delay_date, delay_at,
    cast(hour(delay_at) as int) AS delay_hour, station, line, line_group, bound, d.delay_code,
    coalesce(delay_description, 'Unknown code') AS delay_description, delay_minutes, gap_minutes, vehicle
  FROM stg_delays d LEFT JOIN codes c ON d.delay_code = c.delay_code""",
        "agg_crime": f"""
  SELECT month_start, m.neighbourhood_id, neighbourhood_name, is_improvement_area, mci_category, incidents, population_2021,
    CASE WHEN population_2021 <> 0 THEN {_half_up('(incidents * 1000)', 'population_2021', 3)} END AS incidents_per_1000
  FROM (SELECT cast(date_trunc('month', occurrence_date) as date) AS month_start, neighbourhood_id, mci_category, count(*) AS incidents
        FROM fct_crime WHERE neighbourhood_id IS NOT NULL GROUP BY 1, 2, 3) m
  JOIN dim_n n ON m.neighbourhood_id = n.neighbourhood_id""",
        "agg_delays": f"""
  SELECT month_start, station, line, delay_events, total_delay_minutes,
    CASE WHEN n > 0 THEN {_half_up('total_delay_minutes', 'n', 2)} END AS avg_delay_minutes, max_delay_minutes, delays_10min_plus
  FROM (SELECT cast(date_trunc('month', delay_date) as date) AS month_start, station, line, count(*) AS delay_events,
          cast(sum(delay_minutes) as bigint) AS total_delay_minutes, count(delay_minutes) AS n, max(delay_minutes) AS max_delay_minutes,
          count(*) FILTER (WHERE delay_minutes >= 10) AS delays_10min_plus
        FROM fct_delays GROUP BY 1, 2, 3)""",
        "dim_date": """
  SELECT cast(strftime(date_day, '%Y%m%d') as int) AS date_key, date_day, cast(year(date_day) as int) AS year,
    cast(quarter(date_day) as int) AS quarter, cast(month(date_day) as int) AS month, strftime(date_day, '%b') AS month_abbr,
    cast(date_trunc('month', date_day) as date) AS month_start, cast(isodow(date_day) as int) AS iso_day_of_week,
    strftime(date_day, '%a') AS day_abbr, isodow(date_day) IN (6, 7) AS is_weekend
  FROM (SELECT cast(unnest(generate_series(DATE '2014-01-01', DATE '2025-12-31', interval 1 day)) as date) AS date_day)""",
        "hours": """
  SELECT unnest(generate_series(cast(d0 as timestamp), cast(d1 as timestamp) + interval 23 hour, interval 1 hour)) AS hour
  FROM (SELECT min(delay_date) AS d0, max(delay_date) AS d1 FROM stg_delays)""",
        "line_hours": f"SELECT hour, unnest({_list(LINES)}) AS line FROM hours",
        "hourly": f"""
  SELECT line_group, date_trunc('hour', delay_at) AS hour, count(*) AS delays,
    count(*) FILTER (WHERE delay_minutes >= 5) AS delays_5min, cast(sum(delay_minutes) as bigint) AS delay_minutes
  FROM fct_delays WHERE line_group IN ({_LINES}) GROUP BY 1, 2""",
        "grid": """
  SELECT g.hour, g.line, coalesce(delays, 0) AS delays, coalesce(delays_5min, 0) AS delays_5min, coalesce(delay_minutes, 0) AS delay_minutes
  FROM line_hours g LEFT JOIN hourly d ON g.hour = d.hour AND g.line = d.line_group""",
        "weather": """
  SELECT hour, CASE WHEN m % 41 <> 0 THEN cast(m % 400 as double) / cast(10 as double) - cast(10 as double) END AS temperature_2m,
    cast(m % 50 as double) / cast(10 as double) AS precipitation,
    CASE WHEN m % 43 <> 0 THEN cast(m % 7 as double) END AS snowfall,
    cast(m % 300 as double) / cast(10 as double) AS wind_speed_10m
  FROM (SELECT date_trunc('hour', ts) + interval 2 day AS hour, min(event_id) AS m FROM event_log GROUP BY 1)""",
        "grid_weather": f"SELECT g.*, {_WEATHER} FROM grid g LEFT JOIN weather w ON g.hour = w.hour",
        "features": """
  SELECT *, cast(hour(hour) as int) AS hour_of_day, cast(isodow(hour) - 1 as int) AS weekday, cast(month(hour) as int) AS month,
    cast(isodow(hour) >= 6 as int) AS is_weekend, cast(hour(hour) >= 6 OR hour(hour) <= 1 as int) AS is_service_hour,
    cast(delays_5min > 0 as int) AS any_delay_5min
  FROM grid_weather""",
        "frame": "SELECT * FROM features WHERE temperature_2m IS NOT NULL",
        "history": """
  SELECT hour, line, delays, coalesce(lag(delays) OVER (PARTITION BY line ORDER BY hour), 0) AS delays_prev_1h,
    cast(coalesce(sum(delays) OVER (PARTITION BY line ORDER BY hour ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 0) as bigint) AS delays_prev_24h
  FROM grid""",
        "split": "SELECT max(hour) - interval 7 day AS split_at FROM frame",
        "train": "SELECT frame.* FROM frame, split WHERE hour < split_at",
        "test": "SELECT frame.* FROM frame, split WHERE hour >= split_at",
        "rate": "SELECT line, weekday, hour_of_day, avg(any_delay_5min) AS p FROM train GROUP BY 1, 2, 3",
        "baseline": """
  SELECT t.*, coalesce(r.p, (SELECT avg(any_delay_5min) FROM train)) AS p FROM test t LEFT JOIN rate r
  ON t.line = r.line AND t.weekday = r.weekday AND t.hour_of_day = r.hour_of_day""",
        "curve": """
  SELECT p, pos, neg, coalesce(sum(pos) OVER w, 0) AS pos_above, coalesce(sum(neg) OVER w, 0) AS neg_above
  FROM (SELECT p, sum(any_delay_5min) AS pos, sum(1 - any_delay_5min) AS neg FROM baseline GROUP BY 1)
  WINDOW w AS (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
        "requests": """
  SELECT event_id AS request_id, (['YU', 'BD', 'SHP', 'XX'])[event_id % 4 + 1] AS line, date_trunc('hour', ts) AS "at",
    ([NULL, '{"snowfall": 4}', '{"snowfall": "2.5", "humidity": 9}', '{"precipitation": "wet"}', 'not json', ''])[event_id // 4 % 6 + 1] AS weather
  FROM event_log""",
        "picked": f"""
  SELECT request_id, line, "at", weather, {_WEATHER},
    temperature_2m IS NOT NULL AND precipitation IS NOT NULL AND snowfall IS NOT NULL AND wind_speed_10m IS NOT NULL AS has_forecast
  FROM requests r LEFT JOIN weather w ON r."at" = w.hour""",
        "yearly": "SELECT cast(year(occurrence_date) as int) AS year, mci_category, count(*) AS incidents FROM fct_crime GROUP BY 1, 2",
        "place_rates": """
  SELECT year, m.neighbourhood_id, incidents, neighbourhood_name, population_2021,
    round(incidents * cast(1000 as double) / nullif(population_2021, 0), 6) AS per_1000
  FROM (SELECT cast(year(occurrence_date) as int) AS year, neighbourhood_id, count(*) AS incidents FROM fct_crime GROUP BY 1, 2) m
  JOIN dim_n n ON m.neighbourhood_id = n.neighbourhood_id""",
    }


_DIRTY, _CLEAN = _parts(False), _parts(True)
_ORACLES: dict[str, str] = {}


def _words(sql):
    return {w for w in "".join(c if c.isalnum() or c == "_" else " " for c in sql).split()}


def _sql(final, parts):
    """Prefix the SELECT with the parts it names, and the parts those name, in their listed order."""
    needed, todo = set(), [final]
    while todo:
        found = (_words(todo.pop()) & set(parts)) - needed
        needed |= found
        todo += [parts[p] for p in found]
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in parts.items() if name in needed)
    return f"WITH {ctes}\n{final}" if ctes else final


def _add(name, final, parts=_DIRTY):
    _ORACLES[name] = _sql(final, parts)


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)


_RAW_COLUMNS = (
    "cast(id as varchar) AS id, \"date\", \"time\", day, station, code, min_delay, min_gap, bound, line, vehicle"
)

# --- Landing and sinks
_add("s2_land_csv", f"SELECT {_RAW_COLUMNS}, {LOADED} AS _loaded_at FROM raw_delays")
_add(
    "s3_clean_ident",
    f"SELECT doc_id, md5(ident) AS ident_md5, length(ident) AS ident_length FROM (SELECT doc_id, {_clean('text')} AS ident FROM documents)",
)
_add(
    "s4_duplicate_idents",
    f"""SELECT ident, count(DISTINCT label) AS n_labels FROM (
  SELECT label, {_clean('label')} AS ident FROM (
    SELECT p_brand || ' ' || p_type AS label FROM part UNION ALL SELECT lower(p_brand || '_' || p_type) FROM part))
GROUP BY ident HAVING count(DISTINCT label) > 1""",
)
_add("s5_batch_stamp", f"SELECT count(*) AS n_rows, {LOADED} AS first_stamp, {LOADED} AS last_stamp FROM orders")
_add(
    "s6_full_refresh",
    """SELECT cast(0 as int) AS step, true AS shape_changed, count(*) AS n_rows, cast(12 as int) AS n_columns FROM raw_delays
UNION ALL SELECT 1, false, count(*), 12 FROM raw_delays WHERE bound <> ''
UNION ALL SELECT 2, true, count(*), 11 FROM raw_delays""",
)
_add(
    "s7_land_pages",
    f"""SELECT cast(id as varchar) AS id, "date", "time", day, station, code, nullif(min_delay, '') AS min_delay,
  nullif(min_gap, '') AS min_gap, nullif(bound, '') AS bound, line, vehicle, {LOADED} AS _loaded_at FROM raw_delays""",
)
_add(
    "s8_pinned_columns",
    """SELECT cast(event_id as varchar) AS id, CASE WHEN event_id % 5 = 0 THEN 'noted' END AS note_1, event_type AS type, value FROM events""",
)
_add(
    "s11_snapshots",
    """SELECT cast(20240201 as int) AS snapshot_date, count(*) AS n_rows FROM raw_delays
UNION ALL SELECT 20240202, count(*) FROM raw_delays WHERE bound <> ''""",
)
_add("s12_seed", "SELECT * FROM codes")
_add(
    "s13_materialize",
    "SELECT line_group, count(*) AS delay_events, cast(sum(delay_minutes) as bigint) AS delay_minutes FROM fct_delays GROUP BY 1",
)
_add("s14_weather_gaps", "SELECT hour FROM hours WHERE hour NOT IN (SELECT hour FROM weather)")
_add(
    "s14_weather_coverage",
    """SELECT first_hour, last_hour, first_hour <= cast(cast(h0 as date) as timestamp) AND last_hour >= cast(cast(h1 as date) as timestamp) AS covered
FROM (SELECT min(hour) AS first_hour, max(hour) AS last_hour FROM weather), (SELECT min(hour) AS h0, max(hour) AS h1 FROM hours)""",
)
_add("s15_weather_rows", f"SELECT hour, {_WEATHER} FROM weather")
_add("s16_forecast_pick", f'SELECT "at", request_id, line, {_WEATHER}, has_forecast FROM picked')
_ROC = "sum(neg * (2 * pos_above + pos)) / nullif(2.0 * sum(pos) * sum(neg), 0)"
_AP = "sum(pos * (pos_above + pos) / cast(pos_above + pos + neg_above + neg as double)) / sum(pos)"
_BRIER = "(SELECT avg(power(p - any_delay_5min, 2)) FROM baseline)"
_add(
    "s17_metrics_sink",
    f"SELECT round({_BRIER}, 6) AS brier, round({_AP}, 6) AS pr_auc, round(cast({_ROC} as double), 6) AS roc_auc FROM curve",
)
_TABLES = {
    "major_crime_indicators": "raw_crime",
    "ttc_subway_delays": "raw_delays",
    "neighbourhoods": "supplier",
    "neighbourhood_profiles": "raw_profiles",
}
_MODELS = {
    "stg_crime_incidents": "stg_crime",
    "stg_ttc_delays": "stg_delays",
    "stg_neighbourhoods": "stg_n",
    "stg_neighbourhood_profiles": "stg_p",
    "ttc_delay_codes": "codes",
    "dim_date": "dim_date",
    "dim_neighbourhood": "dim_n",
    "dim_ttc_delay_code": "dim_code",
    "fct_crime_incidents": "fct_crime",
    "fct_ttc_delays": "fct_delays",
    "agg_crime_monthly_neighbourhood": "agg_crime",
    "agg_ttc_delays_station_month": "agg_delays",
}


def _counts(tables):
    return "\nUNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {part}" for n, part in tables.items())


_add("s18_run_all", _counts(_TABLES | _MODELS) + "\nUNION ALL SELECT 'checks', 41 UNION ALL SELECT 'metrics', 1", _CLEAN)

# --- Reshape
_add(
    "r1_unpivot",
    """SELECT cast(100 + position as varchar) AS neighbourhood_number, 'Place ' || position AS neighbourhood_name,
  'Metric ' || sheet_row AS metric, max(CASE WHEN c_custkey // 25 = sheet_row AND c_custkey % 25 = position THEN c_mktsegment END) AS value
FROM (SELECT DISTINCT c_custkey // 25 AS sheet_row FROM customer) s
JOIN (SELECT unnest(range(25)) AS position) p ON position NOT IN (4, 9)
LEFT JOIN customer ON c_custkey = sheet_row * 25 + position
WHERE sheet_row % 7 <> 3 GROUP BY position, sheet_row""",
)
_add("r2_profile_pivot", "SELECT * FROM stg_p")
_add(
    "r3_dim_date",
    """SELECT d.*, coalesce(n, 0) AS incidents FROM dim_date d
LEFT JOIN (SELECT occurrence_date, count(*) AS n FROM fct_crime GROUP BY 1) f ON d.date_day = f.occurrence_date""",
)
_add("r4_hour_spine", "SELECT hour FROM hours")
_add("r5_line_hours", "SELECT hour, line FROM line_hours")

# --- Projections, filters, casts
_add("p1_stg_crime", f"SELECT *, {LOADED} AS _loaded_at FROM stg_crime")
_add("p2_stg_ttc_delays", f"SELECT *, {LOADED} AS _loaded_at FROM stg_delays")
_add("p3_stg_neighbourhoods", f"SELECT *, {LOADED} AS _loaded_at FROM stg_n")
_add("p4_stg_profiles", "SELECT * FROM stg_p")
_add(
    "p5_strict_cast",
    """SELECT mci_category, count(*) AS n_rows, max(source_row_id) AS max_id, min(occurrence_date) AS first_date,
  cast(sum(occurrence_hour) as bigint) AS sum_hour, max(longitude) AS max_longitude FROM stg_crime GROUP BY 1""",
)
_BAD = "SELECT '{0}' AS column_name, '{1}' AS type_name, count(*) AS n_bad, min({2}) AS example, '{4}' AS table_name FROM raw_{4} WHERE {3}"
_NONE = "SELECT '{0}' AS column_name, '{1}' AS type_name, cast(0 as bigint) AS n_bad, cast(NULL as varchar) AS example, '{2}' AS table_name"
_add(
    "p5b_bad_values",
    "\nUNION ALL ".join(
        [
            *[_NONE.format(c, "bigint" if c == "id" else "date" if c == "occ_date" else "double" if c == "long_wgs84" else "int", "crime")
              for c in ("id", "occ_date", "occ_year", "report_hour", "long_wgs84")],
            _BAD.format("report_date", "date", "strftime(report_date, '%Y-%m')", "id % 61 = 0", "crime"),
            _BAD.format("occ_hour", "int", "'noon'", "id % 67 = 0", "crime"),
            _BAD.format("hood_158", "int", "'n/a'", "id % 71 = 0", "crime"),
            _BAD.format("lat_wgs84", "double", "coalesce(lat, '') || 'N'", "id % 73 = 0", "crime"),
            *[_NONE.format(c, k, "delays") for c, k in (("id", "bigint"), ("date", "date"), ("min_gap", "int"))],
            _BAD.format("min_delay", "int", "'ten'", "id % 59 = 0", "delays"),
            _BAD.format("time", "time", "'25:61'", "id % 83 = 0", "delays"),
        ]
    ),
)
_add(
    "p6_blank_to_null",
    """SELECT bound, count(*) AS n_rows, count(delay_minutes) AS n_minutes, count(gap_minutes) AS n_gap, count(vehicle) AS n_vehicle
FROM stg_delays GROUP BY 1""",
)
_add("p7_sentinel_to_null", "SELECT source_row_id AS id, neighbourhood_id FROM stg_crime")
_add("p8_line_group", "SELECT line, line_group, count(*) AS n_rows FROM stg_delays GROUP BY 1, 2")
_add("p9_prefix_flag", "SELECT neighbourhood_id, is_improvement_area FROM stg_n")
_add("p10_text_timestamp", "SELECT event_id AS id, date_trunc('minute', ts) AS delay_at FROM event_log")
_add("p11_fact_date_filter", "SELECT * FROM fct_crime")
_add(
    "p11_year_by_month",
    """SELECT cast(month(occurrence_date) as int) AS month, mci_category, count(*) AS incidents FROM fct_crime
WHERE year(occurrence_date) = 2018 GROUP BY 1, 2""",
)
_add(
    "p11_weekend_days",
    """SELECT date_day, day_abbr, count(*) AS incidents FROM fct_crime f JOIN dim_date d ON f.occurrence_date_key = d.date_key
WHERE d.is_weekend AND d.year = 2018 GROUP BY 1, 2""",
)
_add(
    "p12_calendar_attributes",
    "SELECT d.*, n_rows FROM dim_date d JOIN (SELECT delay_date, count(*) AS n_rows FROM stg_delays GROUP BY 1) f ON d.date_day = f.delay_date",
)
_add("p13_code_family", "SELECT * FROM dim_code")
_add("p14_date_key", "SELECT delay_date_key, count(*) AS n_rows FROM fct_delays GROUP BY 1")
_add("p15_days_to_report", "SELECT days_to_report, count(*) AS n_rows FROM fct_crime GROUP BY 1")
_add(
    "p16_has_temperature",
    f"SELECT hour, line, delays, delays_5min, {_WEATHER} FROM grid_weather WHERE temperature_2m IS NOT NULL",
)
_add("p17_in_list", f"SELECT ttc_delay_key, line_group FROM fct_delays WHERE line_group IN ({_LINES})")
_add("p18_bi_columns", "SELECT * EXCLUDE (geometry_geojson) FROM dim_n")

# --- Joins
_add("j1_dim_neighbourhood", "SELECT * FROM dim_n")
_add("j2_fct_ttc_delays", "SELECT * FROM fct_delays")
_add(
    "j3_known_places",
    """SELECT n.neighbourhood_id, neighbourhood_name, count(*) AS incidents FROM fct_crime f
JOIN dim_n n ON f.neighbourhood_id = n.neighbourhood_id GROUP BY 1, 2""",
)
_add(
    "j4_hours_by_line",
    "SELECT line, count(*) AS n_hours, min(hour) AS first_hour, max(hour) AS last_hour FROM line_hours GROUP BY 1",
)
_add("j5_grid_counts", "SELECT * FROM grid WHERE delays > 0")
_add("j6_grid_weather", "SELECT * FROM grid_weather")
_add("j7_baseline_join", "SELECT hour, line, any_delay_5min, round(p, 6) AS p FROM baseline")
_add(
    "j8_relationships",
    """SELECT neighbourhood_id, count(*) AS n_rows FROM fct_crime
WHERE neighbourhood_id IS NOT NULL AND neighbourhood_id NOT IN (SELECT neighbourhood_id FROM dim_n) GROUP BY 1""",
)
_add(
    "j9_star_crime",
    """SELECT year, is_weekend, is_improvement_area, mci_category, count(*) AS incidents FROM fct_crime f
LEFT JOIN dim_date d ON f.occurrence_date_key = d.date_key LEFT JOIN dim_n n ON f.neighbourhood_id = n.neighbourhood_id GROUP BY 1, 2, 3, 4""",
)
_add(
    "j9_star_delays",
    """SELECT day_abbr, system, code_family_hint, count(*) AS delay_events, cast(sum(delay_minutes) as bigint) AS delay_minutes,
  count(*) FILTER (WHERE delay_minutes >= 10) AS delays_10min_plus
FROM fct_delays f LEFT JOIN dim_date d ON f.delay_date_key = d.date_key LEFT JOIN dim_code c ON f.delay_code = c.delay_code GROUP BY 1, 2, 3""",
)
_add("j10_requests_forecast", "SELECT line, has_forecast, count(*) AS n_requests FROM picked GROUP BY 1, 2")

# --- Aggregations
_add("a1_crime_monthly", "SELECT * FROM agg_crime")
_add("a2_ttc_station_month", "SELECT * FROM agg_delays")
_add("a3_hourly_delays", "SELECT * FROM hourly")
_add(
    "a4_filtered_count",
    "SELECT station, count(*) FILTER (WHERE delay_minutes >= 10) AS delays_10min_plus FROM fct_delays GROUP BY 1",
)
_add("a5_bounds", "SELECT min(delay_date) AS first_date, max(delay_date) AS last_date FROM fct_delays")
_add(
    "a6_group_rate",
    "SELECT line, weekday, hour_of_day, round(avg(any_delay_5min), 6) AS p FROM frame GROUP BY 1, 2, 3",
)
_add("a7_conditional_max", "SELECT neighbourhood_id, population_2021 FROM stg_p")
_add(
    "a8_having_duplicates",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
_add("a9_row_counts", _counts(_TABLES))
_add(
    "a10_positive_rate",
    """SELECT 'train' AS part, count(*) AS n_rows, round(avg(any_delay_5min), 6) AS positive_rate FROM train
UNION ALL SELECT 'test', count(*), round(avg(any_delay_5min), 6) FROM test""",
)

# --- Ordered functions, top-k
_add("w1_prev_1h", "SELECT hour, line, delays, delays_prev_1h FROM history")
_add("w2_prev_24h", "SELECT hour, line, delays, delays_prev_24h FROM history")
_add(
    "w3_history_optional",
    """SELECT f.hour, f.line, any_delay_5min, delays_prev_1h, delays_prev_24h FROM frame f
JOIN history h ON f.hour = h.hour AND f.line = h.line""",
)
_add(
    "w4_top_per_group",
    """SELECT year, cast(rank as int) AS rank, neighbourhood_id, per_1000 FROM (
  SELECT *, row_number() OVER (PARTITION BY year ORDER BY per_1000 DESC NULLS LAST, neighbourhood_id) AS rank FROM place_rates)
WHERE rank <= 3""",
)


def _yoy(source, keys):
    on = " AND ".join([f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in keys] + ["a.year = b.year + 1"])
    shown = ", ".join([f"coalesce(a.{k}, b.{k}) AS {k}" for k in keys] + ["cast(coalesce(a.year, b.year + 1) as int) AS year"])
    return f"""SELECT {shown}, cast(coalesce(a.incidents, 0) as bigint) AS incidents, cast(coalesce(b.incidents, 0) as bigint) AS previous,
  round((coalesce(a.incidents, 0) - b.incidents) / cast(b.incidents as double), 6) AS change
FROM {source} a FULL JOIN {source} b ON {on}"""


_add("w5_yoy", _yoy("yearly", ["mci_category"]))
_add("t1_grid_ordered", "SELECT * FROM grid ORDER BY hour, line")
_add(
    "t2_top_station_months",
    """SELECT month_start, station, line, total_delay_minutes FROM agg_delays
ORDER BY total_delay_minutes DESC NULLS LAST, month_start, station, line NULLS FIRST LIMIT 10""",
)
_AREA_RATES = """SELECT n.neighbourhood_id, neighbourhood_name, is_improvement_area, incidents, cast(population_2021 as bigint) AS population,
  round(incidents * cast(1000 as double) / nullif(population_2021, 0), 6) AS per_1000
FROM dim_n n LEFT JOIN (SELECT neighbourhood_id, count(*) AS incidents FROM fct_crime GROUP BY 1) f ON n.neighbourhood_id = f.neighbourhood_id"""
_add(
    "t3_top_rates",
    f"SELECT neighbourhood_id, per_1000 FROM ({_AREA_RATES}) WHERE per_1000 IS NOT NULL ORDER BY per_1000 DESC, neighbourhood_id LIMIT 15",
)
_add(
    "t4_shift_by_hour",
    """SELECT hour, line, coalesce(lag(delays) OVER (PARTITION BY line ORDER BY hour), 0) AS delays_prev_1h,
  cast(coalesce(sum(delays) OVER (PARTITION BY line ORDER BY hour ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 0) as bigint) AS delays_prev_24h
FROM grid WHERE delays > 0""",
)

# --- Scalar functions
_add("f1_trim", "SELECT id, mci_category AS v, occ_dow AS w FROM raw_crime")
_add("f2_upper_trim", "SELECT id, upper(trim(station)) AS v FROM raw_delays")
_add("f3_nullif", "SELECT id, nullif(min_delay, '') AS v FROM raw_delays")
_add("f4_coalesce", "SELECT ttc_delay_key, coalesce(delay_minutes, 0) AS v, delay_description FROM fct_delays")
_add("f5_concat", "SELECT id, strftime(occ_date, '%Y-%m-%d') || ' ' || division AS v FROM raw_crime")
_add("f6_substr", "SELECT source_row_id, substr(delay_code, 2, 1) AS v FROM stg_delays")
_add("f7_like_prefix", "SELECT source_row_id, line LIKE 'YU%' AS v FROM stg_delays")
_add(
    "f8_case",
    "SELECT source_row_id, CASE substr(delay_code, 2, 1) WHEN 'U' THEN 'Equipment' WHEN 'R' THEN 'Equipment' ELSE 'Other' END AS v FROM stg_delays",
)
_add("f9_in", "SELECT id, hood_158 IN ('NSA', '') AS v FROM raw_crime")
_add(
    "f10_date_format",
    """SELECT source_row_id, cast(strftime(occurrence_date, '%Y%m%d') as int) AS k, strftime(occurrence_date, '%b') AS m,
  strftime(occurrence_date, '%a') AS d FROM stg_crime""",
)
_add(
    "f11_extract",
    """SELECT source_row_id, cast(year(delay_at) as int) AS y, cast(quarter(delay_at) as int) AS q, cast(month(delay_at) as int) AS m,
  cast(isodow(delay_at) as int) AS d, cast(hour(delay_at) as int) AS h FROM stg_delays""",
)
_add(
    "f12_date_trunc",
    """SELECT source_row_id, cast(date_trunc('month', delay_date) as date) AS m, cast(date_trunc('year', delay_date) as date) AS y,
  date_trunc('hour', delay_at) AS h FROM stg_delays""",
)
_add("f13_date_difference", "SELECT source_row_id, cast(report_date - occurrence_date as int) AS v FROM stg_crime")
_add("f14_interval_add", "SELECT source_row_id, delay_at + interval 23 hour AS v FROM stg_delays")
_add(
    "f15_round_numeric",
    f"SELECT l_orderkey, {_half_up('s', 'n', 2)} AS v FROM (SELECT l_orderkey, cast(sum(cast(l_quantity as int)) as bigint) AS s, count(*) AS n FROM lineitem GROUP BY 1)",
)
_add(
    "f16_numeric_to_int",
    f"""SELECT cast(neighbourhood_id as varchar) AS neighbourhood_number,
  cast(sum(cast(round(cast(nullif(value, '') as decimal(18, 3)), 0) as bigint)) as bigint) AS v
FROM raw_profiles WHERE metric = '{_POP}' GROUP BY 1""",
)
_add(
    "f17_safe_division",
    f"SELECT neighbourhood_id, CASE WHEN population_2021 <> 0 THEN {_half_up('(cast(households_2021 as bigint) * 1000)', 'population_2021', 3)} END AS v FROM dim_n",
)
_add("f18_ident_functions", f"SELECT {_clean('c_name')} AS v, count(*) AS n_rows FROM customer GROUP BY 1")
_add("f19_strip", "SELECT event_id, event_type AS v FROM events")
_add(
    "f20_time_parts",
    "SELECT source_row_id, cast(hour(delay_at) as int) AS h, cast(isodow(delay_at) - 1 as int) AS w, cast(month(delay_at) as int) AS m FROM stg_delays",
)
_add("f21_floor_hour", "SELECT event_id, date_trunc('hour', ts) AS v FROM events")
_add("f22_flags", "SELECT hour, line, is_weekend, is_service_hour, any_delay_5min FROM features")
_NUMBER = "try_cast(json_extract_string(CASE WHEN json_valid(weather) THEN weather END, '$.{0}') as double)"
_ABSENT = "json_extract_string(CASE WHEN json_valid(weather) THEN weather END, '$.{0}') IS NULL"
_OVERRIDE_OK = (
    "(weather IS NULL OR weather = '' OR (json_valid(weather) AND "
    + " AND ".join(f"({_ABSENT.format(n)} OR {_NUMBER.format(n)} IS NOT NULL)" for n in _WEATHER.split(", "))
    + "))"
)


def _overridden(defaults):
    return ", ".join(f"coalesce({_NUMBER.format(n)}, {d}) AS {n}" for n, d in defaults.items())


_VARS = _WEATHER.split(", ")
_add(
    "f23_override",
    f"SELECT request_id, line, {_overridden({n: 'cast(0.5 as double)' for n in _VARS})}, {_OVERRIDE_OK} AS override_ok FROM requests",
)
_add(
    "f24_round",
    "SELECT line, hour_of_day, round(avg(any_delay_5min), 3) AS p FROM frame GROUP BY 1, 2",
)

# --- Data tests
_add("q1_not_null", "SELECT source_row_id FROM stg_crime WHERE occurrence_date IS NULL")
_add("q2_unique", "SELECT l_orderkey, count(*) AS n_rows FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
_add(
    "q3_accepted_values",
    f"SELECT mci_category, count(*) AS n_rows FROM stg_crime WHERE mci_category NOT IN ({_CATEGORIES}) GROUP BY 1",
)
_add(
    "q4_relationships",
    "SELECT delay_code, count(*) AS n_rows FROM stg_delays WHERE delay_code NOT IN (SELECT delay_code FROM codes) GROUP BY 1",
)
_add("q5_non_negative", "SELECT crime_incident_key, days_to_report FROM fct_crime WHERE days_to_report < 0")
_add(
    "q6_unique_combination",
    "SELECT event_id, mci_category, count(*) AS n_rows FROM fct_crime GROUP BY 1, 2 HAVING count(*) > 1",
)
_add(
    "q7_no_future",
    """SELECT crime_incident_key, occurrence_date, report_date FROM fct_crime
WHERE occurrence_date > DATE '2019-01-01' OR report_date > DATE '2019-01-01'""",
)
_add(
    "q8_plausible",
    "SELECT month_start, neighbourhood_id, mci_category, incidents_per_1000 FROM agg_crime WHERE incidents_per_1000 > 100",
)
_add(
    "q9_freshness",
    f"""SELECT max_loaded_at, days, CASE WHEN {LOADED} + days * 86400 - max_loaded_at <= 2 * 86400 THEN 'pass'
  WHEN {LOADED} + days * 86400 - max_loaded_at <= 7 * 86400 THEN 'warn' ELSE 'error' END AS status
FROM (SELECT cast(epoch(max(cast("date" as date)) + interval 1 day) as bigint) AS max_loaded_at FROM raw_delays),
  (VALUES (cast(-30 as int)), (0), (3), (9)) v(days)""",
)


def _check(table, kind, column, count_sql):
    return (
        f"SELECT '{table}' AS table_name, '{kind}' AS check_name, '{column}' AS column_name, n AS n_failed, "
        f"CASE WHEN n = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({count_sql})"
    )


def _all_checks():
    part = _MODELS

    def nulls(t, c):
        return _check(t, "not_null", c, f"SELECT count(*) AS n FROM {part[t]} WHERE {c} IS NULL")

    def duplicates(t, c):
        inner = f"SELECT {c} FROM {part[t]} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
        return _check(t, "unique", c, f"SELECT count(*) AS n FROM ({inner})")

    def where(t, kind, c, condition):
        return _check(t, kind, c, f"SELECT count(*) AS n FROM {part[t]} WHERE {condition}")

    def combination(t, columns):
        inner = f"SELECT 1 FROM {part[t]} GROUP BY {columns} HAVING count(*) > 1"
        return _check(t, "unique_combination", columns, f"SELECT count(*) AS n FROM ({inner})")

    def outside(t, c, values):
        return _check(t, "accepted_values", c, f"SELECT count(DISTINCT {c}) AS n FROM {part[t]} WHERE {c} NOT IN ({values})")

    def orphans(t, c, parent, key):
        return where(t, "relationships", c, f"{c} IS NOT NULL AND {c} NOT IN (SELECT {key} FROM {part[parent]})")

    both = [
        ("stg_crime_incidents", "source_row_id"),
        ("stg_ttc_delays", "source_row_id"),
        ("stg_neighbourhoods", "neighbourhood_id"),
        ("stg_neighbourhoods", "neighbourhood_name"),
        ("stg_neighbourhood_profiles", "neighbourhood_id"),
        ("ttc_delay_codes", "delay_code"),
        ("dim_date", "date_key"),
        ("dim_neighbourhood", "neighbourhood_id"),
        ("dim_ttc_delay_code", "delay_code"),
        ("fct_crime_incidents", "crime_incident_key"),
        ("fct_ttc_delays", "ttc_delay_key"),
    ]
    filled = [
        ("stg_crime_incidents", "event_id"),
        ("stg_crime_incidents", "occurrence_date"),
        ("stg_crime_incidents", "mci_category"),
        ("stg_ttc_delays", "delay_date"),
        ("stg_neighbourhood_profiles", "population_2021"),
        ("dim_neighbourhood", "population_2021"),
        ("fct_crime_incidents", "occurrence_date_key"),
    ]
    crime, agg = "fct_crime_incidents", "agg_crime_monthly_neighbourhood"
    today = "DATE '2024-06-30'"
    return [
        *[f(t, c) for t, c in both for f in (duplicates, nulls)],
        *[nulls(t, c) for t, c in filled],
        outside("stg_crime_incidents", "mci_category", _CATEGORIES),
        outside("stg_ttc_delays", "line_group", _LINES + ", 'OTHER'"),
        orphans(crime, "occurrence_date_key", "dim_date", "date_key"),
        orphans(crime, "neighbourhood_id", "dim_neighbourhood", "neighbourhood_id"),
        orphans("fct_ttc_delays", "delay_date_key", "dim_date", "date_key"),
        where("stg_ttc_delays", "non_negative", "delay_minutes", "delay_minutes < 0"),
        where(crime, "non_negative", "days_to_report", "days_to_report < 0"),
        where(agg, "non_negative", "incidents_per_1000", "incidents_per_1000 < 0"),
        combination(agg, "month_start, neighbourhood_id, mci_category"),
        combination("agg_ttc_delays_station_month", "month_start, station, line"),
        where(crime, "no_future", "occurrence_date, report_date", f"occurrence_date > {today} OR report_date > {today}"),
        where(agg, "plausible", "incidents_per_1000", "incidents_per_1000 > 100"),
    ]


_add("q10_run_checks", "\nUNION ALL ".join(_all_checks()))

# --- Model
_add("m1_grid", "SELECT * FROM grid")
_add("m2_features", f"SELECT * EXCLUDE ({_WEATHER}) FROM features")
_add(
    "m3_training_frame",
    """SELECT f.*, delays_prev_1h, delays_prev_24h FROM frame f JOIN history h ON f.hour = h.hour AND f.line = h.line""",
)
_add(
    "m5_split",
    """SELECT 'train' AS part, count(*) AS n_rows, min(hour) AS first_hour, max(hour) AS last_hour FROM train
UNION ALL SELECT 'test', count(*), min(hour), max(hour) FROM test""",
)
_add("m6_classifier", "SELECT hour, line, any_delay_5min, true AS has_p FROM test")
_add("m11_informed", "SELECT hour, line, any_delay_5min, true AS has_p FROM test")
_add("m13_refit_save", "SELECT count(*) AS n_rows, cast(0 as bigint) AS n_differ FROM frame")
_add(
    "m7_baseline",
    "SELECT line, weekday, hour_of_day, count(*) AS n_rows, round(min(p), 6) AS p FROM baseline GROUP BY 1, 2, 3",
)
_add("m8_roc_auc", f"SELECT round(cast({_ROC} as double), 6) AS roc_auc FROM curve")
_add("m9_pr_auc", f"SELECT round({_AP}, 6) AS pr_auc FROM curve")
_add("m10_brier", f"SELECT round({_BRIER}, 6) AS brier")
_add(
    "m12_metrics_row",
    f"""SELECT '2024-02-01T06:00:00+00:00' AS trained_at, (SELECT count(*) FROM train) AS rows_train, (SELECT count(*) FROM test) AS rows_test,
  (SELECT strftime(split_at, '%Y-%m-%d') FROM split) AS test_from, (SELECT round(avg(any_delay_5min), 4) FROM frame) AS positive_rate,
  round(cast({_ROC} as double), 4) AS roc_auc, round({_AP}, 4) AS pr_auc, round({_BRIER}, 4) AS brier FROM curve""",
)
_STATUS = f"""CASE WHEN line NOT IN ({_LINES}) THEN 'bad_line' WHEN NOT has_forecast THEN 'no_weather'
    WHEN NOT {_OVERRIDE_OK} THEN 'bad_override' ELSE 'ok' END"""
_add(
    "m14_score",
    f"""SELECT request_id, line, "at", {_overridden({n: n for n in _VARS})}, {_STATUS} AS status, {_STATUS} = 'ok' AS has_p FROM picked""",
)
_add(
    "m14_request_status",
    f"""SELECT {_STATUS} AS status,
  count(*) AS n_requests, round(sum(coalesce({_NUMBER.format('snowfall')}, snowfall)), 6) AS sum_snowfall
FROM picked GROUP BY 1""",
)

# --- Reports
_add("b1_incidents", "SELECT mci_category, police_division, count(*) AS incidents FROM fct_crime GROUP BY 1, 2")
_add("b2_population", "SELECT is_improvement_area, cast(sum(population_2021) as bigint) AS population FROM dim_n GROUP BY 1")
_add(
    "b3_rate",
    """SELECT tsns_classification, cast(sum(incidents) as bigint) AS incidents, cast(sum(population) as bigint) AS population,
  round(sum(incidents) * cast(1000 as double) / nullif(sum(population), 0), 6) AS per_1000
FROM (SELECT tsns_classification, 1 AS incidents, NULL AS population FROM fct_crime f LEFT JOIN dim_n n ON f.neighbourhood_id = n.neighbourhood_id
  UNION ALL SELECT tsns_classification, NULL, population_2021 FROM dim_n
  UNION ALL SELECT '(all)', 1, NULL FROM fct_crime UNION ALL SELECT '(all)', NULL, population_2021 FROM dim_n)
GROUP BY 1""",
)
_YEARS = "(SELECT year, cast(sum(incidents) as bigint) AS incidents FROM yearly GROUP BY 1)"
_add("b4_yoy", f"SELECT * FROM ({_yoy(_YEARS, [])}) WHERE year IN (SELECT year FROM dim_date)")
_add(
    "b5_delay_measures",
    """SELECT line_group, count(*) AS delay_events, cast(sum(delay_minutes) as bigint) AS delay_minutes,
  round(avg(delay_minutes), 6) AS avg_delay_minutes, count(*) FILTER (WHERE delay_minutes >= 10) AS delays_10min_plus
FROM fct_delays GROUP BY 1""",
)
_add(
    "b6_month_category",
    "SELECT cast(date_trunc('month', occurrence_date) as date) AS month_start, mci_category, count(*) AS incidents FROM fct_crime GROUP BY 1, 2",
)
_add("b7_top_neighbourhoods", f"SELECT * FROM ({_AREA_RATES}) WHERE per_1000 IS NOT NULL ORDER BY per_1000 DESC, neighbourhood_id LIMIT 15")
_add(
    "b8_station_month",
    "SELECT station, strftime(delay_date, '%Y-%m') AS month, cast(sum(delay_minutes) as bigint) AS delay_minutes FROM fct_delays GROUP BY 1, 2",
)
_add(
    "b8_matrix",
    "SELECT station, "
    + ", ".join(f"""cast(sum(delay_minutes) FILTER (WHERE strftime(delay_date, '%Y-%m') = '{m}') as bigint) AS "{m}\"""" for m in ("2024-01", "2024-02"))
    + " FROM fct_delays GROUP BY 1",
)
_add("b9_minutes_by_cause", "SELECT delay_description, cast(sum(delay_minutes) as bigint) AS delay_minutes FROM fct_delays GROUP BY 1")
_add("b10_hour_histogram", "SELECT delay_hour, count(*) AS delay_events FROM fct_delays GROUP BY 1")
_add(
    "b11_auto_theft",
    f"SELECT * FROM ({_yoy('''(SELECT year, incidents FROM yearly WHERE mci_category = 'Auto Theft')''', [])}) WHERE incidents > 0",
)
_add("b12_yearly_rates", "SELECT neighbourhood_id, year, incidents, neighbourhood_name, population_2021, per_1000 FROM place_rates")
_add(
    "b13_top_cause",
    """SELECT delay_description, count(*) AS delay_events, cast(sum(delay_minutes) as bigint) AS delay_minutes FROM fct_delays
WHERE delay_date >= DATE '2024-01-10' GROUP BY 1 ORDER BY 3 DESC NULLS LAST, 1 LIMIT 1""",
)
_add(
    "b14_top_station",
    """SELECT line_group, station, delay_minutes, cast(rank as int) AS rank FROM (
  SELECT line_group, station, cast(sum(delay_minutes) as bigint) AS delay_minutes,
    row_number() OVER (PARTITION BY line_group ORDER BY sum(delay_minutes) DESC NULLS LAST, station) AS rank
  FROM fct_delays GROUP BY 1, 2) WHERE rank = 1""",
)
_add(
    "b15_late_share",
    """SELECT count(*) AS incidents, count(*) FILTER (WHERE days_to_report > 30) AS late,
  round(count(*) FILTER (WHERE days_to_report > 30) / cast(count(*) as double), 6) AS share_late FROM fct_crime""",
)
_add(
    "b16_top_station_months",
    "SELECT * FROM agg_delays ORDER BY total_delay_minutes DESC NULLS LAST, month_start, station, line NULLS FIRST LIMIT 10",
)

# --- Ideas the model's notes describe
_DIFF = """SELECT source_row_id, 'changed' AS change FROM stg_crime WHERE source_row_id % 17 = 0 AND (source_row_id % 19 <> 0 OR source_row_id = 0)
UNION ALL SELECT source_row_id, 'removed' FROM stg_crime WHERE source_row_id % 19 = 0 AND source_row_id <> 0
UNION ALL SELECT -source_row_id, 'added' FROM stg_crime WHERE source_row_id % 19 = 0 AND source_row_id <> 0"""
_add("x1_snapshot_diff", _DIFF)
_add("x1_bucketed_diff", _DIFF)
_add(
    "x2_latest_by_key",
    f"""SELECT event_id, source_row_id, mci_category, CASE WHEN mci_category = 'Robbery' THEN {LOADED} + 86400 ELSE {LOADED} END AS _loaded_at
FROM stg_crime WHERE mci_category = 'Robbery'
  OR event_id NOT IN (SELECT event_id FROM stg_crime WHERE mci_category = 'Robbery')""",
)
_LATER = "mci_category = 'Robbery' AND occurrence_date >= DATE '2019-01-01'"
_add(
    "x2_incremental_fact",
    f"""SELECT event_id, source_row_id, cast(occurrence_date + cast(CASE WHEN source_row_id % 10 = 0 THEN 40 ELSE 0 END as int) as date) AS occurrence_date,
  mci_category, {LOADED} + 86400 AS _loaded_at FROM stg_crime WHERE {_LATER}
UNION ALL SELECT event_id, source_row_id, occurrence_date, mci_category, {LOADED} FROM stg_crime
WHERE event_id NOT IN (SELECT event_id FROM stg_crime WHERE {_LATER})""",
)
_add(
    "x3_volume_check",
    """SELECT month_start, n_rows, round(mean_rows, 6) AS mean_rows, round(sd_rows, 6) AS sd_rows FROM (
  SELECT *, avg(n_rows) OVER () AS mean_rows, stddev_samp(n_rows) OVER () AS sd_rows FROM (
    SELECT cast(date_trunc('month', occurrence_date) as date) AS month_start, count(*) AS n_rows FROM fct_crime GROUP BY 1))
WHERE abs(n_rows - mean_rows) > sd_rows""",
)
for _query, _key in (("x4_station_grid", "station"), ("x4_code_grid", "delay_code")):
    _add(
        _query,
        f"""SELECT line, count(*) AS n_hours, count(*) FILTER (WHERE delays_5min > 0) AS n_late_hours, cast(sum(coalesce(delays, 0)) as bigint) AS delays,
  cast(sum(coalesce(delay_minutes, 0)) as bigint) AS delay_minutes
FROM (SELECT hour, {_key} AS line FROM hours, (SELECT DISTINCT {_key} FROM fct_delays WHERE {_key} IS NOT NULL)) h
LEFT JOIN (SELECT {_key} AS value, date_trunc('hour', delay_at) AS hour, count(*) AS delays, count(*) FILTER (WHERE delay_minutes >= 5) AS delays_5min,
    sum(delay_minutes) AS delay_minutes FROM fct_delays GROUP BY 1, 2) d ON h.hour = d.hour AND h.line = d.value
GROUP BY 1""",
    )
