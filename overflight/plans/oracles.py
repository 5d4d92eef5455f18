"""The same results as ``registry`` in plain SQL, straight from the tables.

The statements share no code with the operators: they compute on the events
what the queries compute on JSON documents made of them.
"""

from __future__ import annotations

# A snapshot is due every ten minutes and comes up to 40 seconds late.
_SNAPSHOT = """time_bucket(INTERVAL '10 minutes', ts) + to_seconds(
           (CAST(epoch(time_bucket(INTERVAL '10 minutes', ts)) AS BIGINT) // 600 * 7) % 41)"""

# One row per event with the fields of its state vector.
VECTORS = """
vectors AS (
  SELECT event_id, ts, """ + _SNAPSHOT + """ AS snapshot_time,
         lower(to_hex(user_id)) AS icao24,
         CASE WHEN event_id % 17 = 0 THEN NULL ELSE event_type END AS callsign,
         'Country ' || (user_id % 7) AS origin_country,
         CAST(floor(epoch(ts)) AS BIGINT) AS time_position,
         CAST(floor(epoch(ts)) AS BIGINT) + 1 AS last_contact,
         -20.0::DOUBLE + ((user_id * 7919 + event_id * 31) % 10000) / 100.0::DOUBLE AS longitude,
         10.0::DOUBLE + ((user_id * 104729 + event_id * 17) % 5500) / 100.0::DOUBLE AS latitude,
         CASE WHEN event_id % 13 <> 0 THEN value * 10.0::DOUBLE END AS baro_altitude,
         event_type = 'error' AS on_ground,
         value AS velocity,
         CASE WHEN event_id % 20 = 0 THEN 505.5::DOUBLE ELSE CAST(event_id % 361 AS DOUBLE) END AS true_track,
         CAST(event_id % 41 - 20 AS DOUBLE) AS vertical_rate,
         CASE WHEN event_id % 11 = 0 THEN user_id || ',7' END AS sensors,
         value * 10.0::DOUBLE + 5.5::DOUBLE AS geo_altitude,
         CASE WHEN event_id % 7 <> 0 THEN lpad(CAST(event_id % 7777 AS VARCHAR), 4, '0') END AS squawk,
         event_id % 50 = 0 AS spi,
         CAST(CASE WHEN event_id % 20 = 0 THEN 3 ELSE 0 END AS BIGINT) AS position_source
  FROM events
)"""

# One row per snapshot.
BRONZE = """
bronze AS (
  SELECT """ + _SNAPSHOT + """ AS snapshot_time,
         CAST(time_bucket(INTERVAL '10 minutes', ts) AS DATE) AS dt, count(*) AS vectors,
         CAST(CAST(time_bucket(INTERVAL '10 minutes', ts) AS DATE) + 1 AS TIMESTAMP) AS loaded_at
  FROM events GROUP BY ALL
)"""

STATES = VECTORS + """,
states AS (
  SELECT snapshot_time, CAST(snapshot_time AS DATE) AS dt,
         CASE WHEN longitude BETWEEN 18 AND 44 AND latitude BETWEEN 42 AND 55 THEN 'ukraine'
              WHEN longitude BETWEEN 36 AND 66 AND latitude BETWEEN 24 AND 42 THEN 'middle_east'
              WHEN longitude BETWEEN 2 AND 12 AND latitude BETWEEN 45 AND 52 THEN 'west_europe'
              ELSE 'other' END AS region,
         CAST(CAST(snapshot_time AS DATE) + 1 AS TIMESTAMP) AS _loaded_at,
         icao24, callsign, origin_country, time_position, last_contact, longitude, latitude, baro_altitude,
         on_ground, velocity, true_track, vertical_rate, sensors, geo_altitude, squawk, spi, position_source
  FROM vectors
  WHERE longitude BETWEEN -10 AND 70 AND latitude BETWEEN 18 AND 60
)"""

MARTS = STATES + """,
coverage AS (
  SELECT dt, count(DISTINCT snapshot_time) AS snapshots_observed,
         round(count(DISTINCT snapshot_time) / 144.0::DOUBLE, 3) AS coverage_pct
  FROM states GROUP BY dt
),
areas(region, area_sqdeg) AS (
  VALUES ('ukraine', 338.0::DOUBLE), ('middle_east', 540.0::DOUBLE), ('west_europe', 70.0::DOUBLE)
),
region_mart AS (
  SELECT s.dt, s.snapshot_time, s.region, count(*) AS aircraft_count, a.area_sqdeg,
         round(CAST(count(*) AS DOUBLE) / a.area_sqdeg, 4) AS density, c.coverage_pct
  FROM states s JOIN areas a ON a.region = s.region JOIN coverage c ON c.dt = s.dt
  WHERE s.on_ground = false AND s.position_source = 0
  GROUP BY s.dt, s.snapshot_time, s.region, a.area_sqdeg, c.coverage_pct
),
points AS (
  SELECT time_bucket(INTERVAL '30 minutes', snapshot_time) AS snapshot_bucket, snapshot_time, region, longitude,
         latitude, callsign, origin_country, baro_altitude, velocity
  FROM states
  WHERE on_ground = false AND position_source = 0 AND extract(minute FROM snapshot_time) IN (0, 30)
)"""


def _grid(cell: float) -> str:
    return f"""
grid AS (
  SELECT dt, region, floor(longitude / {cell}::DOUBLE) * {cell}::DOUBLE AS cell_lon,
         floor(latitude / {cell}::DOUBLE) * {cell}::DOUBLE AS cell_lat, count(*) AS aircraft_count
  FROM states WHERE on_ground = false AND position_source = 0 GROUP BY ALL
)"""


GRID_MART = MARTS + "," + _grid(0.5) + """,
grid_mart AS (SELECT g.*, c.coverage_pct FROM grid g JOIN coverage c USING (dt))"""

SERIES = """
hourly AS (SELECT *, date_trunc('hour', ts) AS h FROM events),
by_type AS (
  SELECT h, event_type, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / (count(*) * 100) AS mean
  FROM hourly GROUP BY ALL
),
overall AS (
  SELECT h, max(value) AS top, count(*) FILTER (event_type = 'error') AS errors,
         count(*) FILTER (event_type = 'view') AS views,
         count(DISTINCT time_bucket(INTERVAL '10 minutes', ts)) * 24.0::DOUBLE AS snapshots
  FROM hourly GROUP BY h
),
series AS (
  SELECT h AS ts, 'coverage' AS metric, event_type AS label, mean / 100 AS value FROM by_type
  UNION ALL SELECT h, 'density', event_type, mean FROM by_type
  UNION ALL SELECT h, 'freshness', '', top * 1000 FROM overall
  UNION ALL SELECT h, 'query_success', '', CASE WHEN errors > views THEN 0.0 ELSE 1.0 END::DOUBLE FROM overall
  UNION ALL SELECT h, 'snapshot', '', snapshots FROM overall
)"""

_OWN_RULES = """
samples AS (
  SELECT 'bronze_stale' AS alert, '' AS instance, ts, value, value > 100000 AS holds, 3600 AS hold_s,
         'critical' AS severity, 'overflight' AS team
  FROM series WHERE metric = 'freshness'
  UNION ALL
  SELECT 'metrics_query_failed', '', ts, value, value = 0, 3600, 'warning', 'overflight'
  FROM series WHERE metric = 'query_success'
  UNION ALL
  SELECT 'low_coverage', '', ts, min(value), min(value) < 0.3, 7200, 'warning', 'overflight'
  FROM series WHERE metric = 'coverage' GROUP BY ts
  UNION ALL
  SELECT 'high_density', label, ts, value, value >= 50, 3600, 'warning', 'overflight'
  FROM series WHERE metric = 'density'
  UNION ALL
  SELECT 'other_team', label, ts, value, value >= 60, 0, 'warning', 'someone-else'
  FROM series WHERE metric = 'density'
)"""

_DECLARED_RULES = """
samples AS (
  SELECT 'bronze_stale' AS alert, '' AS instance, ts, value, value > 172800 AS holds, 600 AS hold_s,
         'critical' AS severity, 'overflight' AS team
  FROM series WHERE metric = 'freshness'
  UNION ALL
  SELECT 'metrics_query_failed', '', ts, value, value = 0, 600, 'warning', 'overflight'
  FROM series WHERE metric = 'query_success'
  UNION ALL
  SELECT 'snapshot_incomplete', '', ts, min(value), min(value) < 115, 600, 'warning', 'overflight'
  FROM series WHERE metric = 'snapshot' GROUP BY ts
  UNION ALL
  SELECT 'low_coverage', '', ts, min(value), min(value) < 0.8, 600, 'warning', 'overflight'
  FROM series WHERE metric = 'coverage' GROUP BY ts
)"""

_TIMELINE = """,
numbered AS (
  SELECT *, row_number() OVER w AS n,
         coalesce(sum(CASE WHEN holds THEN 0 ELSE 1 END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS falses
  FROM samples WINDOW w AS (PARTITION BY alert, instance ORDER BY ts)
),
runs AS (
  SELECT alert, instance, falses, min(ts) FILTER (holds) AS run_start, max(ts) FILTER (holds) AS run_end
  FROM numbered GROUP BY ALL
),
timeline AS (
  SELECT n.alert, n.instance, n.ts, n.value, n.severity, n.team, n.hold_s,
         max(r.run_start) OVER (PARTITION BY n.alert, n.instance ORDER BY n.ts) AS active_since,
         CASE WHEN n.holds AND epoch(n.ts) - epoch(r.run_start) >= n.hold_s THEN 'firing'
              WHEN n.holds THEN 'pending'
              WHEN epoch(r.run_end) - epoch(r.run_start) >= n.hold_s THEN 'resolved'
              ELSE 'inactive' END AS state
  FROM numbered n JOIN runs r USING (alert, instance, falses)
)"""

ALERTS = SERIES + "," + _OWN_RULES + _TIMELINE
_CHANGES = """,
runs_told AS (
  SELECT alert, instance, severity, team, active_since, state, min(ts) AS ts, arg_min(value, ts) AS value
  FROM timeline WHERE state IN ('firing', 'resolved') GROUP BY ALL
)"""

# The timeline again, of a series with one more sample among those before the middle of the month.
_AND_LATE = SERIES + """,
late_series AS (
  SELECT * FROM series UNION ALL
  SELECT max(ts) - INTERVAL '30 minutes', 'freshness', '', 1e9::DOUBLE FROM series
  WHERE metric = 'freshness' AND ts < TIMESTAMP '2024-01-16 05:00:00'
)"""
TWO_RUNS = f"""SELECT *, 'first' AS run FROM (WITH {ALERTS}
  SELECT alert, instance, ts, value, state, active_since, severity FROM timeline) AS whole
UNION ALL SELECT *, 'second' FROM (WITH {_AND_LATE + "," + _OWN_RULES.replace("FROM series", "FROM late_series") + _TIMELINE}
  SELECT alert, instance, ts, value, state, active_since, severity FROM timeline) AS again"""

TIMELINE = f"""WITH {ALERTS}
SELECT alert, instance, ts, value, state, active_since, severity FROM timeline"""

NOTIFICATIONS = f"""WITH {ALERTS}{_CHANGES}
SELECT alert, instance, severity, state, ts, active_since, upper(severity) || ' | ' || alert AS title
FROM runs_told WHERE team = 'overflight'"""

DECLARED_RULES = f"""WITH {SERIES},{_DECLARED_RULES}{_TIMELINE}{_CHANGES},
summaries(alert, summary) AS (VALUES ('bronze_stale', 'no bronze load for 48 h'),
  ('metrics_query_failed', 'metrics are not being refreshed'), ('snapshot_incomplete', 'a day has fewer than 115 snapshots'),
  ('low_coverage', 'a region''s coverage is below 0.8')),
shown AS (SELECT *, CAST(floor(value) AS BIGINT) AS s FROM runs_told)
SELECT alert, instance, state, ts, upper(severity) || ' | ' || alert AS title, summary || ' (value ' || CASE
    WHEN alert <> 'bronze_stale' THEN CAST(round(value, 3) AS VARCHAR)
    WHEN s >= 86400 THEN printf('%dd %dh %dm %ds', s // 86400, s % 86400 // 3600, s % 3600 // 60, s % 60)
    WHEN s >= 3600 THEN printf('%dh %dm %ds', s // 3600, s % 3600 // 60, s % 60)
    ELSE printf('%dm %ds', s // 60, s % 60) END || ')' AS text
FROM shown JOIN summaries USING (alert)"""

LOADED = f"""WITH {BRONZE} SELECT dt, count(DISTINCT snapshot_time) AS snapshots, CAST(sum(vectors) AS BIGINT) AS vectors
FROM bronze GROUP BY dt"""

REGION_DENSITY = f"""WITH {MARTS}
SELECT snapshot_time, region, aircraft_count, area_sqdeg, density, coverage_pct FROM region_mart"""

MEDIANS = f"""WITH {STATES}
SELECT position_source, count(*) AS rows, median(velocity) AS median_velocity, median(baro_altitude) AS median_altitude
FROM states GROUP BY position_source"""

EXTENTS = STATES + """,
extents AS (
  SELECT region, min(longitude) AS lomin, max(longitude) AS lomax, min(latitude) AS lamin, max(latitude) AS lamax
  FROM states GROUP BY region
)"""

# Rows and aircraft of two days of the region mart from every second event.
_HALF_MARTS = """
  SELECT dt, count(*) AS rows, CAST(sum(n) AS BIGINT) AS aircraft FROM (
    SELECT CAST(snapshot_time AS DATE) AS dt, snapshot_time, CASE WHEN longitude BETWEEN 18 AND 44 AND latitude BETWEEN 42 AND 55 THEN 'ukraine'
             WHEN longitude BETWEEN 36 AND 66 AND latitude BETWEEN 24 AND 42 THEN 'middle_east' ELSE 'west_europe' END AS region, count(*) AS n
    FROM vectors WHERE event_id % 2 = 0 AND NOT on_ground AND position_source = 0
      AND CAST(snapshot_time AS DATE) IN (DATE '2024-01-03', DATE '2024-01-04')
      AND (longitude BETWEEN 18 AND 44 AND latitude BETWEEN 42 AND 55 OR longitude BETWEEN 36 AND 66 AND latitude BETWEEN 24 AND 42
        OR longitude BETWEEN 2 AND 12 AND latitude BETWEEN 45 AND 52)
    GROUP BY ALL) GROUP BY dt"""

INCOMPLETE = f"""WITH {BRONZE},
few AS (
  SELECT dt, count(*) AS snapshot_cnt FROM bronze
  WHERE dt < DATE '2024-01-31' AND dt >= DATE '2024-01-01' GROUP BY dt HAVING count(*) < 130
)"""

QUALITY = f"""WITH {MARTS}, {BRONZE},
newest AS (SELECT max(dt) AS dt FROM region_mart),
metrics AS (
  SELECT 'snapshot' AS kind, CAST(dt AS VARCHAR) AS label, CAST(count(*) AS DOUBLE) AS value
  FROM bronze WHERE dt >= DATE '2024-01-28' GROUP BY dt
  UNION ALL
  SELECT 'freshness', '', CAST(epoch(TIMESTAMP '2024-01-31 12:00:00') - epoch(max(loaded_at)) AS DOUBLE)
  FROM bronze WHERE dt >= DATE '2024-01-30'
  UNION ALL
  SELECT 'coverage', region, round(avg(coverage_pct), 6) FROM region_mart WHERE dt = (SELECT dt FROM newest) GROUP BY region
  UNION ALL
  SELECT 'density', region, round(avg(density), 6) FROM region_mart WHERE dt = (SELECT dt FROM newest) GROUP BY region
)"""


def _dq(relation: str, checks: list[tuple[str, str, str, str]], table: str) -> list[str]:
    return [
        f"SELECT '{relation}' AS relation, '{kind}' AS check_name, '{column}' AS column_name, '{severity}' AS severity, "
        f"(SELECT count(*) FROM {table} WHERE {fails}) AS failing_rows"
        for kind, column, severity, fails in checks
    ]


_DQ = [
    *_dq(
        "states",
        [
            ("not_null", "snapshot_time", "error", "snapshot_time IS NULL"),
            ("not_null", "region", "error", "region IS NULL"),
            ("accepted_values", "region", "error", "region NOT IN ('ukraine', 'middle_east', 'west_europe', 'other')"),
            ("not_null", "icao24", "error", "icao24 IS NULL"),
            ("accepted_range", "longitude", "error", "position_source = 0 AND NOT (longitude BETWEEN -180 AND 180)"),
            ("accepted_range", "latitude", "error", "position_source = 0 AND NOT (latitude BETWEEN -90 AND 90)"),
            ("accepted_range", "velocity", "error", "position_source = 0 AND velocity < 0"),
            ("accepted_range", "true_track", "error", "position_source = 0 AND NOT (true_track BETWEEN 0 AND 360)"),
            ("accepted_values", "position_source", "error", "position_source NOT IN (0, 1, 2, 3)"),
            ("accepted_range", "true_track", "warn", "NOT (true_track BETWEEN 0 AND 360)"),
            ("not_null", "callsign", "warn", "callsign IS NULL"),
            ("not_null", "squawk", "error", "NOT on_ground AND squawk IS NULL"),
            ("accepted_values", "region", "error", "region NOT IN ('ukraine', 'other')"),
            ("accepted_range", "velocity", "error", "region <> 'other' AND velocity > 150"),
        ],
        "states",
    ),
    *_dq(
        "lineitem",
        [
            ("accepted_range", "l_discount", "error", "l_discount < 0 OR l_discount > 0.05::DOUBLE"),
            ("accepted_values", "l_returnflag", "error", "l_returnflag NOT IN ('A', 'N')"),
            ("not_null", "l_shipdate", "error", "l_shipdate IS NULL"),
            ("accepted_range", "l_quantity", "error", "l_linestatus = 'O' AND l_quantity < 5"),
        ],
        "lineitem",
    ),
    *_dq("orders", [("accepted_values", "o_orderstatus", "error", "o_orderstatus NOT IN ('F', 'O', 'P')")], "orders"),
    *[
        f"SELECT 'orders', 'unique', '{key}', 'error', (SELECT count(*) FROM "
        f"(SELECT {key} FROM orders WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1))"
        for key in ("o_orderkey", "o_custkey")
    ],
]
_REGIONS = "('ukraine', 'middle_east', 'west_europe', 'other')"


def _known(*columns: str) -> list[tuple[str, str, str, str]]:
    return [("not_null", column, "error", f"{column} IS NULL") for column in columns]


def _ranges(**bounds: str) -> list[tuple[str, str, str, str]]:
    return [("accepted_range", column, "error", f"NOT ({column} {bound})") for column, bound in bounds.items()]


_CELLS = [
    *_known("dt", "region", "cell_lon", "cell_lat", "aircraft_count"),
    ("accepted_values", "region", "error", f"region NOT IN {_REGIONS}"),
    *_ranges(cell_lon="BETWEEN -10 AND 70", cell_lat="BETWEEN 18 AND 60", aircraft_count=">= 1"),
]
# Every declared check, relation by relation.
_BUILD = [
    *_dq("region_area", _known("region", "area_sqdeg"), "areas"),
    "SELECT 'region_area', 'unique', 'region', 'error', (SELECT count(*) FROM (SELECT region FROM areas GROUP BY region HAVING count(*) > 1))",
    *_DQ[:9],
    *_dq("region_density", [
        *_known("snapshot_time", "region", "aircraft_count", "area_sqdeg", "density"),
        ("accepted_values", "region", "error", "region NOT IN ('ukraine', 'middle_east', 'west_europe')"),
        *_ranges(aircraft_count=">= 0", area_sqdeg=">= 1", density=">= 0"),
    ], "region_mart"),
    *_dq("aircraft_points", [
        *_known("snapshot_bucket", "region", "longitude", "latitude"),
        ("accepted_values", "region", "error", f"region NOT IN {_REGIONS}"),
        *_ranges(longitude="BETWEEN -180 AND 180", latitude="BETWEEN -90 AND 90"),
    ], "points"),
    *_dq("grid_density", [*_CELLS, *_known("coverage_pct"), *_ranges(coverage_pct=">= 0")], "grid_mart"),
    *_dq("grid_counts", _CELLS, "grid"),
]
_STATUS = "CASE WHEN failing_rows = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'error' END AS status"

_STEPS = """CASE WHEN kind = 'freshness' THEN CASE WHEN value >= 172800 THEN 'red' WHEN value >= 129600 THEN 'yellow' ELSE 'green' END
            WHEN kind = 'coverage' THEN CASE WHEN value >= 1 THEN 'green' WHEN value >= 0.8 THEN 'yellow' ELSE 'red' END
            WHEN kind = 'snapshot' THEN CASE WHEN value >= 144 THEN 'green' WHEN value >= 115 THEN 'yellow' ELSE 'red' END
            WHEN kind = 'query_success' THEN 'OK' END"""

ORACLES: dict[str, str] = {
    "stage_states": f"WITH {STATES} SELECT * EXCLUDE (dt) FROM states",
    "snapshot_sizes": f"WITH {BRONZE} SELECT snapshot_time, 'global' AS region, vectors AS aircraft FROM bronze",
    "cast_quarantine": f"""WITH {VECTORS} SELECT snapshot_time, 'last_contact' AS failed_fields, count(*) AS vectors
        FROM vectors WHERE position_source = 3 GROUP BY snapshot_time""",
    "daily_coverage": f"WITH {MARTS} SELECT dt, snapshots_observed, coverage_pct FROM coverage",
    "coverage_merged": f"WITH {MARTS} SELECT dt, snapshots_observed, coverage_pct FROM coverage",
    "grid_cell_trend": f"""WITH {GRID_MART},
        sizes AS (SELECT cell_lon, cell_lat, sum(aircraft_count) AS n FROM grid_mart GROUP BY ALL),
        fullest AS (SELECT cell_lon, cell_lat FROM sizes ORDER BY n DESC, cell_lon DESC, cell_lat DESC LIMIT 1)
        SELECT grid_mart.* FROM grid_mart JOIN fullest USING (cell_lon, cell_lat)""",
    "region_density": REGION_DENSITY,
    "region_density_zero_filled": f"""WITH {MARTS},
        snapshots AS (SELECT DISTINCT dt, snapshot_time FROM states)
        SELECT p.snapshot_time, a.region, coalesce(m.aircraft_count, 0) AS aircraft_count, a.area_sqdeg,
               coalesce(m.density, 0.0) AS density, c.coverage_pct
        FROM snapshots p CROSS JOIN areas a JOIN coverage c ON c.dt = p.dt
        LEFT JOIN region_mart m ON m.snapshot_time = p.snapshot_time AND m.region = a.region""",
    "grid_density": f"WITH {STATES}, {_grid(0.5)} SELECT * FROM grid",
    "grid_density_quarter": f"WITH {STATES}, {_grid(0.25)} SELECT * FROM grid",
    "grid_mart": f"WITH {GRID_MART} SELECT * FROM grid_mart",
    "grid_latest": f"WITH {GRID_MART} SELECT * FROM grid_mart WHERE dt = (SELECT max(dt) FROM grid_mart)",
    "grid_trend": f"WITH {GRID_MART} SELECT * FROM grid_mart WHERE region = 'ukraine'",
    "aircraft_points": f"WITH {MARTS} SELECT * FROM points",
    "aircraft_points_first_frame": f"""WITH {STATES},
        first AS (SELECT min(snapshot_time) AS snapshot_time FROM states
                  GROUP BY time_bucket(INTERVAL '30 minutes', snapshot_time))
        SELECT time_bucket(INTERVAL '30 minutes', snapshot_time) AS snapshot_bucket, snapshot_time, region, longitude,
               latitude, callsign, origin_country, baro_altitude, velocity
        FROM states JOIN first USING (snapshot_time) WHERE on_ground = false AND position_source = 0""",
    "points_export": f"""WITH {MARTS}
        SELECT strftime(snapshot_bucket, '%Y-%m-%dT%H:%M:%S') AS ts, region, longitude, latitude, callsign,
               origin_country, baro_altitude, velocity
        FROM points WHERE CAST(snapshot_bucket AS DATE) >= DATE '2024-01-28'""",
    "playback_window": f"""WITH {MARTS} SELECT * FROM points
        WHERE snapshot_bucket <= (SELECT min(snapshot_bucket) + INTERVAL '1 hour' FROM points)""",
    "density_contrast": f"""WITH {MARTS},
        means AS (SELECT region, round(avg(density), 6) AS mean_density FROM region_mart GROUP BY region)
        SELECT region, mean_density,
               round((SELECT mean_density FROM means WHERE region = 'west_europe') / nullif(mean_density, 0), 1) AS times_lower
        FROM means""",
    "region_density_boxes": f"""WITH {MARTS},
        boxed AS (SELECT * REPLACE (CASE WHEN longitude BETWEEN 2.5 AND 14.25 AND latitude BETWEEN 45.5 AND 52.75 THEN 'north'
            WHEN longitude BETWEEN 10 AND 40.5 AND latitude BETWEEN 30.25 AND 46.5 THEN 'south' ELSE 'other' END AS region) FROM states),
        own(region, area_sqdeg) AS (VALUES ('north', 11.75::DOUBLE * 7.25::DOUBLE), ('south', 30.5::DOUBLE * 16.25::DOUBLE))
        SELECT snapshot_time, region, count(*) AS aircraft_count, area_sqdeg,
               round(CAST(count(*) AS DOUBLE) / area_sqdeg, 4) AS density, coverage_pct
        FROM boxed JOIN own USING (region) JOIN coverage USING (dt)
        WHERE on_ground = false AND position_source = 0 GROUP BY snapshot_time, region, area_sqdeg, coverage_pct""",
    "source_profile": MEDIANS,
    "source_first_seen": f"""WITH {STATES} SELECT position_source, min(dt) AS first_day, max(dt) AS last_day,
        count(DISTINCT dt) AS days_seen FROM states GROUP BY position_source""",
    "assign_box": """SELECT region, count(*) AS items, round(sum(l_extendedprice), 2) AS price FROM (
          SELECT l_extendedprice,
                 CASE WHEN l_quantity BETWEEN 1 AND 10 AND l_discount BETWEEN 0 AND 0.03::DOUBLE THEN 'small'
                      WHEN l_quantity BETWEEN 8 AND 30 AND l_discount BETWEEN 0.02::DOUBLE AND 0.07::DOUBLE THEN 'middle'
                      WHEN l_quantity BETWEEN 1 AND 50 AND l_discount BETWEEN 0.06::DOUBLE AND 0.1::DOUBLE THEN 'deep'
                      ELSE 'other' END AS region
          FROM lineitem) GROUP BY region""",
    "assign_box_states": f"WITH {STATES} SELECT snapshot_time, icao24, longitude, latitude, region FROM states",
    "assign_box_sizes": f"""WITH {STATES},
        sides AS (SELECT DISTINCT user_id, -20.0::DOUBLE + (user_id * 7919 % 10000) / 100.0::DOUBLE AS lomin,
            10.0::DOUBLE + (user_id * 104729 % 5500) / 100.0::DOUBLE AS lamin, 0.05::DOUBLE * pow(2.0, user_id % 13) AS side FROM events),
        numbered AS (SELECT row_number() OVER () AS n, longitude, latitude FROM states),
        inside AS (SELECT n, min(user_id) AS user_id FROM numbered JOIN sides ON longitude BETWEEN lomin AND lomin + side
            AND latitude BETWEEN lamin AND lamin + side GROUP BY n)
        SELECT coalesce('box ' || user_id, 'world') AS region, count(*) AS positions, true AS bounded
        FROM numbered LEFT JOIN inside USING (n) GROUP BY 1""",
    "credit_budget": f"""WITH {EXTENTS},
        costs AS (SELECT *, (lamax - lamin) * (lomax - lomin) AS area FROM extents),
        priced AS (SELECT *, CAST(CASE WHEN area <= 25 THEN 1 WHEN area <= 100 THEN 2 WHEN area <= 400 THEN 3 ELSE 4 END
                                  AS BIGINT) AS credits_per_call FROM costs)
        SELECT region, lomin, lomax, lamin, lamax, round(area, 4) AS area_sqdeg, credits_per_call,
               CAST(144 AS BIGINT) AS calls_per_day, credits_per_call * 144 AS credits_per_day,
               round(credits_per_call * 144 * 100.0::DOUBLE / 4000.0::DOUBLE, 1) AS budget_pct
        FROM priced""",
    "region_geojson": f"""WITH {EXTENTS}
        SELECT '{{"type":"FeatureCollection","features":[' || string_agg(
          '{{"type":"Feature","properties":{{"region":"' || region || '"}},"geometry":{{"type":"Polygon","coordinates":[[' ||
          '[' || lomin || ',' || lamin || '],[' || lomax || ',' || lamin || '],[' || lomax || ',' || lamax || '],[' ||
          lomin || ',' || lamax || '],[' || lomin || ',' || lamin || ']]]}}}}', ',' ORDER BY region) || ']}}' AS geojson
        FROM extents""",
    "incomplete_days": f"{INCOMPLETE} SELECT * FROM few",
    "completeness_message": f"""{INCOMPLETE}
        SELECT string_agg(dt || '=' || snapshot_cnt || '/130', ', ' ORDER BY dt) AS message FROM few HAVING count(*) > 0""",
    "missing_days": f"""WITH {BRONZE},
        spine AS (SELECT CAST(unnest(generate_series(DATE '2024-01-27', DATE '2024-02-02', INTERVAL 1 DAY)) AS DATE) AS dt)
        SELECT dt FROM spine WHERE dt NOT IN (SELECT dt FROM bronze)""",
    "daily_health": f"""WITH {BRONZE},
        days AS (SELECT dt, count(DISTINCT snapshot_time) AS snaps FROM bronze WHERE dt >= DATE '2024-01-23' GROUP BY dt)
        SELECT dt, snaps, CASE WHEN dt = DATE '2024-01-30' THEN 'excluded' WHEN snaps < 135 THEN 'missing data'
                               ELSE 'ok' END AS status FROM days""",
    "mart_freshness": f"""WITH {MARTS},
        newest AS (SELECT max(snapshot_time) AS newest, CAST(max(snapshot_time) AS DATE) AS newest_day FROM region_mart),
        moments(as_of, oldest, latest) AS (
          VALUES (TIMESTAMP '2024-01-31 12:00:00', DATE '2024-01-30', DATE '2024-01-30'),
                 (TIMESTAMP '2024-02-01 00:30:00', DATE '2024-01-30', DATE '2024-01-31'),
                 (TIMESTAMP '2024-02-01 01:30:00', DATE '2024-01-31', DATE '2024-01-31'),
                 (TIMESTAMP '2024-02-01 00:45:00', DATE '2024-01-30', DATE '2024-01-31'))
        SELECT newest, newest_day, CASE WHEN newest_day BETWEEN oldest AND latest THEN 'ok' ELSE 'stale' END AS status, as_of
        FROM newest CROSS JOIN moments""",
    "freshness_status": f"""WITH {BRONZE},
        newest AS (SELECT max(loaded_at) AS newest_load FROM bronze),
        limits(moment, status, panel) AS (
          VALUES (TIMESTAMP '2024-02-01 12:00:00', 'pass', 'yellow'), (TIMESTAMP '2024-02-01 12:00:01', 'warn', 'yellow'),
                 (TIMESTAMP '2024-02-02 00:00:01', 'error', 'red'))
        SELECT newest_load, CAST(epoch(moment) - epoch(newest_load) AS BIGINT) AS age_seconds, status, panel
        FROM newest CROSS JOIN limits""",
    "health_verdict": f"""WITH {MARTS}, {BRONZE},
        days AS (SELECT dt, count(DISTINCT snapshot_time) AS snaps FROM bronze WHERE dt >= DATE '2024-01-24' GROUP BY dt),
        failed(n) AS (
          SELECT count(*) FROM days WHERE snaps < 120 AND dt <> DATE '2024-01-31'
          UNION ALL SELECT CASE WHEN EXISTS (SELECT 1 FROM bronze WHERE dt = DATE '2024-01-30') THEN 0 ELSE 1 END
          UNION ALL SELECT CASE WHEN max(dt) = DATE '2024-01-30' THEN 0 ELSE 1 END FROM region_mart)
        SELECT CAST(max(CASE WHEN n > 0 THEN 1 ELSE 0 END) AS BIGINT) AS verdict, count(*) AS checks_run,
               count(*) FILTER (n > 0) AS checks_failed FROM failed""",
    "quality_metrics": f"{QUALITY} SELECT kind, label, round(value, 6) AS value FROM metrics",
    "metric_panels": f"""{QUALITY},
        all_metrics AS (SELECT * FROM metrics UNION ALL SELECT 'query_success', '', 1.0::DOUBLE)
        SELECT TIMESTAMP '2024-01-31 12:00:00' AS ts, kind AS metric, label, round(value, 6) AS value, {_STEPS} AS status
        FROM all_metrics WHERE value IS NOT NULL""",
    "metric_refresh": f"""{QUALITY}
        SELECT TIMESTAMP '2024-01-31 12:05:00' AS ts, kind AS metric, label,
               CASE WHEN kind = 'freshness' THEN value + 300 ELSE round(value, 6) END AS value, 5::BIGINT AS ticks FROM metrics WHERE value IS NOT NULL
        UNION ALL SELECT TIMESTAMP '2024-01-31 12:05:00', 'last_success', '', epoch(TIMESTAMP '2024-01-31 12:05:00'), 5
        UNION ALL SELECT TIMESTAMP '2024-01-31 12:10:00', 'query_success', '', 0.0::DOUBLE, 5""",
    "metric_minimum": f"WITH {SERIES} SELECT ts, metric, min(value) AS value FROM series GROUP BY ts, metric",
    "last_not_null": """SELECT event_type AS metric, CAST(user_id AS VARCHAR) AS label, max(ts) AS ts,
        arg_max(value, ts) AS value FROM events WHERE event_id % 3 <> 0 GROUP BY event_type, user_id""",
    "recent_series": f"""WITH {SERIES} SELECT label, ts, round(avg(value), 6) AS value FROM series
        WHERE metric = 'density' AND ts BETWEEN TIMESTAMP '2024-01-30 12:00:00' AND TIMESTAMP '2024-01-31 12:00:00'
        GROUP BY label, ts""",
    "dq_results": f"WITH {STATES}, results AS ({' UNION ALL '.join(_DQ)}) SELECT *, {_STATUS} FROM results",
    "dq_singular": f"""{INCOMPLETE}, results AS (SELECT 'bronze' AS relation, 'daily_completeness' AS check_name,
        '' AS column_name, 'warn' AS severity, count(*) AS failing_rows FROM few) SELECT *, {_STATUS} FROM results""",
    "alert_timeline": TIMELINE,
    "alert_notifications": NOTIFICATIONS,
    "declared_rules": DECLARED_RULES,
    "heartbeat_gaps": """WITH seen AS (
          SELECT user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next_seen FROM events),
        gaps AS (SELECT user_id, ts AS last_seen, next_seen,
                        epoch_us(coalesce(next_seen, TIMESTAMP '2024-01-31 12:00:00')) - epoch_us(ts) AS silence FROM seen)
        SELECT user_id, last_seen, last_seen + INTERVAL '6 hours' AS down_at, next_seen,
               CAST(silence // 1000000 AS BIGINT) AS silent_seconds
        FROM gaps WHERE silence > 21600000000""",
    "classify_failures": """WITH f AS (
          SELECT event_id, CASE event_type WHEN 'error' THEN 'bronze_snapshots.source' WHEN 'click' THEN 'bronze_snapshots.test'
                 WHEN 'signup' THEN 'marts.region_density.source' ELSE 'load_days' END AS task_id,
                 repeat(props, 1 + event_id % 100) AS text FROM events)
        SELECT event_id, task_id, CASE WHEN length(text) > 800 THEN substr(text, 1, 800) || ' …(생략)' ELSE text END AS error,
               CASE task_id WHEN 'bronze_snapshots.source' THEN 'freshness' WHEN 'bronze_snapshots.test' THEN 'volume'
                            ELSE 'failure' END AS failure_kind,
               task_id LIKE 'bronze_snapshots.%' AS blocks_downstream FROM f""",
    "partition_replace": """WITH o AS (SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS dt FROM orders),
        urgent AS (SELECT * FROM o WHERE o_orderpriority = '1-URGENT' AND year(dt) >= 1996)
        SELECT dt, count(*) AS orders, round(sum(o_totalprice), 2) AS price FROM (
          SELECT dt, o_totalprice * 2 AS o_totalprice FROM urgent
          UNION ALL SELECT dt, o_totalprice FROM o WHERE dt NOT IN (SELECT dt FROM urgent)) GROUP BY dt""",
    "backfill": f"SELECT loaded.*, region FROM ({LOADED}) AS loaded CROSS JOIN (VALUES ('global'), ('korea')) AS r(region)",
    "load_quarantine": f"""WITH {BRONZE},
        numbered AS (SELECT CAST(epoch(snapshot_time) AS BIGINT) // 600 AS n FROM bronze)
        SELECT 'loaded' AS outcome, count(*) AS snapshots FROM numbered WHERE n % 5 <> 0 AND n % 7 <> 0
        UNION ALL SELECT 'quarantined', count(*) FROM numbered WHERE n % 5 = 0 OR n % 7 = 0""",
    "ingest_status": """WITH days AS (SELECT CAST(ts AS DATE) AS dt, count(*) AS n FROM events GROUP BY 1),
        spine AS (SELECT CAST(unnest(generate_series(min(dt), max(dt) + 1, INTERVAL 1 DAY)) AS DATE) AS dt FROM days)
        SELECT CAST(dt AS VARCHAR) AS dt, n > 0 IS TRUE AS has_files, n > 0 IS TRUE AS has_bytes, n > 0 IS TRUE AS has_newest,
               CASE WHEN n > 0 THEN 'ok' ELSE 'no files' END AS status FROM spine LEFT JOIN days USING (dt)""",
    "daily_build": f"""WITH {GRID_MART},
        sizes AS (SELECT 'region_density' AS relation, count(*) AS rows, count(DISTINCT dt) AS days FROM region_mart
          UNION ALL SELECT 'grid_density', count(*), count(DISTINCT dt) FROM grid_mart
          UNION ALL SELECT 'aircraft_points', count(*), count(DISTINCT CAST(snapshot_time AS DATE)) FROM points),
        checks AS ({' UNION ALL '.join(_BUILD)})
        SELECT sizes.*, CAST(sum(failing_rows) AS BIGINT) AS failing_rows FROM sizes JOIN checks USING (relation) GROUP BY ALL""",
    "build_checks": f"WITH {GRID_MART}, results AS ({' UNION ALL '.join(_BUILD)}) SELECT *, {_STATUS} FROM results",
    "stream_region_density": f"""WITH {MARTS}
        SELECT snapshot_time, region, aircraft_count, area_sqdeg, density FROM region_mart""",
    "stream_density_folded": f"""WITH {MARTS}
        SELECT snapshot_time, region, aircraft_count, area_sqdeg, density FROM region_mart""",
    "stream_frames": f"""WITH {MARTS}
        SELECT snapshot_bucket AS frame, region, count(*) AS aircraft_count FROM points GROUP BY ALL""",
    "stream_coverage": f"""WITH {MARTS} SELECT dt, snapshots_observed, coverage_pct FROM coverage
        WHERE CAST(dt + 1 AS TIMESTAMP) <= (SELECT max(snapshot_time) - INTERVAL '1 hour' FROM states)""",
    "stream_ingest": LOADED,
    "stream_late_reload": REGION_DENSITY.replace("('ukraine', 338.0::DOUBLE)", "('ukraine', 1000.0::DOUBLE)"),
    "reload_changed": f"""WITH {MARTS},
        kept AS (SELECT dt, count(*) FILTER (day(dt) % 3 <> 0 OR day(dt) % 2 = 0 OR event_id % 4 <> 0) AS aircraft
                 FROM vectors_in_regions GROUP BY dt),
        days AS (SELECT CAST(ts AS DATE) AS dt, bool_or(event_id % 4 = 0) AS quarter FROM events GROUP BY 1)
        SELECT dt, day(dt) % 2 = 0 AS reloaded, day(dt) % 6 = 0 AND quarter AS rebuilt, nullif(aircraft, 0) AS aircraft
        FROM days LEFT JOIN kept USING (dt)""".replace("vectors_in_regions", """(
            SELECT event_id, CAST(snapshot_time AS DATE) AS dt FROM vectors
            WHERE NOT on_ground AND position_source = 0 AND (longitude BETWEEN 18 AND 44 AND latitude BETWEEN 42 AND 55
              OR longitude BETWEEN 36 AND 66 AND latitude BETWEEN 24 AND 42 OR longitude BETWEEN 2 AND 12 AND latitude BETWEEN 45 AND 52))"""),
    "publish_after_audit": f"""WITH {MARTS},
        before AS (SELECT dt, count(*) AS rows, CAST(sum(aircraft_count) AS BIGINT) AS aircraft FROM region_mart GROUP BY dt),
        halves AS ({_HALF_MARTS})
        SELECT *, 'rejected' AS load, 0::BIGINT AS rebuilt FROM before
        UNION ALL SELECT *, 'sound', 2 FROM before WHERE dt NOT IN (DATE '2024-01-03', DATE '2024-01-04')
        UNION ALL SELECT *, 'sound', 2 FROM halves""",
    "stream_alerts": TWO_RUNS,
    "stream_heartbeat": """WITH signs AS (
          SELECT CAST(user_id AS VARCHAR) AS source, ts FROM events UNION ALL SELECT 'all', ts FROM events),
        seen AS (SELECT source, ts, lead(ts) OVER (PARTITION BY source ORDER BY ts) AS next_seen FROM signs)
        SELECT source, ts AS last_seen, ts + INTERVAL '6 hours' AS down_at, next_seen,
               CAST((epoch_us(next_seen) - epoch_us(ts)) // 1000000 AS BIGINT) AS silent_seconds
        FROM seen WHERE epoch_us(next_seen) - epoch_us(ts) > 21600000000""",
}

# Days are compared as ISO text.
_DAYS = {
    "daily_coverage": ("dt",),
    "grid_density": ("dt",),
    "grid_density_quarter": ("dt",),
    "grid_mart": ("dt",),
    "grid_latest": ("dt",),
    "grid_trend": ("dt",),
    "source_first_seen": ("first_day", "last_day"),
    "incomplete_days": ("dt",),
    "missing_days": ("dt",),
    "daily_health": ("dt",),
    "mart_freshness": ("newest_day",),
    "partition_replace": ("dt",),
    "backfill": ("dt",),
    "stream_coverage": ("dt",),
    "stream_ingest": ("dt",),
    "reload_changed": ("dt",),
    "coverage_merged": ("dt",),
    "grid_cell_trend": ("dt",),
    "publish_after_audit": ("dt",),
}
for _name, _columns in _DAYS.items():
    _text = ", ".join(f"CAST({column} AS VARCHAR) AS {column}" for column in _columns)
    ORACLES[_name] = f"SELECT * REPLACE ({_text}) FROM ({ORACLES[_name]}) AS result"
