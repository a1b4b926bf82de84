"""The same queries as SQL for DuckDB, written independently of the Spark plans.

Where Spark aggregates and joins, the SQL uses windows, so that the two do not
share a derivation. NULL order and tie-breaks are spelled out on both sides.
"""

from pitwall.registry import AS_OF, DRIVER_NUMBER, FULL_NAME, RUN_TS, YEAR
from pitwall.schemas import ENTITIES, NOT_NULL_RAW, NOT_NULL_STAGING, REQUIRED_FIELDS, raw_names

_STAMP = f"TIMESTAMP '{RUN_TS}'"

# The given tables seen as raw tables.
_RAW = """
raw_sessions AS (
  SELECT o_orderkey // 30 AS session_key,
         o_orderpriority AS session_name,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Race' WHEN '2-HIGH' THEN 'Qualifying'
              ELSE 'Practice' END AS session_type,
         o_orderdate AS date_start,
         CASE o_orderkey // 30 % 25 WHEN 7 THEN NULL
              WHEN 11 THEN o_orderdate - INTERVAL 1 HOUR
              ELSE o_orderdate + INTERVAL 2 HOUR END AS date_end,
         '+00:00' AS gmt_offset,
         'LOC_' || (o_custkey % 40) AS location,
         'NATION_' || (o_custkey % 25) AS country_name,
         'CIRCUIT_' || (o_custkey % 24) AS circuit_short_name,
         year(o_orderdate)::INTEGER AS year,
         o_orderdate + to_microseconds(o_orderkey) AS ingested_at
  FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_orderkey // 30 ORDER BY o_orderkey) = 1
),
raw_sessions_dup AS (
  SELECT * FROM raw_sessions
  UNION ALL
  SELECT * REPLACE (ingested_at + INTERVAL 1 DAY AS ingested_at) FROM raw_sessions WHERE session_type = 'Race'
),
raw_drivers AS (
  SELECT CASE WHEN o_orderkey % 97 = 5 THEN NULL ELSE o_custkey % 20 + 1 END::INTEGER AS driver_number,
         o_orderkey // 30 AS session_key,
         'D. DRV_' || (o_custkey % 20 + 1) AS broadcast_name,
         'DRV_' || (o_custkey % 20 + 1) AS full_name,
         'D' || (o_custkey % 20 + 1) AS name_acronym,
         'TEAM_' || (o_orderkey % 10) AS team_name,
         'FF00' || (10 + o_orderkey % 10) AS team_colour,
         'http://img.example/' || (o_custkey % 20 + 1) AS headshot_url,
         'C' || (o_custkey % 20) AS country_code,
         o_orderdate + to_microseconds(o_orderkey) AS ingested_at
  FROM orders
),
raw_laps AS (
  SELECT l_orderkey // 30 AS session_key,
         (l_suppkey % 20 + 1)::INTEGER AS driver_number,
         l_linenumber AS lap_number,
         CASE WHEN l_quantity = 13 THEN NULL ELSE floor(l_extendedprice / 300.0) - 5 END::DOUBLE AS lap_duration,
         l_quantity AS segment_1_duration,
         CASE WHEN l_linenumber = 5 THEN NULL ELSE round(l_discount * 100) END::DOUBLE AS segment_2_duration,
         round(l_tax * 100)::DOUBLE AS segment_3_duration,
         CASE WHEN l_returnflag = 'R' THEN TRUE
              WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN NULL ELSE FALSE END AS is_pit_out_lap,
         l_shipdate AS date_start,
         l_shipdate + INTERVAL 1 DAY AS ingested_at
  FROM lineitem
),
raw_positions AS (
  SELECT event_id // 20 AS session_key,
         (user_id % 12 + 1)::INTEGER AS driver_number,
         CASE WHEN event_type = 'error' AND event_id % 7 = 0 THEN NULL ELSE ts END AS date,
         CASE WHEN event_type = 'signup' AND event_id % 5 = 0 THEN NULL
              ELSE floor(value)::INTEGER % 23 END::INTEGER AS position,
         ts + INTERVAL 1 HOUR AS ingested_at
  FROM events
)"""

# Records of a run carry the time of the run instead of the stored one.
_RESTAMPED = ",\n".join(
    f"run_{entity} AS (SELECT * REPLACE ({_STAMP} AS ingested_at) FROM raw_{entity})" for entity in ENTITIES
)


def _layer_sql(sessions: str, drivers: str, laps: str, positions: str) -> str:
    """CTEs of staging and marts over four raw relations."""
    return f"""
stg_sessions AS (
  SELECT *, TRUE AS is_valid_session FROM {sessions} WHERE date_start <= date_end
),
stg_drivers AS (
  SELECT * FROM {drivers} WHERE driver_number IS NOT NULL
  QUALIFY row_number() OVER (
    PARTITION BY session_key, driver_number
    ORDER BY ingested_at DESC NULLS FIRST, full_name DESC NULLS LAST, name_acronym DESC NULLS LAST,
             team_name DESC NULLS LAST, team_colour DESC NULLS LAST, country_code DESC NULLS LAST,
             headshot_url DESC NULLS LAST, broadcast_name DESC NULLS LAST) = 1
),
stg_laps AS (
  SELECT *, ifnull(segment_1_duration, 0) + ifnull(segment_2_duration, 0) + ifnull(segment_3_duration, 0)
              AS total_segment_time,
         TRUE AS is_valid_lap
  FROM {laps} WHERE lap_duration > 0 AND lap_duration <= 300
),
stg_positions AS (
  SELECT session_key, driver_number, date AS position_timestamp, position, ingested_at, TRUE AS is_valid_position
  FROM {positions} WHERE position BETWEEN 1 AND 20
),
dim_drivers AS (
  SELECT driver_number, full_name, name_acronym, team_name, team_colour, country_code, headshot_url
  FROM stg_drivers
  QUALIFY row_number() OVER (
    PARTITION BY driver_number
    ORDER BY ingested_at DESC NULLS FIRST, full_name DESC NULLS LAST, name_acronym DESC NULLS LAST,
             team_name DESC NULLS LAST, team_colour DESC NULLS LAST, country_code DESC NULLS LAST,
             headshot_url DESC NULLS LAST) = 1
),
fct_lap_times AS (
  SELECT lap.session_key, lap.driver_number, drv.full_name AS driver_name, drv.team_name, lap.lap_number,
         lap.lap_duration, lap.segment_1_duration, lap.segment_2_duration, lap.segment_3_duration,
         ses.session_type, ses.circuit_short_name, ses.year,
         row_number() OVER (
           PARTITION BY lap.session_key, lap.lap_number
           ORDER BY lap.lap_duration NULLS LAST, lap.driver_number NULLS LAST, lap.segment_1_duration NULLS LAST,
                    lap.segment_2_duration NULLS LAST, lap.segment_3_duration NULLS LAST)::BIGINT AS lap_position,
         lap.lap_duration = min(lap.lap_duration) OVER (PARTITION BY lap.session_key, lap.driver_number)
           AS is_driver_fastest_lap,
         lap.lap_duration = min(lap.lap_duration) OVER (PARTITION BY lap.session_key) AS is_session_fastest_lap
  FROM stg_laps AS lap
  JOIN stg_sessions AS ses USING (session_key)
  LEFT JOIN stg_drivers AS drv ON drv.session_key = lap.session_key AND drv.driver_number = lap.driver_number
  WHERE NOT lap.is_pit_out_lap
),
fct_race_results AS (
  SELECT pos.session_key, pos.driver_number, drv.full_name AS driver_name, drv.team_name,
         pos.position AS final_position, ses.session_name, ses.circuit_short_name, ses.location, ses.year
  FROM stg_positions AS pos
  JOIN stg_sessions AS ses ON ses.session_key = pos.session_key AND ses.session_type = 'Race'
  LEFT JOIN stg_drivers AS drv ON drv.session_key = pos.session_key AND drv.driver_number = pos.driver_number
  QUALIFY row_number() OVER (
    PARTITION BY pos.session_key, pos.driver_number
    ORDER BY pos.position_timestamp DESC NULLS FIRST, pos.position DESC,
             ses.session_name DESC NULLS LAST, ses.circuit_short_name DESC NULLS LAST,
             ses.location DESC NULLS LAST, ses.year DESC NULLS LAST) = 1
)"""


_PLAIN = _layer_sql("raw_sessions", "raw_drivers", "raw_laps", "raw_positions")
_RELOADED = _layer_sql("raw_sessions_dup", "raw_drivers", "raw_laps", "raw_positions")

# The race a refresh picks.
_LATEST = f"""
latest AS (
  SELECT session_key, session_name, date_end FROM raw_sessions
  WHERE session_type = 'Race' AND date_end < TIMESTAMP '{AS_OF.replace("T", " ").rstrip("Z")}'
  ORDER BY date_end DESC, session_key LIMIT 1
)"""


def _plain(body: str) -> str:
    return f"WITH {_RAW},{_PLAIN}\n{body}"


def _reloaded(body: str) -> str:
    return f"WITH {_RAW},{_RELOADED}\n{body}"


def _records(entity: str) -> str:
    """Select list of a record: raw columns under their record names."""
    names = [n for n in raw_names(entity) if n != "ingested_at"]
    if entity == "laps":
        names = [f"{n} AS duration_sector_{n[8]}" if n.startswith("segment_") else n for n in names]
    return ", ".join(names)


def _bundle(entity: str) -> str:
    return (
        f"WITH {_RAW},{_LATEST}\nSELECT {_records(entity)}, {_STAMP} AS ingested_at "
        f"FROM raw_{entity} WHERE session_key = (SELECT session_key FROM latest)"
    )


def _iso(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS {column}"


def _sessions_of(year: int) -> str:
    return f"WITH {_RAW}\nSELECT * EXCLUDE (ingested_at) FROM raw_sessions WHERE year = {year}"


def _not_null(prefix: str, checks: dict[str, tuple[str, ...]]) -> str:
    parts = [
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, 'not_null' AS check_name, "
        f"count(*) FILTER (WHERE {column} IS NULL) AS failures FROM {prefix}{table}"
        for table, columns in checks.items() for column in columns
    ]
    return " UNION ALL ".join(parts)


def _unique(relation: str, table: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, 'session_key' AS column_name, 'unique' AS check_name, "
        f"count(*) AS failures FROM (SELECT session_key FROM {relation} WHERE session_key IS NOT NULL "
        "GROUP BY session_key HAVING count(*) > 1)"
    )


def _required() -> str:
    """Laps and positions were landed without empty fields, sessions and drivers with them."""
    parts = []
    for table, fields in REQUIRED_FIELDS.items():
        for field in fields:
            absent = f"{field} IS NULL" if table in ("laps", "positions") else "FALSE"
            parts.append(
                f"SELECT '{table}' AS table_name, '{field}' AS column_name, 'required' AS check_name, "
                f"count(*) FILTER (WHERE {absent}) AS failures FROM raw_{table}"
            )
    return " UNION ALL ".join(parts)


_COUNTS_PER_SESSION = " ".join(
    f"LEFT JOIN (SELECT session_key, count(*) AS {t} FROM raw_{t} GROUP BY session_key) USING (session_key)"
    for t in ENTITIES
)

def _mirrored(entity: str) -> str:
    return (
        f"WITH {_RAW}\nSELECT * FROM raw_{entity} WHERE session_key % 2 = 0 UNION ALL "
        f"SELECT * FROM raw_{entity} WHERE session_key % 2 = 0 AND session_key % 10 = 0 UNION ALL "
        f"SELECT * REPLACE (ingested_at + INTERVAL 1 DAY AS ingested_at) FROM raw_{entity} "
        "WHERE session_key % 2 = 1 AND session_key % 3 <> 0"
    )


ORACLE_SQL: dict[str, str] = {
    "src_sessions_filtered": _sessions_of(YEAR),
    "src_bundle_sessions": _bundle("sessions"),
    "src_bundle_drivers": _bundle("drivers"),
    "src_bundle_laps": _bundle("laps"),
    "src_bundle_positions": _bundle("positions"),
    "src_latest_sessions": _sessions_of(YEAR),
    "src_empty_selection": f"SELECT * FROM ({_sessions_of(YEAR)}) WHERE false",
    "src_catalogue": f"WITH {_RAW}\nSELECT * EXCLUDE (ingested_at) "
    f"REPLACE ({_iso('date_start')}, {_iso('date_end')}) FROM raw_sessions",
    "hist_selection": f"WITH {_RAW}\nSELECT session_key, session_name, session_type, {_iso('date_start')}, year "
    f"FROM raw_sessions AS r WHERE year = {YEAR} AND session_type = 'Practice' "
    "ORDER BY r.year, r.date_start, r.session_key",
    "hist_summary": f"WITH {_RAW}\nSELECT year, session_type, count(*) AS sessions FROM raw_sessions "
    f"WHERE year = {YEAR} GROUP BY ALL ORDER BY ALL",
    "catalogue_summary": f"WITH {_RAW}\nSELECT year, session_type, count(*) AS sessions FROM raw_sessions "
    "GROUP BY ALL ORDER BY ALL",
    "latest_completed_race": f"WITH {_RAW},{_LATEST}\nSELECT * REPLACE ({_iso('date_end')}) FROM latest",
    "load_sessions_shape": f"WITH {_RAW},\n{_RESTAMPED}\nSELECT * FROM run_sessions",
    "load_drivers_shape": f"WITH {_RAW},\n{_RESTAMPED}\nSELECT * FROM run_drivers",
    "load_laps_rename": f"WITH {_RAW},\n{_RESTAMPED}\nSELECT * FROM run_laps",
    "load_positions_shape": f"WITH {_RAW},\n{_RESTAMPED}\nSELECT * FROM run_positions",
    "load_counts": f"WITH {_RAW}\n"
    + " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS loaded FROM raw_{t}" for t in ENTITIES),
    "backfill_replayed": f"WITH {_RAW},\n{_RESTAMPED}\nSELECT * FROM run_laps",
    "load_broken": f"WITH {_RAW}\nSELECT session_key, CASE WHEN bad THEN 'failed' ELSE 'loaded' END AS status, "
    "CASE WHEN bad THEN 'laps: lap_number exceeds its limit of 3' END AS error, CASE WHEN bad THEN 0 ELSE 1 END::BIGINT "
    "AS sessions FROM (SELECT session_key, session_key % 50 = 3 AND session_key IN (SELECT session_key FROM raw_laps) "
    "AS bad FROM raw_sessions)",
    "load_ledger": f"WITH {_RAW}\nSELECT session_key, session_name, year, 'loaded' AS status, "
    + ", ".join(f"ifnull({t}, 0) AS {t}" for t in ENTITIES)
    + f", NULL::VARCHAR AS error FROM raw_sessions {_COUNTS_PER_SESSION}",
    "backfill_year": f"WITH {_RAW}\nSELECT session_key, year, 'loaded' AS status, "
    + ", ".join(f"ifnull({t}, 0) AS {t}" for t in ENTITIES)
    + f" FROM raw_sessions {_COUNTS_PER_SESSION} WHERE year = {YEAR}",
    "backfill_lap_times": f"WITH {_RAW},\n{_RESTAMPED},"
    + _layer_sql("run_sessions", "run_drivers", "run_laps", "run_positions")
    + "\nSELECT * FROM fct_lap_times",
    "refresh_race_results": f"WITH {_RAW},\n{_RESTAMPED},{_LATEST},"
    + _layer_sql(*[f"(SELECT * FROM run_{t} WHERE session_key IN (SELECT session_key FROM latest))" for t in ENTITIES])
    + "\nSELECT * FROM fct_race_results",
    "view_stg_laps": _plain("SELECT * FROM stg_laps"),
    "table_fct_race_results": _plain("SELECT * FROM fct_race_results"),
    "promote_sessions": f"WITH {_RAW}\nSELECT * FROM raw_sessions",
    "promote_drivers": f"WITH {_RAW}\nSELECT * FROM raw_drivers",
    "promote_laps": f"WITH {_RAW}\nSELECT * FROM raw_laps",
    "promote_positions": f"WITH {_RAW}\nSELECT * FROM raw_positions",
    "upsert_sessions": f"WITH {_RAW}\nSELECT * FROM raw_sessions_dup "
    "QUALIFY row_number() OVER (PARTITION BY session_key ORDER BY ingested_at DESC NULLS FIRST) = 1",
    "update_dim_drivers": _reloaded("SELECT * FROM dim_drivers"),
    "update_lap_times": _reloaded("SELECT * FROM fct_lap_times"),
    "update_race_results": _reloaded("SELECT * FROM fct_race_results"),
    **{f"mirror_{t}": _mirrored(t) for t in ENTITIES},
    "promotion_lag": f"WITH {_RAW}\nSELECT session_type AS load_id, CASE session_type WHEN 'Race' THEN 'waiting' "
    "ELSE 'copied' END AS status, TRUE AS in_time, count(*) AS loaded FROM raw_sessions GROUP BY ALL",
    "stg_sessions": _plain("SELECT * FROM stg_sessions"),
    "stg_drivers": _plain("SELECT * FROM stg_drivers"),
    "stg_laps": _plain("SELECT * FROM stg_laps"),
    "stg_positions": _plain("SELECT * FROM stg_positions"),
    "dim_drivers": _plain("SELECT * FROM dim_drivers"),
    "fct_lap_times": _plain("SELECT * FROM fct_lap_times"),
    "fct_race_results": _plain("SELECT * FROM fct_race_results"),
    "fct_lap_times_fanout": _reloaded("SELECT * FROM fct_lap_times"),
    "driver_list": _plain(
        "SELECT DISTINCT driver_number, full_name, team_name FROM dim_drivers "
        "ORDER BY full_name NULLS LAST, driver_number, team_name NULLS LAST"
    ),
    "kpi_total_drivers": _plain("SELECT count(*) AS cnt FROM dim_drivers"),
    "kpi_total_laps": _plain("SELECT count(*) AS cnt FROM fct_lap_times"),
    "kpi_avg_lap": _plain("SELECT avg(lap_duration) AS avg_lap FROM fct_lap_times WHERE lap_duration > 0"),
    "kpi_sessions": _plain("SELECT count(DISTINCT session_key) AS cnt FROM fct_race_results"),
    "driver_standings": _plain(
        "SELECT dim.driver_number, dim.full_name, dim.team_name, count(DISTINCT res.session_key) AS races, "
        "avg(res.final_position) AS avg_position FROM fct_race_results AS res "
        "JOIN dim_drivers AS dim USING (driver_number) GROUP BY ALL "
        "ORDER BY avg_position NULLS LAST, 1, 2 NULLS LAST, 3 NULLS LAST, 4 LIMIT 10"
    ),
    "driver_info": _plain(f"SELECT * FROM dim_drivers WHERE driver_number = {DRIVER_NUMBER}"),
    "driver_lap_series": _plain(
        f"SELECT lap_number, lap_duration FROM fct_lap_times WHERE driver_number = {DRIVER_NUMBER} "
        "AND lap_duration > 0 ORDER BY lap_number NULLS LAST, lap_duration"
    ),
    "driver_lap_stats": _plain(
        "SELECT min(lap_duration) AS best_lap, avg(lap_duration) AS avg_lap, count(*) AS total_laps "
        f"FROM fct_lap_times WHERE driver_number = {DRIVER_NUMBER} AND lap_duration > 0"
    ),
    "fastest_laps": _plain(
        "SELECT lap.session_key, dim.full_name, dim.team_name, lap.lap_number, lap.lap_duration "
        "FROM fct_lap_times AS lap JOIN dim_drivers AS dim USING (driver_number) WHERE lap.lap_duration > 0 "
        "ORDER BY 5, 1, 2 NULLS LAST, 3 NULLS LAST, 4 NULLS LAST LIMIT 10"
    ),
    "team_comparison": _plain(
        "SELECT dim.team_name, count(*) AS total_laps, avg(lap.lap_duration) AS avg_lap_time, "
        "min(lap.lap_duration) AS best_lap FROM fct_lap_times AS lap JOIN dim_drivers AS dim USING (driver_number) "
        "WHERE lap.lap_duration > 0 GROUP BY dim.team_name ORDER BY avg_lap_time NULLS LAST, 1 NULLS LAST"
    ),
    "driver_lookup": _plain(
        f"SELECT driver_number FROM dim_drivers WHERE full_name = '{FULL_NAME}' ORDER BY driver_number LIMIT 1"
    ),
    "dq_not_null_raw": _plain(_not_null("raw_", NOT_NULL_RAW)),
    "dq_unique_raw_sessions": _plain(_unique("raw_sessions_dup", "sessions")),
    "dq_not_null_staging": _plain(_not_null("", NOT_NULL_STAGING)),
    "dq_unique_stg_sessions": _reloaded(_unique("stg_sessions", "stg_sessions")),
    "dq_all_checks": _plain(
        " UNION ALL ".join(
            [
                _not_null("raw_", NOT_NULL_RAW), _unique("raw_sessions", "sessions"),
                _not_null("", NOT_NULL_STAGING), _unique("stg_sessions", "stg_sessions"),
            ]
        )
    ),
    "dq_from_state": _reloaded(
        " UNION ALL ".join(
            [
                _not_null("raw_", NOT_NULL_RAW).replace("FROM raw_sessions", "FROM raw_sessions_dup"),
                _unique("raw_sessions_dup", "sessions"), _not_null("", NOT_NULL_STAGING),
                _unique("stg_sessions", "stg_sessions"),
            ]
        )
    ),
    "dq_required_fields": f"WITH {_RAW}\n{_required()}",
}
