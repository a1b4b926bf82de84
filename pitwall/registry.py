"""Every query by name: callables (spark, sf_dir) -> DataFrame over the given test tables."""

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall import pipeline
from pitwall.operators import checks
from pitwall.plans import quality, reports, staging
from pitwall.plans.layers import Layers, RawTables
from pitwall.schemas import ENTITIES, RACE, REQUIRED_FIELDS, raw_schema
from pitwall.sinks import raw as raw_sink
from pitwall.sinks.check_state import check_counts, checks_from_state
from pitwall.sinks.marts import publish, read_mart
from pitwall.sources import catalogue as cat
from pitwall.sources import given, landing
from pitwall.sources.tables import read_raw, with_attempt
from pitwall.storage import scratch_folder
from pitwall.streaming.lag import lag_report
from pitwall.streaming.mirror import keep_mirrored, mirror, read_mirror
from pitwall.streaming.promotion import promote, promote_by_key, read_keyed, read_promoted

# Parameters of the registered queries.
RUN_TS = datetime(2025, 1, 1)
AS_OF = "2000-06-15T12:00:00Z"
YEAR = 1998
DRIVER_NUMBER = 9
FULL_NAME = "DRV_9"
# JSON lines take some thirteen times the bytes otherwise.
LANDED_AS = "gzip"

Query = Callable[[SparkSession, str], DataFrame]


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    return Layers(given.raw_tables(spark, sf_dir), RUN_TS)


_landings: dict[tuple[str, str], str] = {}


def landing_of(spark: SparkSession, sf_dir: str) -> str:
    """The given tables as landed JSON, written by Spark once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landings:
        root = scratch_folder(spark, "landing")
        raw = given.raw_tables(spark, sf_dir)
        landing.land_all({entity: getattr(raw, entity) for entity in ENTITIES}, root, compression=LANDED_AS)
        _landings[key] = root
    return _landings[key]


_races: dict[str, int] = {}


def _latest_race_of(spark: SparkSession, root: str) -> int:
    """The latest race of a landing folder, found once per application."""
    if root not in _races:
        _races[root] = cat.latest_completed_race(landing.catalogue(spark, root), AS_OF).first()["session_key"]
    return _races[root]


def _bundle_of(entity: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = landing_of(spark, sf_dir)
        return landing.extract_entity(spark, root, entity, _latest_race_of(spark, root), RUN_TS)

    return query


def _fetched_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.fetch_sessions(spark, landing_of(spark, sf_dir), year=YEAR)


def _latest_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.latest_sessions(spark, landing_of(spark, sf_dir), RUN_TS.replace(year=YEAR))


def _catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.catalogue(spark, landing_of(spark, sf_dir))


def _hist_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = cat.chosen_sessions(_catalogue(spark, sf_dir), YEAR, "Practice")
    return cat.backfill_order(chosen).select("session_key", "session_name", "session_type", "date_start", "year")


def _hist_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.summary(cat.chosen_sessions(_catalogue(spark, sf_dir), YEAR))


def _catalogue_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.summary(_catalogue(spark, sf_dir))


def _latest_completed_race(spark: SparkSession, sf_dir: str) -> DataFrame:
    race = cat.latest_completed_race(_catalogue(spark, sf_dir), AS_OF)
    return race.select("session_key", "session_name", "date_end")


def _loaded(entity: str) -> Query:
    """K1-K4: append all landed records of an entity to its raw table and read that back."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, attempt = scratch_folder(spark, "raw"), raw_sink.new_attempt("all")
        records = landing.checked_entity(spark, landing_of(spark, sf_dir), entity, RUN_TS)
        raw_sink.append_rows(raw_sink.raw_shape(records, entity), root, entity, attempt)
        raw_sink.commit(spark, root, "all", attempt)
        return read_raw(spark, root, entity)

    return query


def _load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bundle loaded twice under one id counts once."""
    bundle, root = landing.checked_bundle(spark, landing_of(spark, sf_dir), RUN_TS), scratch_folder(spark, "raw")
    raw_sink.load_bundle(bundle, root, "all")
    return raw_sink.counts_frame(spark, raw_sink.load_bundle(bundle, root, "all"))


def _load_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger when every 50th session has laps with a number beyond the limit."""
    root = scratch_folder(spark, "broken")
    raw = given.raw_tables(spark, sf_dir)
    numbers = F.when(F.col("session_key") % 50 == 3, F.lit(1000)).otherwise(F.col("lap_number"))
    tables = {entity: getattr(raw, entity) for entity in ENTITIES}
    tables["laps"] = tables["laps"].withColumn("lap_number", numbers.cast(tables["laps"].schema["lap_number"].dataType))
    landing.land_all(tables, f"{root}/land", compression=LANDED_AS)
    ledger = pipeline.backfill(spark, f"{root}/land", f"{root}/raw", "all", RUN_TS)
    return ledger.select("session_key", "status", "error", "sessions")


def _backfill_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Races first, then everything, then everything again, all under one load id: laps are there once."""
    root, source = scratch_folder(spark, "replay"), landing_of(spark, sf_dir)
    pipeline.backfill(spark, source, root, "season", RUN_TS, session_type=RACE)
    for _ in range(2):
        pipeline.backfill(spark, source, root, "season", RUN_TS)
    return read_raw(spark, root, "laps")


def _empty_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year without sessions gives no rows, and the columns and types of sessions."""
    return landing.fetch_sessions(spark, landing_of(spark, sf_dir), year=1900)


def _load_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.backfill(spark, landing_of(spark, sf_dir), scratch_folder(spark, "raw"), "all", RUN_TS)


def _view_stg_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging.register_views(spark, {"stg_laps": layers(spark, sf_dir).stg_laps})
    return spark.sql("SELECT * FROM stg_laps")


def _table_fct_race_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_folder(spark, "marts")
    publish(layers(spark, sf_dir).fct_race_results, root, "fct_race_results")
    return read_mart(spark, root, "fct_race_results").drop("updated_at")


def _attempt(df: DataFrame, root: str, entity: str, load_id: str, committed: bool = True) -> None:
    attempt = raw_sink.new_attempt(load_id)
    raw_sink.append_rows(df, root, entity, attempt)
    if committed:
        raw_sink.commit(df.sparkSession, root, load_id, attempt)


def _promoted(entity: str) -> Query:
    """A committed load and one that never was; promoted twice, the second time with a new checkpoint."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_folder(spark, "promotion")
        rows = getattr(given.raw_tables(spark, sf_dir), entity)
        _attempt(rows, f"{root}/from", entity, "all")
        _attempt(rows, f"{root}/from", entity, "failed", committed=False)
        for state in ("first", "second"):
            promote(spark, f"{root}/from", entity, f"{root}/to", f"{root}/{state}").awaitTermination()
        return read_promoted(spark, f"{root}/to", entity)

    return query


def _upsert_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run fills the table, a second one, with a new checkpoint, brings the reloaded races."""
    root = scratch_folder(spark, "upsert")
    sessions = given.raw_sessions(spark, sf_dir)
    for state, part in (("first", sessions), ("second", given.reloaded_sessions(sessions))):
        _attempt(part, f"{root}/from", "sessions", state)
        promote_by_key(
            spark, f"{root}/from", "sessions", f"{root}/to", f"{root}/{state}", ["session_key"], "ingested_at"
        ).awaitTermination()
    return read_keyed(spark, f"{root}/to", raw_schema("sessions"))


def _mirrored(entity: str) -> Query:
    """Two loads are mirrored; one is withdrawn and loaded anew with other times, another one comes twice; mirrored again.

    Even sessions lie in the load that stays; those of every third odd session do not come back.
    """

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_folder(spark, "mirror")
        rows = getattr(given.raw_tables(spark, sf_dir), entity)
        even, odd = (rows.filter(F.col("session_key") % 2 == part) for part in (0, 1))
        _attempt(even, f"{root}/from", entity, "stays")
        _attempt(odd, f"{root}/from", entity, "goes")
        mirror(spark, f"{root}/from", entity, f"{root}/to")
        raw_sink.withdraw(spark, f"{root}/from", "goes")
        again = odd.filter(F.col("session_key") % 3 != 0).withColumn("ingested_at", F.expr("ingested_at + INTERVAL 1 DAY"))
        _attempt(again, f"{root}/from", entity, "again")
        _attempt(even.filter(F.col("session_key") % 10 == 0), f"{root}/from", entity, "twice")
        keep_mirrored(spark, f"{root}/from", entity, f"{root}/to", f"{root}/state").awaitTermination()
        return read_mirror(spark, f"{root}/to", entity)

    return query


def _promotion_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load per session type; all but the last are promoted before the report."""
    root, types = scratch_folder(spark, "lag"), ("Practice", "Qualifying", RACE)
    sessions = given.raw_sessions(spark, sf_dir)
    for kind in types:
        if kind == types[-1]:
            promote(spark, f"{root}/from", "sessions", f"{root}/to", f"{root}/state").awaitTermination()
        _attempt(sessions.filter(F.col("session_type") == kind), f"{root}/from", "sessions", kind)
    report = lag_report(spark, f"{root}/from", f"{root}/to")
    loaded = with_attempt(spark, f"{root}/from", "sessions").groupBy("attempt").agg(F.count(F.lit(1)).alias("loaded"))
    return report.join(loaded, "attempt", "left").select(
        "load_id", "status", "in_time", F.coalesce("loaded", F.lit(0)).cast("long").alias("loaded")
    )


def _backfill_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of one year's back-fill, which opens only folders with sessions of that year."""
    ledger = pipeline.backfill(spark, landing_of(spark, sf_dir), scratch_folder(spark, "raw"), "year", RUN_TS, year=YEAR)
    return ledger.select("session_key", "year", "status", *ENTITIES)


_published: dict[tuple[str, str], str] = {}


def _of_published(report: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """A report on the published lap fact and dimension; they are published once per application."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _published:
            root, found = scratch_folder(spark, "marts"), layers(spark, sf_dir)
            publish(found.fct_lap_times, root, "fct_lap_times")
            publish(found.dim_drivers, root, "dim_drivers")
            _published[key] = root
        fact, dim = (read_mart(spark, _published[key], name) for name in ("fct_lap_times", "dim_drivers"))
        return report(fact, dim)

    return query


def _backfill_lap_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed records -> raw tables -> published marts, for the whole catalogue."""
    root = scratch_folder(spark, "backfill")
    pipeline.backfill(spark, landing_of(spark, sf_dir), f"{root}/raw", "all", RUN_TS)
    pipeline.build_marts(spark, f"{root}/raw", f"{root}/marts", RUN_TS)
    return read_mart(spark, f"{root}/marts", "fct_lap_times").drop("updated_at")


def _refresh_race_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The refresh run: latest race from the landed records to the published results."""
    root = scratch_folder(spark, "refresh")
    pipeline.refresh(spark, landing_of(spark, sf_dir), f"{root}/raw", f"{root}/marts", AS_OF, RUN_TS)
    return read_mart(spark, f"{root}/marts", "fct_race_results").drop("updated_at")


_updates: dict[tuple[str, str], str] = {}


def _updated_marts(spark: SparkSession, sf_dir: str) -> str:
    """Marts after three updates: odd sessions; the others and all races again; odd sessions withdrawn and loaded anew."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _updates:
        root, raw = scratch_folder(spark, "updates"), given.raw_tables(spark, sf_dir)
        odd = F.col("session_key") % 2 == 1
        parts = {
            part: {entity: getattr(raw, entity).filter(rule) for entity in ENTITIES} for part, rule in (("odd", odd), ("even", ~odd))
        }
        races = raw.sessions.filter(F.col("session_type") == RACE)
        again = races.withColumn("ingested_at", F.expr("ingested_at + INTERVAL 1 DAY"))
        parts["even"]["sessions"] = parts["even"]["sessions"].unionByName(again)
        for part in ("odd", "even", "odd"):
            raw_sink.withdraw(spark, f"{root}/raw", part)
            raw_sink.load_bundle(parts[part], f"{root}/raw", part)
            pipeline.update_marts(spark, f"{root}/raw", f"{root}/marts", RUN_TS)
        _updates[key] = f"{root}/marts"
    return _updates[key]


def _updated(mart: str) -> Query:
    return lambda spark, sf_dir: read_mart(spark, _updated_marts(spark, sf_dir), mart).drop("updated_at")


def _of_layers(build: Callable[[Layers], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(layers(spark, sf_dir))


def _reloaded_layers(spark: SparkSession, sf_dir: str) -> Layers:
    """All layers when races were loaded twice."""
    raw = given.raw_tables(spark, sf_dir)
    again = given.reloaded_sessions(raw.sessions)
    return Layers(RawTables(lambda: again, lambda: raw.drivers, lambda: raw.laps, lambda: raw.positions), RUN_TS)


def _of_reloaded_layers(build: Callable[[Layers], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_reloaded_layers(spark, sf_dir))


def _checks_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks before and after races are loaded again, and after a load that is withdrawn: the last report."""
    root, raw = scratch_folder(spark, "checks"), given.raw_tables(spark, sf_dir)
    whole = {entity: getattr(raw, entity) for entity in ENTITIES}
    empty = {entity: df.limit(0) for entity, df in whole.items()}
    races = raw.sessions.filter(F.col("session_type") == RACE)
    for load_id, part in (("all", whole), ("wrong", {**empty, "sessions": raw.sessions}), ("races", {**empty, "sessions": races})):
        raw_sink.load_bundle(part, root, load_id)
        check_counts(spark, root)
    raw_sink.withdraw(spark, root, "wrong")
    return checks_from_state(spark, root)


def _required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = landing_of(spark, sf_dir)
    return checks.all_reports(
        [
            checks.required_fields_report(landing.json_lines(spark, root, entity), entity, list(fields))
            for entity, fields in REQUIRED_FIELDS.items()
        ]
    )


QUERIES: dict[str, Query] = {
    # Sources (S1-S10)
    "src_sessions_filtered": _fetched_sessions,
    "src_bundle_sessions": _bundle_of("sessions"),
    "src_bundle_drivers": _bundle_of("drivers"),
    "src_bundle_laps": _bundle_of("laps"),
    "src_bundle_positions": _bundle_of("positions"),
    "src_latest_sessions": _latest_sessions,
    "src_catalogue": _catalogue,
    "src_empty_selection": _empty_selection,
    "hist_selection": _hist_selection,
    "hist_summary": _hist_summary,
    "catalogue_summary": _catalogue_summary,
    "latest_completed_race": _latest_completed_race,
    # Loads (K1-K6) and runs
    "load_sessions_shape": _loaded("sessions"),
    "load_drivers_shape": _loaded("drivers"),
    "load_laps_rename": _loaded("laps"),
    "load_positions_shape": _loaded("positions"),
    "load_counts": _load_counts,
    "load_ledger": _load_ledger,
    "load_broken": _load_broken,
    "backfill_replayed": _backfill_replayed,
    "backfill_year": _backfill_year,
    "backfill_lap_times": _backfill_lap_times,
    "refresh_race_results": _refresh_race_results,
    # Materialisation and promotion
    "view_stg_laps": _view_stg_laps,
    "table_fct_race_results": _table_fct_race_results,
    "promote_sessions": _promoted("sessions"),
    "promote_drivers": _promoted("drivers"),
    "promote_laps": _promoted("laps"),
    "promote_positions": _promoted("positions"),
    "upsert_sessions": _upsert_sessions,
    "mirror_sessions": _mirrored("sessions"),
    "mirror_drivers": _mirrored("drivers"),
    "mirror_laps": _mirrored("laps"),
    "mirror_positions": _mirrored("positions"),
    "promotion_lag": _promotion_lag,
    "update_dim_drivers": _updated("dim_drivers"),
    "update_lap_times": _updated("fct_lap_times"),
    "update_race_results": _updated("fct_race_results"),
    # Staging (T1-T4) and marts
    "stg_sessions": _of_layers(lambda y: y.stg_sessions),
    "stg_drivers": _of_layers(lambda y: y.stg_drivers),
    "stg_laps": _of_layers(lambda y: y.stg_laps),
    "stg_positions": _of_layers(lambda y: y.stg_positions),
    "dim_drivers": _of_layers(lambda y: y.dim_drivers.drop("updated_at")),
    "fct_lap_times": _of_layers(lambda y: y.fct_lap_times.drop("updated_at")),
    "fct_race_results": _of_layers(lambda y: y.fct_race_results.drop("updated_at")),
    "fct_lap_times_fanout": _of_reloaded_layers(lambda y: y.fct_lap_times.drop("updated_at")),
    # Reports (Q1-Q12)
    "driver_list": _of_layers(lambda y: reports.driver_list(y.dim_drivers)),
    "kpi_total_drivers": _of_layers(lambda y: reports.total_drivers(y.dim_drivers)),
    "kpi_total_laps": _of_published(lambda fact, dim: reports.total_laps(fact)),
    "kpi_avg_lap": _of_published(lambda fact, dim: reports.average_lap(fact)),
    "kpi_sessions": _of_layers(lambda y: reports.total_sessions(y.fct_race_results)),
    "driver_standings": _of_layers(lambda y: reports.driver_standings(y.fct_race_results, y.dim_drivers)),
    "driver_info": _of_layers(lambda y: reports.driver_info(y.dim_drivers, DRIVER_NUMBER).drop("updated_at")),
    "driver_lap_series": _of_published(lambda fact, dim: reports.driver_lap_series(fact, DRIVER_NUMBER)),
    "driver_lap_stats": _of_published(lambda fact, dim: reports.driver_lap_stats(fact, DRIVER_NUMBER)),
    "fastest_laps": _of_published(reports.fastest_laps),
    "team_comparison": _of_published(reports.team_comparison),
    "driver_lookup": _of_layers(lambda y: reports.driver_lookup(y.dim_drivers, FULL_NAME)),
    # Checks (D1-D5)
    "dq_not_null_raw": _of_layers(quality.raw_not_null),
    "dq_unique_raw_sessions": _of_reloaded_layers(quality.raw_unique),
    "dq_not_null_staging": _of_layers(quality.staging_not_null),
    "dq_unique_stg_sessions": _of_reloaded_layers(quality.staging_unique),
    "dq_all_checks": _of_layers(quality.data_checks),
    "dq_from_state": _checks_from_state,
    "dq_required_fields": _required_fields,
}
