"""Whole runs: back-fill, refresh with the latest race, build of the marts."""

from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.jobs import side_by_side
from pitwall.operators.lookup import looked_up
from pitwall.plans import marts, staging
from pitwall.session import sized_for, tuned
from pitwall.sinks.marts import MARTS, SESSION_FACTS, publish, replace_sessions
from pitwall.sinks.raw import load_sessions
from pitwall.sources.catalogue import chosen_sessions, latest_completed_race
from pitwall.sources.landing import catalogue
from pitwall.sources.tables import attempts_now, read_attempts, read_raw, read_raw_tables, session_keys
from pitwall.storage import checkpointed, current_version, folder_bytes, next_version, read_version, write_version


def build_marts(spark: SparkSession, raw_root: str, marts_root: str, run_ts: datetime | str | None = None) -> None:
    """Rebuild all marts from the raw tables.

    Staged drivers feed both facts and are kept between them; executors that get
    lost only cost a recomputation. They are kept before the facts are planned, since
    their number decides how they are looked up.
    """
    sized_for(tuned(spark), folder_bytes(spark, raw_root))
    raw = read_raw_tables(spark, raw_root)
    drivers = staging.stg_drivers(raw.drivers).persist(StorageLevel.MEMORY_AND_DISK)
    laps, positions = staging.stg_laps(raw.laps), staging.stg_positions(raw.positions)
    try:
        sessions = looked_up(staging.stg_sessions(raw.sessions), raw.sessions.count(), "merge")
        known = looked_up(drivers, drivers.count(), "merge")
        builds = {
            "dim_drivers": lambda: marts.dim_drivers(drivers, run_ts),
            "fct_lap_times": lambda: marts.fct_lap_times(laps, sessions, known, run_ts),
            "fct_race_results": lambda: marts.fct_race_results(sessions, positions, known, run_ts=run_ts),
        }
        side_by_side(spark, lambda name: publish(builds[name](), marts_root, name), MARTS)
    finally:
        drivers.unpersist()


STATE = "dim_drivers_newest"


def update_marts(
    spark: SparkSession, raw_root: str, marts_root: str, run_ts: datetime | str | None = None
) -> dict[str, int]:
    """Bring the marts to what the raw tables hold now, at the cost of what has changed since the last update.

    Facts depend on one session at a time, so only sessions with rows in attempts that were
    committed or withdrawn since are built anew, from the attempts that hold them, and replaced
    in their buckets. The dimension is a maximum, so its newest records are kept beside it and
    compared with the new ones; only a withdrawal makes it look at all drivers again. Returns the
    numbers of attempts and of buckets written. The list of attempts is written last, so an
    update that fails is done again as a whole. Rows of other sessions keep their ``updated_at``.
    """
    tuned(spark)
    attempts = checkpointed(attempts_now(spark, raw_root))
    version = current_version(spark, f"{marts_root}/updates")
    seen = spark.createDataFrame([], "attempt string")
    if version is not None:
        seen = read_version(spark, f"{marts_root}/updates", version)
    new = checkpointed(attempts.join(seen, "attempt", "left_anti"))
    gone = checkpointed(seen.join(attempts, "attempt", "left_anti"))
    n_new, n_gone = new.count(), gone.count()
    if version is not None and n_new + n_gone == 0:
        return {"attempts": 0, **dict.fromkeys(SESSION_FACTS, 0)}
    keys = session_keys(spark, raw_root, new.unionByName(gone))
    changed = keys.join(new.unionByName(gone), "attempt", "left_semi").select("session_key")
    touched = checkpointed(changed.filter(F.col("session_key").isNotNull()).distinct())
    holding = keys.join(touched, "session_key", "left_semi").select("attempt").distinct()
    holding = checkpointed(holding.join(attempts, "attempt", "left_semi"))

    def of_touched(entity: str) -> DataFrame:
        return read_attempts(spark, raw_root, entity, holding).join(touched, "session_key", "left_semi")

    sessions, laps = staging.stg_sessions(of_touched("sessions")), staging.stg_laps(of_touched("laps"))
    positions = staging.stg_positions(of_touched("positions"))
    drivers = staging.stg_drivers(of_touched("drivers")).persist(StorageLevel.MEMORY_AND_DISK)

    def dimension() -> int:
        state = f"{marts_root}/{STATE}"
        before = current_version(spark, state)
        known = staging.known_drivers(read_attempts(spark, raw_root, "drivers", attempts if n_gone or before is None else new))
        rows = known.select(*marts.NEWEST_COLUMNS)
        if before is not None and not n_gone:
            rows = rows.unionByName(read_version(spark, state, before))
        version = next_version(spark, state)
        write_version(marts.newest_drivers(rows), state, version)
        publish(marts.dim_drivers(read_version(spark, state, version), run_ts), marts_root, "dim_drivers")
        return 0

    builds = {
        "dim_drivers": dimension,
        "fct_lap_times": lambda: replace_sessions(
            marts.fct_lap_times(laps, sessions, drivers, run_ts), touched, marts_root, "fct_lap_times"
        ),
        "fct_race_results": lambda: replace_sessions(
            marts.fct_race_results(sessions, positions, drivers, run_ts=run_ts), touched, marts_root, "fct_race_results"
        ),
    }
    try:
        written = dict(zip(MARTS, side_by_side(spark, lambda name: builds[name](), MARTS)))
    finally:
        drivers.unpersist()
    write_version(attempts.coalesce(1), f"{marts_root}/updates", next_version(spark, f"{marts_root}/updates"))
    return {"attempts": n_new + n_gone, **{name: written[name] for name in SESSION_FACTS}}


def backfill(
    spark: SparkSession,
    landing_root: str,
    raw_root: str,
    load_id: str,
    run_ts: datetime | str,
    year: int | None = None,
    session_type: str | None = None,
    reload: bool = False,
) -> DataFrame:
    """Load the chosen part of the catalogue and return the ledger; marts are not rebuilt.

    Sessions loaded before are left out unless ``reload`` is set, in which case
    they are appended again. A load id may be used again: what it loaded before stays.
    """
    sized_for(tuned(spark), folder_bytes(spark, landing_root))
    chosen = chosen_sessions(catalogue(spark, landing_root, skip_broken=True, year=year), year, session_type)
    if not reload:
        loaded = read_raw(spark, raw_root, "sessions").select("session_key")
        chosen = chosen.join(looked_up(loaded, loaded.count()), "session_key", "left_anti")
    return load_sessions(spark, landing_root, raw_root, chosen, load_id, run_ts)


def refresh(
    spark: SparkSession,
    landing_root: str,
    raw_root: str,
    marts_root: str,
    as_of: datetime | str,
    run_ts: datetime | str,
    reload: bool = False,
) -> int | None:
    """Load the latest completed race and update the marts; None if there is no such race.

    A race loaded before is not loaded again unless ``reload`` is set. The update reads and
    replaces only what the load has changed.
    """
    race = latest_completed_race(catalogue(spark, landing_root, skip_broken=True), as_of)
    found = race.first()
    if found is None:
        return None
    key = found["session_key"]
    chosen = chosen_sessions(catalogue(spark, landing_root, skip_broken=True)).filter(f"session_key = {key:d}")
    known = read_raw(spark, raw_root, "sessions").filter(f"session_key = {key:d}")
    if reload or known.isEmpty():
        load_sessions(spark, landing_root, raw_root, chosen, f"session-{key}", run_ts, session_key=key)
    update_marts(spark, raw_root, marts_root, run_ts)
    return key
