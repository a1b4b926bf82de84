"""Landed JSON records (S1-S7): folders of JSON lines per entity, and an index of where sessions lie.

What ``land`` writes lies under ``keyed``, by season and, except for sessions, by session key
modulo a number of buckets that a landing folder keeps from its first record on. The index names
the folders of every session; it is written before the records, so it may name a folder too many
but never one too few. Fetching a session, a year or a set of sessions joins the folders with the
index, and Spark opens only those that the join leaves at run time.

Records may also be dropped from outside, into ``<entity>/landing_bucket=<n>`` or ``sessions``.
No index knows these; all of them are read, of one session those of its bucket. A record that
cannot be read makes a fetch fail.
"""

from collections.abc import Callable, Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.functions import conditions as c
from pitwall.jobs import side_by_side
from pitwall.operators.lookup import looked_up
from pitwall.schemas import (
    ENTITIES, RECORD_NAMES, STRICT_ENTITIES, raw_names, record_columns, record_schema,
)
from pitwall.storage import exists, folder_names, has_files, make_folder

# Buckets per entity of a landing folder that is told no other number: some terabytes.
LANDING_BUCKETS = 16
BUCKETED = ("drivers", "laps", "positions")
# Season of a session whose record has not been landed yet, or has no year.
UNKNOWN_SEASON = "unknown"
INDEX = "entity string, session_key bigint, landing_bucket int, season string"

# Problem of a record that is not JSON of the declared types.
UNREADABLE = "record cannot be parsed"


def buckets_of(spark: SparkSession, root: str) -> int:
    """The number of buckets per entity of a landing folder."""
    kept = folder_names(spark, f"{root}/layout", "buckets=")
    return int(kept[0]) if kept else LANDING_BUCKETS


def _kept_buckets(spark: SparkSession, root: str, wanted: int | None) -> int:
    """What the landing folder says; a new one is told the wanted number, which then stays, and gets folders to drop into."""
    if not exists(spark, f"{root}/layout"):
        number = wanted or LANDING_BUCKETS
        for entity in BUCKETED:
            for bucket in range(number):
                make_folder(spark, f"{root}/{entity}/landing_bucket={bucket}")
        make_folder(spark, f"{root}/sessions")
        make_folder(spark, f"{root}/layout/buckets={number}")
    found = buckets_of(spark, root)
    if wanted not in (None, found):
        raise ValueError(f"{root} has {found} sub-folders per entity, not {wanted}")
    return found


def _bucket(session_key: Column, buckets: int) -> Column:
    return F.pmod(session_key, F.lit(buckets)).cast("int")


def _index_path(root: str, entity: str) -> str:
    """A folder per entity: who ends first in a folder removes the work files of all that still write to it."""
    return f"{root}/places/{entity}"


def index_of(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """Where landed records of an entity lie: session_key, landing_bucket (NULL for sessions), season.

    Older landing folders have one index of all entities, which is read too.
    """
    paths = [path for path in (f"{root}/index", _index_path(root, entity)) if exists(spark, path)]
    index = spark.read.schema(INDEX).parquet(*paths) if paths else spark.createDataFrame([], INDEX)
    return index.filter(F.col("entity") == entity).drop("entity")


def _seasons(spark: SparkSession, root: str) -> DataFrame:
    """The season of every session landed so far; of a session landed under several years, the last."""
    known = index_of(spark, root, "sessions").filter(F.col("season") != UNKNOWN_SEASON)
    seasons = known.groupBy("session_key").agg(F.max("season").alias("season"))
    return looked_up(seasons, known.count())


def _folder_keys(entity: str) -> list[str]:
    return ["landing_bucket", "season"] if entity in BUCKETED else ["season"]


def land(
    records: DataFrame,
    root: str,
    entity: str,
    omit_nulls: bool = False,
    buckets: int | None = None,
    compression: str = "none",
    of_raw: bool = False,
) -> None:
    """Append records to a landing folder; raw rows (``of_raw``) become records once they lie together, as times are shorter than their text.

    Records of one folder are brought together, in partitions that Spark sizes by their bytes, so
    that a few large files are written and not one per task and folder. Sessions should be landed
    before their records; those of a session that is not known yet lie in a season of their own.
    Entities may be landed at the same time, as each has its own folders; one entity by one writer.
    """
    spark = records.sparkSession
    number = _kept_buckets(spark, root, buckets)
    seasons = _seasons(spark, root) if entity in BUCKETED else None

    def placed(rows: DataFrame) -> DataFrame:
        if entity in BUCKETED:
            rows = rows.drop("season").join(seasons, "session_key", "left")
            rows = rows.withColumn("landing_bucket", _bucket(F.col("session_key"), number))
        else:
            rows = rows.withColumn("season", F.col("year").cast("string"))
        return rows.withColumn("season", F.coalesce("season", F.lit(UNKNOWN_SEASON)))

    bucket = F.col("landing_bucket") if entity in BUCKETED else F.lit(None).cast("int").alias("landing_bucket")
    # Sessions are looked up once each, not with every record.
    sessions = placed(records.select("session_key", *([] if entity in BUCKETED else ["year"])).distinct())
    index = sessions.select(F.lit(entity).alias("entity"), "session_key", bucket, "season").distinct()
    # A row per session: one file.
    index.repartition(1).write.mode("append").parquet(_index_path(root, entity))
    keys = _folder_keys(entity)
    together = placed(records).hint("rebalance", *keys)
    together = to_records(together, entity, keys) if of_raw else together
    writer = together.write.mode("append").option("ignoreNullFields", omit_nulls)
    writer.option("compression", compression).partitionBy(*keys).json(f"{root}/keyed/{entity}")


def to_records(raw: DataFrame, entity: str, also: Iterable[str] = ()) -> DataFrame:
    """Raw rows as the records they were loaded from: record names, times as ISO text, no stamp; and other columns as they are."""
    back = {raw_name: record for record, raw_name in RECORD_NAMES.get(entity, {}).items()}
    renamed = raw.withColumnsRenamed(back)
    fields = []
    for name, kind in record_columns(entity):
        if kind == "timestamp_ntz":
            text = F.concat(F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
            fields.append(text.alias(name))
        else:
            fields.append(F.col(name))
    return renamed.select(*fields, *also)


def _scans(
    spark: SparkSession,
    root: str,
    entity: str,
    read: Callable[[str, str, T.StructType], DataFrame],
    session_key: int | None = None,
    year: int | None = None,
    sessions: DataFrame | None = None,
) -> DataFrame:
    """All landed records of an entity, or at least those of a session, a year (of sessions) or some sessions.

    ``read`` opens a part of a folder whose sub-folders give the columns of the given schema.
    """
    bucket = T.StructType([T.StructField("landing_bucket", T.IntegerType())] if entity in BUCKETED else [])
    in_bucket, one_bucket = None, ""
    if session_key and entity in BUCKETED:
        number = session_key % buckets_of(spark, root)
        in_bucket, one_bucket = F.col("landing_bucket") == F.lit(number), f"/landing_bucket={number}"
    found = []
    if exists(spark, f"{root}/keyed/{entity}{one_bucket}"):
        season = T.StructType([*bucket.fields, T.StructField("season", T.StringType())])
        keyed = read(f"{root}/keyed/{entity}", one_bucket, season)
        if year and entity not in BUCKETED:
            keyed = keyed.filter(F.col("season") == str(year))
        elif session_key or sessions is not None:
            index = index_of(spark, root, entity)
            if session_key:
                index = index.filter(F.col("session_key") == session_key)
            if sessions is not None:
                index = index.join(sessions.select("session_key"), "session_key", "left_semi")
            # A row per folder at most, so it may be broadcast.
            folders = F.broadcast(index.select(*_folder_keys(entity)).distinct())
            keyed = keyed.join(folders, _folder_keys(entity), "left_semi")
        found.append(keyed.drop("season", "landing_bucket"))
    if not found or has_files(spark, f"{root}/{entity}"):
        dropped = read(f"{root}/{entity}", "", bucket)
        found.append((dropped if in_bucket is None else dropped.filter(in_bucket)).drop("landing_bucket"))
    return reduce(DataFrame.unionByName, found)


def _text_of(spark: SparkSession) -> Callable[[str, str, T.StructType], DataFrame]:
    def read(path: str, part: str, folders: T.StructType) -> DataFrame:
        lines = spark.read.option("basePath", path).text(path + part)
        kinds = {f.name: f.dataType for f in folders}
        known = {n: (F.col(n) if n in lines.columns else F.lit(None)).cast(kind).alias(n) for n, kind in kinds.items()}
        return lines.select("value", *known.values())

    return read


def json_lines(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """Landed records as text (column ``value``)."""
    return _scans(spark, root, entity, _text_of(spark))


def sound(records: DataFrame, entity: str) -> DataFrame:
    """The records without ``problem``; one that has a problem makes the query fail with it."""
    failure = F.when(F.col("problem").isNotNull(), F.raise_error(F.concat(F.lit(f"{entity}: "), F.col("problem"))))
    return records.filter(failure.isNull()).drop("problem")


def _fetched(
    spark: SparkSession, root: str, entity: str, session_key: int | None = None, year: int | None = None
) -> DataFrame:
    return sound(_records(spark, root, entity, session_key, year), entity)


def fetch_sessions(
    spark: SparkSession, root: str, year: int | None = None, session_key: int | None = None
) -> DataFrame:
    """Sessions; a filter that is zero or None does not apply."""
    return _fetched(spark, root, "sessions", session_key, year)


def fetch_drivers(spark: SparkSession, root: str, session_key: int) -> DataFrame:
    """S2."""
    return _fetched(spark, root, "drivers", session_key)


def fetch_laps(spark: SparkSession, root: str, session_key: int) -> DataFrame:
    """S3."""
    return _fetched(spark, root, "laps", session_key)


def fetch_positions(spark: SparkSession, root: str, session_key: int) -> DataFrame:
    """S4."""
    return _fetched(spark, root, "positions", session_key)


def stamped(df: DataFrame, run_ts: datetime | str) -> DataFrame:
    """The ingestion time, one per run, as UTC clock reading."""
    return df.withColumn("ingested_at", c.wall_clock(F.lit(c.utc_text(run_ts))))


def extract_entity(spark: SparkSession, root: str, entity: str, session_key: int, run_ts: datetime | str) -> DataFrame:
    """The records of one session of one entity, stamped."""
    return stamped(_fetched(spark, root, entity, session_key), run_ts)


def extract_session(spark: SparkSession, root: str, session_key: int, run_ts: datetime | str) -> dict[str, DataFrame]:
    """All records of one session, stamped."""
    return {entity: extract_entity(spark, root, entity, session_key, run_ts) for entity in ENTITIES}


def latest_sessions(spark: SparkSession, root: str, run_ts: datetime, year: int | None = None) -> DataFrame:
    """Sessions of a year, by default the year of the run in UTC."""
    return fetch_sessions(spark, root, year=int(c.utc_text(run_ts)[:4]) if year is None else year)


def catalogue(spark: SparkSession, root: str, skip_broken: bool = False, year: int | None = None) -> DataFrame:
    """All sessions, or those of a year, times still as text; a broken one fails, or is left out for loads, which report it."""
    records = _records(spark, root, "sessions", year=year, as_text=True)
    if skip_broken:
        return records.filter(F.col("problem").isNull()).drop("problem")
    return sound(records, "sessions")


def _records(
    spark: SparkSession,
    root: str,
    entity: str,
    session_key: int | None = None,
    year: int | None = None,
    complete: bool = False,
    as_text: bool = False,
    sessions: DataFrame | None = None,
) -> DataFrame:
    """Landed records, and ``problem`` telling why one cannot be read. Times are wall-clock timestamps, or still text.

    Problems: text that is not JSON of the declared types, a time that cannot be read and, if
    records must be ``complete``, an absent field of an entity that needs all of them. A broken
    record keeps its session key if the text still shows one. Of a year come also the broken
    records that show no year, and other sessions may come with the given ``sessions``.
    """
    fields = record_schema(entity)
    schema = T.StructType([*fields, T.StructField("broken", T.StringType())])
    absent = F.array().cast("array<string>")
    if complete and entity in STRICT_ENTITIES:
        lines = _scans(spark, root, entity, _text_of(spark), session_key, year, sessions)
        options = {"columnNameOfCorruptRecord": "broken", "mode": "PERMISSIVE"}
        known = F.coalesce(F.json_object_keys("value"), absent)
        wanted = F.array(*[F.lit(n) for n, _ in record_columns(entity)])
        # A field with a value is there; only other records are read a second time, for their names.
        has_gap = reduce(Column.__or__, [F.col(n).isNull() for n in fields.names])
        # Rows of a generator, since a filter would be moved below a projection and parse the text for each of its fields.
        records = lines.select("value", F.inline(F.array(F.from_json("value", schema, options)))).withColumn(
            "absent", F.when(has_gap, F.array_except(wanted, known)).otherwise(absent)
        ).drop("value")
    else:
        def read(path: str, part: str, folders: T.StructType) -> DataFrame:
            reader = spark.read.schema(T.StructType([*schema, *folders])).option("basePath", path)
            return reader.option("columnNameOfCorruptRecord", "broken").json(path + part)

        records = _scans(spark, root, entity, read, session_key, year, sessions).withColumn("absent", absent)

    shown_key = F.regexp_extract("broken", r'"session_key"\s*:\s*(-?\d+)', 1).try_cast("bigint")
    records = records.withColumn("session_key", F.coalesce("session_key", shown_key))
    if session_key:
        records = records.filter(F.col("session_key") == F.lit(session_key))
    if year:
        records = records.filter((F.col("year") == F.lit(year)) | (F.col("year").isNull() & F.col("broken").isNotNull()))

    times = [n for n, kind in record_columns(entity) if kind == "timestamp_ntz"]
    # Each time is read once, for the check and for the result.
    records = records.withColumns({f"{n}_read": c.wall_clock(F.col(n)) for n in times})
    unread = [
        F.when(F.col(n).isNotNull() & F.col(f"{n}_read").isNull(), F.lit(f"{n} is not a time")) for n in times
    ]
    problem = F.coalesce(
        F.when(F.col("broken").isNotNull(), F.lit(UNREADABLE)),
        F.when(F.size("absent") > 0, F.concat(F.lit("missing field "), F.element_at("absent", 1))),
        *unread,
    )
    columns = [n if as_text or n not in times else F.col(f"{n}_read").alias(n) for n in fields.names]
    return records.select(*columns, problem.alias("problem"))


def checked_records(
    spark: SparkSession,
    root: str,
    entity: str,
    session_key: int | None = None,
    sessions: DataFrame | None = None,
) -> DataFrame:
    """Stamp-less raw columns of landed records, with ``problem`` telling why one cannot be loaded.

    All of them, or at least those of the given ``sessions``. A record that cannot be read has a
    problem, and one with a value beyond its limit.
    """
    records = _records(spark, root, entity, session_key, complete=True, sessions=sessions)
    renamed = records.withColumnsRenamed(RECORD_NAMES.get(entity, {}))
    names = [n for n in raw_names(entity) if n != "ingested_at"]
    return renamed.select(*names, F.coalesce("problem", c.limit_problem(entity)).alias("problem"))


def checked_entity(spark: SparkSession, root: str, entity: str, run_ts: datetime | str) -> DataFrame:
    """All landed records of an entity, stamped, in raw columns; a record that cannot be loaded makes the load fail."""
    return stamped(sound(checked_records(spark, root, entity), entity), run_ts)


def checked_bundle(spark: SparkSession, root: str, run_ts: datetime | str) -> dict[str, DataFrame]:
    """All landed records of all entities, as ``checked_entity`` gives them."""
    return {entity: checked_entity(spark, root, entity, run_ts) for entity in ENTITIES}


def land_all(raw: dict[str, DataFrame], root: str, buckets: int | None = None, compression: str = "none") -> None:
    """Land raw rows as records, sessions first; laps and positions leave out fields without a value."""

    def land_one(entity: str) -> None:
        rows = raw[entity].drop("ingested_at")
        land(rows, root, entity, entity not in STRICT_ENTITIES, buckets, compression, of_raw=True)

    land_one("sessions")
    side_by_side(raw["sessions"].sparkSession, land_one, BUCKETED)
