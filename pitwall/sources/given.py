"""The given test tables seen as raw tables.

Thirty orders make a session and twenty events belong to one. The header of a
session is its first order, found by an aggregate over all orders.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pitwall.plans.layers import RawTables
from pitwall.schemas import RACE

_schemas: dict[str, StructType] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def raw_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.min(F.struct("o_orderkey", "o_orderpriority", "o_orderdate", "o_custkey")).alias("o")
    headers = _table(spark, sf_dir, "orders").groupBy(F.expr("o_orderkey div 30").alias("session_key")).agg(first)
    return headers.selectExpr(
        "session_key",
        "o.o_orderpriority as session_name",
        """case o.o_orderpriority when '1-URGENT' then 'Race' when '2-HIGH' then 'Qualifying'
           else 'Practice' end as session_type""",
        "o.o_orderdate as date_start",
        """case session_key % 25 when 7 then null when 11 then o.o_orderdate - interval 1 hour
           else o.o_orderdate + interval 2 hours end as date_end""",
        "'+00:00' as gmt_offset",
        "concat('LOC_', o.o_custkey % 40) as location",
        "concat('NATION_', o.o_custkey % 25) as country_name",
        "concat('CIRCUIT_', o.o_custkey % 24) as circuit_short_name",
        "year(o.o_orderdate) as year",
        "timestampadd(microsecond, o.o_orderkey, o.o_orderdate) as ingested_at",
    )


def reloaded_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions of which the races were loaded a second time, a day later."""
    again = sessions.filter(F.col("session_type") == RACE)
    return sessions.unionByName(again.withColumn("ingested_at", F.expr("ingested_at + interval 1 day")))


def raw_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(
        "cast(case when o_orderkey % 97 = 5 then null else o_custkey % 20 + 1 end as int) as driver_number",
        "o_orderkey div 30 as session_key",
        "concat('D. DRV_', o_custkey % 20 + 1) as broadcast_name",
        "concat('DRV_', o_custkey % 20 + 1) as full_name",
        "concat('D', o_custkey % 20 + 1) as name_acronym",
        "concat('TEAM_', o_orderkey % 10) as team_name",
        "concat('FF00', 10 + o_orderkey % 10) as team_colour",
        "concat('http://img.example/', o_custkey % 20 + 1) as headshot_url",
        "concat('C', o_custkey % 20) as country_code",
        "timestampadd(microsecond, o_orderkey, o_orderdate) as ingested_at",
    )


def raw_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey div 30 as session_key",
        "cast(l_suppkey % 20 + 1 as int) as driver_number",
        "l_linenumber as lap_number",
        """cast(case when l_quantity = 13 then null
           else floor(l_extendedprice / 300.0d) - 5 end as double) as lap_duration""",
        "l_quantity as segment_1_duration",
        "cast(case when l_linenumber = 5 then null else round(l_discount * 100) end as double) as segment_2_duration",
        "cast(round(l_tax * 100) as double) as segment_3_duration",
        """case when l_returnflag = 'R' then true
           when l_returnflag = 'A' and l_linestatus = 'O' then null else false end as is_pit_out_lap""",
        "l_shipdate as date_start",
        "l_shipdate + interval 1 day as ingested_at",
    )


def raw_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").selectExpr(
        "event_id div 20 as session_key",
        "cast(user_id % 12 + 1 as int) as driver_number",
        "case when event_type = 'error' and event_id % 7 = 0 then null else ts end as date",
        """case when event_type = 'signup' and event_id % 5 = 0 then null
           else cast(floor(value) as int) % 23 end as position""",
        "ts + interval 1 hour as ingested_at",
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(
        sessions=lambda: raw_sessions(spark, sf_dir),
        drivers=lambda: raw_drivers(spark, sf_dir),
        laps=lambda: raw_laps(spark, sf_dir),
        positions=lambda: raw_positions(spark, sf_dir),
    )
