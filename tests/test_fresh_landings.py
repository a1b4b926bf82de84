"""Queries on landed records, each with a landing of its own over rows made here."""

import glob
import os
import re
import threading
from collections import defaultdict
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import DataFrameWriter

from __spark_entry__ import oracle_sql, queries
from pitwall import registry
from pitwall.operators import lookup

# Queries that failed when drivers, laps and positions were landed side by side (the finding).
WRITERS = [
    "backfill_replayed",  # F2
    "backfill_year",  # F3
    "latest_completed_race",  # F4
    "load_broken",  # F5
    "load_ledger",  # F6
    "load_drivers_shape",  # F7
    "load_positions_shape",  # F8
    "load_sessions_shape",  # F9
    "src_bundle_drivers",  # F10
    "src_bundle_positions",  # F11
    "src_catalogue",  # F12
]
# Queries that gave no rows to compare with their SQL for that.
COMPARED = [
    "src_bundle_sessions",  # F16
    "src_bundle_drivers",  # F17
    "src_bundle_laps",  # F18
    "src_bundle_positions",  # F19
    "src_latest_sessions",  # F20
    "src_catalogue",  # F21
    "src_empty_selection",  # F22
    "hist_selection",  # F23
    "catalogue_summary",  # F24
    "latest_completed_race",  # F25
]
# Queries that shuffled and wrote too much, as they may be the one that pays for the landing.
COMPRESSED = [
    "hist_summary",  # F29
    "src_bundle_laps",  # F30
    "src_bundle_sessions",  # F31
    "src_empty_selection",  # F32
]
# Of these, the ones whose landing shuffled times as text.
TIMED = [
    "hist_summary",  # F29
    "src_bundle_laps",  # F30
    "src_bundle_sessions",  # F31
    "src_empty_selection",  # F32
]
# Round 4: queries that failed by driver memory, as tables of sessions and drivers were broadcast whatever their size.
SHUFFLED = [
    "load_ledger",  # F2
    "load_broken",  # F3
    "backfill_lap_times",  # F1
]


@pytest.fixture(scope="module")
def given(spark, tmp_path_factory):
    """Six sessions: two races of 1998, one of 1999, two practices of 1998 and one qualifying of 1997."""
    root, kinds = str(tmp_path_factory.mktemp("given")), ["3-MEDIUM", "1-URGENT", "2-HIGH", "1-URGENT", "5-LOW", "1-URGENT"]
    starts = [datetime(y, 3, 1 + i) for i, y in enumerate((1998, 1998, 1997, 1998, 1998, 1999))]
    orders = [(30 * s + i, 7 * s + i, starts[s] + timedelta(hours=i), kinds[s]) for s in range(6) for i in range(0, 30, 3)]
    laps = [
        (key, key % 13 + lap, lap, 10.0 + lap, 27000.0 + 300.0 * lap, 0.05, 0.02, "NAR"[lap % 3], "OF"[lap % 2], start)
        for key, _, start, _ in orders for lap in range(1, 7)
    ]
    events = [
        (n, starts[n // 20] + timedelta(minutes=n), 5 * n, ("click", "error", "signup")[n % 3], 1.5 * n) for n in range(120)
    ]
    for name, rows, schema in (
        ("orders", orders, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string"),
        ("lineitem", laps, "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
         "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        ("events", events, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.fixture
def writes(monkeypatch):
    """The threads that wrote to each folder; nothing is landed yet."""
    monkeypatch.setattr(registry, "_landings", {})
    seen = defaultdict(set)

    def watched(write):
        return lambda self, path, *a, **k: seen[path].add(threading.get_ident()) or write(self, path, *a, **k)

    monkeypatch.setattr(DataFrameWriter, "parquet", watched(DataFrameWriter.parquet))
    monkeypatch.setattr(DataFrameWriter, "json", watched(DataFrameWriter.json))
    return seen


def result_and_expected(spark, given, name):
    df, duck = queries()[name](spark, given), duckdb.connect()
    for table in ("orders", "lineitem", "events"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{given}/{table}.parquet/*.parquet'")
    columns = ", ".join(sorted(df.columns))
    expected = duck.execute(f"SELECT {columns} FROM ({oracle_sql()[name]})").fetchall()
    return sorted((tuple(r) for r in df.selectExpr(*sorted(df.columns)).collect()), key=repr), sorted(expected, key=repr)


@pytest.mark.parametrize("name", WRITERS)
def test_no_two_writers_share_a_folder(spark, given, writes, name):
    """Who ends first removes the work files of its folder, and with them those of the others."""
    found, expected = result_and_expected(spark, given, name)
    assert any("/keyed/" in path for path in writes)
    assert {path for path, threads in writes.items() if len(threads) > 1} == set()
    assert found == expected and found


@pytest.mark.parametrize("name", COMPARED)
def test_same_rows_from_a_landing_of_its_own(spark, given, writes, name):
    found, expected = result_and_expected(spark, given, name)
    assert all(len(threads) == 1 for threads in writes.values())
    assert found == expected and (found or name == "src_empty_selection")


@pytest.mark.parametrize("name", COMPRESSED)
def test_the_landing_it_pays_for_is_compressed(spark, given, writes, name):
    found, expected = result_and_expected(spark, given, name)
    assert found == expected
    landed = [file for path in writes if "/keyed/" in path for file in glob.glob(f"{path}/**/part-*", recursive=True)]
    assert landed and all(os.path.basename(file).endswith(".json.gz") for file in landed)


@pytest.mark.parametrize("name", TIMED)
def test_the_landing_it_pays_for_shuffles_times_and_not_their_text(spark, given, writes, name, monkeypatch):
    plans, write = {}, DataFrameWriter.json

    def watched(self, path, *a, **k):
        plans[os.path.basename(path)] = self._df._jdf.queryExecution().optimizedPlan().toString()
        return write(self, path, *a, **k)

    monkeypatch.setattr(DataFrameWriter, "json", watched)
    found, expected = result_and_expected(spark, given, name)
    assert found == expected
    for entity in ("sessions", "laps", "positions"):
        after, before = plans[entity].split("RebalancePartitions")
        assert "date_format" in after and "date_format" not in before and "ingested_at" not in before.split("Relation")[0]


def broadcast_parts(plan: str) -> list[str]:
    """What stands below each broadcast of a plan."""
    lines, found = plan.splitlines(), []
    depth = [re.search(r"\w", line).start() if re.search(r"\w", line) else 0 for line in lines]
    for n, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((m for m in range(n + 1, len(lines)) if depth[m] <= depth[n]), len(lines))
            found.append("\n".join(lines[n:end]))
    return found


@pytest.mark.parametrize("name", SHUFFLED)
def test_many_sessions_and_drivers_are_not_broadcast(spark, given, writes, name, monkeypatch):
    """Six sessions are many where three are allowed. Spark, which sees some hundred bytes, would broadcast them."""
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 3, raising=False)
    plans = {}

    def watched(write):
        def watch(self, path, *a, **k):
            plans[path] = self._df._jdf.queryExecution().executedPlan().toString()
            return write(self, path, *a, **k)

        return watch

    monkeypatch.setattr(DataFrameWriter, "parquet", watched(DataFrameWriter.parquet))
    monkeypatch.setattr(DataFrameWriter, "json", watched(DataFrameWriter.json))
    found, expected = result_and_expected(spark, given, name)
    assert found == expected and found
    assert any("ledger/" in path for path in plans)
    for path, plan in plans.items():
        if "/marts/" in path:  # the stored sessions, the kept drivers
            assert not [p for p in broadcast_parts(plan) if "/raw/sessions" in p or "InMemoryTableScan" in p]
        else:
            assert "BroadcastHashJoin [session_key" not in plan
