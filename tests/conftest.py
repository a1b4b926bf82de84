import os
import sys
from datetime import datetime

import pytest

_TESTS = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(_TESTS), _TESTS]

from pitwall_helpers import at  # noqa: E402

from pitwall.plans.layers import Layers, RawTables  # noqa: E402
from pitwall.schemas import raw_names, raw_schema  # noqa: E402
from pitwall.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("pitwall-tests", "4", partitions=4)
    session.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def raw_frame(spark):
    """Build a raw table from rows of some of its columns; the others are NULL."""

    def build(entity: str, columns: list[str], rows: list[tuple]):
        names = raw_names(entity)
        filled = [tuple(dict(zip(columns, row)).get(n) for n in names) for row in rows]
        return spark.createDataFrame(filled, raw_schema(entity))

    return build


@pytest.fixture(scope="session")
def golden(raw_frame):
    """The golden mini-fixture: every rule and bound of the layers, in a few rows."""
    sessions = raw_frame(
        "sessions",
        ["session_key", "session_type", "date_start", "date_end"],
        [
            (1, "Race", at("03-02 15:00"), at("03-02 17:00")),
            (2, "Qualifying", at("03-01 16:00"), at("03-01 17:00")),
            (3, "Race", at("03-09 17:00"), None),
            (4, "Race", at("03-16 17:00"), at("03-16 16:00")),
            (5, "Race", at("03-24 04:00"), at("03-24 04:00")),
        ],
    )
    drivers = raw_frame(
        "drivers",
        ["driver_number", "session_key", "full_name", "team_name", "ingested_at"],
        [
            (1, 1, "A One", "T1", at("03-03 10:00")),
            (1, 1, "A. One", "T1", at("03-03 11:00")),
            (2, 1, "B Two", "T2", at("03-03 10:00")),
            (1, 2, "A One", "T9", at("03-03 12:00")),
            (None, 1, "X", "T1", at("03-03 10:00")),
            (2, 5, "B Two", "T3", None),
        ],
    )
    laps = raw_frame(
        "laps",
        [
            "session_key", "driver_number", "lap_number", "lap_duration",
            "segment_1_duration", "segment_2_duration", "segment_3_duration", "is_pit_out_lap",
        ],
        [
            (1, 1, 1, 90.0, 30.0, 30.0, 30.0, False),
            (1, 1, 2, 89.0, 30.0, None, 29.0, False),
            (1, 2, 1, 91.0, 30.0, 30.0, 31.0, False),
            (1, 2, 2, 89.0, 29.0, 30.0, 30.0, False),
            (1, 2, 3, None, None, None, None, False),
            (1, 2, 4, 0.0, 0.0, 0.0, 0.0, False),
            (1, 2, 5, 300.0, 100.0, 100.0, 100.0, False),
            (1, 2, 6, 300.5, 100.0, 100.0, 100.5, False),
            (1, 1, 3, 80.0, 26.0, 27.0, 27.0, True),
            (1, 1, 4, 70.0, 23.0, 23.0, 24.0, None),
            (3, 1, 1, 85.0, 28.0, 28.0, 29.0, False),
            (1, 7, 1, 88.0, None, None, None, False),
        ],
    )
    positions = raw_frame(
        "positions",
        ["session_key", "driver_number", "date", "position"],
        [
            (1, 1, at("03-02 15:10"), 3),
            (1, 1, at("03-02 16:50"), 1),
            (1, 2, at("03-02 15:10"), 2),
            (1, 2, None, 5),
            (1, 7, at("03-02 15:10"), 20),
            (1, 7, at("03-02 15:20"), 0),
            (1, 7, at("03-02 15:30"), 21),
            (1, 7, at("03-02 15:40"), None),
            (2, 1, at("03-01 16:30"), 1),
            (5, 1, at("03-24 04:00"), 2),
            (5, 2, at("03-24 04:00"), 1),
        ],
    )
    return Layers(
        RawTables(lambda: sessions, lambda: drivers, lambda: laps, lambda: positions), datetime(2025, 1, 1)
    )


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
