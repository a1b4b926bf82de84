"""All layers over one set of raw tables, composed lazily (lineage raw -> staging -> marts)."""

from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame

from pitwall.plans import marts, staging


class RawTables:
    """The four raw tables; each is opened when first asked for."""

    def __init__(
        self,
        sessions: Callable[[], DataFrame],
        drivers: Callable[[], DataFrame],
        laps: Callable[[], DataFrame],
        positions: Callable[[], DataFrame],
    ):
        self._open = {"sessions": sessions, "drivers": drivers, "laps": laps, "positions": positions}

    @cached_property
    def sessions(self) -> DataFrame:
        return self._open["sessions"]()

    @cached_property
    def drivers(self) -> DataFrame:
        return self._open["drivers"]()

    @cached_property
    def laps(self) -> DataFrame:
        return self._open["laps"]()

    @cached_property
    def positions(self) -> DataFrame:
        return self._open["positions"]()


class Layers:
    """Staging and marts of ``raw``; a layer is planned when first asked for."""

    def __init__(self, raw: RawTables, run_ts: datetime | str | None = None):
        self.raw = raw
        self.run_ts = run_ts

    @cached_property
    def stg_sessions(self) -> DataFrame:
        return staging.stg_sessions(self.raw.sessions)

    @cached_property
    def stg_drivers(self) -> DataFrame:
        return staging.stg_drivers(self.raw.drivers)

    @cached_property
    def stg_laps(self) -> DataFrame:
        return staging.stg_laps(self.raw.laps)

    @cached_property
    def stg_positions(self) -> DataFrame:
        return staging.stg_positions(self.raw.positions)

    @cached_property
    def dim_drivers(self) -> DataFrame:
        return marts.dim_drivers(staging.known_drivers(self.raw.drivers), self.run_ts)

    @cached_property
    def fct_lap_times(self) -> DataFrame:
        return marts.fct_lap_times(self.stg_laps, self.stg_sessions, self.stg_drivers, self.run_ts)

    @cached_property
    def fct_race_results(self) -> DataFrame:
        return marts.fct_race_results(self.stg_sessions, self.stg_positions, self.stg_drivers, run_ts=self.run_ts)
