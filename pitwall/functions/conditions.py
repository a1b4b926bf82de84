"""Column expressions behind the cleaning rules.

Conditions are plain conjunctions, never CASE, so that Spark can push them into
the Parquet scan. A row on which one is NULL is dropped by ``filter``.
"""

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitwall.schemas import RAW_COLUMNS


def between(value: Column, low, high) -> Column:
    """both bounds kept."""
    return (value >= low) & (value <= high)


def above_up_to(value: Column, low, high) -> Column:
    """lower bound dropped, upper bound kept; NaN counts as too high."""
    return (value > low) & (value <= high)


def sum_of_known(*values: Column) -> Column:
    """sum with NULL as zero, so all-NULL gives zero."""
    total = F.lit(0.0)
    for value in values:
        total = total + F.coalesce(value, F.lit(0.0))
    return total


def is_false(flag: Column) -> Column:
    """true only for FALSE; NULL stays NULL and is dropped by a filter."""
    return flag == F.lit(False)


def equals_or_false(left: Column, right: Column) -> Column:
    """equality that is never NULL."""
    return F.coalesce(left == right, F.lit(False))


def utc_text(moment: datetime | str) -> str:
    """A moment as text; a datetime without zone is taken as UTC, text stays as it is."""
    if isinstance(moment, str):
        return moment
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc).isoformat()


def run_stamp(run_ts: datetime | str | None) -> Column:
    """the injected run time, or the current time."""
    return F.current_timestamp() if run_ts is None else F.lit(utc_text(run_ts)).cast("timestamp")


def wall_clock(text: Column) -> Column:
    """ISO text to a timestamp without zone: an offset is dropped, the clock reading stays."""
    return text.try_cast("timestamp_ntz")


def instant(text: Column) -> Column:
    """ISO text to a point in time; ``Z`` and offsets are honoured."""
    return text.try_cast("timestamp")


def newest_first(value: Column) -> Column:
    """Descending with NULL as the highest value."""
    return value.desc_nulls_first()


def smallest_first(value: Column) -> Column:
    """Ascending with NULL as the highest value."""
    return value.asc_nulls_last()


def same_or_both_null(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def limit_problem(entity: str) -> Column:
    """Text naming the first column beyond its declared limit, else NULL."""
    checks = []
    for name, kind, limit in RAW_COLUMNS[entity]:
        if limit is None:
            continue
        beyond = (
            F.char_length(name) > limit if kind == "string"
            else (F.col(name) >= 10**limit) | (F.col(name) <= -(10**limit))
        )
        checks.append(F.when(beyond, F.lit(f"{name} exceeds its limit of {limit}")))
    return F.coalesce(*checks, F.lit(None).cast("string"))
