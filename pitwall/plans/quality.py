"""The declared data checks over the layers (D1-D4), 22 in all."""

from pyspark.sql import DataFrame

from pitwall.operators.checks import all_reports, not_null_report, unique_report
from pitwall.plans.layers import Layers
from pitwall.schemas import NOT_NULL_RAW, NOT_NULL_STAGING


def raw_not_null(layers: Layers) -> DataFrame:
    """D1."""
    return all_reports(
        [not_null_report(getattr(layers.raw, table), table, list(columns)) for table, columns in NOT_NULL_RAW.items()]
    )


def raw_unique(layers: Layers) -> DataFrame:
    """D2."""
    return unique_report(layers.raw.sessions, "sessions", "session_key")


def staging_not_null(layers: Layers) -> DataFrame:
    """D3."""
    return all_reports(
        [not_null_report(getattr(layers, table), table, list(columns)) for table, columns in NOT_NULL_STAGING.items()]
    )


def staging_unique(layers: Layers) -> DataFrame:
    """D4."""
    return unique_report(layers.stg_sessions, "stg_sessions", "session_key")


def data_checks(layers: Layers) -> DataFrame:
    """All checks; a check passes with zero failures."""
    return all_reports([raw_not_null(layers), raw_unique(layers), staging_not_null(layers), staging_unique(layers)])
