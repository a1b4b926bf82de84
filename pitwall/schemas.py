"""Table layouts, limits, record contracts and check lists (S*, K*, D*).

These must equal the data contract for results to be right, so they are stated
here as plain text and nowhere else.
"""

from pyspark.sql import types as T

# Raw tables: (column, Spark type, limit). A limit is the longest text for
# strings and the number of digits for integers; None means no limit.
RAW_COLUMNS = {
    "sessions": (
        ("session_key", "bigint", None),
        ("session_name", "string", 100),
        ("session_type", "string", 50),
        ("date_start", "timestamp_ntz", None),
        ("date_end", "timestamp_ntz", None),
        ("gmt_offset", "string", 10),
        ("location", "string", 100),
        ("country_name", "string", 100),
        ("circuit_short_name", "string", 50),
        ("year", "int", 4),
        ("ingested_at", "timestamp_ntz", None),
    ),
    "drivers": (
        ("driver_number", "int", 3),
        ("session_key", "bigint", None),
        ("broadcast_name", "string", 50),
        ("full_name", "string", 100),
        ("name_acronym", "string", 3),
        ("team_name", "string", 100),
        ("team_colour", "string", 6),
        ("headshot_url", "string", 500),
        ("country_code", "string", 3),
        ("ingested_at", "timestamp_ntz", None),
    ),
    "laps": (
        ("session_key", "bigint", None),
        ("driver_number", "int", 3),
        ("lap_number", "int", 3),
        ("lap_duration", "double", None),
        ("segment_1_duration", "double", None),
        ("segment_2_duration", "double", None),
        ("segment_3_duration", "double", None),
        ("is_pit_out_lap", "boolean", None),
        ("date_start", "timestamp_ntz", None),
        ("ingested_at", "timestamp_ntz", None),
    ),
    "positions": (
        ("session_key", "bigint", None),
        ("driver_number", "int", 3),
        ("date", "timestamp_ntz", None),
        ("position", "int", 2),
        ("ingested_at", "timestamp_ntz", None),
    ),
}

_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
}

# Load order of a bundle.
ENTITIES = ("sessions", "drivers", "laps", "positions")

# Names that differ between a landed record and its raw table.
RECORD_NAMES = {
    "laps": {
        "duration_sector_1": "segment_1_duration",
        "duration_sector_2": "segment_2_duration",
        "duration_sector_3": "segment_3_duration",
    },
}

# Entities whose records must carry every loaded field; the others read an
# absent field as NULL.
STRICT_ENTITIES = ("sessions", "drivers")

# Fields every record of an entity must carry (presence, not non-null).
REQUIRED_FIELDS = {
    "sessions": ("session_key", "session_name", "date_start", "year"),
    "drivers": ("driver_number", "full_name", "team_name"),
    "laps": ("session_key", "driver_number", "lap_number", "lap_duration"),
    "positions": ("session_key", "driver_number", "position"),
}

NOT_NULL_RAW = {
    "sessions": ("session_key", "year", "ingested_at"),
    "drivers": ("driver_number", "session_key", "ingested_at"),
    "laps": ("session_key", "driver_number", "lap_number", "ingested_at"),
    "positions": ("session_key", "driver_number", "position", "ingested_at"),
}

NOT_NULL_STAGING = {
    "stg_sessions": ("session_key",),
    "stg_drivers": ("driver_number",),
    "stg_laps": ("session_key", "lap_duration"),
    "stg_positions": ("session_key", "position"),
}

# Validity rules.
LONGEST_LAP_SECONDS = 300
FIRST_POSITION, LAST_POSITION = 1, 20
RACE = "Race"


def raw_names(entity: str) -> list[str]:
    """Column names of a raw table, in order."""
    return [name for name, _, _ in RAW_COLUMNS[entity]]


def _struct(columns: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns])


def raw_schema(entity: str) -> T.StructType:
    """Schema of a raw table; every column is nullable."""
    return _struct([(name, kind) for name, kind, _ in RAW_COLUMNS[entity]])


def record_columns(entity: str) -> list[tuple[str, str]]:
    """(field, type) of a landed record: the raw columns under their record names, unstamped."""
    record_name = {raw: rec for rec, raw in RECORD_NAMES.get(entity, {}).items()}
    return [(record_name.get(n, n), t) for n, t, _ in RAW_COLUMNS[entity] if n != "ingested_at"]


def record_schema(entity: str) -> T.StructType:
    """Schema to parse landed JSON with: times stay text so that their wall clock survives."""
    fields = [(n, "string" if t == "timestamp_ntz" else t) for n, t in record_columns(entity)]
    return _struct(fields)


def table_ddl(entity: str) -> str:
    """Column list for CREATE TABLE, with text limits enforced by the table itself."""
    return ", ".join(
        f"{n} {f'varchar({limit})' if t == 'string' else t}" for n, t, limit in RAW_COLUMNS[entity]
    )
