"""Named schemas for schema-on-read scans (no inference pass at read time).

Unknown names raise :class:`ConfigurationError` at lookup, before any scan.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

from stratum.errors import ConfigurationError

# The raw entity schemas (column names and types, in file order).
_RESULT_LIKE = (
    "constructorId string, date string, driverId string, grid bigint, laps bigint, "
    "number bigint, points double, position bigint, positionText string, raceName string, "
    "round bigint, season bigint, status string, url string"
)
SCHEMA_DDL = {
    "circuits_schema": (
        "circuitId string, url string, circuitName string, lat string, long string, "
        "locality string, country string"
    ),
    "constructors_schema": "constructorId string, name string, nationality string, url string",
    "drivers_schema": (
        "dateOfBirth string, driverId string, "
        "name struct<familyName: string, givenName: string>, nationality string, url string"
    ),
    "races_schema": (
        "season string, round string, url string, raceName string, date string, circuitId string"
    ),
    "results_schema": _RESULT_LIKE,
    "sprints_schema": _RESULT_LIKE,
}

_EXTRA: dict[str, str] = {}


def register_schema(name: str, ddl: str | StructType) -> None:
    """Add a schema to the registry (DDL string or StructType)."""
    _EXTRA[name] = ddl if isinstance(ddl, str) else ddl.simpleString()[7:-1].replace(":", " ")


def get_schema(name: str) -> StructType:
    ddl = _EXTRA.get(name) or SCHEMA_DDL.get(name)
    if ddl is None:
        raise ConfigurationError(f"Unknown schema '{name}'")
    return StructType.fromDDL(ddl)


def find_schema(name: str) -> StructType | None:
    """Lookup that returns None for an unknown name."""
    try:
        return get_schema(name)
    except ConfigurationError:
        return None


def schema_names() -> list[str]:
    return sorted(set(SCHEMA_DDL) | set(_EXTRA))
