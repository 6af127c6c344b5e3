"""Rename / cast / flatten projections described as data.

A spec is an ordered list of :class:`Field` (source path, output name, target
type).  ``project`` turns it into a single ``select`` — pure column
expressions inside whole-stage codegen, no shuffle, and the scan only reads the
referenced columns.  Casts are ``try_cast`` so a malformed value becomes NULL.
Nested fields are addressed with dots (``name.givenName``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.errors import ConfigurationError


@dataclass(frozen=True)
class Field:
    source: str
    name: str | None = None
    dtype: str | None = None

    def column(self):
        c = F.col(self.source)
        if self.dtype:
            c = c.try_cast(self.dtype)
        return c.alias(self.name or self.source.split(".")[-1])


def project(df: DataFrame, spec: Sequence[Field]) -> DataFrame:
    """Apply a projection spec; output columns come in spec order."""
    return df.select(*[f.column() for f in spec])


def output_columns(spec: Sequence[Field]) -> list[str]:
    return [f.name or f.source.split(".")[-1] for f in spec]


# The refined entity projections (source -> name, type).
_RESULTS_SPEC = (
    Field("driverId", "driver_id"),
    Field("constructorId", "constructor_id"),
    Field("season"),
    Field("round"),
    Field("raceName", "race_name"),
    Field("date", "race_date", "date"),
    Field("grid"),
    Field("laps"),
    Field("number"),
    Field("points"),
    Field("position"),
    Field("positionText", "position_text"),
    Field("status"),
    Field("url"),
)
ENTITY_SPECS: dict[str, tuple[Field, ...]] = {
    "circuits": (
        Field("circuitId", "circuit_id"),
        Field("circuitName", "circuit_name"),
        Field("lat", "latitude", "double"),
        Field("long", "longitude", "double"),
        Field("locality"),
        Field("country"),
        Field("url"),
    ),
    "constructors": (
        Field("constructorId", "constructor_id"),
        Field("name"),
        Field("nationality"),
        Field("url"),
    ),
    "drivers": (
        Field("driverId", "driver_id"),
        Field("name.givenName", "firstname"),
        Field("name.familyName", "surname"),
        Field("dateOfBirth", "date_of_birth", "date"),
        Field("nationality"),
        Field("url"),
    ),
    "races": (
        Field("season", "season", "int"),
        Field("round", "round", "int"),
        Field("circuitId", "circuit_id"),
        Field("raceName", "race_name"),
        Field("date", "race_date", "date"),
        Field("url"),
    ),
    "results": _RESULTS_SPEC,
    "sprints": _RESULTS_SPEC,
}


def _spec_transform(spec: Sequence[Field]) -> Callable[[DataFrame], DataFrame]:
    def transform(df: DataFrame) -> DataFrame:
        return project(df, spec)

    return transform


# name -> DataFrame -> DataFrame (the transformation registry).
TRANSFORMS: dict[str, Callable[[DataFrame], DataFrame]] = {
    f"transform_{entity}": _spec_transform(spec) for entity, spec in ENTITY_SPECS.items()
}


def register_transform(name: str, fn: Callable[[DataFrame], DataFrame] | Sequence[Field]) -> None:
    """Add a transform (a function, or a projection spec)."""
    TRANSFORMS[name] = fn if callable(fn) else _spec_transform(fn)


def get_transform(name: str) -> Callable[[DataFrame], DataFrame]:
    try:
        return TRANSFORMS[name]
    except KeyError:
        raise ConfigurationError(f"Transformation '{name}' not registered.") from None


# Refined-output checks per entity (expected columns, not-null
# keys, non-negative measures).
SILVER_NOT_NULL = {
    "circuits": ["circuit_id"],
    "constructors": ["constructor_id"],
    "drivers": ["driver_id"],
    "races": ["circuit_id"],
    "results": ["driver_id", "constructor_id"],
    "sprints": ["driver_id", "constructor_id"],
}
SILVER_NON_NEGATIVE = {
    "results": ["grid", "points"],
    "sprints": ["grid", "points"],
}
