"""Column naming, typing and discovery."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from tripflow.constants import CANONICAL_TYPES, COLUMN_ALIASES, KEY_FIELD_WORDS


def column(name: str):
    """A column by its exact name, whatever characters the name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def standardize_columns(trips: DataFrame) -> DataFrame:
    """Give known source columns their canonical name.

    A column keeps its own name when the canonical one is already taken, so a
    total amount stands in for the fare only where there is no fare.
    """
    present = set(trips.columns)
    names = {old: new for old, new in COLUMN_ALIASES.items() if new not in present}
    return trips.select([column(c).alias(names.get(c, c)) for c in trips.columns])


def conform_types(trips: DataFrame) -> DataFrame:
    """Cast canonical columns to their canonical type; unreadable text is NULL.

    Columns that already have the type are left alone, so that filters on them
    still reach the Parquet scan. A trip id is cast only between whole-number types: ids
    of any other type, text above all, stay as they are.
    """

    def conformed(field: T.StructField):
        wanted = CANONICAL_TYPES.get(field.name)
        value = column(field.name)
        if field.name == "trip_id" and not isinstance(field.dataType, T.IntegralType):
            return value
        if wanted is None or field.dataType.simpleString() == wanted:
            return value
        return value.try_cast(wanted).alias(field.name)

    return trips.select([conformed(f) for f in trips.schema.fields])


def key_fields(columns: Sequence[str]) -> list[str]:
    """First column whose name holds the words of each key-field rule."""
    found = []
    for words in KEY_FIELD_WORDS:
        hits = [c for c in columns if all(w in c.lower() for w in words)]
        found.extend(hits[:1])
    return list(dict.fromkeys(found))


def available(table: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Project to those wanted columns the table has."""
    return table.select([column(c) for c in wanted if c in table.columns])
