"""From trip files to curated trips."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tripflow.constants import CANONICAL_TYPES, LIMITS, Limits
from tripflow.operators.cleaning import clean_trips, needed_for
from tripflow.operators.columns import conform_types, standardize_columns
from tripflow.operators.derive import derive_trips
from tripflow.operators.outliers import filter_outliers
from tripflow.sources.trips import scan_trips


def standard_trips(raw: DataFrame) -> DataFrame:
    """Canonical names and types."""
    return raw.transform(standardize_columns).transform(conform_types)


# Canonical columns only: what any analysis can ask for.
ANALYSIS_COLUMNS = tuple(CANONICAL_TYPES)


def curate_trips(
    raw: DataFrame,
    limits: Limits = LIMITS,
    null_duration: str = "drop",
    *,
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """All preprocessing steps, as one lazy plan with a single shuffle.

    ``columns`` names the trip columns that will be used, next to the times, the
    distance and the fare; columns that are not needed are left out before the
    shuffle. It cannot change any value of the named columns.
    """
    trips = standard_trips(raw)
    if columns is not None:
        trips = needed_for(trips, columns)
    return plausible_trips(clean_trips(trips), limits, null_duration)


def plausible_trips(cleaned: DataFrame, limits: Limits = LIMITS, null_duration: str = "drop") -> DataFrame:
    """The steps after cleaning: derived columns and range rules."""
    return cleaned.transform(derive_trips, limits, null_duration).transform(filter_outliers, limits)


def preprocess(
    spark: SparkSession, path: str, limits: Limits = LIMITS, null_duration: str = "drop"
) -> DataFrame:
    """Scan a trip directory and curate it."""
    return curate_trips(scan_trips(spark, path), limits, null_duration)
