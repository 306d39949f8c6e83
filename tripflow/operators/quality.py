"""Profiles and the quality funnel, each as one job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tripflow.constants import (
    CURATED_PREVIEW_COLUMNS,
    ENRICHED_PREVIEW_COLUMNS,
    LIMITS,
    Limits,
)
from tripflow.functions.rules import is_floating, is_missing
from tripflow.operators.cleaning import dedupe_keys, needed_for, survivor_order
from tripflow.operators.columns import available, column, key_fields
from tripflow.operators.derive import add_time_columns, duration_rule
from tripflow.operators.outliers import outlier_rules


def dataset_overview(table: DataFrame) -> DataFrame:
    """One row per column: position, name, type, with record and column totals."""
    fields = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
            )
            for i, f in enumerate(table.schema.fields, start=1)
        ]
    )
    totals = table.agg(F.count(F.lit(1)).alias("total_records"))
    return totals.select(
        F.inline(fields), "total_records", F.lit(len(table.columns)).alias("total_columns")
    )


def preview(table: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows under a total order, so that a preview is repeatable."""
    order = [column(c).asc_nulls_first() for c in table.columns]
    return table.orderBy(*order).limit(n)


def curated_preview(trips: DataFrame, n: int = 10) -> DataFrame:
    """A few curated trips, in the columns that describe a trip."""
    return preview(available(trips, CURATED_PREVIEW_COLUMNS), n)


def enriched_preview(trips: DataFrame, n: int = 10) -> DataFrame:
    """A few enriched trips, with their zone names."""
    return preview(available(trips, ENRICHED_PREVIEW_COLUMNS), n)


def null_profile(table: DataFrame) -> DataFrame:
    """Missing values (NULL or NaN) per column."""
    counts = table.agg(
        *[
            F.count_if(is_missing(column(f.name), f.dataType)).alias(f.name)
            for f in table.schema.fields
        ]
    )
    pairs = [
        F.struct(F.lit(c).alias("column_name"), column(c).alias("missing")) for c in table.columns
    ]
    return counts.select(F.inline(F.array(*pairs)))


def _key_rules(trips: DataFrame) -> dict[str, Column]:
    """Name -> true for rows that break a null or NaN rule, in rule order."""
    types = {f.name: f.dataType for f in trips.schema.fields}
    rules = {}
    for key in key_fields(trips.columns):
        rules[f"not_null {key}"] = column(key).isNull()
        if is_floating(types[key]):
            rules[f"not_nan {key}"] = F.isnan(column(key))
    return rules


def quality_groups(trips: DataFrame) -> DataFrame:
    """Unique rows and what fell away before them: all that the funnel and the curation need.

    Rows are grouped by the duplicate key, and rows that fail a key rule by the first
    rule they fail. Both are reduced before the shuffle, so neither a hot key nor
    a rule that a third of all rows break is a problem. Rows with ``__failed`` 0 are
    the cleaned trips; ``__rows`` counts the rows of a group.
    """
    key_rules = _key_rules(trips)
    first_failed = F.lit(0)
    for i, broken in reversed(list(enumerate(key_rules.values(), start=1))):
        first_failed = F.when(broken, i).otherwise(first_failed)
    flagged = trips.withColumn("__failed", first_failed)
    ok = F.col("__failed") == 0
    broken_flags = [
        F.count_if(broken).alias(f"__broken_{i}") for i, broken in enumerate(key_rules.values())
    ]

    keys = dedupe_keys(trips.columns)
    rest = survivor_order(trips.columns, keys)
    if keys:
        lowest = F.min(F.when(ok, F.struct(F.lit(1), *[column(c) for c in rest]))).alias("__low")
        grouped = flagged.groupBy(
            "__failed", *[F.when(ok, column(c)).alias(c) for c in keys]
        ).agg(F.count(F.lit(1)).alias("__rows"), lowest, *broken_flags)
        return grouped.select(
            "__failed",
            "__rows",
            *[f"__broken_{i}" for i in range(len(key_rules))],
            *keys,
            *[F.col("__low").getField(c).alias(c) for c in rest],
        )
    return flagged.withColumns(
        {
            "__rows": F.lit(1).cast("bigint"),
            **{
                f"__broken_{i}": broken.cast("bigint")
                for i, broken in enumerate(key_rules.values())
            },
        }
    )


def cleaned_rows(groups: DataFrame) -> DataFrame:
    """The cleaned trips among ``quality_groups``."""
    names = [c for c in groups.columns if not c.startswith("__")]
    return groups.where("__failed = 0").select([column(c) for c in names])


def quality_funnel(
    trips: DataFrame, limits: Limits = LIMITS, null_duration: str = "drop"
) -> DataFrame:
    """Rows before and after every preprocessing step, on standardised trips.

    ``rows_failing`` counts the rows that break the step's rule on its own,
    whatever earlier rules say: among all rows for the key rules, among unique
    rows for the range rules. One scan and one shuffle of reduced rows.
    """
    return funnel_of_groups(quality_groups(needed_for(trips, ())), limits, null_duration)


def funnel_of_groups(
    unique: DataFrame, limits: Limits = LIMITS, null_duration: str = "drop"
) -> DataFrame:
    """The funnel from ``quality_groups``."""
    trips = unique.select([column(c) for c in unique.columns if not c.startswith("__")])
    key_rules = _key_rules(trips)
    keys = dedupe_keys(trips.columns)
    ok = F.col("__failed") == 0

    derived = add_time_columns(unique)
    range_rules = {
        "duration": duration_rule(limits, null_duration),
        **outlier_rules(derived.columns, limits),
    }
    passes = {name: F.coalesce(rule, F.lit(False)) for name, rule in range_rules.items()}

    total = F.sum("__rows")
    steps = [("raw", total, F.lit(0).cast("bigint"))]
    for i, name in enumerate(key_rules):
        still_in = ok | (F.col("__failed") > i + 1)
        steps.append((name, F.sum(F.when(still_in, F.col("__rows"))), F.sum(f"__broken_{i}")))
    if keys:
        duplicates = F.sum(F.when(ok, F.col("__rows") - 1))
        steps.append(("dedupe", F.count_if(ok), duplicates))
    for i, (name, rule) in enumerate(passes.items()):
        together = reduce(Column.__and__, list(passes.values())[: i + 1], ok)
        steps.append((name, F.count_if(together), F.count_if(ok & ~rule)))

    def zero_if_null(value: Column) -> Column:
        return F.coalesce(value, F.lit(0).cast("bigint"))

    counts = derived.agg(
        *[zero_if_null(after).alias(f"__after_{i}") for i, (_, after, _) in enumerate(steps)],
        *[zero_if_null(bad).alias(f"__bad_{i}") for i, (_, _, bad) in enumerate(steps)],
    )
    rows = [
        F.struct(
            F.lit(i).alias("step_no"),
            F.lit(name).alias("step"),
            F.col(f"__after_{max(i - 1, 0)}").alias("rows_before"),
            F.col(f"__after_{i}").alias("rows_after"),
            (F.col(f"__after_{max(i - 1, 0)}") - F.col(f"__after_{i}")).alias("rows_removed"),
            F.col(f"__bad_{i}").alias("rows_failing"),
        )
        for i, (name, _, _) in enumerate(steps)
    ]
    return counts.select(F.inline(F.array(*rows)))


def data_quality_rate(funnel: DataFrame) -> DataFrame:
    """Initial, cleaned and final record counts, and the share that survives."""

    def after(step: Column) -> Column:
        return F.max(F.when(step, F.col("rows_after")))

    range_steps = ("duration", "distance", "fare", "zero_distance")
    counts = funnel.agg(
        after(F.col("step") == "raw").alias("initial_records"),
        F.min(F.when(~F.col("step").isin(*range_steps), F.col("rows_after"))).alias(
            "cleaned_records"
        ),
        F.min("rows_after").alias("final_records"),
    )
    rate = F.try_divide(F.col("final_records"), F.col("initial_records"))
    return counts.withColumn("quality_rate", rate)
