"""Label expressions for weekdays and payment codes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tripflow.constants import MISSING_PAYMENT_LABEL, PAYMENT_LABELS, WEEKEND_DAYS


def weekend_label(day_of_week: Column) -> Column:
    return F.when(day_of_week.isin(*WEEKEND_DAYS), "Weekend").otherwise("Weekday")


def payment_label(code: Column) -> Column:
    """Name of a payment code; codes without a name become ``Other (<code>)``."""
    label = F.when(code.isNull(), MISSING_PAYMENT_LABEL)
    for number, name in PAYMENT_LABELS.items():
        label = label.when(code == number, name)
    return label.otherwise(F.concat(F.lit("Other ("), code.cast("string"), F.lit(")")))


def payment_group(code: Column) -> Column:
    """Credit card, cash, or everything else (missing codes included)."""
    return (
        F.when(code == 1, PAYMENT_LABELS[1]).when(code == 2, PAYMENT_LABELS[2]).otherwise("Other")
    )
