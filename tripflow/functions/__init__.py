"""Column expressions shared by the operators; all of them are built-in Spark functions."""

from tripflow.functions.labels import payment_label, payment_group, weekend_label
from tripflow.functions.rules import is_missing, within
from tripflow.functions.times import day_name, epoch_seconds, trip_minutes, wall_clock

__all__ = [
    "day_name",
    "epoch_seconds",
    "is_missing",
    "payment_group",
    "payment_label",
    "trip_minutes",
    "wall_clock",
    "weekend_label",
    "within",
]
