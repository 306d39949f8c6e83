"""Session factory."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from tripflow.constants import SESSION_DEFAULTS


def create_session(config: Mapping[str, str] | None = None) -> SparkSession:
    """Return a session with the engine's defaults; ``config`` entries win.

    The master and the memory sizes are left to the caller or to
    ``spark-submit``, so the same code starts on a laptop and on a cluster.
    """
    builder = SparkSession.builder
    for key, value in {**SESSION_DEFAULTS, **(config or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
