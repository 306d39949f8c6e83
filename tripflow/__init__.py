"""Trip analytics as Spark jobs: typed trips, quality rules, zones and demand reports."""

__version__ = "0.1.0"
