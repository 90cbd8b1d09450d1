"""timepoint: public-transport reliability analytics as plain Spark DataFrame functions."""

from timepoint.settings import Settings, TimeBand

__all__ = ["Settings", "TimeBand"]
