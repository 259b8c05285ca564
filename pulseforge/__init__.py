"""Sensor-reading analytics expressed as PySpark DataFrames."""

from pulseforge.config import DEFAULTS, Settings
from pulseforge.session import build, configure

__all__ = ["DEFAULTS", "Settings", "build", "configure"]
