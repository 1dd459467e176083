"""Spark jobs for a lodging marketplace's partner marketing: find, score, report, contact."""

from staylift.config import Packages, Rules
from staylift.sources.tables import Tables, load_tables

__all__ = ["Packages", "Rules", "Tables", "load_tables"]
