"""Importing this module fills the registry."""

from . import combat, graph, learn, markers, neighbors, profile, qc, series, sources  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
