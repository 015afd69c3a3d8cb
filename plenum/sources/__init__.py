"""Scans and sinks."""
from . import readers, sinks  # noqa: F401
