"""Incremental ingestion (file-source streams with availableNow triggers)."""
from .incremental import minutes_to_records, run_once, start_minutes_stream  # noqa: F401
