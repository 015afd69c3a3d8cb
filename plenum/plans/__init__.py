"""Composed queries over the driver tables (Spark plan + DuckDB oracle SQL)."""
from .registry import QUERIES, SQL, query  # noqa: F401
from . import corpus, elections, metro, minutes, web  # noqa: F401,E402
