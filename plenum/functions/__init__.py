"""Column -> Column functions and fixed patterns."""
from . import patterns, scalar  # noqa: F401
