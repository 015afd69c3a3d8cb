"""DataFrame -> DataFrame operators."""
from . import aggregate, clean, documents, merge, records, stats  # noqa: F401
