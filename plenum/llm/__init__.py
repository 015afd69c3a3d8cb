"""Corpus operators for training data: de-duplication, language, benchmark
decontamination, toxicity, sharding, tokenisation, quality and chat threads.
Nothing else in the package imports this subpackage."""
from .registry import QUERIES, SQL  # noqa: F401
from . import queries  # noqa: F401,E402
