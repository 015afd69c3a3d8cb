"""Query registry: each entry pairs a Spark builder ``(spark, sf_dir) ->
DataFrame`` with the equivalent DuckDB SQL (or None when the operator is not
expressible in SQL, e.g. an HTML tokenizer)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return deco
