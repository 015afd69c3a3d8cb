"""Ranks within groups of any size.

A window with a row number sends a whole group to one task. Here the table is
range-sorted by group and order columns, so a large group spreads over many
tasks; each task counts its runs, and what earlier tasks hold of the run that
a task begins with is added afterwards (one figure a task).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise


def new_runs(column: pa.Array, last) -> np.ndarray:
    """True where a value of a column without nulls differs from the one before (``last``: the batch before's)."""
    first = last is None or column[0].as_py() != last
    return np.concatenate([[first], pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)])


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, group: str, order: list[str | Column], keep: list[str], name: str = "pos") -> DataFrame:
    """``keep`` and ``name``: the 0-based rank in its group under ``order`` (nulls first). ``group`` holds no null;
    rows that are equal in all of these get ranks in any order. Written once, in order of group and rank."""
    spark = df.sparkSession
    rows = df.repartitionByRange(partitions(df), group, *order).sortWithinPartitions(group, *order).select(group, *[c for c in keep if c != group])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, run, length = TaskContext.get().partitionId(), None, -1, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(0)
            new = new_runs(column, last)
            runs = run + np.cumsum(new)
            index = np.arange(batch.num_rows)
            starts = np.maximum.accumulate(np.where(new, index, -1))
            at = np.where(starts >= 0, index - starts, index + length)
            last, run, length = column[-1].as_py(), int(runs[-1]), int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, part)), pa.array(runs), pa.array(at)],
                                             [*batch.schema.names, "part", "run", "at"])

    schema = T.StructType([*rows.schema.fields, *[T.StructField(c, T.LongType()) for c in ("part", "run", "at")]])
    counted = materialise(rows.mapInArrow(count, schema))
    # One row a task: its first and last run.
    ends = counted.groupBy("part").agg(
        F.min_by(group, "run").alias("first"), F.max_by(group, "run").alias("last"), F.max("run").alias("runs"),
        F.max_by(F.col("at") + 1, F.struct("run", "at")).alias("length")).orderBy("part").collect()
    before, held, ahead = None, 0, []
    for e in ends:
        more = held if e["first"] == before else 0
        if more:
            ahead.append((e["part"], more))
        held = e["length"] + (more if e["runs"] == 0 else 0)
        before = e["last"]
    table = counted
    if ahead:
        table = counted.join(F.broadcast(spark.createDataFrame(ahead, "part long, ahead long")), "part", "left")
    rank = F.col("at") + (F.when(F.col("run") == 0, F.coalesce("ahead", F.lit(0))).otherwise(0) if ahead else F.lit(0))
    return table.select(*keep, rank.cast("long").alias(name))
