"""Sinks (K1-K8). Writes are plain DataFrame writers: they are retried per
task by Spark and committed atomically per job, so a lost executor never
leaves a half-written table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.merge import missing_keys
from ..session import cut_lineage


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = (), **options) -> None:
    """K1: overwrite (no index column). CSV gets a header row."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3: JSON lines; ``mode='append'`` adds files next to earlier output."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_diagnostics(df: DataFrame, path: str, year: str = "year", stats: DataFrame | None = None) -> None:
    """K4: diagnostics partitioned by year (one folder per year). With ``stats`` (one row per year, the total's year
    null, as ``pairing_stats`` gives them) these lie next to them: ``details`` and ``stats``, the total under
    ``summary``. Other years of an earlier run stay."""
    def write(rows: DataFrame, to: str) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(year).json(to)

    if stats is None:
        write(df, path)
    else:
        write(df, f"{path}/details")
        write(stats.withColumn(year, F.coalesce(F.col(year).cast("string"), F.lit("summary"))), f"{path}/stats")


def write_text_by(df: DataFrame, path: str, keys: Sequence[str], file_key: str, text: str,
                  order: str | None = None) -> None:
    """K5: one text record per (keys, file_key), partitioned by ``keys``.
    Several rows for one file key: the last by ``order`` wins (a later write
    of the same day overwrites the earlier file)."""
    d = df
    if order:
        d = d.groupBy(*keys, file_key).agg(F.max_by(text, order).alias(text))
    d.select(*keys, file_key, text).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_text_files(df: DataFrame, path: str, keys: Sequence[str], file_key: str, text: str, order: str | None = None) -> None:
    """K5 as text: one folder per (keys, file_key) with one text file in it, e.g. ``year=1999/day=July_21``. A run
    replaces the folders it writes and leaves the others (other years, other days). Several rows for one file: the
    last by ``order`` wins, without ``order`` the largest text. Null texts are empty files."""
    held = df.select(*keys, file_key, F.coalesce(text, F.lit("")).alias(text), *([order] if order else []))
    one = F.max_by(text, order) if order else F.max(text)
    rows = held.groupBy(*keys, file_key).agg(one.alias(text))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys, file_key).text(path)


def write_metadata(df: DataFrame, path: str) -> None:
    """K6: metadata rows as CSV with a header."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def write_meetings(meetings: DataFrame, path: str, keys: Sequence[str], year: str = "year", pos: str = "meeting_pos") -> None:
    """K5 + K6 of ``meetings_of_pages``: the tagged text of each meeting under ``tagged`` (a folder per year and file key;
    of several meetings with one file key the last by keys and ordinal stays) and a CSV row per meeting under
    ``metadata``. The pages are parsed once. Other years' texts of an earlier run stay; the metadata are those of this run."""
    held = cut_lineage(meetings)
    write_text_files(held.withColumn("__order", F.struct(*keys, pos)), f"{path}/tagged", [year], "file_key", "tagged", order="__order")
    write_metadata(held.select("date", "day_of_week", "meeting_type", "location", "present", "absent", "staff", "source_url"),
                   f"{path}/metadata")


def split_rejects(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """K7: (good, rejects) by a status predicate. Callers writing both should
    persist ``df`` once (``cut_lineage``) so the source is not read twice."""
    flag = F.coalesce(ok, F.lit(False))
    return df.filter(flag), df.filter(~flag)


def write_by_status(df: DataFrame, path: str, status: str = "status", fmt: str = "parquet", mode: str = "overwrite") -> None:
    """K7 in one write: a folder per status (``status=ok``, ``status=rejected``, ...), so the source is read once."""
    df.write.mode(mode).partitionBy(status).format(fmt).save(path)


def skip_landed(df: DataFrame, landed: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """K8: keep only rows whose key has not landed yet (left anti join)."""
    return missing_keys(df, landed, key)
