"""Projection, renaming, cleaning and filters.

Every function takes a DataFrame first and returns a DataFrame; column names
are arguments. All work is a single narrow projection or filter, so Catalyst
folds consecutive calls into one codegen stage and pushes filters to the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar as X


def lower_columns(df: DataFrame) -> DataFrame:
    """P1."""
    return df.toDF(*[c.lower() for c in df.columns])


def lower_strings(df: DataFrame) -> DataFrame:
    """Lower every string value; other types and nulls untouched."""
    return df.select([F.lower(F.col(f"`{f.name}`")).alias(f.name)
                      if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
                      for f in df.schema.fields])


def _to_text(f: T.StructField) -> Column:
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        # Python renders integral floats as '12.0'; keep that shape.
        return F.when(c == F.floor(c), F.concat(F.floor(c).cast("bigint").cast("string"), F.lit(".0"))) \
                .otherwise(c.cast("string"))
    return c.cast("string")


def stringify_lower(df: DataFrame, null_token: str | None = "nan",
                    subset: Sequence[str] | None = None) -> DataFrame:
    """Cast columns to lower-case text; NULL becomes ``null_token``
    (None keeps NULL)."""
    cols = set(subset or df.columns)
    out = []
    for f in df.schema.fields:
        if f.name not in cols:
            out.append(F.col(f"`{f.name}`"))
            continue
        v = F.lower(_to_text(f))
        if null_token is not None:
            v = F.coalesce(v, F.lit(null_token))
        out.append(v.alias(f.name))
    return df.select(out)


def map_columns(df: DataFrame, fn, cols: Sequence[str] | None = None) -> DataFrame:
    """V2: apply a Column -> Column function to every (or each listed)
    column, keeping names; stays a single native projection."""
    targets = set(cols or df.columns)
    return df.select(*[fn(F.col(f"`{c}`")).alias(c) if c in targets else F.col(f"`{c}`") for c in df.columns])


def row_key(*cols: str) -> Column:
    """V3: a composite key value (the tuple built per row in pandas) as a struct."""
    return F.struct(*[F.col(c) for c in cols])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """P4 by name."""
    return df.withColumnsRenamed(dict(mapping))


def rename_at(df: DataFrame, index: int, name: str) -> DataFrame:
    """P4 by position."""
    cols = list(df.columns)
    cols[index] = name
    return df.toDF(*cols)


def order_columns(df: DataFrame, preferred: Sequence[str]) -> DataFrame:
    """Known columns first (when present), the rest after in their order."""
    present = [c for c in preferred if c in df.columns]
    others = [c for c in df.columns if c not in present]
    return df.select(*[F.col(f"`{c}`") for c in present + others])


def with_literal(df: DataFrame, name: str, value) -> DataFrame:
    """P8."""
    return df.withColumn(name, F.lit(value))


def map_column(df: DataFrame, col: str, mapping: Mapping[str, str], out: str | None = None,
               default: str | None = "self", lower_self: bool = True, normalise: bool = False) -> DataFrame:
    """P9/P10 applied to a column."""
    return df.withColumn(out or col, X.map_values(col, mapping, default, lower_self, normalise))


def replace_values(df: DataFrame, col: str, fixes: Mapping[str, str]) -> DataFrame:
    """Point fixes of values in one column."""
    return df.replace(dict(fixes), subset=[col])


def to_number(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Numeric coercion, bad text -> NULL."""
    return df.withColumns({c: F.col(c).cast("string").try_cast("double") for c in cols})


def fill_nulls(df: DataFrame, value=0, include_strings: bool = True) -> DataFrame:
    """Fill numerics with ``value``; optionally also strings with str(value)."""
    out = df.na.fill(value)
    if include_strings and not isinstance(value, str):
        out = out.na.fill(str(value))
    return out


def drop_incomplete(df: DataFrame, subset: Sequence[str], how: str = "any") -> DataFrame:
    """P18/P19."""
    return df.dropna(how=how, subset=list(subset))


def flatten_struct(df: DataFrame, col: str) -> DataFrame:
    """P20: nested object -> top-level columns."""
    if col not in df.columns:
        return df
    inner = [f.name for f in df.schema[col].dataType.fields]
    keep = [c for c in df.columns if c != col]
    return df.select(*[F.col(f"`{c}`") for c in keep],
                     *[F.col(f"`{col}`.`{k}`").alias(k) for k in inner if k not in keep])


def join_lists(df: DataFrame, cols: Sequence[str], sep: str = ", ") -> DataFrame:
    """Array columns -> joined text; other types unchanged."""
    out = {}
    for c in cols:
        if c in df.columns and isinstance(df.schema[c].dataType, T.ArrayType):
            out[c] = F.array_join(F.col(c).cast("array<string>"), sep)
    return df.withColumns(out) if out else df


def ensure_fields(df: DataFrame, required: Sequence[str], list_keys: Sequence[str] = ()) -> DataFrame:
    """Add missing required columns and backfill NULLs ('' or [] for lists)."""
    out = {}
    for k in required:
        empty = F.array().cast("array<string>") if k in list_keys else F.lit("")
        out[k] = F.coalesce(F.col(k), empty) if k in df.columns else empty
    return df.withColumns(out)


def dedupe_first(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Keep the first row per key by ``order``.

    A ``min_by`` aggregate instead of a row_number window: it is partially
    aggregated before the shuffle, so a key holding a third of all rows never
    lands whole in one task."""
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(f"`{c}`") for c in others])
    agg = df.groupBy(*keys).agg(F.min_by(packed, F.col(order)).alias("__first"))
    return agg.select(*keys, "__first.*")


def distinct_sorted(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """P24."""
    d = df.select(*cols) if cols else df
    return d.distinct().orderBy(*(cols or d.columns))


# ---------------------------------------------------------------- filters
def keep_eq(df: DataFrame, col: str, value, negate: bool = False) -> DataFrame:
    """F1. ``negate`` keeps NULLs like pandas ``!=`` does."""
    if negate:
        return df.filter(~F.col(col).eqNullSafe(F.lit(value)))
    return df.filter(F.col(col) == F.lit(value))


def keep_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """F2."""
    return df.filter(F.col(col).isin(list(values)))


def keep_any(df: DataFrame, *conds: Column) -> DataFrame:
    """F4."""
    cond = conds[0]
    for c in conds[1:]:
        cond = cond | c
    return df.filter(cond)


def drop_containing(df: DataFrame, col: str, text: str) -> DataFrame:
    """drop rows whose text contains ``text``; NULLs are kept."""
    return df.filter(~F.coalesce(F.col(col).contains(text), F.lit(False)))


def keep_range(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """inclusive range."""
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(col) >= F.lit(lo))
    if hi is not None:
        cond = cond & (F.col(col) <= F.lit(hi))
    return df.filter(cond)


def with_status(df: DataFrame, value: Column, out: str, status: str = "status") -> DataFrame:
    """evaluate a ``try_*`` expression, keep every row, mark failures."""
    return df.withColumn(out, value).withColumn(
        status, F.when(F.col(out).isNull(), F.lit("error")).otherwise(F.lit("ok")))


def try_in_turn(df: DataFrame, parsers: Mapping[str, Column], out: str = "value", status: str = "status", failed: str = "failed") -> DataFrame:
    """F10 as a cascade: the first parser (name -> ``try_*`` expression) that gives a value counts. Every row stays;
    ``status`` is that parser's name or ``rejected``, ``failed`` the names of those before it that gave none. Later
    parsers run only where all earlier ones failed."""
    names = list(parsers)
    got = F.coalesce(*[F.when(p.isNotNull(), F.struct(F.lit(i).alias("i"), p.alias("v"))) for i, p in enumerate(parsers.values())])
    res = df.withColumn("__got", got)
    at = F.coalesce(F.col("__got.i"), F.lit(len(names)))
    labels = F.array(*[F.lit(n) for n in names])
    return res.withColumns({out: F.col("__got.v"), status: F.coalesce(F.get(labels, F.col("__got.i")), F.lit("rejected")),
                            failed: F.slice(labels, F.lit(1), at)}).drop("__got")


def keep_type(df: DataFrame, content_col: str, kind: str) -> DataFrame:
    """keep payloads of ``kind`` ('pdf' or 'html') judged by leading bytes."""
    c = F.col(content_col)
    head = F.substring(c.cast("binary") if isinstance(df.schema[content_col].dataType, T.StringType) else c, 1, 5)
    is_pdf = F.hex(head) == F.hex(F.lit("%PDF-").cast("binary"))
    return df.filter(is_pdf if kind == "pdf" else ~is_pdf)
