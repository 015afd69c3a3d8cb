"""Joins and set operations.

No operator here broadcasts a side whose size it cannot bound. Joins are left
to AQE, which compares the runtime size of each side with
``spark.sql.autoBroadcastJoinThreshold`` and falls back to a shuffled
sort-merge join (with skew splitting) beyond it. ``bounded_broadcast`` is
used only for sides whose row count is fixed by construction.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions import scalar as X
from .clean import lower_strings


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast hint for a side whose size is fixed by construction (a
    one-row aggregate, a literal lookup table, a grid of known length)."""
    return F.broadcast(df)


def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def enrich(df: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Left join a dimension."""
    return df.join(dim, on=_keys(on), how=how)


def outer_merge(a: DataFrame, b: DataFrame, on, null_safe: bool = False) -> DataFrame:
    """Full outer join with coalesced keys. ``null_safe`` matches NULL
    keys to NULL keys, as pandas merge does."""
    keys = _keys(on)
    if not null_safe:
        return a.join(b, on=keys, how="full")
    la, rb = a.alias("__l"), b.alias("__r")
    cond = None
    for k in keys:
        c = F.col(f"__l.`{k}`").eqNullSafe(F.col(f"__r.`{k}`"))
        cond = c if cond is None else cond & c
    j = la.join(rb, cond, "full")
    rest_a = [F.col(f"__l.`{c}`") for c in a.columns if c not in keys]
    rest_b = [F.col(f"__r.`{c}`") for c in b.columns if c not in keys]
    return j.select(*[F.coalesce(F.col(f"__l.`{k}`"), F.col(f"__r.`{k}`")).alias(k) for k in keys],
                    *rest_a, *rest_b)


def merge_indicator(a: DataFrame, b: DataFrame, on, name: str = "_merge", null_safe: bool = False) -> DataFrame:
    """Full outer join plus an indicator in {both, left_only, right_only}. ``null_safe`` as in ``outer_merge``."""
    j = outer_merge(a.withColumn("__in_l", F.lit(True)), b.withColumn("__in_r", F.lit(True)), on, null_safe)
    ind = (F.when(F.col("__in_l") & F.col("__in_r"), F.lit("both"))
           .when(F.col("__in_l"), F.lit("left_only"))
           .otherwise(F.lit("right_only")))
    return j.withColumn(name, ind).drop("__in_l", "__in_r")


def keep_side(df: DataFrame, side: str, name: str = "_merge") -> DataFrame:
    """F9."""
    return df.filter(F.col(name) == side)


def join_on(a: DataFrame, b: DataFrame, left: str, right: str, how: str = "left") -> DataFrame:
    """Join on differently named keys, keeping both."""
    return a.join(b, a[left] == b[right], how)


def missing_keys(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """Rows of ``a`` whose key is absent from ``b``."""
    return a.join(b.select(*_keys(on)), on=_keys(on), how="left_anti")


def matching_keys(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """Rows of ``a`` whose key is present in ``b``."""
    return a.join(b.select(*_keys(on)), on=_keys(on), how="left_semi")


def expand_templates(df: DataFrame, templates: Sequence[str], name: str = "template") -> DataFrame:
    """Every row times a short literal list, without a cross join: the
    list is an array literal exploded in the same projection."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(t) for t in templates])))


def build_master(base: DataFrame, parts: Sequence[tuple[DataFrame, Sequence[str], str]],
                 check_unique: bool = False) -> DataFrame:
    """Fold a list of (frame, keys, how) joins onto ``base``. With ``check_unique`` the query fails when a joined
    frame has a key twice."""
    out = base
    for dim, keys, how in parts:
        if check_unique:
            dim = ensure_unique(dim, keys)
        out = out.join(dim, on=list(keys), how=how)
    return out


def duplicate_keys(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (the fan-out a join would create)."""
    return dim.groupBy(*keys).count().filter(F.col("count") > 1)


def ensure_unique(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """J12 inside the plan: the same rows; the query fails when it meets a key twice. Counting uses the partitioning
    by key that a join on these keys needs anyway, so there is no second scan and no job of its own. Null keys may
    repeat: they meet nothing in a join."""
    count = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    message = F.concat(F.lit(f"keys {list(keys)} are not unique, e.g. "), shown)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    # A filter, not a column: column pruning would drop the check.
    return dim.withColumn("__n", count).where(F.when((F.col("__n") > 1) & known, F.raise_error(message)).otherwise(F.lit(True))).drop("__n")


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """A28 + A21 without a job of their own: the frame and an observation that holds the row count (``rows``) and the
    given aggregates once an action has run over it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in metrics.items()]), seen


def assert_unique(dim: DataFrame, keys: Sequence[str]) -> None:
    """J12 as a guard: raise when the dimension would fan out a join. The check
    is one distributed aggregate; only one offending key is brought back."""
    bad = duplicate_keys(dim, keys).limit(1).collect()
    if bad:
        raise ValueError(f"keys {list(keys)} are not unique, e.g. {bad[0].asDict()}")


def union_outer(*dfs: DataFrame) -> DataFrame:
    """Union by name, missing columns become NULL."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def union_strict(*dfs: DataFrame) -> DataFrame:
    """Union by name; schemas must agree."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def append_year(history: DataFrame, table: DataFrame, year: int, names: Mapping[str, str], other: str, state: str = "state",
                states: Mapping[str, str] | None = None, corrected: bool = False) -> DataFrame:
    """P2 + P9 + P8 + X2 + P4 + P6 + U1: one year's table in its own layout put under a history of years. ``names`` maps
    the table's total, first and second party's columns, in this order, to the history's; ``other`` is what the total
    leaves of them (literally ``total - (first - second)``, see ``residual``). Text is lower-cased, states go through
    ``states`` with themselves as fallback; the history's columns come out, the table's further ones are left out, those
    it lacks are null."""
    total, first, second = names
    own = lower_strings(table).withColumn("__state", X.map_values(state, states or {"": ""}))
    out = own.withColumn("__other", X.residual(*(f"`{c}`" for c in (total, first, second)), corrected=corrected))
    shared = [c for c in history.columns if c in table.columns and c not in {state, "year", other, *names.values()}]
    rows = out.select(F.lit(year).cast(history.schema["year"].dataType).alias("year"), F.col("__state").alias(state),
                      *[F.col(f"`{c}`").alias(n) for c, n in names.items()], F.col("__other").alias(other),
                      *[F.col(f"`{c}`") for c in shared])
    return union_outer(history, rows)


def replace_slice(df: DataFrame, cond: Column, new: DataFrame) -> DataFrame:
    """U4: drop the rows matching ``cond`` and append ``new`` (outer union)."""
    return union_outer(df.filter(~F.coalesce(cond, F.lit(False))), new)
