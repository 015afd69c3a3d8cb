"""Aggregation, reshape and window-like operators.

Skew rule used throughout: any per-key result is computed with a
partially-aggregable aggregate (sum, count, max, max_by, min_by, bool_or) so
the map side combines rows before the shuffle; a key that holds a third of
all rows then costs one small partial row per map task, not one huge task.
Group totals that go back onto rows are an aggregate joined back on the key
(AQE broadcasts the small side or splits a skewed partition) rather than an
unbounded ``Window.partitionBy`` that would sort a hot key in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as X


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def group_sum(df: DataFrame, keys, values, zero_if_null: bool = True, drop_null_keys: bool = True) -> DataFrame:
    """A1: per-group sums. pandas drops NULL keys and sums an all-NULL group to
    0; both are the defaults here."""
    keys = _cols(keys)
    d = df.dropna(subset=keys) if drop_null_keys else df
    aggs = [(F.coalesce(F.sum(v), F.lit(0)) if zero_if_null else F.sum(v)).alias(v) for v in _cols(values)]
    return d.groupBy(*keys).agg(*aggs)


def group_mean(df: DataFrame, keys, values, drop_null_keys: bool = True) -> DataFrame:
    """A2."""
    keys = _cols(keys)
    d = df.dropna(subset=keys) if drop_null_keys else df
    return d.groupBy(*keys).agg(*[F.avg(v).alias(v) for v in _cols(values)])


def group_max(df: DataFrame, keys, value: str, out: str | None = None) -> DataFrame:
    """A3."""
    return df.groupBy(*_cols(keys)).agg(F.max(value).alias(out or value))


def mean_then_sum(df: DataFrame, outer, inner, value: str, out: str | None = None) -> DataFrame:
    """A4: mean of ``value`` within (outer + inner), then summed over inner."""
    outer, inner = _cols(outer), _cols(inner)
    m = df.groupBy(*outer, *inner).agg(F.avg(value).alias("__m"))
    return m.groupBy(*outer).agg(F.sum("__m").alias(out or value))


def group_any(df: DataFrame, keys, cond: Column, out: str = "any") -> DataFrame:
    """A5: does any row of the group satisfy ``cond``."""
    return df.groupBy(*_cols(keys)).agg(F.bool_or(F.coalesce(cond, F.lit(False))).alias(out))


def units_missing(df: DataFrame, keys, cond: Column) -> DataFrame:
    """groups in which no row satisfies ``cond``."""
    return group_any(df, keys, cond, "__any").filter(~F.col("__any")).drop("__any")


def group_transform(df: DataFrame, keys, value: str, out: str, fn: str = "sum") -> DataFrame:
    """Group aggregate placed on every row (pandas ``transform``)."""
    keys = _cols(keys)
    agg = df.groupBy(*keys).agg(getattr(F, fn)(value).alias(out))
    return df.join(agg, on=keys, how="left")


def group_share(df: DataFrame, keys, value: str, out: str, total: str | None = None) -> DataFrame:
    """``value`` divided by its group total (NULL for a zero total)."""
    keys = _cols(keys)
    tot = total or f"__{value}_total"
    with_tot = group_transform(df, keys, value, tot)
    res = with_tot.withColumn(out, X.share(value, tot))
    return res if total else res.drop(tot)


def weighted_mean(df: DataFrame, keys, weight: str, values: Sequence[str]) -> DataFrame:
    """Per group, sum(v*w)/sum(w) for each value column. The denominator is
    the weight over **all** rows of the group, including rows where v is NULL
    (a NULL product counts as 0 in the numerator)."""
    keys = _cols(keys)
    aggs = [F.try_divide(F.coalesce(F.sum(F.col(v) * F.col(weight)), F.lit(0.0)), F.sum(weight)).alias(v)
            for v in values]
    return df.groupBy(*keys).agg(*aggs)


def pivot_sum(df: DataFrame, index, col: str, value: str, values: Sequence, names: Mapping | None = None,
              extra: Sequence[Column] = ()) -> DataFrame:
    """A10: long -> wide with sum and zero fill, for a known value list. Written
    as conditional sums so extra aggregates (``extra``) share the same single
    shuffle instead of a second groupBy plus a join."""
    names = names or {}
    aggs = [F.coalesce(F.sum(F.when(F.col(col) == F.lit(v), F.col(value))), F.lit(0)).alias(str(names.get(v, v)))
            for v in values]
    return df.groupBy(*_cols(index)).agg(*aggs, *extra)


def pivot_unique(df: DataFrame, index, col: str, value: str, values: Sequence, names: Mapping | None = None,
                 check: bool = True) -> DataFrame:
    """Long -> wide, one value per cell, no fill. With ``check`` a
    duplicated (index, col) cell raises, as pandas ``pivot`` does."""
    index = _cols(index)
    names = names or {}
    aggs = [F.first(F.when(F.col(col) == F.lit(v), F.col(value)), ignorenulls=True).alias(str(names.get(v, v)))
            for v in values]
    counts = [F.count(F.when(F.col(col) == F.lit(v), F.lit(1))) for v in values]
    out = df.groupBy(*index).agg(*aggs, F.greatest(*counts, F.lit(0)).alias("__n"))
    if check:
        # a filter, not a projected column: column pruning would drop the check
        out = out.filter(F.when(F.col("__n") > 1, F.raise_error(F.lit("pivot: duplicate cell"))).otherwise(F.lit(True)))
    return out.drop("__n")


def fold_other(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    """Sum several columns into ``out`` (NULL counts as 0) and drop the rest."""
    total = None
    for c in cols:
        t = F.coalesce(F.col(c), F.lit(0))
        total = t if total is None else total + t
    return df.withColumn(out, total).drop(*[c for c in cols if c != out])


def unpivot(df: DataFrame, ids, values: Sequence[str], name: str = "variable", value: str = "value") -> DataFrame:
    """Wide -> long (``stack``)."""
    return df.unpivot(_cols(ids), list(values), name, value)


def transpose_table(df: DataFrame, key: str, row_values: Sequence[str], name: str = "field") -> DataFrame:
    """Transpose a table: rows keyed by ``key`` become columns, the other
    columns become rows (their names land in ``name``). Built as
    unpivot + pivot so it is a distributed reshape, not a driver collect;
    ``row_values`` is the known list of key values."""
    value_cols = [c for c in df.columns if c != key]
    long = df.select(F.col(key).cast("string").alias(key), *[F.col(c).cast("double").alias(c) for c in value_cols])
    long = long.unpivot([key], value_cols, name, "__v")
    return long.groupBy(name).pivot(key, [str(v) for v in row_values]).agg(F.first("__v"))


def rows_to_maps(df: DataFrame, keys, name: str, value: str, out: str = "cells") -> DataFrame:
    """Wide rows as maps: per group of ``keys`` one map from ``name`` to ``value``, with any number of entries and
    without a pivot. Of repeated names the largest value counts; null names are left out."""
    keys = _cols(keys)
    cells = df.where(F.col(name).isNotNull()).groupBy(*keys, F.col(name).cast("string").alias("__name")).agg(F.max(value).alias("__value"))
    return cells.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("__name", "__value"))).alias(out))


def transpose_maps(df: DataFrame, key: str, cells: str = "cells", name: str = "field") -> DataFrame:
    """A13 for tables of any width: rows (``key``, map from column name to value) become rows (``name``, map from the
    old keys to values). Names need not be known, and no job runs while the query is built."""
    long = df.select(F.col(key).alias("__key"), F.explode(cells).alias(name, "__value"))
    return rows_to_maps(long, name, "__key", "__value", cells)


def share_where(df: DataFrame, keys, cond: Column, out: str = "share") -> DataFrame:
    """Share of rows meeting a predicate; a NULL comparison counts as False,
    rows with a NULL key are dropped."""
    return df.dropna(subset=_cols(keys)).groupBy(*_cols(keys)).agg(F.avg(F.coalesce(cond, F.lit(False)).cast("double")).alias(out))


def zero_share_by_year(df: DataFrame, unit, year: str, value: str, years: Sequence[int]) -> DataFrame:
    """A14 for a list of years and their mean: (period, n_rows, share). A year's rows are those of that year and those
    of year 0 (units filled in by an outer merge); period ``mean`` has a row per unit with its mean over all its rows. A
    null value is not zero; rows with a null unit are dropped; a period without rows has a null share. One aggregate per
    unit and one of these, so a unit with very many rows is summed map-side."""
    mine = [F.col(year).isin(0, y) for y in years]
    zero = F.coalesce(F.col(value) == 0, F.lit(False))
    per = df.dropna(subset=_cols(unit)).groupBy(*_cols(unit)).agg(
        F.avg(value).alias("__mean"), *[F.count_if(m).alias(f"__n{i}") for i, m in enumerate(mine)],
        *[F.count_if(m & zero).alias(f"__z{i}") for i, m in enumerate(mine)])
    none = F.lit(0).cast("bigint")
    periods = [(str(y), F.coalesce(F.sum(f"__n{i}"), none), F.sum(f"__z{i}")) for i, y in enumerate(years)]
    periods.append(("mean", F.count(F.lit(1)), F.count_if(F.col("__mean") == 0)))
    total = per.agg(F.array(*[F.struct(F.lit(p).alias("period"), n.alias("n_rows"), z.alias("zeros")) for p, n, z in periods]).alias("__p"))
    return total.select(F.explode_outer("__p").alias("p")).select(
        "p.period", "p.n_rows", F.try_divide(F.col("p.zeros").cast("double"), F.col("p.n_rows")).alias("share"))


def control_panel(sheets: DataFrame, state: str = "state", row: str = "row", cells: str = "cells") -> DataFrame:
    """A13 + S11 + X23 + X11 + X24 + X22 + X25: sheets of states (a row per chamber, a map from column label to value) to
    one row per state and year: ``state, year, stateyear, governor, senate, house, total_gov``. Rows 1 to 3 of a sheet
    are governor, senate and house whatever they are called, further ones are left out; a label is a two-digit year
    after one character (other labels give a null year); the first underscore of a state's name becomes a blank; values
    keep their first character. Of repeated rows the largest value stays; a null value stays null. One shuffle by
    (state, label), aggregated map-side."""
    places = ("governor", "senate", "house")
    long = explode_nonempty(sheets.select(F.col(state).alias("__s"), F.col(row).alias("__r"), F.col(cells).alias("__c")),
                            ["__s", "__r"], F.map_entries("__c"), ("__i", "__e"))
    wide = long.groupBy("__s", F.col("__e.key").alias("__label")).agg(
        *[F.max(F.when(F.col("__r") == i, F.col("__e.value"))).alias(p) for i, p in enumerate(places, 1)])
    yy = X.sub_first("__label", ".", "")
    named = wide.select(X.sub_first("__s", "_", " ").alias("state"), X.expand_year(F.when(yy.rlike("^[0-9]{2}$"), yy)).alias("year"),
                        *[X.first_char(p).alias(p) for p in places])
    return named.select("state", "year", X.concat_key("state", "year").alias("stateyear"), *places,
                        X.control("governor", "senate", "house").alias("total_gov"))


def longest_per_key(df: DataFrame, keys, text: str, pos: str, sized: bool = False) -> DataFrame:
    """The longest text per key; the first (lowest ``pos``) wins ties.
    ``max_by`` is partially aggregated, so a hot key stays cheap. With ``sized``
    the column holds the text's length already, and no text travels."""
    keys = _cols(keys)
    others = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(text) if sized else F.length(text), -F.col(pos))
    packed = F.struct(*[F.col(f"`{c}`") for c in others])
    return df.groupBy(*keys).agg(F.max_by(packed, order).alias("__b")).select(*keys, "__b.*")


def count_by(df: DataFrame, keys, out: str = "n") -> DataFrame:
    """Counts per key, sorted by key."""
    keys = _cols(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).orderBy(*keys)


def sorted_unique_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """A22 in long form: distinct values per group, sorted. The long form is
    what scales: a group may hold a third of all values, so the per-group set is
    never collected into one row."""
    return df.select(key, value).dropna().distinct().orderBy(key, value)


PAIRING_METRICS = ["labels", "blocks_found", "paired", "labels_without_block", "unmatched_blocks"]


def pairing_stats(labels: DataFrame, blocks: DataFrame, year: str = "year", code: str = "code") -> DataFrame:
    """Per year the number of labels, blocks found, paired labels, labels without a block and block codes without
    a label, and the total of all years (year null), from one aggregate over grouping sets. ``labels`` has a row per
    label, ``blocks`` one per block, both with their year and normalised case code; blank codes pair with nothing."""
    lab = labels.groupBy(year, code).agg(F.count(F.lit(1)).alias("n_labels"))
    blk = blocks.groupBy(year, code).agg(F.count(F.lit(1)).alias("n_blocks"))
    both = lab.join(blk, [year, code], "full").select(year, code, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_labels", "n_blocks")])
    pairs = (F.col(code) != "") & (F.col("n_labels") > 0) & (F.col("n_blocks") > 0)
    lone = (F.col(code) != "") & (F.col("n_labels") == 0)
    parts = {"labels": F.col("n_labels"), "blocks_found": F.col("n_blocks"), "paired": F.when(pairs, F.col("n_labels")).otherwise(0),
             "labels_without_block": F.when(pairs, 0).otherwise(F.col("n_labels")), "unmatched_blocks": F.when(lone, 1).otherwise(0)}
    return rollup_levels(both.select(year, *[v.cast("bigint").alias(k) for k, v in parts.items()]), [[year], []], PAIRING_METRICS).drop("level")


def valid_ratio(df: DataFrame, flag: str, keys=None, out: str = "valid_json_ratio") -> DataFrame:
    """Share of rows whose ``flag`` is true."""
    g = df.groupBy(*_cols(keys)) if keys else df.groupBy()
    return g.agg(F.avg(F.col(flag).cast("double")).alias(out))


def rollup_level(df: DataFrame, keys, measures: Sequence[str]) -> DataFrame:
    """The same measures summed at a coarser level, by the null rules of A1
    (NULL keys dropped, an all-NULL sum is 0)."""
    return group_sum(df, keys, measures)


def rollup_levels(df: DataFrame, levels: Sequence[Sequence[str]], measures: Sequence[str]) -> DataFrame:
    """A26 at several levels at once: the measures summed by each list of keys, in one aggregate over grouping sets.
    ``level`` is the list's number; keys that a level does not have are null. Null rules as in A1: a row whose key
    is null takes no part in the levels that have this key, and an all-null sum is 0."""
    keys = list(dict.fromkeys(k for level in levels for k in level))
    if not keys:
        raise ValueError("one level must have a key")
    own = F.lit(None).cast("int")
    for i, level in enumerate(levels):
        flags = F.lit(True)
        for k in keys:
            flags = flags & (F.grouping(k) == F.lit(0 if k in level else 1))
        own = F.when(flags, F.lit(i)).otherwise(own)
    sums = df.groupingSets([list(level) for level in levels], *keys).agg(
        own.alias("level"), *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])
    whole = F.lit(False)
    for i, level in enumerate(levels):
        full = F.col("level") == i
        for k in level:
            full = full & F.col(k).isNotNull()
        whole = whole | full
    return sums.where(whole)


def collapse_units(df: DataFrame, unit_keys, year: str, value: str, mean_out: str | None = None,
                   fill_unmatched: bool = True) -> DataFrame:
    """Sum ``value`` by (unit, year), then average over years per unit.
    With ``fill_unmatched`` unmatched rows (NULL unit keys) are filled with 0
    first and form their own group, as a ``fillna(0)`` before the groupby does."""
    unit_keys = _cols(unit_keys)
    d = df
    if fill_unmatched:
        fills = {}
        for k in unit_keys + [year]:
            t = df.schema[k].dataType.simpleString()
            fills[k] = F.coalesce(F.col(k), F.lit(0).cast(t) if t != "string" else F.lit("0"))
        d = d.withColumns(fills)
    per_year = d.groupBy(*unit_keys, year).agg(F.coalesce(F.sum(value), F.lit(0)).alias(value))
    return per_year.groupBy(*unit_keys).agg(F.avg(value).alias(mean_out or value))


# ---------------------------------------------------------------- window-like
def explode_nonempty(df: DataFrame, keep, array_expr, names=("pos", "item"), with_pos: bool = True) -> DataFrame:
    """Rows of a computed array (with its 0-based position when ``with_pos``).

    Written with the ``_outer`` generator plus a filter on the generated
    column: a plain ``explode`` makes Catalyst infer ``size(array) > 0`` on
    the generator's input and push it below the projection, which evaluates
    an expensive array expression (a regex split of a whole document) twice
    or more — once in that pushed-down filter and once in the projection."""
    gen = F.posexplode_outer if with_pos else F.explode_outer
    arr = F.col(array_expr) if isinstance(array_expr, str) else array_expr
    out = df.select(*keep, gen(arr).alias(*names))
    return out.filter(F.col(names[0]).isNotNull())


def with_ordinal(df: DataFrame, array_col: str, out: str = "item", pos: str = "pos", base: int = 1) -> DataFrame:
    """Explode an array with its 1-based ordinal."""
    keep = [c for c in df.columns if c != array_col]
    return explode_nonempty(df, keep, array_col, (pos, out)).withColumn(pos, F.col(pos) + base)


def marker_spans(df: DataFrame, doc: str, start: str, end: str = "end", length: str | None = None) -> DataFrame:
    """Span from each marker to the next one in the same document (or to
    ``length``). A document's markers are bounded by its text, so the window
    partition is bounded too."""
    from pyspark.sql import Window

    w = Window.partitionBy(doc).orderBy(start)
    nxt = F.lead(start).over(w)
    return df.withColumn(end, F.coalesce(nxt, F.col(length)) if length else nxt)
