"""Global and per-group statistics.

Global constants (mean, sd, slope, grid bounds) are scalar subqueries
(``DataFrame.scalar()``): one partially-aggregated job whose single value is
inlined into the outer projection. No cross join, no unpartitioned window, and
nothing but that one value passes through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zscore(df: DataFrame, cols: Sequence[str], suffix: str = "_z") -> DataFrame:
    """(x - mean) / sd over the whole frame; sd with ddof=1; NULLs ignored.
    The moments of all columns are one struct of one aggregate."""
    moments = df.select(*cols).agg(F.struct(*[f(c).alias(f"{name}{i}") for i, c in enumerate(cols)
                                              for name, f in (("mean", F.avg), ("sd", F.stddev_samp))])).scalar()
    return df.withColumns({c + suffix: F.try_divide(F.col(c) - moments[f"mean{i}"], moments[f"sd{i}"])
                           for i, c in enumerate(cols)})


def fit_line(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Least-squares line y = slope * x + intercept (pairs with a NULL are
    skipped). Per group when ``keys`` is given."""
    g = df.groupBy(*keys) if keys else df.groupBy()
    return g.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                 F.regr_count(y, x).alias("n"))


def add_fit(df: DataFrame, x: str, y: str, out: str = "fitted") -> DataFrame:
    """Fitted values on the global line; slope and intercept are one struct
    of one aggregate."""
    line = df.select(x, y).agg(F.struct(F.regr_slope(y, x).alias("slope"),
                                        F.regr_intercept(y, x).alias("intercept"))).scalar()
    return df.withColumn(out, line["slope"] * F.col(x) + line["intercept"])


def grid(lo: Column, hi: Column, n: int) -> Column:
    """``n`` evenly spaced points from lo to hi inclusive (linspace)."""
    step = (hi - lo) / F.lit(n - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: lo + i * step)


def kde(df: DataFrame, x: str, group: str, n: int = 500, groups: Sequence | None = None) -> DataFrame:
    """Gaussian KDE per group on a common grid from the global min to the
    global max of ``x``. Scott's rule: h = sd * m^(-1/5), with sd the ddof=1
    standard deviation and m the group size; density(g) =
    sum(exp(-((g - x)/h)^2 / 2)) / (m * h * sqrt(2 pi)).

    Distributed form: equal values are counted first; each distinct value emits
    its ``n`` kernel terms, times its count, in the map
    stage (a generator inside the codegen span), and the terms are partially
    summed by (group, grid index) before the shuffle, so the shuffle carries
    at most tasks x groups x n rows whatever the data size. The per-group
    bandwidth is an aggregate joined on the group key (small: one row per
    group; AQE decides broadcast by its runtime size)."""
    d = df.select(F.col(group).alias("grp"), F.col(x).cast("double").alias("x")).dropna()
    if groups is not None:
        d = d.filter(F.col("grp").isin(list(groups)))
    ends = d.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    lo, hi = ends["lo"], ends["hi"]
    bw = d.groupBy("grp").agg(F.count(F.lit(1)).alias("m"),
                              (F.stddev_samp("x") * F.pow(F.count(F.lit(1)), F.lit(-0.2))).alias("h"))
    step = (hi - lo) / F.lit(n - 1)
    terms = (d.groupBy("grp", "x").agg(F.count(F.lit(1)).alias("c")).join(bw, "grp")
             .select("grp", "m", "h", "x", "c", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
             .withColumn("g", lo + F.col("i") * step)
             .withColumn("k", F.col("c") * F.exp(-0.5 * F.pow((F.col("g") - F.col("x")) / F.col("h"), 2))))
    dens = terms.groupBy("grp", "i").agg(F.sum("k").alias("s"), F.first("m").alias("m"),
                                         F.first("h").alias("h"), F.first("g").alias("g"))
    return dens.select(F.col("grp").alias(group), F.col("i").cast("bigint").alias("grid_index"),
                       F.col("g").alias("grid_x"),
                       (F.col("s") / (F.col("m") * F.col("h") * F.lit(math.sqrt(2 * math.pi)))).alias("density"))


#: Cells of ``kde_cells`` are this many bandwidths wide; powers up to this order are kept.
CELL_WIDTH = 0.5
CELL_ORDER = 12


def _hermite(order: int) -> list[list[int]]:
    """Coefficients, by rising power, of the Hermite polynomials He_0 .. He_order."""
    polys = [[1], [0, 1]]
    for k in range(1, order):
        up = [0, *polys[k]]
        down = [k * a for a in polys[k - 1]] + [0, 0]
        polys.append([a - b for a, b in zip(up, down)])
    return polys[:order + 1]


def kde_cells(df: DataFrame, x: str, group: str, n: int = 500) -> DataFrame:
    """A18 for large groups of distinct values: the same densities as ``kde``, from moments of cells.

    Per group, values are put into cells half a bandwidth h wide, of which only the power sums of t = (value - centre) / h
    are kept. With u = (grid point - centre) / h the kernel is exp(-(u - t)^2 / 2) = exp(-u^2 / 2) * sum over k of
    He_k(u) t^k / k!, so a cell's share of the density is a polynomial in u made of its power sums. Powers up to 12 are
    kept; as |He_k(u)| exp(-u^2 / 4) < 1.09 sqrt(k!) and |t| <= 1/4, the rest is below 3e-13 of a kernel's peak for each
    value, so the density errs by less than 3e-13 / (h sqrt(2 pi)), apart from rounding.

    The data are read twice, two columns each time: for counts, deviations and ends, then for the power sums, both partly
    summed before the shuffle. Cells times ``n`` kernel terms are formed whatever the number of rows; there are as many
    cells as a group's range has half bandwidths, at most. A group without spread (one row, equal values) has no
    bandwidth: its densities are NULL. NULL groups and values are left out, as in ``kde``."""
    d = df.select(F.col(group).alias("grp"), F.col(x).cast("double").alias("x")).dropna()
    bw = d.groupBy("grp").agg(F.count(F.lit(1)).alias("m"), F.min("x").alias("lo_g"), F.max("x").alias("hi_g"),
                              F.nullif(F.stddev_samp("x") * F.pow(F.count(F.lit(1)), F.lit(-0.2)), F.lit(0.0)).alias("h"))
    ends = bw.agg(F.struct(F.min("lo_g").alias("lo"), F.max("hi_g").alias("hi"))).scalar()
    width = F.col("h") * CELL_WIDTH
    celled = (d.join(bw.select("grp", "m", "h", "lo_g"), "grp")
              .withColumn("cell", F.floor((F.col("x") - F.col("lo_g")) / width))
              .withColumn("centre", F.col("lo_g") + (F.col("cell") + 0.5) * width)
              .withColumn("t", (F.col("x") - F.col("centre")) / F.col("h")))
    sums = celled.groupBy("grp", "m", "h", "cell", "centre").agg(
        *[F.sum(F.pow("t", F.lit(float(k))) / math.factorial(k)).alias(f"s{k}") for k in range(CELL_ORDER + 1)])
    polys = _hermite(CELL_ORDER)
    coefs = [sum((F.col(f"s{k}") * float(polys[k][j]) for k in range(j, CELL_ORDER + 1) if polys[k][j]), F.lit(0.0)).alias(f"a{j}")
             for j in range(CELL_ORDER + 1)]
    at = (sums.select("grp", "m", "h", "centre", *coefs, ends.alias("ends"))
          .withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
          .withColumn("g", F.col("ends.lo") + F.col("i") * ((F.col("ends.hi") - F.col("ends.lo")) / F.lit(n - 1)))
          .withColumn("u", (F.col("g") - F.col("centre")) / F.col("h")))
    poly = F.col(f"a{CELL_ORDER}")
    for j in range(CELL_ORDER - 1, -1, -1):
        poly = poly * F.col("u") + F.col(f"a{j}")
    dens = at.groupBy("grp", "m", "h", "i", "g").agg(F.sum(poly * F.exp(-0.5 * F.col("u") * F.col("u"))).alias("s"))
    return dens.select(F.col("grp").alias(group), F.col("i").cast("bigint").alias("grid_index"), F.col("g").alias("grid_x"),
                       (F.col("s") / (F.col("m") * F.col("h") * F.lit(math.sqrt(2 * math.pi)))).alias("density"))
