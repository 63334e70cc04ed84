"""Correlations, tests and smooth curves. Row-level work is grouped sums; only their results are small."""

from __future__ import annotations

import math
from itertools import combinations_with_replacement

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions import pvalues
from tarmac.plans.lookup import lookup_join, one_row
from tarmac.plans.ordering import running_totals
from tarmac.plans.storage import materialize


@F.pandas_udf(T.DoubleType())
def t_p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([pvalues.t_two_sided(a, b) for a, b in zip(t, df)])


@F.pandas_udf(T.DoubleType())
def chi2_p_value(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([pvalues.chi2_upper(a, int(b)) for a, b in zip(x, dof)])


@F.pandas_udf(T.DoubleType())
def fisher_p_value(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    return pd.Series([pvalues.fisher_two_sided(int(w), int(x), int(y), int(z)) for w, x, y, z in zip(a, b, c, d)])


def correlation(a: Column, b: Column) -> Column:
    """Aggregate: correlation over the rows where both are present; null if one of them is constant there."""
    x, y = a.cast("double"), b.cast("double")
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    r = F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))
    return F.when(r > 1, 1.0).when(r < -1, -1.0).otherwise(r)


def pearson_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Correlation of each pair of columns over the rows where both are present, as (a, b, r)."""
    pairs = list(combinations_with_replacement(cols, 2))
    row = df.agg(
        *[correlation(F.col(p[0]), F.col(p[1])).alias(f"{p[0]}|{p[1]}") for p in pairs]
    )
    cells = []
    for a, b in pairs:
        value = F.col(f"`{a}|{b}`")
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), value.alias("r")))
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def spearman_target(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Rank correlation of each feature with the target, with its absolute value, largest first.

    Equal (feature value, target) pairs are counted first; average ranks come from running counts over distinct values
    in even blocks, so there is no window over all rows.
    """
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features])
    pairs = df.select(F.col(target).cast("double").alias("y"), F.explode(cells).alias("c")).select("c.feature", "c.x", "y")
    pairs = pairs.filter("x IS NOT NULL AND y IS NOT NULL").groupBy("feature", "x", "y").agg(F.count("*").alias("n"))
    pairs = materialize(pairs, "pairs")
    sides = F.array(*[F.struct(F.lit(v).alias("side"), F.col(v).alias("v")) for v in ("x", "y")])
    values = pairs.select("feature", "n", F.explode(sides).alias("s")).groupBy("feature", "s.side", "s.v").agg(F.sum("n").alias("m"))
    ranks = running_totals(values, [F.col("v")], {"run": "m"}, ["feature", "side"])
    ranks = materialize(ranks.withColumn("r", F.col("run") - (F.col("m") - 1) / 2), "ranks")
    out = pairs
    for v in ("x", "y"):
        one = ranks.filter(F.col("side") == v).select("feature", F.col("v").alias(v), F.col("r").alias(f"r{v}"))
        out = lookup_join(out, one, ["feature", v])
    totals = pairs.groupBy("feature").agg(((F.sum("n") + 1) / 2).alias("mid"))
    out = out.join(F.broadcast(totals), "feature")
    dx, dy = F.col("rx") - F.col("mid"), F.col("ry") - F.col("mid")
    sums = out.groupBy("feature").agg(
        F.sum(F.col("n") * dx * dy).alias("xy"), F.sum(F.col("n") * dx * dx).alias("xx"), F.sum(F.col("n") * dy * dy).alias("yy")
    )
    r = F.col("xy") / F.nullif(F.sqrt("xx") * F.sqrt("yy"), F.lit(0.0))
    return sums.select("feature", r.alias("r"), F.abs(r).alias("abs_r")).orderBy(F.desc_nulls_last("abs_r"), "feature")


def welch_t(df: DataFrame, group: str, value: str, first: str, second: str, p_value: bool = True) -> DataFrame:
    """t-test of two groups with unequal variances: t, degrees of freedom and two-sided p."""
    sums = {}
    for tag, g in (("a", first), ("b", second)):
        x = F.when(F.col(group) == g, F.col(value))
        sums.update({f"n{tag}": F.count(x), f"m{tag}": F.avg(x), f"v{tag}": F.var_samp(x)})
    row = df.filter(F.col(group).isin(first, second)).agg(*[e.alias(n) for n, e in sums.items()])
    row = row.withColumns({g: F.col(f"v{g[1]}") / F.nullif(F.col(f"n{g[1]}"), F.lit(0)) for g in ("ea", "eb")})
    both = F.col("ea") + F.col("eb")
    zero = F.lit(0.0)
    parts = [F.col(f"e{g}") * F.col(f"e{g}") / F.nullif((F.col(f"n{g}") - 1).cast("double"), zero) for g in "ab"]
    df_ = both * both / F.nullif(parts[0] + parts[1], zero)
    out = row.select(((F.col("ma") - F.col("mb")) / F.nullif(F.sqrt(both), zero)).alias("t"), df_.alias("dof"))
    return out.withColumn("p_value", t_p_value("t", "dof")) if p_value else out


def chi_square(df: DataFrame, row: str, col: str, p_value: bool = True) -> DataFrame:
    """Independence test on the contingency table of two columns; continuity correction for 2x2 only."""
    cells = df.filter(F.col(row).isNotNull() & F.col(col).isNotNull()).groupBy(row, col).agg(F.count("*").cast("double").alias("o"))
    margin = {"r": Window.partitionBy(row), "c": Window.partitionBy(col)}
    cells = cells.withColumns({k: F.sum("o").over(w) for k, w in margin.items()})
    one = cells.agg(
        F.sum("o").alias("n"),
        F.sum(F.col("o") * F.col("o") / (F.col("r") * F.col("c"))).alias("q"),
        F.count_distinct(row).alias("rows"),
        F.count_distinct(col).alias("cols"),
        # for 2x2: every |observed - expected| is the same, so any present cell gives it
        F.max(F.struct("o", "r", "c")).alias("cell"),
    )
    dof = (F.col("rows") - 1) * (F.col("cols") - 1)
    gap = F.abs(F.col("cell.o") - F.col("cell.r") * F.col("cell.c") / F.col("n"))
    fixed = gap - F.least(gap, F.lit(0.5))
    r1, c1 = F.col("cell.r"), F.col("cell.c")
    inverse = F.col("n") * F.col("n") * F.col("n") / (r1 * (F.col("n") - r1) * c1 * (F.col("n") - c1))
    stat = F.when(dof == 0, 0.0).when(dof == 1, fixed * fixed * inverse).otherwise(F.col("n") * (F.col("q") - 1))
    out = one.select(stat.alias("chi2"), dof.cast("long").alias("dof"))
    return out.withColumn("p_value", F.when(F.col("dof") > 0, chi2_p_value("chi2", "dof")).otherwise(1.0)) if p_value else out


def expected_counts(df: DataFrame, row: str, col: str) -> DataFrame:
    """Observed and expected count of each cell that occurs."""
    cells = df.filter(F.col(row).isNotNull() & F.col(col).isNotNull()).groupBy(row, col).agg(F.count("*").alias("observed"))
    cells = materialize(cells, "cells")
    n = cells.agg(F.sum("observed").alias("_n"))
    r, c = (F.sum("observed").over(Window.partitionBy(k)) for k in (row, col))
    return one_row(cells, n).withColumn("expected", r * c / F.col("_n")).drop("_n")


def fisher_exact(df: DataFrame, a: str, b: str, p_value: bool = True) -> DataFrame:
    """Exact test of two boolean columns: sample odds ratio and two-sided p of (not, not), (not, yes), (yes, not), (yes, yes)."""
    x, y = F.col(a), F.col(b)
    t = df.agg(
        F.count_if(~x & ~y).alias("n00"), F.count_if(~x & y).alias("n01"), F.count_if(x & ~y).alias("n10"), F.count_if(x & y).alias("n11")
    )
    off = F.col("n01") * F.col("n10")
    ratio = F.when(off > 0, F.col("n00") * F.col("n11") / F.nullif(off, F.lit(0))).when(F.col("n00") * F.col("n11") > 0, float("inf"))
    out = t.withColumn("odds_ratio", ratio)
    return out.withColumn("p_value", fisher_p_value("n00", "n01", "n10", "n11")) if p_value else out


# Bins per bandwidth at least; bandwidths beyond which a kernel is zero in double precision.
_KDE_FINE = 8
_KDE_REACH = 39.0


def _binned(df: DataFrame, col: str, bins: int, extra: dict, fine: int = 0) -> DataFrame:
    """Sums per equal-width bin of ``col`` with the range of the column on each row.

    At most ``bins`` rows; with ``fine``, at most so many more that each Scott bandwidth holds ``fine`` bins.
    """
    x = F.col(col).cast("double")
    known = df.filter(x.isNotNull())
    ends = known.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count("*").alias("total"), F.stddev_samp(x).alias("sd"))
    bins = F.lit(bins)
    if fine:
        width = F.nullif(F.col("sd") * F.pow(F.col("total").cast("double"), F.lit(-0.2)), F.lit(0.0))
        bins = F.greatest(bins, F.ceil((F.col("hi") - F.col("lo")) / width * fine))
    spot = F.least(F.floor((x - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)) * bins), bins - 1)
    return (
        one_row(known, ends)
        .groupBy(F.coalesce(spot, F.lit(0)).cast("long").alias("bin"), "lo", "hi", "total", "sd")
        .agg(F.count("*").alias("n"), F.sum(x).alias("sx"), *[e.alias(k) for k, e in extra.items()])
    )


def kde_curve(df: DataFrame, col: str, grid: int = 200, bins: int = 1024) -> DataFrame:
    """Gaussian density on an even grid over the range, Scott bandwidth, from binned values at their bin means.

    There are at least ``bins`` bins, and as many as keep a bin within an eighth of the bandwidth. A bin meets the grid points
    at which its term is not zero in double precision.
    """
    b = materialize(_binned(df, col, bins, {}, _KDE_FINE), "bins")
    width = F.nullif(F.col("sd") * F.pow(F.col("total").cast("double"), F.lit(-0.2)), F.lit(0.0))
    step = (F.col("hi") - F.col("lo")) / (grid - 1)
    mean = F.col("sx") / F.col("n")
    reach = F.when(step > 0, _KDE_REACH * width / F.nullif(step, F.lit(0.0)))
    spot = F.when(step > 0, (mean - F.col("lo")) / F.nullif(step, F.lit(0.0)))
    first = F.coalesce(F.greatest(F.floor(spot - reach) - 1, F.lit(0)), F.lit(0)).cast("long")
    last = F.coalesce(F.least(F.ceil(spot + reach) + 1, F.lit(grid - 1)), F.lit(grid - 1)).cast("long")
    points = b.withColumn("point", F.explode(F.sequence(first, last)))
    at = F.col("lo") + F.col("point") * (F.col("hi") - F.col("lo")) / (grid - 1)
    z = (at - mean) / width
    term = F.col("n") * F.exp(-z * z / 2) / (F.col("total") * width * math.sqrt(2 * math.pi))
    points = points.select("point", at.alias("x"), term.alias("term"))
    # grid points out of reach of every row keep a density of zero
    every = b.select("lo", "hi", "sd", "total").distinct().withColumn("point", F.explode(F.expr(f"sequence(0L, {grid - 1}L)")))
    every = every.select("point", at.alias("x"), (width * 0.0).alias("term"))
    return points.unionByName(every).groupBy("point").agg(F.max("x").alias("x"), F.sum("term").alias("density"))


def local_trend(df: DataFrame, x: str, y: str, grid: int = 50, bins: int = 200, span: float = 2 / 3) -> DataFrame:
    """Local straight-line trend of y on x: an approximation of LOWESS without robustness steps.

    Per bin of x only count and sums are kept. At each grid point the nearest bins holding ``span`` of the rows get
    tricube weights by distance of their mean.
    """
    yy = F.col(y).cast("double")
    xx = F.col(x).cast("double")
    b = _binned(df.filter(yy.isNotNull()), x, bins, {"sy": F.sum(yy), "sxx": F.sum(xx * xx), "sxy": F.sum(xx * yy)})
    points = b.withColumn("point", F.explode(F.expr(f"sequence(0L, {grid - 1}L)")))
    at = F.col("lo") + F.col("point") * (F.col("hi") - F.col("lo")) / (grid - 1)
    points = points.withColumns({"x": at, "d": F.abs(F.col("sx") / F.col("n") - at)})
    near = Window.partitionBy("point").orderBy("d", "bin").rowsBetween(Window.unboundedPreceding, 0)
    points = points.withColumn("seen", F.sum("n").over(near))
    inside = F.col("seen") - F.col("n") < F.lit(span) * F.col("total")
    points = points.filter(inside).withColumn("h", F.max("d").over(Window.partitionBy("point")) * 1.0001)
    u = F.when(F.col("h") > 0, F.col("d") / F.nullif(F.col("h"), F.lit(0.0))).otherwise(0.0)
    w = F.pow(1 - u * u * u, F.lit(3.0))
    s = points.groupBy("point").agg(F.max("x").alias("x"), *[F.sum(w * F.col(c)).alias(f"w_{c}") for c in ("n", "sx", "sy", "sxx", "sxy")])
    W, X, Y, XX, XY = (F.col(f"w_{c}") for c in ("n", "sx", "sy", "sxx", "sxy"))
    flat = W * XX - X * X
    slope = F.when(F.abs(flat) > 1e-9 * W * XX, (W * XY - X * Y) / F.nullif(flat, F.lit(0.0))).otherwise(0.0)
    return s.select("point", "x", ((Y - slope * X) / W + slope * F.col("x")).alias("trend"))


def scatter_cells(df: DataFrame, x: str, y: str, cells: int = 1000, depth: int = 12, at_once: int = 4) -> DataFrame:
    """Counts of all rows in nested square cells: a cell with more than 1 / ``cells`` of the rows is cut in four, down to ``depth``
    cuts. Columns level, cx, cy (place at that level), x_low, x_high, y_low, y_high and n.

    Rows without x or y are counted under null cells, so the counts add up to the table. Each pass reads only rows of cells that
    are still too full, of which there are never more than ``cells``, and cuts ``at_once`` times.
    """
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    known = a.isNotNull() & b.isNotNull() & ~F.isnan(a) & ~F.isnan(b)
    lo_x, hi_x, lo_y, hi_y, n, total = df.agg(*[f(F.when(known, c)) for c in (a, b) for f in (F.min, F.max)], F.count_if(known), F.count("*")).first()
    spark, schema = df.sparkSession, "level int, cx long, cy long, n long"
    missing = spark.createDataFrame([(None, None, None, total - n)] if total > n else [], schema)
    if not n:
        found = missing
    else:
        limit, side = max(1, n // cells), 1 << depth

        def place(value: Column, low: float, high: float) -> Column:
            return F.least(F.floor((value - F.lit(low)) / F.lit(high - low) * F.lit(float(side))), F.lit(side - 1)).cast("long") if high > low else F.lit(0).cast("long")

        places = df.where(known).select(place(a, lo_x, hi_x).alias("cx"), place(b, lo_y, hi_y).alias("cy"))
        parts, level = [missing], 0
        full = spark.createDataFrame([(0, 0)] if n > limit else [], "px long, py long")
        if n <= limit:
            parts.append(spark.createDataFrame([(0, 0, 0, n)], schema))
        while level < depth and not full.isEmpty():
            last = min(depth, level + at_once)
            up, down = depth - level, depth - last
            inside = places.withColumns({"px": F.shiftright("cx", up), "py": F.shiftright("cy", up)}).join(F.broadcast(full), ["px", "py"], "left_semi")
            counts = materialize(inside.groupBy(F.shiftright("cx", down).alias("cx"), F.shiftright("cy", down).alias("cy")).agg(F.count("*").alias("n")), "cells")
            for cut in range(level + 1, last + 1):
                rise = last - cut
                own = counts.groupBy(F.shiftright("cx", rise).alias("cx"), F.shiftright("cy", rise).alias("cy")).agg(F.sum("n").alias("n"))
                own = own.withColumns({"px": F.shiftright("cx", 1), "py": F.shiftright("cy", 1)}).join(F.broadcast(full), ["px", "py"], "left_semi")
                own = materialize(own.select(F.lit(cut).alias("level"), "cx", "cy", "n"), "cells")
                ends = F.lit(True) if cut == depth else F.col("n") <= limit
                parts.append(own.where(ends))
                full = own.where(~ends).select(F.col("cx").alias("px"), F.col("cy").alias("py"))
            level = last
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)

    def edge(low: float | None, high: float | None, at: Column) -> Column:
        return F.lit(low).cast("double") + F.lit((high or 0.0) - (low or 0.0)) * at / F.pow(F.lit(2.0), F.col("level"))

    return found.select(
        "level", "cx", "cy", edge(lo_x, hi_x, F.col("cx")).alias("x_low"), edge(lo_x, hi_x, F.col("cx") + 1).alias("x_high"),
        edge(lo_y, hi_y, F.col("cy")).alias("y_low"), edge(lo_y, hi_y, F.col("cy") + 1).alias("y_high"), "n",
    )
