"""Exploration: grouped counts, summaries, imputation, outliers, histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.operators.quantiles import exact_quantiles, medians, quantile_map
from tarmac.plans.lookup import lookup_join, one_row
from tarmac.plans.ordering import running_totals
from tarmac.plans.storage import materialize

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def count_by(df: DataFrame, key: str, column: str, name: str = "n") -> DataFrame:
    """Non-null values of ``column`` per key."""
    return df.groupBy(key).agg(F.count(column).alias(name))


def sum_numeric(df: DataFrame, key: str) -> DataFrame:
    """Sum of every numeric column per key."""
    return df.groupBy(key).agg(*[F.sum(c).alias(c) for c in numeric_columns(df) if c != key])


def mean_median_sum(df: DataFrame, keys: list[str], full: list[str], plain: list[str]) -> DataFrame:
    """Mean and sum of all listed columns per group, and the exact median of those in ``full``.

    The columns are written once, as the percentiles read them twice more: what ``df`` joins or shuffles is not done again.
    """
    df = materialize(df.select(*dict.fromkeys([*keys, *full, *plain])), "measured")
    wanted = [f(c).alias(f"{c}_{n}") for c in [*full, *plain] for n, f in (("mean", F.avg), ("sum", F.sum))]
    base = df.groupBy(*keys).agg(*wanted)
    mids = exact_quantiles(df, full, [0.5], keys)
    wide = mids.groupBy(*keys).agg(*[F.max(F.when(F.col("feature") == c, F.col("q"))).alias(f"{c}_median") for c in full])
    right = wide.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[f"{c}_median" for c in full])
    cond = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return base.join(right, cond, "left").drop(*[f"_r_{k}" for k in keys])


def crosstab(df: DataFrame, row: str, col: str, values: list) -> DataFrame:
    """Contingency table with one column per value of ``col`` (a fixed list saves a distinct job); absent cells are 0."""
    cells = [F.count_if(F.col(col) == v).alias(f"{col}_{v}") for v in values]
    return df.groupBy(row).agg(*cells)


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column: count, mean, sample deviation, min, exact quartiles, max."""
    fields = (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
    stats = df.agg(*[fn(F.col(c).cast("double")).alias(f"{c}__{n}") for c in cols for n, fn in fields])
    long = stats.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("feature"), *[F.col(f"{c}__{n}").alias(n) for n, _ in fields]) for c in cols])
        ).alias("x")
    ).select("x.*")
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75]).groupBy("feature")
    q = q.agg(*[F.max(F.when(F.col("p") == p, F.col("q"))).alias(n) for n, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))])
    return long.join(q, "feature", "left")


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values and type per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = [F.struct(F.lit(c).alias("feature"), F.lit(t).alias("type"), F.col(c).alias("nulls")) for c, t in df.dtypes]
    return counts.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def modes(df: DataFrame, cols: list[str]) -> dict[str, str | None]:
    """Most frequent value per text column, the smallest on ties; counted by value, so no task sees all values."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("v")) for c in cols])
    counts = df.select(F.explode(pairs).alias("p")).filter("p.v IS NOT NULL").groupBy("p.feature", "p.v").count()
    best = counts.groupBy("feature").agg(F.min(F.struct((-F.col("count")).alias("n"), "v")).alias("b"))
    return {r["feature"]: r["b"]["v"] for r in best.collect()}


def impute_mode_median(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Fill text columns with their mode and numeric ones with their exact median."""
    cols = cols or df.columns
    text = [c for c in text_columns(df) if c in cols]
    numbers = [c for c in numeric_columns(df) if c in cols]
    fill = {**(modes(df, text) if text else {}), **(medians(df, numbers) if numbers else {})}
    return df.fillna({c: v for c, v in fill.items() if v is not None})


def cap_outliers(df: DataFrame, cols: list[str], low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Pull values outside the two exact percentiles to them; nulls stay. ``df`` is written once, as it is read three times."""
    df = materialize(df, "uncapped")
    limits = quantile_map(df, cols, [low, high])

    def capped(c: str) -> Column:
        if low not in limits[c]:
            return F.col(c).cast("double")
        inner = F.greatest(F.least(F.col(c).cast("double"), F.lit(limits[c][high])), F.lit(limits[c][low]))
        return F.when(F.col(c).isNotNull(), inner)

    return df.withColumns({c: capped(c) for c in cols})


def nunique(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct values per column: one row per (column, value) first, then a count, so columns share one shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("v")) for c in cols])
    seen = df.select(F.explode(pairs).alias("p")).filter("p.v IS NOT NULL").select("p.*").distinct()
    return seen.groupBy("feature").agg(F.count("*").alias("n"))


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias(name)).orderBy(F.desc(name), F.col(col).asc_nulls_last())


def minmax_norm(df: DataFrame, col: str, name: str) -> DataFrame:
    """Scale a column to 0..1 over the whole table."""
    ends = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    scaled = (F.col(col) - F.col("_lo")) / F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0))
    return one_row(df, ends).withColumn(name, scaled).drop("_lo", "_hi")


def zscore_totals(df: DataFrame, key: str, col: str, name: str) -> DataFrame:
    """Total per key and its z-score over the keys (sample deviation)."""
    totals = materialize(df.groupBy(key).agg(F.sum(col).alias("total")), "totals")
    fit = totals.agg(F.avg("total").alias("_m"), F.stddev_samp("total").alias("_s"))
    return one_row(totals, fit).withColumn(name, (F.col("total") - F.col("_m")) / F.nullif(F.col("_s"), F.lit(0.0))).drop("_m", "_s")


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last one closed; empty bins are listed."""
    x = F.col(col).cast("double")
    ends = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).withColumn("w", (F.col("hi") - F.col("lo")) / bins)
    spot = F.when(F.col("w") > 0, F.least(F.floor((x - F.col("lo")) / F.col("w")), F.lit(bins - 1))).otherwise(0)
    counts = one_row(df.filter(x.isNotNull()).select(col), ends).groupBy(spot.cast("long").alias("bin")).agg(F.count("*").alias("n"))
    frame = ends.select("lo", "w", F.explode(F.expr(f"sequence(0L, {bins - 1}L)")).alias("bin"))
    out = frame.join(counts, "bin", "left")
    low = F.col("lo") + F.col("bin") * F.col("w")
    return out.select("bin", low.alias("low"), (low + F.col("w")).alias("high"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def box_stats(df: DataFrame, col: str, whisker: float = 1.5) -> DataFrame:
    """Quartiles, the farthest values inside the fences, and the number of values outside."""
    q = quantile_map(df, [col], [0.25, 0.5, 0.75])[col]
    if not q:
        return df.limit(0).select(*[F.lit(0.0).alias(n) for n in ("q1", "median", "q3", "low", "high")], F.lit(0).cast("long").alias("outliers"))
    q1, q2, q3 = q[0.25], q[0.5], q[0.75]
    x = F.col(col).cast("double")
    inside = (x >= q1 - whisker * (q3 - q1)) & (x <= q3 + whisker * (q3 - q1))
    return df.agg(
        F.lit(q1).alias("q1"),
        F.lit(q2).alias("median"),
        F.lit(q3).alias("q3"),
        F.min(F.when(inside, x)).alias("low"),
        F.max(F.when(inside, x)).alias("high"),
        F.count_if(~inside).alias("outliers"),
    )


def rank_average(df: DataFrame, value: str, per: list[str], name: str = "rank") -> DataFrame:
    """Descending rank per group, ties share their average rank; a null value has none.

    Ranks come from running counts over distinct values in even blocks, so a group may be of any size.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*per, value).agg(F.count("*").alias("_m"))
    run = running_totals(counts, [F.col(value).desc()], {"_run": "_m"}, per)
    ranks = run.select(*per, value, (F.col("_run") - (F.col("_m") - 1) / 2).alias(name))
    return lookup_join(df, materialize(ranks, "ranks"), [*per, value])


def top_per_group(df: DataFrame, per: list[str], value: str, tie: list[str], k: int = 5) -> DataFrame:
    """The k largest rows per group with their place; the row limit is pushed below the shuffle by Spark."""
    order = Window.partitionBy(*per).orderBy(F.col(value).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie])
    return df.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def to_numeric_columns(df: DataFrame) -> DataFrame:
    """Cast each text column to double when every value converts; others stay text."""
    text = text_columns(df)
    if not text:
        return df
    bad = df.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).alias(c) for c in text]).first()
    return df.withColumns({c: F.col(c).cast("double") for c in text if bad[c] == 0})


def parse_date_lenient(value: str, fmt: str = "yyyyMMdd") -> Column:
    """Day of a text, null when it is not one."""
    return F.try_to_timestamp(F.col(value), F.lit(fmt)).cast("date")


def map_counts(df: DataFrame, key: str, name: str) -> DataFrame:
    counts = materialize(df.groupBy(key).agg(F.count("*").alias(name)), "counts")
    return lookup_join(df, counts, [key])
