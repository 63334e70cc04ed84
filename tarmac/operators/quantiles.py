"""Exact percentiles (linear interpolation) without gathering a column in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.plans.lookup import lookup_join
from tarmac.plans.ordering import running_totals
from tarmac.plans.storage import materialize

ACCURACY = 10_000
MARGIN = 4
ONE_TASK_VALUES = 2_000_000


def exact_quantiles(
    df: DataFrame,
    cols: list[str],
    probs: list[float],
    by: list[str] | None = None,
    accuracy: int = ACCURACY,
    one_task: int = ONE_TASK_VALUES,
) -> DataFrame:
    """One row per group, column and probability: ``feature``, ``p``, ``n`` (non-null) and the percentile ``q``.

    First pass: a mergeable sketch brackets each wanted rank; its rank error is a small fraction of the bracket's margin,
    and small groups get their whole range. Second pass: only values inside the bracket are counted by value and ranked,
    so a few rows in ten thousand are shuffled. When that can still be more than ``one_task`` values for one rank, they are
    ranked in even blocks instead of one window. A bracket that missed its rank would raise, never give a wrong value.
    """
    by = by or []
    long = _long(df, cols, by)
    edges = sorted({e for p in probs for e in (max(0.0, p - MARGIN / accuracy), min(1.0, p + MARGIN / accuracy))})
    sketch = long.groupBy(*by, "feature").agg(
        F.count("*").alias("n"),
        F.min("v").alias("_min"),
        F.max("v").alias("_max"),
        F.percentile_approx("v", edges, accuracy).alias("_e"),
    )
    small = F.col("n") <= 10 * accuracy
    parts = []
    for p in probs:
        low, high = max(0.0, p - MARGIN / accuracy), min(1.0, p + MARGIN / accuracy)
        a = F.when(small | F.lit(low == 0.0), F.col("_min")).otherwise(F.col("_e")[edges.index(low)])
        b = F.when(small | F.lit(high == 1.0), F.col("_max")).otherwise(F.col("_e")[edges.index(high)])
        rank = F.lit(float(p)) * (F.col("n") - 1)
        parts.append(F.struct(F.lit(float(p)).alias("p"), a.alias("a"), b.alias("b"), rank.alias("r")))
    sketch = materialize(sketch.select(*by, "feature", "n", F.array(*parts).alias("_w")), "brackets")

    # all counts of one pass: values below the bracket once per wanted rank, values inside by value
    hits = lookup_join(long, _null_safe(sketch, by), [*_safe(by), "feature"], "inner") if by else long.join(F.broadcast(sketch), "feature")
    hits = hits.withColumn("_x", F.explode("_w")).filter(F.col("v") <= F.col("_x.b"))
    inside = F.when(F.col("v") >= F.col("_x.a"), F.col("v"))
    counts = hits.groupBy(*by, "feature", "n", "_x", inside.alias("value")).agg(F.count("*").alias("c"))
    by_value = [F.col("value").asc_nulls_first()]
    most = sketch.agg(F.max("n")).first()[0] or 0
    if most * 2 * MARGIN / accuracy > one_task:
        ranked = running_totals(counts, by_value, {"_run": "c"}, [*by, "feature", "_x"])
    else:
        order = Window.partitionBy(*by, "feature", "_x").orderBy(*by_value)
        ranked = counts.withColumn("_run", F.sum("c").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    first, last = F.col("_run") - F.col("c"), F.col("_run") - 1
    low_rank, high_rank = F.floor("_x.r"), F.ceil("_x.r")

    def at(rank):
        return F.max(F.when((first <= rank) & (rank <= last), F.col("value")))

    picked = ranked.groupBy(*by, "feature", "n", "_x").agg(at(low_rank).alias("_lo"), at(high_rank).alias("_hi"))
    share = F.col("_x.r") - F.floor("_x.r")
    value = F.when(F.col("_lo").isNull() | F.col("_hi").isNull(), F.raise_error(F.lit("percentile bracket missed its rank")))
    value = value.otherwise(F.col("_lo") + share * (F.col("_hi") - F.col("_lo")))
    return picked.select(*by, "feature", F.col("_x.p").alias("p"), "n", value.alias("q"))


def _long(df: DataFrame, cols: list[str], by: list[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols])
    out = df.select(*by, F.explode(pairs).alias("_p")).select(*by, "_p.feature", "_p.v").filter("v IS NOT NULL AND NOT isnan(v)")
    return out.withColumns({s: F.struct(b) for s, b in zip(_safe(by), by)}) if by else out


def _safe(by: list[str]) -> list[str]:
    return [f"_k_{b}" for b in by]


def _null_safe(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Group keys as structs, which match on null too."""
    return sketch.withColumns({s: F.struct(b) for s, b in zip(_safe(by), by)}).drop(*by)


def quantile_map(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, dict[float, float]]:
    """The percentiles of whole columns on the driver: one number per column and probability."""
    out: dict[str, dict[float, float]] = {c: {} for c in cols}
    for row in exact_quantiles(df, cols, probs).collect():
        out[row["feature"]][row["p"]] = row["q"]
    return out


def medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    return {c: v.get(0.5) for c, v in quantile_map(df, cols, [0.5]).items()}
