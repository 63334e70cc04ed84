"""Scaling, target and label encoding, imputation, feature scores."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.operators.quantiles import medians
from tarmac.operators.sampling import SEED, kfold_assign
from tarmac.operators.stats import correlation
from tarmac.plans.lookup import lookup_join
from tarmac.plans.ordering import global_index
from tarmac.plans.storage import materialize


def standardize(df: DataFrame, cols: list[str], basis: DataFrame | None = None) -> DataFrame:
    """Zero mean and unit population deviation, measured on ``basis``; a constant column becomes 0."""
    basis = df if basis is None else basis
    fit = basis.agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()

    def scaled(c: str) -> Column:
        mean, dev = fit[f"m_{c}"], fit[f"s_{c}"]
        if mean is None:
            return F.lit(None).cast("double")
        return (F.col(c) - F.lit(mean)) / F.lit(dev if dev else 1.0)

    return df.withColumns({c: scaled(c) for c in cols})


def _encode(n: Column, s: Column, ss: Column, all_n: Column, all_s: Column, all_ss: Column, smooth: float | str) -> Column:
    mean_y, mean_c = all_s / all_n, s / n
    if smooth == "auto":
        var_y = all_ss / all_n - mean_y * mean_y
        var_c = F.greatest(ss / n - mean_c * mean_c, F.lit(0.0))
        weight = var_y * n / (var_y * n + var_c)
        return F.when((n == 0) | (var_y <= 0), mean_y).otherwise(weight * mean_c + (1 - weight) * mean_y)
    return (s + F.lit(float(smooth)) * mean_y) / (n + F.lit(float(smooth)))


def target_encode(
    train: DataFrame,
    test: DataFrame,
    cols: list[str],
    target: str,
    ids: list[str],
    folds: int = 5,
    smooth: float | str = "auto",
    stratify: bool = True,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """Replace category columns by smoothed target means.

    A train row gets the means of the other folds; a test row those of all train rows; an unseen category the overall
    mean. Counts and sums per (column, category, fold) come from one map-side combined pass over train.
    """
    per = [target] if stratify else []
    folded = materialize(kfold_assign(train, folds, ids, per, seed, "_fold"), "folds")
    y = F.col(target)
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in cols])
    sums = (
        folded.select("_fold", y.alias("_y"), F.explode(pairs).alias("p"))
        .groupBy("p.feature", "p.category", "_fold")
        .agg(F.count("_y").alias("n"), F.sum("_y").alias("s"), F.sum(F.col("_y") * F.col("_y")).alias("ss"))
    )
    sums = materialize(sums, "category-sums")
    # overall counts and sums per fold: at most one row per fold on the driver
    per_fold = sums.filter(F.col("feature") == cols[0]).groupBy("_fold").agg(F.sum("n"), F.sum("s"), F.sum("ss")).collect()
    whole = [float(sum(r[i] for r in per_fold)) for i in (1, 2, 3)]
    rest = {r[0]: [w - float(r[i]) for i, w in zip((1, 2, 3), whole)] for r in per_fold}

    names = ("n", "s", "ss")
    category = Window.partitionBy("feature", "category")
    left = {f"_{c}": F.sum(c).over(category) - F.col(c) for c in names}

    def pick(values: dict[int, float]) -> Column:
        out = F
        for fold, v in values.items():
            out = out.when(F.col("_fold") == fold, F.lit(v))
        return out

    others = [pick({f: v[i] for f, v in rest.items()}) for i in range(3)]
    cross = sums.withColumns(left)
    cross = cross.withColumn("_enc", _encode(F.col("_n"), F.col("_s"), F.col("_ss"), *others, smooth))
    cross = materialize(cross.select("feature", "category", "_fold", "_enc"), "encoding-train")
    full = sums.groupBy("feature", "category").agg(*[F.sum(c).alias(c) for c in names])
    full = full.withColumn("_enc", _encode(F.col("n"), F.col("s"), F.col("ss"), *[F.lit(w) for w in whole], smooth))
    full = materialize(full.select("feature", "category", "_enc"), "encoding-test")

    def apply(df: DataFrame, table: DataFrame, keys: list[str], default: Column) -> DataFrame:
        for c in cols:
            values = table.filter(F.col("feature") == c).drop("feature").withColumnRenamed("category", "_cat")
            df = lookup_join(df.withColumn("_cat", F.col(c).cast("string")), values, ["_cat", *keys])
            df = df.withColumn(c, F.coalesce("_enc", default)).drop("_cat", "_enc")
        return df

    fold_mean = pick({f: v[1] / v[0] for f, v in rest.items()}) if rest else F.lit(None)
    overall = F.lit(whole[1] / whole[0] if whole[0] else None)
    return (
        apply(folded, cross, ["_fold"], fold_mean).select(*train.columns),
        apply(test, full, [], overall).select(*test.columns),
    )


def label_encode(df: DataFrame, col: str, name: str) -> DataFrame:
    """0-based number of the label in sorted order."""
    labels = df.select(col).filter(F.col(col).isNotNull()).distinct()
    return lookup_join(df, materialize(global_index(labels, [F.col(col)], name), "labels"), [col])


def median_impute(train: DataFrame, test: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """Fill both tables with the exact medians of train."""
    fill = {c: v for c, v in medians(train, cols).items() if v is not None}
    return train.fillna(fill), test.fillna(fill)


def select_k_best(df: DataFrame, features: list[str], target: str, k: int = 10) -> DataFrame:
    """The k features with the largest univariate F score over their complete pairs; null for constants, infinite for r = 1."""
    pairs = {c: F.count_if(F.col(c).isNotNull() & F.col(target).isNotNull()) for c in features}
    stats = df.agg(*[F.struct(correlation(F.col(c), F.col(target)).alias("r"), n.alias("n")).alias(c) for c, n in pairs.items()])
    long = stats.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`.r").alias("r"), F.col(f"`{c}`.n").alias("n")) for c in features])).alias("x"))
    r2 = F.col("x.r") * F.col("x.r")
    score = long.select("x.feature", F.when(r2 == 1, F.lit(float("inf"))).otherwise(r2 / F.nullif(1 - r2, F.lit(0.0)) * (F.col("x.n") - 2)).alias("f_score"))
    return score.orderBy(F.col("f_score").desc_nulls_last(), "feature").limit(k)


def poly_features(df: DataFrame, cols: list[str]) -> DataFrame:
    """All products up to degree 2: ``bias``, ``a``, ``a_b``, ..."""
    products = {f"{a}_{b}": F.col(a) * F.col(b) for a, b in combinations_with_replacement(cols, 2)}
    return df.withColumns({"bias": F.lit(1.0), **products})
