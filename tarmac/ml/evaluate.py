"""Metrics, curves and importances of predictions in long form: (model, label, prediction, score)."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.operators.explore import top_per_group
from tarmac.operators.sampling import hash_key
from tarmac.plans.lookup import one_row
from tarmac.plans.ordering import block_rows, global_index, totals_along, with_halo
from tarmac.plans.storage import materialize


def _ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 when undefined."""
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def clf_metrics(preds: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1 per model, in one aggregation."""
    y, p = F.col("label") == 1, F.col("prediction") == 1
    c = preds.groupBy("model").agg(
        F.count("*").alias("n"), F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(F.col("label") == F.col("prediction")).alias("ok"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select(
        "model", (F.col("ok") / F.col("n")).alias("accuracy"), _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"), _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def confusion_matrix(preds: DataFrame) -> DataFrame:
    """All four cells per model, with the smallest and largest count over all models."""
    y, p = F.col("label"), F.col("prediction")
    cells = [(a, b) for a in (0, 1) for b in (0, 1)]
    c = preds.groupBy("model").agg(*[F.count_if((y == a) & (p == b)).alias(f"c{a}{b}") for a, b in cells])
    rows = [F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(f"c{a}{b}").alias("n")) for a, b in cells]
    long = materialize(c.select("model", F.explode(F.array(*rows)).alias("x")).select("model", "x.*"), "confusion")
    return one_row(long, long.agg(F.min("n").alias("min_n"), F.max("n").alias("max_n")))


def class_report(preds: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per model and class, with macro and weighted averages."""
    cells = preds.groupBy("model", "label", "prediction").agg(F.count("*").alias("n"))
    both = cells.select("model", F.explode(F.array(
        F.struct(F.col("label").alias("cls"), F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("said")),
        F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("said")),
    )).alias("x")).select("model", "x.*")
    s = both.groupBy("model", "cls").agg(*[F.sum(c).alias(c) for c in ("hit", "actual", "said")])
    per = s.select(
        "model", F.col("cls").cast("int").cast("string").alias("cls"), _ratio(F.col("hit"), F.col("said")).alias("precision"),
        _ratio(F.col("hit"), F.col("actual")).alias("recall"),
        _ratio(2 * F.col("hit"), F.col("said") + F.col("actual")).alias("f1"), F.col("actual").alias("support"),
    )
    per = materialize(per, "class-report")
    names = ("precision", "recall", "f1")
    macro = per.groupBy("model").agg(*[F.avg(c).alias(c) for c in names], F.sum("support").alias("support"))
    heavy = [(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c) for c in names]
    weighted = per.groupBy("model").agg(*heavy, F.sum("support").alias("support"))
    out = per.unionByName(macro.withColumn("cls", F.lit("macro avg")))
    return out.unionByName(weighted.withColumn("cls", F.lit("weighted avg")))


def _score_counts(preds: DataFrame, corners: bool = False) -> DataFrame:
    """Rows of both classes at or above each distinct score, and the class totals, per model; with ``corners`` also ``_turns``:
    whether the next smaller score adds other numbers of both classes than this one, or there is none."""
    counts = preds.groupBy("model", "score").agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"))
    counts = materialize(counts, "score-counts")
    indexed = global_index(counts, [F.col("model").asc_nulls_last(), F.col("score").desc()])
    if corners:
        # the next row of a block's last one stands in the block after it: a halo along the order from the end
        indexed = materialize(indexed.withColumn("_back", F.lit(counts.count() - 1) - F.col("gidx")), "score-places")
        length = block_rows(indexed)
        following = Window.partitionBy("_block", "model").orderBy("_back")
        turned = with_halo(indexed, length, 1, "_back").withColumns({c: F.lag(c[3:]).over(following) for c in ("_n_pos", "_n_neg")})
        turns = ~(F.col("_n_pos").eqNullSafe(F.col("pos")) & F.col("_n_neg").eqNullSafe(F.col("neg")))
        indexed = turned.where("_own").select("model", "score", "pos", "neg", "gidx", turns.alias("_turns"))
    run = totals_along(indexed, {"tp": "pos", "fp": "neg"}, ["model"])
    totals = counts.groupBy("model").agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    return run.join(F.broadcast(totals), "model")


def roc_curve(preds: DataFrame, corners: bool = True) -> DataFrame:
    """Points by distinct score (ties together), from the largest down, and the start (0, 0) with a null score. A rate whose
    class is absent is null. Of points that follow each other in equal steps only the ends are kept, unless ``corners`` is
    false; the first and last score always have a point, and the area is the same."""
    pts = _score_counts(preds, corners)
    if corners:
        pts = pts.where(F.col("_turns") | ((F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))))
    pts = pts.select("model", "score", (F.col("fp") / F.nullif(F.col("all_neg"), F.lit(0))).alias("fpr"), (F.col("tp") / F.nullif(F.col("all_pos"), F.lit(0))).alias("tpr"))
    start = preds.select("model").distinct().select("model", F.lit(None).cast("double").alias("score"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(pts)


def roc_auc(preds: DataFrame) -> DataFrame:
    """Area under the curve: negatives of each score times the positives above it, ties counted half."""
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    return _score_counts(preds).groupBy("model").agg((area / F.nullif(F.max("all_pos") * F.max("all_neg").cast("double"), F.lit(0.0))).alias("auc"))


def reg_metrics(preds: DataFrame) -> DataFrame:
    e = F.col("label") - F.col("prediction")
    return preds.groupBy("model").agg(
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        (1 - F.sum(e * e) / F.nullif(F.count("label") * F.var_pop("label"), F.lit(0.0))).alias("r2"),
    )


def residuals(preds: DataFrame) -> DataFrame:
    return preds.withColumn("residual", F.col("label") - F.col("prediction"))


def baseline_improvement(preds: DataFrame, train_mean: DataFrame) -> DataFrame:
    """MAE and RMSE beside those of always predicting the train mean (one row, column ``mean``), and percent gained."""
    e = F.col("label") - F.col("prediction")
    b = F.col("label") - F.col("mean")
    m = one_row(preds, train_mean.select("mean")).groupBy("model").agg(
        F.avg(F.abs(e)).alias("mae"), F.avg(F.abs(b)).alias("mae_base"),
        F.sqrt(F.avg(e * e)).alias("rmse"), F.sqrt(F.avg(b * b)).alias("rmse_base"),
    )
    gain = {f"{c}_gain": (1 - F.col(c) / F.nullif(F.col(f"{c}_base"), F.lit(0.0))) * 100 for c in ("mae", "rmse")}
    return m.withColumns(gain)


def permutation_importance(model: Model, name: str, data: DataFrame, features: list[str], kind: str, ids: list[str], repeats: int = 5, seed: int = 42) -> DataFrame:
    """Mean loss of score (accuracy or R2) when one feature is shuffled, per feature.

    Rows get their places in one hash order. Repeat t gives each row the feature of the row ``shift`` places further on, around
    the end, with shifts spread evenly over the table; so one sort and one join serve all repeats. All features and repeats go
    through the model as one long table, with one grouped metric.
    """
    key = [F.col(c).asc_nulls_last() for c in ids]
    rows = data.select("label", vector_to_array("features").alias("_x"), *ids).withColumn("_h", hash_key(ids, seed))
    rows = global_index(rows, [F.col("_h"), *key], "_row").select("_row", "label", "_x")
    n = rows.count()
    shifts = [1 + int((t + 0.5) * (n - 1) / repeats) if n > 1 else 0 for t in range(repeats)]
    places = F.array(*[F.struct(F.lit(t).alias("repeat"), F.pmod(F.col("_row") - F.lit(s), F.lit(max(n, 1))).alias("_row")) for t, s in enumerate(shifts)])
    donors = rows.select(F.explode(places).alias("_p"), F.col("_x").alias("_d")).select("_p.repeat", "_p._row", "_d")
    long = donors.join(rows, "_row")
    # feature -1 is the unchanged row, whose score is the reference point
    which = F.expr(f"sequence(-1, {len(features) - 1})")
    long = long.withColumn("f", F.explode(which))
    mixed = F.transform("_x", lambda x, i: F.when(i == F.col("f"), F.element_at(F.col("_d"), i + 1)).otherwise(x))
    scored = model.transform(long.select("repeat", "f", "label", array_to_vector(mixed).alias("features")))
    y, p = F.col("label"), F.col("prediction")
    score = F.avg((y == p).cast("double")) if kind == "clf" else 1 - F.sum((y - p) * (y - p)) / (F.count("*") * F.var_pop("label"))
    scores = materialize(scored.groupBy("repeat", "f").agg(score.alias("score")), "importance")
    whole = scores.filter("f = -1").select("repeat", F.col("score").alias("whole"))
    drop = scores.filter("f >= 0").join(F.broadcast(whole), "repeat").groupBy("f").agg(F.avg(F.col("whole") - F.col("score")).alias("importance"))
    names = F.array(*[F.lit(f) for f in features])
    return drop.select(F.lit(name).alias("model"), F.element_at(names, F.col("f") + 1).alias("feature"), "importance")


def importance_table(importances: list[DataFrame]) -> DataFrame:
    """Features by models with the mean importance and its average-tie rank, largest first (one row per feature)."""
    long = importances[0]
    for df in importances[1:]:
        long = long.unionByName(df)
    long = materialize(long, "importances")
    models = [r[0] for r in long.select("model").distinct().orderBy("model").collect()]
    wide = long.groupBy("feature").agg(*[F.max(F.when(F.col("model") == m, F.col("importance"))).alias(m) for m in models], F.avg("importance").alias("mean_importance"))
    order = Window.orderBy(F.desc("mean_importance"))
    ties = F.count("*").over(Window.partitionBy("mean_importance"))
    return wide.withColumn("rank", F.rank().over(order) + (ties - 1) / 2).orderBy("rank", "feature")


def top_features(importances: DataFrame, k: int = 5) -> DataFrame:
    """The k most important features per model, side by side: one row per place, one column per model."""
    best = top_per_group(importances, ["model"], "importance", ["feature"], k)
    models = [r[0] for r in importances.select("model").distinct().orderBy("model").collect()]
    return best.groupBy("place").agg(*[F.max(F.when(F.col("model") == m, F.col("feature"))).alias(m) for m in models]).orderBy("place")
