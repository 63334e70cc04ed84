"""Metrics and curves over predictions of two simple rules on all flights."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.catalog.base import R, VIEWS, query, r6
from tarmac.ml import evaluate as ev
from tarmac.sources import demo

ID = ", ".join(demo.ROW_ID)

VIEWS["preds"] = """
SELECT 'distance' AS model, DepDel15 AS label, CASE WHEN Distance > 1500 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, floor(Distance / 10) AS score
FROM flights WHERE DepDel15 IS NOT NULL
UNION ALL SELECT 'airtime', DepDel15, CASE WHEN AirTime > 250 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END, AirTime + ln FROM flights WHERE DepDel15 IS NOT NULL"""
VIEWS["values_pred"] = f"""
SELECT {ID}, 'arrival' AS model, DepDelayMinutes AS label, ArrDelayMinutes AS prediction FROM flights WHERE DepDelayMinutes IS NOT NULL
UNION ALL SELECT {ID}, 'airtime', DepDelayMinutes, AirTime / 8 FROM flights WHERE DepDelayMinutes IS NOT NULL"""


def class_predictions(spark, sf):
    df = demo.flights(spark, sf).filter("DepDel15 IS NOT NULL")
    rules = F.array(
        F.struct(F.lit("distance").alias("model"), (F.col("Distance") > 1500).cast("double").alias("prediction"), F.floor(F.col("Distance") / 10).cast("double").alias("score")),
        F.struct(F.lit("airtime").alias("model"), (F.col("AirTime") > 250).cast("double").alias("prediction"), (F.col("AirTime") + F.col("ln")).alias("score")),
    )
    return df.select(F.col("DepDel15").alias("label"), F.explode(rules).alias("x")).select("x.model", "label", "x.prediction", "x.score")


def value_predictions(spark, sf):
    df = demo.flights(spark, sf).filter("DepDelayMinutes IS NOT NULL")
    rules = F.array(
        F.struct(F.lit("arrival").alias("model"), F.col("ArrDelayMinutes").alias("prediction")),
        F.struct(F.lit("airtime").alias("model"), (F.col("AirTime") / 8).alias("prediction")),
    )
    return df.select(*demo.ROW_ID, F.col("DepDelayMinutes").alias("label"), F.explode(rules).alias("x")).select(*demo.ROW_ID, "x.model", "label", "x.prediction")


_TP, _FP = "count(*) FILTER (WHERE label = 1 AND prediction = 1)::DOUBLE", "count(*) FILTER (WHERE label = 0 AND prediction = 1)"
_FN, _OK = "count(*) FILTER (WHERE label = 1 AND prediction = 0)", "count(*) FILTER (WHERE label = prediction)::DOUBLE"


@query(
    "clf_metrics",
    f"""SELECT model, {R(f'{_OK} / count(*)', 'accuracy')}, {R(f'{_TP} / ({_TP} + {_FP})', 'precision')}, {R(f'{_TP} / ({_TP} + {_FN})', 'recall')},
  {R(f'2 * {_TP} / (2 * {_TP} + {_FP} + {_FN})', 'f1')} FROM preds GROUP BY model""",
)
def clf_metrics(spark, sf):
    return r6(ev.clf_metrics(class_predictions(spark, sf)), "accuracy", "precision", "recall", "f1")


@query(
    "confusion_matrix",
    """
WITH k AS (SELECT CAST(a AS INT) AS actual, CAST(p AS INT) AS predicted FROM range(2) x(a), range(2) y(p)),
c AS (SELECT model, actual, predicted, count(*) FILTER (WHERE label = actual AND prediction = predicted) AS n FROM preds, k GROUP BY ALL)
SELECT *, min(n) OVER () AS min_n, max(n) OVER () AS max_n FROM c""",
)
def confusion_matrix(spark, sf):
    return ev.confusion_matrix(class_predictions(spark, sf))


def _class_sql(k: int) -> str:
    hit, said, act = (f"count(*) FILTER (WHERE {w})::DOUBLE" for w in (f"label = {k} AND prediction = {k}", f"prediction = {k}", f"label = {k}"))
    return f"SELECT model, '{k}' AS cls, {hit} / {said} AS p, {hit} / {act} AS r, 2 * {hit} / ({said} + {act}) AS f, {act}::BIGINT AS s FROM preds GROUP BY model"


@query(
    "class_report",
    f"""
WITH c AS ({_class_sql(0)} UNION ALL {_class_sql(1)}),
a AS (SELECT * FROM c
  UNION ALL SELECT model, 'macro avg', avg(p), avg(r), avg(f), sum(s)::BIGINT FROM c GROUP BY model
  UNION ALL SELECT model, 'weighted avg', sum(p * s) / sum(s), sum(r * s) / sum(s), sum(f * s) / sum(s), sum(s)::BIGINT FROM c GROUP BY model)
SELECT model, cls, {R('p', 'precision')}, {R('r', 'recall')}, {R('f', 'f1')}, s AS support FROM a""",
)
def class_report(spark, sf):
    return r6(ev.class_report(class_predictions(spark, sf)), "precision", "recall", "f1")


_RUN = """c AS (SELECT model, score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM preds GROUP BY ALL),
r AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY model) AS all_pos, sum(neg) OVER (PARTITION BY model) AS all_neg
  FROM c WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@query(
    "roc_curve",
    f"""
WITH {_RUN},
k AS (SELECT *, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg, row_number() OVER w AS i FROM r WINDOW w AS (PARTITION BY model ORDER BY score DESC))
SELECT model, score, {R('fp / all_neg::DOUBLE', 'fpr')}, {R('tp / all_pos::DOUBLE', 'tpr')} FROM k WHERE i = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
UNION ALL SELECT DISTINCT model, NULL::DOUBLE, 0::DOUBLE, 0::DOUBLE FROM preds""",
)
def roc_curve(spark, sf):
    return r6(ev.roc_curve(class_predictions(spark, sf)), "fpr", "tpr")


@query(
    "roc_auc",
    f"""
WITH {_RUN},
p AS (SELECT model, score, fp / all_neg::DOUBLE AS x, tp / all_pos::DOUBLE AS y FROM r),
s AS (SELECT model, x - coalesce(lag(x) OVER w, 0) AS dx, (y + coalesce(lag(y) OVER w, 0)) / 2 AS h FROM p WINDOW w AS (PARTITION BY model ORDER BY score DESC))
SELECT model, {R('sum(dx * h)', 'auc')} FROM s GROUP BY model""",
)
def roc_auc(spark, sf):
    return r6(ev.roc_auc(class_predictions(spark, sf)), "auc")


@query(
    "reg_metrics",
    f"""SELECT model, {R('sqrt(avg((label - prediction) * (label - prediction)))', 'rmse')}, {R('avg(abs(label - prediction))', 'mae')},
  {R('1 - sum((label - prediction) * (label - prediction)) / (count(*) * var_pop(label))', 'r2')} FROM values_pred GROUP BY model""",
)
def reg_metrics(spark, sf):
    return r6(ev.reg_metrics(value_predictions(spark, sf)), "rmse", "mae", "r2")


@query("residuals", f"SELECT {ID}, model, label, prediction, label - prediction AS residual FROM values_pred")
def residuals(spark, sf):
    return ev.residuals(value_predictions(spark, sf))


@query(
    "baseline_improvement",
    f"""
WITH b AS (SELECT avg(DepDelayMinutes) AS mean FROM flights WHERE ln <= 3),
m AS (SELECT model, avg(abs(label - prediction)) AS mae, avg(abs(label - mean)) AS mae_base,
  sqrt(avg((label - prediction) * (label - prediction))) AS rmse, sqrt(avg((label - mean) * (label - mean))) AS rmse_base FROM values_pred, b GROUP BY model)
SELECT model, {', '.join(R(c) for c in ('mae', 'mae_base', 'rmse', 'rmse_base'))}, {R('(1 - mae / mae_base) * 100', 'mae_gain')}, {R('(1 - rmse / rmse_base) * 100', 'rmse_gain')} FROM m""",
)
def baseline_improvement(spark, sf):
    mean = demo.flights(spark, sf).filter("ln <= 3").agg(F.avg("DepDelayMinutes").alias("mean"))
    out = ev.baseline_improvement(value_predictions(spark, sf), mean)
    return r6(out, "mae", "mae_base", "rmse", "rmse_base", "mae_gain", "rmse_gain")
