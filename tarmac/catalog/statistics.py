"""Correlations, tests and curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.catalog.base import R, query, r6
from tarmac.functions import bands
from tarmac.operators import stats as st
from tarmac.operators.trend import lowess
from tarmac.sources import demo

_CORR = ["DepDelayMinutes", "ArrDelayMinutes", "Distance", "AirTime"]


@query("pearson_matrix", "\nUNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {R(f'corr({a}, {b})', 'r')} FROM flights" for a in _CORR for b in _CORR))
def pearson_matrix(spark, sf):
    return r6(st.pearson_matrix(demo.flights(spark, sf), _CORR), "r")


_FEAT = ["Distance", "AirTime", "ArrDelay", "CRSDepTime"]


def _spearman_sql(f: str) -> str:
    return f"""SELECT '{f}' AS feature, corr(rx, ry) AS r FROM (SELECT
  rank() OVER (ORDER BY {f}) + (count(*) OVER (PARTITION BY {f}) - 1) / 2.0::DOUBLE AS rx,
  rank() OVER (ORDER BY DepDelayMinutes) + (count(*) OVER (PARTITION BY DepDelayMinutes) - 1) / 2.0::DOUBLE AS ry
  FROM flights WHERE {f} IS NOT NULL AND DepDelayMinutes IS NOT NULL)"""


@query(
    "spearman_target",
    "WITH c AS (" + "\nUNION ALL ".join(_spearman_sql(f) for f in _FEAT) + f") SELECT feature, {R('r')}, {R('abs(r)', 'abs_r')} FROM c",
)
def spearman_target(spark, sf):
    return r6(st.spearman_target(demo.flights(spark, sf), _FEAT, "DepDelayMinutes"), "r", "abs_r")


_LABEL = "CASE WHEN CRSDepTime < 600 THEN 'Early Morning' WHEN CRSDepTime < 1200 THEN 'Morning' WHEN CRSDepTime < 1800 THEN 'Afternoon' ELSE 'Evening' END"


def _labelled(spark, sf):
    df = demo.flights(spark, sf)
    return df.select(
        "CRSDepTime", "DepDelayMinutes", "Cancelled", "Diverted",
        bands.clock_label("CRSDepTime").alias("label"), bands.severe("DepDelayMinutes").alias("severe"),
    )


# composite Simpson rule over 2,000 steps of the tail formulas
_SIMPSON = "CASE WHEN k IN (0, 2000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END"


def _chi2_sql(dof: int) -> str:
    """Upper tail of chi2 (``x``), by its density in the root of the value."""
    u = "(sqrt(x) * k / 2000)"
    area = f"(SELECT sum({_SIMPSON} * pow({u}, {dof - 1}) * exp(-{u} * {u} / 2)) * any_value(sqrt(x)) / 6000 FROM stat, range(2001) r(k))"
    return f"SELECT {R('x', 'chi2')}, {dof}::BIGINT AS dof, {R(f'1 - {area} * 2 / (pow(2::DOUBLE, {dof} / 2.0::DOUBLE) * exp(lgamma({dof} / 2.0::DOUBLE)))', 'p_value')} FROM stat"


@query(
    "welch_t",
    f"""
WITH g AS (SELECT {_LABEL} AS label, DepDelayMinutes AS y FROM flights),
s AS (SELECT label, count(y) AS n, avg(y) AS m, var_samp(y) / count(y) AS e FROM g GROUP BY label),
stat AS (SELECT (a.m - b.m) / sqrt(a.e + b.e) AS t, (a.e + b.e) * (a.e + b.e) / (a.e * a.e / (a.n - 1) + b.e * b.e / (b.n - 1)) AS v
  FROM s a, s b WHERE a.label = 'Morning' AND b.label = 'Evening'),
area AS (SELECT sum({_SIMPSON} * pow(1 + (t * k / 2000) * (t * k / 2000) / v, -(v + 1) / 2)) * any_value(abs(t)) / 6000 AS h FROM stat, range(2001) r(k))
SELECT {R('t')}, {R('v', 'dof', 4)}, {R('1 - 2 * h * exp(lgamma((v + 1) / 2) - lgamma(v / 2)) / sqrt(v * pi())', 'p_value')} FROM stat, area""",
)
def welch_t(spark, sf):
    out = st.welch_t(_labelled(spark, sf), "label", "DepDelayMinutes", "Morning", "Evening")
    return r6(r6(out, "t", "p_value"), "dof", digits=4)


@query(
    "chi_square",
    f"""
WITH g AS (SELECT {_LABEL} AS a, CASE WHEN DepDelayMinutes > 60 THEN 1 ELSE 0 END AS b FROM flights),
c AS (SELECT a, b, count(*)::DOUBLE AS o FROM g GROUP BY a, b),
e AS (SELECT o, sum(o) OVER (PARTITION BY a) * sum(o) OVER (PARTITION BY b) / sum(o) OVER () AS e FROM c),
stat AS (SELECT sum((o - e) * (o - e) / e) AS x FROM e)
{_chi2_sql(3)}""",
)
def chi_square(spark, sf):
    return r6(st.chi_square(_labelled(spark, sf), "label", "severe"), "chi2", "p_value")


@query(
    "chi_square_2x2",
    f"""
WITH g AS (SELECT ln <= 3 AS a, DepDel15 AS b FROM flights WHERE DepDel15 IS NOT NULL),
c AS (SELECT a, b, count(*)::DOUBLE AS o FROM g GROUP BY a, b),
e AS (SELECT o, sum(o) OVER (PARTITION BY a) * sum(o) OVER (PARTITION BY b) / sum(o) OVER () AS e FROM c),
stat AS (SELECT sum((abs(o - e) - least(abs(o - e), 0.5)) * (abs(o - e) - least(abs(o - e), 0.5)) / e) AS x FROM e)
{_chi2_sql(1)}""",
)
def chi_square_2x2(spark, sf):
    df = demo.flights(spark, sf).select((F.col("ln") <= 3).alias("a"), F.col("DepDel15").alias("b"))
    return r6(st.chi_square(df, "a", "b"), "chi2", "p_value")


@query(
    "chi_square_expected",
    f"""
WITH c AS (SELECT {_LABEL} AS label, CASE WHEN DepDelayMinutes > 60 THEN 1 ELSE 0 END AS severe, count(*) AS observed FROM flights GROUP BY ALL)
SELECT label, severe, observed, {R('sum(observed) OVER (PARTITION BY label) * sum(observed) OVER (PARTITION BY severe) / (sum(observed) OVER ())::DOUBLE', 'expected')} FROM c""",
)
def chi_square_expected(spark, sf):
    return r6(st.expected_counts(_labelled(spark, sf), "label", "severe"), "expected")


def _choose(m: str, k: str) -> str:
    return f"(lgamma({m} + 1) - lgamma({k} + 1) - lgamma({m} - ({k}) + 1))"


@query(
    "fisher_exact",
    f"""
WITH t AS (SELECT count(*) FILTER (WHERE NOT a AND NOT b) AS n00, count(*) FILTER (WHERE NOT a AND b) AS n01,
  count(*) FILTER (WHERE a AND NOT b) AS n10, count(*) FILTER (WHERE a AND b) AS n11
  FROM (SELECT pk % 97 = 0 AS a, ok % 89 = 0 AS b FROM flights)),
k AS (SELECT t.*, unnest(range(greatest(0, n00 + n10 - n10 - n11), least(n00 + n01, n00 + n10) + 1)) AS k FROM t),
p AS (SELECT *, {_choose('(n00 + n01)', 'k')} + {_choose('(n10 + n11)', '(n00 + n10 - k)')} - {_choose('(n00 + n01 + n10 + n11)', '(n00 + n10)')} AS lp FROM k)
SELECT n00, n01, n10, n11, {R('any_value(n00 * n11 / (n01 * n10)::DOUBLE)', 'odds_ratio')},
  {R('sum(exp(lp)) FILTER (WHERE lp <= obs + 1e-7)', 'p_value')}
FROM p, (SELECT lp AS obs FROM p WHERE k = n00) GROUP BY n00, n01, n10, n11""",
)
def fisher_exact(spark, sf):
    df = demo.flights(spark, sf).select((F.col("pk") % 97 == 0).alias("a"), (F.col("ok") % 89 == 0).alias("b"))
    return r6(st.fisher_exact(df, "a", "b"), "odds_ratio", "p_value")


@query(
    "fisher_cancelled",
    """
SELECT *, n00 * n11 / (n01 * n10)::DOUBLE AS odds_ratio FROM (
SELECT count(*) FILTER (WHERE NOT Cancelled AND NOT Diverted) AS n00, count(*) FILTER (WHERE NOT Cancelled AND Diverted) AS n01,
  count(*) FILTER (WHERE Cancelled AND NOT Diverted) AS n10, count(*) FILTER (WHERE Cancelled AND Diverted) AS n11 FROM flights)""",
)
def fisher_cancelled(spark, sf):
    return st.fisher_exact(demo.flights(spark, sf), "Cancelled", "Diverted", p_value=False)


@query(
    "kde_curve",
    f"""
WITH e AS (SELECT min(Distance) AS lo, max(Distance) AS hi, count(Distance) AS total, stddev_samp(Distance) AS sd FROM flights),
b AS (SELECT least(floor((Distance - lo) / (hi - lo) * 1024), 1023) AS bin, count(*) AS n, avg(Distance) AS m FROM flights, e WHERE Distance IS NOT NULL GROUP BY bin),
g AS (SELECT k::BIGINT AS point, lo + k * (hi - lo) / 199 AS x, sd * pow(total::DOUBLE, -0.2) AS h, total FROM e, range(200) t(k))
SELECT point, {R('x')}, {R('sum(n * exp(-((x - m) / h) * ((x - m) / h) / 2)) / (any_value(total) * any_value(h) * sqrt(2 * pi()))', 'density', 9)}
FROM g, b GROUP BY point, x""",
)
def kde_curve(spark, sf):
    return r6(r6(st.kde_curve(demo.flights(spark, sf), "Distance"), "x"), "density", digits=9)


@query(
    "local_trend",
    f"""
WITH f AS (SELECT Distance AS x, DepDelay AS y FROM flights WHERE Distance IS NOT NULL AND DepDelay IS NOT NULL),
e AS (SELECT min(x) AS lo, max(x) AS hi, count(*) AS total FROM f),
b AS (SELECT least(floor((x - lo) / (hi - lo) * 200), 199) AS bin, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy FROM f, e GROUP BY bin),
g AS (SELECT k::BIGINT AS point, lo + k * (hi - lo) / 49 AS gx, total FROM e, range(50) t(k)),
d AS (SELECT *, abs(sx / n - gx) AS d FROM g, b),
s AS (SELECT *, sum(n) OVER (PARTITION BY point ORDER BY d, bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS before FROM d),
h AS (SELECT *, max(d) OVER (PARTITION BY point) * 1.0001::DOUBLE AS h FROM s WHERE before < 2.0::DOUBLE / 3 * total),
w AS (SELECT *, pow(1 - pow(d / h, 3), 3) AS w FROM h),
t AS (SELECT point, gx, sum(w * n) AS W, sum(w * sx) AS X, sum(w * sy) AS Y, sum(w * sxx) AS XX, sum(w * sxy) AS XY FROM w GROUP BY point, gx),
l AS (SELECT *, (W * XY - X * Y) / (W * XX - X * X) AS slope FROM t)
SELECT point, {R("gx", "x")}, {R('(Y - slope * X) / W + slope * gx', 'trend', 5)} FROM l""",
)
def local_trend(spark, sf):
    return r6(r6(st.local_trend(demo.flights(spark, sf), "Distance", "DepDelay"), "x"), "trend", digits=5)


@query("lowess_trend")
def lowess_trend(spark, sf):
    """Robust local regression of the delay on the distance at places of equal row counts."""
    return r6(lowess(demo.flights(spark, sf), "Distance", "DepDelay"), "trend")


@query(
    "top_correlations",
    "WITH c AS (" + "\nUNION ALL ".join(_spearman_sql(f) for f in _FEAT) + f") SELECT feature, {R('abs(r)', 'abs_r')} FROM c ORDER BY abs(r) DESC LIMIT 2",
)
def top_correlations(spark, sf):
    return r6(st.spearman_target(demo.flights(spark, sf), _FEAT, "DepDelayMinutes").drop("r").limit(2), "abs_r")
