"""Sampling, splitting, scaling and encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.catalog.base import VIEWS, R, arrivals, daily_sql, query, r6, rolling_sql, side_columns
from tarmac.operators import encoding as en
from tarmac.operators import sampling as sp
from tarmac.operators import stats as st
from tarmac.plans import training_table as tt
from tarmac.sources import demo

ID = ", ".join(demo.ROW_ID)
IDS = demo.ROW_ID


def _hash(seed: int = 42) -> str:
    return f"md5(concat_ws('|', '{seed}', {', '.join(f'CAST({c} AS VARCHAR)' for c in IDS)}))"


def _rank(per: str = "", seed: int = 42) -> str:
    part = f"PARTITION BY {per} " if per else ""
    return f"row_number() OVER ({part}ORDER BY {_hash(seed)})"


@query(
    "undersample",
    f"""
WITH f AS (SELECT {ID}, year(CalendarDate) AS y, DepDel15 FROM flights WHERE DepDel15 IS NOT NULL),
r AS (SELECT *, {_rank('y, DepDel15')} AS r, count(*) FILTER (WHERE DepDel15 = 1) OVER (PARTITION BY y) AS k FROM f)
SELECT {ID}, CAST(y AS INT) AS Year, DepDel15 FROM r WHERE DepDel15 = 1 OR r <= k""",
)
def undersample(spark, sf):
    df = demo.flights(spark, sf).select(*IDS, F.year("CalendarDate").alias("Year"), "DepDel15")
    return sp.undersample(df, "DepDel15", IDS, ["Year"])


@query(
    "undersample_all",
    f"""
WITH f AS (SELECT {ID}, DepDelayMinutes FROM flights WHERE DepDelayMinutes IS NOT NULL),
k AS (SELECT min(n) AS k FROM (SELECT count(*) AS n FROM f GROUP BY DepDelayMinutes))
SELECT {ID}, DepDelayMinutes FROM (SELECT *, {_rank('DepDelayMinutes')} AS r FROM f), k WHERE r <= k""",
)
def undersample_all(spark, sf):
    return sp.undersample_all(demo.flights(spark, sf).select(*IDS, "DepDelayMinutes"), "DepDelayMinutes", IDS)


@query("shuffle_key", f"SELECT {ID}, CAST({_rank()} - 1 AS BIGINT) AS position FROM flights")
def shuffle_key(spark, sf):
    return sp.shuffle_position(demo.flights(spark, sf).select(*IDS), IDS)


_SCALED = ["AirTime", "Distance", "CRSDepTime", "DepDelay"]


@query(
    "standardize",
    f"SELECT {ID}, " + ", ".join(R(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()", c) for c in _SCALED) + ", CAST(0 AS DOUBLE) AS one FROM flights",
)
def standardize(spark, sf):
    df = demo.flights(spark, sf).select(*IDS, *[F.col(c).cast("double").alias(c) for c in _SCALED], F.lit(1.0).alias("one"))
    return r6(en.standardize(df, [*_SCALED, "one"]), *_SCALED)


@query(
    "train_test_split",
    f"SELECT {ID}, CASE WHEN {_rank()} <= ceil(count(*) OVER () * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS part FROM flights",
)
def train_test_split(spark, sf):
    train, test = sp.train_test_split(demo.flights(spark, sf).select(*IDS), IDS)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "stratified_sample",
    f"""SELECT {ID}, DepDel15 FROM (SELECT *, {_rank('DepDel15')} AS r, count(*) OVER (PARTITION BY DepDel15) AS n FROM flights WHERE DepDel15 IS NOT NULL)
WHERE r <= floor(n * 0.1::DOUBLE + 0.5::DOUBLE)""",
)
def stratified_sample(spark, sf):
    df = demo.flights(spark, sf).select(*IDS, "DepDel15").filter("DepDel15 IS NOT NULL")
    return sp.stratified_sample(df, 0.1, IDS, ["DepDel15"])


@query("kfold_assign", f"SELECT {ID}, DepDel15, CAST((({_rank('DepDel15')} - 1) * 5) // count(*) OVER (PARTITION BY DepDel15) AS INT) AS fold FROM flights WHERE DepDel15 IS NOT NULL")
def kfold_assign(spark, sf):
    df = demo.flights(spark, sf).select(*IDS, "DepDel15").filter("DepDel15 IS NOT NULL")
    return sp.kfold_assign(df, 5, IDS, ["DepDel15"])


@query("kfold_plain", f"SELECT {ID}, CAST((({_rank()} - 1) * 5) // count(*) OVER () AS INT) AS fold FROM flights")
def kfold_plain(spark, sf):
    return sp.kfold_assign(demo.flights(spark, sf).select(*IDS), 5, IDS)


_ENC = ["Airline", "Origin", "Dest"]
_PARTS = f"""
base AS (SELECT {ID}, Airline, Origin, Dest, DepDel15 AS y FROM flights WHERE DepDel15 IS NOT NULL),
marked AS (SELECT *, {_rank()} <= ceil(count(*) OVER () * 0.2::DOUBLE) AS is_test FROM base),
train AS (SELECT *, (({_rank('y')} - 1) * 5) // count(*) OVER (PARTITION BY y) AS fold FROM marked WHERE NOT is_test),
test AS (SELECT * FROM marked WHERE is_test)"""


def _auto(n, s, ss, N, S, SS):
    v = f"({SS} / {N} - ({S} / {N}) * ({S} / {N}))"
    vc = f"greatest({ss} / {n} - ({s} / {n}) * ({s} / {n}), 0)"
    lam = f"({v} * {n} / ({v} * {n} + {vc}))"
    return f"CASE WHEN {n} = 0 OR {v} <= 0 THEN {S} / {N} ELSE {lam} * ({s} / {n}) + (1 - {lam}) * ({S} / {N}) END"


def _fixed(n, s, ss, N, S, SS):
    return f"({s} + 5 * ({S} / {N})) / ({n} + 5)"


def _encode_sql(part: str, formula, names=_ENC, parts: str = _PARTS, keep: str = "y AS DepDel15", digits: int = 6) -> str:
    ctes, joins, cols = [], [], []
    for c in names:
        if part == "train":
            ctes.append(
                f"s_{c} AS (SELECT {c}, fold, count(*) AS n, sum(y) AS s, sum(y * y) AS ss FROM train GROUP BY ALL),\n"
                f"o_{c} AS (SELECT {c}, fold, sum(n) OVER w - n AS n, sum(s) OVER w - s AS s, sum(ss) OVER w - ss AS ss FROM s_{c} WINDOW w AS (PARTITION BY {c})),\n"
                f"e_{c} AS (SELECT {c}, o.fold, {formula('o.n::DOUBLE', 'o.s', 'o.ss', 'g.n', 'g.s', 'g.ss')} AS e FROM o_{c} o JOIN g ON o.fold = g.fold)"
            )
            joins.append(f"JOIN e_{c} ON t.{c} = e_{c}.{c} AND t.fold = e_{c}.fold")
            cols.append(R(f"e_{c}.e", c, digits))
        else:
            ctes.append(
                f"e_{c} AS (SELECT {c}, {formula('count(*)::DOUBLE', 'sum(y)', 'sum(y * y)', 'any_value(g.n)', 'any_value(g.s)', 'any_value(g.ss)')} AS e FROM train, g GROUP BY {c})"
            )
            joins.append(f"LEFT JOIN e_{c} ON t.{c} = e_{c}.{c}")
            cols.append(R(f"coalesce(e_{c}.e, (SELECT s / n FROM g))", c, digits))
    if part == "train":
        g = "g AS (SELECT fold, sum(count(*)) OVER () - count(*) AS n, sum(sum(y)) OVER () - sum(y) AS s, sum(sum(y * y)) OVER () - sum(y * y) AS ss FROM train GROUP BY fold)"
    else:
        g = "g AS (SELECT count(*) AS n, sum(y) AS s, sum(y * y) AS ss FROM train)"
    return f"WITH {parts.strip()},\n{g},\n" + ",\n".join(ctes) + f"\nSELECT {ID}, {keep}, {', '.join(cols)} FROM {part} t " + "\n".join(joins)


def _encoded(spark, sf, smooth):
    df = demo.flights(spark, sf).select(*IDS, *_ENC, "DepDel15").filter("DepDel15 IS NOT NULL")
    train, test = sp.train_test_split(df, IDS)
    return en.target_encode(train, test, _ENC, "DepDel15", IDS, smooth=smooth)


@query("target_encode_train", _encode_sql("train", _auto))
def target_encode_train(spark, sf):
    return r6(_encoded(spark, sf, "auto")[0], *_ENC)


@query("target_encode_test", _encode_sql("test", _auto))
def target_encode_test(spark, sf):
    return r6(_encoded(spark, sf, "auto")[1], *_ENC)


@query("target_encode_fixed", _encode_sql("train", _fixed))
def target_encode_fixed(spark, sf):
    return r6(_encoded(spark, sf, 5.0)[0], *_ENC)


@query("label_encode", f"SELECT {ID}, Airline, CAST(dense_rank() OVER (ORDER BY Airline) - 1 AS BIGINT) AS code FROM flights")
def label_encode(spark, sf):
    return en.label_encode(demo.flights(spark, sf).select(*IDS, "Airline"), "Airline", "code")


@query(
    "median_impute",
    f"""
WITH m AS (SELECT {ID}, AirTime, DepDelay, {_rank()} <= ceil(count(*) OVER () * 0.2::DOUBLE) AS is_test FROM flights),
q AS (SELECT median(AirTime) AS a, median(DepDelay) AS d FROM m WHERE NOT is_test)
SELECT {ID}, coalesce(AirTime, a) AS AirTime, coalesce(DepDelay, d) AS DepDelay FROM m, q WHERE is_test""",
)
def median_impute(spark, sf):
    train, test = sp.train_test_split(demo.flights(spark, sf).select(*IDS, "AirTime", "DepDelay"), IDS)
    return en.median_impute(train, test, ["AirTime", "DepDelay"])[1]


_FEATURES = ["AirTime", "Distance", "CRSDepTime", "CRSArrTime", "ArrDelayMinutes", "ln"]


@query(
    "select_k_best",
    "WITH c AS ("
    + " UNION ALL ".join(f"SELECT '{f}' AS feature, corr({f}, DepDelayMinutes) AS r, count(DepDelayMinutes) AS n FROM flights" for f in _FEATURES)
    + f") SELECT feature, {R('r * r / (1 - r * r) * (n - 2)', 'f_score', 4)} FROM c ORDER BY r * r DESC LIMIT 4",
)
def select_k_best(spark, sf):
    return r6(en.select_k_best(demo.flights(spark, sf), _FEATURES, "DepDelayMinutes", 4), "f_score", digits=4)


_POLY = ["AirTime", "DepDelay", "ArrDelay"]


@query(
    "poly_features",
    f"SELECT {ID}, AirTime, DepDelay, ArrDelay, CAST(1 AS DOUBLE) AS bias, "
    + ", ".join(f"{a} * {b} AS {a}_{b}" for i, a in enumerate(_POLY) for b in _POLY[i:])
    + " FROM flights",
)
def poly_features(spark, sf):
    return en.poly_features(demo.flights(spark, sf).select(*IDS, *_POLY), _POLY)


@query(
    "plot_sample",
    f"SELECT {ID}, FlightDate, DepDelay, Distance FROM flights ORDER BY {_hash()} LIMIT 500",
)
def plot_sample(spark, sf):
    df = demo.flights(spark, sf).select(*IDS, "FlightDate", "DepDelay", "Distance")
    return sp.bounded_sample(df, 500, IDS)


@query(
    "scatter_cells",
    """
WITH v AS (SELECT DepDelay::DOUBLE AS y, Distance::DOUBLE AS x FROM flights),
k AS (SELECT * FROM v WHERE x IS NOT NULL AND y IS NOT NULL),
b AS (SELECT min(x) AS lx, max(x) AS hx, min(y) AS ly, max(y) AS hy, greatest(1, count(*) // 1000) AS lim FROM k),
p AS (SELECT least(floor((x - lx) / (hx - lx) * 4096.0::DOUBLE), 4095)::BIGINT AS cx, least(floor((y - ly) / (hy - ly) * 4096.0::DOUBLE), 4095)::BIGINT AS cy FROM k, b),
c AS (SELECT level::INTEGER AS level, cx >> (12 - level) AS cx, cy >> (12 - level) AS cy, count(*) AS n FROM p, range(13) l(level) GROUP BY ALL),
e AS (SELECT c.* FROM c LEFT JOIN c u ON u.level = c.level - 1 AND u.cx = c.cx >> 1 AND u.cy = c.cy >> 1, b
  WHERE (c.n <= lim OR c.level = 12) AND (u.n > lim OR c.level = 0))
SELECT level, cx, cy, lx + (hx - lx) * cx / 2.0::DOUBLE ** level AS x_low, lx + (hx - lx) * (cx + 1) / 2.0::DOUBLE ** level AS x_high,
  ly + (hy - ly) * cy / 2.0::DOUBLE ** level AS y_low, ly + (hy - ly) * (cy + 1) / 2.0::DOUBLE ** level AS y_high, n FROM e, b
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, n FROM (SELECT count(*) AS n FROM v WHERE x IS NULL OR y IS NULL) WHERE n > 0""",
)
def scatter_cells(spark, sf):
    """Delay against distance of all rows, as counts of nested cells."""
    return st.scatter_cells(demo.flights(spark, sf).select("DepDelay", "Distance"), "Distance", "DepDelay")


def _final(spark, sf):
    flights = demo.flights(spark, sf).select(
        *IDS, "FlightDate", F.month("CalendarDate").alias("Month"), (F.weekday("CalendarDate") + 1).alias("DayOfWeek"),
        "Airline", "Origin", "Dest", "CRSDepTime", "CRSArrTime", "AirTime", "Distance", "DepDelayMinutes", "DepDel15",
    )
    return tt.training_tables(flights, demo.observations(spark, sf), demo.station_key(spark, sf), IDS, years=(2024, 2024), airports=arrivals(spark, sf))


# Checking SQL of the whole way from raw tables to the train and test tables
VIEWS["balanced"] = f"""
SELECT * EXCLUDE (r, k) FROM (SELECT *, {_rank('year(FlightDate), DepDel15')} AS r, count(*) FILTER (WHERE DepDel15 = 1) OVER (PARTITION BY year(FlightDate)) AS k
  FROM flights WHERE DepDel15 IS NOT NULL) WHERE DepDel15 = 1 OR r <= k"""
VIEWS["bal_merged"] = VIEWS["merged"].replace("FROM flights f", "FROM bal_minutes f")
VIEWS["bal_minutes"] = f"""
SELECT {ID}, FlightDate, CAST(month(CalendarDate) AS INT) AS Month, CAST(isodow(CalendarDate) AS INT) AS DayOfWeek, Airline, Origin, Dest,
  CASE WHEN CRSDepTime % 100 < 60 AND CRSDepTime < 2400 THEN CRSDepTime // 100 * 60 + CRSDepTime % 100 END AS CRSDepTime,
  CASE WHEN CRSArrTime % 100 < 60 AND CRSArrTime < 2400 THEN CRSArrTime // 100 * 60 + CRSArrTime % 100 END AS CRSArrTime,
  AirTime, Distance, DepDelayMinutes, DepDel15,
  CASE WHEN AirTime IS NULL THEN 'Unknown' WHEN AirTime < 120 THEN '0' WHEN AirTime < 360 THEN '1' ELSE '2' END AS AirTimeCategory,
  CASE WHEN Distance < 500 THEN '0' WHEN Distance < 2500 THEN '1' ELSE '2' END AS DistanceCategory,
  CASE WHEN CRSDepTime < 600 THEN 0 WHEN CRSDepTime < 1200 THEN 1 WHEN CRSDepTime < 1800 THEN 2 ELSE 3 END AS TimeofDay,
  CAST(dayofyear(FlightDate) AS INT) AS DayOfYear,
  CAST(FlightDate IN (DATE '2024-01-01', DATE '2024-01-15') AS INT) AS Holiday_Indicator,
  CAST(FlightDate <= DATE '2024-01-04' OR FlightDate BETWEEN DATE '2024-01-12' AND DATE '2024-01-18' AS INT) AS Near_Holiday,
  CAST(isodow(CalendarDate) IN (1, 7) AS INT) AS Weekend_Indicator
FROM balanced"""
for _side in ("Origin", "Dest"):
    VIEWS[f"bal_roll_{_side.lower()}"] = rolling_sql(daily_sql(_side, list(side_columns(_side)), "bal_merged"), _side, side_columns(_side), "key")
VIEWS["bal_roll_delays"] = rolling_sql(
    daily_sql("Origin", ["DepDelayMinutes"], "bal_merged"), "Origin", {"DepDelayMinutes": "origin_depdelayminutes"}, "key"
)
_ROLLED = [f"{p}_avg_{n}" for s in ("Origin", "Dest") for p in ("weekly", "monthly") for n in side_columns(s).values()]
_ROLLED += ["weekly_avg_origin_depdelayminutes", "monthly_avg_origin_depdelayminutes"]
_PAST = [f"past_{k}_avg_delay" for k in (10, 50, 100)]
_SIDES = [f"{s}_{e}" for s in ("Origin", "Dest") for e in ("PRCP", "SNOW", "SNWD", "TMAX", "TMIN")]
_FINAL_SCALED = ["Month", "DayOfWeek", "CRSDepTime", "CRSArrTime", "AirTime", "Distance", "TimeofDay", "DayOfYear", *_SIDES, *_PAST, "cumulative_flights_before", *_ROLLED]
_FINAL_CYCLES = [f"{c}_{fn}" for c in tt.calendar.PERIODS for fn in ("sin", "cos")]
_WINDOW = f"ORDER BY FlightDate, CRSDepTime NULLS LAST, {ID}"
_FINAL_PARTS = f"""
history AS (SELECT {ID}, {', '.join(f"avg(DepDelayMinutes) OVER (PARTITION BY Origin {_WINDOW} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) AS past_{k}_avg_delay" for k in (10, 50, 100))},
  row_number() OVER (PARTITION BY Origin, FlightDate {_WINDOW}) - 1 AS cumulative_flights_before FROM bal_merged),
wide AS (SELECT m.*, h.* EXCLUDE ({ID}), o.* EXCLUDE (Origin, FlightDate), d.* EXCLUDE (Dest, FlightDate), r.* EXCLUDE (Origin, FlightDate)
  FROM bal_merged m JOIN history h USING ({ID})
  LEFT JOIN bal_roll_origin o ON m.Origin = o.Origin AND m.FlightDate = o.FlightDate
  LEFT JOIN bal_roll_dest d ON m.Dest = d.Dest AND m.FlightDate = d.FlightDate
  LEFT JOIN bal_roll_delays r ON m.Origin = r.Origin AND m.FlightDate = r.FlightDate),
complete AS (SELECT *, CASE WHEN Weekend_Indicator = 1 OR Holiday_Indicator = 1 THEN 0 ELSE 1 END AS Working_Day,
  {', '.join(f"{fn}(2 * pi() * {c} / {p}) AS {c}_{fn}" for c, p in tt.calendar.PERIODS.items() for fn in ("sin", "cos"))}
  FROM wide WHERE {' AND '.join(f"{c} IS NOT NULL" for c in _FINAL_SCALED)}),
scaled AS (SELECT {ID}, Airline, Origin, Dest, AirTimeCategory, DistanceCategory, DepDelayMinutes, DepDel15 AS y, {', '.join(tt.FLAGS + _FINAL_CYCLES)},
  {', '.join(f"({c} - avg({c}) OVER ()) / (CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 ELSE stddev_pop({c}) OVER () END) AS {c}" for c in _FINAL_SCALED)},
  {_rank()} <= ceil(count(*) OVER () * 0.2::DOUBLE) AS is_test FROM complete),
train AS (SELECT *, (({_rank('y')} - 1) * 5) // count(*) OVER (PARTITION BY y) AS fold FROM scaled WHERE NOT is_test),
test AS (SELECT * FROM scaled WHERE is_test)"""
_FINAL_KEEP = f"DepDelayMinutes, y AS DepDel15, {', '.join(tt.FLAGS)}, " + ", ".join(R(f"t.{c}", c, 4) for c in _FINAL_CYCLES + _FINAL_SCALED)


def _rounded(df):
    return r6(df, *tt.ENCODED, *_FINAL_CYCLES, *_FINAL_SCALED, digits=4)


@query("final_train", _encode_sql("train", _auto, tt.ENCODED, _FINAL_PARTS, _FINAL_KEEP, 4))
def final_train(spark, sf):
    return _rounded(_final(spark, sf)[0])


@query("final_test", _encode_sql("test", _auto, tt.ENCODED, _FINAL_PARTS, _FINAL_KEEP, 4))
def final_test(spark, sf):
    return _rounded(_final(spark, sf)[1])
