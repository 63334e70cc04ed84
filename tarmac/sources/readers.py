"""Scans and sinks: yearly flight parquet, station observations, lookup tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The flight columns that are kept.
FLIGHT_SCHEMA = T.StructType(
    [
        T.StructField("FlightDate", T.DateType()),
        T.StructField("DayOfWeek", T.IntegerType()),
        T.StructField("Month", T.IntegerType()),
        T.StructField("Airline", T.StringType()),
        T.StructField("Origin", T.StringType()),
        T.StructField("Dest", T.StringType()),
        T.StructField("CRSDepTime", T.IntegerType()),
        T.StructField("CRSArrTime", T.IntegerType()),
        T.StructField("AirTime", T.DoubleType()),
        T.StructField("Distance", T.DoubleType()),
        T.StructField("DepDelayMinutes", T.DoubleType()),
        T.StructField("DepDel15", T.DoubleType()),
    ]
)
FLIGHT_COLUMNS = FLIGHT_SCHEMA.fieldNames()
OBSERVATION_SCHEMA = T.StructType(
    [
        T.StructField("STATION", T.StringType()),
        T.StructField("DATE", T.StringType()),
        T.StructField("ELEMENT", T.StringType()),
        T.StructField("VALUE", T.DoubleType()),
    ]
)
# Weather elements, and those where a missing value means none.
ELEMENTS = ("PRCP", "SNOW", "SNWD", "TMAX", "TMIN")
ZERO_FILLED = ("PRCP", "SNOW", "SNWD")
# Years looked for in file names.
NAME_YEARS = (2000, 2029)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing values are null everywhere, so that counts and means skip them."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(c, F.lit(None)) for c in floats}) if floats else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition a scan that has fewer splits than there are cores (few files, or one huge row group).

    Large inputs already have enough splits and are left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def scan_parquet(spark: SparkSession, path: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """Parquet scan of one or more paths, limited to ``columns``."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return nan_to_null(df.select(*columns) if columns else df)


def scan_flights(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Yearly flight files with the kept columns only."""
    return scan_parquet(spark, path, FLIGHT_COLUMNS)


def year_from_name(name: Column, years: tuple[int, int] = NAME_YEARS) -> Column:
    """Smallest year of ``years`` whose digits occur in the text, else ``unknown``."""
    wanted = F.transform(F.sequence(F.lit(years[0]), F.lit(years[1])), lambda y: y.cast("string"))
    return F.coalesce(F.array_min(F.filter(wanted, lambda y: F.contains(name, y))), F.lit("unknown"))


def scan_years(spark: SparkSession, path: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """Parquet scan with a ``year`` column taken from each file's name."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    names = columns or df.columns
    return nan_to_null(df.select(*names, year_from_name(F.col("_metadata.file_name")).alias("year")))


def scan_observations(
    spark: SparkSession,
    path: str | list[str],
    skip_first_line: bool = True,
    with_order: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """Headerless station files (plain or gzip): first four columns by position.

    ``obs_order`` is the input order (file, split, row), used to pick the first value of a station and day.
    A gzip file is one task to read, so ``partitions`` spreads the rows straight after it.
    """
    # a longer line keeps its first four fields, the rest is dropped by the reader
    df = spark.read.schema(OBSERVATION_SCHEMA).option("header", skip_first_line).option("enforceSchema", True).csv(path)
    if with_order:
        df = df.select(
            *OBSERVATION_SCHEMA.fieldNames(),
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("start"),
                F.monotonically_increasing_id().alias("row"),
            ).alias("obs_order"),
        )
    df = nan_to_null(df)
    return df.repartition(partitions, "STATION", "DATE") if partitions else df


def scan_station_key(spark: SparkSession, path: str) -> DataFrame:
    """Airport to station lookup; ``line`` is the input order, so that the last entry can win."""
    df = spark.read.option("header", True).csv(path).select("Airport", "Closest_Station")
    return df.withColumn("line", F.monotonically_increasing_id())


def scan_positional(spark: SparkSession, path: str, keep: dict[int, str]) -> DataFrame:
    """Headerless CSV: keep the columns at the given positions under new names, all as text."""
    df = spark.read.csv(path, header=False)
    return df.select(*[F.col(f"_c{pos}").alias(name) for pos, name in keep.items()])


def year_coverage(wanted: DataFrame, flights: DataFrame, weather: DataFrame, year: str = "year") -> DataFrame:
    """One row per wanted year: which side is present and whether the year can be used."""
    f = flights.select(year).distinct().withColumn("has_flights", F.lit(True))
    w = weather.select(year).distinct().withColumn("has_weather", F.lit(True))
    out = wanted.select(year).join(F.broadcast(f), year, "left").join(F.broadcast(w), year, "left")
    out = out.fillna(False, ["has_flights", "has_weather"])
    return out.withColumn("usable", F.col("has_flights") & F.col("has_weather"))


def union_years(tables: list[DataFrame]) -> DataFrame:
    """Stack yearly tables by column name, duplicates kept."""
    out = tables[0]
    for df in tables[1:]:
        out = out.unionByName(df)
    return out


def write_parquet(df: DataFrame, path: str, by: list[str] | None = None, mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True)
