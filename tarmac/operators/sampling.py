"""Exact and repeatable sampling, splitting and folds.

Rows are ordered by the md5 of a seed and their id columns, so the same rows are taken on any cluster and in any
partitioning. A class is never sorted as a whole: counts per leading hash digits find the bucket where the quota ends,
and only the hashes of that bucket are ranked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.plans.lookup import fits_broadcast, lookup_join
from tarmac.plans.ordering import global_index
from tarmac.plans.storage import materialize

SEED = 42
# leading hash digits of a threshold, whose bucket is only counted
_CUT_DIGITS = 3


def hash_key(ids: list[str], seed: int = SEED) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids]))


def class_key(per: list[str]) -> Column:
    return F.struct(*per) if per else F.struct(F.lit(0).alias("all"))


def _tag(df: DataFrame, ids: list[str], per: list[str], seed: int) -> DataFrame:
    return df.withColumns({"_cls": class_key(per), "_h": hash_key(ids, seed), "_bucket": F.substring(hash_key(ids, seed), 1, _CUT_DIGITS)})


def _with_run(hist: DataFrame) -> DataFrame:
    """Running count over the buckets of a class (at most 65,536 rows per class)."""
    return hist.withColumn("_run", F.sum("_n").over(Window.partitionBy("_cls").orderBy("_bucket")))


def _content(df: DataFrame, columns: list[str]) -> list[Column]:
    return [_sortable(df, c).asc_nulls_last() for c in columns]


def _place_in_run(edge: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that share a threshold hash with their place (``_in_run``) among those of their class and hash, by content.

    They are numbered over range partitions, which also split a hash that many rows share; values stay as they came. Equal rows
    may take each other's place.
    """
    tied = edge.withColumn("_tie", F.monotonically_increasing_id())
    placed = global_index(tied, [F.col("_cls"), F.col("_h"), *_content(edge, columns), F.col("_tie")], "_at")
    starts = materialize(placed.groupBy("_cls", "_h").agg(F.min("_at").alias("_start_at")), "run-starts")
    return lookup_join(placed, starts, ["_cls", "_h"]).withColumn("_in_run", F.col("_at") - F.col("_start_at"))


def _cuts(narrow: DataFrame, hist: DataFrame, wanted: DataFrame) -> tuple[DataFrame, bool]:
    """For each wanted (``_cls``, ``_f``, ``_k``) the hash ``_cut`` of the k-th row of the class; ``_need`` of the rows with that hash
    belong to the first k, and ``_split`` says whether not all of them do. Also whether the result is small enough to broadcast.

    Counts per leading digits find the bucket in which a quota ends; inside it, counts by more digits, and then by hash.
    """
    ends = (F.col("_run") >= F.col("_k")) & (F.col("_run") - F.col("_n") < F.col("_k"))
    left_over = (F.col("_k") - F.col("_run") + F.col("_n")).alias("_need")
    bucket = _with_run(hist).join(wanted.select("_cls", "_f", "_k"), "_cls").filter(ends).select("_cls", "_f", "_bucket", left_over)
    bucket = materialize(bucket, "cut-bucket")
    # the widest table that is sent holds a 32-letter hash
    small = fits_broadcast(bucket.withColumn("_cut", F.lit("x" * 32)))
    finer = F.substring("_h", 1, 2 * _CUT_DIGITS)

    def run(counts: DataFrame, by: str) -> DataFrame:
        return counts.withColumn("_run", F.sum("_n").over(Window.partitionBy("_cls", "_f").orderBy(by))).filter(ends)

    # a bucket in which several quotas end is counted once for each
    inside = _in_buckets(narrow, bucket, F.col("_bucket"), small).groupBy("_cls", "_f", finer.alias("_bucket"), F.col("_need").alias("_k"))
    bucket = materialize(run(inside.agg(F.count("*").alias("_n")), "_bucket").select("_cls", "_f", "_bucket", left_over), "cut-bucket")
    hashes = _in_buckets(narrow, bucket, finer, small).groupBy("_cls", "_f", "_h", F.col("_need").alias("_k")).agg(F.count("*").alias("_n"))
    cut = run(hashes, "_h").select("_cls", "_f", F.col("_h").alias("_cut"), left_over, (F.col("_run") != F.col("_k")).alias("_split"))
    return materialize(cut, "cut"), small


def _in_buckets(narrow: DataFrame, bucket: DataFrame, key: Column, small: bool) -> DataFrame:
    """Narrow rows whose class and leading digits are in ``bucket``, once for each quota that ends there."""
    side = bucket.groupBy("_cls", F.col("_bucket").alias("_b")).agg(F.collect_list(F.struct("_f", "_need")).alias("_q"))
    side = F.broadcast(side) if small else side
    met = narrow.select("_cls", "_h", key.alias("_b")).join(side, ["_cls", "_b"])
    return met.select("_cls", "_h", F.explode("_q").alias("_x")).select("_cls", "_h", "_x._f", "_x._need")


def mark_exact(
    df: DataFrame,
    quota: Callable[[DataFrame], DataFrame],
    ids: list[str],
    per: list[str] | None = None,
    seed: int = SEED,
    flag: str = "picked",
) -> DataFrame:
    """Flag exactly ``_k`` rows of each class; classes without a quota are all false.

    ``quota`` gets the class sizes (columns ``per``, ``_cls``, ``_size``) and returns ``_cls`` and ``_k``. A narrow table
    (hash and class only) is written and read to find the hash at which each class reaches its quota; the full table is then flagged in place,
    without a shuffle when the thresholds fit a broadcast. Only when several rows share the threshold hash and not all of
    them are wanted are those rows ordered by content.
    """
    per = per or []
    tagged = _tag(df, ids, per, seed)
    narrow = materialize(tagged.select("_cls", "_bucket", "_h"), "hashes")
    hist = materialize(narrow.groupBy("_cls", "_bucket").agg(F.count("*").alias("_n")), "buckets")
    sizes = hist.groupBy("_cls").agg(F.sum("_n").alias("_size")).select(*[F.col("_cls")[c].alias(c) for c in per], "_cls", "_size")
    cut, small = _cuts(narrow, hist, quota(sizes).select("_cls", F.lit(0).alias("_f"), "_k"))

    joined = lookup_join(tagged.drop("_bucket"), cut.drop("_f"), ["_cls"], small=small)
    sure = joined.withColumn(flag, F.coalesce(F.col("_h") <= F.col("_cut"), F.lit(False)))
    if not cut.filter("_split").limit(1).count():
        return sure.select(*df.columns, flag)
    on_edge = F.coalesce(F.col("_split") & (F.col("_h") == F.col("_cut")), F.lit(False))
    edge = _place_in_run(joined.filter(on_edge), df.columns).withColumn(flag, F.col("_in_run") < F.col("_need"))
    return sure.filter(~on_edge).select(*df.columns, flag).unionByName(edge.select(*df.columns, flag))


def mark_fraction(
    df: DataFrame,
    fraction: float,
    ids: list[str],
    per: list[str] | None = None,
    seed: int = SEED,
    flag: str = "picked",
    rounding: str = "ceil",
) -> DataFrame:
    """Flag a fraction of all rows, or of each class: rounded up, or to the nearest (halves up)."""
    wanted = F.col("_size") * F.lit(float(fraction))
    k = F.ceil(wanted) if rounding == "ceil" else F.floor(wanted + 0.5)
    return mark_exact(df, lambda sizes: sizes.select("_cls", k.cast("long").alias("_k")), ids, per, seed, flag)


def train_test_split(df: DataFrame, ids: list[str], fraction: float = 0.2, per: list[str] | None = None, seed: int = SEED):
    """Disjoint and complete train and test tables; test holds the rounded-up fraction."""
    marked = materialize(mark_fraction(df, fraction, ids, per, seed, "_test"), "split")
    return marked.filter(~F.col("_test")).drop("_test"), marked.filter("_test").drop("_test")


def stratified_sample(df: DataFrame, fraction: float, ids: list[str], per: list[str], seed: int = SEED) -> DataFrame:
    return mark_fraction(df, fraction, ids, per, seed, "_in", "nearest").filter("_in").drop("_in")


def undersample(df: DataFrame, target: str, ids: list[str], per: list[str] | None = None, seed: int = SEED) -> DataFrame:
    """All rows of class 1 and as many of class 0, per ``per`` (a year). Rows with a null class are dropped."""
    per = per or []

    def quota(sizes: DataFrame) -> DataFrame:
        late = F.max(F.when(F.col(target) == 1, F.col("_size"))).over(Window.partitionBy(*per) if per else Window.partitionBy(F.lit(0)))
        out = sizes.withColumn("_k", F.coalesce(late, F.lit(0)))
        short = out.filter((F.col(target) == 0) & (F.col("_size") < F.col("_k"))).limit(5).collect()
        # a group with late rows but no class 0 at all has no row to compare, so count its classes
        late_only = sizes.groupBy(*per).agg(F.count_if(F.col(target) == 0).alias("_zero")).filter("_zero = 0").limit(5).collect()
        if short or late_only:
            raise ValueError(f"fewer on-time than delayed rows in: {[[r[c] for c in per] or 'all' for r in [*short, *late_only]]}")
        return out

    known = df.filter(F.col(target).isin(0, 1))
    return mark_exact(known, quota, ids, [*per, target], seed, "_in").filter("_in").drop("_in")


def undersample_all(df: DataFrame, target: str, ids: list[str], seed: int = SEED) -> DataFrame:
    """Every class cut to the size of the smallest one; each distinct value of the target is a class."""

    def quota(sizes: DataFrame) -> DataFrame:
        return sizes.crossJoin(F.broadcast(sizes.agg(F.min("_size").alias("_k"))))

    known = df.filter(F.col(target).isNotNull())
    return mark_exact(known, quota, ids, [target], seed, "_in").filter("_in").drop("_in")


def kfold_assign(
    df: DataFrame,
    k: int,
    ids: list[str],
    per: list[str] | None = None,
    seed: int = SEED,
    name: str = "fold",
) -> DataFrame:
    """Fold 0..k-1 of each row: the r-th row (from 0) of a class of n rows, in hash order, is in fold r k div n. Fold sizes
    differ by one at most.

    The hashes at which the folds of each class begin are found as in ``mark_exact``, all in the same passes; the table is then
    flagged where it is, without an exchange. Only rows that share such a hash with rows of another fold are ordered by content.
    """
    tagged = _tag(df, ids, per or [], seed)
    narrow = materialize(tagged.select("_cls", "_bucket", "_h"), "hashes")
    hist = materialize(narrow.groupBy("_cls", "_bucket").agg(F.count("*").alias("_n")), "buckets")
    sizes = hist.groupBy("_cls").agg(F.sum("_n").alias("_size"))
    begins = sizes.select("_cls", "_size", F.explode(F.sequence(F.lit(1), F.lit(k - 1))).alias("_f")) if k > 1 else sizes.withColumn("_f", F.lit(0)).limit(0)
    cut, small = _cuts(narrow, hist, begins.select("_cls", "_f", F.expr(f"(_f * _size + {k - 1}) div {k}").alias("_k")))
    per_class = materialize(cut.groupBy("_cls").agg(F.collect_list(F.struct("_cut", "_need", "_split")).alias("_cuts")), "fold-cuts")  # k - 1 entries a class
    joined = lookup_join(tagged.drop("_bucket"), per_class, ["_cls"], small=small)
    cuts = F.coalesce(F.col("_cuts"), F.array().cast(per_class.schema["_cuts"].dataType))
    after = F.size(F.filter(cuts, lambda c: F.col("_h") > c["_cut"]))
    if not cut.filter("_split").limit(1).count():
        return joined.select(*df.columns, after.cast("int").alias(name))
    on_edge = F.exists(cuts, lambda c: c["_split"] & (F.col("_h") == c["_cut"]))
    sure = joined.filter(~on_edge).select(*df.columns, after.cast("int").alias(name))
    edge = _place_in_run(joined.filter(on_edge), df.columns)
    within = F.size(F.filter(cuts, lambda c: (F.col("_h") > c["_cut"]) | ((F.col("_h") == c["_cut"]) & (F.col("_in_run") >= c["_need"]))))
    return sure.unionByName(edge.select(*df.columns, within.cast("int").alias(name)))


def _sortable(df: DataFrame, name: str) -> Column:
    """The column, or the sorted entries of a map, which has no order of its own."""
    return F.array_sort(F.map_entries(name)) if isinstance(df.schema[name].dataType, T.MapType) else F.col(name)


def shuffle_position(df: DataFrame, ids: list[str], seed: int = SEED, name: str = "position") -> DataFrame:
    """Position of each row in the shuffled order."""
    order = [F.col("_h"), *_content(df, df.columns)]
    return global_index(df.withColumn("_h", hash_key(ids, seed)), order, name).drop("_h")


def bounded_sample(df: DataFrame, rows: int, ids: list[str], seed: int = SEED) -> DataFrame:
    """Exactly ``rows`` rows (all when there are fewer), for plots."""

    def quota(sizes: DataFrame) -> DataFrame:
        return sizes.select("_cls", F.least("_size", F.lit(rows).cast("long")).alias("_k"))

    return mark_exact(df, quota, ids, [], seed, "_in").filter("_in").drop("_in")
