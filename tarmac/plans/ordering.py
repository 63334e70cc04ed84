"""Order-dependent work over whole tables without an unpartitioned window.

Rows are range-partitioned by the full sort key and written once with their position. Work then runs in even blocks of
consecutive positions, so neither a hot key nor a global order ends up in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.plans.storage import materialize

MIN_BLOCK = 100_000
PART_ROWS = 1 << 20
MAX_BLOCKS = 65_536
_POSITION_BITS = 33


def global_index(df: DataFrame, order: list[Column], name: str = "gidx") -> DataFrame:
    """Add the 0-based position of each row in ``order`` (which should be total) as a long column."""
    tagged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    tagged = materialize(tagged, "ordered")
    part = F.shiftright("_place", _POSITION_BITS)
    sizes = tagged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # one row per range partition, never more than the number of shuffle partitions
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    starts = materialize(starts, "starts")
    inside = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        tagged.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + inside)
        .drop("_part", "_place", "_start")
    )


def even_parts(spark: SparkSession, rows: int) -> int:
    """Partitions of at most about ``PART_ROWS`` rows each, so that a task needs the same memory however long the table is."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // PART_ROWS))


def block_rows(indexed: DataFrame, at_least: int = MIN_BLOCK) -> int:
    """Block length that keeps the number of blocks bounded however long the table is."""
    total = indexed.count()
    return max(1, at_least, -(-total // MAX_BLOCKS))


def with_blocks(indexed: DataFrame, length: int, name: str = "gidx") -> DataFrame:
    return indexed.withColumn("_block", F.expr(f"{name} div {length}"))


def with_halo(indexed: DataFrame, length: int, width: int, name: str = "gidx") -> DataFrame:
    """Blocks that also hold the last ``width`` rows of the block before; ``_own`` marks the rows to keep."""
    if length < width:
        raise ValueError("a block must be at least as long as the frame")
    home = F.expr(f"{name} div {length}")
    tail = F.col(name) % length >= length - width
    spots = F.when(tail, F.array(home, home + 1)).otherwise(F.array(home))
    return indexed.withColumn("_block", F.explode(spots)).withColumn("_own", F.col("_block") == home)


def running_totals(
    df: DataFrame,
    order: list[Column],
    sums: dict[str, str],
    group: list[str] | None = None,
    at_least: int = MIN_BLOCK,
) -> DataFrame:
    """Inclusive running sums ``{new: source}`` along ``group`` then ``order``, restarting per group."""
    group = group or []
    indexed = global_index(df, [F.col(g).asc_nulls_last() for g in group] + order)
    return totals_along(indexed, sums, group, at_least).select(*df.columns, *sums)


def totals_along(indexed: DataFrame, sums: dict[str, str], group: list[str], at_least: int = MIN_BLOCK) -> DataFrame:
    """The same for rows whose position ``gidx`` (by group first) is known."""
    blocked = with_blocks(indexed, block_rows(indexed, at_least))
    inside = Window.partitionBy("_block", *group).orderBy("gidx").rowsBetween(Window.unboundedPreceding, 0)
    local = blocked.select("*", *[F.sum(c).over(inside).alias(n) for n, c in sums.items()])

    subtotal = blocked.groupBy("_block", *group).agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    # rows here: blocks plus groups; one group holds at most MAX_BLOCKS of them
    earlier = Window.partitionBy(*group) if group else Window
    earlier = earlier.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = subtotal.select(
        F.col("_block").alias("_cb"),
        *[F.col(g).alias(f"_c_{g}") for g in group],
        *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in sums],
    )
    cond = F.col("_block") == F.col("_cb")
    for g in group:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_c_{g}"))
    out = local.join(carry, cond)
    out = out.withColumns({n: F.col(n) + F.col(f"_o_{n}") for n in sums})
    return out.select(*indexed.columns, *sums)


def fill_along(indexed: DataFrame, cols: list[str], at_least: int = MIN_BLOCK, name: str = "gidx") -> DataFrame:
    """Backward then forward fill of ``cols`` along the position column, across the whole table."""
    length = block_rows(indexed, at_least)
    blocked = with_blocks(indexed, length, name)
    down = Window.partitionBy("_block").orderBy(F.col(name).desc()).rowsBetween(Window.unboundedPreceding, 0)
    local = blocked.withColumns({f"_f_{c}": F.last(c, True).over(down) for c in cols})

    present = {c: F.when(F.col(c).isNotNull(), F.col(name)) for c in cols}
    firsts = blocked.groupBy("_block").agg(*[F.min_by(c, present[c]).alias(f"_h_{c}") for c in cols])
    # one row per block, at most MAX_BLOCKS
    after = Window.orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    heads = firsts.select("_block", *[F.last(f"_h_{c}", True).over(after).alias(f"_n_{c}") for c in cols])
    tail = blocked.agg(*[F.max_by(c, present[c]).alias(f"_e_{c}") for c in cols])
    out = local.join(F.broadcast(heads), "_block").crossJoin(F.broadcast(tail))
    out = out.withColumns({c: F.coalesce(f"_f_{c}", f"_n_{c}", f"_e_{c}") for c in cols})
    return out.select(*indexed.columns)
