"""Rows packed into matrix blocks, the form in which the iterative trainers read them.

Rows are put in the order of a hash of their content and cut into even blocks, written once to the shared folder. The blocks
follow from the rows alone, not from the cluster, so the same rows give the same model everywhere; rows that are equal spread
over as many blocks as they fill. A block is read by a task as NumPy matrices; nothing turns rows into Python objects again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.plans.ordering import global_index
from tarmac.plans.storage import materialize

#: Rows of a block: at least, blocks of a long table, and bytes of a block's features at most.
MIN_ROWS, MANY_BLOCKS, MOST_BYTES = 8_192, 1_024, 64 << 20
#: Rows of a block at least, where tables of one block have a way of their own; partitions at least, and rows of a partition in long tables.
SPREAD_ROWS, LEAST_PARTS, PART_ROWS = 1 << 16, 24, 1 << 20
#: Partial results up to which the driver adds them itself; more are added in groups first.
DIRECT = 32


class Block(NamedTuple):
    number: int
    x: np.ndarray
    y: np.ndarray
    fold: np.ndarray
    #: Places of the rows in the order of the hash.
    place: np.ndarray


@dataclass(frozen=True)
class Packed:
    """Blocks as an RDD kept on the executors, with the size of the table."""

    rdd: RDD
    rows: int
    width: int
    blocks: int

    def free(self) -> None:
        self.rdd.unpersist()


def rows_per_block(rows: int, width: int, least: int = MIN_ROWS) -> int:
    return max(1, min(max(least, -(-rows // MANY_BLOCKS)), MOST_BYTES // (8 * max(width, 1))))


def parts_of(rows: int, blocks: int) -> int:
    """Partitions of the blocks, each with neighbouring blocks: they follow from the rows alone, as the sums of a pass do."""
    return max(1, min(blocks, max(LEAST_PARTS, rows // PART_ROWS)))


def row_arrays(df: DataFrame, features: list[str], labels: list[str], fold: str | None = None) -> DataFrame:
    """Rows as arrays ``_x`` (null becomes NaN) and ``_y``, with ``_fold`` (-1 without ``fold``)."""
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in features])
    y = F.array(*[F.col(c).cast("double") for c in labels])
    return df.select(x.alias("_x"), y.alias("_y"), (F.col(fold) if fold else F.lit(-1)).cast("int").alias("_fold"))


def flat_matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of arrays of one length as a matrix, without an object per row."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _packer(width: int, targets: int) -> Callable[[tuple, pa.Table], pa.Table]:
    def packed(key: tuple, rows: pa.Table) -> pa.Table:
        place = rows["_spot"].to_numpy()
        order = place.argsort()
        x, y = (flat_matrix(rows[c].combine_chunks(), n)[order] for c, n in (("_x", width), ("_y", targets)))
        columns = {"x": x, "y": y, "fold": rows["_fold"].to_numpy()[order], "place": place[order]}
        numbers = {"number": pa.array([key[0].as_py()], pa.int64()), "n": pa.array([len(order)], pa.int32())}
        return pa.table({**numbers, **{k: pa.array([v.tobytes()], pa.binary()) for k, v in columns.items()}})

    return packed


def pack(df: DataFrame, features: list[str], labels: list[str], fold: str | None = None, seed: int = 42, least: int | None = None) -> Packed:
    """Blocks of ``features`` (null becomes NaN) and ``labels``, with the fold of each row (-1 without ``fold``)."""
    rows = row_arrays(df, features, labels, fold)
    rows = rows.withColumns({"_h": F.xxhash64(F.lit(seed), "_x", "_y", "_fold"), "_tie": F.monotonically_increasing_id()})
    # rows of one hash are equal rows, which may take each other's place; the tie only spreads them
    placed = global_index(rows, [F.col("_h"), F.col("_tie")], "_spot")
    n, width, targets = placed.count(), len(features), len(labels)
    each = rows_per_block(n, width, least or MIN_ROWS)
    if least and n > each:
        # what is too long for one block gives work to many tasks
        each = rows_per_block(n, width, min(least, SPREAD_ROWS))
    blocks = placed.select("_x", "_y", "_fold", "_spot", F.expr(f"_spot div {each}").alias("_block")).groupBy("_block")
    packed = materialize(blocks.applyInArrow(_packer(width, targets), "number long, n int, x binary, y binary, fold binary, place binary"), "blocks")
    many = max(1, -(-n // each))
    parts = parts_of(n, many)

    def unpack(row) -> Block:
        return Block(
            row["number"], np.frombuffer(row["x"]).reshape(row["n"], width), np.frombuffer(row["y"]).reshape(row["n"], targets),
            np.frombuffer(row["fold"], np.int32), np.frombuffer(row["place"], np.int64),
        )

    dealt = packed.repartitionById(parts, F.expr(f"cast(number * {parts} div {many} as int)")).sortWithinPartitions("number")
    rdd = dealt.rdd.map(unpack).persist(StorageLevel.MEMORY_AND_DISK)
    return Packed(rdd, n, width, many)


def vector_columns(dataset: DataFrame, features_col: str, labels: list[str], more: tuple[str, ...] = ()) -> tuple[DataFrame, list[str]]:
    """The vector's entries as columns x0, x1, ..."""
    first = dataset.select(features_col).first()
    if first is None:
        raise ValueError("no rows to learn from")
    width = len(first[0])
    x = vector_to_array(F.col(features_col)).alias("x")
    rows = dataset.select(x, *labels, *more)
    names = [f"_x{i}" for i in range(width)]
    return rows.select(*[F.col("x")[i].alias(n) for i, n in enumerate(names)], *labels, *more), names


def _groups(blocks: Iterator[Block], rows: int) -> Iterator[list[Block]]:
    group, held = [], 0
    for block in blocks:
        if group and held + len(block.x) > rows:
            yield group
            group, held = [], 0
        group.append(block)
        held += len(block.x)
    if group:
        yield group


def add_up(rdd: RDD, partial: Callable[[Any], Any], add: Callable[[Any, Any], Any], together: int | None = None) -> Any:
    """Sum of ``partial`` over all blocks, always added in the same order; None without blocks. With ``together`` it gets lists of
    neighbouring blocks that hold about so many rows."""

    def own(index: int, blocks: Any):
        total = None
        for block in _groups(blocks, together) if together else blocks:
            part = partial(block)
            total = part if total is None else add(total, part)
        return [] if total is None else [(index, total)]

    parts = rdd.mapPartitionsWithIndex(own)
    if rdd.getNumPartitions() > DIRECT:
        grouped = parts.map(lambda p: (p[0] // DIRECT, p)).groupByKey(max(1, rdd.getNumPartitions() // DIRECT))
        parts = grouped.map(lambda g: (g[0], _ordered_sum(list(g[1]), add)))
    found = parts.collect()  # one small sum per partition, or per group of them
    return _ordered_sum(found, add) if found else None


def _ordered_sum(parts: list[tuple[int, Any]], add: Callable[[Any, Any], Any]) -> Any:
    total = None
    for _, part in sorted(parts, key=lambda p: p[0]):
        total = part if total is None else add(total, part)
    return total
