"""Mixing sources to target weights along a time-varying curriculum, with DataFrame operations only.

A schedule gives the weight of each source over training time, as steps of equal length. Integrated weights share the words of
all sources; a target stops at a multiple of its source's size and the excess is shared again by weight. Inside a source
documents come in hash order, pass after pass; the words before a document, looked up in the inverse of the source's
cumulative demand, give its position in training. Rows are range-sorted by position.

Only ids, sizes and hashes move. Running sums restart per source but are computed in blocks, so a source that holds a large
part of all rows is spread over many tasks. The table of sources (one row each) is ranked and summed in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.joins import KEYS, key_columns, keyed, sized
from tarmac.plans.ordering import global_index, running_totals
from tarmac.plans.storage import materialize

#: Weights by rank of the source, repeating, for each step of training: all alike at first, then more for the later classes. Their
#: sums over time are in proportion 1, 2, 3.
CURRICULUM = [[2, 2, 2], [0, 2, 4]]
MOST_PASSES = 3
#: Rows of a source that one task sums before blocks begin to grow with the table.
BLOCK_ROWS = 4096


def word_count(text: Column) -> Column:
    """Number of runs of characters outside [\\x20\\x09-\\x0D]."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_targets(sizes: DataFrame, schedule: list[list[int]] = CURRICULUM, most_passes: int = MOST_PASSES) -> DataFrame:
    """Per source (``_source``, ``_total``): ``_target`` words and ``_demand``, the cumulative target after each step.

    With sources in order of the size at which they are full relative to weight, the shares of the k first full ones are their
    limits, and the rest is shared by weight; the first source whose share fits its limit decides.
    """
    width, steps = len(schedule[0]), len(schedule)
    if any(len(s) != width or min(s) < 0 for s in schedule) or any(sum(s[i] for s in schedule) == 0 for i in range(width)):
        raise ValueError("every step needs one weight per class, and every class a weight at some step")
    rank = F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())) - 1
    by_class = F.array(*[F.array(*[F.lit(int(s[i])) for s in schedule]) for i in range(width)])
    ranked = sizes.withColumn("_steps", F.get(by_class, F.pmod(rank, F.lit(width)).cast("int")))
    weight = F.aggregate("_steps", F.lit(0).cast("long"), lambda a, w: a + w)
    limited = ranked.withColumn("_weight", weight).withColumn("_limit", F.col("_total") * most_passes)
    by_fill = Window.orderBy(F.col("_limit") / F.col("_weight"), F.col("_source").asc_nulls_last())
    before, onward = by_fill.rowsBetween(Window.unboundedPreceding, -1), by_fill.rowsBetween(0, Window.unboundedFollowing)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shared = limited.select(
        "*",
        (F.sum("_total").over(every) - F.coalesce(F.sum("_limit").over(before), F.lit(0))).alias("_rest"),
        F.sum("_weight").over(onward).alias("_open"),
    )
    fits = F.col("_rest") * F.col("_weight") <= F.col("_limit") * F.col("_open")
    level = F.max(F.when(fits, F.col("_rest") / F.col("_open"))).over(every)  # the same for all that fit in exact arithmetic
    first = F.min(F.when(fits, F.struct((F.col("_limit") / F.col("_weight")).alias("f"), F.col("_source").isNull().alias("n"), F.col("_source").alias("s"), (F.col("_rest") / F.col("_open")).alias("v")))).over(every)
    level = F.coalesce(first["v"], level)
    share = F.least(F.col("_limit").cast("double"), level * F.col("_weight"))
    target = shared.withColumn("_target", share)
    so_far = F.transform(F.sequence(F.lit(1), F.lit(steps)), lambda k: F.aggregate(F.slice("_steps", F.lit(1), k), F.lit(0).cast("long"), lambda a, w: a + w))
    demand = F.transform(so_far, lambda s: F.when(s == F.col("_weight"), F.col("_target")).otherwise(F.col("_target") * s / F.col("_weight")))
    return target.select("_source", "_total", "_target", F.concat(F.array(F.lit(0.0)), demand).alias("_demand"))


def _position(words: Column, demand: Column) -> Column:
    """Training time, 0 to 1, at which a source's cumulative demand reaches ``words``."""
    steps = F.size(demand) - 1
    step = F.greatest(F.size(F.filter(demand, lambda d: d <= words)), F.lit(1)) - 1
    step = F.least(step, steps - 1)
    low, high = F.get(demand, step), F.get(demand, step + 1)
    inside = F.when(high > low, (words - low) / (high - low)).otherwise(F.lit(0.0))
    return F.when(steps == 1, inside).otherwise((step + inside) / steps)


def document_demand(docs: DataFrame, schedule: list[list[int]] = CURRICULUM, most_passes: int = MOST_PASSES, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row of ``docs``: its size in words, source_size, target, taken, position (of its first word taken), and what
    ``training_order`` needs.

    The last words that a source's target still asks for may end inside a document; ``taken`` then counts that part, so each
    source gives its target rounded to a whole word. Null texts have size 0, null is a source of its own and comes last, null
    ids come last inside a source; repeated rows each count; an empty table or one without words takes nothing; other columns
    are not read.
    """
    rows = docs.select(*key_columns(id_col, text_col), F.col(source_col).alias("_source"), word_count(F.col(text_col)).alias("_words"))
    rows = materialize(rows.withColumn("_hash", F.md5(F.col("_id").cast("string"))), "sizes")
    targets = materialize(source_targets(rows.groupBy("_source").agg(F.sum("_words").alias("_total")), schedule, most_passes), "targets")
    order = [F.col("_hash").asc_nulls_last(), F.col("_id").asc_nulls_last(), F.col("_words")]
    summed = running_totals(rows, order, {"_upto": "_words"}, ["_source"], at_least=BLOCK_ROWS)
    known = targets.withColumnRenamed("_source", "_s")
    placed = summed.join(known, F.col("_source").eqNullSafe(F.col("_s"))).withColumn("_before", F.col("_upto") - F.col("_words"))
    asked = F.floor(F.col("_target") + 0.5)
    whole = F.when(F.col("_total") > 0, F.expr("floor(_target + 0.5) div nullif(_total, 0)")).otherwise(0)
    placed = placed.withColumn("_whole", whole.cast("long")).withColumn("_left", asked - F.col("_whole") * F.col("_total"))
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("_words"), F.col("_left") - F.col("_before")))
    placed = placed.withColumn("_tail", part).withColumn("_taken", F.col("_whole") * F.col("_words") + F.col("_tail"))
    position = F.when(F.col("_taken") > 0, _position(F.col("_before").cast("double"), F.col("_demand")))
    return placed.select(
        F.col("_id").alias(id_col), F.col("_source").alias(source_col), F.col("_words").alias("size"), F.col("_total").alias("source_size"), F.col("_target").alias("target"),
        F.col("_taken").alias("taken"), position.alias("position"), *KEYS, "_before", "_whole", "_tail", "_demand",
    )


def _passes(demand: DataFrame) -> DataFrame:
    """One row per document and pass with words: its pass, words and position, beside the columns of ``demand``."""
    passes = F.filter(
        F.transform(F.sequence(F.lit(0).cast("long"), F.col("_whole")), lambda p: F.struct(p.alias("no"), F.when(p < F.col("_whole"), F.col("size")).otherwise(F.col("_tail")).alias("words"))),
        lambda p: p["words"] > 0,
    )
    rows = demand.withColumn("_pass", F.explode(passes))
    begin = (F.col("_before") + F.col("_pass.no") * F.col("source_size")).cast("double")
    return rows.withColumns({"pass": F.col("_pass.no"), "words": F.col("_pass.words"), "position": _position(begin, F.col("_demand"))})


def training_order(demand: DataFrame) -> DataFrame:
    """One row per document and pass, with the words taken in that pass and its position, range-sorted by position."""
    order = ["position", "_h1", "_h2", "pass"]
    ids = [c for c in demand.columns if not c.startswith("_") and c not in ("taken", "position", "target", "source_size")]
    return _passes(demand).select(*ids, *KEYS, "pass", "words", "position").repartitionByRange(*order).sortWithinPartitions(*order)


def mixed_rows(docs: DataFrame, schedule: list[list[int]] = CURRICULUM, most_passes: int = MOST_PASSES, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Whole rows of ``docs``, each as often as the mix takes it, range-sorted by position. A pass that takes only a part of a
    document counts if it takes at least half, so a source gives its target to within half a document. Every row answers for itself:
    rows that agree in id, text and source are numbered, and take the passes of the same number."""
    demand = document_demand(docs, schedule, most_passes, id_col, text_col, source_col)
    demand = materialize(demand.withColumn("_source", F.col(source_col)), "demand")
    several = demand.groupBy(*_ROW_KEY).agg(F.count("*").alias("_n")).where("_n > 1").select(*_ROW_KEY)
    several = materialize(several, "repeats")  # no rows unless some agree in id, text and source
    rows = keyed(docs, id_col, text_col).withColumn("_source", F.col(f"_row.{source_col}"))
    if several.isEmpty():
        demand, rows = demand.withColumn("_copy", F.lit(0).cast("long")), rows.withColumn("_copy", F.lit(0).cast("long"))
    else:
        demand = _numbered(demand, several, [F.col("_before")])
        rows = _numbered(rows, several, [F.to_json("_row")])
    taken = _passes(demand).where("2 * words >= size").select(*_ROW_KEY, "_copy", "pass", "position")
    taken = materialize(taken, "passes")
    order = ["position", "_h1", "_h2", "pass", "_copy"]
    mixed = _same_key(rows, sized(taken, 96), [*_ROW_KEY, "_copy"]).repartitionByRange(*order).sortWithinPartitions(*order)
    return mixed.select("_row.*")


#: Columns in which a row agrees with its demand.
_ROW_KEY = [*KEYS, "_source"]


def _same_key(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Null-safe join on columns of one name, which the result holds once."""
    named = right.withColumnsRenamed({c: f"_r{c}" for c in on})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r{c}")) for c in on])
    return left.join(named, same, how).drop(*[f"_r{c}" for c in on])


def _numbered(rows: DataFrame, several: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``_copy``: 0, or the place among the rows of a key in ``several``. Those are ordered over range partitions,
    so a key that many rows share does not meet in one task; rows equal in ``order`` may take each other's place."""
    single = _same_key(rows, sized(several, 48), _ROW_KEY, "left_anti").withColumn("_copy", F.lit(0).cast("long"))
    shared = _same_key(rows, sized(several, 48), _ROW_KEY, "left_semi").withColumn("_tie", F.monotonically_increasing_id())
    placed = global_index(shared, [*[F.col(c) for c in _ROW_KEY], *order, F.col("_tie")], "_at")
    starts = materialize(placed.groupBy(*_ROW_KEY).agg(F.min("_at").alias("_first")), "repeat-starts")
    placed = _same_key(placed, sized(starts, 56), _ROW_KEY).withColumn("_copy", F.col("_at") - F.col("_first"))
    return single.unionByName(placed.select(*single.columns))


def range_sorted(demand: DataFrame) -> DataFrame:
    """Documents by position; those the mix leaves out come last."""
    visible = [c for c in demand.columns if not c.startswith("_")]
    order = [F.col("position").asc_nulls_last(), F.col(visible[0])]
    return demand.select(*visible).repartitionByRange(*order).sortWithinPartitions(*order)
