"""Exact duplicates by progressive refinement, with DataFrame operations only.

The first scan groups rows by the length of the normalised text and a hash of its prefix; a group of one is done. Only for
rows of larger groups does a second scan hash the full content. Of rows that agree on length and full hash, one stays.

What is shuffled are counts per group and, for the rows that survive, their hashes; texts never move. The keys of surviving
groups go to all tasks if a count shows that they are small; if they are not, the second scan hashes every row instead, with
the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.joins import KEYS, kept_rows, key_columns, small_enough
from tarmac.plans.storage import materialize

#: Characters that do not count, [\x20\x09-\x0D].
IGNORED = " \t\n\x0b\x0c\r"
#: Characters of the normalised text that the prefix hash covers.
PREFIX = 64
_KEY_BYTES = 32


def normalised(text: Column) -> Column:
    for character in IGNORED:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def _judged(docs: DataFrame, id_col: str, text_col: str, digest_all: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """Rows compared in full, and rows known to be alone without that (None if all were compared)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    plain = docs.select(*key_columns(id_col, text_col), F.length(text).cast("long").alias("_chars"), normalised(text).alias("_text"))
    keyed = plain.select("*", F.length("_text").alias("_len"), F.xxhash64(F.substring("_text", 1, PREFIX)).alias("_prefix"))
    groups = materialize(keyed.groupBy("_len", "_prefix").agg(F.count("*").alias("_n")).where("_n > 1"), "candidates").drop("_n")
    full = F.sha2("_text", 256).alias("_sha")
    wanted = [*KEYS, "_chars", "_len", full]
    if small_enough(groups.count(), _KEY_BYTES):
        keys = F.broadcast(groups)
        hashed = keyed.join(keys, ["_len", "_prefix"], "left_semi").select(*wanted)
        alone = keyed.join(keys, ["_len", "_prefix"], "left_anti").select("_id", full if digest_all else F.lit(None).cast("string").alias("_sha"))
    else:
        hashed, alone = keyed.select(*wanted), None
    rows = materialize(hashed.withColumn("_row", F.monotonically_increasing_id()), "hashed")
    best = F.min(F.struct((-F.col("_chars")).alias("c"), F.col("_id").isNull().alias("n"), F.col("_id").alias("i"), F.col("_row").alias("r")))
    # written, so that adaptive execution may split the join with a large group
    winners = materialize(rows.groupBy("_sha", "_len").agg(best.alias("_best"), F.count("*").alias("_size")), "winners")
    judged = rows.join(winners, ["_sha", "_len"])
    return judged.select(*KEYS, F.col("_best.i").alias("_keep"), "_size", (F.col("_row") == F.col("_best.r")).alias("_kept"), "_sha"), alone


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Whole rows of ``docs`` that stay; edge cases as in ``exact_groups``."""
    judged, _ = _judged(docs, id_col, text_col)
    return kept_rows(docs, judged, id_col, text_col)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False) -> DataFrame:
    """``id_col``, keep_id, group_size, kept and text_sha256 of every row.

    Equal are texts that agree after deletion of white space; null counts as empty, so null, empty and blank texts are one
    group. The row with most code points in the original text stays, then the smallest id (null last). Of repeated rows with
    the same id and text exactly one is marked as kept. text_sha256 is null for rows that were never read in full, unless
    ``digest_all``. Other columns are not read; an empty table gives an empty result; texts are read whole.
    """
    judged, alone = _judged(docs, id_col, text_col, digest_all)
    out = judged.select("_id", "_keep", "_size", "_kept", "_sha")
    if alone is not None:
        out = out.union(alone.select("_id", F.col("_id").alias("_keep"), F.lit(1).cast("long").alias("_size"), F.lit(True).alias("_kept"), "_sha"))
    return out.select(
        F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"), F.col("_kept").alias("kept"), F.col("_sha").alias("text_sha256")
    )
