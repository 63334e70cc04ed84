"""SimHash near-duplicates: pigeonhole blocks find candidate pairs of fingerprints, Hamming distance confirms them.

Fingerprints are made where the texts are read; after that only (id, fingerprint) moves, and pairs are sought between
different fingerprints. The 64 bits are cut into 5 blocks: fingerprints that differ in at most 3 bits agree on 2 blocks at
least, so they meet under one of 10 keys of about 26 bits, which keeps chance meetings rare.

Fingerprints under a key are paired directly while there are at most ``hot`` of them. Beyond that the members of the key meet
without pairs: each emits every value within 2 flipped bits of itself. If two fingerprints differ in at most 3 bits, some
value is at most 1 flip from one and at most 2 flips from the other, so linking all that emit a value to one fingerprint at
most 1 flip away gives the same components, with a number of links that grows with the members, not with their square.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.components import connected_components
from tarmac.llm.joins import keep_or_drop, kept_rows, key_columns
from tarmac.plans.storage import materialize

SHINGLE = 3
SEED = 42
DISTANCE = 3
#: Bit offsets of the blocks.
CUTS = [0, 13, 26, 39, 52, 64]
#: Different fingerprints under one key that are paired directly.
HOT_KEY = 1000
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_AT_ONCE = 1 << 18


def fingerprint(text: str) -> int:
    """Signed 64-bit SimHash of one text."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    begins = [0, *[e + 1 for e in ends[:-1]]]
    spans = list(zip(begins, ends[SHINGLE - 1 :], strict=False)) or [(0, len(line))]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(spans), _AT_ONCE):
        hashes = np.array([digest(line[a:b], SEED) for a, b in spans[at : at + _AT_ONCE]], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(spans), bitorder="little").view(np.int64)[0])


def with_fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    @F.pandas_udf("long")
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint(t) for t in batch], dtype="int64")

    return docs.select(*key_columns(id_col, text_col), fingerprints(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("_fp"))


def _block_keys(fp: str) -> list:
    keys = []
    for number, (i, j) in enumerate(combinations(range(len(CUTS) - 1), 2)):
        parts = [F.shiftrightunsigned(fp, CUTS[b]).bitwiseAND(F.lit((1 << (CUTS[b + 1] - CUTS[b])) - 1)) for b in (i, j)]
        keys.append(F.lit(number << 32) + F.shiftleft(parts[0], 13) + parts[1])
    return keys


def _flipped(fps: DataFrame) -> DataFrame:
    """(_fp, _v, _flips): each fingerprint and its values within 2 flipped bits, always 2,081 rows. Bit 64 stands for none."""
    first = fps.select("_fp", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("_a"))
    pairs = first.select("_fp", "_a", F.explode(F.sequence("_a", F.lit(64))).alias("_b")).where("_a < _b or _a = 64")
    masks = [F.expr(f"if({c} < 64, shiftleft(1L, {c}), 0L)") for c in ("_a", "_b")]
    value = F.col("_fp").bitwiseXOR(masks[0]).bitwiseXOR(masks[1])
    return pairs.select("_fp", value.alias("_v"), F.expr("int(_a < 64) + int(_b < 64)").alias("_flips"))


def fingerprint_links(fps: DataFrame, hot: int = HOT_KEY) -> DataFrame:
    """Links (src, dst) between different fingerprints (column ``_fp``, distinct) that give the components of distance 3."""
    blocks = fps.select("_fp", F.explode(F.array(*_block_keys("_fp"))).alias("_key"))
    shared = materialize(blocks.groupBy("_key").agg(F.count("*").alias("_n")).where("_n > 1"), "keys")
    busy = materialize(blocks.join(shared, "_key"), "busy")
    few = busy.where(F.col("_n") <= hot)
    other = few.select("_key", F.col("_fp").alias("_fp2"))
    close = F.bit_count(F.col("_fp").bitwiseXOR(F.col("_fp2"))) <= DISTANCE
    links = few.join(other, "_key").where((F.col("_fp") < F.col("_fp2")) & close).select(F.col("_fp").alias("src"), F.col("_fp2").alias("dst"))
    crowded = busy.where(F.col("_n") > hot).select("_fp").distinct()
    if crowded.isEmpty():
        return links
    emitted = _flipped(crowded)
    centres = emitted.where("_flips <= 1").groupBy("_v").agg(F.min("_fp").alias("_centre"))
    stars = emitted.join(centres, "_v").where("_fp <> _centre").select(F.col("_centre").alias("src"), F.col("_fp").alias("dst"))
    return links.union(stars)


def _grouped(docs: DataFrame, id_col: str, text_col: str, hot: int) -> DataFrame:
    """Keys and ``_fp`` of every row with ``_group`` (a fingerprint of its component) and ``_component`` (its smallest id)."""
    rows = materialize(with_fingerprints(docs, id_col, text_col), "fingerprints")
    fps = materialize(rows.groupBy("_fp").agg(F.min("_id").alias("_least")), "distinct-fingerprints")
    found = materialize(connected_components(fingerprint_links(fps.select("_fp"), hot)), "components")
    members = found.join(fps, F.col("node") == F.col("_fp")).select("_fp", "component", "_least")
    least = members.groupBy("component").agg(F.min("_least").alias("_component"))
    linked = materialize(members.join(least, "component").select("_fp", F.col("component").alias("_group"), "_component"), "linked")
    single = keep_or_drop(fps, linked, ["_fp"], keep=False, row_bytes=16).select("_fp", F.col("_fp").alias("_group"), F.col("_least").alias("_component"))
    return rows.join(linked.union(single), "_fp")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT_KEY) -> DataFrame:
    """``id_col``, fingerprint (16 hexadecimal digits) and component_id (smallest id reachable) of every row.

    Null texts count as empty and have fingerprint zero, as texts without words do; rows with equal fingerprints belong
    together; repeated rows stay, each with the same result; a null id is never a component id unless all ids of its component
    are null; other columns are not read; an empty table gives an empty result. ``hot`` changes the plan, never the result.
    """
    named = _grouped(docs, id_col, text_col, hot)
    return named.select(F.col("_id").alias(id_col), F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), F.col("_component").alias("component_id"))


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT_KEY) -> DataFrame:
    """Whole rows of ``docs``: of each component the one with the smallest id (null last)."""
    rows = materialize(_grouped(docs, id_col, text_col, hot).drop("_fp", "_component"), "grouped")
    key = F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("i"), F.col("_h1").alias("a"), F.col("_h2").alias("b"))
    best = materialize(rows.groupBy("_group").agg(F.min(key).alias("_best"), F.count("*").alias("_n")).where("_n > 1"), "representatives")
    judged = rows.join(best, "_group").withColumn("_kept", key.eqNullSafe(F.col("_best")))
    return kept_rows(docs, judged, id_col, text_col)
