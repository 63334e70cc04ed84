"""Order MinHash document fingerprints, with DataFrame operations only.

The k-mers of a text (k neighbouring words) are numbered by occurrence, so repeats count, and hashed. The smallest hashes are
selected, put back in text order, and each selected k-mer is hashed with the next one as a tuple. Two texts share a tuple only
if they share both k-mers in the same order with nothing selected between them, so likeness falls with every edit and move.

All work on one text happens inside its row with array functions. Arrays are sorted as plain longs that hold hash and place,
so no comparison leaves the JVM's primitive sort.

Each text meets the next document (descending id) without a global sort: ids are cut into blocks of ``BLOCK_IDS`` consecutive
numbers, a block is one window, and only the first row of a block is sent to the block before it as well. Texts are shuffled
once. The order of the blocks themselves is found on a table with one row per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.joins import sized
from tarmac.plans.ordering import global_index
from tarmac.plans.storage import materialize

K = 5
#: k-mers selected from a text.
SELECTED = 64
BLOCK_IDS = 64
_PLACE_BITS = 30
_PLACE = (1 << _PLACE_BITS) - 1
_LOWEST = -(1 << 62)


def with_sketch(rows: DataFrame, text: str, name: str) -> DataFrame:
    """Add column ``name``: the tuple hashes of a text, as ints in text order.

    The helper columns are separate projections that are each used more than once, so the planner does not merge them into
    the lambdas that read them.
    """
    words, kmers, order, starts, chosen = (f"{name}_{x}" for x in ("words", "kmers", "order", "starts", "chosen"))
    kept = [F.col(c) for c in rows.columns]
    none = F.array().cast("array<bigint>")
    found = F.regexp_extract_all(F.col(text), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    step = rows.select(*kept, F.transform(found, lambda w: F.xxhash64(w)).alias(words))

    def kmer(i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + j) for j in range(K)])

    count = F.size(words)
    made = F.when(count >= K, F.transform(F.sequence(F.lit(0), F.greatest(count - K, F.lit(0))), kmer))
    step = step.select(*kept, made.when(count > 0, F.array(F.xxhash64(words))).otherwise(none).alias(kmers))

    # hash above place; a first occurrence keeps the hash of its k-mer
    placed = F.transform(kmers, lambda h, i: h.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(i.cast("long")))
    repeats = (F.size(F.array_distinct(kmers)) < F.size(kmers)).alias(f"{name}_repeats")
    step = step.select(*kept, kmers, F.sort_array(placed).alias(order), repeats)

    # only where k-mers repeat: runs of equal ones lie side by side, in text order
    same = lambda j: F.shiftright(F.get(order, j), _PLACE_BITS) == F.shiftright(F.get(order, j - 1), _PLACE_BITS)
    runs = F.filter(F.sequence(F.lit(0), F.size(order) - 1), lambda j: (j == 0) | ~same(j))
    step = step.select(*kept, kmers, order, F.when(F.col(f"{name}_repeats"), runs).alias(starts))

    def later(j: Column, occurrence: Column) -> Column:
        place = F.get(order, j).bitwiseAND(F.lit(_PLACE))
        return F.xxhash64(F.get(kmers, place.cast("int")), occurrence).bitwiseAND(F.lit(~_PLACE)).bitwiseOR(place)

    def run(start: Column, number: Column) -> Column:
        end = F.coalesce(F.get(starts, number + 1), F.size(order))
        numbered = F.transform(F.sequence(start, end - 1), lambda j: F.when(j == start, F.get(order, j)).otherwise(later(j, j - start)))
        return F.when(end - start == 1, F.array(F.get(order, start))).otherwise(numbered)

    numbered = F.when(F.col(starts).isNull(), F.col(order)).otherwise(F.sort_array(F.flatten(F.transform(starts, run))))
    # the smallest, as place above hash, back in text order
    least = F.transform(F.slice(numbered, 1, SELECTED), lambda v: F.shiftleft(v.bitwiseAND(F.lit(_PLACE)), 63 - _PLACE_BITS).bitwiseOR(F.shiftrightunsigned(v, _PLACE_BITS + 1)))
    step = step.select(*kept, F.sort_array(least).alias(chosen))

    hash_at = lambda i: F.get(chosen, i).bitwiseAND(F.lit((1 << (63 - _PLACE_BITS)) - 1))
    n = F.size(chosen)
    pair = F.transform(F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0))), lambda i: F.shiftright(F.xxhash64(hash_at(i), F.coalesce(hash_at(i + 1), F.lit(-1).cast("long"))), 32).cast("int"))
    return step.select(*kept, F.when(n > 0, pair).otherwise(F.array().cast("array<int>")).alias(name))


def as_text(sketch: str) -> Column:
    """8 hexadecimal digits per tuple; empty for a text without words."""
    return F.array_join(F.transform(sketch, lambda x: F.lpad(F.lower(F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: str, b: str) -> Column:
    """Shared tuples among all different tuples of both; 1 for two texts without words."""
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def _blocks(ids: DataFrame) -> DataFrame:
    """Per block its highest id and the block before it in descending order; the block before the first is the last."""
    blocks = ids.groupBy("_block").agg(F.max("_id").alias("_top"))
    ordered = materialize(global_index(blocks, [F.col("_block").desc()], "_g"), "blocks")
    count = ordered.count()
    before = ordered.select(((F.col("_g") + 1) % F.lit(max(count, 1))).alias("_g"), F.col("_block").alias("_before"))
    return materialize(ordered.join(before, "_g").select("_block", "_top", "_before"), "blocks")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sketch: bool = True) -> DataFrame:
    """``_id``, ``_text`` and, of the next document in descending order of id, ``_next_text``; with ``_own`` and ``_next``
    sketches. Null ids come last; equal ids follow in order of a hash of their text."""
    block = F.coalesce(F.floor(F.col(id_col) / BLOCK_IDS).cast("long"), F.lit(_LOWEST))
    tops = _blocks(docs.select(F.col(id_col).alias("_id"), block.alias("_block")))
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"), block.alias("_block"))
    if sketch:
        rows = with_sketch(rows, "_text", "_own")
    tops = sized(tops.withColumnsRenamed({"_block": "_b", "_top": "_t"}), 40)
    marked = rows.join(tops, (F.col("_block") == F.col("_b")) & F.col("_id").eqNullSafe(F.col("_t")), "left")
    here, guest = F.struct(F.col("_block").alias("b"), F.lit(0).alias("guest")), F.struct(F.col("_before").alias("b"), F.lit(1).alias("guest"))
    spots = F.when(F.col("_before").isNotNull(), F.array(here, guest)).otherwise(F.array(here))
    dealt = marked.withColumn("_spot", F.explode(spots)).drop("_b", "_t", "_before", "_block")
    dealt = dealt.select("*", F.col("_spot.b").alias("_block"), F.col("_spot.guest").alias("_guest")).drop("_spot")
    along = Window.partitionBy("_block").orderBy("_guest", F.col("_id").desc_nulls_last(), F.xxhash64("_text"))
    following = [F.lead("_text").over(along).alias("_next_text")]
    if sketch:
        following.append(F.lead("_own").over(along).alias("_next"))
    return dealt.select("*", *following).where("_guest = 0").drop("_guest", "_block")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` (an integer), n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next per row.

    The edited text has its last half replaced by the beginning of the next document; the last document is followed by the
    first, a single one by itself. Null counts as empty, and texts without words have an empty fingerprint that is like another
    empty one only; texts of fewer than 5 words are one k-mer. Repeated rows are each other's next document; null ids come last
    and share one block. Other columns are not read; an empty table gives an empty result; texts are read whole.
    """
    rows = with_next(docs, id_col, text_col)
    n = F.length("_text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("_text", F.lit(1), n - half), F.substring("_next_text", F.lit(1), half))
    rows = rows.select("_id", n.cast("long").alias("n_chars"), "_own", "_next", edited.alias("_edited"))
    rows = rows.select("_id", "n_chars", "_own", "_next", "_edited", F.sha2("_edited", 256).alias("edited_sha256"))
    rows = with_sketch(rows, "_edited", "_changed")
    return rows.select(
        F.col("_id").alias(id_col), "n_chars", "edited_sha256", as_text("_own").alias("fingerprint"), as_text("_changed").alias("edited_fingerprint"),
        likeness("_own", "_changed").alias("near_edited"), likeness("_own", "_next").alias("near_next"),
    )
