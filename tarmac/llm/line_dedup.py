"""Line deduplication that can be extended and undone: exact reference counts behind sharded cuckoo filters.

A ledger holds one row for each different line key of each inserted text, with +1, or -1 once its document was deleted. From it
follows the exact table of references, split into shards by key: how many texts hold a key, which document comes first, and
whether a second document holds it. Each shard has a cuckoo filter of its keys that several documents share. Finding lines to
drop starts at the filters: ledger rows they deny, nearly all in common text, are settled in the scan; only the others meet the
exact table, so a false positive costs a join row and never a line. Inserting or deleting documents recounts the touched keys
from the ledger, rewrites the touched shards, and adds or takes out the fingerprints of keys that became or ceased to be shared.

Rows of a very common line are combined before they are shuffled; lines are 16-byte digests outside the first and last scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.cuckoo import CuckooFilter
from tarmac.llm.joins import BROADCAST_BYTES, sized, small_enough
from tarmac.plans.storage import materialize, stage_path

BLANKS = " \t\n\x0b\x0c\r"
#: Different keys that a shard is meant to hold.
SHARD_KEYS = 1_000_000
_KEY = ["_k1", "_k2"]
_TEXT = ["_doc", "_t"]


def line_key(line: str, least: int) -> bytes | None:
    """16-byte digest of the line without blanks at its ends and with A-Z lower-cased; None for a short line."""
    line = line.strip(BLANKS)
    return xxhash.xxh3_128_digest(line.encode("utf-8").lower()) if len(line) >= least else None


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def _keys_of(rows: DataFrame, least: int) -> DataFrame:
    """(_doc, _t, _k1, _k2) for each different key of each row of (_doc, _t, _text)."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, digests = [], []
            for i, text in enumerate(batch.column(2)):
                own = {line_key(line, least) for line in text.as_py().split("\n")} - {None}
                source.extend([i] * len(own))
                digests.extend(own)
            pair = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
            taken = pa.array(source, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(taken), batch.column(1).take(taken), pa.array(pair[:, 0]), pa.array(pair[:, 1])], [*_TEXT, *_KEY])

    kind = rows.schema["_doc"].dataType.simpleString()
    return rows.mapInArrow(keys, f"_doc {kind}, _t long, _k1 long, _k2 long")


def _build(shard: pd.DataFrame) -> pd.DataFrame:
    """Filter of a shard's shared keys, doubled until they fit."""
    size = len(shard)
    while True:
        made = CuckooFilter.for_keys(size)
        if made.insert(shard["_k1"].to_numpy(), shard["_k2"].to_numpy()):
            return pd.DataFrame({"_shard": [int(shard["_shard"].iloc[0])], "_filter": [made.to_bytes()]})
        size *= 2


def _change(key: tuple, old: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
    """A shard's filter after keys became shared (_add) or ceased to be; null if it has to be built anew."""
    made = CuckooFilter.from_bytes(old["_filter"].iloc[0]) if len(old) else CuckooFilter.for_keys(1)
    gone = changes[~changes["_add"]]
    made.remove(gone["_k1"].to_numpy(), gone["_k2"].to_numpy())
    new = changes[changes["_add"]]
    fits = not len(new) or made.insert(new["_k1"].to_numpy(), new["_k2"].to_numpy())
    return pd.DataFrame({"_shard": [int(key[0])], "_filter": [made.to_bytes() if fits else None]})


@dataclass(frozen=True)
class LineIndex:
    """State after some insertions and deletions: paths of written tables. Every change gives a new value; old ones stay valid."""

    spark: SparkSession
    least: int = 10
    shards: int = 0
    doc_type: str = "bigint"
    ledger: tuple[str, ...] = ()
    deleted: bool = False
    refs: dict[int, str] = field(default_factory=dict)
    filters: str | None = None

    def _ledger(self) -> DataFrame:
        return self.spark.read.schema(f"_doc {self.doc_type}, _t long, _k1 long, _k2 long, _change int").parquet(*self.ledger)

    def _shard(self) -> Column:
        return F.pmod(F.col("_k1"), F.lit(self.shards)).cast("int").alias("_shard")

    def _read_refs(self, shards: list[int] | None = None) -> DataFrame:
        schema = f"_k1 long, _k2 long, _refs long, _first {self.doc_type}, _shared boolean"
        paths = [p for s, p in self.refs.items() if shards is None or s in shards]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _recount(self, ledger: DataFrame, deleted: bool) -> DataFrame:
        rows = ledger.withColumn("_order", F.struct(F.col("_doc").isNull().alias("n"), F.col("_doc").alias("d")))
        if deleted:
            rows = rows.groupBy(*_KEY, "_order").agg(F.sum("_change").alias("_change")).where("_change > 0")
        counted = rows.groupBy(*_KEY).agg(F.sum("_change").alias("_refs"), F.min("_order").alias("_a"), F.max("_order").alias("_b"))
        return counted.select(*_KEY, "_refs", F.col("_a.d").alias("_first"), (~F.col("_a").eqNullSafe(F.col("_b"))).alias("_shared"))

    def _write_refs(self, refs: DataFrame) -> dict[int, str]:
        path = stage_path(self.spark, "line-refs")
        refs.withColumn("_shard", self._shard()).repartition("_shard").write.partitionBy("_shard").parquet(path)
        # a row per shard
        shards = self.spark.read.schema("_k1 long, _shard int").parquet(path).select("_shard").distinct().collect()
        return {r[0]: f"{path}/_shard={r[0]}" for r in shards}

    def _write_filters(self, filters: DataFrame) -> str:
        path = stage_path(self.spark, "line-filters")
        filters.write.parquet(path)
        return path

    def _read_filters(self) -> DataFrame:
        schema = "_shard int, _filter binary"
        return self.spark.read.schema(schema).parquet(self.filters) if self.filters else self.spark.createDataFrame([], schema)

    def _built(self, shards: list[int] | None = None) -> DataFrame:
        shared = self._read_refs(shards).where("_shared").select(*_KEY, self._shard())
        return shared.groupBy("_shard").applyInPandas(_build, "_shard int, _filter binary")

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        """The index with the texts of ``docs`` added. Rows that repeat an id belong to the same document; null is an id too."""
        text = _text(text_col)
        rows = docs.select(F.col(id_col).alias("_doc"), F.xxhash64(text).alias("_t"), text.alias("_text"))
        path = stage_path(self.spark, "line-ledger")
        _keys_of(rows, self.least).withColumn("_change", F.lit(1)).write.parquet(path)
        kind = rows.schema["_doc"].dataType.simpleString()
        if self.ledger:
            return replace(self, ledger=(*self.ledger, path))._touched(path)
        first = replace(self, ledger=(path,), doc_type=kind)
        counted = materialize(first._recount(first._ledger(), False), "line-counts")
        if not first.shards:
            first = replace(first, shards=max(8, -(-counted.count() // SHARD_KEYS)))
        first = replace(first, refs=first._write_refs(counted))
        return replace(first, filters=first._write_filters(first._built()))

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> LineIndex:
        """The index without the documents whose ids are in ``ids``; ids that it does not hold are ignored."""
        if not self.ledger:
            return self
        wanted = materialize(ids.select(F.col(id_col).alias("_gone")).distinct(), "line-deletions")
        held = self._ledger().groupBy(*_TEXT, *_KEY).agg(F.sum("_change").alias("_n")).where("_n > 0")
        held = held.join(sized(wanted), F.col("_doc").eqNullSafe(F.col("_gone")), "left_semi")
        path = stage_path(self.spark, "line-ledger")
        held.select(*_TEXT, *_KEY, (-F.col("_n")).cast("int").alias("_change")).write.parquet(path)
        return replace(self, ledger=(*self.ledger, path), deleted=True)._touched(path)

    def _touched(self, path: str) -> LineIndex:
        """Recount the keys of a new part of the ledger, and bring their shards and filters up to date."""
        keys = materialize(self.spark.read.parquet(path).select(*_KEY).distinct(), "touched-keys")
        shards = [r[0] for r in keys.select(self._shard()).distinct().collect()]  # a row per shard
        if not shards:
            return self
        now = materialize(self._recount(self._ledger().join(sized(keys), _KEY, "left_semi"), self.deleted), "touched-counts")
        before = self._read_refs(shards)
        was = before.where("_shared").join(sized(keys), _KEY, "left_semi").select(*_KEY, F.lit(True).alias("_was"))
        changes = now.where("_shared").select(*_KEY, F.lit(True).alias("_is")).join(was, _KEY, "full").where("_was is null or _is is null")
        changes = materialize(changes.select(*_KEY, self._shard(), F.col("_was").isNull().alias("_add")), "filter-changes")
        written = self._write_refs(before.join(sized(keys), _KEY, "left_anti").unionByName(now))
        out = replace(self, refs={**{s: p for s, p in self.refs.items() if s not in shards}, **written})
        filters = self._read_filters()
        changed = filters.groupBy("_shard").cogroup(changes.groupBy("_shard")).applyInPandas(_change, "_shard int, _filter binary")
        changed = materialize(changed, "line-filters")
        full = [r[0] for r in changed.where("_filter is null").select("_shard").collect()]  # shards at most
        if full:
            changed = changed.where("_filter is not null").unionByName(out._built(full))
        return replace(out, filters=out._write_filters(changed))

    def _perhaps_shared(self, rows: DataFrame) -> DataFrame:
        """Rows whose key is in its shard's filter; all rows if the filters are too large to be sent to the tasks."""
        filters = self._read_filters()
        total = filters.agg(F.sum(F.length("_filter"))).first()[0] or 0
        if total > BROADCAST_BYTES:
            return rows
        sent = self.spark.sparkContext.broadcast({r[0]: bytes(r[1]) for r in filters.collect()})
        shards = self.shards

        def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            made = {s: CuckooFilter.from_bytes(b) for s, b in sent.value.items()}
            for batch in batches:
                high, low = batch.column(2).to_numpy(), batch.column(3).to_numpy()
                shard, keep = high % shards, np.zeros(len(high), bool)
                for s in np.unique(shard):
                    if int(s) in made:
                        own = np.flatnonzero(shard == s)
                        keep[own] = made[int(s)].contains(high[own], low[own])
                yield batch.filter(pa.array(keep))

        return rows.mapInArrow(test, rows.schema)

    def dropped(self) -> DataFrame:
        """(_doc, _t, _keys): for each text that loses lines, the 16-byte keys it loses."""
        rows = self._ledger()
        if self.deleted:
            rows = rows.groupBy(*_TEXT, *_KEY).agg(F.sum("_change").alias("_n")).where("_n > 0")
        perhaps = materialize(self._perhaps_shared(rows.select(*_TEXT, *_KEY)).distinct(), "line-candidates")
        shared = materialize(self._read_refs().where("_shared").select(*_KEY, "_first"), "shared-lines")
        lost = perhaps.join(sized(shared), _KEY).where(~F.col("_doc").eqNullSafe(F.col("_first")))
        return lost.groupBy(*_TEXT).agg(F.collect_list(F.struct(*_KEY)).alias("_keys"))

    def kept_lines(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``id_col``, ``text_col`` without the lines that an earlier document holds, n_lines and n_dropped of every row.

        A line goes if its key (blanks at both ends off, A-Z lower-cased) has at least ``least`` code points and stands in two
        or more documents of the index, unless this is the one with the smallest id; null comes last. Repeated lines of that
        document all stay. Null and empty texts are one empty line; texts are read whole; other columns are not read; an empty
        table gives an empty result. Rows that the index does not hold stay as they are.
        """
        least = self.least

        @F.pandas_udf("text string, n long")
        def without(texts: pd.Series, keys: pd.Series) -> pd.DataFrame:
            out = []
            for text, lost in zip(texts, keys):
                if text is None:
                    out.append((None, 0))
                    continue
                gone = {int(k["_k1"]).to_bytes(8, "big", signed=True) + int(k["_k2"]).to_bytes(8, "big", signed=True) for k in lost}
                lines = text.split("\n")
                kept = [line for line in lines if line_key(line, least) not in gone]
                out.append(("\n".join(kept), len(lines) - len(kept)))
            return pd.DataFrame(out, columns=["text", "n"])

        lost = materialize(self.dropped(), "dropped-lines").select(F.col("_doc").alias("_d"), F.col("_t").alias("_lt"), "_keys")
        rows, entries = lost.agg(F.count("*"), F.coalesce(F.sum(F.size("_keys")), F.lit(0))).first()
        side = F.broadcast(lost) if small_enough(2 * rows + entries, 48) else lost
        text = _text(text_col)
        named = docs.select(F.col(id_col).alias("_doc"), text.alias("_text"), F.xxhash64(text).alias("_t"))
        joined = named.join(side, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_t") == F.col("_lt")), "left")
        changed = without(F.when(F.col("_keys").isNotNull(), F.col("_text")), F.col("_keys"))
        lines = (F.length("_text") - F.length(F.replace("_text", F.lit("\n"), F.lit(""))) + 1).cast("long")
        out = joined.select("_doc", "_text", lines.alias("_lines"), changed.alias("_c"))
        return out.select(
            F.col("_doc").alias(id_col), F.coalesce("_c.text", "_text").alias(text_col), F.col("_lines").alias("n_lines"), F.coalesce("_c.n", F.lit(0).cast("long")).alias("n_dropped")
        )


def deduplicate_lines(docs: DataFrame, least: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``kept_lines`` of a fresh index over ``docs``."""
    return LineIndex(docs.sparkSession, least).insert(docs, id_col, text_col).kept_lines(docs, id_col, text_col)
