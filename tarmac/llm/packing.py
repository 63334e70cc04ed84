"""Token-id output packed into fixed-length rows by best fit decreasing.

Texts become token ids where they are read. Documents longer than a row are split into pieces without loss. Pieces are dealt
to shards by a hash of their document and, inside a shard, packed best fit decreasing: longest piece first, each into the row
with the least remaining space that holds it. The open rows are leaves of a segment tree over remaining capacities, so each
search takes logarithmic time. A shard holds about ``SHARD_TOKENS`` tokens whatever the size of the table, so more data means
more shards, not larger ones.

A packed row holds its ids as little-endian 16-bit numbers, the cumulative segment lengths, and the position of every id
inside its segment, which restarts at 0 with each segment.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.token_counts import split_words

ROW_TOKENS = 2048
SHARD_TOKENS = 4_000_000
#: Characters up to which the library cuts a text into words itself; its pattern runs out of stack on runs of some million.
WHOLE_CHARS = 1 << 18


class CapacityTree:
    """Remaining capacities 0..row as leaves that hold how many open rows have that capacity; inner nodes hold sums.

    The best fit for a piece is the first leaf at or right of its length that is not empty.
    """

    def __init__(self, row: int):
        self._leaves = 1 << row.bit_length()
        self._count = [0] * (2 * self._leaves)
        self._rows: list[list[int]] = [[] for _ in range(row + 1)]

    def add(self, capacity: int, row: int) -> None:
        self._rows[capacity].append(row)
        self._change(capacity, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """Capacity and number of the row with the smallest capacity of at least ``least``; it leaves the tree."""
        count, node = self._count, least + self._leaves
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):  # up until a right sibling has rows
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self._leaves:  # down, left first
                node *= 2
                if not count[node]:
                    node += 1
        capacity = node - self._leaves
        self._change(capacity, -1)
        return capacity, self._rows[capacity].pop()

    def _change(self, capacity: int, by: int) -> None:
        node = capacity + self._leaves
        while node:
            self._count[node] += by
            node >>= 1


def best_fit_decreasing(lengths: np.ndarray, row: int) -> np.ndarray:
    """Row number of each piece; no piece is longer than ``row``. Ties keep the given order."""
    tree, out, rows = CapacityTree(row), np.empty(len(lengths), np.int64), 0
    for piece in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[piece])
        found = tree.take(length)
        capacity, number = found or (row, rows)
        rows += found is None
        out[piece] = number
        if capacity > length:
            tree.add(capacity - length, number)
    return out


@lru_cache(maxsize=2)
def _encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    if max(table.values()) >= 1 << 16:
        raise ValueError("token ids must fit 16 bits")
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def text_ids(encoding: tiktoken.Encoding, text: str) -> bytes:
    """Ids of one text as little-endian 16-bit numbers."""
    if len(text) <= WHOLE_CHARS:
        return encoding.encode_to_numpy(text, disallowed_special=()).astype("<u2").tobytes()
    words, _ = split_words([text])
    known = {w: np.array(encoding._encode_single_piece(w), "<u2").tobytes() for w in set(words)}
    return b"".join(map(known.__getitem__, words))


def token_ids(text: Column, ranks_path: str, pattern: str) -> Column:
    """Ids of each text. The file of ranks is read on the driver and sent to the workers."""
    with open(ranks_path, "rb") as file:
        ranks = file.read()

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoding = _encoding(ranks, pattern)
        for batch in batches:
            yield pd.Series([text_ids(encoding, t) for t in batch], dtype=object)

    return encode(F.coalesce(text.cast("string"), F.lit("")))


def _pack_shard(row_tokens: int):
    def pack(shard: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows[rows["ids"].str.len() > 0].sort_values(["doc", "ids"], kind="stable", na_position="last")
        step, pieces, owner, part = 2 * row_tokens, [], [], []
        for doc, ids in zip(rows["doc"], rows["ids"], strict=True):
            for number, at in enumerate(range(0, len(ids), step)):
                pieces.append(ids[at : at + step])
                owner.append(None if pd.isna(doc) else int(doc))
                part.append(number)
        place = best_fit_decreasing(np.array([len(p) // 2 for p in pieces], np.int64), row_tokens)
        order = np.argsort(place, kind="stable")
        cuts = [*np.flatnonzero(np.diff(place[order], prepend=-1)).tolist(), len(order)]
        out = []
        for number, (a, b) in enumerate(pairwise(cuts)):
            own = order[a:b].tolist()
            sizes = np.array([len(pieces[p]) // 2 for p in own])
            ends = np.cumsum(sizes)
            positions = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
            out.append(
                (int(shard[0]), number, int(ends[-1]), b"".join([pieces[p] for p in own]), np.concatenate([[0], ends]).astype(np.int32), positions.astype("<u2").tobytes(), [owner[p] for p in own], [part[p] for p in own])
            )
        return pd.DataFrame(out, columns=["shard", "row", "n_tokens", "ids", "cu_seqlens", "position_ids", "doc_ids", "pieces"])

    return pack


PACKED = "shard long, row long, n_tokens long, ids binary, cu_seqlens array<int>, position_ids binary, doc_ids array<long>, pieces array<int>"


def pack_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", row_tokens: int = ROW_TOKENS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Packed rows: shard, row, n_tokens, ids, cu_seqlens, position_ids, and of each segment its doc_ids and piece number.

    Every token of every row is in exactly one packed row. Null and empty texts have no tokens and take no space; null ids are
    kept as null; repeated rows are each packed; other columns are not read; an empty table gives an empty result. A document
    of any length is split losslessly; the pieces of one document stay in one shard. The number of shards follows from the
    bytes of the texts, counted first.
    """
    if not 0 < row_tokens < 1 << 16:
        raise ValueError("positions must fit 16 bits")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    shards = max(1, total // (2 * shard_tokens))
    # texts without tokens travel as well: a filter on the ids would make Spark encode each text twice
    shard = F.pmod(F.xxhash64(F.col(id_col).cast("long"), F.when(F.col(id_col).isNull(), text)), F.lit(shards))
    rows = docs.select(shard.alias("shard"), F.col(id_col).cast("long").alias("doc"), token_ids(F.col(text_col), ranks_path, pattern).alias("ids"))
    return rows.groupBy("shard").applyInPandas(_pack_shard(row_tokens), PACKED)


def write_packed(packed: DataFrame, path: str) -> None:
    """One folder per shard with the packed rows in order."""
    packed.repartition("shard").sortWithinPartitions("shard", "row").write.mode("overwrite").partitionBy("shard").parquet(path)


def read_matrix(packed: DataFrame, row_tokens: int = ROW_TOKENS, fill: int = 0) -> DataFrame:
    """Packed rows as id arrays of equal length, filled up at the end."""

    @F.pandas_udf("array<int>")
    def unpack(ids: pd.Series) -> pd.Series:
        return ids.map(lambda b: np.pad(np.frombuffer(b, "<u2").astype(np.int32), (0, row_tokens - len(b) // 2), constant_values=fill))

    return packed.withColumn("matrix_row", unpack("ids"))
