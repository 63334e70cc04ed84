"""Line deduplication beside brute force, and its undoing."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import line_dedup as ld
from tarmac.llm.cuckoo import CuckooFilter
from tests.llm.conftest import ODD

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LINES = ["A line that is common ", "\ta line THAT is common", "Ünïcode Zeile É gleich", "ünïcode zeile É gleich", "short", "", "only here 1", "ten chars!", "a different line altogether"]


def corpus(n: int) -> list[tuple]:
    rows = [(i, "\n".join(LINES[(i * j + j) % len(LINES)] + (f" {i}" if (i + j) % 5 == 0 else "") for j in range(i % 7))) for i in range(n)]
    return [*rows, (3, "ten chars!\nten chars!\nmore text in this line"), (None, LINES[0] + "\nnull has this line"), (None, "null has this line"), (2, None)]


def brute(rows: list[tuple]) -> list[tuple]:
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(ld.BLANKS).translate(UPPER)
            if len(key) >= 10:
                holders[key].add(doc)
    first = {k: min(v, key=lambda d: (d is None, d)) for k, v in holders.items() if len(v) > 1}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        keys = [line.strip(ld.BLANKS).translate(UPPER) for line in lines]
        kept = [line for line, k in zip(lines, keys) if k not in first or first[k] == doc]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def got(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("bound", [None, 0])
def test_equals_brute_force(spark, monkeypatch, bound):
    if bound is not None:
        monkeypatch.setattr(ld, "BROADCAST_BYTES", bound)
    rows = corpus(40)
    result = got(ld.deduplicate_lines(frame(spark, rows)))
    assert result == brute(rows) and sum(r[3] for r in result) > 20


def test_insertions_and_deletions_equal_a_fresh_index(spark):
    rows = corpus(40)
    parts = [[r for r in rows if (r[0] or 0) % 3 == k] for k in range(3)]
    index = ld.LineIndex(spark, 10, shards=4).insert(frame(spark, parts[2]))
    alone = got(index.kept_lines(frame(spark, parts[2])))
    grown = index.insert(frame(spark, parts[0])).insert(frame(spark, parts[1]))
    assert got(grown.kept_lines(frame(spark, rows))) == brute(rows)
    ids = frame(spark, parts[0] + parts[1]).select("doc_id")
    undone = grown.delete(ids.union(spark.createDataFrame([(12345,)], "doc_id long")))
    assert got(undone.kept_lines(frame(spark, parts[2]))) == alone == brute(parts[2])
    again = undone.insert(frame(spark, parts[0]))
    assert got(again.kept_lines(frame(spark, parts[0] + parts[2]))) == brute(parts[0] + parts[2])
    assert got(undone._read_refs().orderBy("_k1", "_k2")) == got(index._read_refs().orderBy("_k1", "_k2"))


def test_filters_grow_when_they_are_full(spark):
    first = [(1, "the very first line"), (2, "the very first line")]
    many = [(d, "\n".join(f"line number {i} of many" for i in range(400))) for d in (3, 4)]
    index = ld.LineIndex(spark, 10, shards=1).insert(frame(spark, first)).insert(frame(spark, many))
    assert got(index.kept_lines(frame(spark, first + many))) == brute(first + many)


def test_odd_rows(spark, odd, none):
    rows = [(r[0], r[1]) for r in ODD]
    assert got(ld.deduplicate_lines(odd)) == brute(rows)
    assert ld.deduplicate_lines(none).collect() == []
    assert got(ld.deduplicate_lines(odd, id_col="_id")) == got(ld.deduplicate_lines(odd.withColumn("_id", F.lit("clash _id")), id_col="_id"))


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = rng.integers(-(2**63), 2**63, (2, 30_000))
    made = CuckooFilter.for_keys(20_000)
    assert made.insert(keys[0, :20_000], keys[1, :20_000])
    made = CuckooFilter.from_bytes(made.to_bytes())
    assert made.contains(keys[0, :20_000], keys[1, :20_000]).all()
    assert made.contains(keys[0, 20_000:], keys[1, 20_000:]).mean() < 0.01
    made.remove(keys[0, :10_000], keys[1, :10_000])
    assert made.contains(keys[0, 10_000:20_000], keys[1, 10_000:20_000]).all()
    assert made.contains(keys[0, :10_000], keys[1, :10_000]).mean() < 0.01
    full = CuckooFilter.for_keys(10)
    before = full.to_bytes()
    assert not full.insert(keys[0], keys[1]) and full.to_bytes() == before
