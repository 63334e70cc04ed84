"""Conversation repair beside brute force over all edit sequences."""

import hashlib
import itertools
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tarmac.llm import conversations as cv

LEGAL = re.compile(r"(s?(ua)+)?")


def brute(rows: list[tuple]) -> tuple:
    """Report of one conversation, rows (turn, role, text) in order; every audit with one insertion at a place is tried, or two in short conversations."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.rstrip(cv.BLANKS)
        faults.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
        seen.add((role, text))
    best = None
    inserts = [[], ["user"], ["assistant"], *([["user", "assistant"], ["assistant", "user"]] if len(rows) < 3 else [])]
    edits = [[("D", 4, None)] if f in (1, 2) else [("D", 4, None), ("K", 3 * (f == 3), r), ("R", 3 + 3 * (f == 3), "user"), ("R", 3 + 3 * (f == 3), "assistant")] for (_, r, _), f in zip(rows, faults)]
    for chosen in itertools.product(*edits):
        for added in itertools.product(inserts, repeat=len(rows) + 1):
            audit, cost, out = "", 0, []
            for i in range(len(rows) + 1):
                for role in added[i]:
                    audit, cost = audit + "I", cost + 3
                    out.append((role, ""))
                if i < len(rows):
                    audit, cost = audit + chosen[i][0], cost + chosen[i][1]
                    if chosen[i][2] is not None:
                        out.append((chosen[i][2], rows[i][2]))
            if (best is None or (cost, audit) < best[:2]) and LEGAL.fullmatch("".join(r[:1] or "-" for r, _ in out)):
                best = (cost, audit, "\n".join(f"{r}:{x}" for r, x in out))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return gaps, faults.count(1), faults.count(2), faults.count(3), illegal, best[0], best[1], hashlib.sha256(best[2].encode()).hexdigest()


def conversation(rng: random.Random, n: int) -> list[tuple]:
    texts = ["Fine.", "Why?", "cut off", "", " \t", "Fine. ", None]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, ""]
    turns = sorted(rng.sample(range(9), n))
    return [(None if rng.random() < 0.05 and i == 0 else t, rng.choice(roles), rng.choice(texts)) for i, t in enumerate(turns)]


def frame(spark, convs: dict) -> object:
    rows = [(c, *r) for c, rs in convs.items() for r in rs]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


def got(df) -> dict:
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_reports_equal_brute_force(spark):
    rng = random.Random(3)
    convs = {i: conversation(rng, rng.randrange(1, 5)) for i in range(60)}
    convs[None] = conversation(rng, 3)
    expected = {c: brute(r) for c, r in convs.items()}
    assert got(cv.repair_conversations(frame(spark, convs))) == expected
    assert len({v[6] for v in expected.values()}) > 10


def test_one_long_conversation_over_many_tasks(spark):
    rng = random.Random(5)
    roles = ["user", "assistant", "user", "assistant", "system", "tool"]
    rows = [(i, rng.choice(roles), rng.choice(["Yes.", f"No {i}!", f"cut {i}"])) for i in range(700)]
    whole = cv.Stretch()
    seen = set()
    for turn, role, text in rows:
        fault = 2 if (role, text) in seen else 3 if text[-1] not in ".!?" else 0
        whole.add(turn, role, text, fault, 1)
        seen.add((role, text))
    trails = cv.Trails()
    cost, node, ending = cv.finish(trails, whole.cells(trails, 0))
    audit = trails.text(node) + ending
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = frame(spark, {1: rows[:5], 2: rows, 3: rows[:4]})
        made = got(cv.repair_conversations(df))
        messages = cv.repaired_messages(df).where("conv_id = 2").orderBy("_part", "_place", "_number").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert made[2][5:7] == (cost, audit)
    assert made[2][:5] == (0, whole.blank, whole.duplicate, whole.truncated, whole.illegal)
    assert LEGAL.fullmatch("".join(m.role[0] for m in messages))
    assert made[2][7] == hashlib.sha256("\n".join(f"{m.role}:{m.text}" for m in messages).encode()).hexdigest()
    assert made[1] == brute(rows[:5]) and made[3] == brute(rows[:4])


def test_stretches_chain_to_the_whole():
    rng = random.Random(7)
    for _ in range(200):
        rows = [(rng.choice(["user", "assistant", "system", "x"]), rng.choice([0, 0, 1, 2, 3])) for _ in range(rng.randrange(1, 12))]
        cut = rng.randrange(len(rows) + 1)

        def stretch(part):
            s = cv.Stretch()
            for role, fault in part:
                s.add(None, role, "t", fault, 1)
            return s

        trails = cv.Trails()
        cost, node, ending = cv.finish(trails, stretch(rows).cells(trails, 0))
        expected = (cost, trails.text(node) + ending)
        chain, cells = cv.Trails(), {0: (0, 0)}
        for part in (rows[:cut], rows[cut:]):
            table = []
            for state in range(4):
                own = cv.Trails()
                table += [(state, after, c, own.text(n)) for after, (c, n) in stretch(part).cells(own, state).items()]
            cells = cv.advance(chain, cells, table)
        cost, node, ending = cv.finish(chain, cells)
        assert (cost, chain.text(node) + ending) == expected


def test_equal_hashes_are_verified(monkeypatch):
    rng = random.Random(1)
    for prime in (cv._PRIME, 3, 1):
        monkeypatch.setattr(cv, "_PRIME", prime)
        trails, leaves = cv.Trails(), {0: [0]}
        for depth in range(1, 9):
            leaves[depth] = [trails.add(rng.choice(leaves[depth - 1]), rng.choice("DKR")) for _ in range(12)]
        for a, b in itertools.product(leaves[8], repeat=2):
            for x, y in (("", "I"), ("K", "D")):
                assert trails.less(a, x, b, y) == (trails.text(a) + x < trails.text(b) + y)


def test_repeats_copies_and_lost_rows(spark):
    rows = [(1, 0, "user", "Hi.", 1, False), (1, 0, "user", "Hi.", 2, False), (1, 1, "assistant", "Yes.", 1, False), (2, 0, "user", "Hi.", 1, True), (None, 5, "user", "Hi.", 1, True), (None, 6, "user", "Hi.", 1, False)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, c int, g boolean")
    made = got(cv.repair_conversations(df, copies=F.col("c"), gone=F.col("g")))
    hi = [(0, "user", "Hi.")]
    assert made == {1: brute([*hi * 3, (1, "assistant", "Yes.")]), 2: brute([]), None: brute([(6, "user", "Hi.")])}
    assert made[2] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


@pytest.mark.parametrize("kind", ["string", "long"])
def test_odd_tables(spark, kind):
    df = spark.createDataFrame([(1, 0, "user", "x" * 200_000 + ".", "c")] * 3, "conv_id long, turn long, role string, text string, _conv string")
    df = df.withColumn("conv_id", F.col("conv_id").cast(kind)).withColumns({c: F.lit("clash") for c in ("cost", "audit", "_part", "_text", "how", "_gone")})
    report = cv.repair_conversations(df).collect()
    assert [(r["duplicate"], r["cost"], r["audit"]) for r in report] == [(2, 11, "KDDI")]
    assert cv.repair_conversations(df.limit(0)).collect() == [] and cv.repaired_messages(df.limit(0)).collect() == []


def test_damage_reports_every_conversation(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows, copies, gone = cv.damage(df)
    made = got(cv.repair_conversations(rows, copies=copies, gone=gone))
    convs = defaultdict(list)
    for r in rows.withColumns({"c": copies, "g": gone}).orderBy("turn").collect():
        convs[r["conv_id"]].extend([] if r["g"] else [(r["turn"], r["role"], r["text"])] * r["c"])
    assert set(made) == set(convs)
    short = {c: r for c, r in convs.items() if len(r) <= 3}
    assert short and all(made[c] == brute(r) for c, r in short.items())
