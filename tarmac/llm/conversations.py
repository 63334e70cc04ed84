"""Repair of conversation structure by an audit of cheapest edits.

Roles of a repaired conversation read ``(s?(ua)+)?``: a system turn at most, then user and assistant in turn. Four states of that
language and the rows of a conversation span a dynamic program; each row is kept, given the role that the state asks for, or
deleted, and empty turns may be inserted. Each cell of the program holds its cheapest audit as the last node of a chain, so audits
share their beginnings. Nodes know their ancestors at distances of powers of two and a rolling hash of their chain; of two audits
of equal cost the smaller text is found by a search for their longest common beginning over those hashes, and the beginning is
verified on the nodes.

Rows are range-partitioned by conversation and turn, so a conversation of any length spreads over many tasks. A task settles
the conversations that lie wholly inside its range. For those at its borders it works out the cheapest audit from every state
to every state; these few tables are then chained per conversation, with the same nodes and comparison, and only the rows
themselves pass through one task, as a stream, because the digest of a conversation is one sequence.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.joins import sized
from tarmac.plans.storage import materialize

BLANKS = " \t\n\x0b\x0c\r"
#: States: nothing yet, after system, after user, after assistant. The role each asks for, and the state after it.
NEXT_ROLE = ("user", "user", "assistant", "user")
AFTER = (2, 2, 3, 2)
_KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
#: What completes a conversation that ends in a state.
_ENDINGS = {0: (0, ""), 1: (2 * INSERT, "II"), 2: (INSERT, "I"), 3: (0, "")}
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
_PRIME, _RADIX = (1 << 61) - 1, 1_000_003


def _steps(initial: str, truncated: bool) -> list[tuple[int, int, int, str]]:
    """(state, next state, cost, edits) of a row that may stay. An insertion right before a deletion costs the same as right
    after it and reads larger, so insertions stand before kept rows only; two in a row lead back and never pay."""
    out, extra = [], CUT_OFF * truncated
    for state in range(4):
        out.append((state, state, DELETE, "D"))
        for place, cost, edits in ((state, 0, ""), (AFTER[state], INSERT, "I")):
            out.append((state, AFTER[place], cost + REROLE + extra, edits + "R"))
            if (initial, place) in _KEPT:
                out.append((state, _KEPT[initial, place], cost + extra, edits + "K"))
    return out


STEPS = {(initial, truncated): _steps(initial, truncated) for initial in ("s", "u", "a", "") for truncated in (False, True)}


class Trails:
    """Audits as nodes that share their beginnings. A node adds a piece of text to its parent; chains that are compared hold
    equally many nodes, and of two different pieces at the same place none begins with the other."""

    def __init__(self) -> None:
        self.piece, self.hash, self.up = [""], [0], [[]]

    def add(self, parent: int, piece: str) -> int:
        jumps, at = [parent], parent
        while len(self.up[at]) >= len(jumps):
            at = self.up[at][len(jumps) - 1]
            jumps.append(at)
        self.piece.append(piece)
        self.hash.append((self.hash[parent] * _RADIX + int.from_bytes(piece.encode()) + 1) % _PRIME)
        self.up.append(jumps)
        return len(self.up) - 1

    def _same(self, a: int, b: int) -> bool:
        while a != b:
            if self.piece[a] != self.piece[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, end_a: str, b: int, end_b: str) -> bool:
        """Whether the audit at ``a`` followed by ``end_a`` is smaller than that at ``b`` followed by ``end_b``."""
        if a == b:
            return end_a < end_b
        if self.hash[a] == self.hash[b] and self._same(a, b):
            return end_a < end_b
        x, y = a, b
        for k in range(len(self.up[a]) - 1, -1, -1):
            if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                x, y = self.up[x][k], self.up[y][k]
        if self.piece[x] != self.piece[y] and self._same(self.up[x][0], self.up[y][0]):
            return self.piece[x] < self.piece[y]
        return self.text(a) + end_a < self.text(b) + end_b  # a hash stood for two beginnings

    def chain(self, node: int) -> list[int]:
        out = []
        while node:
            out.append(node)
            node = self.up[node][0]
        return out[::-1]

    def text(self, node: int) -> str:
        return "".join(self.piece[n] for n in self.chain(node))


Cells = dict[int, tuple[int, int]]


def advance(trails: Trails, cells: Cells, steps: list[tuple[int, int, int, str]]) -> Cells:
    """Cells (state: cost and node) after one more step: cheapest, then smallest audit."""
    best: dict[int, tuple[int, int, str]] = {}
    for state, after, cost, edits in steps:
        if state in cells:
            total, node = cells[state][0] + cost, cells[state][1]
            held = best.get(after)
            if held is None or total < held[0] or (total == held[0] and trails.less(node, edits, held[1], held[2])):
                best[after] = (total, node, edits)
    return {state: (total, trails.add(node, edits)) for state, (total, node, edits) in best.items()}


class Replay:
    """Messages that an audit leaves, row by row."""

    def __init__(self, state: int, audit: str) -> None:
        self._state, self._audit, self._at = state, audit, 0

    def _inserted(self) -> list[tuple[str, str]]:
        out = []
        while self._at < len(self._audit) and self._audit[self._at] == "I":
            out.append((NEXT_ROLE[self._state], ""))
            self._state, self._at = AFTER[self._state], self._at + 1
        return out

    def row(self, role: str, text: str | None, copies: int) -> list[tuple[str, str]]:
        out = self._inserted()
        edit = self._audit[self._at]
        if edit == "R":
            out.append((NEXT_ROLE[self._state], text))
            self._state = AFTER[self._state]
        elif edit == "K":
            out.append((role, text))
            self._state = _KEPT[role[0], self._state]
        self._at += copies
        return out

    def end(self) -> list[tuple[str, str]]:
        return self._inserted()


class Digest:
    """SHA-256 of ``role:text`` lines."""

    def __init__(self) -> None:
        self._hash, self._any = hashlib.sha256(), False

    def add(self, messages: list[tuple[str, str]]) -> None:
        for role, text in messages:
            self._hash.update(f"{chr(10) if self._any else ''}{role}:{text}".encode("utf-8"))
            self._any = True

    def hex(self) -> str:
        return self._hash.hexdigest()


class Stretch:
    """Consecutive rows of one conversation with the counts that can be added to those of the next stretch."""

    def __init__(self) -> None:
        self.rows: list[tuple[str, str | None, int, int]] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.first_turn = self.last_turn = self.first = self.last = None

    def add(self, turn: int | None, role: str, text: str | None, fault: int, copies: int) -> None:
        self.rows.append((role, text, fault, copies))
        again = copies if fault == DUPLICATE else copies - 1
        if fault == BLANK:
            self.blank += copies
        else:
            self.duplicate += again
        self.truncated += fault == TRUNCATED
        initial = role[:1]
        if self.last is not None:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        self.illegal += copies - 1
        self.first, self.last = initial if self.first is None else self.first, initial
        if turn is not None:
            self.distinct += turn != self.last_turn
            self.first_turn, self.last_turn = turn if self.first_turn is None else self.first_turn, turn

    def counts(self) -> dict:
        return {k: v for k, v in vars(self).items() if k != "rows"}

    def join(self, other: dict) -> None:
        """Add the counts of the stretch that follows."""
        for name in ("blank", "duplicate", "truncated", "illegal", "distinct"):
            setattr(self, name, getattr(self, name) + other[name])
        if other["first"] is not None:
            if self.last is not None:
                self.illegal += self.last + other["first"] not in ("su", "ua", "au")
            self.first, self.last = other["first"] if self.first is None else self.first, other["last"]
        if other["first_turn"] is not None:
            self.distinct -= other["first_turn"] == self.last_turn
            self.first_turn, self.last_turn = other["first_turn"] if self.first_turn is None else self.first_turn, other["last_turn"]

    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.distinct

    def cells(self, trails: Trails, state: int) -> Cells:
        cells: Cells = {state: (0, 0)}
        for role, _, fault, copies in self.rows:
            if fault in (BLANK, DUPLICATE):
                cells = {s: (cost + DELETE * copies, trails.add(node, "D" * copies)) for s, (cost, node) in cells.items()}
                continue
            initial = role[:1]
            cells = advance(trails, cells, STEPS[initial if initial in ("s", "u", "a") else "", fault == TRUNCATED])
            if copies > 1:
                cells = {s: (cost + DELETE * (copies - 1), trails.add(node, "D" * (copies - 1))) for s, (cost, node) in cells.items()}
        return cells


def finish(trails: Trails, cells: Cells) -> tuple[int, int, str]:
    """Cost, last node and closing edits of the best audit."""
    best = None
    for state, (cost, node) in cells.items():
        extra, edits = _ENDINGS[state]
        if best is None or cost + extra < best[0] or (cost + extra == best[0] and trails.less(node, edits, best[1], best[2])):
            best = (cost + extra, node, edits)
    return best


_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_OUT = "_part int, _kind int, _place long, _role string, _text string, _fault int, _copies long, _state string, _messages array<struct<role: string, text: string>>, " + _REPORT
_NAMES = [c.split()[0] for c in _REPORT.split(", ")]
#: Kinds of rows between the two passes: finished conversation, table of a stretch, row of a stretch.
_DONE, _TABLE, _ROW = range(3)


class _Writer:
    def __init__(self, conv_type: pa.DataType) -> None:
        message = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), message, *[pa.int64()] * 6, pa.string(), pa.string()]
        self.schema = pa.schema([("_conv", conv_type), *zip([*"_part _kind _place _role _text _fault _copies _state _messages".split(), *_NAMES], kinds)])
        self._rows: list[dict] = []

    def add(self, **row) -> None:
        self._rows.append(row)

    def full(self) -> bool:
        return len(self._rows) >= 2_000

    def batch(self) -> pa.RecordBatch:
        rows, self._rows = self._rows, []
        return pa.RecordBatch.from_pylist(rows, self.schema)


def _report(counts: Stretch, cost: int, audit: str, digest: str) -> dict:
    return {
        "gaps": counts.gaps(), "blank": counts.blank, "duplicate": counts.duplicate, "truncated": counts.truncated, "illegal": counts.illegal,
        "cost": cost, "audit": audit, "repaired_sha256": digest,
    }


def _first_pass(messages: bool):
    def settle(out: _Writer, part: int, conv, own: Stretch) -> None:
        trails = Trails()
        cost, node, ending = finish(trails, own.cells(trails, 0))
        audit = trails.text(node) + ending
        replay, digest, left = Replay(0, audit), Digest(), []
        for role, text, _, copies in own.rows:
            made = replay.row(role, text, copies)
            digest.add(made)
            left.extend(made)
        digest.add(made := replay.end())
        kept = [{"role": r, "text": t} for r, t in [*left, *made]] if messages else None
        out.add(_conv=conv, _part=part, _kind=_DONE, _place=0, _messages=kept, **_report(own, cost, audit, digest.hex()))

    def hand_on(out: _Writer, part: int, conv, own: Stretch) -> None:
        table = []
        for state in range(4):
            trails = Trails()
            table.extend((state, after, cost, trails.text(node)) for after, (cost, node) in own.cells(trails, state).items())
        out.add(_conv=conv, _part=part, _kind=_TABLE, _place=0, _state=json.dumps([own.counts(), table]))
        for i, (role, text, fault, copies) in enumerate(own.rows):
            out.add(_conv=conv, _part=part, _kind=_ROW, _place=i, _role=role, _text=text, _fault=fault, _copies=copies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, conv, own, before = TaskContext.get().partitionId(), None, None, None, False
        for batch in batches:
            out = out or _Writer(batch.schema.field(0).type)
            for key, turn, role, text, fault, copies in zip(*[c.to_pylist() for c in batch.columns]):
                if own is None or key != conv:
                    if own is not None:
                        (settle if before else hand_on)(out, part, conv, own)
                        before = True
                    conv, own = key, Stretch()
                if role is not None:
                    own.add(turn, role, text, fault, copies)
                if out.full():
                    yield out.batch()
        if own is not None:
            hand_on(out, part, conv, own)
            yield out.batch()

    return run


def _second_pass(messages: bool):
    """Stretches by conversation: first their tables in order, then their rows in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, conv, begun = None, None, False
        counts = trails = cells = digest = replay = None
        plan: dict[int, tuple[int, str]] = {}
        parts: list[int] = []
        reached: dict[int, int] = {}
        part, total = None, (0, "")

        def decide() -> None:
            nonlocal digest, total
            cost, node, ending = finish(trails, cells)
            state = 0
            for p, n in zip(parts, trails.chain(node), strict=True):
                plan[p] = (state, trails.piece[n])
                state = reached[n]
            total, digest = (cost, trails.text(node) + ending), Digest()
            plan[-1] = (state, ending)

        def end() -> None:
            if digest is None:
                decide()
            made = Replay(*plan[-1]).end()
            digest.add(made)
            kept = [{"role": r, "text": t} for r, t in made] if messages else None
            out.add(_conv=conv, _part=2**31 - 1, _kind=_DONE, _place=0, _messages=kept, **_report(counts, *total, digest.hex()))

        for batch in batches:
            out = out or _Writer(batch.schema.field(0).type)
            for key, p, kind, place, role, text, copies, table in zip(*[c.to_pylist() for c in batch.columns]):
                if not begun or key != conv:
                    if begun:
                        end()
                    conv, begun, counts, trails, cells, digest, replay, plan, parts, part = key, True, Stretch(), Trails(), {0: (0, 0)}, None, None, {}, [], None
                if kind == _TABLE:
                    own, steps = json.loads(table)
                    counts.join(own)
                    cells = advance(trails, cells, steps)
                    reached.update({node: state for state, (_, node) in cells.items()})
                    parts.append(p)
                    continue
                if digest is None:
                    decide()
                if p != part:
                    part, replay = p, Replay(*plan[p])
                made = replay.row(role, text, copies)
                digest.add(made)
                if messages and made:
                    out.add(_conv=conv, _part=p, _kind=_ROW, _place=place, _messages=[{"role": r, "text": t} for r, t in made])
                if out.full():
                    yield out.batch()
        if begun:
            end()
            yield out.batch()

    return run


def _faults(convs: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, copies: Column, gone: Column) -> DataFrame:
    """(_conv, _turn, _role, _text, _fault, _copies): equal rows of a conversation as one row with a number, faults judged, texts
    only where they may stay. A row without a role stands for a conversation that has lost a row."""
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role_col, text_col)]
    rows = convs.select(F.col(conv_col).alias("_conv"), F.col(turn_col).cast("long").alias("_turn"), filled[0].alias("_role"), filled[1].alias("_text"), copies.cast("long").alias("_copies"), gone.alias("_gone"))
    rows = rows.withColumns({"_d1": F.xxhash64("_text"), "_d2": F.xxhash64(F.lit(1), "_text")})
    key, order = ["_conv", "_role", "_d1", "_d2"], F.struct(F.col("_turn").isNotNull().alias("n"), F.col("_turn").alias("t"))
    seen = rows.where("not _gone").groupBy(*key).agg(F.count("*").alias("_n"), F.min(order).alias("_first")).where("_n > 1")
    seen = materialize(seen.select(*[F.col(c).alias(f"_s{c}") for c in key], "_first"), "repeated-turns")
    same = F.col("_conv").eqNullSafe(F.col("_s_conv")) & (F.col("_role") == F.col("_s_role")) & (F.col("_d1") == F.col("_s_d1")) & (F.col("_d2") == F.col("_s_d2"))
    joined = rows.join(sized(seen, 64), same & ~F.col("_gone"), "left").withColumn("_later", F.coalesce(order > F.col("_first"), F.lit(False)))
    stripped = F.rtrim("_text", F.lit(BLANKS))
    fault = F.when(stripped == "", BLANK).when(F.col("_later"), DUPLICATE).when(~F.substring(stripped, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)
    judged = joined.withColumn("_fault", fault)
    judged = judged.withColumn("_text", F.when(F.col("_fault").isin(SOUND, TRUNCATED), F.col("_text")))
    once = judged.where("_first is null and not _gone")
    several = judged.where("_first is not null and not _gone").groupBy("_conv", "_turn", "_role", "_d1", "_d2", "_fault").agg(F.sum("_copies").alias("_copies"), F.max("_text").alias("_text"))
    lost = judged.where("_gone").select("_conv").distinct()
    columns = ["_conv", "_turn", "_role", "_text", "_fault", "_copies", "_d1", "_d2"]
    return once.select(*columns).unionByName(several.select(*columns)).unionByName(lost, allowMissingColumns=True)


def _audits(convs: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, copies: Column | None, gone: Column | None, messages: bool) -> DataFrame:
    rows = _faults(convs, conv_col, turn_col, role_col, text_col, F.lit(1) if copies is None else copies, F.lit(False) if gone is None else gone)
    order = [F.col(c).asc_nulls_first() for c in ("_conv", "_turn", "_role", "_d1", "_d2")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("_conv", "_turn", "_role", "_text", "_fault", "_copies")
    kind = rows.schema["_conv"].dataType.simpleString()
    first = materialize(rows.mapInArrow(_first_pass(messages), f"_conv {kind}, {_OUT}"), "audits")
    open_ = first.where(F.col("_kind") != _DONE).select("_conv", "_part", "_kind", "_place", "_role", "_text", "_copies", "_state")
    open_ = open_.repartition("_conv").sortWithinPartitions("_conv", "_kind", "_part", "_place")
    second = open_.mapInArrow(_second_pass(messages), f"_conv {kind}, {_OUT}")
    return first.where(F.col("_kind") == _DONE).unionByName(second)


def repair_conversations(
    convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies: Column | None = None, gone: Column | None = None
) -> DataFrame:
    """One row per conversation: ``conv_col``, gaps, counts of blank, duplicate, truncated and illegal, cost, audit and
    repaired_sha256 (of ``role:text`` lines).

    Rows are taken by turn, null first; rows of one turn by role and digest of the text. A null role or text counts as one
    space; a null conversation is a conversation. ``copies`` says how often a row stands there, ``gone`` marks rows that are not
    there but whose conversation is reported. A row's first fault counts: blank, duplicate (role and text seen earlier),
    truncated (last character that is no blank is none of ``.!?``). Keeping costs 0, a new role 3, deleting 4 (blank and
    duplicate rows must go), an inserted empty turn 3, a truncated row that stays 3 more. Equal costs: the smallest audit.
    An empty table gives an empty result; other columns are not read; texts and conversations of any length are whole.
    """
    made = _audits(convs, conv_col, turn_col, role_col, text_col, copies, gone, messages=False)
    return made.select(F.col("_conv").alias(conv_col), *_NAMES)


def repaired_messages(
    convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies: Column | None = None, gone: Column | None = None
) -> DataFrame:
    """The messages that the audits leave: ``conv_col``, _part, _place and _number (their order inside a conversation), role and
    text. Edge cases as in ``repair_conversations``."""
    made = _audits(convs, conv_col, turn_col, role_col, text_col, copies, gone, messages=True)
    return made.select(F.col("_conv").alias(conv_col), "_part", "_place", F.posexplode("_messages").alias("_number", "_m")).select(conv_col, "_part", "_place", "_number", "_m.role", "_m.text")


def damage(convs: DataFrame) -> tuple[DataFrame, Column, Column]:
    """Repeatable damage for measurements: the crc of ``conv_id:turn`` drops a row, empties its text, takes out ``.!?``, doubles it
    or makes it a user's. Returns the rows with the columns that say how often each stands there and whether it is gone."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    how = F.crc32(key.cast("binary")) % 20
    text = F.when(how == 1, "").when(how == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = convs.select("conv_id", "turn", F.when(how == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), how.alias("how"))
    return rows, F.when(F.col("how") == 3, 2).otherwise(1), F.col("how") == 0
