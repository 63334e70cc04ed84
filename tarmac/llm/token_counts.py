"""Token counts of byte-level BPE by compiled finite-state transducers.

Two deterministic machines replace the tokenizer library.

* The *splitter* reads character classes (each with its fixed look-ahead folded in) and emits 1 where a word of the
  tokenizer's split pattern begins. It has 8 states, so the effect of a whole chunk of text is a map of 8 states to 8
  states. Chunks of all texts of a slice are mapped side by side, the maps of one text are composed by a parallel prefix
  scan, and a second pass with the now known entry states emits the word starts.
* The *word machine* reads the bytes of a word. Its state is the longest vocabulary prefix that ends here (a node of the
  automaton compiled from the vocabulary) with the tokens that end the prefixes so far; a transition finds the one token
  that can end the new prefix, so the tokens emitted up to there are one more than at the start of that token. A token may
  follow another only if no merge across their border would have come first; that test is compiled from the merge ranks and
  remembered per pair. Every distinct word of a slice runs once, all words in step.

Nothing shuffles: each row is counted where it is read.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from tarmac.llm.arrays import REMEMBERED, PairTable, code_points, slices

#: Characters per chunk of the prefix scan.
CHUNK = 256
#: Words longer than this many bytes run alone, one byte at a time.
LONG_WORD = 4096

# Fixed values of the split pattern: white space, and the endings split off after an apostrophe.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]

# character classes, then symbols: classes of white space are split by whether a visible character follows
LETTER, NUMBER, OTHER, BLANK, SPACE = range(5)
BLANK_LAST, SPACE_LAST, ENDING_1, ENDING_2 = range(5, 9)
SYMBOLS = 9
# states: after no word, in a run of a class, inside an ending with 2 or 1 letters to go
FRESH, IN_LETTER, IN_NUMBER, IN_OTHER, IN_BLANK, IN_SPACE, GO_2, GO_1 = range(8)
STATES = 8


@lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """Class of every code point. Where two Unicode versions at hand differ, the tokenizer's own splitting decides."""
    every = "".join(map(chr, range(0x110000)))
    table = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for run in regex.finditer(pattern, every):
            table[run.start() : run.end()] = kind
    older = np.array([{"L": LETTER, "N": NUMBER}.get(unicodedata.category(c)[0], OTHER) for c in every], np.uint8)
    split = ByteLevel(add_prefix_space=False).pre_tokenize_str
    for point in np.flatnonzero(table != older):
        for kind, neighbour in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
            if len(split(neighbour + every[point])) == 1:
                table[point] = kind
    table[WHITE_SPACE] = SPACE
    table[0x20] = BLANK
    return table


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and emission, both indexed by symbol * STATES + state."""
    after = np.zeros((SYMBOLS, STATES), np.uint8)
    emits = np.ones((SYMBOLS, STATES), np.uint8)
    for kind, run in ((LETTER, IN_LETTER), (NUMBER, IN_NUMBER), (OTHER, IN_OTHER)):
        after[kind] = run
        emits[kind, [run, IN_BLANK]] = 0  # a single blank belongs to the run that follows it
    after[LETTER, GO_2], emits[LETTER, GO_2] = GO_1, 0
    after[LETTER, GO_1], emits[LETTER, GO_1] = FRESH, 0
    for symbol, run in ((BLANK, IN_BLANK), (SPACE, IN_SPACE), (BLANK_LAST, IN_BLANK), (SPACE_LAST, IN_SPACE)):
        after[symbol] = run
    for symbol in (BLANK, SPACE):  # only the last one before a visible character leaves a run of white space
        emits[symbol, [IN_BLANK, IN_SPACE]] = 0
    for symbol, go in ((ENDING_1, GO_1), (ENDING_2, GO_2)):
        after[symbol] = go
        after[symbol, [IN_OTHER, IN_BLANK]], emits[symbol, [IN_OTHER, IN_BLANK]] = IN_OTHER, 0
    return after.ravel(), emits.ravel()


NEXT_STATE, EMITS = _splitter()


def split_symbols(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Symbols of concatenated texts; ``bounds`` are the places where texts begin, and the end."""
    symbols = character_classes()[points]
    inner = np.ones(len(points), bool)  # whether the next character belongs to the same text
    inner[bounds[1:] - 1] = False
    following = np.empty_like(points)
    following[:-1] = points[1:]
    visible = np.zeros(len(points), bool)
    visible[:-1] = symbols[1:] < BLANK
    visible &= inner
    quote = np.flatnonzero((points == ord("'")) & inner)
    symbols[(symbols == BLANK) & visible] = BLANK_LAST
    symbols[(symbols == SPACE) & visible] = SPACE_LAST
    first = following[quote]
    for ending in ENDINGS:
        at = quote[first == ord(ending[0])]
        if len(ending) == 2:
            at = at[inner[at + 1]]
            at = at[following[at + 1] == ord(ending[1])]
        symbols[at] = ENDING_1 if len(ending) == 1 else ENDING_2
    return symbols


def word_starts(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Emissions of the splitter over concatenated, non-empty texts."""
    per_text = -(-np.diff(bounds) // CHUNK)
    text = np.repeat(np.arange(len(per_text)), per_text)
    place = np.arange(len(text)) - (np.cumsum(per_text) - per_text)[text]
    begin = bounds[:-1][text] + place * CHUNK
    size = np.minimum(CHUNK, bounds[1:][text] - begin)
    order = np.argsort(-size, kind="stable")
    starts, active = begin[order], np.searchsorted(-size[order], -np.arange(1, size.max() + 1), side="right")

    run = np.tile(np.arange(STATES, dtype=np.uint8), (len(order), 1))
    for step, k in enumerate(active):
        run[:k] = NEXT_STATE[symbols[starts[:k] + step].astype(np.intp)[:, None] * STATES + run[:k]]
    maps = np.empty_like(run)
    maps[order] = run

    stride = 1
    while stride < per_text.max():
        at = np.flatnonzero(place >= stride)
        maps[at] = np.take_along_axis(maps[at], maps[at - stride].astype(np.intp), axis=1)
        stride *= 2
    state = np.full(len(text), FRESH, np.uint8)
    later = np.flatnonzero(place > 0)
    state[later] = maps[later - 1, FRESH]

    emitted = np.empty(len(symbols), bool)
    state = state[order]
    for step, k in enumerate(active):
        at = starts[:k] + step
        key = symbols[at].astype(np.intp) * STATES + state[:k]
        emitted[at] = EMITS[key]
        state[:k] = NEXT_STATE[key]
    return emitted


def byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in byte-level vocabularies: printable bytes stand for themselves, others follow from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordMachine:
    """Tokens of single words. Tokens are numbered by merge rank: bytes first, then merges in order."""

    def __init__(self, vocabulary: bytes):
        letters = byte_letters()
        model = json.loads(vocabulary)
        added = model.get("added_tokens") or []
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens that take up their surroundings are not supported")
        longest_first = sorted((t["content"] for t in added), key=lambda c: (-len(c), c))
        self.special = re.compile("|".join(map(re.escape, longest_first))) if added else None
        merges = model["model"]["merges"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in merges]
        spelled = {bytes([b]): b for b in range(256)}
        self.bytes_of = [bytes([b]) for b in range(256)]
        left, right = list(range(256)), list(range(256))
        for one, two in merges:
            one, two = (bytes(letters[c] for c in x) for x in (one, two))
            if one + two in spelled:
                raise ValueError("two merges make the same token")
            spelled[one + two] = len(left)
            self.bytes_of.append(one + two)
            left.append(spelled[one])
            right.append(spelled[two])
        self.left, self.right = np.array(left), np.array(right)
        self.size = np.array([len(b) for b in self.bytes_of])
        self._none = len(left)
        made = np.arange(256, self._none)
        self._merged = PairTable(self.left[256:], self.right[256:], made, self._none)
        self._compile(self._stand_alone(made))
        bits = 21
        self._shift = np.uint64(64 - bits)
        self._pairs = np.full(1 << bits, -1, np.int64)
        self._apart = np.zeros(1 << bits, bool)

    def _stand_alone(self, made: np.ndarray) -> list[bool]:
        """Whether the spelling of each token is tokenized as that one token."""
        alone = [True] * 256
        for token, fits in zip(made, self._stay_apart(self.left[256:], self.right[256:], made), strict=True):
            alone.append(bool(fits) and alone[self.left[token]] and alone[self.right[token]])
        return alone

    def _compile(self, usable: list[bool]) -> None:
        """Automaton over bytes whose nodes are the prefixes of tokens: transitions, token here, next shorter token."""
        tokens = [(b, t) for t, b in enumerate(self.bytes_of) if usable[t]]
        nodes: dict[bytes, int] = {b"": 0}
        for spelling, _ in sorted(tokens):
            for end in range(1, len(spelling) + 1):
                nodes.setdefault(spelling[:end], len(nodes))
        n = len(nodes)
        goto = np.zeros((n, 256), np.int32)
        self.token = np.full(n, -1, np.int32)
        for spelling, token in tokens:
            self.token[nodes[spelling]] = token
        self.shorter, fall = np.zeros(n, np.int32), np.zeros(n, np.int32)
        levels: dict[int, list[tuple[int, int, int]]] = {}
        for prefix, node in nodes.items():
            if prefix:
                levels.setdefault(len(prefix), []).append((node, nodes[prefix[:-1]], prefix[-1]))
        for depth in sorted(levels):  # rows of shallower nodes are complete
            node, parent, byte = np.array(levels[depth]).T
            if depth > 1:
                fall[node] = goto[parent, byte]
            goto[parent, byte] = node
            goto[node] = goto[fall[node]]
            self.shorter[node] = np.where(self.token[fall[node]] >= 0, fall[node], self.shorter[fall[node]])
        self.goto = goto.ravel()

    def _stay_apart(self, left: np.ndarray, right: np.ndarray, before: np.ndarray | int | None = None) -> np.ndarray:
        """Whether no merge crosses the border of two neighbouring tokens, looking back in merge order from ``before``.

        Undoes the later of the two tokens' merges again and again; at each point in time the pieces at the border must not
        have had a merge of their own that was due earlier. Of equal merges the left one comes first.
        """
        a, b = left.astype(np.int64), right.astype(np.int64)
        due = np.full(len(a), self._none, np.int64)
        if before is not None:
            due[:] = before
        apart = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            crossed = self._merged.get(a[live], b[live]) < due[live]
            apart[live[crossed]] = False
            live = live[~crossed]
            live = live[np.maximum(a[live], b[live]) >= 256]
            x, y = a[live], b[live]
            undo_left = x > y
            due[live] = np.where(undo_left, x, y + 1)
            a[live] = np.where(undo_left, self.right[x], x)
            b[live] = np.where(undo_left, y, self.left[y])
        return apart

    def may_follow(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``_stay_apart`` with a table of pairs already asked for; a slot keeps the pair that came last."""
        pair = (left.astype(np.int64) << 32) | right
        slot = ((pair.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.intp)
        out = self._apart[slot]
        new = np.flatnonzero(self._pairs[slot] != pair)
        if len(new):
            out[new] = self._stay_apart(left[new], right[new])
            self._pairs[slot[new]] = pair[new]
            # two new pairs may share a slot: the flag must be that of the pair that stayed
            stayed = new[self._pairs[slot[new]] == pair[new]]
            self._apart[slot[stayed]] = out[stayed]
        return out

    def count(self, words: list[bytes]) -> np.ndarray:
        """Number of tokens of each word."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        out = np.zeros(len(words), np.int64)
        for w in np.flatnonzero(sizes > LONG_WORD):
            out[w] = self._count_alone(words[w])
        fit = np.flatnonzero(sizes <= LONG_WORD)
        fit = fit[np.argsort(-sizes[fit], kind="stable")]
        if not len(fit) or not sizes[fit[0]]:
            return out
        sizes = sizes[fit]
        data = np.frombuffer(b"".join([words[w] for w in fit]), np.uint8)
        begin = np.cumsum(sizes) - sizes
        base = begin + np.arange(len(fit))  # one more slot per word, for its empty prefix
        last = np.full(len(data) + len(fit), -1, np.int32)
        emitted = np.zeros(len(last), np.int32)
        node = np.zeros(len(fit), np.int32)
        active = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
        for step, k in enumerate(active):
            node[:k] = self.goto[node[:k].astype(np.intp) * 256 + data[begin[:k] + step]]
            lane, state = np.arange(k), node[:k]
            state = np.where(self.token[state] >= 0, state, self.shorter[state])
            while len(lane):
                token = self.token[state]
                start = base[lane] + (step + 1) - self.size[token]
                good = start == base[lane]
                ask = np.flatnonzero(~good)
                good[ask] = self.may_follow(last[start[ask]], token[ask])
                to = base[lane[good]] + step + 1
                last[to] = token[good]
                emitted[to] = emitted[start[good]] + 1
                lane, state = lane[~good], self.shorter[state[~good]]
        out[fit] = emitted[base + sizes]
        return out

    def _count_alone(self, word: bytes) -> int:
        last, emitted, node = [-1], [0], 0
        known: dict[tuple[int, int], bool] = {}
        for end, byte in enumerate(word, 1):
            node = int(self.goto[node * 256 + byte])
            state = node if self.token[node] >= 0 else int(self.shorter[node])
            while True:
                token = int(self.token[state])
                start = end - int(self.size[token])
                if start:
                    pair = (last[start], token)
                    if pair not in known:
                        known[pair] = bool(self._stay_apart(np.array([pair[0]]), np.array([token]))[0])
                if not start or known[pair]:
                    break
                state = int(self.shorter[state])
            last.append(token)
            emitted.append(emitted[start] + 1)
        return emitted[-1]


@lru_cache(maxsize=2)
def word_machine(vocabulary: bytes) -> WordMachine:
    return WordMachine(vocabulary)


def split_words(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Words of all texts in order, and the number of words of each text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    full = np.flatnonzero(lengths)
    counts = np.zeros(len(texts), np.int64)
    if not len(full):
        return [], counts
    joined = "".join(texts)
    bounds = np.concatenate([[0], np.cumsum(lengths[full])])
    begins = np.flatnonzero(word_starts(split_symbols(code_points(joined), bounds), bounds))
    counts[full] = np.diff(np.searchsorted(begins, bounds))
    at = begins.tolist()
    return [joined[a:b] for a, b in zip(at, at[1:] + [len(joined)], strict=True)], counts


def text_counts(texts: list[str], machine: WordMachine, known: dict[str, int]) -> np.ndarray:
    """Tokens of each text. ``known`` remembers words between calls. A special string is one token and parts the text."""
    out = np.zeros(len(texts), np.int64)
    pieces, owner = [], []
    for i, text in enumerate(texts):
        parts = machine.special.split(text) if machine.special and machine.special.search(text) else [text]
        out[i] = len(parts) - 1
        pieces.extend(parts)
        owner.extend([i] * len(parts))
    owner = np.array(owner, np.int64)
    for begin, end in slices(pieces):
        words, per_piece = split_words(pieces[begin:end])
        new = list(set(words) - known.keys())
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list(set(words))
        known.update(zip(new, machine.count([w.encode("utf-8") for w in new]).tolist(), strict=True))
        tokens = np.concatenate([[0], np.cumsum(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))])
        ends = np.cumsum(per_piece)
        np.add.at(out, owner[begin:end], tokens[ends] - tokens[ends - per_piece])
    return out


def count_tokens(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """``id_col``, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every row.

    The vocabulary file is read on the driver and sent to the workers. Null and empty texts have 0 bytes and 0 tokens; a null
    id stays null; strings of special tokens inside a text count as one token, the library's default; repeated rows are each counted; other columns are not read, so their names do not matter; an empty table
    gives an empty result. Texts of any length are counted whole.
    """
    with open(vocabulary_path, "rb") as file:
        vocabulary = file.read()

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine, known = word_machine(vocabulary), {}
        for batch in batches:
            yield pd.Series(text_counts(batch.tolist(), machine, known))

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    counted = docs.select(F.col(id_col), F.octet_length(text).cast("long").alias("n_bytes"), tokens(text).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
