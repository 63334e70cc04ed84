"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

Text becomes one flat array of symbols. Two neighbouring characters that no vocabulary piece holds side by side can never
merge, so the array falls into many short words; every distinct word of a slice is encoded once. A round finds the best pair
rank of each word by a segmented minimum, merges all its leftmost non-overlapping occurrences at once, drops the merged-away
symbols, and looks up ranks again where neighbours changed; words without a pair leave the array. Rounds end when no pair
remains. Characters outside the vocabulary fall back to byte pieces.

Nothing shuffles: each row is encoded where it is read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from tarmac.llm.arrays import REMEMBERED, PairTable, code_points, slices

# Fixed values of the model format: piece types, the letter that stands for a blank, the letter for undecodable bytes.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BLANK = "▁"
UNDECODABLE = "�"


class PieceModel:
    """Tables of one BPE model with byte fallback and identity normalisation."""

    def __init__(self, serialized: bytes):
        model = model_pb2.ModelProto()
        model.ParseFromString(serialized)
        norm, train = model.normalizer_spec, model.trainer_spec
        plain = not norm.precompiled_charsmap and not norm.remove_extra_whitespaces and norm.escape_whitespaces and norm.add_dummy_prefix
        if not plain or train.model_type != train.BPE or not train.byte_fallback or train.treat_whitespace_as_suffix:
            raise ValueError("only BPE models with byte fallback, identity normalisation and a dummy prefix are supported")
        if {p.type for p in model.pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("user-defined and unused pieces are not supported")
        self.end_id = train.eos_id
        self.kind = [p.type for p in model.pieces]
        self.text = [p.piece for p in model.pieces]
        self.byte_value = {i: int(p.piece[3:-1], 16) for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.byte_id = {b: i for i, b in self.byte_value.items()}
        shown = {CONTROL: "", UNKNOWN: train.unk_surface, BYTE: None}
        self._plain = [shown.get(p.type, p.piece.replace(BLANK, " ")) for p in model.pieces]
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        scores = np.array([p.score for p in model.pieces])
        # symbols: pieces by their id; characters without a piece of their own, but inside longer pieces, come after
        symbols = dict(normal)
        for piece in normal:
            for letter in piece:
                symbols.setdefault(letter, len(model.pieces) + len(symbols) - len(normal))
        self._loose = {i: letter for letter, i in symbols.items() if letter not in normal}
        self._symbol_of = np.full(0x110000, -1, np.int64)
        for letter, i in symbols.items():
            if len(letter) == 1:
                self._symbol_of[ord(letter)] = i
        left, right, made = [], [], []
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                if piece[:cut] in symbols and piece[cut:] in symbols:
                    left.append(symbols[piece[:cut]])
                    right.append(symbols[piece[cut:]])
                    made.append(i)
        self._made = PairTable(np.array(left), np.array(right), np.array(made), -1)
        #: rank of a piece, best score first, equal scores alike; the last entry, for "no piece", is worst
        self._rank = np.append(np.unique(-scores, return_inverse=True)[1], len(model.pieces))
        self._none = len(model.pieces)

        letters = sorted({c for piece in normal if len(piece) > 1 for c in piece})
        self._letter = np.zeros(0x110000, np.int32)
        self._letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self._joined = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for piece in normal:
            at = self._letter[[ord(c) for c in piece]]
            self._joined[at[:-1], at[1:]] = True

    def _merged(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        made = self._made.get(left, right)
        return made, self._rank[made]

    def words(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Words of all texts in order, already with the blank letter, and the number of words of each text."""
        full = np.array([bool(t) for t in texts], bool)
        marked = [BLANK + t.replace(" ", BLANK) for t in texts if t]
        counts = np.zeros(len(texts), np.int64)
        if not marked:
            return [], counts
        joined = "".join(marked)
        bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, marked), np.int64, len(marked)))])
        letter = self._letter[code_points(joined)]
        starts = np.ones(len(letter), bool)
        starts[1:] = ~self._joined[letter[:-1], letter[1:]]
        starts[bounds[:-1]] = True
        begins = np.flatnonzero(starts)
        counts[full] = np.diff(np.searchsorted(begins, bounds))
        at = begins.tolist()
        return [joined[a:b] for a, b in zip(at, at[1:] + [len(joined)], strict=True)], counts

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Piece ids of each (non-empty) word, by merge rounds over all words at once."""
        points = code_points("".join(words))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbol = self._symbol_of[points]
        done_word, done_place, done_symbol = [], [], []
        word = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(points))
        made = np.full(len(points), -1, np.int64)
        rank = np.full(len(points), self._none, np.int64)
        inner = np.flatnonzero(word[1:] == word[:-1])
        made[inner], rank[inner] = self._merged(symbol[inner], symbol[inner + 1])
        while len(word):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            count = np.diff(np.append(first, len(word)))
            best = np.minimum.reduceat(rank, first)
            best_here = np.repeat(best, count)
            over = best_here == self._none
            if over.any():  # finished words leave
                done_word.append(word[over])
                done_place.append(place[over])
                done_symbol.append(symbol[over])
                live = ~over
                word, place, symbol, made, rank, best_here = word[live], place[live], symbol[live], made[live], rank[live], best_here[live]
                if not len(word):
                    break
            chosen = rank == best_here
            # of occurrences that overlap, every second one counts, from the left
            run = np.flatnonzero(chosen)
            new_run = np.concatenate([[True], run[1:] != run[:-1] + 1])
            lead = np.repeat(run[new_run], np.diff(np.append(np.flatnonzero(new_run), len(run))))
            take = run[(run - lead) % 2 == 0]
            symbol[take] = made[take]
            keep = np.ones(len(word), bool)
            keep[take + 1] = False
            shifted = np.cumsum(keep) - 1
            word, place, symbol, made, rank = word[keep], place[keep], symbol[keep], made[keep], rank[keep]
            changed = np.zeros(len(word) + 1, bool)
            changed[shifted[take]] = True
            changed[:-1] |= changed[1:]
            touched = np.flatnonzero(changed[:-1])
            made[touched], rank[touched] = -1, self._none
            touched = touched[touched + 1 < len(word)]
            touched = touched[word[touched] == word[touched + 1]]
            made[touched], rank[touched] = self._merged(symbol[touched], symbol[touched + 1])
        all_word, all_place, all_symbol = (np.concatenate(x) for x in (done_word, done_place, done_symbol))
        order = np.argsort(all_place, kind="stable")
        cuts = np.cumsum(np.bincount(all_word, minlength=len(words)))
        ids, ends = all_symbol[order].tolist(), cuts.tolist()
        out = [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        without_piece = (all_symbol < 0) | (all_symbol >= self._none)
        for w in np.unique(all_word[without_piece]).tolist():
            own = order[cuts[w] - len(out[w]) : cuts[w]]
            out[w] = self._with_bytes(out[w], points[all_place[own]])
        return out

    def _with_bytes(self, ids: list[int], points: np.ndarray) -> list[int]:
        """Symbols without a piece become the byte pieces of their character."""
        out: list[int] = []
        for i, point in zip(ids, points, strict=True):
            if 0 <= i < self._none:
                out.append(i)
            else:
                out.extend(self.byte_id[b] for b in chr(point).encode("utf-8"))
        return out

    def decode_words(self, words: list[list[int]]) -> list[str]:
        """Text of the ids of each word; the blank before a text is still there."""
        plain, out = self._plain, []
        for ids in words:
            try:
                out.append("".join([plain[i] for i in ids]))
            except TypeError:  # byte pieces have no text of their own
                out.append(self._decode_bytes(ids))
        return out

    def _decode_bytes(self, ids: list[int]) -> str:
        out, pending = [], bytearray()
        for i in ids:
            if i in self.byte_value:
                pending.append(self.byte_value[i])
                continue
            out.append(_runs(pending))
            pending.clear()
            out.append(self._plain[i])
        out.append(_runs(pending))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """Text of any id sequence: byte pieces join to characters, the dummy prefix and control pieces go."""
        ids = [i for i in ids if self.kind[i] != CONTROL]
        text = self._decode_bytes(ids)
        return text[1:] if ids and self.kind[ids[0]] == NORMAL and self.text[ids[0]].startswith(BLANK) else text


def _runs(pending: bytearray) -> str:
    """Bytes as UTF-8; each byte that is in no whole character gives one replacement letter."""
    data, out, at = bytes(pending), [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at : at + size].decode("utf-8"))
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append(UNDECODABLE)
            at += 1
    return "".join(out)


@lru_cache(maxsize=2)
def piece_model(serialized: bytes) -> PieceModel:
    return PieceModel(serialized)


class Encoder:
    """Encodes texts slice by slice and remembers the distinct words it met."""

    def __init__(self, model: PieceModel):
        self._model = model
        self._forget()

    def _forget(self) -> None:
        self._ids: dict[str, str] = {}
        self._text: dict[str, str] = {}

    def _learn(self, words: set[str]) -> None:
        new = list(words - self._ids.keys())
        if len(self._ids) + len(new) > REMEMBERED:
            self._forget()
            new = list(words)
        if new:
            encoded = self._model.encode_words(new)
            self._ids.update(zip(new, [" ".join(map(str, ids)) for ids in encoded], strict=True))
            self._text.update(zip(new, self._model.decode_words(encoded), strict=True))

    def texts(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """Number of ids with the end id, the ids in decimal, and the decoded text, of each text."""
        end = str(self._model.end_id)
        for begin, stop in slices(texts):
            words, per_text = self._model.words(texts[begin:stop])
            self._learn(set(words))
            ids = list(map(self._ids.__getitem__, words))
            text = list(map(self._text.__getitem__, words))
            at = 0
            for n in per_text.tolist():
                line = " ".join([*ids[at : at + n], end])
                yield line.count(" ") + 1, line, "".join(text[at : at + n])[1:]
                at += n


def _encoded(docs: DataFrame, model_path: str, text_col: str, schema: str, row):
    with open(model_path, "rb") as file:
        serialized = file.read()

    @F.pandas_udf(schema)
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(piece_model(serialized))
        for batch in batches:
            yield pd.DataFrame(row(x) for x in encoder.texts(batch.tolist())) if len(batch) else pd.DataFrame(columns=[c.split()[0] for c in schema.split(", ")])

    return encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def encode_decode_digest(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_tokens, ids_sha256 (decimal ids joined by blanks) and decoded_sha256 of every row.

    The model file is read on the driver and sent to the workers. Null and empty texts give the end id alone and decode to
    nothing; a null id stays null; repeated rows are each encoded; other columns are not read; an empty table gives an empty
    result. Texts of any length are encoded whole.
    """

    def row(x: tuple[int, str, str]) -> dict:
        n, ids, decoded = x
        return {"n_tokens": n, "ids_sha256": hashlib.sha256(ids.encode()).hexdigest(), "decoded_sha256": hashlib.sha256(decoded.encode("utf-8")).hexdigest()}

    out = _encoded(docs, model_path, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", row)
    return docs.select(F.col(id_col), out.alias("_o")).select(id_col, "_o.*")


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, token_ids (with the end id) and decoded text of every row; edge cases as in ``encode_decode_digest``."""

    def row(x: tuple[int, str, str]) -> dict:
        _, ids, decoded = x
        return {"token_ids": np.array(ids.split(" "), np.int32), "decoded": decoded}

    out = _encoded(docs, model_path, text_col, "token_ids array<int>, decoded string", row)
    return docs.select(F.col(id_col), out.alias("_o")).select(id_col, "_o.*")
