"""Groups of spelling variants: words one edit apart, found in a reduced alphabet.

Letters are hashed to a few symbols, so every word becomes a reduced word; two words that differ by one inserted, deleted or
replaced code point have reduced words that differ by one such edit at most. Each distinct reduced word generates the hashes of
its whole one-edit neighbourhood, which meet the hashes of the reduced vocabulary in an equi-join; members of matching reduced
words are compared in full. A hash or a symbol that stands for several words only adds pairs to compare, it never loses one.

The number of symbols follows from the size of the vocabulary and is doubled while reduced words still stand for many words, up
to one symbol for (nearly) every letter; it decides how much is compared, not the result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.joins import sized
from tarmac.plans.storage import materialize

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_BREAK = re.compile("[^A-Za-zÀ-ÿ]")
#: Code points searched for runs at once, and different words a task holds before it hands them on.
CHUNK, HELD = 1_000_000, 200_000
MIN_SYMBOLS, MAX_SYMBOLS = 4, 256
#: Compared pairs of one reduced word, per word of the vocabulary, above which the alphabet grows.
PAIRS_A_WORD = 8
#: Neighbours generated at once inside a task.
_AT_ONCE = 1_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _runs(text: str) -> Iterator[list[str]]:
    at = 0
    while at < len(text):
        cut = _BREAK.search(text, at + CHUNK) if len(text) - at > CHUNK else None
        end = cut.start() if cut else len(text)
        yield RUN.findall(text, at, end)
        at = end


def text_words(text: str, doc_id: object, slip: int | None) -> Counter[str]:
    """Lower-cased (A-Z only) runs of letters with their counts. With ``slip`` a run loses one code point where the crc of
    document and run is divisible by it: repeatable misspellings for tests and measurements."""
    raw: Counter[str] = Counter()
    for runs in _runs(text):
        raw.update(runs)
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter[str] = Counter()
    for run, n in raw.items():
        low = run.encode().lower()
        word = low.decode()
        if slip:
            h = zlib.crc32(low, start)
            if h % slip == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
        out[word] += n
    return out


def word_counts(docs: DataFrame, min_length: int = 6, min_count: int = 5, slip: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all words with at least ``min_length`` code points and ``min_count`` occurrences, counted over whole texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for word, n in text_words(text.as_py() or "", doc_id, slip).items():
                    if len(word) >= min_length:
                        held[word] += n
                if len(held) > HELD:
                    yield flush()
        if held:
            yield flush()

    rows = docs.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    counted = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_count)


def symbols_of(word: str, symbols: int) -> bytes:
    """The reduced word: one byte per code point."""
    points = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    mixed = (points * np.uint64(2654435761) & np.uint64(0xFFFFFFFF)) >> np.uint64(13)
    return (mixed % np.uint64(symbols)).astype(np.uint8).tobytes()


def _powers(n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, _BASE, np.uint64))])


def reduced_hashes(words: np.ndarray) -> np.ndarray:
    """Hash of each row of a matrix of symbols."""
    length = words.shape[1]
    if not length:
        return np.zeros(len(words), np.uint64)
    return ((words.astype(np.uint64) + np.uint64(1)) * _powers(length)[:length][::-1]).sum(axis=1, dtype=np.uint64)


def neighbour_hashes(words: np.ndarray, symbols: int) -> np.ndarray:
    """Hashes of all strings of the reduced alphabet at most one edit away from each row (all rows have one length).

    Prefix and suffix hashes give each neighbour in constant time, so a word of length n costs about 2 n x symbols.
    """
    rows, length = words.shape
    power = _powers(length + 2)
    codes = words.astype(np.uint64) + np.uint64(1)
    prefix = np.zeros((rows, length + 1), np.uint64)
    suffix = np.zeros((rows, length + 1), np.uint64)
    for i in range(length):
        prefix[:, i + 1] = prefix[:, i] * _BASE + codes[:, i]
        suffix[:, length - 1 - i] = codes[:, length - 1 - i] * power[i] + suffix[:, length - i]
    letters = np.arange(1, symbols + 1, dtype=np.uint64)
    at = np.arange(length)
    deleted = prefix[:, :-1] * power[length - 1 - at] + suffix[:, 1:]
    replaced = (prefix[:, :-1] * power[length - at] + suffix[:, 1:])[:, :, None] + (power[length - 1 - at][:, None] * letters)[None]
    at = np.arange(length + 1)
    inserted = (prefix * power[length + 1 - at] + suffix)[:, :, None] + (power[length - at][:, None] * letters)[None]
    return np.concatenate([prefix[:, -1:], deleted, replaced.reshape(rows, -1), inserted.reshape(rows, -1)], axis=1)


def _by_length(reduced: list[bytes], symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in ``reduced``, matrix of symbols) of equally long words, few enough for their neighbours to be held at once."""
    places: dict[int, list[int]] = {}
    for i, word in enumerate(reduced):
        places.setdefault(len(word), []).append(i)
    for length, own in places.items():
        step = max(1, _AT_ONCE // (2 * (length + 1) * symbols))
        for begin in range(0, len(own), step):
            part = own[begin : begin + step]
            yield np.array(part), np.frombuffer(b"".join(reduced[i] for i in part), np.uint8).reshape(len(part), length)


def reduce_words(counts: DataFrame, symbols: int) -> DataFrame:
    """``counts`` with the reduced word and its hash."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reduced = [symbols_of(w, symbols) for w in batch.column(0).to_pylist()]
            hashes = np.zeros(len(reduced), np.uint64)
            for places, words in _by_length(reduced, symbols):
                hashes[places] = reduced_hashes(words)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(reduced, pa.binary()), pa.array(hashes.view(np.int64))], ["word", "n", "reduced", "rhash"])

    return counts.select("word", "n").mapInArrow(reduce, "word string, n long, reduced binary, rhash long")


def _neighbours(words: DataFrame, symbols: int) -> DataFrame:
    """(rhash, other): hash of each reduced word beside the hashes of its neighbourhood, each once."""

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy()
            for places, matrix in _by_length(batch.column(1).to_pylist(), symbols):
                near = np.sort(neighbour_hashes(matrix, symbols), axis=1)
                first = np.concatenate([np.ones((len(near), 1), bool), near[:, 1:] != near[:, :-1]], axis=1)
                source = np.repeat(own[places], first.sum(axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(source), pa.array(near[first].view(np.int64))], ["rhash", "other"])

    distinct = words.select("rhash", "reduced").distinct()
    return distinct.mapInArrow(generate, "rhash long, other long")


def _reduced(counts: DataFrame, symbols: int | None) -> tuple[DataFrame, int]:
    size = counts.count()
    chosen = symbols or max(MIN_SYMBOLS, int(np.ceil(max(size, 1) ** (1 / 6))))
    while True:
        words = materialize(reduce_words(counts, chosen), "reduced-words")
        per_word = words.groupBy("rhash").agg(F.count("*").alias("c"))
        pairs = per_word.agg(F.sum(F.col("c") * F.col("c"))).first()[0] or 0
        if symbols or chosen >= MAX_SYMBOLS or pairs <= PAIRS_A_WORD * size:
            return words, chosen
        chosen = min(MAX_SYMBOLS, 2 * chosen)


def near_pairs(counts: DataFrame, symbols: int | None = None) -> DataFrame:
    """(word, n, near, near_n): each word of ``counts`` (word, n; written, one row per word) beside every word exactly one edit
    away; both directions of a pair are there."""
    words, chosen = _reduced(counts, symbols)
    vocabulary = materialize(words.select(F.col("rhash").alias("other")).distinct(), "reduced-vocabulary")
    matches = _neighbours(words, chosen).join(sized(vocabulary), "other")
    # several reduced words may share a hash; their matches are then the same pairs of hashes
    matches = materialize(matches.distinct(), "matches")
    members = words.select("rhash", "word", "n")
    others = words.select(F.col("rhash").alias("other"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    candidates = matches.join(sized(members, 128), "rhash").join(sized(others, 128), "other")
    return candidates.where(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n")


def group_variants(counts: DataFrame, ratio: int = 5, symbols: int | None = None) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of ``counts`` (word string, n long, one row per word).

    ``form`` is the near word (exactly one inserted, deleted or replaced code point) with most occurrences, the smallest in
    code-point order among equals, if it occurs at least ``ratio`` times as often; ``root`` is the last word when forms are
    followed, the word itself without one. Counts rise along forms, so chains end. Null words are left out; words of any length
    are compared whole; an empty table gives an empty result; other columns are not read. The result does not depend on
    ``symbols``.
    """
    counts = materialize(counts.where(F.col("word").isNotNull()).select("word", F.col("n").cast("long").alias("n")), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w")))
    near = near_pairs(counts, symbols).groupBy(F.col("word").alias("_w")).agg(F.count("*").alias("_near"), best.alias("_best"))
    near = materialize(near, "near-words")
    joined = counts.join(sized(near, 128), F.col("word") == F.col("_w"), "left")
    often = -F.col("_best.m") >= ratio * F.col("n")
    joined = materialize(
        joined.select("word", "n", F.coalesce("_near", F.lit(0).cast("long")).alias("n_near"), F.when(often, F.col("_best.w")).alias("form"), F.when(often, -F.col("_best.m")).alias("form_n")),
        "forms",
    )
    roots = follow(joined.where("form is not null").select(F.col("word").alias("_w"), F.col("form").alias("_r")))
    out = joined.join(sized(roots, 128), F.col("word") == F.col("_w"), "left")
    return out.select("word", "n", "n_near", "form", "form_n", F.coalesce("_r", "word").alias("root"))


def follow(links: DataFrame) -> DataFrame:
    """The end of each chain of links (_w, _r) by pointer doubling: a chain of length k takes about log2(k) rounds."""
    links = materialize(links, "links")
    while True:
        step = sized(links.select(F.col("_w").alias("_v"), F.col("_r").alias("_next")), 128)
        moved = links.join(step, F.col("_r") == F.col("_v"), "left")
        moved = materialize(moved.select("_w", F.coalesce("_next", "_r").alias("_r"), F.col("_next").isNotNull().alias("_moved")), "links")
        links = moved.select("_w", "_r")
        if moved.where("_moved").isEmpty():
            return links


def spelling_variants(
    docs: DataFrame, min_length: int = 6, min_count: int = 5, ratio: int = 5, slip: int | None = None, symbols: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``group_variants`` of the words of whole texts (``word_counts``). Null and empty texts have no words; repeated rows count
    each; a null id counts as empty text where ``slip`` needs it; other columns are not read."""
    return group_variants(word_counts(docs, min_length, min_count, slip, id_col, text_col), ratio, symbols)
