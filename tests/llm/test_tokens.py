"""Token counts, pieces and packing beside the tokenizer libraries."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import PATTERN, path
from tokenizers import Tokenizer

from tarmac.llm import packing, pieces, token_counts
from tests.llm.conftest import ODD

BPE = path("byte_bpe_50k.json")
RANKS = path("byte_bpe_50k.tiktoken")
PIECES = path("piece_bpe_32k.model")
PARTS = ["a", "b", " ", "  ", "'", "s", "t", "re", "ll", "d", "\n", "\t", "1", "23", ".", "!", "é", "ß", "漢", "🙂", "́", "\xa0", "\x85", "the", "ing", "ation", "▁", "<|endoftext|>", "\x00", "⁇", "<0x0A>"]
texts = st.lists(st.sampled_from(PARTS) | st.characters(codec="utf-8"), max_size=60).map("".join)


@pytest.fixture(scope="module")
def bpe():
    return Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def machine():
    return token_counts.word_machine(open(BPE, "rb").read())


@pytest.fixture(scope="module")
def processor():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def model():
    return pieces.piece_model(open(PIECES, "rb").read())


def library_count(bpe, text):
    return len(bpe.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, max_size=5))
def test_counts_equal_the_library(bpe, machine, batch):
    assert token_counts.text_counts(batch, machine, {}).tolist() == [library_count(bpe, t) for t in batch]


def test_counts_of_long_texts(bpe, machine):
    rng = random.Random(3)
    long = ["".join(rng.choice(PARTS) for _ in range(4000)) for _ in range(10)] + ["a" * 6000, "'" * 3000, " " * 2000, "ab" * 3000]
    assert token_counts.text_counts(long, machine, {}).tolist() == [library_count(bpe, t) for t in long]


def test_chunk_length_does_not_matter(monkeypatch):
    rng = random.Random(4)
    joined = ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 300))) for _ in range(40)]
    want = token_counts.split_words(joined)[0]
    monkeypatch.setattr(token_counts, "CHUNK", 3)
    assert token_counts.split_words(joined)[0] == want


def test_classes_of_all_characters():
    from tokenizers.pre_tokenizers import ByteLevel

    split, classes = ByteLevel(add_prefix_space=False).pre_tokenize_str, token_counts.character_classes()
    for point in range(0, 0x30000):
        if not 0xD800 <= point < 0xE000:
            neighbour = {token_counts.LETTER: "a", token_counts.NUMBER: "1", token_counts.OTHER: "!"}.get(int(classes[point]), "\n")
            assert len(split(neighbour + chr(point))) == 1, hex(point)


def test_count_tokens_of_odd_rows(odd, none, bpe):
    rows = token_counts.count_tokens(odd, BPE).collect()
    want = sorted((str(i), len((t or "").encode()), library_count(bpe, t or "")) for i, t, *_ in ODD)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in rows)
    assert token_counts.count_tokens(none, BPE).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, max_size=5))
def test_pieces_equal_the_library(processor, model, batch):
    for text, (n, ids, decoded) in zip(batch, pieces.Encoder(model).texts(batch), strict=True):
        want = processor.encode(text, add_eos=True)
        assert [int(i) for i in ids.split()] == want and n == len(want)
        assert decoded == processor.decode(want) == model.decode(want)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 31_999) | st.integers(0, 258), max_size=12))
def test_decode_equals_the_library(processor, model, ids):
    assert model.decode(ids) == processor.decode(ids)


def test_digests_of_odd_rows(odd, none, processor):
    rows = pieces.encode_decode_digest(odd, PIECES).collect()

    def want(text):
        ids = processor.encode(text or "", add_eos=True)
        return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(processor.decode(ids).encode()).hexdigest()

    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == sorted((str(i), *want(t)) for i, t, *_ in ODD)
    assert pieces.encode_decode_digest(none, PIECES).count() == 0
    encoded = pieces.encode_documents(odd, PIECES).where("doc_id = 12").first()
    assert encoded.token_ids == processor.encode("one two", add_eos=True) and encoded.decoded == "one two"


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_decreasing(lengths):
    place = packing.best_fit_decreasing(np.array(lengths, np.int64), 50)
    free, want = [], [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [f for f in free if f >= lengths[i]]
        if fits:
            best = min(fits)
            free[free.index(best)] -= lengths[i]
        else:
            free.append(50 - lengths[i])
    assert len(set(place.tolist())) == len(free)
    used = np.bincount(place, weights=np.array(lengths), minlength=len(free)) if lengths else np.zeros(0)
    assert sorted(50 - used) == sorted(free)
    del want


@pytest.mark.parametrize("shard_tokens", [1_000, 4_000_000])
def test_packing_loses_nothing(odd, none, shard_tokens):
    encoding = packing._encoding(open(RANKS, "rb").read(), PATTERN)
    packed = packing.pack_documents(odd, RANKS, PATTERN, row_tokens=64, shard_tokens=shard_tokens).collect()
    found: dict = {}
    for row in packed:
        ids, places = np.frombuffer(row.ids, "<u2"), np.frombuffer(row.position_ids, "<u2")
        assert row.n_tokens == len(ids) == row.cu_seqlens[-1] <= 64
        for doc, piece, a, b in zip(row.doc_ids, row.pieces, row.cu_seqlens, row.cu_seqlens[1:], strict=False):
            assert places[a:b].tolist() == list(range(b - a))
            found.setdefault((doc, piece), []).append(ids[a:b].tolist())
    want: dict = {}
    for doc, text, *_ in ODD:
        ids = encoding.encode_ordinary(text or "")
        for number, at in enumerate(range(0, len(ids), 64)):
            want.setdefault((doc, number), []).append(ids[at : at + 64])
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    assert packing.pack_documents(none, RANKS, PATTERN).count() == 0


def test_ids_of_long_texts(monkeypatch):
    encoding = packing._encoding(open(RANKS, "rb").read(), PATTERN)
    text = "It's  the\n\n  end, isn't it?\t42 ünïcode " * 50 + " " * 3000 + "x"
    whole = packing.text_ids(encoding, text)
    assert np.frombuffer(whole, "<u2").tolist() == encoding.encode_ordinary(text)
    monkeypatch.setattr(packing, "WHOLE_CHARS", 10)
    assert packing.text_ids(encoding, text) == whole
    assert len(packing.text_ids(encoding, " " * 3_000_000 + "x")) > 0


def test_packed_files_and_matrix(spark, plain_odd, tmp_path):
    packed = packing.pack_documents(plain_odd, RANKS, PATTERN, row_tokens=64)
    packing.write_packed(packed, str(tmp_path / "packed"))
    again = packing.read_matrix(spark.read.parquet(str(tmp_path / "packed")), 64)
    assert again.count() == packed.count()
    assert all(len(r.matrix_row) == 64 for r in again.select("matrix_row").collect())
