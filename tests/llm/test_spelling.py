"""Spelling variants beside brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from tarmac.llm import spelling as sp


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts: dict[str, int], ratio: int = 5) -> dict[str, tuple]:
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (counts[w], len(near[w]), form[w], counts[form[w]] if form[w] else None, root)
    return out


def got(df) -> dict[str, tuple]:
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


def words(seed: int, n: int, letters: str, lengths: range) -> dict[str, int]:
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.choice(lengths))): 5 ** rng.randrange(1, 7) + rng.randrange(3) for _ in range(n)}


@pytest.mark.parametrize("symbols", [None, 1, 3, 256])
def test_groups_equal_brute_force(spark, symbols):
    counts = words(1, 250, "abé", range(6, 9))
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    result = got(sp.group_variants(df, symbols=symbols))
    assert result == brute(counts)
    assert any(r[2] and r[4] != r[2] for r in result.values())


def test_all_neighbours_are_generated():
    rng = np.random.default_rng(0)
    word = rng.integers(0, 3, 7)
    near = set(sp.neighbour_hashes(word[None], 3)[0].tolist())
    edits = [word] + [np.delete(word, i) for i in range(7)] + [np.insert(word, i, c) for i in range(8) for c in range(3)]
    edits += [np.concatenate([word[:i], [c], word[i + 1 :]]) for i in range(7) for c in range(3)]
    assert near == {int(sp.reduced_hashes(e[None])[0]) for e in edits}


def test_words_of_the_odd_table(spark, odd, none):
    from tests.llm.conftest import ODD

    plain = Counter()
    for doc_id, text, *_ in ODD:
        plain.update({w: n for w, n in sp.text_words(text or "", doc_id, None).items() if len(w) >= 3})
    rows = {r["word"]: r["n"] for r in sp.word_counts(odd, 3, 2).collect()}
    assert rows == {w: n for w, n in plain.items() if n >= 2} and rows["word"] == 30_000
    assert sp.spelling_variants(none).collect() == [] and sp.spelling_variants(odd, 3, 2).count() == len(rows)


def test_slips_depend_on_document_and_run():
    import zlib

    text = " ".join(f"Wor{chr(97 + i % 26)}{chr(97 + i // 26)}den" for i in range(600))
    out = sp.text_words(text, 7, 5)
    expected = Counter()
    for run in text.split():
        low = run.lower()
        h = zlib.crc32(f"7:{low}".encode())
        at = h % len(low)
        expected[low[:at] + low[at + 1 :] if h % 5 == 0 else low] += 1
    assert out == expected and any(len(w) == 7 for w in out)


def test_long_texts_are_cut_between_runs(monkeypatch):
    monkeypatch.setattr(sp, "CHUNK", 10)
    text = "abcdefghijklmnopqrst " * 5 + "ÀÿÀ!x"
    assert [w for part in sp._runs(text) for w in part] == sp.RUN.findall(text)


def test_very_long_words(spark):
    a = "ab" * 3000
    rows = [(a, 100), (a[:3000] + "c" + a[3000:], 7), (a[:-1] + "z", 6), ("shorter", 5)]
    assert got(sp.group_variants(spark.createDataFrame(rows, "word string, n long"))) == brute(dict(rows))
