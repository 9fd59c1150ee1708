"""Skybands against their definition, over several blocks and kinds of ranks."""

import numpy as np
import pyarrow as pa
import pytest

from roadstrata.llm import divergence


@pytest.mark.parametrize("block", [1, 7, 256, 1024])
@pytest.mark.parametrize("spread", [3, 40, 10**12])
def test_a_skyband_is_what_fewer_than_k_dominate(monkeypatch, block, spread):
    monkeypatch.setattr(divergence, "BLOCK", block)
    draw = np.random.default_rng(spread)
    more, less, name = draw.integers(0, spread, 300), draw.integers(0, spread, 300), draw.permutation(300) * 10**9
    dominated = (more[:, None] >= more) & (less[:, None] <= less) & (name[:, None] < name)
    for k in (1, 5, 50):
        assert (divergence.skyband(more, less, name, k) == (dominated.sum(axis=0) < k)).all()
    assert len(divergence.skyband(more[:0], less[:0], name[:0], 50)) == 0


def test_items_are_compared_in_small_numbers():
    ranks = divergence._ranks(np.array([10**15, -3, 10**15, 7]))
    assert ranks.tolist() == [2, 0, 2, 1] and ranks.dtype == np.uint8
    assert divergence._ranks(np.arange(70_000)[::-1]).dtype == np.uint32


def test_a_task_sums_its_counts_over_blocks_and_batches(monkeypatch):
    """Each group's term leaves a task once while it holds them, long texts and texts of spaces only among them."""
    monkeypatch.setattr(divergence, "TEXTS", 4000)
    rng = np.random.default_rng(5)
    words = ["a", "B", "été", "Ünd", "日本", *(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300))]
    texts = [" ".join(rng.choice(words, n)) for n in rng.integers(0, 200, 60)] + ["", " 12 ", "x" * 9000, "A a, " * 3000, "1 b2c\n"]
    rows = [(f"l{i % 2}", f"s{i % 3}", t) for i, t in enumerate(texts * 2)]
    named = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.binary()), strict=True)]
    table = pa.RecordBatch.from_arrays(named, names=["lang", "source", "text"])
    wanted = {}
    for lang, source, text in rows:
        for term, n in divergence.terms_of(text.encode()).items():
            had = wanted.get((lang, source, term.decode()), (0, 0))
            wanted[lang, source, term.decode()] = (had[0] + n, had[1] + 1)
    found = [r for b in divergence._count(iter([table.slice(0, 70), table.slice(70, 0), table.slice(70)])) for r in b.to_pylist()]
    assert {(r["lang"], r["source"], r["term"]): (r["n"], r["docs"]) for r in found} == wanted and len(found) == len(wanted)
    # What is more than a task holds is handed on in parts, which add up.
    monkeypatch.setattr(divergence, "HELD", 50)
    parts = [r for b in divergence._count(iter([table])) for r in b.to_pylist()]
    added = {}
    for r in parts:
        had = added.get((r["lang"], r["source"], r["term"]), (0, 0))
        added[r["lang"], r["source"], r["term"]] = (had[0] + r["n"], had[1] + r["docs"])
    assert added == wanted and len(parts) > len(wanted)
    assert not list(divergence._count(iter([]))) and not list(divergence._count(iter([table.slice(0, 0)])))


def test_a_task_does_not_hand_on_a_term_again_before_it_holds_many():
    letters = [f"{a}{b}{c}{d}" for a in "abcdefghijklm" for b in "abcdefghijklmnopqrstuvwxyz" for c in "abcdefghijklmnopqrstuvwxyz" for d in "abcdefghijklmnopqrstuvwxyz"]
    text = " ".join(letters[:160_000]).encode()
    batch = pa.RecordBatch.from_pydict({"lang": ["l"] * 3, "source": ["s"] * 3, "text": [text] * 3})
    found = list(divergence._count(iter([batch])))
    assert sum(b.num_rows for b in found) == 160_000 and all(set(b.column("docs").to_pylist()) == {3} for b in found)
