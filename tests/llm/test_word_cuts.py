"""Words of simple pieces, against the expression that says what a word is."""

import random
import re

import pyarrow as pa
import pyarrow.compute as pc

from roadstrata.llm import token_files

WORD = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def test_pieces_are_cut_where_the_kind_of_character_changes():
    every = [chr(i) for i in range(33, 256) if re.match(token_files.SIMPLE, chr(i))]
    rng = random.Random(3)
    pieces = [*every, *("".join(rng.choices(every, k=rng.randint(1, 12))) for _ in range(20_000)), "ÀÿßÞ9a!!0", "...", "2024-01-01"]
    assert pc.all(pc.match_substring_regex(pa.array(pieces), token_files.SIMPLE)).as_py()
    lowered = pc.utf8_lower(pa.array(pieces))
    wanted = [WORD.findall(p) for p in lowered.to_pylist()]
    for at, end in ((0, len(pieces)), (17, 400), (5, 5)):
        words, counts = token_files._cut(lowered.slice(at, end - at))
        assert words.to_pylist() == [w for p in wanted[at:end] for w in p] and counts.tolist() == [len(p) for p in wanted[at:end]]
        words.validate(full=True)
