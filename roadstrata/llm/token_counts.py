"""Token counts by rank-synchronous merging of ragged arrays.

Words of many documents lie one after the other in one array of symbols. In each step every word finds its
lowest-ranked pair of neighbours, and all words apply theirs at once, as array operations; words without
a pair that merges leave. What is left of a word are its tokens, and only their number is kept.
"""

from __future__ import annotations

import json
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from roadstrata.llm.common import shared_bytes, text_blocks

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: Text that is counted at a time, in characters.
BLOCK = 3 << 20
#: Symbols that are merged at a time; a longer word goes alone.
SYMBOLS = 1 << 20
#: Words a task remembers; beyond it, it starts anew.
REMEMBERED = 400_000

NEVER = np.int64(1 << 40)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies: itself, or the next free one from U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = count(256)
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Merges:
    """The vocabulary's merges as a table of symbol pairs, looked up for whole arrays."""

    def __init__(self, definition: dict):
        model = definition["model"]
        vocabulary, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.plain = np.array([vocabulary[c] for c in letters], np.int64)
        self.final = np.array([vocabulary[c + suffix] for c in letters], np.int64)
        self.size = max(vocabulary.values()) + 1
        pairs = [tuple(p.split(" ")) if isinstance(p, str) else tuple(p) for p in model["merges"]]
        keys = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in pairs], np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        self.order = np.argsort(keys, kind="stable")
        self.keys, self.made = keys[self.order], made
        # A small table by the pair's hash tells most pairs that never merge without a search.
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self._slot(self.keys)] = True

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NEVER if it does not merge."""
        keys = left * self.size + right
        out = np.full(len(keys), NEVER)
        maybe = np.flatnonzero(self.seen[self._slot(keys)])
        at = np.minimum(np.searchsorted(self.keys, keys[maybe]), len(self.keys) - 1)
        hit = self.keys[at] == keys[maybe]
        out[maybe[hit]] = self.order[at[hit]]
        return out

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Number of tokens of each word; no word is empty."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.plain[raw]
        last = np.cumsum(sizes) - 1
        symbols[last] = self.final[raw[last]]
        owner = np.repeat(np.arange(len(words)), sizes)
        result = sizes.copy()
        pair = np.append(self.ranks(symbols[:-1], symbols[1:]), NEVER)
        pair[last] = NEVER  # no pair reaches over a word's end
        while len(symbols):
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.minimum.reduceat(pair, starts)
            going = lowest < NEVER
            lengths = np.diff(np.append(starts, len(symbols)))
            result[owner[starts[~going]]] = lengths[~going]
            stay = np.repeat(going, lengths)
            symbols, owner, pair = symbols[stay], owner[stay], pair[stay]
            if not len(symbols):
                break
            hit = pair == np.repeat(lowest[going], lengths[going])
            # In a run of overlapping hits (a a a) every other one counts, from the left.
            index = np.arange(len(hit))
            run = hit & ~np.append(False, hit[:-1])
            first = np.maximum.accumulate(np.where(run, index, 0))
            hit &= (index - first) % 2 == 0
            at = np.flatnonzero(hit)
            symbols[at] = self.made[pair[at]]
            rest = np.ones(len(symbols), bool)
            rest[at + 1] = False
            symbols, owner = symbols[rest], owner[rest]
            pair = pair[rest]
            moved = at - np.arange(len(at))
            # Only pairs beside a new symbol have changed.
            for k in (moved, moved[moved > 0] - 1):
                right = np.minimum(k + 1, len(symbols) - 1)
                fresh = self.ranks(symbols[k], symbols[right])
                fresh[(right == k) | (owner[right] != owner[k])] = NEVER
                pair[k] = fresh
        return result


class Counter:
    """Tokens of whole texts for a vocabulary file of this kind: special strings, normal form, words, merges."""

    def __init__(self, raw: bytes):
        definition = json.loads(raw)
        self.merges = Merges(definition)
        special = [t["content"] for t in definition["added_tokens"]]
        self.special = regex.compile("|".join(regex.escape(s) for s in special)) if special else None
        pattern = definition["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern).findall
        self.known: dict[str, int] = {}

    def normal(self, text: str) -> str:
        """NFC and lower case, each character for itself: a final sigma is no exception."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def texts(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; whole texts, some at a time."""
        return [n for some in text_blocks(texts, BLOCK) for n in self._block(some)]

    def _block(self, texts: list[str | None]) -> list[int]:
        number, places, extra = defaultdict(count().__next__), [], []
        for text in texts:
            parts, text = [text or ""], text or ""
            if self.special and "<|" in text:
                # A special string is one token wherever it stands; the text around it is normalised apart.
                parts = self.special.split(text)
            found = [w for p in parts for w in self.words(self.normal(p))] if len(parts) > 1 else self.words(self.normal(text))
            places.append(np.fromiter(map(number.__getitem__, found), np.int64, len(found)))
            extra.append(len(parts) - 1)
        sizes = self._sizes(list(number))
        return [int(sizes[at].sum()) + e for at, e in zip(places, extra, strict=True)]

    def _sizes(self, words: list[str]) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self.known = {}
        fresh = [w for w in words if w not in self.known]
        held, size = [], 0
        for w in [*fresh, None]:
            if held and (w is None or size + 4 * len(w) > SYMBOLS):
                self.known.update(zip(held, self.merges.counts([x.encode() for x in held]).tolist(), strict=True))
                held, size = [], 0
            if w is not None:
                held.append(w)
                size += 4 * len(w)
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))


def token_report(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    Whole texts, null as empty, counted as the public library would for the vocabulary file, without added begin or end;
    special strings inside a text are one token each. over_limit: n_tokens > `limit`. No shuffle: each
    task counts its own documents. Equal rows each give their row; null doc_ids stay null; extra columns are not used.
    """
    raw = shared_bytes(docs.sparkSession, vocabulary or public_tokenizers.path(VOCABULARY))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, held, size = Counter(raw.value), [], 0

        def counted() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            tokens = pa.array(counter.texts(table.column("text").to_pylist()), pa.int64())
            columns = [table.column(0).combine_chunks(), table.column(1).combine_chunks(), tokens]
            return pa.RecordBatch.from_arrays(
                [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns], names=["doc_id", "n_bytes", "n_tokens"]
            )

        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= BLOCK:
                yield counted()
                held, size = [], 0
        if held:
            yield counted()

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), "text")
    counts = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
