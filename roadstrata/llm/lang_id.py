"""Language identification by unigram pieces, summed over all ways to cut a word into pieces.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability is the sum
over all its segmentations of the product of their pieces, by the forward algorithm; a text's is the
product of its words'. The probabilities are learned by expectation maximisation over the word counts
of a bounded sample of labelled documents; the counting runs on Spark in every round.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from roadstrata.llm.common import stored, text_blocks, uniform, unused_name

VOCABULARY = "piece_bpe_32k.model"
#: Labelled documents that are learned from, for each language, about; drawn by a hash of the id. Whole texts.
LEARNED = 2_000
ROUNDS = 3
#: Added to each piece's expected count.
SMOOTHING = 0.1
#: Text that is scored at a time, in characters.
BLOCK = 3 << 20
#: Words of equal length that are scored at a time.
WORDS_AT_ONCE = 16_384
#: For learning, longer words are cut into parts of so many characters.
PART = 48
#: Words a task remembers; beyond it, it starts anew.
REMEMBERED = 200_000

UNKNOWN = "und"
START = "▁"
LETTERS = re.compile(r"[^\W\d_]+").findall

BASE = np.uint64(0x9E3779B97F4A7C15)
FILTER_BITS = 22


def _filter_slot(h: np.ndarray) -> np.ndarray:
    return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


class Pieces:
    """The vocabulary, looked up for all substrings of many words at once by rolling hashes."""

    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        self.unknown, self.none = len(pieces), len(pieces) + 1
        self.longest = max(map(len, pieces), default=1)
        self.seen = np.zeros(1 << FILTER_BITS, bool)
        self.by_length: list[tuple[np.ndarray, np.ndarray]] = []
        for n in range(1, self.longest + 1):
            ids = np.array([i for i, p in enumerate(pieces) if len(p) == n], np.int64)
            h = np.zeros(len(ids), np.uint64)
            for k in range(n):
                h = h * BASE + np.array([ord(pieces[i][k]) + 1 for i in ids], np.uint64)
            order = np.argsort(h)
            self.by_length.append((h[order], ids[order]))
            self.seen[_filter_slot(h)] = True

    def lookup(self, words: np.ndarray) -> np.ndarray:
        """[w, t, n - 1]: the piece that is characters t - n to t of word w. `words`: code points, one row per word."""
        rows, m = words.shape
        found = np.full((rows, m + 1, self.longest), self.none, np.int32)
        found[:, 1:, 0] = self.unknown
        codes = words.astype(np.uint64) + np.uint64(1)
        h = np.zeros((rows, m), np.uint64)
        for n in range(1, min(m, self.longest) + 1):
            h = h[:, : m - n + 1] * BASE + codes[:, n - 1 :]
            hashes, ids = self.by_length[n - 1]
            if not len(hashes):
                continue
            w, t = np.nonzero(self.seen[_filter_slot(h)])
            wanted = h[w, t]
            at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
            hit = hashes[at] == wanted
            found[w[hit], t[hit] + n, n - 1] = ids[at[hit]]
        return found


def public_pieces(path: str | None = None) -> list[str]:
    """The pieces that consist of letters, in lower case, with or without the mark of a word's start."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(VOCABULARY))
    pieces = (model.id_to_piece(i).lower() for i in range(model.get_piece_size()))
    kept = {p for p in pieces if p == START or p.removeprefix(START).isalpha()}
    return sorted(kept)


def forward(found: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Log probability of each word for each language. `table`: piece by language, a row of zeros last."""
    rows, ends, longest = found.shape
    alpha = np.zeros((rows, ends, table.shape[1]))
    alpha[:, 0] = 1.0
    logs = np.zeros((rows, table.shape[1]))
    for t in range(1, ends):
        n = min(t, longest)
        # Pieces of length 1, 2, ... end at t and begin at t - 1, t - 2, ...
        before = alpha[:, t - n : t][:, ::-1]
        alpha[:, t] = np.einsum("wng,wng->wg", before, table[found[:, t, :n]])
        if t % 16 == 0:
            window = alpha[:, max(0, t - longest + 1) : t + 1]
            top = window.max(axis=1)
            window /= top[:, None]
            logs += np.log(top)
    return logs + np.log(alpha[:, -1])


def expected(found: np.ndarray, table: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Expected number of each piece in the words, over all segmentations, times the words' weights. One language."""
    rows, ends, longest = found.shape
    prob = table[found]
    alpha, beta = np.zeros((rows, ends)), np.zeros((rows, ends))
    alpha[:, 0] = beta[:, -1] = 1.0
    for t in range(1, ends):
        n = min(t, longest)
        alpha[:, t] = (alpha[:, t - n : t][:, ::-1] * prob[:, t, :n]).sum(axis=1)
    for t in range(ends - 2, -1, -1):
        for n in range(1, min(longest, ends - 1 - t) + 1):
            beta[:, t] += prob[:, t + n, n - 1] * beta[:, t + n]
    out = np.zeros(len(table))
    scale = weight / alpha[:, -1]
    for t in range(1, ends):
        for n in range(1, min(t, longest) + 1):
            share = alpha[:, t - n] * prob[:, t, n - 1] * beta[:, t] * scale
            out += np.bincount(found[:, t, n - 1], share, len(table))
    return out


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers of the words, their code points one row each), for words of one length at a time."""
    groups = defaultdict(list)
    for i, w in enumerate(words):
        groups[len(w)].append(i)
    for n, group in groups.items():
        step = max(1, min(WORDS_AT_ONCE, (WORDS_AT_ONCE * 12) // n))
        for at in range(0, len(group), step):
            some = group[at : at + step]
            text = "".join(words[i] for i in some)
            yield np.array(some), np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(some), n)


def only_letters(word: str) -> str:
    return word if word.isalpha() else "".join(c for c in word if c.isalpha())


@dataclass(frozen=True)
class Model:
    languages: list[str]
    pieces: list[str]
    table: np.ndarray  # piece by language; then unknown characters; then zeros


def remainder(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))


def _word_counts(docs: DataFrame, per_language: int) -> DataFrame:
    """(lang, part, n): the words of the sample, cut at PART characters."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder(F.col("doc_id")) != 2))
    known = known.select(F.col("lang").cast("string").alias("lang"), "text", uniform(F.lit(11), F.col("doc_id")).alias("draw"))
    # One number per language; as a literal, so that no text is shuffled to meet it.
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not sizes:
        return docs.sparkSession.createDataFrame([], "lang string, part string, n long")
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, per_language / n)])
    sample = known.filter(F.col("draw") < share[F.col("lang")])

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = defaultdict(int)
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word in LETTERS(text.lower()):
                    counts[lang, word] += 1
            out = defaultdict(int)
            for (lang, word), n in counts.items():
                if clean := only_letters(word):
                    marked = START + clean
                    for i in range(0, len(marked), PART):
                        out[lang, marked[i : i + PART]] += n
            columns = pa.array([k[0] for k in out]), pa.array([k[1] for k in out]), pa.array(list(out.values()), pa.int64())
            kinds = pa.string(), pa.string(), pa.int64()
            yield pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "part", "n"])

    found = sample.select("lang", "text").mapInArrow(words, "lang string, part string, n long")
    return found.groupBy("lang", "part").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, per_language: int = LEARNED, rounds: int = ROUNDS, vocabulary: str | None = None) -> Model:
    """Fit the piece probabilities of each language in `docs` (doc_id, text, lang).

    Documents whose crc32(doc_id as text) mod 4 is 2, or whose doc_id, text or lang is null, are not learned
    from. The driver holds languages times pieces numbers, as the model does.
    """
    spark = docs.sparkSession
    pieces = public_pieces(vocabulary)
    counts = stored(_word_counts(docs, per_language), "word-counts")
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    size, number = len(pieces) + 2, {x: i for i, x in enumerate(languages)}
    table = np.full((size, len(languages)), 1.0 / (size - 1))
    table[-1] = 0.0
    for _ in range(rounds if languages else 0):
        sent = spark.sparkContext.broadcast((pieces, table, number))

        def count_pieces(frames: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            pieces, table, number = sent.value
            vocabulary, total = Pieces(pieces), np.zeros(table.shape)
            for frame in frames:
                for lang, own in frame.groupby("lang"):
                    words, weight = own["part"].tolist(), own["n"].to_numpy(float)
                    for some, codes in by_length(words):
                        found = vocabulary.lookup(codes)
                        total[:, number[lang]] += expected(found, table[:, number[lang]], weight[some])
            piece, lang = np.nonzero(total)
            yield pd.DataFrame({"piece": piece, "language": lang, "n": total[piece, lang]})

        totals = counts.mapInPandas(count_pieces, "piece long, language long, n double")
        sums = totals.groupBy("piece", "language").agg(F.sum("n").alias("n")).toPandas()
        table = np.full((size, len(languages)), SMOOTHING)
        table[-1] = 0.0
        np.add.at(table, (sums["piece"].to_numpy(), sums["language"].to_numpy()), sums["n"].to_numpy())
        table /= table.sum(axis=0)
    return Model(languages, pieces, table)


class Scorer:
    """Log probabilities of words, remembered up to a bound."""

    def __init__(self, model: Model):
        self.model, self.vocabulary = model, Pieces(model.pieces)
        self.known: dict[str, int] = {}
        self.logs = np.zeros((0, len(model.languages)))

    def words(self, words: list[str]) -> np.ndarray:
        """One row per word; a word without a letter has zeros."""
        if len(self.known) > REMEMBERED:
            self.known, self.logs = {}, self.logs[:0]
        fresh = [w for w in words if w not in self.known]
        logs = np.zeros((len(fresh), len(self.model.languages)))
        marked = [only_letters(w) for w in fresh]
        there = [i for i, w in enumerate(marked) if w]
        for some, codes in by_length([START + marked[i] for i in there]):
            logs[np.array(there)[some]] = forward(self.vocabulary.lookup(codes), self.model.table)
        base = len(self.logs)
        self.logs = np.concatenate([self.logs, logs])
        self.known.update((w, base + i) for i, w in enumerate(fresh))
        return self.logs[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))]

    def texts(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, posterior) of each text; whole texts, some at a time."""
        return [found for some in text_blocks(texts, BLOCK) for found in self._block(some)]

    def _block(self, texts: list[str | None]) -> list[tuple[str, float]]:
        number, places, lettered = defaultdict(count().__next__), [], []
        for text in texts:
            words = LETTERS((text or "").lower())
            places.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        words = list(number)
        logs = self.words(words)
        lettered = np.fromiter((any(map(str.isalpha, w)) for w in words), bool, len(words))
        out = []
        for at in places:
            if not self.model.languages or not lettered[at].any():
                out.append((UNKNOWN, 0.0))
                continue
            total = logs[at].sum(axis=0)
            best = int(total.argmax())
            out.append((self.model.languages[best], float(1.0 / np.exp(total - total[best]).sum())))
        return out


def predictions(rows: DataFrame, model: Model) -> DataFrame:
    """`rows` (any columns and a column `text`, last) with lang_pred and score in place of the text."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    kept = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, held, size = Scorer(sent.value), [], 0

        def scored():
            table = pa.Table.from_batches(held).combine_chunks()
            found = scorer.texts(table.column(len(kept)).to_pylist())
            columns = [*table.columns[:-1], pa.chunked_array([pa.array([f[0] for f in found], pa.string())])]
            columns.append(pa.chunked_array([pa.array([f[1] for f in found], pa.float64())]))
            yield from pa.Table.from_arrays(columns, names=[*kept, "lang_pred", "score"]).to_batches()

        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= BLOCK:
                yield from scored()
                held, size = [], 0
        if held:
            yield from scored()

    kinds = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes[:-1])
    return rows.mapInArrow(run, kinds + ", lang_pred string, score double")


def language_report(docs: DataFrame, per_language: int = LEARNED) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    held_out: crc32(doc_id as text) mod 4 is 2 (null doc_id: false, and not learned from). lang_pred is
    the likeliest learned language of the whole text (ties: the first by code point) and score its posterior under
    equal priors; `und` and 0 for a null text, one without letters, or if nothing was learned. Predictions see the text alone.
    Extra columns are not used; equal rows each give their row.
    """
    model = learn(docs, per_language)
    held = F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "text")
    return predictions(rows, model)


def keep_identified(docs: DataFrame, least: float = 0.4, per_language: int = LEARNED) -> DataFrame:
    """`docs` without the documents whose language can't be told: `und`, or a posterior below `least`. Columns as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs, per_language))
    name = unused_name(docs, "identified")

    @F.pandas_udf("boolean")
    def told(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(sent.value)
        for texts in parts:
            found = scorer.texts([None if t is None else str(t) for t in texts])
            yield pd.Series([lang != UNKNOWN and score >= least for lang, score in found], dtype=bool)

    return docs.withColumn(name, told("text")).filter(F.col(name)).drop(name)
