"""SimHash near-dedup with a hierarchical index in Gray order."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from roadstrata.llm.common import stored, unused_name
from roadstrata.llm.components import EDGES, components, edge_batch, join_labels

WORDS = 4
SEED = 42
BITS = 4
#: Fingerprints that a cell aims at; larger classes are cut into blocks of so many and compared block by block.
CELL = 4096
#: Children of a node of the index.
FAN = 4
#: Fingerprints that walk down the index together.
QUERIES = 512

FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


# --- fingerprints ---


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64-bit SimHash of the text's word shingles. bytes.lower() changes A-Z only and split() knows the ASCII spaces."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    n = max(1, len(parts) - words + 1)
    spans = zip(starts[:n].tolist(), ends[len(parts) - n :].tolist(), strict=True)
    hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    over = np.packbits(2 * counts > n, bitorder="little")
    return int(over.view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, text_key, fp) of each document; fp and text_key are longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t, words) for t in batch.column("text").to_pylist()), np.uint64, len(batch))
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "fp"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return chosen.mapInArrow(run, "doc_id long, text_key long, fp long")


# --- the index ---


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in Gray order, where neighbours differ in few bits."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Fingerprints in Gray order under nodes that hold the bits all their fingerprints share.

    `mask` of a node marks the bits in which its fingerprints agree and no node above it does: shared
    bits are factored into the uppermost node they hold for. On the way down a query adds
    up its differences in these bits, each bit once; a node whose sum is over the limit is left with all below it.
    """

    def __init__(self, codes: np.ndarray):
        """`codes`: distinct unsigned 64-bit numbers in Gray order."""
        self.codes = codes
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        ones, zeros = codes, ~codes
        shared = [(ones, ones | zeros)]
        while len(ones) > 1:
            cuts = np.arange(0, len(ones), FAN)
            ones, zeros = np.bitwise_and.reduceat(ones, cuts), np.bitwise_and.reduceat(zeros, cuts)
            shared.append((ones, ones | zeros))
        shared.reverse()
        above = np.zeros(1, np.uint64)
        for pattern, agreed in shared:
            if len(self.levels):
                above = np.repeat(above, FAN)[: len(agreed)]
            self.levels.append((pattern, agreed & ~above))
            above = agreed

    def uniform(self, labels: np.ndarray) -> list[np.ndarray]:
        """By level, the label that all fingerprints of a node have, else -1."""
        low = high = labels
        out = [labels]
        while len(low) > 1:
            cuts = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            out.append(np.where(low == high, low, -1))
        return out[::-1]

    def near(self, queries: np.ndarray, limit: int, own: np.ndarray, labels: np.ndarray, after: np.ndarray | None):
        """(query number, place in the index) of pairs within `limit` bits.

        Nodes whose fingerprints all carry the query's own label are left out: they are joined already.
        `after`: only places after these are wanted.
        """
        q = np.arange(len(queries))
        node = np.zeros(len(queries), np.int64)
        sums = np.zeros(len(queries), np.int64)
        below = len(self.levels)
        for (pattern, mask), same in zip(self.levels, self.uniform(labels), strict=True):
            below -= 1
            sums = sums + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
            stay = (sums <= limit) & (same[node] != own[q])
            if after is not None:
                stay &= np.minimum((node + 1) * FAN**below, len(self.codes)) - 1 > after[q]
            q, node, sums = q[stay], node[stay], sums[stay]
            if below:
                size = len(self.levels[len(self.levels) - below][0])
                child = (node[:, None] * FAN + np.arange(FAN)).reshape(-1)
                there = child < size
                q, sums, node = np.repeat(q, FAN)[there], np.repeat(sums, FAN)[there], child[there]
        return q, node


def cell_edges(codes: np.ndarray, side: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges, one per fingerprint at most, that join what lies within `limit` bits in one cell.

    `side` 0 and 1 are the two blocks of a cell: pairs inside one block belong to that block's own cell,
    where all are side 0.
    """
    order = np.argsort(gray_rank(codes), kind="stable")
    codes, side = codes[order], side[order]
    labels = np.arange(len(codes))
    whole = not side.any()
    targets = np.arange(len(codes)) if whole else np.flatnonzero(side == 1)
    sources = targets if whole else np.flatnonzero(side == 0)
    if len(targets) and len(sources):
        index = GrayIndex(codes[targets])
        for i in range(0, len(sources), QUERIES):
            some = sources[i : i + QUERIES]
            after = np.arange(i, i + len(some)) if whole else None
            q, at = index.near(codes[some], limit, labels[some], labels[targets], after)
            join_labels(labels, some[q], targets[at])
    rest = labels != np.arange(len(codes))
    return codes[rest], codes[labels[rest]]


# --- the join ---


def segments(bits: int) -> list[tuple[int, int]]:
    """(shift, width) of bits + 1 segments of 64 bits: two fingerprints within `bits` bits agree in one of them."""
    n = bits + 1
    bounds = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def near_links(codes: DataFrame, bits: int = BITS) -> DataFrame:
    """(u, v): links between distinct fingerprints (column fp) that join all pairs within `bits` bits.

    Each fingerprint goes to one class per segment, by the first bits of that segment, as many as bring a class
    to about CELL fingerprints: any two within `bits` bits meet in a class. A class that is larger
    (a family of near copies) is cut into blocks of CELL, and each pair of blocks is a cell of its own, so a
    cell holds about 2 * CELL fingerprints at most. A cell's pairs become a forest at once: all
    pairs of a family are never written.
    """
    n = codes.count()
    parts = segments(bits)
    depth = min(min(w for _, w in parts), max(0, math.ceil(math.log2(max(1, n / CELL)))))
    classes = F.array(*[
        (F.pmod(F.shiftright("fp", shift), F.lit(1 << depth)) * len(parts) + i).cast("int")
        for i, (shift, _) in enumerate(parts)
    ])
    placed = codes.select("fp", F.explode(classes).alias("class"))
    # At most (bits + 1) * 2 ** depth rows, depth at most 12: fit to be broadcast by construction.
    blocks = placed.groupBy("class").agg(F.ceil(F.count("*") / CELL).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64(F.lit(5), "fp"), F.col("blocks")).cast("int")
    cells = (
        placed.join(F.broadcast(blocks), "class")
        .withColumn("block", block)
        .select("class", "block", "fp", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select(
            "class",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            F.when(F.col("block") > F.col("other"), 1).otherwise(0).alias("side"),
            "fp",
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        now = None

        def finished():
            rows = np.concatenate(held)
            return edge_batch(*[x.view(np.int64) for x in cell_edges(rows[:, 1].copy().view(np.uint64), rows[:, 0], bits)])

        for batch in batches:
            c, low, high, side, fp = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in batch.columns)
            cuts = np.flatnonzero((np.diff(c) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(c)], strict=True):
                if a == b:
                    continue
                cell = (c[a], low[a], high[a])
                if cell != now and held:
                    yield finished()
                    held = []
                now = cell
                held.append(np.stack([side[a:b], fp[a:b]], axis=1))
        if held:
            yield finished()

    key = ["class", "low", "high"]
    return cells.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, EDGES)


def _groups(prints: DataFrame, bits: int) -> DataFrame:
    """(fp, root): each distinct fingerprint with the fingerprint that stands for its component."""
    codes = stored(prints.select("fp").distinct(), "codes")
    roots = components(near_links(codes, bits)).withColumnRenamed("u", "member")
    joined = codes.join(roots, codes["fp"] == roots["member"], "left")
    return joined.select("fp", F.coalesce("root", "fp").alias("root"))


def simhash_groups(docs: DataFrame, bits: int = BITS, words: int = WORDS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Whole texts, A-Z in lower case, shingles of `words` words, repeats included; fewer words are one shingle;
    no words, or null, give fingerprint zero, which is linked like any other. Documents
    link at `bits` or fewer differing bits; component_id is the smallest doc_id of those linked, directly or over others.
    A null doc_id gets its component but never names one, unless there is no other: then component_id is null.
    Extra columns are not used; equal rows each give their row; an empty table gives no rows.
    """
    prints = stored(fingerprints(docs, words).select("doc_id", "fp"), "prints")
    groups = stored(_groups(prints, bits), "groups")
    # Per fingerprint first: a component with a third of all documents is few rows when it meets.
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    names = least.join(groups, "fp").groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(groups.join(names, "root").select("fp", "component_id"), "named")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, bits: int = BITS, words: int = WORDS) -> DataFrame:
    """`docs` with one row of each component of simhash_groups(): that of the smallest doc_id.

    Of several rows with that doc_id the one with the smallest hash of its text stays; of equal rows, one. Null ids come last.
    """
    prints = stored(fingerprints(docs, words), "prints")
    groups = _groups(prints, bits)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    first = prints.groupBy("fp").agg(F.min(order).alias("first"))
    kept = first.join(groups, "fp").groupBy("root").agg(F.min("first").alias("first"))
    own, key = unused_name(docs, "kept_id"), unused_name(docs, "kept_text")
    kept = kept.select(F.col("first.doc_id").alias(own), F.col("first.text_key").alias(key)).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(own)) & (F.xxhash64(docs["text"]) == F.col(key))
    return docs.join(kept, same).dropDuplicates([own, key]).select(*docs.columns)
