"""Token ids of documents in coded files: written in the order of doc_id, read back block by block.

A folder of files holds

- `table`: the shared frequencies (id, freq), from the counts of all ids;
- `blocks`: a row per coded block, in Parquet because its commits survive lost executors and any file system takes it:
  part and block (their order is the order of the ids), first (its first id within the part), n_ids, states, places and
  words of `rans.py` as little-endian bytes, words_crc32 and ids_crc32, docs (doc_id, first within the block, n) of the
  documents that start in it, and open_first: where in the part the document starts that the block goes on with.

Each block decodes by itself.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from roadstrata.llm import rans
from roadstrata.llm.common import shared_bytes, stored
from roadstrata.workspace import discard, materialize_at, scratch_path, session_setting, shuffle_width

VOCABULARY = "word_bpe_49k.json"
END = 2
#: Bytes of text encoded at a time, and pieces of text and words that a task remembers before it starts anew with either.
TEXTS, REMEMBERED, WORDS = 6 << 20, 600_000, 800_000
#: Blocks that are coded together.
TOGETHER = 32

#: Pieces of characters whose words can be told apart here, Latin letters, digits and signs that start no special form, and such words.
SIMPLE = r"""^[A-Za-z0-9À-ÖØ-öø-ÿ!"#$%&()*+,\-./:;=>?@\[\]\\^_`{}~]+$"""
#: By byte: letters, which all bytes of other than ASCII characters are here, digits, each a word of its own, and signs.
LETTER, DIGIT = 1, 2
KIND = np.array([DIGIT if 48 <= b <= 57 else LETTER if 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint8)
#: Separators for Arrow and Python that are not white space for the library, and the library's white space.
NOT_SPACE, SPACE = re.compile("[\x1c-\x1f]").search, re.compile(r"[^\S\x1c-\x1f]+")

BLOCKS = (
    "part int, block int, first long, n_ids int, open_first long, states binary, places binary, words binary, "
    "words_crc32 long, ids_crc32 long, docs array<struct<doc_id:long,first:int,n:long>>"
)


class Encoder:
    """Ids of whole texts by the public library, which sees each distinct word once while a task remembers it.

    The vocabulary drops white space and no word crosses it, so a text's ids are those of its pieces between white space. Pieces of simple
    characters are cut into words as the vocabulary's pattern would; other pieces go to the library as they are.
    """

    def __init__(self, raw: bytes, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(raw.decode())
        self.end = end
        model = json.loads(raw)["model"]
        suffix = model.get("end_of_word_suffix")
        #: Whether an id ends a word, if the vocabulary says so.
        self.ends_word = None
        if suffix:
            self.ends_word = np.zeros(self.library.get_vocab_size(), bool)
            self.ends_word[[i for token, i in model["vocab"].items() if token.endswith(suffix)]] = True
        self.words = _Memory()
        self._forget_pieces()

    def _forget_pieces(self) -> None:
        self.pieces = _Memory()
        # No piece of a text is a line break, so that can stand for the end id.
        self.pieces.add(["", "\n"], np.array([self.end], np.uint32), np.array([0, 1]))

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after the other, how many of each word)"""
        known = words.dictionary_encode()
        return self.words.look_up(known.dictionary, known.indices.to_numpy(), self._plain_words)

    def _plain_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As one text with a space between words; ids that end a word tell them apart again."""
        if self.ends_word is not None:
            line = " ".join(_strings(words))
            ids = np.array(self.library.encode_batch_fast([line], add_special_tokens=False)[0].ids, np.uint32)
            last = np.flatnonzero(self.ends_word[ids])
            if len(last) == len(words) and (not len(ids) or last[-1] == len(ids) - 1):
                return ids, np.diff(last, prepend=-1)
        return self._by_library(words)

    def _by_library(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.library.encode_batch_fast(_strings(words), add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _by_words(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        simple = pc.match_substring_regex(pieces, SIMPLE)
        words, per_piece = _cut(pc.utf8_lower(pieces.filter(simple)))
        ids, sizes = self._words(words)
        owner = np.repeat(np.arange(len(per_piece)), per_piece)
        easy = np.bincount(owner, weights=sizes, minlength=len(per_piece)).astype(np.int64)
        other_ids, other_sizes = self._by_library(pieces.filter(pc.invert(simple)))
        is_simple = simple.to_numpy(zero_copy_only=False)
        total = np.empty(len(pieces), np.int64)
        total[is_simple], total[~is_simple] = easy, other_sizes
        every, from_words = np.empty(int(total.sum()), np.uint32), np.repeat(is_simple, total)
        every[from_words], every[~from_words] = ids, other_ids
        return every, total

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, each with the end id; the number of each text's ids)"""
        if len(self.pieces.number) > REMEMBERED:
            self._forget_pieces()
        # Words come back in new pieces, and cost far more to learn.
        if len(self.words.number) > WORDS:
            self.words = _Memory()
        texts = pc.fill_null(texts, "")
        pieces = pc.utf8_split_whitespace(texts)
        if pc.any(pc.match_substring_regex(texts, "[\x1c-\x1f]")).as_py():
            pieces = pa.array([SPACE.split(t) for t in texts.to_pylist()], pa.list_(pa.string()))
        known = pieces.flatten().dictionary_encode()
        bounds = pieces.offsets.to_numpy()
        at = np.insert(known.indices.to_numpy(), bounds[1:], len(known.dictionary))
        ids, sizes = self.pieces.look_up(pa.concat_arrays([known.dictionary, pa.array(["\n"])]), at, self._by_words)
        places = np.append(0, np.cumsum(sizes))[bounds + np.arange(len(bounds))]
        return ids, np.diff(places)


def _cut(pieces: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """(words of lower-cased simple pieces one after the other, how many of each): where the kind of character changes, and at each digit."""
    if not len(pieces):
        return pa.array([], pa.string()), np.zeros(0, np.int64)
    bounds = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset : pieces.offset + len(pieces) + 1]
    text = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    kind = KIND[text]
    begins = kind == DIGIT
    begins[1:] |= kind[1:] != kind[:-1]
    begins[bounds[:-1]] = True
    starts = np.flatnonzero(begins)
    places = np.append(starts, len(text)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(text))
    return words, np.diff(np.searchsorted(starts, bounds))


def _strings(array: pa.Array) -> list[str]:
    """As to_pylist(), several times as fast."""
    return array.to_numpy(zero_copy_only=False).tolist()


_kept: dict[tuple[int, int], Encoder] = {}


def encoder(raw: bytes, end: int) -> Encoder:
    """The worker's encoder for a vocabulary: tasks that follow one another in a worker share what it remembers."""
    key = (zlib.crc32(raw), end)
    if key not in _kept:
        _kept.clear()
        _kept[key] = Encoder(raw, end)
    return _kept[key]


class _Memory:
    """Ids of strings met before."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.flat, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def add(self, strings: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.number.update(zip(strings, range(len(self.number), len(self.number) + len(strings)), strict=True))
        starts = (len(self.flat) + np.cumsum(sizes) - sizes).astype(np.int32)
        self.starts, self.sizes = np.append(self.starts, starts), np.append(self.sizes, sizes.astype(np.int32))
        self.flat = np.append(self.flat, ids)

    def look_up(self, distinct: pa.Array, at: np.ndarray, learn) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after the other, how many of each) of distinct[at]; `learn` gives those of strings not met before."""
        strings = _strings(distinct)
        place = np.fromiter(map(self.number.get, strings, repeat(-1)), np.int64, len(strings))
        fresh = np.flatnonzero(place < 0)
        if len(fresh):
            some = distinct.take(pa.array(fresh))
            ids, sizes = learn(some)
            place[fresh] = len(self.number) + np.arange(len(fresh))
            self.add([strings[i] for i in fresh.tolist()], ids, sizes)
        sizes, starts = self.sizes[place], self.starts[place]
        size = sizes[at]
        before = np.cumsum(size, dtype=np.int32) - size
        return self.flat[np.repeat(starts[at] - before, size) + np.arange(size.sum(), dtype=np.int32)], size


def tokens(docs: DataFrame, vocabulary: str | None = None, end: int = END) -> DataFrame:
    """One row per document: doc_id, n, ids (binary: 16-bit little-endian, or 32-bit for larger vocabularies).

    The library's ids of the whole text (null: empty) without added begin or end, special strings inside handled as its
    default, and `end` after them. Map-only.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    raw, wide, end_id = shared_bytes(docs.sparkSession, path), id_width(path), end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(raw.value, end_id)
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy().cumsum()
            cuts = [*np.flatnonzero(np.diff(size // TEXTS)) + 1, batch.num_rows]
            for at, end in zip([0, *cuts], cuts, strict=False):
                texts = batch.column("text").slice(at, end - at)
                ids, lengths = encode(texts)
                ids = ids.astype("<u2" if wide == 2 else "<u4")
                bounds = np.append(0, np.cumsum(lengths)) * wide
                data = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(texts), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(ids)]
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(texts)), pa.array(lengths), data.cast(pa.binary())],
                    names=["doc_id", "n", "ids"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, ids binary")


def id_width(path: str) -> int:
    """Bytes of an id as `tokens` gives them."""
    with open(path, encoding="utf-8") as f:
        definition = json.load(f)
    top = max([*definition["model"]["vocab"].values(), *(t["id"] for t in definition.get("added_tokens", []))], default=0)
    return 2 if top < 1 << 16 else 4


def id_counts(ids: DataFrame, wide: int) -> dict[int, int]:
    """How often each id stands in all rows: at most one number per id of the vocabulary reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            # All rows of a batch at once: counting each by itself would go over the whole vocabulary for every document.
            found = np.bincount(np.frombuffer(_joined(batch.column(0)), f"<u{wide}"))
            if len(found) > len(total):
                total = np.append(total, np.zeros(len(found) - len(total), np.int64))
            total[: len(found)] += found
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["id", "n"])

    counted = ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return {r.id: r.n for r in counted.collect()}


def _joined(rows: pa.BinaryArray) -> memoryview:
    """The bytes of all rows one after the other, null as none, without a copy."""
    if rows.null_count:
        rows = rows.drop_null()
    if not len(rows):
        return memoryview(b"")
    offsets = np.frombuffer(rows.buffers()[1], np.int32)[rows.offset : rows.offset + len(rows) + 1]
    return memoryview(rows.buffers()[2] or b"")[offsets[0] : offsets[-1]]


class _Writer:
    """Cuts one part's ids into blocks and codes some at a time."""

    def __init__(self, shares: dict[int, int]):
        self.table = rans.Table(shares)
        self.first = self.block = 0  # of the next block
        self.held: list[np.ndarray] = []
        self.size = 0
        self.docs: list[tuple[int | None, int, int]] = []  # those that start in what is held, by place in the part
        self.open = -1

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[dict]:
        self.docs.append((doc_id, self.first + self.size, len(ids)))
        self.held.append(ids)
        self.size += len(ids)
        while self.size >= TOGETHER * rans.BLOCK:
            yield from self.flush(TOGETHER)

    def flush(self, blocks: int | None = None) -> Iterator[dict]:
        """Codes the first `blocks` full blocks of what is held, or all of it."""
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint16)
        rest = ids[blocks * rans.BLOCK :] if blocks else ids[:0]
        cut = [ids[i : i + rans.BLOCK] for i in range(0, len(ids) - len(rest), rans.BLOCK)]
        self.held, self.size = [rest], len(rest)
        docs, at = self.docs, 0
        for symbols, coded in zip(cut, rans.encode(cut, self.table), strict=True):
            own = []
            while at < len(docs) and docs[at][1] < self.first + coded.n:
                own.append({"doc_id": docs[at][0], "first": docs[at][1] - self.first, "n": docs[at][2]})
                at += 1
            words = coded.words.astype("<u4").tobytes()
            yield {
                "block": self.block, "first": self.first, "n_ids": coded.n,
                "open_first": -1 if own and own[0]["first"] == 0 else self.open,
                "states": coded.states.astype("<u8").tobytes(), "places": coded.places.astype("<i4").tobytes(), "words": words,
                "words_crc32": zlib.crc32(words), "ids_crc32": zlib.crc32(symbols.astype("<u4")), "docs": own,
            }
            if own:
                self.open = self.first + own[-1]["first"]
            self.first += coded.n
            self.block += 1
        self.docs = docs[at:]


def write_ids(docs: DataFrame, path: str, vocabulary: str | None = None, end: int = END) -> None:
    """Write the documents' ids under `path`, in ascending order of doc_id (null first, then by number and hash of the ids).

    Ids are counted over all documents before any is coded. Rows are dealt by ranges of (doc_id, number, hash, row), so a
    doc_id with a third of all rows is spread over parts; a part is coded in runs of whole blocks, a long document over as many
    as it needs. Extra columns are not used; an empty table gives files without rows.
    """
    spark = docs.sparkSession
    wide, scratch = id_width(vocabulary or public_tokenizers.path(VOCABULARY)), scratch_path(spark, "ids")
    with session_setting(spark, "spark.sql.parquet.compression.codec", "zstd"):
        ids = materialize_at(tokens(docs, vocabulary, end), scratch)
    shares = rans.frequencies(id_counts(ids, wide))
    table = [(int(s), int(n)) for s, n in shares.items()]
    spark.createDataFrame(table, "id long, freq long").coalesce(1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast(shares)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, part = _Writer(shared.value), None
        schema = pa.schema(
            [
                ("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()),
                ("open_first", pa.int64()), ("states", pa.binary()), ("places", pa.binary()), ("words", pa.binary()),
                ("words_crc32", pa.int64()), ("ids_crc32", pa.int64()),
                ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("first", pa.int32()), ("n", pa.int64())]))),
            ]
        )

        def rows(found: Iterator[dict]) -> Iterator[pa.RecordBatch]:
            for some in _chunks(found, TOGETHER):
                yield pa.RecordBatch.from_pylist([{"part": part, **r} for r in some], schema=schema)

        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
            for doc_id, one in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                yield from rows(writer.add(doc_id, np.frombuffer(one.as_buffer(), f"<u{wide}")))
        if part is not None:
            yield from rows(writer.flush())

    order = ["doc_id", "n", "hash", "row"]
    (
        ids.withColumns({"hash": F.xxhash64("ids"), "row": F.monotonically_increasing_id()})
        .repartitionByRange(shuffle_width(spark, scratch), *order)
        .sortWithinPartitions(*order)
        .select(F.spark_partition_id().alias("part"), "doc_id", "ids")
        .mapInArrow(code, BLOCKS)
        .write.parquet(f"{path}/blocks")
    )
    discard(spark, scratch)


def _chunks(rows: Iterator, size: int) -> Iterator[list]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def _read_blocks(rows: list[dict], table: rans.Table) -> list[np.ndarray]:
    """Ids of some blocks. A block whose words or ids do not fit their checksum ends the read."""
    coded = []
    for r in rows:
        if zlib.crc32(r["words"]) != r["words_crc32"]:
            raise ValueError(f"words of block {r['block']} of part {r['part']} are damaged")
        states = np.frombuffer(r["states"], "<u8").reshape(-1, rans.LANES)
        coded.append(rans.Block(r["n_ids"], states, np.frombuffer(r["places"], "<i4"), np.frombuffer(r["words"], "<u4")))
    found = rans.decode(coded, table)
    for r, ids in zip(rows, found, strict=True):
        if zlib.crc32(ids.astype("<u4")) != r["ids_crc32"]:
            raise ValueError(f"ids of block {r['block']} of part {r['part']} are damaged")
    return found


def _pieces(spark: SparkSession, path: str, with_ids: bool) -> DataFrame:
    """What each block holds of each document: part, doc_first, doc_id, n, piece_first, piece_n, crc, ids.

    doc_id and n are those of the document where it starts, else null; ids only if asked for.
    """
    shares = {r.id: r.freq for r in spark.read.parquet(f"{path}/table").collect()}  # bounded by the vocabulary
    shared = spark.sparkContext.broadcast(shares)
    schema = pa.schema(
        [
            ("part", pa.int32()), ("doc_first", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()),
            ("piece_first", pa.int64()), ("piece_n", pa.int64()), ("crc", pa.int64()), ("ids", pa.list_(pa.int32())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Table(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                rows, out = batch.slice(at, TOGETHER).to_pylist(), []
                for r, ids in zip(rows, _read_blocks(rows, table), strict=True):
                    docs = [{"doc_id": d["doc_id"], "n": d["n"], "at": d["first"], "doc_first": r["first"] + d["first"]} for d in r["docs"]]
                    if r["open_first"] >= 0:
                        docs.insert(0, {"doc_id": None, "n": None, "at": 0, "doc_first": r["open_first"]})
                    for d, end in zip(docs, [*(d["at"] for d in docs[1:]), r["n_ids"]], strict=True):
                        piece = ids[d.pop("at") : end].astype("<u4")
                        out.append(
                            d | {"part": r["part"], "piece_first": r["first"] + end - len(piece), "piece_n": len(piece),
                                 "crc": zlib.crc32(piece), "ids": piece.view("<i4") if with_ids else None}
                        )
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    kinds = "part int, doc_first long, doc_id long, n long, piece_first long, piece_n long, crc long, ids array<int>"
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    return blocks.mapInArrow(run, kinds)


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, before): ids of all parts before. A row per part; no word of a block is read."""
    sizes = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))


def _join_crcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        joined = []
        for pieces in batch.column("pieces").to_pylist():
            crc = pieces[0]["crc"]
            for p in pieces[1:]:
                crc = rans.crc32_join(crc, p["crc"], 4 * p["piece_n"])
            joined.append(crc)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(joined, pa.int64())], names=[*batch.schema.names[:-1], "crc"])


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files under `path`: doc_id, start, n_tokens, ids_crc32, all from what the blocks decode to.

    Blocks decode side by side and are checked against their checksums. A document that goes over several
    blocks gives a checksum per block, and these are joined; its ids are not gathered.
    """
    # A batch is a list of whole blocks, some 100 KB each, so it must be short; the setting counts while the plan runs.
    with session_setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(2 * TOGETHER)):
        pieces = stored(_pieces(spark, path, False).drop("ids"), "pieces")
    whole = pieces.filter(F.col("n") == F.col("piece_n")).select("part", "doc_first", "doc_id", F.col("n").alias("n_tokens"), "crc")
    piece = F.struct("piece_first", "piece_n", F.col("crc").alias("crc"))
    cut = (
        pieces.filter("n is null or n <> piece_n")
        .groupBy("part", "doc_first")
        .agg(F.max("doc_id").alias("doc_id"), F.sum("piece_n").alias("n_tokens"), F.sort_array(F.collect_list(piece)).alias("pieces"))
        .mapInArrow(_join_crcs, "part int, doc_first long, doc_id long, n_tokens long, crc long")
    )
    return (
        whole.unionByName(cut)
        .join(part_starts(spark, path), "part")
        .select("doc_id", (F.col("before") + F.col("doc_first")).alias("start"), "n_tokens", F.col("crc").alias("ids_crc32"))
    )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, start, ids. Documents within a block need no shuffle, others are put together."""
    with session_setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(2 * TOGETHER)):
        pieces = stored(_pieces(spark, path, True), "pieces")
    cut = (
        pieces.filter("n is null or n <> piece_n")
        .groupBy("part", "doc_first")
        .agg(F.max("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("piece_first", "ids"))).alias("pieces"))
        .select("part", "doc_first", "doc_id", F.flatten(F.transform("pieces", lambda p: p["ids"])).alias("ids"))
    )
    whole = pieces.filter(F.col("n") == F.col("piece_n")).select("part", "doc_first", "doc_id", "ids")
    return (
        whole.unionByName(cut)
        .join(part_starts(spark, path), "part")
        .select("doc_id", (F.col("before") + F.col("doc_first")).alias("start"), "ids")
    )


def token_file_report(docs: DataFrame, vocabulary: str | None = None, end: int = END) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids_crc32, read back from files written for it.

    Whole texts, null as empty; every document has at least its end id. Documents of equal or null doc_id each give their row and
    lie side by side. Extra columns are not used; an empty table gives no rows.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "token-files")
    write_ids(docs, path, vocabulary, end)
    return read_report(spark, path)
