"""Byte-level BPE by a global shuffle of distinct words: each word is encoded once, its ids are joined back.

Text is split into pre-tokens ("words") by the tokenizer's pattern. A block is a run of documents of one
task, up to BLOCK_CHARS of text (a longer document is a block of its own). Of a block go out

* one payload row: its documents and the number of the word at each position, and
* one packet row per bucket: the block's distinct words of that hash bucket.

Packets meet by bucket, a task for each, where each distinct word is encoded once, and return to their block, where
ids are put at the words' positions. Both kinds of rows go through the same two shuffles, so the text
is split once and nothing needs to be kept. There is a bucket for so much text as was counted in the input, which bounds a task and
the words it remembers. A word's rows are at most one per block, however often it occurs:
there are no hot words. Packets carry many words in one row, which keeps the shuffle small.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from roadstrata.llm.common import shared_bytes

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
BLOCK_CHARS = 12 << 20
#: Bytes of text that one bucket of the word shuffle stands for: some tenth of them are distinct words of their blocks, which its task remembers.
BYTES_PER_BUCKET = 64 << 20
#: Tokens gathered at a time.
CHUNK = 1 << 20

PAYLOAD = -1
ROWS = "block long, bucket int, data binary"


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes to rank, of the lines of a rank file."""
    pairs = (line.split() for line in raw.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def encoder(ranks: dict[bytes, int]):
    """bytes of one pre-token to its ids. The merges themselves are the public library's."""
    import tiktoken

    # The text is split already: the pattern takes what it is given as one piece.
    library = tiktoken.Encoding("ranks", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
    return library.encode_ordinary


class TokenBytes:
    """The token-byte table as one flat array: the bytes of many ids in a few array operations."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values(), default=-1) + 1
        table = [b""] * size
        for token, rank in ranks.items():
            table[rank] = token
        self.lengths = np.fromiter(map(len, table), np.int64, size)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(table), np.uint8)

    def join(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes, and how many of them there are up to and with each id."""
        return gather(self.flat, self.starts, self.lengths, ids)


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, of: np.ndarray):
    """The pieces `of` of a ragged array one after the other, and their ends."""
    sizes = lengths[of]
    ends = np.cumsum(sizes)
    shift = starts[of] - (ends - sizes)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(shift, sizes)], ends


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned numbers as one compressed byte string; equal bytes of each lie together."""
    parts = []
    for a in arrays:
        a = a.astype("<u4")
        parts += [len(a).to_bytes(8, "little"), a.view(np.uint8).reshape(-1, 4).T.tobytes()]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def unsqueeze(data: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(raw):
        n = int.from_bytes(raw[at : at + 8], "little")
        planes = np.frombuffer(raw, np.uint8, 4 * n, at + 8).reshape(4, n)
        out.append(np.ascontiguousarray(planes.T).view("<u4").reshape(-1))
        at += 8 + 4 * n
    return out


def pack_words(words: Iterable[bytes]) -> bytes:
    words = list(words)
    lengths = np.fromiter(map(len, words), "<u4", len(words))
    raw = len(words).to_bytes(8, "little") + lengths.tobytes() + b"".join(words)
    return zstandard.ZstdCompressor(level=3).compress(raw)


def unpack_words(data: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int.from_bytes(raw[:8], "little")
    ends = (np.cumsum(np.frombuffer(raw, "<u4", n, 8), dtype=np.int64) + 8 + 4 * n).tolist()
    return [raw[a:b] for a, b in zip([8 + 4 * n, *ends[:-1]], ends, strict=True)]


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    block, bucket, data = zip(*rows, strict=True)
    columns = [pa.array(block, pa.int64()), pa.array(bucket, pa.int32()), pa.array(data, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["block", "bucket", "data"])


def _ids_plane(ids: list[int | None]) -> tuple[np.ndarray, ...]:
    """doc_ids as three arrays of 32 bits: whether there is one, its lower and its upper half."""
    known = np.fromiter((i is not None for i in ids), bool, len(ids))
    value = np.fromiter((i or 0 for i in ids), np.int64, len(ids)).view(np.uint64)
    return known, value & np.uint64(0xFFFFFFFF), value >> np.uint64(32)


def split_blocks(pattern: str, buckets: int, block_chars: int = BLOCK_CHARS):
    """mapInArrow function: (doc_id, text) to the payload and packet rows of their blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words_of = regex.compile(pattern).findall
        # The same split of the input gives the same blocks when a task runs again.
        names = count(TaskContext.get().partitionId() << 32)

        def flushed():
            words = [w.encode() for w in number]
            bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
            at = np.concatenate(places) if places else np.empty(0, np.uint32)
            sizes = np.fromiter(map(len, places), np.int64, len(places))
            name = next(names)
            yield _rows([(name, PAYLOAD, squeeze(*_ids_plane(ids), sizes, at, bucket))])
            order = np.argsort(bucket, kind="stable")
            used, starts = np.unique(bucket[order], return_index=True)
            ends = [*starts.tolist(), len(words)][1:]
            rows, held = [], 0
            for b, start, end in zip(used.tolist(), starts.tolist(), ends, strict=True):
                rows.append((name, b, pack_words(words[i] for i in order[start:end])))
                held += len(rows[-1][2])
                if held > 1 << 22 or len(rows) >= 1024:
                    yield _rows(rows)
                    rows, held = [], 0
            if rows:
                yield _rows(rows)

        number, ids, places, held = defaultdict(count().__next__), [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text or "")
                places.append(np.fromiter(map(number.__getitem__, words), np.uint32, len(words)))
                ids.append(doc)
                held += len(text or "")
                if held >= block_chars:
                    yield from flushed()
                    number, ids, places, held = defaultdict(count().__next__), [], [], 0
        if ids:
            yield from flushed()

    return run


def encode_packets(ranks_file):
    """mapInArrow function over the packets of one bucket: packets of words to packets of their ids, each word encoded once; payload rows pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, known = encoder(read_ranks(ranks_file.value)), {}
        for batch in batches:
            rows = []
            for block, bucket, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if bucket != PAYLOAD:
                    found = []
                    for word in unpack_words(data):
                        ids = known.get(word)
                        if ids is None:
                            ids = known[word] = encode(word.decode())
                        found.append(ids)
                    lengths = np.fromiter(map(len, found), np.uint32, len(found))
                    flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(lengths.sum()))
                    data = squeeze(lengths, flat)
                rows.append((block, bucket, data))
            if rows:
                yield _rows(rows)

    return run


def _documents(payload: bytes, packets: list[bytes]) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of each document of a block."""
    known, low, high, sizes, at, bucket = unsqueeze(payload)
    parts = [unsqueeze(p) for p in packets]
    none = [np.empty(0, np.uint32)]
    lengths = np.concatenate([p[0] for p in parts] or none).astype(np.int64)
    flat = np.concatenate([p[1] for p in parts] or none)
    starts = np.cumsum(lengths) - lengths
    # Packets come by bucket, words in a packet by number: where word i came to lie.
    place = np.empty(len(bucket), np.int64)
    place[np.argsort(bucket, kind="stable")] = np.arange(len(bucket))
    doc_ids = (low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)).view(np.int64)
    ends = np.cumsum(sizes, dtype=np.int64)
    first, done = 0, 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(ends, done + CHUNK, "right")))
        ids, token_ends = gather(flat, starts, lengths, place[at[done : ends[last - 1]]])
        token_ends = np.concatenate([[0], token_ends])
        cuts = token_ends[np.concatenate([[done], ends[first:last]]) - done]
        for k in range(first, last):
            doc = int(doc_ids[k]) if known[k] else None
            yield doc, ids[cuts[k - first] : cuts[k - first + 1]]
        first, done = last, int(ends[last - 1])


def assemble(ranks_file, with_ids: bool):
    """mapInArrow function over rows sorted by block and bucket: the documents of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = TokenBytes(read_ranks(ranks_file.value))

        def finished(payload: bytes, packets: list[bytes]) -> Iterator[pa.RecordBatch]:
            rows, held = [], 0
            for doc, ids in _documents(payload, packets):
                shas = hashlib.sha256(), hashlib.sha256()
                shas[0].update(ids.astype("<u4").tobytes())
                for i in range(0, len(ids), CHUNK):
                    shas[1].update(table.join(ids[i : i + CHUNK])[0].tobytes())
                rows.append((doc, len(ids), *[s.hexdigest() for s in shas], ids if with_ids else None))
                held += len(ids) if with_ids else 64
                if held > CHUNK:
                    yield made(rows)
                    rows, held = [], 0
            if rows:
                yield made(rows)

        def made(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns[: 4 + with_ids], names=names[: 4 + with_ids])

        now, payload, packets = None, b"", []
        for batch in batches:
            for block, bucket, data in zip(*batch.columns, strict=True):
                if block.as_py() != now:
                    if now is not None:
                        yield from finished(payload, packets)
                    now, packets = block.as_py(), []
                if bucket.as_py() == PAYLOAD:
                    payload = data.as_py()
                else:
                    packets.append(data.as_py())
        if now is not None:
            yield from finished(payload, packets)

    return run


def bucket_count(docs: DataFrame) -> int:
    """One bucket per BYTES_PER_BUCKET of text, which is counted, and at least as many as the session gives a shuffle."""
    spark = docs.sparkSession
    least = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(least, -(-total // BYTES_PER_BUCKET))


def block_home(buckets: int) -> Column:
    """The task of a block: blocks of one task go to one task after the other, from its own number on, so all get as many."""
    nth = F.col("block").bitwiseAND(F.lit((1 << 32) - 1))
    return F.pmod(F.shiftright("block", 32) + nth, F.lit(buckets)).cast("int")


def dealt_words(docs: DataFrame, buckets: int) -> DataFrame:
    """Payload and packet rows of (doc_id, text): all packets of a bucket, and no others, in the task of its number."""
    rows = docs.mapInArrow(split_blocks(public_tokenizers.PATTERN, buckets), ROWS)
    return rows.repartitionById(buckets, F.when(F.col("bucket") == PAYLOAD, block_home(buckets)).otherwise(F.col("bucket")))


def bpe_report(docs: DataFrame, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256, and ids if wanted.

    Whole texts by the ranks in the file `vocabulary`, each match of public_tokenizers.PATTERN apart, without special tokens.
    A null text is empty: no ids. Equal rows each give their row; a null doc_id stays null. Extra columns are not
    used; an empty table gives no rows. `docs` is read twice, once to count its text, and again by tasks that are lost: it should come from files,
    whose splits hold the same rows each time, since a block is named by its task and its place in it. The digests are of the ids as little-endian 32-bit numbers and of
    the bytes that the ids decode to by the token-byte table.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    ranks = shared_bytes(docs.sparkSession, path)
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    buckets = bucket_count(docs)
    encoded = dealt_words(chosen, buckets).mapInArrow(encode_packets(ranks), ROWS)
    gathered = encoded.repartitionById(buckets, block_home(buckets)).sortWithinPartitions("block", "bucket")
    out = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return gathered.mapInArrow(assemble(ranks, with_ids), out + ", ids array<int>" * with_ids)
