"""How far the sources of a language diverge in their words, pair by pair and term by term.

Terms are counted in tasks before the shuffle. A bucket holds all sources' counts of some terms of a language: its task adds up
the distances of all pairs of sources over its terms as arrays, and keeps each source's skyband, the terms that fewer than k others
dominate. Skybands of buckets are merged, and what is left is ranked exactly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from roadstrata.llm.common import stored

#: Documents of a language that must hold a term, terms ranked per group, and the contract's additive constants.
DOCUMENTS, TERMS, SCALE, MORE = 30, 50, 1_000_000_000, 5
#: Rows of a bucket on average; cells of a dense array at a time; buckets merged at a time.
ROWS, CELLS, MERGED = 32_768, 1 << 21, 64
#: Items of a skyband that are compared with each other.
BLOCK = 256
#: Bytes of a long text split at a time, bytes of texts counted together, and counts a task holds before it hands them on.
PIECE, TEXTS, HELD = 1 << 20, 4 << 20, 500_000

_KEEP = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> Counter:
    """Counts of a text's terms: runs of letters A-Z, lower-cased, and of characters from U+0080."""
    spaced, found, at = text.translate(_KEEP), Counter(), 0
    while at < len(spaced):
        end = spaced.find(b" ", at + PIECE)
        end = len(spaced) if end < 0 else end
        found.update(spaced[at:end].split())
        at = end
    return found


def _count_block(texts: pa.BinaryArray, group: np.ndarray) -> pa.Table:
    """group, term, n, docs of some whole texts; `group` has the number of each text's group."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = memoryview(texts.buffers()[2] or b"")[offsets[0] : offsets[-1]]
    # Letter for letter, so that every text stays where it is.
    spaced = pa.py_buffer(bytes(data).translate(_KEEP))
    spaced = pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets - offsets[0]), spaced)
    words = pc.ascii_split_whitespace(spaced)
    found = words.flatten().dictionary_encode()
    term, terms = found.indices.to_numpy().astype(np.int64), max(1, len(found.dictionary))
    text = np.repeat(np.arange(len(texts)), np.diff(words.offsets.to_numpy()))
    # Once by text, so that each counts once for its group.
    once, n = np.unique(text * terms + term, return_counts=True)
    key = group[once // terms] * terms + once % terms
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    columns = [
        pa.array(key[first] // terms, pa.int32()), found.dictionary.take(pa.array(key[first] % terms)),
        pa.array(np.add.reduceat(n, first) if len(first) else n, pa.int64()), pa.array(np.diff(np.append(first, len(key))), pa.int64()),
    ]
    # Spaces at the ends of a text leave an empty word.
    table = pa.table(columns, names=["group", "term", "n", "docs"])
    return table.filter(pc.not_equal(table.column("term"), ""))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number: dict[tuple[str, str], int] = {}
    held: list[pa.Table] = []
    size = 0

    def merged() -> pa.Table:
        added = pa.concat_tables(held).group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
        return added.select(["group", "term", "n_sum", "docs_sum"]).rename_columns(["group", "term", "n", "docs"])

    def rows(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for batch in table.combine_chunks().to_batches(max_chunksize=ROWS):
            names = [pa.array([g[i] for g in number], pa.string()).take(batch.column("group")) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*names, *batch.columns[1:]], names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
        group = np.fromiter((number.setdefault(g, len(number)) for g in groups), np.int64, batch.num_rows)
        lengths = pc.binary_length(batch.column("text")).to_numpy()
        block = np.cumsum(lengths, dtype=np.int64) // TEXTS
        cuts = [*(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for at, end in zip([0, *cuts], cuts, strict=False):
            some, own = batch.column("text").slice(at, end - at), group[at:end]
            long = lengths[at:end] > TEXTS
            for i in np.flatnonzero(long).tolist():
                terms = terms_of(some[i].as_buffer().to_pybytes())
                columns = [pa.array([own[i]] * len(terms), pa.int32()), pa.array(list(terms), pa.binary()).cast(pa.string()),
                           pa.array(terms.values(), pa.int64()), pa.array([1] * len(terms), pa.int64())]
                held.append(pa.table(columns, names=["group", "term", "n", "docs"]))
            if long.any():
                some, own = some.filter(pa.array(~long)), own[~long]
            if len(some):
                held.append(_count_block(some, own))
            size = sum(t.num_rows for t in held)
            if size > 2 * HELD:
                held = [merged()]
                if held[0].num_rows > HELD:
                    yield from rows(held.pop())
    if held:
        yield from rows(merged())


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that hold it), over whole texts. Null fields are ''.

    A task's rows are summed before they leave it, so they are dealt as they are; dealt by language and term, all sources of a term are together.
    """
    blank = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")
    counted = docs.select(*blank, text).mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return counted.repartition("term", "lang").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def skyband(more: np.ndarray, less: np.ndarray, name: np.ndarray, k: int) -> np.ndarray:
    """Which items fewer than `k` others dominate: with no smaller `more`, no larger `less` and a smaller `name`.

    In the order of (more down, less, name) an item comes after all that dominate it, and of these the first k
    are themselves kept, so it is enough to count among the kept.
    """
    order = np.lexsort((name, less, -more))
    less, name = _ranks(less)[order], _ranks(name)[order]
    kept = np.zeros(len(order), bool)
    for at in range(0, len(order), BLOCK):
        here = slice(at, min(at + BLOCK, len(order)))
        before = np.flatnonzero(kept[:at])
        count = np.zeros(here.stop - at, np.int64)
        for some in range(0, len(before), 4096):
            b = before[some : some + 4096, None]
            count += np.count_nonzero((less[b] <= less[here]) & (name[b] < name[here]), axis=0)
        # By rows: those inside the block that come before an item and dominate it if they are kept.
        inside = (less[here] <= less[here, None]) & (name[here] < name[here, None])
        inside &= np.tri(len(inside), k=-1, dtype=bool)
        sure = count + np.count_nonzero(inside, axis=1) < k
        kept[here] = sure
        for i in np.flatnonzero((count < k) & ~sure):
            # Whether those are kept is known when their turn has come.
            kept[at + i] = count[i] + np.count_nonzero(inside[i, :i] & kept[at : at + i]) < k
    found = np.zeros(len(order), bool)
    found[order] = kept
    return found


def _ranks(values: np.ndarray) -> np.ndarray:
    """Numbers in the same order, in the smallest type that holds them: comparing them is most of the work."""
    distinct, at = np.unique(values, return_inverse=True)
    return at.astype(np.min_scalar_type(max(1, len(distinct) - 1)))


def shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 5) / (total + 5 * terms)) of each count, in whole numbers of any size."""
    below = total + MORE * terms
    distinct, at = np.unique(counts, return_inverse=True)
    return np.array([1 + SCALE * (c + MORE) // below for c in distinct.tolist()], np.int64)[at]


PARTS = "lang string, source string, item string, value long, n long, lang_n long"
_SCHEMA = pa.schema(
    [
        ("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64()),
        ("n", pa.int64()), ("lang_n", pa.int64()),
    ]
)


def _bucket(counts: pa.Table, groups: pa.Table) -> pa.Table:
    """Sums of all pairs of sources over the bucket's terms (value), and each source's skyband (n, lang_n)."""
    groups = groups.sort_by("source")
    lang, sources = groups.column("lang")[0].as_py(), groups.column("source").to_pylist()
    totals, terms = groups.column("total").to_pylist(), groups.column("terms")[0].as_py()
    number = {s: i for i, s in enumerate(sources)}
    column = np.fromiter((number[s] for s in counts.column("source").to_pylist()), np.int64, counts.num_rows)
    # Names in the order of their UTF-8 bytes, which is not that of UTF-16 or of any locale.
    raw = counts.column("term").cast(pa.binary()).to_pylist()
    names = sorted(set(raw))
    place = {t: i for i, t in enumerate(names)}
    row = np.fromiter(map(place.__getitem__, raw), np.int64, len(raw))
    n = counts.column("n").to_numpy().astype(np.int64)
    lang_n = np.zeros(len(names), np.int64)
    np.add.at(lang_n, row, n)

    none = np.array([shares(np.zeros(1, np.int64), t, terms)[0] if terms else 0 for t in totals], np.int64)
    share = np.empty(len(n), np.int64)
    out = []
    for i in range(len(sources)):
        own = np.flatnonzero(column == i)
        if not len(own):
            continue
        share[own] = shares(n[own], totals[i], terms)
        held = own[skyband(n[own], lang_n[row[own]], row[own], TERMS)]
        out.append(
            pa.table(
                {"lang": [lang] * len(held), "source": [sources[i]] * len(held), "item": [names[r].decode() for r in row[held]],
                 "value": pa.nulls(len(held), pa.int64()), "n": n[held], "lang_n": lang_n[row[held]]}, schema=_SCHEMA,
            )
        )

    apart = np.zeros((len(sources), len(sources)), np.int64)
    order = np.argsort(row, kind="stable")
    width = max(1, CELLS // max(1, len(sources)))
    for first in range(0, len(names), width):
        here = order[np.searchsorted(row[order], first) : np.searchsorted(row[order], first + width)]
        dense = np.repeat(none[:, None], min(width, len(names) - first), axis=1)
        dense[column[here], row[here] - first] = share[here]
        for i in range(len(sources) - 1):
            apart[i, i + 1 :] += np.abs(dense[i + 1 :] - dense[i]).sum(axis=1)
    apart += apart.T
    for i, source in enumerate(sources):
        others = [j for j in range(len(sources)) if j != i]
        empty = pa.nulls(len(others), pa.int64())
        out.append(
            pa.table(
                {"lang": [lang] * len(others), "source": [source] * len(others), "item": [sources[j] for j in others],
                 "value": apart[i, others], "n": empty, "lang_n": empty}, schema=_SCHEMA,
            )
        )
    return pa.concat_tables(out)


def _merge_skybands(table: pa.Table) -> pa.Table:
    raw = table.column("item").cast(pa.binary()).to_pylist()
    place = {t: i for i, t in enumerate(sorted(raw))}
    names = np.fromiter(map(place.__getitem__, raw), np.int64, len(raw))
    kept = skyband(table.column("n").to_numpy(), table.column("lang_n").to_numpy(), names, TERMS)
    return table.filter(pa.array(kept))


def divergence(docs: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """lang, source, part, item, value, rank: how far each group of a language and source lies from the others, and in which terms.

    A term counts in a language if `documents` of the language's documents hold it. Part `pair` has each other source of the language with the
    summed distance of the shares of all counted terms; part `term` the 50 terms whose share lies furthest above the language's.
    Every group that occurs has its pairs, also without terms. Ranks go by value down, then by UTF-8.

    Null text, lang and source are ''. Equal rows and doc_ids each count. Extra columns are not used; an empty table gives no rows.

    A term of a group with a third of all occurrences is a row per task, or per HELD rows of one, before the shuffle. Buckets are hash classes of a
    language's terms and hold about ROWS rows each; a row per source of a language joins each.
    """
    # Rows are dealt by term already, and there are as many of a term as its language has sources.
    in_docs = F.sum("docs").over(Window.partitionBy("term", "lang"))
    counts = term_counts(docs).withColumn("in_docs", in_docs).filter(F.col("in_docs") >= documents)
    kept = stored(counts.drop("docs", "in_docs"), "kept-terms")
    # Sizes of languages and groups: rows as many as there are languages and groups.
    sizes = kept.groupBy("lang").agg(
        F.count("*").alias("rows"), F.count_distinct("term").alias("terms"), F.sum("n").alias("lang_total")
    )
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    groups = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").fillna(0, ["total", "rows", "terms", "lang_total"])
    groups = stored(groups.withColumn("buckets", F.ceil(F.greatest("rows", F.lit(1)) / ROWS).cast("long")), "groups")

    bucket = F.pmod(F.xxhash64("term"), F.col("buckets"))
    dealt = kept.join(groups.select("lang", "buckets").distinct(), "lang").withColumn("bucket", bucket)
    every = groups.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)))
    run = (
        dealt.select("lang", "bucket", "source", "term", "n").groupBy("lang", "bucket")
        .cogroup(every.select("lang", "bucket", "source", "total", "terms").groupBy("lang", "bucket"))
        .applyInArrow(lambda key, a, b: _add_bucket(key, _bucket(a, b)), f"bucket long, {PARTS}")
    )
    found = stored(run, "buckets")

    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = (
        found.filter("value is not null").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
        .withColumns({"part": F.lit("pair"), "rank": F.row_number().over(by_value)})
    )
    bands, most = found.filter("value is null"), groups.agg(F.max("buckets")).first()[0] or 1
    while most > 1:
        bands = bands.withColumn("bucket", F.floor(F.col("bucket") / MERGED))
        bands = stored(bands.groupBy("lang", "source", "bucket").applyInArrow(_merge_skybands, f"bucket long, {PARTS}"), "skybands")
        most = -(-most // MERGED)

    def share(count: str, total: str) -> str:
        # Decimals: a count times 10^9 does not fit into a long.
        return f"1 + cast({SCALE} as decimal(10)) * cast({count} + {MORE} as decimal(20)) div cast({total} + {MORE} * terms as decimal(20))"

    terms = (
        bands.drop("value").join(groups.select("lang", "source", "total", "terms", "lang_total"), ["lang", "source"])
        .withColumn("value", F.expr(f"({share('n', 'total')}) - ({share('lang_n', 'lang_total')})"))
        .filter("value > 0")
        .withColumns({"part": F.lit("term"), "rank": F.row_number().over(by_value)})
        .filter(F.col("rank") <= TERMS)
    )
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(columns).unionByName(terms.select(columns))


def _add_bucket(key: tuple, table: pa.Table) -> pa.Table:
    """The bucket's number beside its rows."""
    number = key[1].as_py() if isinstance(key[1], pa.Scalar) else key[1]
    return table.add_column(0, "bucket", pa.array([number] * table.num_rows, pa.int64()))
