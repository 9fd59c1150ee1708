"""A Merkle manifest of a dataset as a postorder append log.

The leaves of a language, in order, are cut into aligned runs of FAN ** HEIGHT. A builder per run hashes its subtree and writes the nodes
in the order in which they are complete, one segment of the log. The roots of the segments are the leaves of the next log, and so on
until a language has one node; the languages' nodes are the leaves of the last tree. Where a node stands in its segment follows from
the sizes of the subtrees before it alone, so a proof is read from a segment without searching it.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from roadstrata.llm.common import stored
from roadstrata.workspace import discard, materialize_at, scratch_path, session_setting, shuffle_width

#: Children of a node, and levels of a builder's subtree above its leaves.
FAN, HEIGHT = 8, 3
#: One in so many documents, by the checksum of its id, is tampered with in the report.
TAMPERED = 3


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """The digest of a row: hex SHA-256 of its fields, each `-` if null, else its UTF-8 length, a colon and itself."""
    return F.sha2(F.concat(*[_field(c) for c in (doc_id, source, lang, n_chars, text)]), 256)


def digest(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def post(last: int, level: int) -> int:
    """Where in the log a node stands whose last leaf is number `last`: after the leaves up to that and the nodes they completed."""
    total = level
    while last:
        total += last
        last //= FAN
    return total


def shape(leaves: int, levels: int) -> list[int]:
    """Nodes on each level, the leaves' first."""
    return [max(1, -(-leaves // FAN**k)) for k in range(levels + 1)]


def levels_for(leaves: int) -> int:
    """Levels above the leaves until one node is left."""
    levels = 0
    while FAN**levels < leaves:
        levels += 1
    return levels


def build(leaves: list[str], levels: int) -> bytes:
    """The nodes over `leaves` in the order of their completion, 32 bytes each."""
    log, open_runs = bytearray(), [[] for _ in range(levels + 1)]

    def close(node: str, level: int, end: bool) -> None:
        while True:
            log.extend(bytes.fromhex(node))
            if level == levels:
                return
            open_runs[level].append(node)
            if len(open_runs[level]) < FAN and not end:
                return
            node = digest(open_runs[level])
            open_runs[level].clear()
            level += 1

    for i, node in enumerate(leaves):
        close(node, 0, i == len(leaves) - 1)
    return bytes(log)


class Segment:
    """One builder's stretch of the log, read by position."""

    def __init__(self, log: bytes, leaves: int, levels: int):
        self.log, self.leaves, self.levels = log, leaves, levels
        self.counts = shape(leaves, levels)

    def node(self, level: int, index: int) -> str:
        at = 32 * post(min((index + 1) * FAN**level, self.leaves) - 1, level)
        return self.log[at : at + 32].hex()

    def path(self, index: int) -> list[tuple[list[str], list[str]]]:
        """Per level, the nodes before and after the leaf's own in its run."""
        found = []
        for level in range(self.levels):
            first = index - index % FAN
            end = min(first + FAN, self.counts[level])
            found.append(([self.node(level, i) for i in range(first, index)], [self.node(level, i) for i in range(index + 1, end)]))
            index //= FAN
        return found


def fold(node: str, path: list[tuple[list[str], list[str]]]) -> str:
    """The root that follows from a leaf and its siblings."""
    for before, after in path:
        node = digest([*before, node, *after])
    return node


def _as_pairs(path: list[dict]) -> list[tuple[list[str], list[str]]]:
    return [(p["before"], p["after"]) for p in path]


PATH = "array<struct<before:array<string>,after:array<string>>>"
_PATH = pa.list_(pa.struct([("before", pa.list_(pa.string())), ("after", pa.list_(pa.string()))]))


def numbered(rows: DataFrame, tree: str, order: list[str], label: str) -> DataFrame:
    """`rows`, stored, with `at`, their number within `tree` by `order` from 0, and `leaves`, how many the tree has.

    Rows are dealt by ranges of (tree, order, row): also rows alike in all columns go to several tasks. A task
    numbers its own; cells of (task, tree) are shifted by the sizes of those before, a row per cell. Nulls are first.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    rows = materialize_at(rows, path).withColumn("_row", F.monotonically_increasing_id())
    keys = [tree, *order, "_row"]
    width = shuffle_width(spark, path, bytes_per_task=16 << 20)
    ranged = stored(
        rows.repartitionByRange(width, *keys)
        .sortWithinPartitions(*keys)
        .drop("_row")
        .withColumns({"_task": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}),
        f"{label}-ranged",
    )
    discard(spark, path)
    cells = ranged.groupBy(tree, "_task").agg(F.count("*").alias("_n"), F.min("_place").alias("_least"))
    same = Window.partitionBy(tree)
    before = same.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        F.col(tree).alias("_tree"), F.col("_task").alias("_cell"), "_least",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(same).alias("leaves"),
    )
    return (
        ranged.join(cells, F.col(tree).eqNullSafe(F.col("_tree")) & (F.col("_task") == F.col("_cell")))
        .withColumn("at", F.col("_before") + F.col("_place") - F.col("_least"))
        .drop("_tree", "_task", "_place", "_cell", "_least", "_before")
    )


LOG = "tree string, step int, segment long, leaves long, levels int, of long, root string, log binary"


def append_log(leaves: DataFrame, height: int = HEIGHT, label: str = "log") -> list[DataFrame]:
    """The segments of every tree, a stored table per step, the lowest first.

    `leaves` has tree, at, leaves (of the tree) and node. A segment holds FAN ** `height` leaves at most: tree, step, segment,
    leaves, levels, of (segments of its tree on this step), root, log. A tree that is one segment has only the levels it needs.
    """
    width = FAN**height

    def builder(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        nodes = table.column("node").to_pylist()
        first, total = table.column("at")[0].as_py(), table.column("leaves")[0].as_py()
        levels = height if total > width else levels_for(total)
        log = build(nodes, levels)
        row = {
            "tree": table.column("tree")[0].as_py(), "step": table.column("step")[0].as_py(), "segment": first // width,
            "leaves": len(nodes), "levels": levels, "of": -(-total // width), "root": log[-32:].hex(), "log": log,
        }
        return pa.Table.from_pylist([row], schema=pa.schema(
            [("tree", pa.string()), ("step", pa.int32()), ("segment", pa.int64()), ("leaves", pa.int64()),
             ("levels", pa.int32()), ("of", pa.int64()), ("root", pa.string()), ("log", pa.binary())]
        ))

    steps: list[DataFrame] = []
    while True:
        rows = leaves.select("tree", "at", "leaves", "node").withColumn("step", F.lit(len(steps)))
        built = rows.groupBy("tree", F.floor(F.col("at") / width).alias("segment")).applyInArrow(builder, LOG)
        steps.append(stored(built, f"{label}-{len(steps)}"))
        going = steps[-1].filter("of > 1")
        if going.isEmpty():
            return steps
        leaves = going.select("tree", F.col("segment").alias("at"), F.col("of").alias("leaves"), F.col("root").alias("node"))


def _same_segment(known: DataFrame) -> tuple[DataFrame, Column]:
    named = known.withColumnsRenamed({"tree": "_tree", "segment": "_segment"})
    return named, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("segment") == F.col("_segment"))


def _with_paths(step: DataFrame, known: DataFrame) -> DataFrame:
    joined = step.drop("root").join(*_same_segment(known))
    return joined.select("tree", "segment", "leaves", "levels", "log", "subroot", "root", "path")


def _hand_down(step: DataFrame, known: DataFrame, height: int) -> DataFrame:
    """The paths of all leaves of a step's segments, from those of the segments: tree, segment (the leaf's number), subroot, root, path."""
    width = FAN**height
    schema = pa.schema(
        [("tree", pa.string()), ("segment", pa.int64()), ("subroot", pa.string()), ("root", pa.string()), ("path", _PATH)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                own, rows = Segment(r["log"], r["leaves"], r["levels"]), []
                for i in range(r["leaves"]):
                    path = [{"before": b, "after": a} for b, a in own.path(i)] + r["path"]
                    rows.append({"tree": r["tree"], "segment": r["segment"] * width + i, "subroot": r["subroot"], "root": r["root"], "path": path})
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    handed = _with_paths(step, known).mapInArrow(run, f"tree string, segment long, subroot string, root string, path {PATH}")
    with session_setting(step.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", "500"):
        return stored(handed, "paths")


def _segment_paths(steps: list[DataFrame], top: DataFrame, height: int) -> DataFrame:
    """Per segment of the lowest step, its siblings from its own root to the root of all: tree, segment, subroot, root, path.

    `top` has these (tree as top_tree) of each tree's last node. Each step hands its segments' paths to the segments that are its leaves.
    """
    known = None
    for step in reversed(steps):
        if known is not None:
            known = _hand_down(before, known, height)
        last = step.filter("of = 1").select("tree", "segment").join(top, F.col("tree").eqNullSafe(F.col("top_tree")))
        last = last.select("tree", "segment", "subroot", "root", "path")
        known = last if known is None else known.unionByName(last)
        before = step
    return known


def leaves_of(docs: DataFrame) -> DataFrame:
    """doc_id, tree (the language), node (the row's leaf) and tampered (the leaf with its text in lower case, where that is done)."""
    doc_id, n_chars = F.col("doc_id").cast("long"), F.col("n_chars").cast("long")
    source, lang, text = (F.col(c).cast("string") for c in ("source", "lang", "text"))
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    changed = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(TAMPERED)) == 0
    return docs.select(
        doc_id.alias("doc_id"), lang.alias("tree"), leaf(doc_id, source, lang, n_chars, text).alias("node"),
        F.when(changed, leaf(doc_id, source, lang, n_chars, lowered)).alias("tampered"),
    )


def manifest(docs: DataFrame, height: int = HEIGHT) -> tuple[DataFrame, list[DataFrame], DataFrame, list[DataFrame]]:
    """(leaves with their places, the languages' logs by step, the languages with theirs, the log over the languages by step)."""
    leaves = numbered(leaves_of(docs), "tree", ["doc_id", "node"], "leaves")
    steps = append_log(leaves, height)
    ends = [step.filter("of = 1").select(F.lit(0).alias("all"), F.col("tree").alias("lang"), F.col("root").alias("node")) for step in steps]
    langs = stored(numbered(reduce(DataFrame.unionByName, ends), "all", ["lang"], "subroots"), "languages")
    return leaves, steps, langs, append_log(langs.withColumn("tree", F.lit(None).cast("string")), height, "top")


def manifest_report(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, tampered, log_place.

    The leaf is the digest of the row as it is. proof_sha256 digests the leaf's siblings level by level up to the root, left to
    right. folded_root follows from these siblings and the leaf, or, for one document in three by the checksum of
    its id, the leaf of its text in lower case (`tampered`; a null text stays null); verified says whether it is the root. log_place is the leaf's
    place in its language's log, were that one file.

    Null fields count as nulls; null languages are a tree of their own, the first. Rows of equal doc_id lie by their leaf, rows alike
    in any order. A null doc_id has no checksum and is not tampered with. Extra columns are not used; an empty table gives no rows.
    """
    width = FAN**height
    leaves, steps, langs, over = manifest(docs, height)
    end = over[-1].select(F.lit(None).cast("string").alias("top_tree"), F.col("root").alias("subroot"), "root")
    end = end.withColumn("path", F.expr(f"cast(array() as {PATH})"))
    of_langs = _hand_down(over[0], _segment_paths(over, end, height), height).select(F.col("segment").alias("at"), "root", "path")
    top = langs.select("at", F.col("lang").alias("top_tree"), F.col("node").alias("subroot")).join(of_langs, "at")
    segments = _with_paths(steps[0], _segment_paths(steps, top, height))
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
            ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_()), ("tampered", pa.bool_()),
            ("log_place", pa.int64()),
        ]
    )

    def prove(own: pa.Table, log: pa.Table) -> pa.Table:
        r, out = log.to_pylist()[0], []
        segment, above = Segment(r["log"], r["leaves"], r["levels"]), _as_pairs(r["path"])
        for row in own.to_pylist():
            path = [*segment.path(row["at"] % width), *above]
            found = fold(row["tampered"] or row["node"], path)
            out.append(
                {"doc_id": row["doc_id"], "leaf": row["node"], "subroot": r["subroot"], "root": r["root"],
                 "proof_sha256": digest([n for before, after in path for n in (*before, *after)]), "folded_root": found,
                 "verified": found == r["root"], "tampered": row["tampered"] is not None, "log_place": post(row["at"], 0)}
            )
        return pa.Table.from_pylist(out, schema=schema)

    segment = F.floor(F.col("at") / width).alias("segment")
    return (
        leaves.select("tree", segment, "at", "doc_id", "node", "tampered")
        .groupBy("tree", "segment")
        .cogroup(segments.groupBy("tree", "segment"))
        .applyInArrow(
            prove,
            "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
            "verified boolean, tampered boolean, log_place long",
        )
    )
