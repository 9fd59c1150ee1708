"""Mixing sources to target weights by pivotal dependent rounding. Built-in functions only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from roadstrata.functions.keys import dense_key
from roadstrata.llm.common import content_key, repeated, stored, uniform, unused_name
from roadstrata.llm.sharding import stable_key

#: A source takes at most so many times its own words.
MOST = 3
#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
CONTENT = 3
#: Documents that meet in one node of the reduction tree, on average.
NODE = 64

#: What draws depend on: the same for the report and for the documents themselves.
DRAWN = ("doc_id", "source", "size", "content", "nth")

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, most: int = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, n, target) of rows (source, size, rows).

    All words are shared by weight. A target above `most` times its source's size stops there, and what
    it had above that is shared among the rest by weight, until none is above. Each
    round is one aggregate over the sources; the driver sees its totals only.
    """
    sources = sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.sum("rows").alias("n")
    )
    ranked = dense_key(sources.withColumn("last", F.col("source").isNull()), ["last", "source"], "place")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.element_at(cycle, (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    ranked = stored(ranked.select("source", "source_size", "n", weight.alias("weight")), "sources")
    cap = F.col("source_size") * float(most)
    level, total, none = 0.0, None, F.lit(0.0)
    while True:
        full = cap <= F.col("weight") * F.lit(level)
        row = ranked.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(full, cap).otherwise(none)).alias("capped"),
            F.sum(F.when(full, none).otherwise(F.col("weight"))).alias("open"),
        ).first()
        total = row["total"] or 0
        if not total or not row["open"]:
            break
        raised = (total - row["capped"]) / row["open"]
        if raised <= level * (1 + 1e-12):
            break
        level = raised
    target = F.least(cap, F.col("weight") * F.lit(level)) if total else none
    return ranked.select("source", "source_size", "n", target.alias("target"))


def rounded_copies(units: DataFrame, targets: DataFrame, seed: int = 17, drawn: Sequence[str] | None = None) -> DataFrame:
    """`units` (source, size and other columns; no two rows alike) with source_size, target and whole `copies`.

    A source's documents all get target / source_size copies. The whole part is certain. The rest is
    rounded by pivots: two documents of a source, with sizes a and b and shares p and q, shift
    mass, a * p + b * q staying the same, until one share is 0 or 1; the direction is drawn
    so that each share keeps its mean. A node of the tree folds about NODE documents
    to one that is still open, and the open ones meet in the nodes of the next level. The last one of a source goes to the
    nearer side, so a source misses its target by half of one document at most.

    Documents without words draw alone. All draws come from the columns `drawn` (default: all), which should tell rows apart: reruns agree.
    A node is a hash class of a source, so no source, however large, meets in one task before it is folded.
    """
    columns = units.columns
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = (
        units.withColumnRenamed("source", "own")
        .join(targets, F.col("own").eqNullSafe(F.col("source")))
        .drop("own")
        .withColumns({"rate": rate, "draw": F.xxhash64(F.lit(seed), stable_key(*[F.col(c) for c in drawn or columns]))})
        .withColumn("whole", F.floor(F.col("rate") + 1e-9))
        .withColumn("share", F.greatest(F.col("rate") - F.col("whole"), F.lit(0.0)))
        .withColumn("node", F.pmod(F.xxhash64(F.lit(seed + 1), "draw"), F.ceil(F.col("n") / NODE)))
    )
    joined = stored(joined, "shares")
    alone = (F.col("size") == 0) | (F.col("share") < 1e-9)
    bit = F.when(uniform(F.lit(seed + 2), F.col("draw")) < F.col("share"), 1).otherwise(0)
    done = [joined.filter(alone).withColumn("bit", bit)]
    most = joined.agg(F.max("n")).first()[0] or 0
    carried = [*columns, "source_size", "target", "whole"]
    open_ = joined.filter(~alone).select("source", "node", "draw", "size", "share", F.struct(*carried).alias("row"))
    levels = 1 + max(0, math.ceil(math.log(max(1, most / NODE), NODE)))
    for depth in range(levels):
        folded = stored(_fold(open_, seed + 10 + depth), f"level-{depth}")
        closed = folded.select(F.explode("closed").alias("c"))
        done.append(closed.select("c.row.*", F.col("c.bit").alias("bit")))
        open_ = folded.filter("open is not null").select(
            "source", F.floor(F.col("node") / NODE).alias("node"), "open.draw", "open.size", "open.share", "open.row"
        )
    last = open_.withColumn("bit", F.when(F.col("share") >= 0.5, 1).otherwise(0))
    done.append(last.select("row.*", "bit"))
    out = [*columns, "source_size", "target", (F.col("whole") + F.col("bit")).cast("int").alias("copies")]
    result = done[0].select(*out)
    for part in done[1:]:
        result = result.unionByName(part.select(*out))
    return result


def _fold(rows: DataFrame, seed: int) -> DataFrame:
    """(source, node, open, closed): each node's documents pivoted one after the other, longest first.

    A pivot can close a long document only by many short ones, so these come later, and what stays open is short.
    """
    item = "struct<less:bigint,draw:bigint,size:bigint,share:double,row:{row}>"
    row = rows.schema["row"].dataType.simpleString()
    item = item.format(row=row)
    items = F.sort_array(F.collect_list(F.struct((-F.col("size")).alias("less"), "draw", "size", "share", "row")))
    nodes = rows.groupBy("source", "node").agg(items.alias("items"))
    # x is the open document and y the next one. up: what x can gain, down: what it can lose.
    step = f"""
      aggregate(items,
        struct(cast(null as {item}) as open, cast(array() as array<struct<row:{row},bit:int>>) as closed),
        (acc, y) -> if(acc.open is null, struct(y as open, acc.closed as closed),
          element_at(transform(array(struct(
              acc.open as x,
              least(1 - acc.open.share, y.share * y.size / acc.open.size) as up,
              least(acc.open.share, (1 - y.share) * y.size / acc.open.size) as down,
              shiftrightunsigned(xxhash64({seed}, acc.open.draw, y.draw), 11) / {float(1 << 53)} as u)),
            s -> element_at(transform(array(
                if(s.u * (s.up + s.down) < s.down,
                   struct(s.x.share + s.up as p, y.share - s.up * s.x.size / y.size as q),
                   struct(s.x.share - s.down as p, y.share + s.down * s.x.size / y.size as q))),
              r -> if(least(r.p, 1 - r.p) <= least(r.q, 1 - r.q),
                struct(
                  if(least(r.q, 1 - r.q) < 1e-9, cast(null as {item}),
                     named_struct('less', y.less, 'draw', y.draw, 'size', y.size, 'share', r.q, 'row', y.row)) as open,
                  concat(acc.closed, array(struct(s.x.row as row, cast(round(r.p) as int) as bit)),
                    if(least(r.q, 1 - r.q) < 1e-9, array(struct(y.row as row, cast(round(r.q) as int) as bit)), array())) as closed),
                struct(
                  named_struct('less', s.x.less, 'draw', s.x.draw, 'size', s.x.size, 'share', r.p, 'row', s.x.row) as open,
                  concat(acc.closed, array(struct(y.row as row, cast(round(r.q) as int) as bit))) as closed))), 1)), 1)))
    """
    return nodes.select("source", "node", F.expr(step).alias("f")).select("source", "node", "f.open", "f.closed")


def mix_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    size is the number of words (null text: 0); taken is size times the whole copies taken, at most MOST. A null
    source is a source, after all others. A source without words has target 0. Rows alike in doc_id,
    source and size are counted before the shuffle and numbered, so many copies of a row are no hot
    key. Extra columns are not used; an empty table gives no rows.
    """
    units = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count().alias("size"),
            content_key(docs, CONTENT).alias("content"),
        )
        .groupBy("doc_id", "source", "size", "content")
        .agg(F.count("*").alias("rows"))
    )
    units = stored(units, "units")
    each = repeated(units, F.col("rows"), "nth").drop("rows")
    return rounded_copies(each, source_targets(units), drawn=DRAWN).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken")
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """`docs` with each row as often as the mix takes it; columns as in `docs`. Laws and draws as in mix_report().

    Equal rows are gathered and counted before anything is joined; their copies add up. Rows that differ in any
    column, a null in one place from a null in another too, are taken each for itself.
    """
    columns = docs.columns
    counted = unused_name(docs, "mix_rows")
    distinct = docs.groupBy(*columns).agg(F.count("*").alias(counted))
    # Stored with the number, so that it names one row for good.
    keyed = distinct.select(
        F.monotonically_increasing_id().alias("mix_id"), content_key(docs, CONTENT).alias("content"),
        F.struct(*columns).alias("mix_row"), F.col(counted).alias("mix_rows"),
    )
    keyed = stored(keyed, "rows")
    units = keyed.select(
        "mix_id", F.col("mix_row.doc_id").cast("long").alias("doc_id"), F.col("mix_row.source").cast("string").alias("source"),
        word_count("mix_row.text").alias("size"), "content", F.col("mix_rows").alias("rows"),
    )
    units = stored(units, "units")
    each = repeated(units, F.col("rows"), "nth").drop("rows")
    taken = rounded_copies(each, source_targets(units), drawn=DRAWN).groupBy("mix_id").agg(F.sum("copies").alias("copies")).filter("copies > 0")
    joined = keyed.select("mix_id", "mix_row").join(taken, "mix_id")
    return repeated(joined, F.col("copies"), "nth").select("mix_row.*")
