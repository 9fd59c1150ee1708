"""Near-duplicate vectors and nearest neighbours over small-world graphs, one per shard.

A shard holds some thousand distinct vectors; its graph is stored as one row of flat arrays. Every block of
queries meets every shard of its kind in a task of its own, and what the shards find is merged.
Rows of one vector are one node, so copies cost nothing and do not crowd out other neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from roadstrata.llm.common import stored
from roadstrata.llm.components import components, join_labels
from roadstrata.llm.hnsw import TOP, Graph

#: Distinct vectors of a shard, and queries of a block, on average.
SHARD, BLOCK = 16_384, 8_192
#: The same for searches. Small shards are built faster and need narrower beams; queries meet more of them.
SEARCH_SHARD, SEARCH_BLOCK = 8_192, 4_096
COSINE = 0.93
#: Beam to begin with; it is doubled until an audit passes.
BEAM = 64
#: Queries per task that an audit also compares with the whole shard, and the share of true results they must find.
AUDITED = 256
LINK_RECALL, SEARCH_RECALL = 0.999, 0.98
#: A beam of links is widened up to this part of its shard, or twice the first beam if that is more; a wider one costs more than a scan.
WIDEST = 128
#: Single-precision similarities below the limit by less than this are looked at again in double precision.
SLACK = 1e-4
NEAREST = 20
QUERY_STEP = 20


def usable(vector: Column) -> Column:
    """Whether a vector is there, has only finite components and one that is not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.chunk(0)
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows that agree in their first `keys` columns."""
    now, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = list(zip(*[batch.column(i).to_pylist() for i in range(keys)], strict=True))
        start = 0
        for i in range(1, len(values) + 1):
            if i == len(values) or values[i] != values[start]:
                if values[start] != now and held:
                    yield now, pa.Table.from_batches(held)
                    held = []
                now = values[start]
                held.append(batch.slice(start, i - start))
                start = i
    if held:
        yield now, pa.Table.from_batches(held)


# --- shards ---

SHARD_ROW = "nodes binary, weights binary, vectors binary, members binary, ends binary, places binary, links binary, sizes array<int>"


def entry_layer(n: int) -> int:
    """Nodes of the uppermost layer of a graph of n nodes at most: all are looked at to enter, so that a small family is not out of reach."""
    return min(4096, max(16, n // 4))


def _built(kinds: str, keys: int, unit, top):
    """mapInArrow function over rows (keys..., node, weight, members, vector) sorted by keys: a row of arrays per shard."""
    names = [part.split()[0] for part in kinds.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, table in _groups(batches, keys):
            vectors = _matrix(table.column("vector"), table.num_rows)
            graph = Graph.build(unit(vectors), top=top(len(vectors)))
            places, links, sizes = graph.arrays()
            members = table.column("members").combine_chunks()
            sizes_of = np.diff(members.offsets.to_numpy()) if isinstance(members, pa.ListArray) else np.array([len(x) for x in members.to_pylist()])
            flat = np.array([i for x in members.to_pylist() for i in x], np.int64)
            row = {
                "nodes": table.column("node").to_numpy().astype(np.int64).tobytes(),
                "weights": table.column("weight").to_numpy().astype(np.int64).tobytes(),
                "vectors": vectors.tobytes(),
                "members": flat.tobytes(),
                "ends": np.cumsum(sizes_of).astype(np.int64).tobytes(),
                "places": places,
                "links": links,
                "sizes": sizes,
            }
            columns = {n: pa.array([k], table.schema.field(i).type) for i, (n, k) in enumerate(zip(names, key, strict=True))}
            columns |= {n: pa.array([v], pa.list_(pa.int32()) if n == "sizes" else pa.binary()) for n, v in row.items()}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def build_shards(placed: DataFrame, kind: list[str], unit, top=lambda n: TOP) -> DataFrame:
    """One row per shard of `placed` (columns `kind`, shard, node, weight, members, vector)."""
    keys = [*kind, "shard"]
    types = dict(placed.dtypes)
    head = ", ".join(f"{k} {types[k]}" for k in keys)
    dealt = placed.select(*keys, "node", "weight", "members", "vector").repartition(*keys).sortWithinPartitions(*keys, "node")
    return dealt.mapInArrow(_built(head, len(keys), unit, top), f"{head}, {SHARD_ROW}")


class Shard:
    """A shard's arrays, read from its row."""

    def __init__(self, table: pa.Table, unit):
        row = table.slice(0, 1).to_pylist()[0]
        self.nodes = np.frombuffer(row["nodes"], np.int64)
        self.weights = np.frombuffer(row["weights"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], np.float64).reshape(len(self.nodes), -1)
        self.members = np.frombuffer(row["members"], np.int64)
        self.ends = np.frombuffer(row["ends"], np.int64)
        self.unit = unit(self.vectors)
        self.graph = Graph.stored(self.unit, row["places"], row["links"], row["sizes"])

    def places(self, nodes: np.ndarray) -> np.ndarray:
        """Where the nodes stand in the graph, -1 for those of other shards."""
        order = np.argsort(self.nodes)
        at = order[np.minimum(np.searchsorted(self.nodes, nodes, sorter=order), len(order) - 1)]
        back = np.empty(len(order), np.int64)
        back[self.graph.order] = np.arange(len(order))
        return np.where(self.nodes[at] == nodes, back[at], -1)

    def search(self, queries: np.ndarray, width: int, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """As Graph.search(), with places in the shard's own order in the result."""
        ids, sims = self.graph.search(queries.astype(np.float32), width, own)
        return np.where(ids < 0, -1, self.graph.order[np.maximum(ids, 0)]), sims


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)


def lifted_vectors(vectors: np.ndarray) -> np.ndarray:
    """Vectors over the longest of them, with one more component that makes each of length 1.

    Nearness to a query without that component is then the inner product.
    """
    scaled = vectors / np.linalg.norm(vectors, axis=1).max()
    rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("nd,nd->n", scaled, scaled)))
    return np.concatenate([scaled, rest[:, None]], 1).astype(np.float32)


def norm_band(vector: Column) -> Column:
    """Vectors of a band differ in length by less than a factor of 16; length 1 is in the middle of band 0."""
    squares = F.aggregate(vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return F.floor(F.log2(F.sqrt(squares)) / 4 + 0.5).cast("int")


def _evenly(n: int, wanted: int) -> np.ndarray:
    return np.unique(np.linspace(0, n - 1, min(n, wanted)).astype(np.int64)) if n else np.empty(0, np.int64)


# --- near duplicates ---


def found_links(shard: Shard, nodes: np.ndarray, queries: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, place) of pairs at `cosine` or above, verified in double precision; a vector finds itself too.

    `nodes` names the queries: in its own shard a query also enters the graph at its own place. A query is searched again with a beam twice as wide while its
    whole beam lies above the limit. Then queries that found most, queries spread evenly and queries that found no other are compared with the
    whole shard; in each of these groups the mean share of a query's links to others that it found must be LINK_RECALL. If it is not, all
    queries like those that missed some, with links or without, are searched again with beams twice as wide; what was found before is kept, and other
    queries are audited. Beams wider than a part of the shard (WIDEST) give way to a scan of it.
    """
    units, places = unit_vectors(queries), shard.places(nodes)
    lengths, own = np.linalg.norm(shard.vectors, axis=1), np.linalg.norm(queries, axis=1)
    n = len(shard.nodes)
    widest = max(2 * BEAM, n // WIDEST)
    exact = np.zeros(len(queries), bool)

    def verified(q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The pairs, as one number each."""
        good = []
        for i in range(0, len(q), 1 << 16):
            a, b = q[i : i + (1 << 16)], at[i : i + (1 << 16)]
            cos = np.einsum("nd,nd->n", queries[a], shard.vectors[b]) / (own[a] * lengths[b])
            good.append(cos >= cosine)
        keep = np.concatenate(good) if good else np.empty(0, bool)
        return q[keep].astype(np.int64) * n + at[keep]

    def scanned(some: np.ndarray) -> np.ndarray:
        parts = [np.empty((0, 2), np.int64)]
        for i in range(0, len(some), 512):
            near = np.argwhere(units[some[i : i + 512]] @ shard.unit.T >= cosine - SLACK)
            near[:, 0] = some[i + near[:, 0]]
            parts.append(near)
        exact[some] = True
        both = np.concatenate(parts)
        return verified(both[:, 0], both[:, 1])

    def searched(todo: np.ndarray, width: int) -> np.ndarray:
        pairs = [np.empty(0, np.int64)]
        while len(todo):
            if width > widest or width >= n:
                pairs.append(scanned(todo))
                break
            at, sims = shard.search(units[todo], width, places[todo])
            near = (sims >= cosine - SLACK) & (at >= 0)
            row, column = np.nonzero(near)
            pairs.append(verified(todo[row], at[row, column]))
            todo, width = todo[near[:, -1]], width * 2
        return np.concatenate(pairs)

    def others(pairs: np.ndarray) -> np.ndarray:
        """How many other vectors each query is paired with."""
        return np.bincount(pairs // n, minlength=len(queries)) - (places >= 0)

    width = {"linked": BEAM, "alone": BEAM}
    pairs = np.unique(searched(np.arange(len(queries)), BEAM))
    while not exact.all():
        counts = others(pairs)
        kinds = {"linked": np.flatnonzero(~exact & (counts > 0)), "alone": np.flatnonzero(~exact & (counts <= 0))}
        rest = np.flatnonzero(~exact)
        groups = [
            kinds["linked"][np.argsort(-counts[kinds["linked"]], kind="stable")[: AUDITED // 2]],
            rest[_evenly(len(rest), AUDITED // 2)],
            kinds["alone"][_evenly(len(kinds["alone"]), AUDITED // 4)],
        ]
        audited = scanned(np.unique(np.concatenate(groups)))
        true = others(audited)
        linked = [g[true[g] > 0] for g in groups]
        failed = [g for g in linked if len(g) and (counts[g] / true[g]).mean() < LINK_RECALL]
        pairs = np.union1d(pairs, audited)
        if not failed:
            break
        missing = np.unique(np.concatenate(failed))
        missing = missing[counts[missing] < true[missing]]
        for kind, some in kinds.items():
            if np.isin(missing, some).any():
                width[kind] *= 2
                pairs = np.union1d(pairs, searched(some[~exact[some]], width[kind]))
    return pairs // n, pairs % n


def near_vectors(vectors: DataFrame, cosine: float = COSINE, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    `vectors`: vec_id, embedding, label. Vectors of equal label (and as many components) link at a double
    precision cosine of at least `cosine`; n_links counts the other rows linked directly, copies included. A null
    label, or a vector that is null, zero, or has null or non-finite components, links with nothing.
    component_id is the smallest vec_id reachable, and the row of that id is kept. Extra columns are not
    used; equal rows each give their row and link with each other.

    Every vector queries every shard of its label. A label with a third of all rows is just more shards and more
    blocks. Within a task links become counts and a forest: a family of near copies never
    appears as all its pairs.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").alias("vector"))
    good = rows.filter(F.col("label").isNotNull() & usable(F.col("vector")))
    nodes = (
        good.groupBy("label", "vector")
        .agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
        .withColumns({"node": F.monotonically_increasing_id(), "dim": F.size("vector")})
    )
    nodes = stored(nodes, "nodes")
    kind = ["label", "dim"]
    sizes = nodes.groupBy(*kind).agg(
        F.ceil(F.count("*") / shard).cast("int").alias("shards"), F.ceil(F.count("*") / block).cast("int").alias("blocks")
    )
    placed = nodes.join(sizes, kind).withColumns(
        {
            "shard": F.pmod(F.xxhash64(F.lit(1), "node"), F.col("shards")).cast("int"),
            "block": F.pmod(F.xxhash64(F.lit(2), "node"), F.col("blocks")).cast("int"),
            "members": F.array("node"),
        }
    )
    placed = stored(placed, "placed")
    shards = stored(build_shards(placed, kind, unit_vectors, entry_layer), "shards").join(sizes, kind)
    shards = shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    queries = placed.select(*kind, "block", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "node", "vector")

    def link(index: pa.Table, asked: pa.Table) -> pa.Table:
        u, v, links = [np.empty(0, np.int64)] * 3
        if index.num_rows and asked.num_rows:
            held = Shard(index, unit_vectors)
            own = asked.column("node").to_numpy().astype(np.int64)
            q, at = found_links(held, own, _matrix(asked.column("vector"), asked.num_rows), cosine)
            other = own[q] != held.nodes[at]
            q, at = q[other], at[other]
            everyone, places = np.unique(np.concatenate([own, held.nodes]), return_inverse=True)
            labels = np.arange(len(everyone))
            join_labels(labels, places[: len(own)][q], places[len(own) :][at])
            count = np.zeros(len(everyone), np.int64)
            np.add.at(count, places[: len(own)][q], held.weights[at])
            some = (count > 0) | (labels != np.arange(len(everyone)))
            u, v, links = everyone[some], everyone[labels[some]], count[some]
        return pa.table({"u": pa.array(u), "v": pa.array(v), "links": pa.array(links)})

    cell = [*kind, "shard", "block"]
    found = shards.drop("shards", "blocks").groupBy(*cell).cogroup(queries.groupBy(*cell))
    found = stored(found.applyInArrow(link, "u long, v long, links long"), "links")
    counts = found.groupBy("u").agg(F.sum("links").alias("links"))
    roots = components(found.select("u", "v"))
    marked = (
        nodes.join(counts, F.col("node") == counts["u"], "left").drop("u")
        .join(roots, F.col("node") == roots["u"], "left").drop("u")
        .withColumn("root", F.coalesce("root", "node"))
    )
    marked = stored(marked, "marked")
    names = marked.groupBy("root").agg(F.min("least").alias("component_id"))
    total = F.coalesce("links", F.lit(0)) + F.col("weight") - 1
    result = marked.join(names, "root").select("label", "vector", total.alias("n_links"), "component_id")
    joined = rows.join(result, ["label", "vector"], "left").withColumns(
        {"n_links": F.coalesce("n_links", F.lit(0)).cast("long"), "component_id": F.coalesce("component_id", "vec_id")}
    )
    return joined.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


# --- nearest neighbours ---


def _dots(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed from the first component to the last."""
    total = np.zeros(vectors.shape[:2])
    for d in range(queries.shape[1]):
        total += queries[:, d, None] * vectors[:, :, d]
    return total


def nearest_in_shard(shard: Shard, ids: np.ndarray, queries: np.ndarray, k: int):
    """(query id, vec_id, score) of each query's k best rows in the shard.

    The beam is doubled until queries spread evenly find SEARCH_RECALL of what a scan of the shard finds.
    """
    n, want = len(shard.nodes), min(len(shard.nodes), k + 1)
    asked = np.concatenate([unit_vectors(queries), np.zeros((len(queries), 1), np.float32)], 1)
    audit = _evenly(len(queries), AUDITED)
    width = min(n, max(2 * BEAM, 2 * want))
    while True:
        at, sims = shard.search(asked, width)
        if width >= n or not shard.graph.layers:
            break
        true = asked[audit] @ shard.unit.T
        limit = -np.partition(-true, want - 1, axis=1)[:, want - 1]
        # The scan's own similarities of what was found, so that no tolerance is needed.
        found = ((np.take_along_axis(true, np.maximum(at[audit], 0), 1) >= limit[:, None]) & (at[audit] >= 0)).sum(axis=1)
        if np.minimum(found, want).sum() >= SEARCH_RECALL * want * len(audit):
            break
        width = min(n, 2 * width)
    if width >= n and shard.graph.layers:  # the beam holds all: look at all
        sims = asked @ shard.unit.T
        at = np.argsort(-sims, axis=1, kind="stable")
    at = at[:, : min(at.shape[1], 2 * want + 8)]
    starts = shard.ends - np.diff(np.concatenate([[0], shard.ends]))
    out = []
    for i in range(0, len(queries), 1024):
        some = at[i : i + 1024]
        scores = _dots(queries[i : i + 1024], shard.vectors[np.maximum(some, 0)])
        row, column = np.nonzero(some >= 0)
        node, score = some[row, column], scores[row, column]
        size = shard.ends[node] - starts[node]
        ends = np.cumsum(size)
        member = shard.members[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[node] - (ends - size), size)]
        row, score = np.repeat(row, size), np.repeat(score, size)
        other = member != ids[i : i + 1024][row]
        row, member, score = row[other], member[other], score[other]
        order = np.lexsort((member, -score, row))
        row, member, score = row[order], member[order], score[order]
        first = np.searchsorted(row, row, "left")
        best = np.arange(len(row)) - first < k
        out.append((ids[i : i + 1024][row[best]], member[best], score[best]))
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def nearest_vectors(vectors: DataFrame, k: int = NEAREST, step: int = QUERY_STEP, shard: int = SEARCH_SHARD, block: int = SEARCH_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows, by inner product, of each row whose vec_id is divisible by `step`.

    Candidates are all rows but those of the query's own id; ties go to the smaller vec_id; with fewer candidates, all.
    score is the inner product of the original vectors in double precision. Vectors that are null, zero, or have null or
    non-finite components take no part, nor do null ids; vectors meet those with as many components. Rows of equal
    id and vector are one. Extra columns are not used.

    Every query meets every shard. A shard holds vectors of like length, as it scales them by the longest. Of rows with the same vector the k + 1 smallest ids are kept with their
    node: no result needs more of them.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    nodes = (
        rows.withColumn("rank", rank).filter(F.col("rank") <= k + 1)
        .groupBy("vector").agg(F.sort_array(F.collect_set("vec_id")).alias("members"))
        .withColumns({"node": F.monotonically_increasing_id(), "dim": F.size("vector"), "band": norm_band(F.col("vector")), "weight": F.lit(1).cast("long")})
    )
    nodes = stored(nodes, "nodes")
    kind = ["dim", "band"]
    shards_of = nodes.groupBy(*kind).agg(F.ceil(F.count("*") / shard).cast("int").alias("shards"))
    placed = nodes.join(shards_of, kind).withColumn("shard", F.pmod(F.xxhash64(F.lit(1), "node"), F.col("shards")).cast("int"))
    index = stored(build_shards(placed, kind, lifted_vectors), "shards")
    asked = rows.filter(F.col("vec_id") % step == 0).distinct().withColumn("dim", F.size("vector"))
    blocks = asked.groupBy("dim").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    queries = (
        asked.join(blocks, "dim").join(shards_of, "dim")
        .withColumn("block", F.pmod(F.xxhash64(F.lit(2), "vec_id"), F.col("blocks")).cast("int"))
        .select(*kind, "block", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "vec_id", "vector")
    )
    index = index.join(blocks, "dim").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")

    def search(held: pa.Table, asked: pa.Table) -> pa.Table:
        found = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        if held.num_rows and asked.num_rows:
            ids = asked.column("vec_id").to_numpy().astype(np.int64)
            found = nearest_in_shard(Shard(held, lifted_vectors), ids, _matrix(asked.column("vector"), asked.num_rows), k)
        return pa.table({"query_id": pa.array(found[0]), "vec_id": pa.array(found[1]), "score": pa.array(found[2])})

    cell = [*kind, "shard", "block"]
    found = index.groupBy(*cell).cogroup(queries.groupBy(*cell)).applyInArrow(search, "query_id long, vec_id long, score double")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", best.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
