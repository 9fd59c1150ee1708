"""Vector operators against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadstrata.llm import vectors
from roadstrata.llm.components import components
from roadstrata.llm.hnsw import Graph
from roadstrata.llm.oracles import ORACLES
from roadstrata.llm.queries import QUERIES
from tests.compare import connect, difference

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int"


def clustered(n, dim=16, seed=7, copies=60):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for i in range(0, n, 10):
        x[i + 1 : i + 4] = x[i] + 0.15 * rng.normal(size=x[i + 1 : i + 4].shape)
    x[:copies] = x[0]
    x[copies : 2 * copies] = x[copies] + 0.02 * rng.normal(size=(copies, dim))
    return x.astype(np.float32)


def awkward(spark):
    x = clustered(1500)
    rows = [(i, v.tolist(), i % 3 if i % 7 else None) for i, v in enumerate(x)]
    base = x[5].tolist()
    rows += [
        (9000, None, 1), (9001, [], 1), (9002, [0.0] * 16, 1), (9003, [*base[:15], NAN], 1), (9004, [*base[:15], INF], 1),
        (9005, [*base[:15], None], 1), (9006, base, None), (9020, base[:8], 1), (9040, base[:8], 1), (None, base, 1),
        (9060, [-0.0, *base[1:]], 2), (5, base, 2), (5, base, 2),
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return df.withColumns({c: F.lit("own") for c in ("node", "dim", "shard", "block", "vector", "root", "u", "links", "least", "rank")}), rows


def good(v):
    return bool(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)


def brute_links(rows):
    n = len(rows)
    counts, label = np.zeros(n, int), np.arange(n)
    keys = {}
    for i, (_, v, kind) in enumerate(rows):
        if good(v) and kind is not None:
            keys.setdefault((kind, len(v)), []).append(i)
    for group in keys.values():
        x = np.array([rows[i][1] for i in group], np.float32).astype(float)
        x /= np.linalg.norm(x, axis=1)[:, None]
        for a, b in np.argwhere(np.triu(x @ x.T >= 0.93, 1)):
            i, j = group[a], group[b]
            counts[i] += 1
            counts[j] += 1
            low, high = sorted((label[i], label[j]))
            label[label == high] = low
    least = {}
    for i, (vec, *_) in enumerate(rows):
        if vec is not None:
            least[label[i]] = min(vec, least.get(label[i], vec))
    return [(rows[i][0], int(counts[i]), least.get(label[i]) if (label == label[i]).sum() > 1 else rows[i][0]) for i in range(n)]


@pytest.mark.parametrize("small", [False, True])
def test_near_vectors(spark, small):
    df, rows = awkward(spark)
    sizes = {"shard": 200, "block": 90} if small else {}
    got = vectors.near_vectors(df, **sizes).collect()
    assert sorted(map(str, ((r.vec_id, r.n_links, r.component_id) for r in got))) == sorted(map(str, brute_links(rows)))
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


@pytest.mark.parametrize("small", [False, True])
def test_nearest_vectors(spark, small):
    df, rows = awkward(spark)
    sizes = {"shard": 200, "block": 20} if small else {}
    got = {}
    for r in vectors.nearest_vectors(df, **sizes).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    usable = {(i, tuple(v)) for i, v, _ in rows if i is not None and good(v)}
    want = {}
    for i, q in usable:
        if i % 20 == 0:
            found = [(-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in usable if j != i and len(v) == len(q)]
            want[i] = [(n + 1, j, -s) for n, (s, j) in enumerate(sorted(found)[:20])]
    assert set(got) == {k for k, v in want.items() if v}
    hits = tried = 0
    for i, found in got.items():
        found.sort()
        assert [n for n, *_ in found] == [n for n, *_ in want[i]]
        score = {j: sum(a * b for a, b in zip(q, v, strict=True)) for k, q in usable if k == i for j, v in usable if len(v) == len(q)}
        assert np.allclose([s for *_, s in found], [score[j] for _, j, _ in found], rtol=1e-12)
        assert [(-s, j) for _, j, s in found] == sorted((-s, j) for _, j, s in found)
        tried += len(found)
        hits += len({j for _, j, _ in found} & {j for _, j, _ in want[i]})
    # Shards of one scanned layer are exact; a graph finds what the audit asks for at least.
    assert hits == tried if small else hits >= 0.97 * tried


def test_one_long_vector_hides_no_neighbours(spark):
    x = clustered(3000)
    x[17] *= 1e8
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], SCHEMA).repartition(4)
    got = {}
    for r in vectors.nearest_vectors(df).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    asked = np.arange(0, len(x), 20)
    scores = x[asked].astype(float) @ x.astype(float).T
    scores[np.arange(len(asked)), asked] = -np.inf
    limit = -np.sort(-scores, axis=1)[:, 19]
    hits = sum((scores[i, sorted(got[q])] >= limit[i] - 1e-9 * abs(limit[i])).sum() for i, q in enumerate(asked.tolist()))
    assert hits >= 0.97 * 20 * len(asked)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert vectors.near_vectors(empty).count() == vectors.nearest_vectors(empty).count() == 0
    nothing = spark.createDataFrame([(1, None, None), (20, [0.0], 1)], SCHEMA)
    assert vectors.near_vectors(nothing).filter("kept and n_links = 0").count() == 2
    assert vectors.nearest_vectors(nothing).count() == 0


def test_graph_recall_and_storage():
    x = clustered(6000, 32)
    x = np.unique(x, axis=0)
    x /= np.linalg.norm(x, axis=1)[:, None]
    graph = Graph.build(x)
    assert len(graph.layers) >= 1 and graph.sizes[-1] <= 512
    again = Graph.stored(x, *graph.arrays())
    q = x[::30]
    ids, sims = again.search(q, 128)
    true = np.argsort(-(q @ x.T), 1)[:, :20]
    recall = np.mean([len(set(true[i]) & set(again.order[ids[i]][:20])) / 20 for i in range(len(q))])
    assert recall >= 0.95
    assert (np.diff(sims, axis=1) <= 0).all()


@pytest.mark.parametrize("foreign", [False, True])
def test_audit_widens_until_all_links_are_found(foreign):
    x = clustered(4000, 16, copies=400).astype(float)
    x = np.unique(x, axis=0)
    shard = vectors.Shard.__new__(vectors.Shard)
    shard.nodes, shard.vectors, shard.unit = np.arange(len(x)) + foreign * 10**6, x, vectors.unit_vectors(x)
    shard.graph = Graph.build(shard.unit)
    q, at = vectors.found_links(shard, np.arange(len(x)) * 2 if foreign else np.arange(len(x)), x, 0.93)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    true = int((u @ u.T >= 0.93).sum())
    assert true >= len(set(zip(q.tolist(), at.tolist(), strict=True))) >= 0.999 * true


def test_audit_sees_small_groups_beside_a_hot_one():
    """A search that loses the pairs in narrow beams, beside a family that finds all its links."""
    rng = np.random.default_rng(3)
    hot = rng.normal(size=24) + 0.02 * rng.normal(size=(2000, 24))
    one = rng.normal(size=(1000, 24))
    x = np.concatenate([hot, one, one + 0.01 * rng.normal(size=one.shape)])
    u = vectors.unit_vectors(x)

    class Losing(vectors.Shard):
        def search(self, queries, width, own=None):
            sims = queries @ self.unit.T
            if width < 128:
                small = own >= 2000
                sims[small] = np.where(np.arange(len(x)) == own[small][:, None], sims[small], -1)
            at = np.argsort(-sims, axis=1, kind="stable")[:, :width]
            return at, np.take_along_axis(sims, at, 1)

    shard = Losing.__new__(Losing)
    shard.nodes, shard.vectors, shard.unit = np.arange(len(x)), x, u
    shard.graph = Graph(u, np.arange(len(x)), [len(x)], [])
    q, at = vectors.found_links(shard, np.arange(len(x)), x, 0.93)
    y = x / np.linalg.norm(x, axis=1)[:, None]
    assert set(zip(q.tolist(), at.tolist(), strict=True)) == set(map(tuple, np.argwhere(y @ y.T >= 0.93).tolist()))


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    edges = [(int(a), int(b)) for a, b in rng.integers(-300, 300, (250, 2))]
    edges += [(1000 + i, 1001 + i) for i in range(300)] + [(7, 2000 + i) for i in range(100)] + [(3, 3)]
    label = {n: n for e in edges for n in e}

    def find(n):
        while label[n] != n:
            n = label[n]
        return n

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        label[y] = x
    got = {r.u: r.root for r in components(spark.createDataFrame(edges, "u long, v long").repartition(7)).collect()}
    assert got == {n: find(n) for n in label if find(n) != n}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None
