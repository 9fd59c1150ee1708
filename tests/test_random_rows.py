"""Random small tables against a plain Python account of the same rules."""

from hypothesis import HealthCheck, given, settings as hypothesis_settings, strategies as st
from pyspark.sql import functions as F

from roadstrata.functions.keys import hash_key
from roadstrata.operators.lookup import lookup_key
from roadstrata.operators.survivors import dedupe, latest_per_key
from roadstrata.plans.facts import traffic_rollup

few = hypothesis_settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
label = st.one_of(st.none(), st.sampled_from(["", "a", "b", "N", "1:a"]))
time = st.one_of(st.none(), st.integers(0, 3))


@few
@given(st.lists(st.tuples(label, time, st.integers(0, 9)), max_size=40))
def test_dedupe_and_latest(spark, rows):
    df = spark.createDataFrame(rows, "k string, t int, seq int")
    least = {}
    for k, t, seq in rows:
        least[k, t] = min(seq, least.get((k, t), seq))
    got = [tuple(r) for r in dedupe(df, ["k", "t"], ["seq"]).collect()]
    assert sorted(got, key=repr) == sorted([(*key, seq) for key, seq in least.items()], key=repr)

    newest = {}
    for k, t, seq in rows:
        rank = (t is None, -(t or 0), seq)
        newest[k] = min((rank, (k, t, seq)), newest.get(k, (rank, (k, t, seq))))
    got = {r.k: tuple(r) for r in latest_per_key(df, ["k"], "t", ties=["seq"]).collect()}
    assert got == {k: row for k, (_, row) in newest.items()}


@few
@given(st.lists(st.tuples(label, label), max_size=30), st.lists(st.tuples(label, label), max_size=30))
def test_lookup(spark, facts, members):
    members = sorted(set(members), key=repr)
    fact = spark.createDataFrame([(i, *r) for i, r in enumerate(facts)], "id int, x string, y string")
    dim = spark.createDataFrame([(i, *r) for i, r in enumerate(members)], "sk bigint, a string, b string")
    keys = {member: i for i, member in enumerate(members)}
    strict = {i: keys.get(r) if None not in r else None for i, r in enumerate(facts)}
    loose = {i: keys.get(r) for i, r in enumerate(facts)}
    on = {"a": "x", "b": "y"}
    for null_safe, spread, want in ((False, (), strict), (False, ("id",), strict), (True, (), loose)):
        got = lookup_key(fact, dim, on, "sk", null_safe=null_safe, spread_by=spread).collect()
        assert {r.id: r.sk for r in got} == want and len(got) == len(facts)


@few
@given(st.lists(st.tuples(st.one_of(st.none(), st.text(max_size=4)), st.one_of(st.none(), st.text(max_size=4))), max_size=30))
def test_hash_keys_differ_when_parts_do(spark, pairs):
    pairs = [tuple(None if p is None else p.encode("utf-8", "ignore").decode() for p in pair) for pair in pairs]
    df = spark.createDataFrame(pairs, "x string, y string")
    keys = {r.k for r in df.select(hash_key(["x", "y"]).alias("k")).collect()}
    assert len(keys) == len(set(pairs))


@few
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(1, 3)), st.integers(-90, 200), st.one_of(st.none(), st.integers(0, 8).map(float)), st.integers(0, 4)), max_size=40))
def test_rollup(spark, rows):
    df = spark.createDataFrame(rows, "cur_location_sk bigint, time_sk int, speed_kmph float, congestion_score int")
    fact = df.withColumn("traffic_vehicle_id", F.lit("V"))
    groups = {}
    for place, t, speed, score in rows:
        groups.setdefault((place, t - t % 60), []).append((speed, score))
    want = {
        key: (
            (lambda speeds: sum(speeds) / len(speeds) if speeds else None)([s for s, _ in g if s is not None]),
            sum(c for _, c in g) / len(g),
            len(g),
        )
        for key, g in groups.items()
    }
    got = traffic_rollup(fact, "minute").collect()
    assert {(r.cur_location_sk, r.time_sk): (r.avg_speed, r.avg_congestion, r.traffic_count) for r in got} == want
