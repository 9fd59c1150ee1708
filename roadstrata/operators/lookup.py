"""Surrogate-key lookups: left outer joins of a fact to a dimension on its business key."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from roadstrata.functions.keys import as_column

#: Pieces that a hot key is cut into for each task's fair share of rows it has: pieces fall on tasks by hash, so many small ones come out even.
PIECES = 32
#: The most distinct keys that a sketch can follow.
MOST_TRACKED = 1_000_000


def join_hash(values: Iterable[Column | str]) -> Column:
    """64 bits of all parts of a join key; null is a value of its own in each."""
    return F.xxhash64(*[x for v in map(as_column, values) for x in (v.isNull(), v)])


def hot_keys(
    fact: DataFrame, roles: Mapping[str, Sequence[Column | str]], tasks: int
) -> dict[str, dict[int, int]]:
    """For each role the hashes of its hot keys and how many pieces each is to be cut into.

    Hot is a key with over a quarter of the rows that a task would have if all `tasks` had as many. Each map task keeps a sketch
    of its most frequent keys per role and only the sketches are merged, so one pass over the key columns finds them, and no key's
    rows come together for it. There are at most four hot keys a task and role, 16 bytes each on the driver. A
    sketch's counts are close, not exact: they only set how finely a key is cut. It follows eight keys a task, at most MOST_TRACKED;
    keys it cannot tell apart from the rest have a few rows more than that quarter and stay whole. Repeated rows count each time; an empty table has no hot key.
    """
    hashes = fact.select(*[join_hash(values).alias(role) for role, values in roles.items()])
    tracked = min(MOST_TRACKED, max(1024, 8 * tasks))
    found = hashes.agg(
        F.count("*").alias("__rows"),
        *[F.expr(f"approx_top_k(`{role}`, {min(tracked, 4 * tasks)}, {tracked})").alias(role) for role in roles],
    ).first()
    fair = found["__rows"] / tasks
    return {
        role: {
            item["item"]: math.ceil(PIECES * item["count"] / fair)
            for item in found[role]
            if item["count"] > fair / 4
        }
        for role in roles
    }


def lookup_key(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, Column | str],
    key: str,
    alias: str | None = None,
    null_safe: bool = False,
    spread_by: Sequence[str] = (),
    hot: Mapping[int, int] | None = None,
) -> DataFrame:
    """Add `alias`, the `key` of the member whose columns equal the expressions in `on`.

    `on` maps a dimension column to the fact expression it must equal. The
    dimension must be unique on those columns; then the fact keeps its rows. It is
    joined under private names, so one dimension can be looked up in many roles.

    With plain equality a null part finds no member. All such rows would shuffle to
    one task, so when `spread_by` names fact columns they get a hash of them,
    which no member has, as one more join key: as many ways as there are rows. Hot keys that
    `hot_keys` found for the same expressions (`hot`, with `spread_by`) are cut into pieces: a row gets one of them by a hash of
    its `spread_by` columns, and the key's member is copied once per piece; all other keys
    are joined plainly. Without `hot` such keys are left to the
    skew-join splitting of AQE, which needs one side's partitions to be small. Broadcasting is chosen by measured sizes.
    """
    alias = alias or key
    names = {column: f"__{alias}_{i}" for i, column in enumerate(on)}
    members = dim.select(
        *[F.col(column).alias(name) for column, name in names.items()], F.col(key).alias(alias)
    )
    wanted = {name: as_column(on[column]) for column, name in names.items()}
    equal = [
        value.eqNullSafe(F.col(name)) if null_safe else value == F.col(name)
        for name, value in wanted.items()
    ]
    if hot and not spread_by:
        raise ValueError("hot keys need columns to spread them by")
    if spread_by and (hot or not null_safe):
        salt = F.lit(0).cast("bigint")
        spread, home = f"__{alias}_spread", f"__{alias}_home"
        bucket = F.xxhash64(*spread_by)
        # Always 0, but computed: a literal would be folded out of the join keys.
        homes = F.pmod(F.xxhash64(alias), F.lit(1))
        if hot:
            same_kinds(fact.select(*wanted.values()), members.select(*names.values()))
            fact, pieces = with_pieces(fact, wanted.values(), hot, f"__{alias}")
            members, copies = with_pieces(members, names.values(), hot, f"__{alias}_dim")
            salt = F.when(pieces.isNotNull(), F.pmod(bucket, pieces)).otherwise(salt)
            homes = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(copies, F.lit(1)) - 1))
        if not null_safe:
            incomplete = reduce(lambda a, b: a | b, [value.isNull() for value in wanted.values()])
            salt = F.when(incomplete, bucket).otherwise(salt)
        fact = fact.withColumn(spread, salt)
        members = members.withColumn(home, homes)
        equal.append(F.col(spread) == F.col(home))
    joined = fact.join(members, reduce(lambda a, b: a & b, equal), "left")
    private = [n for n in joined.columns if n.startswith(f"__{alias}_")]
    return joined.drop(*private)


def with_pieces(df: DataFrame, key: Iterable[Column | str], hot: Mapping[int, int], prefix: str) -> tuple[DataFrame, Column]:
    """`df` and the number of pieces of its row's key, null where the key is not hot. `hot` is bounded, see `hot_keys`."""
    schema = f"{prefix}_hot bigint, {prefix}_pieces bigint"
    found = df.sparkSession.createDataFrame(list(hot.items()), schema)
    joined = df.join(F.broadcast(found), join_hash(key) == F.col(f"{prefix}_hot"), "left")
    return joined, F.col(f"{prefix}_pieces")


def same_kinds(left: DataFrame, right: DataFrame) -> None:
    """Equal values hash alike only where they are of one type."""
    kinds = [[f.dataType for f in df.schema] for df in (left, right)]
    if kinds[0] != kinds[1]:
        raise ValueError(f"hot keys need the same types on both sides: {kinds[0]} and {kinds[1]}")
