"""Scalar lookups re-aimed as joins.

The source calls a per-row function for every lookup.  Here each lookup is a
*dimension*: a DataFrame that is unique on its key by construction (one
aggregation when it is built), joined once with a left equi join and reused
as columns.  A left join to a unique key can never change the row count.
"""

from __future__ import annotations

import weakref
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows a dimension may hold to be broadcast explicitly.  Larger dimensions
# are left to the planner: AQE re-plans a sort-merge join as a broadcast from
# measured (not estimated) shuffle sizes, so a side is only ever broadcast
# behind a size check.
DEFAULT_BROADCAST_ROWS = 200_000

# Buckets over which rows with a NULL join key are spread in a shuffled left
# join.  Such rows never match, but hash partitioning would otherwise send
# all of them to one task.
NULL_KEY_SPREAD = 512

# Tasks over which the fact rows of one heavy key are spread, and how often
# the dimension's row of such a key is copied.
HOT_KEY_SPREAD = 128
# A key is heavy from half a task's fair share of the rows on.
HOT_PER_TASK = 2


def dimension(df: DataFrame, keys: Sequence[str], values: Sequence[str],
              prefer: Sequence[Column] | None = None) -> DataFrame:
    """One row per key.  When a key has several rows, the row with the
    greatest ``prefer`` tuple wins (default: the greatest value tuple), so the
    pick is deterministic.  Rows with a NULL key part are dropped: they can
    never be matched by an equi join."""
    keys = list(keys)
    values = list(values)
    not_null = _and([F.col(k).isNotNull() for k in keys])
    if len(values) == 1 and not prefer:
        # Same pick as the struct form below, but a plain max stays in the
        # hash aggregate for fixed-width and decimal values.
        return df.where(not_null).groupBy(*keys).agg(F.max(values[0]).alias(values[0]))
    order = list(prefer or []) + [F.col(v) for v in values]
    packed = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)],
                      *[F.col(v).alias(v) for v in values])
    best = (df.where(not_null).groupBy(*keys).agg(F.max(packed).alias("_best")))
    return best.select(*keys, *[F.col(f"_best.{v}").alias(v) for v in values])


def conflicts(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """What :func:`dimension` had to choose from: every distinct value tuple of the
    keys that have several, with the number of them (``candidates``), the rows
    that say so (``rows``) and whether it is the one picked (``picked``).
    NULL values are values; rows with a NULL key part never match and are left
    out.  Rows are first reduced to distinct tuples, so a key with any number
    of rows costs one row per value."""
    keys, values = list(keys), list(values)
    each = df.where(_and([F.col(k).isNotNull() for k in keys])).groupBy(*keys, *values).agg(F.count(F.lit(1)).alias("rows"))
    value = F.struct(*values)
    per_key = each.groupBy(*keys).agg(F.count(F.lit(1)).alias("candidates"), F.max(value).alias("_top")).where("candidates > 1")
    per_key = per_key.select(*[F.col(k).alias(f"_c_{k}") for k in keys], "candidates", "_top")
    joined = each.join(per_key, _and([F.col(k) == F.col(f"_c_{k}") for k in keys]))
    return joined.select(*keys, *values, "candidates", "rows", value.eqNullSafe(F.col("_top")).alias("picked"))


def difference(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> dict[str, int]:
    """How a table unique on ``keys`` differs from its last state: how many keys
    are ``new``, ``changed`` (another 64-bit hash of the row) and ``gone``.  One
    full join of keys and hashes; three numbers come to the driver."""
    keys = list(keys)
    columns = sorted(new.columns)
    if sorted(old.columns) != columns or {f.name: f.dataType for f in old.schema} != {f.name: f.dataType for f in new.schema}:
        return {"new": new.count(), "changed": 0, "gone": old.count()}

    def hashed(df: DataFrame, tag: str) -> DataFrame:
        return df.select(*[F.col(k).alias(f"{tag}_{k}") for k in keys], F.xxhash64(*columns).alias(f"{tag}_hash"))
    both = hashed(old, "o").join(hashed(new, "n"), _and([F.col(f"o_{k}").eqNullSafe(F.col(f"n_{k}")) for k in keys]), "full")
    n = both.agg(F.count(F.when(F.col("o_hash").isNull(), 1)).alias("new"), F.count(F.when(F.col("n_hash").isNull(), 1)).alias("gone"),
                 F.count(F.when(F.col("o_hash") != F.col("n_hash"), 1)).alias("changed")).first()
    return {k: int(n[k]) for k in ("new", "changed", "gone")}


# Exact row counts per dimension object; weakly keyed, so a dimension that is
# no longer used drops out and an id can never be mistaken for another.  A
# count holds as long as the files behind the object do; a run builds its
# dimension objects anew.
_SIZE_PROOFS: "weakref.WeakKeyDictionary[DataFrame, int]" = weakref.WeakKeyDictionary()


def broadcast_if_small(dim: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``dim`` only after proving it holds at most ``max_rows`` rows.

    The check is an exact count, done once per dimension object and
    remembered, so it answers for any bound; above the bound the dimension is
    returned untouched and joins by shuffle.
    """
    prove_small([dim])
    return F.broadcast(dim) if _SIZE_PROOFS[dim] <= max_rows else dim


def prove_small(dims: Sequence[DataFrame]) -> None:
    """Count several dimensions in one action (partial counts per task, one row
    per dimension to the driver), so a feed that joins many reference tables
    pays for one job, not one per table."""
    todo = [d for d in dims if d not in _SIZE_PROOFS]
    if not todo:
        return
    parts = [d.select(F.lit(i).alias("_i")) for i, d in enumerate(todo)]
    u = parts[0]
    for q in parts[1:]:
        u = u.unionByName(q)
    counts = {r["_i"]: r["n"] for r in u.groupBy("_i").agg(F.count(F.lit(1)).alias("n")).collect()}
    for i, d in enumerate(todo):
        _SIZE_PROOFS[d] = counts.get(i, 0)


def row_count(dim: DataFrame) -> int:
    """Exact rows of a dimension, counted once per object."""
    prove_small([dim])
    return _SIZE_PROOFS[dim]


def heavy_hitters(df: DataFrame, *keys: Sequence[str], tasks: int | None = None) -> list[list[int]]:
    """For each key (a list of columns) the hashes of its heavy values: all that
    hold at least one row in ``HOT_PER_TASK * tasks``, perhaps a few others.

    One pass over the key columns for all keys, with Spark's frequent-items
    aggregate, whose state is as bounded as its result: at most
    ``HOT_PER_TASK * tasks`` numbers a key come to the driver, whatever the
    size of the table.  ``tasks`` defaults to the session's shuffle
    partitions.  NULL keys are not counted (they are spread anyway)."""
    n = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(1.0 / (HOT_PER_TASK * n), 1e-4)
    hashed = df.select(*[F.when(_and([F.col(c).isNotNull() for c in k]), _key_hash([F.col(c) for c in k], [df.schema[c].dataType for c in k]))
                         .alias(f"h{i}") for i, k in enumerate(keys)])
    found = hashed.freqItems([f"h{i}" for i in range(len(keys))], share).first()
    return [sorted(h for h in found[i] or [] if h is not None) for i in range(len(keys))]


def _key_hash(cols: Sequence[Column], types: Sequence[T.DataType]) -> Column:
    """Hash of a key, the same whichever integer type holds it."""
    return F.xxhash64(*[c.cast("decimal(38,0)") if isinstance(t, _INTEGRAL) or isinstance(t, T.DecimalType) and not t.scale else c
                        for c, t in zip(cols, types)])


def lookup(df: DataFrame, dim: DataFrame, on: Sequence[str] | dict,
           cols: Sequence[str] | dict | None = None, *, small: bool = False,
           max_rows: int = DEFAULT_BROADCAST_ROWS, spread_null_keys: bool = True,
           row_key: Sequence[str] | None = None, hot: Sequence[int] = ()) -> DataFrame:
    """Left-join ``dim`` (unique on its key) onto ``df`` and add ``cols``.

    ``on`` maps fact column -> dimension column (a list means same names).
    ``cols`` maps dimension column -> output name.  ``small=True`` asks for a
    broadcast, granted only if :func:`broadcast_if_small` proves the size.
    Shuffled joins spread NULL-key fact rows over many tasks by a hash of
    ``row_key``, columns that tell the fact rows apart (all columns if not
    named).  ``hot`` names heavy keys by their hashes (:func:`heavy_hitters`):
    their fact rows are spread alike, and the dimension's row of such a key
    is copied to each of the tasks.
    """
    pairs = list(on.items()) if isinstance(on, dict) else [(k, k) for k in on]
    dim_keys = [d for _, d in pairs]
    if cols is None:
        cols = [c for c in dim.columns if c not in dim_keys]
    out_map = dict(cols) if isinstance(cols, dict) else {c: c for c in cols}

    tag = "_lk"
    right = dim.select(*[F.col(d).alias(f"{tag}_k{i}") for i, (_, d) in enumerate(pairs)],
                       *[F.col(c).alias(f"{tag}_v_{o}") for c, o in out_map.items()])
    right = right.where(_and([F.col(f"{tag}_k{i}").isNotNull() for i in range(len(pairs))]))
    # Both paths compare the same values: keys of one type, or integers and
    # decimals widened without loss.  Text against numbers is refused, since
    # its meaning would depend on how the join is carried out.
    types = [_common_type(f, df.schema[f].dataType, d, dim.schema[d].dataType) for f, d in pairs]
    right = right.select(*[F.col(f"{tag}_k{i}").cast(t).alias(f"{tag}_k{i}") for i, t in enumerate(types)],
                         *[F.col(f"{tag}_v_{o}") for o in out_map.values()])
    cond = [F.col(f).cast(t) == F.col(f"{tag}_k{i}") for i, ((f, _), t) in enumerate(zip(pairs, types))]

    packed: dict = {}
    # A dimension that fails its size proof joins like any large one.
    broadcast = small and broadcast_if_small(dim, max_rows) is not dim
    if broadcast:
        joined = df.join(F.broadcast(right), on=_and(cond), how="left")
    elif spread_null_keys:
        # One struct key (fact keys + salt) against (dimension keys + 0):
        # the shuffle hashes the whole struct, so rows whose key has a NULL
        # part - they can never match - spread over NULL_KEY_SPREAD tasks
        # instead of piling into one.  Being a single expression, the key
        # cannot be satisfied by a partitioning on the bare key, so the
        # planner cannot drop the salt by re-using the dimension's layout.
        # The salt hashes the row's own key (all columns unless the caller
        # names it, which lets the scan skip the rest); a retried task deals
        # its rows out as before.
        any_null = _or([F.col(f).isNull() for f, _ in pairs])
        row_hash = F.xxhash64(*[F.col(c) for c in row_key or df.columns])
        salt = F.when(any_null, F.pmod(row_hash, F.lit(NULL_KEY_SPREAD)))
        copies = F.array(F.lit(0))
        if hot:
            fact_hash = _key_hash([F.col(f) for f, _ in pairs], [df.schema[f].dataType for f, _ in pairs])
            dim_hash = _key_hash([F.col(f"{tag}_k{i}") for i in range(len(pairs))], types)
            salt = salt.when(fact_hash.isin(list(hot)), F.pmod(row_hash, F.lit(HOT_KEY_SPREAD)))
            copies = F.when(dim_hash.isin(list(hot)), F.sequence(F.lit(0), F.lit(HOT_KEY_SPREAD - 1))).otherwise(copies)
        salt = salt.otherwise(F.lit(0)).cast("int")
        left_key = F.struct(*[F.col(f).cast(t).alias(f"k{i}") for i, ((f, _), t) in enumerate(zip(pairs, types))],
                            salt.alias("s"))
        # The key travels once: its columns are read from the struct afterwards.
        packed = {f: F.col(f"{tag}_lkey.k{i}") for i, ((f, _), t) in enumerate(zip(pairs, types)) if df.schema[f].dataType == t}
        left = df.withColumn(f"{tag}_lkey", left_key).drop(*packed)
        if hot:
            right = right.withColumn(f"{tag}_s", F.explode(copies))
        right = right.withColumn(f"{tag}_rkey", F.struct(
            *[F.col(f"{tag}_k{i}").cast(t).alias(f"k{i}") for i, t in enumerate(types)],
            (F.col(f"{tag}_s") if hot else F.lit(0)).alias("s")))
        joined = left.join(right, on=F.col(f"{tag}_lkey") == F.col(f"{tag}_rkey"), how="left")
    else:
        joined = df.join(right, on=_and(cond), how="left")

    keep = [packed[c].alias(c) if c in packed else F.col(c) for c in df.columns] + [F.col(f"{tag}_v_{o}").alias(o) for o in out_map.values()]
    return joined.select(*keep)


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _common_type(fact: str, a: T.DataType, dim: str, b: T.DataType) -> T.DataType:
    """The type both key sides have or widen to without loss."""
    if a == b:
        return a
    if isinstance(a, _INTEGRAL) and isinstance(b, _INTEGRAL):
        return T.LongType()
    if isinstance(a, (T.DecimalType,) + _INTEGRAL) and isinstance(b, (T.DecimalType,) + _INTEGRAL):
        scale = max(getattr(a, "scale", 0), getattr(b, "scale", 0))
        return T.DecimalType(38, scale)
    raise TypeError(f"lookup keys {fact} ({a.simpleString()}) and {dim} ({b.simpleString()}) differ in kind; cast one")


def _and(conds):
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def _or(conds):
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out
