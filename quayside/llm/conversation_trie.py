"""Prefix trie of conversations: parallel tree contraction.

A node is a distinct sequence of first turns; its key is 128 bits, the XOR of
hashes of (depth, role and text) along the sequence, so keys of whole
conversations come from running XORs.  Turns are numbered and XORed within
ranges of like size and carried over ranges, so one conversation may hold any
share of the rows.  Texts are hashed (SHA-256, 120 bits) in the scan and do not
travel.

Subtree totals come from rounds of two moves, each a join on keys: *rake* takes
all leaves and adds what they hold to their parents; *compress* takes nodes
with a single child out of their chains (of two neighbours never both: a bit
of the depth, later a coin, decides) and links the child to the grandparent.
A round writes what it took; rounds shrink geometrically and their number is
about the logarithm of the depth.  Then the rounds are gone through backwards: a
compressed node's total is its own plus that of the child it was linked past.

Defined cases: null role or text counts as empty; rows without conv_id belong to
no conversation; a null turn comes first; turns of one number follow the order
of their hashes; repeated rows are turns of their own; texts of any length are
hashed whole; an empty table gives no nodes, not even a root; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import materialize, ship
from quayside.operators.window import cut_by_range

KEY = ["k1", "k2"]
PARENT = ["p1", "p2"]
RAKED, COMPRESSED, LEFT = 0, 1, 2
PIECE = 1 << 14


def _mixed(depth: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), depth.cast("long"), F.col("f1"), F.col("f2"))


def _same(left: list[str], right: list[str]) -> Column:
    return (F.col(left[0]) == F.col(right[0])) & (F.col(left[1]) == F.col(right[1]))


def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, two halves of the turn's hash, and the text's code points."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    sha = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    half = [F.conv(F.substring("sha", a, 15), 16, 10).cast("long").alias(f) for a, f in ((1, "f1"), (16, "f2"))]
    return (conversations.where(F.col("conv_id").isNotNull())
            .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", sha.alias("sha"), F.length(text).alias("chars"))
            .select("conv_id", "turn", *half, F.col("chars").cast("long").alias("chars")))


def memberships(conversations: DataFrame, opening: Callable[[Column], tuple[Column, Column]] | None = None, longest: int = 0) -> DataFrame:
    """One row per conversation and depth, 0 included: conv_id, depth, key,
    parent's key, chars of the last turn, and whether the conversation ends there.

    ``opening`` gives for a conv_id another conversation and how many of its
    first turns (``longest`` at most) replace as many of the own ones.
    """
    order = [F.col("turn").asc_nulls_first(), F.col("f1"), F.col("f2")]
    rows = cut_by_range(_turns(conversations), "conv_id", order, "cut")
    by_cut = Window.partitionBy("conv_id").orderBy("cut")
    cuts = rows.groupBy("conv_id", "cut").agg(F.count("*").alias("n"))
    cuts = cuts.withColumn("before", F.sum("n").over(by_cut) - F.col("n"))
    inside = Window.partitionBy("conv_id", "cut").orderBy(*order)
    zero = F.lit(0).cast("long")

    base, asked = opening(F.col("conv_id")) if opening else (F.col("conv_id"), zero)
    convs = cuts.groupBy("conv_id").agg(F.sum("n").alias("own")).select("conv_id", "own", base.alias("base"), asked.cast("long").alias("asked"))
    steps = range(1, longest + 1)
    if longest:
        placed = (rows.withColumn("i", F.row_number().over(inside)).where(F.col("i") <= longest)
                  .join(cuts.select("conv_id", "cut", "before"), ["conv_id", "cut"])
                  .select("*", (F.col("i") + F.col("before")).alias("place")).where(F.col("place") <= longest)
                  .withColumns({"x1": _mixed(F.col("place"), 1), "x2": _mixed(F.col("place"), 2)}))
        heads = placed.groupBy("conv_id").agg(
            F.count("*").alias("there"),
            *[F.bit_xor(F.when(F.col("place") <= d, F.col(x))).alias(f"{x}_{d}") for x in ("x1", "x2") for d in steps],
            *[F.max(F.when(F.col("place") == d, F.col("chars"))).alias(f"c_{d}") for d in steps])
        convs = convs.join(heads.withColumnRenamed("conv_id", "base"), "base", "left")
        convs = convs.withColumn("m", F.least("asked", F.coalesce("there", zero)))
    else:
        convs = convs.withColumn("m", zero)
    empty = F.struct(zero.alias("k1"), zero.alias("k2"), zero.alias("chars"))
    nodes = F.array(empty, *[F.struct(F.col(f"x1_{d}").alias("k1"), F.col(f"x2_{d}").alias("k2"), F.col(f"c_{d}").alias("chars")) for d in steps])
    convs = materialize(convs.select("conv_id", "asked", "m", (F.col("m") + F.greatest(F.col("own") - F.col("asked"), zero)).alias("size"),
                                     F.slice(nodes, 1, (F.col("m") + 1).cast("int")).alias("nodes")))
    none = F.lit(None).cast("long")
    first = (convs.select("conv_id", "size", "nodes", F.posexplode("nodes").alias("depth", "node"))
             .withColumn("above", F.when(F.col("depth") > 0, F.get("nodes", F.col("depth") - 1)))
             .select("conv_id", F.col("depth").cast("long").alias("depth"), "node.k1", "node.k2",
                     F.coalesce("above.k1", none).alias("p1"), F.coalesce("above.k2", none).alias("p2"), "node.chars",
                     (F.col("depth") == F.col("size")).alias("ends")))

    last = F.get("nodes", F.col("m").cast("int"))
    about = cuts.join(convs.select("conv_id", "asked", "m", "size", last["k1"].alias("o1"), last["k2"].alias("o2")), "conv_id").drop("n")
    own = (rows.withColumn("i", F.row_number().over(inside)).join(about, ["conv_id", "cut"])
           .withColumn("place", F.col("i") + F.col("before")).where(F.col("place") > F.col("asked"))
           .withColumn("depth", F.col("place") - F.col("asked") + F.col("m"))
           .withColumns({"x1": _mixed(F.col("depth"), 1), "x2": _mixed(F.col("depth"), 2)}))
    earlier = by_cut.rowsBetween(Window.unboundedPreceding, -1)
    carried = own.groupBy("conv_id", "cut").agg(F.bit_xor("x1").alias("t1"), F.bit_xor("x2").alias("t2")).select(
        "conv_id", "cut", *[F.coalesce(F.bit_xor(t).over(earlier), zero).alias(c) for t, c in (("t1", "c1"), ("t2", "c2"))])
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = own.withColumns({"r1": F.bit_xor("x1").over(so_far), "r2": F.bit_xor("x2").over(so_far)}).join(carried, ["conv_id", "cut"])
    key = [F.col(f"r{i}").bitwiseXOR(F.col(f"c{i}")).bitwiseXOR(F.col(f"o{i}")) for i in (1, 2)]
    rest = running.select("conv_id", "depth", key[0].alias("k1"), key[1].alias("k2"), key[0].bitwiseXOR(F.col("x1")).alias("p1"),
                          key[1].bitwiseXOR(F.col("x2")).alias("p2"), "chars", (F.col("depth") == F.col("size")).alias("ends"))
    return first.unionByName(rest)


def tree_of(members: DataFrame) -> DataFrame:
    """One row per node: key, parent's key, depth, smallest member, members, children, chars."""
    nodes = members.groupBy(*KEY).agg(
        *[F.max(c).alias(c) for c in (*PARENT, "depth", "chars")], F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    nodes = materialize(nodes)
    kids = nodes.where("p1 IS NOT NULL").groupBy(*PARENT).agg(F.count("*").alias("n"))
    kids = kids.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), "n")
    return materialize(nodes.join(kids, _same(KEY, ["q1", "q2"]), "left").select(*nodes.columns, F.coalesce("n", F.lit(0).cast("long")).alias("n_children")))


def subtree_sums(tree: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Key and, for each of ``values``, its sum over the node's subtree.

    ``tree`` has the columns of a key, its parent's key (null at roots), depth
    and n_children; sums are of longs.
    """
    names = list(values)
    v, e, b = ([f"{x}{i}" for i in range(len(names))] for x in "veb")
    deepest = tree.agg(F.max("depth")).first()[0] or 0
    bits = max(1, int(deepest).bit_length())
    zero = F.lit(0).cast("long")

    def coin(r: int, depth: str, key: list[str]) -> Column:
        """Differs, sooner or later, between the two ends of every link."""
        side = F.shiftright(depth, r) if r < bits else F.xxhash64(F.lit(r), *key)
        return side.bitwiseAND(F.lit(1))

    now = tree.select(*KEY, *PARENT, F.col("depth").cast("long").alias("depth"), (F.col("n_children") == 0).alias("leaf"),
                      *[c.cast("long").alias(x) for x, c in zip(v, values.values(), strict=True)], *[zero.alias(x) for x in e])
    rounds: list[tuple[DataFrame, dict[int, int]]] = []
    left = None
    while left is None or left:
        r = len(rounds)
        live = ~F.col("leaf")
        below = now.where("p1 IS NOT NULL").groupBy(*PARENT).agg(
            F.count(F.when(live, 1)).alias("live"),
            *[F.max(F.when(live, F.col(x))).alias(y) for x, y in (("k1", "c1"), ("k2", "c2"), ("depth", "cd"))],
            *[F.coalesce(F.sum(F.when(F.col("leaf"), F.col(x) + F.col(y))), zero).alias(f"s{x}") for x, y in zip(v, e, strict=True)],
            *[F.max(F.when(live, F.col(y))).alias(f"c{y}") for y in e]).withColumnsRenamed({"p1": "q1", "p2": "q2"})
        met = now.join(below, _same(KEY, ["q1", "q2"]), "left")
        taken = (F.col("live") == 1) & F.col("p1").isNotNull() & (coin(r, "depth", KEY) == 1) & (coin(r, "cd", ["c1", "c2"]) == 0)
        kind = F.when(F.col("leaf"), RAKED).when(taken, COMPRESSED).otherwise(LEFT)
        held = [F.col(x) + F.coalesce(F.col(f"s{x}"), zero) for x in v]
        done = materialize(met.select(
            *KEY, *PARENT, "depth", kind.alias("kind"), (F.col("live") == 0).alias("bare"), "c1", "c2", *[h.alias(x) for h, x in zip(held, v, strict=True)], *e,
            *[(h + F.coalesce(F.col(f"c{y}"), zero)).alias(x) for h, y, x in zip(held, e, b, strict=True)]))
        count = {row["kind"]: row["count"] for row in done.groupBy("kind").count().collect()}
        rounds.append((done, count))
        left = count.get(LEFT, 0)
        past = done.where(F.col("kind") == COMPRESSED).select(
            "c1", "c2", F.col("p1").alias("n1"), F.col("p2").alias("n2"), *[(F.col(x) + F.col(y)).alias(f"a{y}") for x, y in zip(v, e, strict=True)])
        stay = done.where(F.col("kind") == LEFT).drop("c1", "c2")
        now = stay.join(past, _same(KEY, ["c1", "c2"]), "left").select(
            *KEY, F.coalesce("n1", "p1").alias("p1"), F.coalesce("n2", "p2").alias("p2"), "depth", F.col("bare").alias("leaf"), *v,
            *[(F.col(y) + F.coalesce(F.col(f"a{y}"), zero)).alias(y) for y in e])

    known: DataFrame | None = None
    for done, count in reversed(rounds):
        part = done.where(F.col("kind") == RAKED).select(*KEY, *v)
        if count.get(COMPRESSED):
            later = known.select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), *[F.col(x).alias(f"t{x}") for x in v])
            again = done.where(F.col("kind") == COMPRESSED).select(*KEY, "c1", "c2", *b).join(later, _same(["c1", "c2"], ["q1", "q2"]))
            part = part.unionByName(materialize(again.select(*KEY, *[(F.col(y) + F.col(f"t{x}")).alias(x) for x, y in zip(v, b, strict=True)])))
        known = part if known is None else known.unionByName(part)
    return known.select(*KEY, *[F.col(x).alias(n) for x, n in zip(v, names, strict=True)])


def ends_digest(members: DataFrame) -> DataFrame:
    """Key and SHA-256 of the comma-joined, ascending conv_ids that end at the node.

    Ids are joined to pieces in ranges of like size; a node's pieces stream
    through one digest, whose state is all that is held.
    """
    ship(members.sparkSession)

    def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def piece() -> pa.RecordBatch:
            body = ",".join(map(str, ids)).encode()
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, ids[0])] + [pa.array([body], pa.binary())], names=["k1", "k2", "first", "ids"])

        for batch in batches:
            for k1, k2, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (k1, k2) != node or len(ids) == PIECE:
                    if ids:
                        yield piece()
                    node, ids = (k1, k2), []
                ids.append(conv)
        if ids:
            yield piece()

    def digested(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for batch in batches:
            out = []
            for k1, k2, _, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (k1, k2) == node:
                    sha.update(b"," + body)
                    continue
                if node:
                    out.append((*node, sha.hexdigest()))
                node, sha = (k1, k2), hashlib.sha256(body)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=["k1", "k2", "sha"])
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, sha.hexdigest())], names=["k1", "k2", "sha"])

    ends = members.where("ends").select(*KEY, "conv_id")
    pieces = ends.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id").mapInArrow(joined, "k1 long, k2 long, first long, ids binary")
    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(digested, "k1 long, k2 long, sha string")


def trie(conversations: DataFrame, opening: Callable[[Column], tuple[Column, Column]] | None = None, longest: int = 0) -> DataFrame:
    """One row per node; see the module and :func:`memberships`.

    ``saved`` sums (members - 1) * code points of the last text over the subtree:
    what storing each prefix once saves.
    """
    members = materialize(memberships(conversations, opening, longest))
    tree = tree_of(members)
    sums = subtree_sums(tree, {"n_leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("chars")})
    parents = tree.where("n_children > 0").select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    named = tree.select(*KEY, *PARENT, "conv_id", "depth", "n_convs", "n_children").join(parents, _same(PARENT, ["q1", "q2"]), "left").drop("q1", "q2")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return (named.join(sums, KEY).join(ends_digest(members), KEY, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", F.coalesce("sha", nothing).alias("ends_sha256")))
