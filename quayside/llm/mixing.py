"""Mixing sources to target weights by capped water-filling.

Every source asks for its weight's share of the budget.  A source whose share
is more than ``max_epochs`` times its size is clamped there; what it cannot
take is shared again by weight among the others, until none is above.  A
source then repeats every document ``floor(target / size)`` times and, for
the fraction left, once more the documents that come first in a seeded order
until the fraction's words are reached.

The seeded order is an md5 of (seed, doc_id).  A source is never sorted as a
whole: its first hex digits split it into 4096 slots, words are summed per
slot, running sums over the slot table give every slot's start, and documents
are ranked inside (source, slot) only.  A document is in the fraction if the
middle of its words lies there, so a source misses its target by half a
document at most.

Defined cases: null text has size 0 and is repeated like its source; null
source is the last source; sources of size 0 get target 0; repeated rows with
one doc_id and size share their place in the order and are taken in turn; a very
long text is repeated or not as a whole; an empty table gives an empty result; other
columns are ignored, or kept by ``mixed_documents``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import materialize, text_of, words

SLOT_DIGITS = 3


def sizes(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", F.size(words(text_of())).cast("long").alias("size"))


def ranked_sources(sources: DataFrame) -> DataFrame:
    """``place`` 0, 1, 2, ... by code point, null last, without one global sort task:
    a range partitioning, row numbers inside each part, and the parts' offsets."""
    parts = materialize(
        sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()))
    counts = parts.groupBy("part").agg(F.count("*").alias("n"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    order = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return (parts.withColumn("i", F.row_number().over(order) - 1).join(before, "part")
            .withColumn("place", F.col("i") + F.col("before")).drop("i", "before", "part"))


def targets(sources: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """(source, source_size, target) from (source, source_size)."""
    pattern = F.array(*[F.lit(int(w)) for w in weights])
    rows = materialize(ranked_sources(sources).select(
        "source", "source_size", F.get(pattern, (F.col("place") % len(weights)).cast("int")).cast("long").alias("weight")))
    cap = F.col("source_size") * max_epochs
    full = F.lit(False)
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    n_full = -1
    while True:
        got = rows.agg(F.count(F.when(full, 1)), F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))).first()
        if got[0] == n_full:
            break
        n_full, rest, weight = got[0], total - (got[1] or 0), got[2] or 0
        # above its cap at the present water level, or already clamped
        full = (F.col("weight") * F.lit(rest) > cap * F.lit(weight)) if weight else F.lit(True)
    share = F.col("weight").cast("double") * F.lit(float(rest)) / F.lit(float(weight or 1))
    return rows.select("source", "source_size", F.when(full, cap.cast("double")).otherwise(share).alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), max_epochs: int = 3, seed: int = 42) -> DataFrame:
    """One row per document: ``size``, its source's ``source_size`` and
    ``target``, ``reps`` (how often the mix holds it) and ``taken`` words."""
    rows = materialize(sizes(docs).withColumn(
        "turn", F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))))
        .withColumn("slot", F.substring("turn", 1, SLOT_DIGITS)))
    slots = rows.groupBy("source", "slot").agg(F.sum("size").alias("words"))
    slots = materialize(slots)
    goal = targets(slots.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs)
    goal = goal.select(F.col("source").alias("g_source"), "source_size", "target",
                       F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                       .otherwise(F.lit(0)).cast("long").alias("whole"))
    running = Window.partitionBy("source").orderBy("slot")
    start = slots.select("source", "slot", (F.sum("words").over(running) - F.col("words")).alias("before"))
    start = (start.join(goal, F.col("source").eqNullSafe(F.col("g_source")))
             .select(F.col("source").alias("s_source"), F.col("slot").alias("s_slot"), "before", "source_size", "target",
                     "whole", (F.col("target") - F.col("whole") * F.col("source_size")).alias("part")))
    inside = Window.partitionBy("source", "slot").orderBy("turn", "size", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    middle = F.col("before") + F.col("ahead") + F.col("size") / 2
    extra = F.when((F.col("part") > 0) & (middle <= F.col("part")), 1).otherwise(0)
    return (ranked.join(start, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("slot") == F.col("s_slot")))
            .withColumn("reps", F.col("whole") + extra)
            .select("doc_id", "source", "size", "source_size", "target", "reps", (F.col("size") * F.col("reps")).alias("taken")))


def mixed_documents(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), max_epochs: int = 3, seed: int = 42) -> DataFrame:
    """The documents of the mix, each row as often as the mix holds it."""
    reps = (mix(docs, weights, max_epochs, seed).where("reps > 0").groupBy("doc_id", "source", "size")
            .agg(F.array_sort(F.collect_list("reps")).alias("reps"))
            .select(F.col("doc_id").alias("m_doc"), F.col("source").alias("m_source"), F.col("size").alias("m_size"), "reps"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("d"), F.col("source").alias("s"),
                       F.size(words(text_of())).cast("long").alias("n"))
    twins = Window.partitionBy("d", "s", "n").orderBy(F.xxhash64("row.text"))
    joined = (rows.withColumn("twin", F.row_number().over(twins))
              .join(reps, F.col("d").eqNullSafe(F.col("m_doc")) & F.col("s").eqNullSafe(F.col("m_source"))
                    & (F.col("n") == F.col("m_size"))))
    times = F.coalesce(F.get("reps", F.col("twin") - 1), F.lit(0))
    return (joined.where(times > 0).select("row", F.explode(F.sequence(F.lit(1).cast("long"), times)).alias("rep"))
            .select("row.*"))
