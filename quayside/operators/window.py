"""``LAG`` within a group, safe on hot groups.

``LAG(v) OVER (ORDER BY g, o...)`` guarded by "previous g equals this g" is a
LAG partitioned by ``g``.  Partitioning by ``g`` alone would put a hot group
(say a third of all rows) into one task, so the rows are first cut into
ranges of ``(g, o...)`` of like size.  LAG runs inside ``(g, range)``; the
first row of a range takes the last value of the nearest earlier range of
the same group, found on a table with one row per ``(g, range)`` - at most
as many rows as there are groups and ranges together, however ids are
spread.  The result equals the global form exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.operators.maintenance import materialize


def cut_by_range(df: DataFrame, group: str, order: Sequence[Column], out: str) -> DataFrame:
    """Add ``out``: the number of the row's range when rows are cut by
    ``(group, order...)`` into ranges of like size, as many as the session has
    shuffle partitions.  Range borders come from a sample, so the rows are
    written once with their number: every later reader sees the same cut."""
    cut = df.repartitionByRange(F.col(group).asc(), *order)
    return materialize(cut.withColumn(out, F.spark_partition_id()))


def lag_within(df: DataFrame, group: str, order: Sequence[Column], value: str, out: str,
               bucket: Column) -> DataFrame:
    """Add ``out`` = previous row's ``value`` within ``group`` in ``order``.

    ``bucket`` must be non-decreasing along ``order`` inside a group, such as
    the column that :func:`cut_by_range` adds.  Rows with a NULL group get
    NULL, as "NULL = NULL" is not true.
    """
    b = df.withColumn("_lag_b", bucket)
    w = Window.partitionBy(group, "_lag_b").orderBy(*order)
    w_all = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    b = (b.withColumn("_lag_prev", F.lag(F.col(value), 1).over(w))
          .withColumn("_lag_rn", F.row_number().over(w))
          .withColumn("_lag_last", F.last(F.col(value)).over(w_all)))
    heads = b.where(F.col("_lag_rn") == 1).select(group, "_lag_b", "_lag_last")
    heads = heads.withColumn(
        "_lag_carry",
        F.lag("_lag_last", 1).over(Window.partitionBy(group).orderBy("_lag_b")),
    ).select(F.col(group).alias("_lag_g"), F.col("_lag_b").alias("_lag_hb"), "_lag_carry")
    joined = b.join(heads, (F.col(group) == F.col("_lag_g")) & (F.col("_lag_b") == F.col("_lag_hb")),
                    "left")
    prev = F.when(F.col(group).isNull(), F.lit(None)).when(
        F.col("_lag_rn") == 1, F.col("_lag_carry")).otherwise(F.col("_lag_prev"))
    return joined.withColumn(out, prev.cast(df.schema[value].dataType)).select(*df.columns, out)
