"""Post-load table maintenance folded into the projection: fills, guarded
backfills, deletes by list, appends by name, typed NULL placeholders."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.lookup import dimension, lookup


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """``UPDATE t SET c = v WHERE c IS NULL`` for each ``c: v``."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def backfill(df: DataFrame, dim: DataFrame, on: dict, targets: dict, guard: str,
             *, small: bool = False) -> DataFrame:
    """``UPDATE t SET tgt = f(keys) WHERE tgt IS NULL AND guard IS NOT NULL``.

    ``dim`` is unique on its key; ``targets`` maps target column -> dimension
    column.  All targets share one join.
    """
    tmp = {d: f"_bf_{t}" for t, d in targets.items()}
    joined = lookup(df, dim, on, tmp, small=small)
    for t, d in targets.items():
        upd = F.when(F.col(t).isNull() & F.col(guard).isNotNull(), F.col(f"_bf_{t}")).otherwise(F.col(t))
        joined = joined.withColumn(t, upd.cast(df.schema[t].dataType))
    return joined.drop(*tmp.values())


@dataclass(frozen=True)
class Rank:
    """One way to match a row with a candidate: equal ``keys`` (row column ->
    candidate column).  ``row_lacks`` / ``candidate_lacks`` name a column that
    must be NULL on that side; ``label`` says afterwards that this way matched."""
    label: str
    keys: dict
    row_lacks: str | None = None
    candidate_lacks: str | None = None


def ranked_lookup(df: DataFrame, candidates: DataFrame, ranks: Sequence[Rank], values: Sequence[str], label: str = "matched_by") -> DataFrame:
    """The distinct key tuples of ``df`` that some rank matches, with ``values`` and
    ``label`` of the first rank that does.

    All ranks are answered in one join: candidates are stacked as one row per
    (rank, key), the greatest value tuple of a key winning, and each distinct
    key tuple of ``df`` asks once per rank it qualifies for.  Columns are the
    key columns of ``df`` (NULLs kept), the values and the label."""
    columns = list(dict.fromkeys(c for r in ranks for c in [*r.keys, *([r.row_lacks] if r.row_lacks else [])]))
    width = max(len(r.keys) for r in ranks)

    def slots(names: Sequence[str]) -> list[Column]:
        return [F.col(n).cast("string").alias(f"_k{i}") for i, n in enumerate(names)] + [
            F.lit("").alias(f"_k{i}") for i in range(len(names), width)]

    def usable(names: Sequence[str], lacks: str | None) -> Column:
        out = F.col(lacks).isNull() if lacks else F.lit(True)
        for n in names:
            out = out & F.col(n).isNotNull()
        return out

    keys = [f"_k{i}" for i in range(width)]
    offered = F.explode(F.array_compact(F.array(*[F.when(usable(list(r.keys.values()), r.candidate_lacks), F.struct(
        F.lit(i).alias("_rank"), *slots(list(r.keys.values())))) for i, r in enumerate(ranks)])))
    offer = dimension(candidates.select(offered.alias("_o"), *values).select("_o.*", *values), ["_rank", *keys], list(values))
    asked = F.explode(F.array_compact(F.array(*[F.when(usable(list(r.keys), r.row_lacks), F.struct(
        F.lit(i).alias("_rank"), *slots(list(r.keys)))) for i, r in enumerate(ranks)])))
    rows = df.select(*columns).distinct().select(*columns, asked.alias("_a")).select(*columns, "_a.*")
    best = rows.join(offer, ["_rank", *keys]).groupBy(*columns).agg(F.min_by(F.struct("_rank", *values), "_rank").alias("_best"))
    name = F.element_at(F.array(*[F.lit(r.label) for r in ranks]), F.col("_best._rank") + 1)
    return best.select(*columns, *[F.col(f"_best.{v}").alias(v) for v in values], name.alias(label))


def ranked_backfill(df: DataFrame, candidates: DataFrame, ranks: Sequence[Rank], targets: dict, guard: str,
                    label: str | None = None, *, matched_only: bool = False) -> DataFrame:
    """:func:`backfill` whose dimension is the first rank that matches: targets
    that are NULL are filled where ``guard`` is not NULL.  ``label`` adds the
    matching rank's name.  ``matched_only`` returns the rows that some rank
    matches and leaves the others, which stay as they are, to the caller;
    rows and candidates that cannot meet then stay on the scan."""
    if matched_only:
        df, candidates = _may_meet(df.where(F.col(guard).isNotNull()), candidates, ranks)
    found = ranked_lookup(df.where(F.col(guard).isNotNull()), candidates, ranks, list(dict.fromkeys(targets.values())), "_bf_label")
    columns = [c for c in found.columns if c in df.columns and c not in targets]
    found = found.select(*[F.col(c).alias(f"_bf_k_{c}") for c in columns], *[F.col(d).alias(f"_bf_{t}") for t, d in targets.items()], "_bf_label")
    same = F.col(guard).isNotNull()
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_bf_k_{c}"))
    joined = df.join(found, same, "inner" if matched_only else "left")
    filled = {t: F.when(F.col(t).isNull(), F.col(f"_bf_{t}")).otherwise(F.col(t)).cast(df.schema[t].dataType) for t in targets}
    extra = [F.col("_bf_label").alias(label)] if label else []
    return joined.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns], *extra)


def _may_meet(df: DataFrame, candidates: DataFrame, ranks: Sequence[Rank]) -> tuple[DataFrame, DataFrame]:
    """Rows and candidates behind Bloom filters of the other side, by the first pair
    of columns that every rank compares.  ``df`` is read twice."""
    from quayside.operators.bloom import only_possible

    shared = [(a, b) for a, b in ranks[0].keys.items() if all(r.keys.get(a) == b for r in ranks)]
    if not shared:
        return df, candidates
    (row, candidate), *_ = shared
    df = only_possible(df, row, candidates.select(candidate).distinct(), candidate)
    return df, only_possible(candidates, candidate, df.select(row).distinct(), row)


def purge(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """``DELETE WHERE col IN (values)``: rows with a NULL ``col`` stay."""
    return df.where(~F.coalesce(F.col(col).isin(list(values)), F.lit(False)))


def union_by_name(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """Bag union matched by column name; columns a side lacks are NULL."""
    out = first
    for r in rest:
        out = out.unionByName(r, allowMissingColumns=True)
    return out


def typed_nulls(spec: dict) -> list[Column]:
    """Typed NULL placeholders ``{name: type}`` so the written schema is the
    declared one (never ``void``)."""
    return [F.lit(None).cast(t).alias(n) for n, t in spec.items()]


# Tables that the run in progress has materialized (None: no run).
_RUN_TABLES: ContextVar = ContextVar("run_tables", default=None)


@contextmanager
def run_tables(spark: SparkSession):
    """Delete at the end, come what may, the tables that :func:`materialize`
    writes inside; what the run keeps must be written elsewhere by then."""
    paths: list[str] = []
    token = _RUN_TABLES.set(paths)
    try:
        yield
    finally:
        _RUN_TABLES.reset(token)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for p in paths:
            path = hadoop.Path(p)
            path.getFileSystem(conf).delete(path, True)


# What :func:`materialize` has written, for those who look at plans (None: nobody).
_WRITTEN: ContextVar = ContextVar("written", default=None)


@contextmanager
def written_tables():
    """The DataFrames that :func:`materialize` writes inside, as they were
    planned: a query's own plan begins at the last table it has written."""
    tables: list[DataFrame] = []
    token = _WRITTEN.set(tables)
    try:
        yield tables
    finally:
        _WRITTEN.reset(token)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage before a fan-out.

    Operators that read their input twice (distinct probes + join back, the
    skew-safe LAG) would otherwise recompute every join above them once per
    branch.  The rows are written once as a Parquet table under the
    session's ``spark.checkpoint.dir`` (a shared folder on a cluster; set
    locally only when unset) and read back: both branches then scan files,
    columnar and compressed, and a lost executor does not replay the
    upstream joins.  Inside :func:`run_tables` the table goes when the run
    ends.
    """
    from quayside.context import ensure_checkpoint_dir

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quayside-tables/{uuid.uuid4().hex}"
    if _RUN_TABLES.get() is not None:
        _RUN_TABLES.get().append(path)
    if _WRITTEN.get() is not None:
        _WRITTEN.get().append(df)
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)
