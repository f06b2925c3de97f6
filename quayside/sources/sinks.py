"""Staged writes, publish, clean-up, run log.

Every target of a run is first written under
``_staging/run=<seq>/attempt=<id>/<table>`` in the warehouse (a shared folder
on a cluster); the attempt id is new for every :class:`Stage`, so running a
run id again never touches files that readers use.  Reading a staged table
back cuts the lineage: a later step, or a retried task after a lost
executor, restarts from files, not from the sources.

Only when all tables of the run are written does :meth:`Stage.publish` add
one pointer set, a folder ``_published/publish=<n>`` that is claimed by
creating a file in it and counts from its ``_SUCCESS`` mark on.  A writer
that dies in between leaves a folder without a mark: readers pass over it
and the next writer takes the next number.  A pointer set names the tables
of its own run only, and a reader takes each table from the newest set that
names it, so two publishers never undo each other.  Pointer files are never
rewritten, and a reader never sees a half-refreshed set (the source truncated
and committed table by table and swallowed errors).

:func:`clean` deletes what nobody needs any more: attempts that no current
pointer names, once they are old enough (by their newest file if they were
never published, by the publish that replaced them if they were) and no
unexpired :func:`pinned` reader holds them.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quayside.operators.lookup import difference
from quayside.sources.files import Files
from quayside.sources.tables import from_date, year_column, write_by_year

POINTER = "_published"
STAGING = "_staging"
READERS = "_readers"
RUN_LOG = "_run_log"
DONE = "_SUCCESS"
KEEP = dt.timedelta(days=7)
_POINTER_SCHEMA = "table string, run_seq bigint, path string"


class Stage:
    def __init__(self, spark: SparkSession, warehouse: str, run_seq: int):
        self.spark = spark
        self.warehouse = warehouse.rstrip("/")
        self.run_seq = run_seq
        self.attempt = uuid.uuid4().hex
        self.paths: dict[str, str] = {}
        self.counts: dict[str, int] = {}
        self.changes: dict[str, dict[str, int]] = {}
        self.published: int | None = None

    def path(self, table: str) -> str:
        return f"{self.warehouse}/_staging/run={self.run_seq}/attempt={self.attempt}/{table}"

    def write(self, table: str, df: DataFrame, by_year: str | None = None) -> DataFrame:
        """Write ``df`` (one pass; its row count observed on the way) and
        return the written table.  ``by_year`` names a date column by whose
        year the table is stored (:func:`write_by_year`)."""
        obs = Observation(f"rows_{table}")
        observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        path = self.path(table)
        if by_year:
            write_by_year(observed, path, by_year)
        else:
            observed.write.mode("error").parquet(path)
        self.paths[table] = path
        self.counts[table] = int(obs.get["rows"])
        written = self.spark.read.parquet(path)
        return written.drop(year_column(by_year)) if by_year else written

    def write_changes(self, table: str, df: DataFrame, keys: list[str] | None) -> DataFrame:
        """As :meth:`write`, for a support table that is unique on ``keys``: compared
        with its last published state, and not written again if no key is
        new, changed or gone.  ``changes`` holds the counts for the run log."""
        old = read_pointer(self.spark, self.warehouse) if keys else None
        row = old.where(F.col("table") == table).select("path").first() if old is not None else None
        if row is None:
            out = self.write(table, df)
            self.changes[table] = {"new": self.counts[table], "changed": 0, "gone": 0}
            return out
        before = self.spark.read.parquet(row["path"])
        self.changes[table] = difference(before, df, keys)
        if any(self.changes[table].values()):
            return self.write(table, df)
        self.paths[table] = row["path"]   # published again as it is
        return before

    def publish(self) -> None:
        """Make this run's tables the current ones (as ``published``, the publish's number)."""
        files = Files(self.spark, self.warehouse)
        gone = [t for t, p in self.paths.items() if not files.exists(p)]
        if gone:
            raise FileNotFoundError(f"staged tables are no longer there: {', '.join(sorted(gone))}")
        number = 1 + max(_numbers(files, self.warehouse), default=0)
        while not files.claim(f"{self.warehouse}/{POINTER}/publish={number}/_claim"):
            number += 1   # another publisher was faster
        folder = f"{self.warehouse}/{POINTER}/publish={number}"
        rows = [(t, self.run_seq, p) for t, p in sorted(self.paths.items())]
        # a few rows; into the claimed folder, which no other writer enters
        self.spark.createDataFrame(rows, _POINTER_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        if not files.exists(f"{folder}/{DONE}"):   # committers may be set to leave none
            files.claim(f"{folder}/{DONE}")
        self.published = number


def _numbers(files: Files, warehouse: str) -> list[int]:
    """Numbers of all publish folders, finished or not."""
    names = (n.removeprefix("publish=") for n in files.names(f"{warehouse.rstrip('/')}/{POINTER}"))
    return [int(n) for n in names if n.isdigit()]


def _pointer_sets(spark: SparkSession, warehouse: str) -> DataFrame | None:
    """(publish, table, run_seq, path) of the finished publishes."""
    base = f"{warehouse.rstrip('/')}/{POINTER}"
    files = Files(spark, warehouse)
    done = [f"{base}/publish={n}" for n in sorted(_numbers(files, warehouse)) if files.exists(f"{base}/publish={n}/{DONE}")]
    if not done:
        return None   # nothing published yet
    return spark.read.option("basePath", base).schema(f"{_POINTER_SCHEMA}, publish int").parquet(*done)


def read_pointer(spark: SparkSession, warehouse: str) -> DataFrame | None:
    """(table, run_seq, path): for each table the newest finished publish of it."""
    sets = _pointer_sets(spark, warehouse)
    if sets is None:
        return None
    newest = sets.groupBy("table").agg(F.max(F.struct("publish", "run_seq", "path")).alias("p"))
    return newest.select("table", "p.run_seq", "p.path")


def read_published(spark: SparkSession, warehouse: str, table: str, *, date: str | None = None,
                   since: dt.datetime | None = None) -> DataFrame:
    """The published table; with ``date`` and ``since`` its rows from that instant
    on, of which a table stored by the year of ``date`` opens the years' folders
    only."""
    ptr = read_pointer(spark, warehouse)
    if ptr is None:
        raise FileNotFoundError(f"nothing published in {warehouse}")
    row = ptr.where(F.col("table") == table).select("path").first()
    if row is None:
        raise KeyError(table)
    df = spark.read.parquet(row["path"])
    if since is not None:
        df = from_date(df, date, since)
    return df.drop(*[c for c in df.columns if c == year_column(c.removeprefix("_").removesuffix("_year"))])


@contextmanager
def pinned(spark: SparkSession, warehouse: str, lasts: dt.timedelta = dt.timedelta(days=1)) -> Iterator[dict[str, DataFrame]]:
    """The published tables by name, kept from :func:`clean` while the block
    runs, ``lasts`` at most (so that a dead reader holds nothing for ever)."""
    files, base = Files(spark, warehouse), f"{warehouse.rstrip('/')}/{READERS}"
    lease = f"{base}/{uuid.uuid4().hex}"
    try:
        while True:
            pointers = {r["table"]: r["path"] for r in (read_pointer(spark, warehouse) or spark.createDataFrame([], _POINTER_SCHEMA)).collect()}
            until = _millis(dt.datetime.now(dt.timezone.utc) + lasts)
            files.write_text(lease, json.dumps({"until": until, "paths": sorted(pointers.values())}))
            if all(files.exists(p) for p in pointers.values()):
                break   # else replaced and cleaned before the pin was written: look again
        yield {t: spark.read.parquet(p) for t, p in pointers.items()}
    finally:
        files.delete(lease)


def clean(spark: SparkSession, warehouse: str, older_than: dt.timedelta = KEEP, now: dt.datetime | None = None) -> list[str]:
    """Delete attempts and pointer sets that are out of use; the deleted paths.

    ``older_than`` must exceed the longest run and the longest read that is not
    :func:`pinned`.  Safe to interrupt and to repeat.
    """
    warehouse = warehouse.rstrip("/")
    files = Files(spark, warehouse)
    border = _millis((now or dt.datetime.now(dt.timezone.utc)) - older_than)
    base = f"{warehouse}/{POINTER}"
    finished = {n: files.modified(f"{base}/publish={n}/{DONE}") for n in _numbers(files, warehouse)
                if files.exists(f"{base}/publish={n}/{DONE}")}
    sets = _pointer_sets(spark, warehouse)
    # a few rows a publish; (publish, table) -> attempt
    named = [(r["publish"], r["table"], _attempt(r["path"])) for r in sets.collect()] if sets is not None else []
    by_table: dict[str, list[tuple[int, str]]] = {}
    for n, table, attempt in sorted(named):
        by_table.setdefault(table, []).append((n, attempt))
    in_use: set[str] = set()      # current, or replaced only lately
    needed: set[int] = set()
    for steps in by_table.values():
        for (n, attempt), after in zip(steps, [*steps[1:], None]):
            if after is None or finished[after[0]] > border:
                in_use.add(attempt)
                needed.add(n)
    for name in files.names(f"{warehouse}/{READERS}"):
        lease = json.loads(files.read_text(f"{warehouse}/{READERS}/{name}") or '{"until": 0, "paths": []}')
        if lease["until"] > _millis(now or dt.datetime.now(dt.timezone.utc)):
            in_use |= {_attempt(p) for p in lease["paths"]}
    once = {attempt for _, _, attempt in named}
    gone = []
    for run in files.names(f"{warehouse}/{STAGING}"):
        attempts = files.names(f"{warehouse}/{STAGING}/{run}")
        old = [a for a in attempts if f"{run}/{a}" not in in_use and (
            f"{run}/{a}" in once or files.modified(f"{warehouse}/{STAGING}/{run}/{a}") <= border)]
        gone += [f"{warehouse}/{STAGING}/{run}/{a}" for a in old]
        if len(old) == len(attempts) and files.modified(f"{warehouse}/{STAGING}/{run}") <= border:
            gone.append(f"{warehouse}/{STAGING}/{run}")
    newest = max(_numbers(files, warehouse), default=0)   # stays, so that no number is taken twice
    for n in _numbers(files, warehouse):
        if n not in needed and n != newest and files.modified(f"{base}/publish={n}") <= border:
            gone.append(f"{base}/publish={n}")
    for path in gone:
        files.delete(path)
    return gone


def _attempt(path: str) -> str:
    """``run=<seq>/attempt=<id>`` of a staged table's path."""
    return "/".join(path.rstrip("/").split("/")[-3:-1])


def _millis(t: dt.datetime) -> int:
    return int((t if t.tzinfo else t.replace(tzinfo=dt.timezone.utc)).timestamp() * 1000)


class RunLog:
    """Append-only run events: START, SUCCESS (with row counts), FAILED."""

    def __init__(self, spark: SparkSession, warehouse: str):
        self.spark = spark
        self.path = f"{warehouse.rstrip('/')}/{RUN_LOG}"

    def event(self, run_seq: int, status: str, message: str, counts: dict | None = None) -> None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        row = [(int(run_seq), status, message, json.dumps(counts or {}, sort_keys=True), now)]
        df = self.spark.createDataFrame(row, "run_seq bigint, status string, message string, counts string, "
                                             "logged_at timestamp_ntz")
        df.coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)
