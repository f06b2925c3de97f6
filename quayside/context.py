"""Run context and session settings.

The source procedure reads the wall clock many times per row.  Here the clock is
frozen once per run in :class:`RunContext` and enters every plan as a
literal, so a retried task or a re-run with the same context gives the same
rows.
"""

from __future__ import annotations

import datetime as _dt
import os
from dataclasses import dataclass, field

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Settings every session of this engine wants.  They are applied by
# build_session(); library code never mutates a session it was handed.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # PySpark 4 records the Python call site of every Column call for error
    # messages; plan construction of the wide feed projections pays for it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app: str = "quayside",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the engine's settings.

    On a cluster ``master`` stays ``None`` and the submitter decides.
    ``spark.checkpoint.dir`` is only set when the cluster did not name one
    (tests and local runs); a cluster's shared folder always wins.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in SESSION_SETTINGS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the session's checkpoint folder, setting one only if unset."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        # On a cluster a checkpoint must live in a shared folder every
        # executor can read; a machine-local folder would lose it.
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for cluster runs")
    path = fallback or os.environ.get("QUAYSIDE_LOCAL_CHECKPOINT_DIR")
    if not path:
        import tempfile
        path = tempfile.mkdtemp(prefix="quayside-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def ntz(value: _dt.datetime | _dt.date | str) -> Column:
    """A TIMESTAMP_NTZ literal, independent of the session time zone.

    Python ``datetime`` literals become session-zone TIMESTAMPs in PySpark;
    the feeds compare against wall-clock NTZ columns, so every constant goes
    through this helper instead.
    """
    if isinstance(value, _dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        text = value.strftime("%Y-%m-%d 00:00:00")
    else:
        text = str(value)
    return F.expr(f"TIMESTAMP_NTZ'{text}'")


@dataclass(frozen=True)
class RunContext:
    """Frozen per-run values: the run id and the run clock.

    ``as_of`` replaces every wall-clock read of the source procedure; the lookback
    windows are whole days counted back from the day of ``as_of``.
    """

    run_seq: int
    as_of: _dt.datetime
    lookback_days: dict = field(default_factory=lambda: dict(LOOKBACK_DAYS))

    def cutoff(self, days: int) -> _dt.datetime:
        """First instant kept by a ``day(x) >= day(as_of) - days`` window."""
        day = _dt.datetime(self.as_of.year, self.as_of.month, self.as_of.day)
        return day - _dt.timedelta(days=days)

    def cutoff_for(self, feed: str) -> _dt.datetime:
        return self.cutoff(self.lookback_days[feed])

    def as_of_lit(self) -> Column:
        return ntz(self.as_of)

    def run_date_text(self) -> Column:
        """Run date as ``DD-MON-YY`` text (upper-case month)."""
        return F.lit(self.as_of.strftime("%d-%b-%y").upper())


# Rolling windows per feed, in days (kept as settings; two
# feeds use 720 and four use 730 in the source procedure).
LOOKBACK_DAYS = {
    "ams": 730,
    "dealer": 730,
    "vessel": 730,
    "ivr": 720,
    "vms_end": 720,
    "vms_start": 720,
}
