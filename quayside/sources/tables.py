"""Table readers.

Sources are columnar Parquet read through ``spark.read``; projections and
filters written later in the plan reach the scan (``ReadSchema`` /
``PushedFilters``) because nothing here materialises or re-partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quayside.functions import lookback
from quayside.sources.buckets import is_bucketed, read_bucketed


def read_table(spark: SparkSession, base: str, name: str, schema: StructType | None = None) -> DataFrame:
    """Read ``{base}/{name}.parquet`` (a file or a folder of part files).

    With ``schema`` the files must hold all its columns: a renamed or missing
    column raises here instead of being read as NULL.  Columns that the
    schema does not name are left out, but for the folder column of a table
    stored by year (:func:`write_by_year`)."""
    path = f"{base.rstrip('/')}/{name}.parquet"
    if schema is None:
        return spark.read.parquet(path)
    if is_bucketed(spark, path):
        stored = read_bucketed(spark, path)
        wrong = [f.name for f in schema.fields if f.name not in stored.columns or stored.schema[f.name].dataType != f.dataType]
        if wrong:
            raise ValueError(f"{path} lacks declared columns, or has others under their names: {', '.join(wrong)}")
        return stored.select(*[f.name for f in schema.fields])
    missing = [f.name for f in schema.fields if f.name not in set(spark.read.parquet(path).columns)]
    if missing:
        raise ValueError(f"{path} lacks declared columns: {', '.join(missing)}")
    return spark.read.schema(schema).parquet(path)


def year_column(date: str) -> str:
    """Name of the folder column of a table stored by the year of ``date``."""
    return f"_{date}_year"


def write_by_year(df: DataFrame, path: str, date: str, mode: str = "error") -> None:
    """Store a table in one folder per calendar year of ``date``, so that a
    window opens the folders of its own years only; rows without a date have a
    folder of their own.  Years are split or joined to files of like size, and
    rows lie in the order of ``date``, so that within the window's first year
    row groups before it are skipped too."""
    year = year_column(date)
    rows = df.withColumn(year, F.year(date)).hint("rebalance", year)
    rows.sortWithinPartitions(year, date).write.mode(mode).partitionBy(year).parquet(path)


def from_date(df: DataFrame, date: str, cutoff) -> DataFrame:
    """Rows whose ``date`` is not before ``cutoff``; a table stored by year is
    opened from the cutoff's year on only."""
    keep = lookback(date, cutoff)
    year = year_column(date)
    if year not in df.columns:
        return df.where(keep)
    return df.where(keep & (F.col(year) >= F.lit(cutoff.year))).drop(year)


class TableSet:
    """Lazy, memoised access to the tables of one folder: ``ts.orders``."""

    def __init__(self, spark: SparkSession, base: str, schemas: dict | None = None):
        self._spark = spark
        self._base = base
        self._schemas = schemas or {}
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self._spark, self._base, name, self._schemas.get(name))
        return self._cache[name]

    @property
    def spark(self) -> SparkSession:
        return self._spark


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Ingest rule: an empty string is NULL in the source dialect, so every
    text column maps '' to NULL once, at read time (a projection; it stays in
    the scan's codegen stage)."""
    from pyspark.sql.types import StringType

    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, StringType):
            c = F.when(c == F.lit(""), F.lit(None).cast("string")).otherwise(c).alias(f.name)
        cols.append(c)
    return df.select(*cols)
