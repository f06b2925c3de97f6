"""Shared expressions of the corpus operators.

Null texts count as empty texts everywhere; words are maximal runs of
characters other than space and TAB..CR.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.maintenance import materialize

__all__ = ["SPACE", "SPACES", "documents", "let", "lower_ascii", "materialize", "ship", "text_of", "words"]

SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """All words of a text, in order."""
    return F.array_remove(F.split(text, SPACES), "")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, _UPPER, _UPPER.lower())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A lambda body evaluates its free expressions once per element; binding
    the value as a lambda variable keeps array passes linear.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package (once per application), so that Python
    functions find it wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    name = f"{tempfile.mkdtemp(prefix='quayside-')}/quayside_llm.zip"
    with zipfile.ZipFile(name, "w") as z:
        for f in sorted((root / "quayside").rglob("*.py")):
            z.write(f, f.relative_to(root))
    sc.addPyFile(name)
    _shipped.add(sc.applicationId)
