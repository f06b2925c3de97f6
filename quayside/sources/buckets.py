"""Tables stored in buckets of their join key.

Logbook documents, images and catch (and phone trips, reports and landings)
grow without end and are joined on the same keys in every run.  Stored in
buckets of the key, sorted by it, each join reads them as they lie: no
exchange, and no sort where a bucket is one file.  The bucket layout belongs to
the table, so a bucketed table is registered in the session's catalog; the
folder carries the layout in a small file, so that any later session can
register it again.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.sources.files import Files

LAYOUT = "_layout.json"

# How the big sources are joined.
JOIN_KEYS = {
    "document": "docid", "images": "docid", "catch": "imgid",
    "ivr_trip": "rsa_tripid", "ivr_report": "rsa_tripid", "ivr_landing": "rsa_trip_reportid",
}


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Store ``df`` in ``buckets`` buckets of ``key`` and read it back.

    Take at least as many buckets as a join has shuffle partitions (Spark
    prefers the wider side's layout), and small enough ones to sort in memory.
    One file a bucket: rows are dealt by the bucket's own hash before the write.
    Rows with a NULL key, which no inner join matches, all lie in one bucket.
    """
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, F.col(key))
    dealt.write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")   # the files stay; readers register them
    Files(spark, path).write_text(f"{path.rstrip('/')}/{LAYOUT}", json.dumps(
        {"key": key, "buckets": buckets, "schema": df.schema.jsonValue()}))
    return read_bucketed(spark, path)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The table in its layout; joins and groupings on its key need no exchange."""
    from pyspark.sql.types import StructType

    layout = json.loads(Files(spark, path).read_text(f"{path.rstrip('/')}/{LAYOUT}"))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(layout["schema"]).fields)
    name = f"bucketed_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{layout['key']}`) SORTED BY (`{layout['key']}`) "
              f"INTO {layout['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def is_bucketed(spark: SparkSession, path: str) -> bool:
    return Files(spark, path).exists(f"{path.rstrip('/')}/{LAYOUT}")
