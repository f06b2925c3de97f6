"""Token files: ids of documents in ascending doc_id order, range coded.

The documents are range partitioned and sorted by doc_id; each write task
packs whole documents into segments and codes them (``range_coder``: blocks
that are reset and checksummed one by one).  A row of the written Parquet
table is a segment: its part and number, its documents' ids and lengths, and
the coded bytes, so Spark's commit protocol guards the files and any number of
tasks can read them back.  A document's start follows from the lengths: sums
inside the segment, over the segments of a part, and over the parts.

Defined cases: null text is empty and holds the end id alone; a null doc_id
comes first; repeated rows follow each other (rows of one doc_id in any order); a
document longer than a segment has one of its own; an empty table has no segment;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.byte_tokens import encoder
from quayside.llm.common import ship, text_of
from quayside.llm.range_coder import BLOCK, LANES, decode, encode

SEGMENT = BLOCK * LANES
DOCS_AT_ONCE = 256


def write(docs: DataFrame, path: str, folder: str, end_id: int, vocabulary: int) -> None:
    """Write the token table of ``docs`` to ``folder``."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    end = int(end_id).to_bytes(4, "little")
    names = ["part", "segment", "doc_ids", "lengths", "n_tokens", "coded"]

    def coded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, segment = encoder(path), TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        doc_ids: list = []
        size = 0

        def row() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            return pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([segment]), pa.array([doc_ids], pa.list_(pa.int64() if kind == "bigint" else None)),
                 pa.array([[len(h) // 4 for h in held]], pa.list_(pa.int64())), pa.array([len(ids)], pa.int64()),
                 pa.array([encode(ids, vocabulary)], pa.binary())], names=names)

        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                some = batch.slice(at, DOCS_AT_ONCE)
                for doc_id, ids in zip(some.column(0).to_pylist(), enc.encode(some.column(1).to_pylist()), strict=True):
                    if held and size + len(ids) // 4 + 1 > SEGMENT:
                        yield row()
                        held, doc_ids, size, segment = [], [], 0, segment + 1
                    held.append(ids + end)
                    doc_ids.append(doc_id)
                    size += len(held[-1]) // 4
        if held:
            yield row()

    text = text_of()
    ordered = (docs.select("doc_id", text.alias("text")).repartitionByRange(F.col("doc_id"), F.xxhash64("text"))
               .sortWithinPartitions("doc_id", F.xxhash64("text")))
    schema = f"part long, segment long, doc_ids array<{kind}>, lengths array<long>, n_tokens long, coded binary"
    ordered.mapInArrow(coded, schema).write.option("compression", "uncompressed").parquet(folder)


def read(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the coded ids."""
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    names = ["part", "segment", "doc_id", "place", "n_tokens", "ids_crc32"]

    def opened(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, segment, doc_ids, lengths, coded = (batch.column(c)[i] for c in ("part", "segment", "doc_ids", "lengths", "coded"))
                body = decode(coded.as_py()).astype("<u4").tobytes()
                n = np.array(lengths.as_py(), np.int64)
                end = np.cumsum(n)
                if len(body) != 4 * end[-1]:
                    raise ValueError("a segment's documents and its ids differ in length")
                crc = [zlib.crc32(body[4 * a:4 * b]) for a, b in zip((end - n).tolist(), end.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * len(n)), pa.array([segment.as_py()] * len(n)), doc_ids.values,
                     pa.array(end - n), pa.array(n), pa.array(crc, pa.int64())], names=names)

    docs = files.select("part", "segment", "doc_ids", "lengths", "coded").mapInArrow(
        opened, f"part long, segment long, doc_id {kind}, place long, n_tokens long, ids_crc32 long")
    sizes = files.select("part", "segment", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("segment")) - F.col("n_tokens")
    starts = sizes.withColumn("inside", inside).join(before, "part").select("part", "segment", (F.col("inside") + F.col("before")).alias("offset"))
    return docs.join(starts, ["part", "segment"]).select(
        "doc_id", (F.col("offset") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
