"""Packing documents into fixed-width sequences: shortest pack first over the
histogram of lengths.

A document's ids and its end id are cut into pieces of ``width`` and a rest.
Only the histogram of piece lengths (at most ``width`` rows) comes to the
driver.  Lengths are placed longest first, always into the open packing
pattern with most space left, splitting a pattern's count when fewer pieces
remain; if none has space, new patterns open, filled with that length.  Every
pattern slot then owns a range of ranks of its length, and pieces join the
slots by (length, rank).

Ranks come from row numbers inside (write partition, length) plus the counts
of earlier partitions, so the commonest length is never ranked in one task.

Defined cases: a null text is empty and yields one piece, its end id; repeated
rows are packed like any other; pieces of one length are ranked in any order, and
any order packs as well; a very long text is cut into as many pieces as it needs;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.byte_tokens import encoder
from quayside.llm.common import materialize, ship, text_of

WIDTH = 1024
DOCS_AT_ONCE = 256


def _columns(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """(first column, texts) in short runs, so that few texts are unpacked at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, DOCS_AT_ONCE):
            part = batch.slice(at, DOCS_AT_ONCE)
            yield part.column(0), part.column(1).to_pylist()


def pieces(docs: DataFrame, path: str, end_id: int = 0, width: int = WIDTH, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of every piece; on request
    ``ids``, its little-endian unsigned 32-bit ids."""
    ship(docs.sparkSession)
    end = int(end_id).to_bytes(4, "little")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for doc_ids, texts in _columns(batches):
            row, start, length, crc, total, held = [], [], [], [], [], []
            for i, body in enumerate(enc.encode(texts)):
                body += end
                n = len(body) // 4
                for at in range(0, n, width):
                    part = body[4 * at:4 * (at + width)]
                    row.append(i)
                    start.append(at)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(n)
                    if with_ids:
                        held.append(part)
            made = [doc_ids.take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
            yield pa.RecordBatch.from_arrays(made + [pa.array(held, pa.binary())] * with_ids, names=names)

    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(cut, schema)


def pack_histogram(histogram: dict[int, int], width: int = WIDTH) -> list[tuple[int, tuple[int, ...]]]:
    """Packing patterns (how often, lengths) that use every piece once."""
    by_space: dict[int, list[tuple[int, tuple[int, ...]]]] = {}

    def put(count: int, lengths: tuple[int, ...], space: int) -> None:
        by_space.setdefault(space, []).append((count, lengths))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            space = max(by_space, default=0)
            if space >= length:
                count, lengths = by_space[space].pop()
                if not by_space[space]:
                    del by_space[space]
                used = min(count, left)
                if count > used:
                    put(count - used, lengths, space)
                put(used, (*lengths, length), space - length)
                left -= used
            else:
                each = min(width // length, left)
                packs = left // each
                put(packs, (length,) * each, width - each * length)
                left -= packs * each
    return [x for space in sorted(by_space) for x in by_space[space]]


def slots(patterns: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset) of every pattern slot."""
    rank: dict[int, int] = {}
    out, sequence = [], 0
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            first = rank.get(length, 0)
            rank[length] = first + count
            out.append((length, first, first + count, sequence, offset))
            offset += length
        sequence += count
    return out


def place(cut: DataFrame, width: int = WIDTH) -> DataFrame:
    """``cut`` (written pieces, with their write partition ``part``) with
    ``sequence_id`` and ``offset``."""
    spark = cut.sparkSession
    counts = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = slots(pack_histogram(histogram, width))
    owner = spark.createDataFrame(
        [tuple(map(int, x)) for x in table], "s_length long, first long, end long, first_sequence long, offset long")
    before = Window.partitionBy("length").orderBy("part")
    starts = counts.select(F.col("part").alias("b_part"), F.col("length").alias("b_length"),
                           (F.sum("n").over(before) - F.col("n")).alias("before"))
    inside = Window.partitionBy("part", "length").orderBy("doc_id", "start", "ids_crc32")
    ranked = (cut.withColumn("i", F.row_number().over(inside) - 1)
              .join(starts, (F.col("part") == F.col("b_part")) & (F.col("length") == F.col("b_length")))
              .withColumn("rank", F.col("i") + F.col("before")))
    if len(table) <= 100_000:   # few patterns, whatever the corpus: lengths are at most ``width``
        owner = F.broadcast(owner)
    return (ranked.join(owner, (F.col("length") == F.col("s_length")) & (F.col("rank") >= F.col("first"))
                        & (F.col("rank") < F.col("end")))
            .withColumn("sequence_id", F.col("first_sequence") + F.col("rank") - F.col("first"))
            .drop("part", "i", "b_part", "b_length", "before", "rank", "s_length", "first", "end", "first_sequence"))


def pack(docs: DataFrame, path: str, end_id: int = 0, width: int = WIDTH, with_ids: bool = False) -> DataFrame:
    """One row per piece: its document, place there, sequence and offset."""
    cut = materialize(pieces(docs, path, end_id, width, with_ids).withColumn("part", F.spark_partition_id()))
    return place(cut, width)
