"""SimHash near-dedup: byte-position inverted index with count filtering.

A fingerprint has 8 bytes; two that differ in at most ``4`` bits share the
bytes of at least 4 positions.  Distinct fingerprints are filed in a
positional byte index.  Lists of single bytes would hold a 256th of all
fingerprints each, so a list is kept for every 4 positions at once (70 lists
a fingerprint, a list for each of 2^32 values): a pair that shares 4 positions
meets in at least one.  For each pair the shared positional bytes are tallied,
pairs below the guaranteed 4 go, and the bits are compared.  A pair counts in
the first list it shares only.

Equal fingerprints are one row from the start.  A long list gives the edges of
a spanning forest, not all of its pairs, and stops as soon as it is one
component.  Components come from alternating large and small stars over
written edge tables.

Defined cases: null text is empty; a text without words has fingerprint zero
and is linked like any other; a null doc_id is never a component's smallest
unless all are null; repeated rows each appear; texts of any length are taken whole;
an empty table gives no rows; other columns are ignored.
Of each group one row stays, whatever ids it has; rows are told apart by their
doc_id and a 64-bit hash of all columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import materialize, ship, text_of

SHINGLE = 4
MAX_BITS = 4
SEED = 42
LONG_LIST = 64
DOCS_AT_ONCE = 256


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the lower-cased (A-Z) words' shingles."""
    words = text.encode().lower().split()
    n = len(words) - shingle + 1
    if not words:
        return 0
    joined = b" ".join(words)
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    end = np.cumsum(size) - 1
    first, last = (end - size + 1)[:n].tolist(), end[shingle - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first, last, strict=True)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 4096):
        ones += np.unpackbits(h[at:at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, ``fp``, the fingerprint as a signed long, and ``row``, a hash of the whole row."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(at, DOCS_AT_ONCE)
                fps = np.array([fingerprint(t.as_py(), shingle) for t in part.column(1)], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps), part.column(2)], names=["doc_id", "fp", "row"])

    return (docs.select("doc_id", text_of().alias("text"), F.xxhash64(F.struct("*")).alias("row"))
            .mapInArrow(hashed, f"doc_id {kind}, fp long, row long"))


def _sets(max_bits: int) -> np.ndarray:
    """The sets of byte positions that a pair must share one of."""
    return np.array(list(combinations(range(8), 8 - max_bits)), np.int64)


def _first_set(sets: np.ndarray) -> np.ndarray:
    """For each 8-bit mask of shared positions the first set inside it, else -1."""
    masks = (1 << sets).sum(axis=1)
    inside = (np.arange(256)[:, None] & masks) == masks
    return np.where(inside.any(axis=1), inside.argmax(axis=1), -1)


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Mask of the byte positions that the pairs share."""
    same = (a ^ b).view(np.uint8).reshape(-1, 8) == 0
    return np.packbits(same, axis=1, bitorder="little").ravel()


def _long_list(fp: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges of a spanning forest of one list's links."""
    label = np.arange(len(fp))
    for d in range(1, len(fp)):
        a, b = np.arange(len(fp) - d), np.arange(d, len(fp))
        near = (np.bitwise_count(fp[a] ^ fp[b]) <= max_bits) & (label[a] != label[b])
        if near.any():
            a, b = a[near], b[near]
            yield fp[a], fp[b]
            while True:   # join the labels that these edges connect
                low = np.minimum(label[a], label[b])
                root = np.arange(len(fp))
                np.minimum.at(root, label[a], low)
                np.minimum.at(root, label[b], low)
                new = root[label]
                if (new == label).all():
                    break
                label = new
            if not label.any():
                return


def _links(key: np.ndarray, fp: np.ndarray, first_set: np.ndarray, max_bits: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified pairs of lists that are whole, sorted by key."""
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(starts, len(key)))
    for s, n in zip(starts[size > LONG_LIST], size[size > LONG_LIST], strict=True):
        yield from _long_list(fp[s:s + n], max_bits)
    some = (size > 1) & (size <= LONG_LIST)
    starts, size = starts[some], size[some]
    end = np.repeat(starts + size, size)
    at = end - size.repeat(size) + np.arange(len(end)) - np.repeat(np.cumsum(size) - size, size) if len(end) else end
    for d in range(1, int(size.max(initial=1))):
        i = at[at + d < end]
        a, b = fp[i], fp[i + d]
        mask = _shared(a, b)
        good = (np.bitwise_count(mask) >= least) & (first_set[mask] == (key[i] >> 32)) & (np.bitwise_count(a ^ b) <= max_bits)
        yield a[good], b[good]


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links that connect the same fingerprints as all links do."""
    ship(distinct.sparkSession)
    sets, least = _sets(max_bits), 8 - max_bits
    first_set = _first_set(sets)

    def filed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fp = batch.column(0).slice(at, 4096).to_numpy(zero_copy_only=False)
                part = fp.view(np.uint8).reshape(-1, 8)[:, sets]             # fingerprint, list, position
                value = np.zeros(part.shape[:2], np.int64)
                for i in range(sets.shape[1]):
                    value = (value << 8) | part[:, :, i]
                key = value | (np.arange(len(sets), dtype=np.int64) << 32)
                yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(np.repeat(fp, len(sets)))], names=["key", "fp"])

    def met(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_fp = np.empty(0, np.int64), np.empty(0, np.int64)
        waiting, n = [], 0

        def out(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            if len(key) > 1:
                for a, b in _links(key, fp.view(np.uint64), first_set, max_bits, least):
                    if len(a):
                        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:   # a list may go on in the next batch
            waiting.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            n += batch.num_rows
            if n < 200_000 or waiting[0][0][0] == waiting[-1][0][-1]:
                continue
            key, fp = (np.concatenate(x) for x in zip(*waiting, strict=True))
            whole = int(np.searchsorted(key, key[-1]))
            yield from out(key[:whole], fp[:whole])
            waiting, n = [(key[whole:], fp[whole:])], len(key) - whole
        if waiting:
            yield from out(*(np.concatenate(x) for x in zip(*waiting, strict=True)))

    return (distinct.select("fp").mapInArrow(filed, "key long, fp long").repartition("key")
            .sortWithinPartitions("key", "fp").mapInArrow(met, "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's component, for nodes with edges."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        seen = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else e
        low = seen.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
        met = seen.join(low, F.col("a") == F.col("c"))
        if large:
            new = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            new = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select(F.col("c").alias("a"), F.col("m").alias("b")))
        return new.where("a > b").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct())
    before = state(now)
    while before[0]:
        now = materialize(star(star(now, large=True), large=False))
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _grouped(docs: DataFrame, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`fingerprints`, and (fp, least, root) of every fingerprint."""
    rows = materialize(fingerprints(docs, shingle))
    groups = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(groups, max_bits))
    rooted = groups.join(roots, groups["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    return rows, materialize(rooted)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of every row."""
    rows, rooted = _grouped(docs, shingle, max_bits)
    low = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(low, "root").select(F.col("fp").alias("f"), "component_id")
    return (rows.join(named, F.col("fp") == F.col("f"))
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def representatives(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each group (its smallest doc_id), with the columns of ``docs``.

    A group is told by its root fingerprint, as doc_ids may be null or repeat.
    """
    rows, rooted = _grouped(docs, shingle, max_bits)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", "row"))
    each = rows.groupBy("fp").agg(first.alias("low")).join(rooted.select(F.col("fp").alias("f"), "root"), F.col("fp") == F.col("f"))
    stay = each.groupBy("root").agg(F.min("low").alias("low")).select(F.col("low.doc_id").alias("c"), F.col("low.row").alias("r"))
    same = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("d"), F.xxhash64(F.struct("*")).alias("h"))
    copies = Window.partitionBy("d", "h").orderBy("h")
    return (same.join(stay, F.col("d").eqNullSafe(F.col("c")) & (F.col("h") == F.col("r")))
            .withColumn("i", F.row_number().over(copies)).where("i = 1").select("row.*"))
