"""Super-k-mers: the windows of a sequence, dealt out by minimiser.

A window's minimiser is the smallest hash among its grams.  Consecutive windows
with the minimiser at one place travel as one packed string (a super-k-mer)
to the minimiser's bucket, so equal windows always meet, and a string carries
far less than its windows.  Equal windows never lie in one super-k-mer.

Steps: ``common_minimisers`` finds, from bounded counter summaries, the
minimisers held by very many super-k-mers; ``deal`` sends all others to
buckets of bounded size, as compressed Arrow blobs, and ``in_buckets`` calls
an operator's comparison there; ``hot_windows`` sends the windows of common
minimisers one by one, by 128-bit window hash, for skew-safe aggregation.
All return runs of windows (none, doc_id, text_key, start, length), which
``gather`` joins back to the documents.

A document is its doc_id, an integer, and a 64-bit hash of its text: repeated
rows are one document for the join, unlike texts under one doc_id are not.  Rows
without doc_id (``none``) carry a second 64-bit hash of the text in its place.
Null texts are empty; documents shorter than a window have none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from zstandard import ZstdCompressor

from quayside.llm.common import materialize, ship, text_of

#: super-k-mers of a minimiser beyond which its windows are dealt one by one
COMMON = 150_000
#: counters of a task's summary: a count is short by 1/COUNTERS of the task's rows at most
COUNTERS = 1 << 17
BUCKET_ROWS = 100_000
CHUNK = 1 << 19
HELD = 1 << 23
ID = ["none", "doc_id", "text_key"]
RUNS = "none boolean, doc_id long, text_key long, start long, length long"
#: parts into which a common window's places are split by their documents
SALTS = 256
_A, _B = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


@dataclass(frozen=True)
class Units:
    """How an operator cuts texts: ``split`` gives the units' hashes and the
    place where each unit starts in the packed bytes."""
    window: int
    gram: int
    split: Callable[[list[str]], tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def joined_hash(h: np.ndarray, n: int, factor: int) -> np.ndarray:
    """Polynomial hash of every ``n`` consecutive hashes."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    out, covered, power = None, 0, h
    span, step = 1, factor
    while True:
        if n & span:
            if out is None:
                out, covered = power, span
            else:   # what is there already, then this span
                size = len(h) - covered - span + 1
                out = out[:size] * np.uint64(step) + power[covered:covered + size]
                covered += span
        if covered == n:
            return out
        power = power[:-span] * np.uint64(step) + power[span:] if len(power) > span else power[:0]
        step = step * step % (1 << 64)
        span *= 2


def sliding_min(g: np.ndarray, n: int) -> np.ndarray:
    span, low = 1, g
    while span * 2 <= n:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = n - span
    return np.minimum(low[:len(low) - rest], low[rest:]) if rest else low


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true flags."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def cut(h: np.ndarray, doc_end: np.ndarray, units: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Super-k-mers of concatenated documents: first window, windows, minimiser.
    ``doc_end`` holds for each unit where its document ends."""
    k = units.window
    windows = len(h) - k + 1
    if windows < 1:
        none = np.empty(0, np.int64)
        return none, none, none.astype(np.uint64)
    g = mixed(joined_hash(h, units.gram, _A))
    low = sliding_min(g, k - units.gram + 1)
    valid = np.arange(windows) + k <= doc_end[:windows]
    new = np.ones(windows, bool)
    new[1:] = (low[1:] != low[:-1]) | (g[:windows - 1] == low[:-1]) | (valid[1:] != valid[:-1]) | (doc_end[1:windows] != doc_end[:windows - 1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, windows))
    good = valid[first]
    return first[good], n[good], low[first[good]]


@dataclass
class Ids:
    """The documents' identities, one array a column."""
    none: np.ndarray
    doc: np.ndarray
    key: np.ndarray

    def take(self, at: np.ndarray) -> Ids:
        return Ids(self.none[at], self.doc[at], self.key[at])

    def arrays(self) -> list[pa.Array]:
        return [pa.array(self.none, pa.bool_()), pa.array(self.doc.astype(np.int64)), pa.array(self.key.astype(np.int64))]

    def unlike(self, other: Ids) -> np.ndarray:
        return (self.doc != other.doc) | (self.key != other.key) | (self.none != other.none)

    @classmethod
    def of(cls, table: pa.Table | pa.RecordBatch) -> Ids:
        return cls(*(table.column(c).to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch) else table.column(c).to_numpy() for c in ID))


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Ids, list[str]]]:
    """Identities and texts, about CHUNK characters at once."""
    for batch in batches:
        ids, texts = Ids.of(batch), batch.column("text")
        at = 0
        while at < batch.num_rows:
            part, size, end = [], 0, at
            while end < batch.num_rows and size < CHUNK:
                part.append(texts[end].as_py())
                size += len(part[-1])
                end += 1
            yield ids.take(np.arange(at, end)), part
            at = end


def keyed(docs: DataFrame) -> DataFrame:
    """none, doc_id, text_key, text."""
    kind = docs.schema["doc_id"].dataType
    if not isinstance(kind, IntegralType):
        raise TypeError(f"doc_id is {kind.simpleString()}; documents are ordered by integers")
    return docs.select(F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.lit(1), text_of())).alias("doc_id"),
                       F.xxhash64(text_of()).alias("text_key"), text_of().alias("text"))


def common_minimisers(docs: DataFrame, units: Units, common: int) -> tuple[np.ndarray, int]:
    """Minimisers of more than ``common`` super-k-mers, and how many super-k-mers
    there are.  At most ``super-k-mers / common`` come to the driver."""
    def summary(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value, count, total = np.empty(0, np.uint64), np.empty(0, np.int64), 0
        for _, texts in _chunks(batches):
            _, h, _, _, doc_end = units.split(texts)
            m = cut(h, doc_end, units)[2]
            total += len(m)
            v, c = np.unique(m, return_counts=True)
            value, back = np.unique(np.concatenate((value, v)), return_inverse=True)
            count = np.bincount(back, np.concatenate((count, c))).astype(np.int64)
            if len(value) > COUNTERS:   # Misra-Gries: lower all until few are left
                count -= np.partition(count, len(count) - COUNTERS - 1)[len(count) - COUNTERS - 1]
                value, count = value[count > 0], count[count > 0]
        made = [pa.array(np.append(value.view(np.int64), 0)), pa.array(np.append(count, total)), pa.array(np.append(np.zeros(len(value), bool), True))]
        yield pa.RecordBatch.from_arrays(made, names=["minimiser", "n", "total"])

    found = docs.mapInArrow(summary, "minimiser long, n long, total boolean").groupBy("total", "minimiser").agg(F.sum("n").alias("n"))
    rows = found.where(F.col("total") | (F.col("n") > common)).collect()
    total = sum(r["n"] for r in rows if r["total"])
    return np.sort(np.array([r["minimiser"] for r in rows if not r["total"]], np.int64).view(np.uint64)), total


def deal(docs: DataFrame, units: Units, common: np.ndarray, n_buckets: int) -> DataFrame:
    """(bucket, blob): every bucket's super-k-mers of a chunk, as compressed Arrow."""
    def sent(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for ids, texts in _chunks(batches):
            packed, h, place, doc, doc_end = units.split(texts)
            first, n, m = cut(h, doc_end, units)
            if len(common):
                rare = ~np.isin(m, common)
                first, n, m = first[rare], n[rare], m[rare]
            if not len(first):
                continue
            of = doc[first]
            begin = np.searchsorted(doc, np.arange(len(texts)))
            a, b = place[first].tolist(), place[first + n + units.window - 1].tolist()
            held.append(pa.RecordBatch.from_arrays([
                pa.array((m >> np.uint64(32)).astype(np.uint32)), *ids.take(of).arrays(),
                pa.array((first - begin[of]).astype(np.uint32)), pa.array(n.astype(np.uint32)),
                pa.array([packed[x:y] for x, y in zip(a, b, strict=True)], pa.binary()),
                pa.array((m % np.uint64(n_buckets)).astype(np.int64))], names=["m", *ID, "start", "n", "packed", "bucket"]))
            size += len(packed)
            if size > HELD:
                yield _blobs(held)
                held, size = [], 0
        if held:
            yield _blobs(held)

    return docs.mapInArrow(sent, "bucket long, blob binary")


def _blobs(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(held).combine_chunks()
    bucket = table.column("bucket").to_numpy()
    order = np.argsort(bucket, kind="stable")
    table, bucket = table.drop_columns(["bucket"]).take(pa.array(order)), bucket[order]
    starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    blobs = []
    for a, b in zip(starts, np.append(starts[1:], len(bucket)), strict=True):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))) as w:
            w.write_table(table.slice(a, b - a))
        blobs.append(sink.getvalue().to_pybytes())
    return pa.RecordBatch.from_arrays([pa.array(bucket[starts]), pa.array(blobs, pa.binary())], names=["bucket", "blob"])


@dataclass
class Strings:
    """Distinct strings of a bucket that share their minimiser with another,
    each with its first document, key and window, one after the other."""
    text: bytes
    at: np.ndarray       # where each begins in text, and the end
    n: np.ndarray        # windows
    ids: Ids
    start: np.ndarray


def in_buckets(blobs: DataFrame, n_buckets: int, compare: Callable[[Strings], list[np.ndarray]], first_stays: bool) -> DataFrame:
    """Runs of windows that go.  A string found again goes whole (all of its
    places, or all but the first); ``compare`` flags the windows of distinct
    strings that other strings hold, or hold earlier."""
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket: dict[int, list[bytes]] = {}
        for batch in batches:
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_bucket.setdefault(bucket, []).append(blob)
        while by_bucket:
            _, parts = by_bucket.popitem()
            table = pa.concat_tables([pa.ipc.open_stream(p).read_all() for p in parts]).combine_chunks()
            del parts
            yield from _bucket_runs(table, compare, first_stays)

    return blobs.repartition(n_buckets, "bucket").mapInArrow(read, RUNS)


def _bucket_runs(table: pa.Table, compare: Callable[[Strings], list[np.ndarray]], first_stays: bool) -> Iterator[pa.RecordBatch]:
    m = table.column("m").to_numpy()
    order = np.argsort(m, kind="stable")
    same = m[order][1:] == m[order][:-1]
    met = order[np.concatenate(([False], same)) | np.concatenate((same, [False]))]   # minimisers met twice
    if not len(met):
        return
    table = table.take(pa.array(met))
    packed = table.column("packed").combine_chunks()
    packed = packed.chunk(0) if isinstance(packed, pa.ChunkedArray) else packed
    coded = packed.dictionary_encode()
    code, strings = coded.indices.to_numpy(), coded.dictionary
    m, ids = table.column("m").to_numpy(), Ids.of(table)
    start, n = table.column("start").to_numpy().astype(np.int64), table.column("n").to_numpy().astype(np.int64)
    order = np.lexsort((start, ids.key, ids.doc, ids.none, code))
    code, m, ids, start, n = code[order], m[order], ids.take(order), start[order], n[order]
    first = np.concatenate(([True], code[1:] != code[:-1]))
    where = np.flatnonzero(first)
    if first_stays:   # a repeated row is the same place
        lead = where[code]
        again = ids.unlike(ids.take(lead)) | (start != start[lead])
    else:
        again = np.bincount(code)[code] > 1
    if again.any():
        yield _runs_batch(ids.take(again), start[again], n[again])
    groups, back = np.unique(m[where], return_inverse=True)
    several = np.bincount(back)[back] > 1
    if not several.any():
        return
    ask = np.flatnonzero(several)
    ask = ask[np.argsort(m[where][ask], kind="stable")]
    some = strings.take(pa.array(code[where][ask]))
    text = b"".join(some.to_pylist())
    size = np.diff(np.frombuffer(some.buffers()[1], np.int32, len(some) + 1, some.offset * 4)).astype(np.int64)
    place = where[ask]
    flags = compare(Strings(text, np.concatenate(([0], np.cumsum(size))), n[place], ids.take(place), start[place]))
    ends = np.cumsum(n[place])
    flat = np.concatenate(flags) if isinstance(flags, list) else flags
    if not flat.any():
        return
    edge = np.zeros(len(flat) + 1, bool)
    edge[ends] = True   # a run never goes on in the next string
    on = flat.astype(np.int8)
    begin = np.flatnonzero((on == 1) & (np.concatenate(([0], on[:-1])) == 0) | (on == 1) & edge[:-1])
    stop = np.flatnonzero((on == 1) & (np.concatenate((on[1:], [0])) == 0) | (on == 1) & edge[1:]) + 1
    string = np.searchsorted(ends, begin, side="right")
    offset, length = begin - (ends - n[place])[string], stop - begin
    if first_stays:
        yield _runs_batch(ids.take(place[string]), start[place][string] + offset, length)
        return
    # all places of the string lose these windows
    count = np.bincount(code)[code[where]][ask]
    repeat = count[string]
    j = np.arange(repeat.sum()) - np.repeat(np.cumsum(repeat) - repeat, repeat)
    at = np.repeat(place[string], repeat) + j
    yield _runs_batch(ids.take(at), start[at] + np.repeat(offset, repeat), np.repeat(length, repeat))


def _runs_batch(ids: Ids, start: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*ids.arrays(), pa.array(start.astype(np.int64)), pa.array(n.astype(np.int64))], names=[*ID, "start", "length"])


def hot_windows(docs: DataFrame, units: Units, common: np.ndarray) -> DataFrame:
    """none, doc_id, text_key, start, h1, h2: windows of common minimisers."""
    def sent(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _chunks(batches):
            _, h, _, doc, doc_end = units.split(texts)
            first, n, m = cut(h, doc_end, units)
            hot = np.isin(m, common)
            if not hot.any():
                continue
            first, n = first[hot], n[hot]
            at = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            begin, of = np.searchsorted(doc, np.arange(len(texts))), doc[at]
            h1, h2 = (joined_hash(h, units.window, f)[at].view(np.int64) for f in (_A, _B))
            yield pa.RecordBatch.from_arrays(
                [*ids.take(of).arrays(), pa.array((at - begin[of]).astype(np.int64)), pa.array(h1), pa.array(h2)],
                names=[*ID, "start", "h1", "h2"])

    return docs.mapInArrow(sent, "none boolean, doc_id long, text_key long, start long, h1 long, h2 long")


def repeated(docs: DataFrame, units: Units, compare: Callable[[Strings], list[np.ndarray]], first_stays: bool,
             common: int = COMMON) -> DataFrame:
    """Runs of windows that go, of ``docs`` from ``keyed``."""
    ship(docs.sparkSession)
    hot, total = common_minimisers(docs, units, common)
    n_buckets = max(1, total // BUCKET_ROWS)
    out = in_buckets(deal(docs, units, hot, n_buckets), n_buckets, compare, first_stays)
    if not len(hot):
        return out
    # A window may have any share of the places: they are split by their
    # documents, counted by part, then over the parts, and joined by part.
    salt = F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(SALTS)).cast("int")
    seen = materialize(hot_windows(docs, units, hot).withColumn("salt", salt))
    place = F.struct(*ID, "start")
    parts = seen.groupBy("h1", "h2", "salt").agg(F.count("*").alias("n"), F.min(place).alias("low"))
    whole = parts.groupBy("h1", "h2").agg(F.sum("n").alias("all"), F.min("low").alias("best")).where("all > 1")
    gone = seen.join(parts.select("h1", "h2", "salt").join(whole, ["h1", "h2"]), ["h1", "h2", "salt"])
    if first_stays:
        gone = gone.where(place != F.col("best"))
    return out.unionByName(gone.select(*ID, "start", F.lit(1).cast("long").alias("length")))


def gather(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """doc_id, ``body`` (the text as a zstd frame: it crosses a shuffle), and
    the ``starts`` and ``lengths`` of each document's runs."""
    def squeezed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = ZstdCompressor(level=1)
        for batch in batches:
            body = pa.array([press.compress(t.as_py().encode()) for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ID), body], names=[*ID, "body"])

    each = (materialize(runs).groupBy(*ID).agg(F.collect_list(F.struct("start", "length")).alias("runs"))
            .select(*[F.col(c).alias(f"r_{c}") for c in ID], F.col("runs.start").alias("starts"), F.col("runs.length").alias("lengths")))
    docs = docs.mapInArrow(squeezed, "none boolean, doc_id long, text_key long, body binary")
    same = (F.col("doc_id") == F.col("r_doc_id")) & (F.col("text_key") == F.col("r_text_key")) & (F.col("none") == F.col("r_none"))
    return docs.join(each, same, "left").select(F.when(~F.col("none"), F.col("doc_id")).alias("doc_id"), "body", "starts", "lengths")


def covered(n: int, window: int, starts, lengths) -> np.ndarray:
    """Which of ``n`` units a removed window covers."""
    change = np.zeros(n + 1, np.int64)
    starts, lengths = np.asarray(starts, np.int64), np.asarray(lengths, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths + window - 1, -1)
    return np.cumsum(change[:-1]) > 0
