"""Jaccard join of word n-gram sets by parity sketches.

Two sets linked at similarity t differ in at most ``D = (1 - t) / t * m`` tokens,
``m`` being the smaller set's size.  XOR-hashing a set's tokens into blocks
makes a sketch of which every differing token can change one block only.  So

* *index*: per band of sizes there are ``D + 1 + c`` blocks; each holds the XOR of
  its tokens' 64-bit hashes, and linked sets agree on at least ``c + 1`` blocks.
  A set files its ``D + 1`` fullest blocks (ties: the higher block), leaving out
  ``c``.  Fullness is the same for both sets of an agreeing block, so the fullest
  block on which they agree has at least ``c`` emptier ones that they agree on and
  is left out by neither: no link is lost, and empty or nearly empty blocks, which
  unlike sets share, are not filed.
* *bit sketch*: each token flips one bit, so the Hamming distance of two bit
  sketches is at most the number of differing tokens; pairs beyond it go.
* what is left is verified on the sets themselves.

A band reaches from ``lo`` to ``lo / t``; a set files in its own band and in the one
below, so sets of neighbouring bands meet.  Equal sets are one row from the start.
Lists of sets that share a block are compared in rounds: each set with its list's
hub, the set nearest to the majority of the list's bits; then, only in lists that
these links leave in several components and across components only, each set with
its nearest candidates, with more in every round until none is left.  Links within a component
decide nothing, so a large group of copies costs a few pairs a copy, and no link
between components is left out.

Defined cases: null or wordless text has no shingles and is linked with nothing;
fewer words than a shingle make one shingle; a null doc_id is never a component's
smallest unless all are null; repeated rows each appear; texts of any length are
taken whole; an empty table gives no rows; other columns are ignored.  Shingles are
compared by 64-bit hashes, whole sets by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from zstandard import ZstdCompressor, ZstdDecompressor

from quayside.llm.common import materialize, ship, text_of
from quayside.llm.simhash import components
from quayside.llm.superkmers import joined_hash, mixed
from quayside.llm.word_windows import word_hashes

SHINGLE = 4
PERCENT = 85
CHUNK = 1 << 20
HELD = 1 << 20
BUCKET_ROWS = 1 << 20
#: lists up to which all candidates are asked at once, and candidates of the first round beyond
SHORT = 32
TAKE = 32
_A, _B = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


@dataclass(frozen=True)
class Bands:
    """Bands of set sizes: the largest size of each, from 1 up."""
    percent: int
    ends: tuple[int, ...]

    @classmethod
    def of(cls, percent: int, largest: int) -> Bands:
        ends = [1]
        while ends[-1] < largest:
            ends.append(max(ends[-1] + 1, ends[-1] * 100 // percent))
        return cls(percent, tuple(ends))

    def differ(self, band: int) -> int:
        """Tokens in which linked sets, the smaller of this band, differ at most."""
        return (100 - self.percent) * self.ends[band] // self.percent


def packed(text: str) -> bytes:
    """Lower-cased (A-Z) words, each followed by a space."""
    words = text.encode().lower().split()
    return b" ".join(words) + b" " if words else b""


def shingle_sets(bodies: list[bytes], shingle: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text given as ``packed``."""
    h, place = word_hashes(b"".join(bodies))
    ends = np.searchsorted(place, np.cumsum([len(b) for b in bodies]))   # words up to each text's end
    g = mixed(joined_hash(h, shingle, _A))
    out, begin = [], 0
    for end in ends.tolist():
        n = end - begin
        if n >= shingle:
            x = np.sort(g[begin:end - shingle + 1])
            out.append(x[np.concatenate(([True], x[1:] != x[:-1]))])
        else:
            out.append(mixed(joined_hash(h[begin:end], n, _B) + np.uint64(n)) if n else h[:0])
        begin = end
    return out


def bit_sketch(tokens: np.ndarray) -> np.ndarray:
    """Parities of a set's tokens over as many bits as it has tokens, rounded up
    to a power of two (64 at least), as 64-bit words."""
    bits = max(64, 1 << (len(tokens) - 1).bit_length())
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view("<u8")


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """The sketch over fewer bits: parities of equal bit numbers add up."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, words), axis=0)


def block_keys(tokens: np.ndarray, bands: Bands) -> np.ndarray:
    """Keys under which a set is filed: its own band's and the band's below."""
    own = int(np.searchsorted(bands.ends, len(tokens)))
    out = []
    for band in (own - 1, own):
        differ = bands.differ(band) if band >= 0 else 0
        if not differ:   # only equal sets are linked
            continue
        blocks = differ + 1 + max(1, (differ + 1) // 3)
        of = ((tokens >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)
        xor = np.zeros(blocks, np.uint64)
        np.bitwise_xor.at(xor, of, tokens)
        number = np.arange(blocks)
        fullest = np.argsort(np.bincount(of, minlength=blocks) * blocks + number)[-(differ + 1):]
        out.append(mixed(xor[fullest] ^ mixed((fullest + 1).astype(np.uint64) + np.uint64((band + 1) << 32))))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _few(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about CHUNK bytes of one column."""
    begin, size = 0, 0
    for i, x in enumerate(batch.column(column)):
        size += len(x.as_py())
        if size >= CHUNK:
            yield batch.slice(begin, i + 1 - begin)
            begin, size = i + 1, 0
    if begin < batch.num_rows:
        yield batch.slice(begin)


def signatures(docs: DataFrame, shingle: int, with_body: bool) -> DataFrame:
    """doc_id, n (shingles), s1 and s2 (the set's 128 bits); with ``with_body``
    also the bit sketch and the packed text as a zstd frame."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n", "s1", "s2"] + ["sketch", "body"] * with_body

    def signed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = ZstdCompressor(level=1)
        for batch in batches:
            for part in _few(batch, 1):
                bodies = [packed(t.as_py()) for t in part.column(1)]
                sets = shingle_sets(bodies, shingle)
                two = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x.tobytes()) for x in sets), np.int64).reshape(-1, 2)
                made = [part.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array(two[:, 0]), pa.array(two[:, 1])]
                if with_body:
                    made += [pa.array([bit_sketch(x).tobytes() if len(x) else b"" for x in sets], pa.binary()),
                             pa.array([press.compress(b) for b in bodies], pa.binary())]
                yield pa.RecordBatch.from_arrays(made, names=names)

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(
        signed, f"doc_id {kind}, n long, s1 long, s2 long" + ", sketch binary, body binary" * with_body)


def _sets_of(batches: Iterable[pa.RecordBatch], column: int, shingle: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    opened = ZstdDecompressor()
    for batch in batches:
        for part in _few(batch, column):
            yield part, shingle_sets([opened.decompress(b.as_py()) if len(b.as_py()) else b"" for b in part.column(column)], shingle)


def lists(sets: DataFrame, bands: Bands, shingle: int) -> DataFrame:
    """(list, size, members): distinct lists of sets that share a block key."""
    tokens = sets.agg(F.sum("n")).first()[0] or 0
    n_buckets = max(1, tokens * 5 * (100 - bands.percent) // 200 // BUCKET_ROWS)   # two bands, about D entries each

    def filed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids, size = [], [], 0
        for part, tokens in _sets_of(batches, 1, shingle):
            for i, t in zip(part.column(0).to_pylist(), tokens, strict=True):
                k = block_keys(t, bands)
                keys.append(k)
                ids.append(np.full(len(k), i, np.int64))
                size += len(k)
            if size >= HELD:
                yield _blobs(np.concatenate(keys), np.concatenate(ids), n_buckets)
                keys, ids, size = [], [], 0
        if size:
            yield _blobs(np.concatenate(keys), np.concatenate(ids), n_buckets)

    def met(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if bucket != now and held:
                    yield from _shared(held)
                    held = []
                now = bucket
                held.append(np.frombuffer(blob, np.int64).reshape(2, -1))
        if held:
            yield from _shared(held)

    blobs = sets.select("id", "body").mapInArrow(filed, "bucket long, blob binary").repartition("bucket").sortWithinPartitions("bucket")
    found = blobs.mapInArrow(met, "l1 long, l2 long, size long, members array<long>")
    return materialize(found.groupBy("l1", "l2").agg(F.first("size").alias("size"), F.first("members").alias("members")))


def _blobs(key: np.ndarray, ids: np.ndarray, n_buckets: int) -> pa.RecordBatch:
    """One blob a bucket: the keys, then the ids."""
    bucket = (key % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    key, ids, bucket = key[order].view(np.int64), ids[order], bucket[order]
    first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    blobs = [np.concatenate((key[a:b], ids[a:b])).tobytes() for a, b in zip(first, np.append(first[1:], len(bucket)), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.array(blobs, pa.binary())], names=["bucket", "blob"])


def _shared(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The bucket's lists of two members or more, each distinct list once."""
    key, ids = np.concatenate(held, axis=1)
    order = np.lexsort((ids, key))
    key, ids = key[order], ids[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(first, len(key)))
    more = np.repeat(size > 1, size)
    ids, size = ids[more], size[size > 1]
    if not len(size):
        return
    first = np.cumsum(size) - size
    names = [np.add.reduceat(mixed(ids.view(np.uint64) + np.uint64(x)), first).view(np.int64) for x in (_A, _B)]
    one = np.unique(np.stack(names, axis=1), axis=0, return_index=True)[1]
    take = np.repeat(first[one] - np.cumsum(size[one]) + size[one], size[one]) + np.arange(size[one].sum())
    members = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size[one]))).astype(np.int32)), pa.array(ids[take]))
    yield pa.RecordBatch.from_arrays([pa.array(names[0][one]), pa.array(names[1][one]), pa.array(size[one]), members],
                                     names=["l1", "l2", "size", "members"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int, shingle: int) -> DataFrame:
    """(a, b): the pairs that are linked; sizes and bit sketches first, then the sets."""
    def near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y, n, m in zip(batch.column("xa"), batch.column("xb"), batch.column("na").to_pylist(), batch.column("nb").to_pylist(), strict=True):
                x, y = np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8")
                words = min(len(x), len(y))
                far = int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum())
                good.append(far * (100 + percent) <= (100 - percent) * (n + m))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, tokens in _sets_of(batches, 1, shingle):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([t.tobytes() for t in tokens], pa.binary())], names=["i", "tokens"])

    def linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("ta"), batch.column("tb"), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                at = np.searchsorted(x, y)
                both = int((x[np.minimum(at, len(x) - 1)] == y).sum())
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    light = sets.select("id", "n", "sketch")
    left, right = (light.select(F.col("id").alias(f"i{x}"), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"x{x}")) for x in "ab")
    sized = pairs.join(left, F.col("a") == F.col("ia")).join(right, F.col("b") == F.col("ib"))
    sized = sized.where((F.col("na") * 100 >= F.col("nb") * percent) & (F.col("nb") * 100 >= F.col("na") * percent))
    close = materialize(sized.select("a", "b", "na", "nb", "xa", "xb").mapInArrow(near, "a long, b long"))
    asked = close.select(F.col("a").alias("id")).unionByName(close.select(F.col("b").alias("id"))).distinct()
    tokens = sets.select("id", "body").join(asked, "id", "left_semi").mapInArrow(made, "i long, tokens binary")
    left, right = (tokens.select(F.col("i").alias(f"i{x}"), F.col("tokens").alias(f"t{x}")) for x in "ab")
    both = close.join(left, F.col("a") == F.col("ia")).join(right, F.col("b") == F.col("ib"))
    return materialize(both.select("a", "b", "ta", "tb").mapInArrow(linked, "a long, b long"))


def _open_lists(met: DataFrame, roots: DataFrame, least: int) -> DataFrame:
    """(l1, l2, id, root) of the members of lists of ``least`` members or more
    that lie in several components."""
    each = met.where(F.col("size") >= least).select("l1", "l2", "size", F.explode("members").alias("id"))
    each = each.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    split = each.groupBy("l1", "l2").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("l1", "l2")
    return each.join(split, ["l1", "l2"])


def _across(members: DataFrame, sets: DataFrame, began: DataFrame | None, percent: int, skip: int, take: int) -> DataFrame:
    """(a, b): pairs of lists' members in different components whose sizes and bit
    sketches allow a link.

    With ``take`` 0 each member and its list's hub, the member nearest to the
    majority of the list's bits.  Else, for each member outside the component
    that was the list's largest when the rounds ``began``, the candidates of
    rank ``skip`` to ``skip + take`` in the order of their distance; short
    lists all at once.  Ranks do not depend on later links, so rounds that go
    through all ranks leave out no pair that could join two components.
    """
    def rows_of(ids: list, root: list, start: list, n: list, sketch: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        ids, root, start, n = np.array(ids), np.array(root), np.array(start), np.array(n)
        words = min(len(x) for x in sketch) // 8
        bits = np.stack([folded(np.frombuffer(x, "<u8"), words) for x in sketch])

        def allowed(i: int) -> tuple[np.ndarray, np.ndarray]:
            far = np.bitwise_count(bits ^ bits[i]).sum(axis=1, dtype=np.int64)
            good = (n * 100 >= n[i] * percent) & (n[i] * 100 >= n * percent) & (far * (100 + percent) <= (100 - percent) * (n + n[i]))
            good[i] = False
            return np.flatnonzero(good), far

        if not take:
            ones = np.unpackbits(bits.view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
            most = np.packbits(ones * 2 > len(ids)).view(np.uint64)
            hub = int(np.bitwise_count(bits ^ most).sum(axis=1, dtype=np.int64).argmin())
            near = allowed(hub)[0]
            yield ids[near[root[near] != root[hub]]], ids[hub]
            return
        names, count = np.unique(start, return_counts=True)
        for i in np.flatnonzero(start != names[count.argmax()]):   # the largest component's own pairs decide nothing
            near, far = allowed(i)
            if len(ids) > SHORT:
                near = near[np.argsort(far[near] / (n[near] + n[i]), kind="stable")][skip:skip + take]
            yield ids[near[root[near] != root[i]]], ids[i]

    def compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, ([], [], [], [], [])

        def pairs() -> Iterator[pa.RecordBatch]:
            for others, one in rows_of(*held):
                if len(others):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(others, one)), pa.array(np.maximum(others, one))], names=["a", "b"])

        for batch in batches:
            for l1, l2, *row in zip(*(batch.column(c).to_pylist() for c in ("l1", "l2", "id", "root", "start", "n", "sketch")), strict=True):
                if (l1, l2) != now:
                    if now:
                        yield from pairs()
                    now, held = (l1, l2), ([], [], [], [], [])
                for x, y in zip(held, row, strict=True):
                    x.append(y)
        if now:
            yield from pairs()

    rows = members.withColumn("start", F.col("id"))
    if began is not None:
        start = began.select(F.col("node").alias("id"), F.col("root").alias("start"))
        rows = members.join(start, "id", "left").withColumn("start", F.coalesce("start", "id"))
    rows = rows.join(sets.select("id", "n", "sketch"), "id").select("l1", "l2", "id", "root", "start", "n", "sketch").repartition("l1", "l2").sortWithinPartitions("l1", "l2", "id")
    return rows.mapInArrow(compared, "a long, b long").distinct()


def linked_sets(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Distinct sets (id, s1, s2, n, least doc_id, sketch, body) and (node, root),
    the components of their links, for sets with links."""
    if not 50 <= percent <= 100:
        raise ValueError("percent is from 50 to 100")
    found = signatures(docs, shingle, with_body=True).where("n > 0")
    sets = found.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("least"), F.first("sketch").alias("sketch"), F.first("body").alias("body"))
    sets = materialize(sets.withColumn("id", F.monotonically_increasing_id()))
    bands = Bands.of(percent, (sets.agg(F.max("n")).first()[0] or 1) * 100 // percent + 1)
    met = lists(sets, bands, shingle)
    two = met.where("size = 2").select(F.col("members")[0].alias("a"), F.col("members")[1].alias("b"))
    each = met.where("size > 2").select("l1", "l2", F.explode("members").alias("id")).withColumn("root", F.col("id"))
    hubs = _across(each, sets, None, percent, 0, 0)
    began = roots = components(verified(two.unionByName(hubs).distinct(), sets, percent, shingle))
    skip, take, least = 0, TAKE, 3   # lists of two are done
    while True:
        members = materialize(_open_lists(met, roots, least))
        if members.isEmpty():
            return sets, roots
        pairs = materialize(_across(members, sets, began, percent, skip, take))
        if not pairs.isEmpty():
            links = verified(pairs, sets, percent, shingle)
            if not links.isEmpty():   # with what the links so far come to
                roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links))
        skip, take, least = skip + take, take * 32, max(SHORT + 1, skip + take + 2)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    sets, roots = linked_sets(docs, shingle, percent)
    rooted = sets.select("id", "s1", "s2", "least").join(roots, F.col("id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "id"))
    low = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(low, "root").select(F.col("s1").alias("t1"), F.col("s2").alias("t2"), "component_id")
    rows = signatures(docs, shingle, with_body=False)
    return (rows.join(named, (F.col("s1") == F.col("t1")) & (F.col("s2") == F.col("t2")), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))
