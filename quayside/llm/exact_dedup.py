"""Exact dedup against an index of historical digests: minimal perfect hash.

``build_index`` hashes the distinct digests of a history into buckets by their
leading bytes and builds one minimal perfect hash per bucket (hash and
displace: groups of keys, largest first, search a displacement that sends
every key to a free slot).  Slot ``i`` holds the full 32-byte digest and the
winner's locator (its doc_id and how many rows share the text).  A lookup
computes one slot and compares all 32 bytes there: members are repeats of the
winner; nonmembers are grouped among themselves.

Texts are equal when identical after lower-casing A-Z.  The history of
``deduplicate`` is the newer half of the documents: the largest doc_id wins,
so a text known there has its winner, and older rows only look it up.  Where
the halves are cut changes the work, never the result.

Copies meet as (digest, largest doc_id, rows) partial aggregates, so a group
of any size is one row before it moves.  Defined cases: null text equals the
empty text; a null doc_id is older than any other; of repeated rows with one
doc_id and text exactly one is kept; texts of any length are digested whole; an
empty table gives an empty result; other columns are ignored, or kept by
``distinct_documents``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import lower_ascii, materialize, ship, text_of

KEYS_PER_BUCKET = 20_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(lower_ascii(text).cast("binary"), 256))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift, multiply)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _slots(halves: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    """Slot of each key; a negative displacement names the slot itself."""
    hashed = (_mixed(halves[:, 1] + displacement.astype(np.uint64) * _MIX) % np.uint64(n)).astype(np.int64)
    return np.where(displacement < 0, -1 - displacement, hashed)


def _groups(halves: np.ndarray, n_groups: int) -> np.ndarray:
    return (_mixed(halves[:, 0]) % np.uint64(n_groups)).astype(np.int64)


def perfect_hash(halves: np.ndarray) -> np.ndarray:
    """Displacement per group of four keys (on average) that makes
    ``_slots`` a bijection of the distinct keys onto ``0..n-1``."""
    n = len(halves)
    n_groups = max(1, n // 4)
    group = _groups(halves, n_groups)
    by_group = np.argsort(group, kind="stable")
    count = np.bincount(group, minlength=n_groups)
    first = np.concatenate(([0], np.cumsum(count)))[:-1]
    displacement, taken = np.zeros(n_groups, np.int64), np.zeros(n, bool)
    for g in np.argsort(-count, kind="stable"):
        if count[g] < 2:
            break
        keys = halves[by_group[first[g]:first[g] + count[g]]]
        d = 1
        while True:
            tries = np.arange(d, d + 64)
            at = (_mixed(keys[:, 1][None, :] + tries.astype(np.uint64)[:, None] * _MIX) % np.uint64(n)).astype(np.int64)
            srt = np.sort(at, axis=1)
            good = ~taken[at].any(axis=1) & (srt[:, 1:] != srt[:, :-1]).all(axis=1)
            if good.any():
                k = int(good.argmax())
                displacement[g] = tries[k]
                taken[at[k]] = True
                break
            d += 64
    free = np.flatnonzero(~taken)
    singles = np.flatnonzero(count == 1)
    displacement[singles] = -1 - free[:len(singles)]
    return displacement


def _halves(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 4)[:, 2:4].copy()


_INDEX = "bucket long, displacement binary, digests binary, winners binary, counts binary"


def _build(known: pd.DataFrame) -> pd.DataFrame:
    halves = _halves(known["digest"])
    displacement = perfect_hash(halves)
    slot = _slots(halves, displacement[_groups(halves, len(displacement))], len(known))
    order = np.argsort(slot)
    return pd.DataFrame({
        "bucket": [int(known["bucket"].iloc[0])], "displacement": [displacement.astype("<i8").tobytes()],
        "digests": [b"".join(known["digest"].iloc[order])],
        "winners": [known["winner"].to_numpy("<i8")[order].tobytes()],
        "counts": [known["rows"].to_numpy("<i8")[order].tobytes()]})


def _lookup(asked: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    out = asked[["digest"]].copy()
    out["winner"], out["rows"] = None, 0
    if len(asked) and len(index):
        row = index.iloc[0]
        displacement = np.frombuffer(row["displacement"], "<i8")
        kept = np.frombuffer(row["digests"], "V32")
        halves = _halves(asked["digest"])
        slot = _slots(halves, displacement[_groups(halves, len(displacement))], len(kept))
        same = kept[slot] == np.frombuffer(b"".join(asked["digest"]), "V32")   # all 32 bytes
        winners = np.frombuffer(row["winners"], "<i8")[slot]
        counts = np.frombuffer(row["counts"], "<i8")[slot]
        out["winner"] = pd.array(np.where(same, winners, 0), dtype="Int64")
        out.loc[~same, "winner"] = pd.NA
        out["rows"] = np.where(same, counts, 0)
    return out


def _bucketed(groups: DataFrame, n_buckets: int) -> DataFrame:
    return groups.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(n_buckets)))


def build_index(history: DataFrame, n_buckets: int) -> DataFrame:
    """One row per bucket from ``history`` (digest, winner, rows), digests distinct."""
    return _bucketed(history, n_buckets).groupBy("bucket").applyInPandas(_build, _INDEX)


def look_up(groups: DataFrame, index: DataFrame, n_buckets: int) -> DataFrame:
    """(digest, winner, rows) of the index for every asked digest; winner is
    null for a nonmember."""
    return (_bucketed(groups.select("digest"), n_buckets).groupBy("bucket").cogroup(index.groupBy("bucket"))
            .applyInPandas(_lookup, "digest binary, winner long, rows long"))


def groups_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.max("doc_id").alias("winner"), F.sum("n").alias("rows"))


def winners(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows, groups)``: (doc_id, digest, n equal rows) and per distinct
    digest its winner and number of rows."""
    ship(docs.sparkSession)
    rows = materialize(docs.select("doc_id", digest_of(text_of()).alias("digest"))
                       .groupBy("doc_id", "digest").agg(F.count("*").alias("n")))
    cut = rows.agg(F.percentile_approx("doc_id", 0.5).alias("cut"), F.count("*").alias("n")).first()
    if cut["cut"] is None:
        return rows, groups_of(rows)
    newer = F.coalesce(F.col("doc_id") >= cut["cut"], F.lit(False))
    n_buckets = max(1, cut["n"] // KEYS_PER_BUCKET)
    history = materialize(groups_of(rows.where(newer)))
    older = materialize(groups_of(rows.where(~newer)))
    index = materialize(build_index(history, n_buckets))
    found = materialize(look_up(older, index, n_buckets))

    joined = older.join(found.select("digest", F.col("winner").alias("known"), F.col("rows").alias("known_rows")), "digest")
    members = joined.where("known is not null").select("digest", F.col("known").alias("winner"),
                                                       (F.col("rows") + F.col("known_rows")).alias("rows"))
    nonmembers = joined.where("known is null").select("digest", "winner", "rows")
    untouched = history.join(members.select("digest"), "digest", "left_anti")
    return rows, untouched.unionByName(members).unionByName(nonmembers)


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row per input row: ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    rows, groups = winners(docs)
    turn = F.posexplode(F.array_repeat(F.lit(0), F.col("n").cast("int")))
    return (rows.join(groups.withColumnRenamed("rows", "group_size"), "digest")
            .select("doc_id", F.col("winner").alias("keep_id"), "group_size", turn.alias("i", "one"),
                    F.lower(F.hex("digest")).alias("text_sha256"))
            .select("doc_id", "keep_id", "group_size",
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("i") == 0)).alias("kept"), "text_sha256"))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    _, groups = winners(docs)
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("d"), digest_of(text_of()).alias("k"))
    stay = rows.join(groups.select("digest", "winner"), (F.col("k") == F.col("digest")) & F.col("d").eqNullSafe(F.col("winner")))
    first = Window.partitionBy("digest", "winner").orderBy(F.xxhash64("row"))
    return stay.withColumn("i", F.row_number().over(first)).where("i = 1").select("row.*")
