"""Substring dedup of word windows by super-k-mer partitioning.

Every word covered by a window of 35 words that also starts anywhere else is
removed (all copies go).  Windows travel in super-k-mers (``superkmers``); in
its bucket a string seen again counts all its windows at once, and the windows
of the distinct strings of a minimiser are sorted by two 64-bit hashes, their
bytes compared where both agree, and counted exactly.

Defined cases: null text has no words; texts of fewer than 35 words keep all;
repeated rows repeat their windows, so all of these go; doc_ids may be null or
repeat, but are integers (others raise); very long texts are cut like others and
only their last step is one row's work; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from zstandard import ZstdDecompressor

from quayside.llm.superkmers import COMMON, Strings, Units, covered, gather, joined_hash, keyed, mixed, repeated

WINDOW = 35
GRAM = 5
_A, _B = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64))
_BYTE[32] = 0
_power = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _power
    if len(_power) < n:
        _power = np.concatenate(([np.uint64(1)], np.cumprod(np.full(2 * n, _A, np.uint64))))
    return _power


def word_hashes(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, each followed by one space, and where they start,
    with the end."""
    data = np.frombuffer(packed, np.uint8)
    ends = np.flatnonzero(data == 32)
    place = np.concatenate(([0], ends + 1))
    if not len(ends):
        return np.empty(0, np.uint64), place
    size = np.diff(place)
    inside = np.arange(len(data)) - np.repeat(place[:-1], size)
    return mixed(np.add.reduceat(_BYTE[data] * _powers(int(size.max()))[inside], place[:-1])), place


def split(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Packed words, their hashes, where each starts, its text, its text's end."""
    each = [b" ".join(t.encode().split()) for t in texts]
    n = np.array([x.count(b" ") + 1 if x else 0 for x in each], np.int64)
    packed = b"".join([x + b" " for x in each if x])
    h, place = word_hashes(packed)
    return packed, h, place, np.repeat(np.arange(len(texts)), n), np.repeat(np.cumsum(n), n)


def units(window: int = WINDOW, gram: int = GRAM) -> Units:
    return Units(window, min(gram, window), split)


def counted_twice(s: Strings, window: int) -> np.ndarray:
    """Flags of the windows (of all strings, in order) whose words occur twice."""
    h, place = word_hashes(s.text)
    n_words = s.n + window - 1
    first = np.cumsum(n_words) - n_words
    at = np.repeat(first, s.n) + np.arange(s.n.sum()) - np.repeat(np.cumsum(s.n) - s.n, s.n)
    h1, h2 = joined_hash(h, window, _A)[at], joined_hash(h, window, _B)[at]
    order = np.lexsort((h2, h1))
    same = (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1])
    pair = np.flatnonzero(same)
    a, b = place[at[order[pair]]].tolist(), place[at[order[pair + 1]]].tolist()
    size = (place[at[order[pair]] + window] - place[at[order[pair]]]).tolist()
    text = s.text
    if not all(text[x:x + z] == text[y:y + z] for x, y, z in zip(a, b, size, strict=True)):
        whole = [text[x:y] for x, y in zip(place[at].tolist(), place[at + window].tolist(), strict=True)]   # two hashes agree, the words don't
        _, back = np.unique(np.array(whole, object), return_inverse=True)
        return np.bincount(back)[back] > 1
    out = np.zeros(len(at), bool)
    out[order[:-1][same]] = True
    out[order[1:][same]] = True
    return out


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, common: int = COMMON, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and ``kept``, the text that stays)."""
    rows = keyed(docs)
    runs = repeated(rows, units(window, gram), lambda s: counted_twice(s, window), False, common)
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept"] * with_text

    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = ZstdDecompressor()
        for batch in batches:
            n, gone, sha, body = [], [], [], []
            for frame, starts, lengths in zip(*(batch.column(c) for c in ("body", "starts", "lengths")), strict=True):
                words = opened.decompress(frame.as_py()).split()
                n.append(len(words))
                if starts.is_valid:
                    out = covered(len(words), window, starts.as_py(), lengths.as_py())
                    gone.append(int(out.sum()))
                    words = [w for w, x in zip(words, out.tolist(), strict=True) if not x]
                else:
                    gone.append(0)
                joined = b" ".join(words)
                sha.append(hashlib.sha256(joined).hexdigest())
                body.append(joined.decode() if with_text else "")
            made = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays(made + [pa.array(body, pa.string())] * with_text, names=names)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text
    return gather(rows, runs).mapInArrow(kept, schema)
