"""Substring dedup of bytes by suffix arrays, two-stage sorting.

Every byte covered by a 100-byte string that also starts earlier (smaller
doc_id, or earlier in the document) is removed.  Equal strings meet in the
bucket of their minimiser (``superkmers``); there a suffix array of the
bucket's distinct strings is built in two stages: suffixes smaller than their
successor are sorted directly, 8 bytes at a time and only while they tie; the
others are induced by one scan over the byte buckets in order.  Neighbours
whose common prefix reaches 100 bytes are equal strings, and all but the
earliest of them go.

Defined cases: null text is empty; texts of fewer than 100 bytes keep all;
repeated rows (same doc_id and text) are one document and never remove each
other; unlike texts of one doc_id are documents in the order of their hashes; a
null doc_id is later than any other; doc_ids are integers, others raise; very long
texts are cut like others and only their last step is one row's work; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from zstandard import ZstdDecompressor

from quayside.llm.superkmers import COMMON, Strings, Units, covered, gather, keyed, mixed, repeated, runs_of

WINDOW = 100
GRAM = 20
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64))


def split(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Packed bytes, their hashes, where each starts, its text, its text's end."""
    each = [t.encode() for t in texts]
    packed = b"".join(each)
    n = np.fromiter(map(len, each), np.int64, len(each))
    return (packed, _BYTE[np.frombuffer(packed, np.uint8)], np.arange(len(packed) + 1), np.repeat(np.arange(len(texts)), n),
            np.repeat(np.cumsum(n), n))


def units(window: int = WINDOW, gram: int = GRAM) -> Units:
    return Units(window, min(gram, window), split)


def _words(t: np.ndarray, depth: int) -> np.ndarray:
    """The 8 bytes from every place on, as numbers in their order."""
    padded = np.concatenate((t, np.zeros(depth + 16, np.uint8)))
    out = np.zeros(len(padded) - 8, np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | padded[i:len(padded) - 8 + i]
    return out


def suffix_array(t: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``t`` in the order of their suffixes' first ``depth`` bytes;
    ``words`` are its ``_words``."""
    n = len(t)
    if not n:
        return np.empty(0, np.int64)
    # smaller than the successor: the next other byte is larger (the end is smallest)
    change = np.flatnonzero(t[1:] != t[:-1])
    after = np.searchsorted(change, np.arange(n))
    rises = np.concatenate((t[change + 1] > t[change], [False]))[after]
    direct = np.flatnonzero(rises)
    direct = _sorted_directly(words, direct, depth)
    ends = np.concatenate(([0], np.cumsum(np.bincount(t[direct], minlength=256))))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[t[-1]].append(np.array([n - 1]))   # before the end, the smallest suffix of all
    out = []
    for c in range(256):
        mine, front = [], np.concatenate(waiting[c]) if waiting[c] else np.empty(0, np.int64)
        waiting[c] = []
        while len(front):   # the bucket's own induced suffixes, in rounds
            mine.append(front)
            before = front[front > 0] - 1
            front = before[t[before] == c]
        bucket = np.concatenate(mine + [direct[ends[c]:ends[c + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[t[before] > c]
        if not len(before):
            continue
        first = t[before]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        cuts = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
        for a, b in zip(cuts, [*cuts[1:], len(first)], strict=True):
            waiting[first[a]].append(before[a:b])
    return np.concatenate(out)


def _sorted_directly(words: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` sorted by ``depth`` bytes; ties are sorted on by the next 8."""
    order = places[np.argsort(words[places], kind="stable")]
    first = words[order]
    tied = np.concatenate(([False], first[1:] == first[:-1])) if len(order) else np.empty(0, bool)
    for d in range(8, depth, 8):
        open_ = tied | np.concatenate((tied[1:], [False])) if len(tied) else tied
        at = np.flatnonzero(open_)
        if not len(at):
            break
        group = np.cumsum(~tied[at])
        next_ = words[order[at] + d]
        by = np.lexsort((next_, group))
        order[at] = order[at][by]
        next_, group = next_[by], group[by]
        tied[at] = np.concatenate(([False], (next_[1:] == next_[:-1]) & (group[1:] == group[:-1])))
    return order


def common_prefix_reaches(t: np.ndarray, words: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Whether the suffixes at ``a`` and ``b`` share ``depth`` bytes."""
    out = np.ones(len(a), bool)
    live = np.arange(len(a))
    for d in [*range(0, depth - 7, 8), depth - 8] if depth >= 8 else []:
        same = words[a[live] + d] == words[b[live] + d]
        out[live[~same]] = False
        live = live[same]
    for d in range(depth if depth < 8 else 0):
        same = t[np.minimum(a[live] + d, len(t) - 1)] == t[np.minimum(b[live] + d, len(t) - 1)]
        out[live[~same]] = False
        live = live[same]
    return out


def found_earlier(s: Strings, window: int) -> np.ndarray:
    """Flags of the windows (of all strings, in order) that start earlier too."""
    t = np.frombuffer(s.text, np.uint8)
    total = int(s.n.sum())
    string = np.repeat(np.arange(len(s.n)), s.n)
    inside = np.arange(total) - np.repeat(np.cumsum(s.n) - s.n, s.n)
    window_at = np.full(len(t), -1, np.int64)
    window_at[s.at[:-1][string] + inside] = np.arange(total)
    words = _words(t, window)
    sa = suffix_array(t, words, window)
    sa = sa[window_at[sa] >= 0]   # places where a window starts
    w = window_at[sa]
    same = common_prefix_reaches(t, words, sa[:-1], sa[1:], window)
    group = np.concatenate(([0], np.cumsum(~same)))
    ids, start = s.ids.take(string[w]), s.start[string[w]] + inside[w]
    twice = np.concatenate(([False], same)) | np.concatenate((same, [False]))
    at = np.flatnonzero(twice)
    at = at[np.lexsort((start[at], ids.key[at], ids.doc[at], ids.none[at], group[at]))]
    out = np.zeros(total, bool)
    if len(at):
        first = np.concatenate(([True], group[at][1:] != group[at][:-1]))
        lead = at[first][np.cumsum(first) - 1]
        earlier = ids.take(lead).unlike(ids.take(at)) | (start[lead] != start[at])
        out[w[at[earlier]]] = True
    return out


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, common: int = COMMON, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and ``kept``, the bytes that stay)."""
    rows = keyed(docs)
    runs = repeated(rows, units(window, gram), lambda s: found_earlier(s, window), True, common)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text

    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = ZstdDecompressor()
        for batch in batches:
            n, gone, spans, sha, body = [], [], [], [], []
            for frame, starts, lengths in zip(*(batch.column(c) for c in ("body", "starts", "lengths")), strict=True):
                data = opened.decompress(frame.as_py())
                n.append(len(data))
                if starts.is_valid:
                    out = covered(len(data), window, starts.as_py(), lengths.as_py())
                    gone.append(int(out.sum()))
                    spans.append(len(runs_of(out)[0]))
                    data = np.frombuffer(data, np.uint8)[~out].tobytes()
                else:
                    gone.append(0)
                    spans.append(0)
                sha.append(hashlib.sha256(data).hexdigest())
                body.append(data if with_text else b"")
            made = [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, gone, spans)), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays(made + [pa.array(body, pa.binary())] * with_text, names=names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return gather(rows, runs).mapInArrow(kept, schema)
