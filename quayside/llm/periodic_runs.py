"""Periodic runs of words: online sparse diagonal DP.

A run of period q is a stretch whose words equal the words q before: a match
on the diagonal (lag) q.  Going through the words in order, every earlier
occurrence of a word's context feeds the match length of its lag, and a lag
that is not fed ends; if its match is long enough the run is emitted.

Sparse means two things here.  Only contexts that occur twice in a text are
followed (contexts of 1, 2, 4, ... words, each made of two shorter ones that
occur twice themselves, compared exactly by dense codes).  And per context
length ``l`` a word feeds one lag, that of the nearest earlier occurrence, and
only lags of ``l/2 < q <= l``.  That loses no run: inside a run of smallest
period q <= l an occurrence of a context of l words nearer than q would
overlap the one at q in at least q words more than its own lag, so both would
share a divisor of q as period, against q being smallest.  For the same reason
no lag that is a mere multiple of a period is ever fed by a long match.  So all
lags together cost O(n log n), also for one word repeated over a whole text.

Defined cases: null text has no words; words are compared by their bytes;
doc_ids may be null, of any type, or repeat (each row is judged alone);
very long texts are one row's work, linear but for sorting; an empty table
gives no rows; other columns are ignored.  Ties do not arise, as runs are told
by start and period.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quayside.llm.common import ship, text_of

SHORTEST = 24
REPEATS = 3
CHUNK = 1 << 20


def _again(at: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the places ``at`` those whose code occurs twice, with dense codes and
    how far back the code stood last (0: nowhere)."""
    order = np.argsort(code, kind="stable")
    ranked = code[order]
    same = ranked[1:] == ranked[:-1]
    dense = np.empty(len(at), np.int64)
    dense[order] = np.concatenate(([0], np.cumsum(~same)))
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    lag = np.zeros(len(at), np.int64)
    lag[order[1:][same]] = at[order[1:][same]] - at[order[:-1][same]]
    return at[twice], dense[twice], lag[twice]


def find_runs(code: np.ndarray, end: np.ndarray, shortest: int = SHORTEST, repeats: int = REPEATS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of at least ``shortest`` words and
    ``repeats`` periods in concatenated texts, by start, then period.

    ``code`` holds a number per word, other numbers in other texts; ``end``
    holds for each word where its text ends.
    """
    if repeats < 3 or shortest < 2:
        raise ValueError("a run has at least 3 periods and 2 words")
    n = len(code)
    if not n:
        none = np.empty(0, np.int64)
        return none, none, none
    longest_lag = int(np.diff(np.concatenate(([0], np.unique(end)))).max()) // repeats
    first = 1 << ((2 * shortest // 3).bit_length() - 1)   # every match to emit is as long
    at, code, lag = _again(np.arange(n), code)
    size, low, found = 1, 0, []
    slot = np.full(n + 1, -1, np.int64)
    while len(at) and low < longest_lag:
        if size >= first:
            found.append(_ended(at, lag, size, low, shortest, repeats))
            low = size
        slot[at] = np.arange(len(at))
        next_at = np.minimum(at + size, n)
        joined = (slot[next_at] >= 0) & (at + 2 * size <= end[at])
        pair = code[joined] * (int(code.max()) + 1) + code[slot[next_at[joined]]]
        slot[at] = -1
        at, code, lag = _again(at[joined], pair)
        size *= 2
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none
    start, length, period = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _ended(at: np.ndarray, lag: np.ndarray, size: int, low: int, shortest: int, repeats: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of the lags in (low, size] that contexts of ``size`` words feed: a
    lag is active while each next word feeds it again."""
    fed = (lag > low) & (lag <= size)
    at, lag = at[fed], lag[fed]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (lag[1:] != lag[:-1])
    first = np.flatnonzero(new)
    match = np.diff(np.append(first, len(at))) + size - 1
    start, period = at[first] - lag[first], lag[first]
    length = match + period
    good = length >= np.maximum(shortest, repeats * period)
    return start[good], length[good], period[good]


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[list[bytes]]]]:
    """First row, row after the last, and the rows' words, about CHUNK bytes at once."""
    begin, held, size = 0, [], 0
    for i, text in enumerate(batch.column(1)):
        body = text.as_py().encode()
        held.append(body.split())
        size += len(body)
        if size >= CHUNK:
            yield begin, i + 1, held
            begin, held, size = i + 1, [], 0
    if held:
        yield begin, batch.num_rows, held


def runs_of_texts(each: list[list[bytes]], shortest: int, repeats: int) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of the runs of texts given as words, and
    the flags of the words that stay, texts one after the other."""
    n = np.array([len(w) for w in each], np.int64)
    begin = np.cumsum(n) - n
    flat = pa.array([w for ws in each for w in ws], pa.binary()).dictionary_encode()
    text = np.repeat(np.arange(len(each)), n)
    code = flat.indices.to_numpy().astype(np.int64) + text * max(1, len(flat.dictionary))
    start, length, period = find_runs(code, np.repeat(begin + n, n), shortest, repeats)
    change = np.zeros(len(code) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    of = text[start] if len(start) else np.empty(0, np.int64)
    return of, start - begin[of], length, period, np.cumsum(change[:-1]) == 0


def collapse(docs: DataFrame, shortest: int = SHORTEST, repeats: int = REPEATS) -> DataFrame:
    """doc_id, n_words, ``runs`` (start, length, period; by start, then period)
    and ``kept``: the words outside runs and of each run's first period, joined
    by one space."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    run = pa.struct([(x, pa.int64()) for x in ("start", "length", "period")])

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, each in _chunks(batch):
                of, start, length, period, stays = runs_of_texts(each, shortest, repeats)
                offsets = np.searchsorted(of, np.arange(len(each) + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
                    [pa.array(start), pa.array(length), pa.array(period)], fields=list(run)))
                hit = set(of.tolist())
                kept, place = [], 0
                for i, ws in enumerate(each):
                    if i in hit:
                        ws = [w for w, x in zip(ws, stays[place:place + len(ws)].tolist(), strict=True) if x]
                    place += len(each[i])
                    kept.append(b" ".join(ws).decode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([len(ws) for ws in each], pa.int64()), lists, pa.array(kept, pa.string())],
                    names=["doc_id", "n_words", "runs", "kept"])

    schema = f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, kept string"
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(found, schema)
