"""Token counts of a sentencepiece BPE model at every prefix of a text.

Prefix dynamic programming: the last token of ``text[:i]`` is the one token
``t`` that ends there and can follow the last token of ``text[:i - len(t)]``
(the pair encodes to itself), so its count is that prefix's count plus one.
A document's counts answer truncation and budget questions by look-up.

No piece of the vocabulary spans a cut between segments (runs of space marks
with the word behind them, words before an ASCII mark that no piece joins to a
letter), so counts add up over segments, and a worker runs the programme once
for every distinct segment.  Runs of spaces merge last: a run keeps all its
marks if the word behind it starts with a lone mark, else all but one.

The model must be BPE with identity normalisation and byte fallback; anything
else is refused.  Defined cases: null text is empty and has 0 tokens; repeated
rows are each counted; a character outside the vocabulary counts its bytes; a very
long text is one row's work, linear in its length but for the segments it repeats;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import ship, text_of

MARK = "▁"
#: segments a worker remembers before it starts afresh (about 250 MB)
CACHE_SEGMENTS = 1_000_000
LONGEST_CACHED = 48
DOCS_AT_ONCE = 256
_counters: dict[str, PrefixCounter] = {}


class PrefixCounter:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as proto
        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if (model.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces
                or not spec.add_dummy_prefix or not model.trainer_spec.byte_fallback):
            raise ValueError("a BPE model with identity normalisation, dummy prefix and byte fallback is needed")
        self.library = SentencePieceProcessor(model_file=path)
        self.score = {p.piece: p.score for p in model.pieces if p.type == 1}
        inner = [p for p in self.score if MARK in p.lstrip(MARK)] + [p for p in self.score if p[:2] == MARK * 2 and p.strip(MARK)]
        if inner:
            raise ValueError("a piece goes on after a space mark")
        self.longest = max(map(len, self.score))
        self.trie: dict = {}
        for p in self.score:
            node = self.trie
            for c in p:
                node = node.setdefault(c, {})
            node[""] = p
        joined = {p[i:i + 2] for p in self.score for i in range(len(p) - 1)}
        letters = "".join(c for c in map(chr, range(0x41, 0x250)) if c.isalpha())
        marks = [c for c in map(chr, range(33, 127)) if not c.isalnum() and not any(a + c in joined for a in letters)]
        one, cut = f"[{letters}]", "[" + re.escape("".join(marks)) + "]" if marks else "(?!)"
        self.segments = re.compile(
            f"{MARK}*{one}+(?={cut}|{MARK}|\\Z)|{MARK}*[^{MARK}]+?(?:(?<={one})(?={cut})|(?={MARK})|\\Z)|{MARK}+", re.DOTALL)
        self.pairs: dict[str, dict[str, bool]] = {}   # whether the pair encodes to itself
        self.runs: dict[int, int] = {0: 0, 1: 1}
        self.tables: dict[str, bytes] = {}

    def _merged(self, text: str) -> list[str]:
        """BPE of a short text: best pair first, leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _run(self, n: int) -> int:
        """Tokens of ``n`` space marks by themselves."""
        if n not in self.runs:
            if len(self.runs) > CACHE_SEGMENTS:
                self.runs = {0: 0, 1: 1}
            self.runs[n] = len(self.library.encode(" " * (n - 1)))
        return self.runs[n]

    def _programme(self, text: str) -> tuple[list[int], list[bool]]:
        """For every prefix its tokens, and whether the first is a lone mark."""
        n, root, pairs = len(text), self.trie, self.pairs
        last, count, lone = [None] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        last[0] = ""
        for j in range(n + 1):
            a = last[j]
            if a is None:   # the character before is outside the vocabulary: its bytes, which merge with nothing
                a = last[j] = ""
                count[j], lone[j] = count[j - 1] + len(text[j - 1].encode()), lone[j - 1]
            known = pairs.get(a)
            if known is None:
                known = pairs[a] = {}
            node, i = root, j
            for c in text[j:j + self.longest]:
                node = node.get(c)
                if node is None:
                    break
                i += 1
                t = node.get("")
                if t is not None and last[i] is None:
                    fits = known.get(t)
                    if fits is None:
                        fits = known[t] = self._merged(a + t) == ([a, t] if a else [t])
                    if fits:
                        last[i], count[i] = t, count[j] + 1
                        lone[i] = lone[j] if j else t == MARK
        return count, lone

    def _table(self, segment: str) -> list[int]:
        """Tokens of every prefix of a segment, the whole last."""
        word = segment.lstrip(MARK)
        spaces = len(segment) - len(word)
        count, lone = self._programme(MARK + word if spaces else word)
        if spaces < 2:
            return count[1:]
        whole, short = self._run(spaces), self._run(spaces - 1)
        return [self._run(k) for k in range(1, spaces + 1)] + [
            whole + c - 1 if a else short + c for c, a in zip(count[2:], lone[2:], strict=True)]

    def _tables(self, segments: list[str]) -> dict[str, np.ndarray]:
        """Tables of the distinct segments; the short ones are remembered."""
        new = set(segments).difference(self.tables)
        if len(self.tables) + len(new) > CACHE_SEGMENTS:
            self.tables, self.pairs = {}, {}
            new = set(segments)
        once = {}
        for s in new:
            table = self._table(s)
            if len(s) <= LONGEST_CACHED:
                self.tables[s] = bytes(table)   # at most 4 tokens a character
            else:
                once[s] = np.array(table, np.int64)
        return once

    def cut(self, text: str) -> list[str]:
        return self.segments.findall(MARK + text.replace(" ", MARK)) if text else []

    def at_segments(self, text: str) -> tuple[list[str], np.ndarray, dict[str, np.ndarray]]:
        """Segments, tokens up to the end of each, tables not remembered."""
        segments = self.cut(text)
        once = self._tables(segments)
        tables = self.tables
        if once:
            each = [int(once[s][-1]) if s in once else tables[s][-1] for s in segments]
        else:
            each = [tables[s][-1] for s in segments]
        return segments, np.cumsum(np.array(each, np.int64)), once

    def _of(self, segment: str, once: dict[str, np.ndarray]) -> np.ndarray:
        return once[segment] if segment in once else np.frombuffer(self.tables[segment], np.uint8).astype(np.int64)

    def prefixes(self, text: str) -> np.ndarray:
        """Tokens of ``text[:i]`` for i = 0..len(text)."""
        segments, ends, once = self.at_segments(text)
        if not segments:
            return np.zeros(1, np.int64)
        out = np.concatenate([self._of(s, once) + (ends[i - 1] if i else 0) for i, s in enumerate(segments)])
        out[0] = 0   # the first mark is the model's own
        return out

    def longest_prefix(self, segments: list[str], ends: np.ndarray, once: dict[str, np.ndarray], budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens.  Every
        prefix inside a segment has more tokens than the segments before."""
        before = np.concatenate(([0], ends))
        for i in range(int(np.searchsorted(before[:len(segments)], budget)) - 1, -1, -1):
            fits = np.flatnonzero(self._of(segments[i], once) + before[i] <= budget)
            if len(fits):
                return sum(map(len, segments[:i])) + int(fits[-1])   # less the model's own first mark
        return 0


def counter(path: str) -> PrefixCounter:
    """The worker's counter for this model."""
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, DOCS_AT_ONCE):
            yield batch.slice(at, DOCS_AT_ONCE)


def count_tokens(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, and ``fit_chars``: how many
    characters the longest prefix of at most ``limit`` tokens has."""
    ship(docs.sparkSession)
    names = ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"]
    kind = docs.schema["doc_id"].dataType.simpleString()

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for part in _runs(batches):
            size, tokens, fit = [], [], []
            for text in part.column(1).to_pylist():
                segments, ends, once = count.at_segments(text)
                n = int(ends[-1]) if segments else 0
                size.append(len(text.encode()))
                tokens.append(n)
                fit.append(len(text) if n <= limit else count.longest_prefix(segments, ends, once, limit))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(size, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_()), pa.array(fit, pa.int64())], names=names)

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(
        counted, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")


def store_prefixes(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ``counts``: the token count at every prefix, as deflated
    little-endian 32-bit steps (``stored_counts`` opens them)."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def stored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for part in _runs(batches):
            rows = [zlib.compress(np.diff(count.prefixes(t), prepend=0).astype("<i4").tobytes(), 1) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.binary())], names=["doc_id", "counts"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(stored, f"doc_id {kind}, counts binary")


def stored_counts(counts: bytes) -> np.ndarray:
    """Tokens of ``text[:i]`` for every i, from ``store_prefixes``."""
    return np.cumsum(np.frombuffer(zlib.decompress(counts), "<i4").astype(np.int64))


def truncate_at(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    return int(np.flatnonzero(counts <= budget)[-1])
