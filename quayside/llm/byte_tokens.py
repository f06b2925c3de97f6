"""Ids of whole texts from a byte-level BPE file of the ``tokenizers`` library.

The library spends most of its time on pre-tokenising, and on encoding the
same words again.  Texts made only of Latin letters, digits, ASCII marks,
spaces and newlines, whose pre-token classes are certain, are cut here with
the same pattern and each distinct pre-token goes once per worker through the
library's BPE model.  Whole texts of that kind are cut many at a time, on the
classes of their bytes, and pre-tokens of up to 16 bytes are looked up by those
bytes (``_Table``).  Any other piece of text (between a space or newline
after a character that is no white space, where a pre-token always starts)
goes through the library's ``encode`` as it is.  The ids are the library's.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Callable, Iterable

import numpy as np

#: pre-tokens a worker remembers before it starts afresh (about 200 MB)
CACHE_TOKENS = 1_000_000
LONGEST_CACHED = 48
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
_MARK = "!-/:-@\\[-`{-~"
_CERTAIN = re.compile(f"[{_LETTER}0-9{_MARK} \n]*")
# fixed value: the pre-token pattern of this vocabulary, for certain characters
_PRE_TOKEN = re.compile(
    f" ?[{_LETTER}]+| ?[0-9]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{_MARK}]+|[ \n]+(?![^ \n])|[ \n]+")   # words first: most are
_PIECE = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_OTHER_SPACE = re.compile(r"[^\S \n]")
#: classes of the bytes of certain texts: white space, then digits, marks and letters
_WHITE, _DIGIT, _MARKS, _LETTERS = range(4)
_CLASS = np.full(256, _LETTERS, np.uint8)
_CLASS[[i for i in range(128) if not chr(i).isalpha()]] = _MARKS
_CLASS[48:58] = _DIGIT
_CLASS[[10, 32]] = _WHITE
_KEY = 16                  # bytes of a pre-token that the table finds
_GROUP = 1 << 20           # characters of texts cut at once; a text above four times that goes alone, by the pattern
_encoders: dict[str, Encoder] = {}


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class _Known(dict):
    """Ids of the pre-tokens met so far; ``long`` has those of one text that are too long to keep."""

    def __init__(self, ids_of: Callable[[str], bytes]):
        super().__init__()
        self.ids_of, self.long = ids_of, {}

    def __missing__(self, token: str) -> bytes:
        held = self
        if len(token) > LONGEST_CACHED:
            held = self.long
            if token in held:
                return held[token]
        elif len(self) >= CACHE_TOKENS:
            self.clear()
        held[token] = ids = self.ids_of(token)
        return ids


def cut(body: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of certain texts begin; ``starts`` are those of the texts, none empty."""
    kind = _CLASS.take(body)
    white, space = kind == _WHITE, body == 32
    first = np.zeros(len(body) + 4, bool)
    first[starts] = True
    text = first[:len(body)].copy()
    begin = first[:len(body)]
    begin[1:] |= (kind[1:] != kind[:-1]) & ~space[:-1]     # a space goes with what follows
    begin[1:] |= white[1:] & ~white[:-1]
    begin[1:-1] |= white[1:-1] & ~white[2:] & ~text[2:]    # the last of a run before another character
    at = np.flatnonzero(begin & (body == 39))
    ahead = np.zeros(3, np.uint8)
    one, two = (np.concatenate([body, ahead])[at + i] for i in (1, 2))
    ends = np.append(text, [True] * 3)
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
    short, long = short & ~ends[at + 1], long & ~ends[at + 1] & ~ends[at + 2]
    first[at[short | long] + 1] = False
    first[at[short] + 2] = True
    first[at[long] + 3] = True
    return np.flatnonzero(begin)


class _Table:
    """Ids of pre-tokens by their bytes: open addressing, many look-ups at a time."""

    SLOTS = 21             # 2^21, at most half of them taken

    def __init__(self):
        self.low, self.high = (np.zeros(1 << self.SLOTS, np.uint64) for _ in range(2))
        self.word = np.zeros(1 << self.SLOTS, np.int32)
        self.begin, self.count, self.ids = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 18, "<u4")
        self.n = self.n_ids = 0

    def clear(self) -> None:
        self.low[:] = self.high[:] = 0
        self.n = self.n_ids = 0

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mixed = (low ^ high * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xC2B2AE3D27D4EB4F)
        return ((mixed ^ mixed >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.SLOTS)).view(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The number of each pre-token, or -1."""
        slot, left = self._slot(low, high), None
        out = np.full(len(low), -1, np.int32)
        while len(slot):
            held = self.low.take(slot)
            same = (held == low) & (self.high.take(slot) == high)
            hit = np.flatnonzero(same)
            out[hit if left is None else left[hit]] = self.word.take(slot[hit])
            on = np.flatnonzero(~same & (held != 0))
            left = on if left is None else left[on]
            low, high, slot = low[on], high[on], slot[on] + 1 & (1 << self.SLOTS) - 1
        return out

    def add(self, ids: list[bytes]) -> np.ndarray:
        """Numbers for new pre-tokens of these ids."""
        flat, count = np.frombuffer(b"".join(ids), "<u4"), np.array([len(i) // 4 for i in ids], np.int64)
        n, n_ids = self.n + len(ids), self.n_ids + len(flat)
        if n > len(self.begin):
            self.begin, self.count = np.resize(self.begin, 2 * n), np.resize(self.count, 2 * n)
        if n_ids > len(self.ids):
            self.ids = np.resize(self.ids, 2 * n_ids)
        self.ids[self.n_ids:n_ids] = flat
        self.begin[self.n:n] = self.n_ids + np.cumsum(count) - count
        self.count[self.n:n] = count
        made = np.arange(self.n, n, dtype=np.int32)
        self.n, self.n_ids = n, n_ids
        return made

    def keep(self, low: np.ndarray, high: np.ndarray, word: np.ndarray) -> None:
        """File different new pre-tokens."""
        slot = self._slot(low, high)
        while len(slot):
            free = np.flatnonzero(self.low.take(slot) == 0)
            at = slot[free]
            self.low[at], self.high[at], self.word[at] = low[free], high[free], word[free]
            on = np.flatnonzero((self.low.take(slot) != low) | (self.high.take(slot) != high))
            low, high, word, slot = low[on], high[on], word[on], slot[on] + 1 & (1 << self.SLOTS) - 1

    def spell(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, and where each word's end."""
        count = self.count.take(word)
        end = np.cumsum(count)
        return self.ids.take(np.repeat(self.begin.take(word) - end + count, count) + np.arange(end[-1])), end


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.model = self.library.model
        self.letters = _byte_letters()
        self.known = _Known(self._model_ids)
        self.table = _Table()

    def _model_ids(self, token: str) -> bytes:
        if token.isascii() and "\n" not in token:
            shown = token.replace(" ", self.letters[32])
        else:
            shown = token.encode().decode("latin-1").translate(self.letters)
        return _packed([t.id for t in self.model.tokenize(shown)])

    def _library_ids(self, text: str) -> bytes:
        return _packed(self.library.encode(text, add_special_tokens=False).ids)

    def _certain(self, text: str) -> bytes:
        self.known.long.clear()
        return b"".join(map(self.known.__getitem__, _PRE_TOKEN.findall(text)))

    def _any(self, text: str) -> bytes:
        special = any(s in text for s in self.special)
        if _OTHER_SPACE.search(text):
            return self._library_ids(text)
        parts, plain = [], []
        for piece in _PIECE.findall(text):   # neighbours of the same kind go together
            if _CERTAIN.fullmatch(piece) and not (special and any(s in piece for s in self.special)):
                plain.append(piece)
                continue
            if plain:
                parts.append(self._certain("".join(plain)))
                plain = []
            parts.append(self._library_ids(piece))
        if plain:
            parts.append(self._certain("".join(plain)))
        return b"".join(parts)

    def _is_certain(self, text: str) -> bool:
        return _CERTAIN.fullmatch(text) is not None and not any(s in text for s in self.special)

    def _group(self, texts: list[str]) -> list[bytes]:
        """Ids of certain texts, none empty."""
        raw = [t.encode() for t in texts]
        size = np.array([len(r) for r in raw])
        text_at = np.cumsum(size) - size
        whole = b"".join(raw)
        body = np.frombuffer(whole + bytes(_KEY), np.uint8)
        begin = cut(body[:len(whole)], text_at)
        length = np.diff(begin, append=len(whole))
        key = np.lib.stride_tricks.sliding_window_view(body, _KEY)[begin].view("<u8")
        mask = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
        low, high = key[:, 0] & mask.take(np.minimum(length, 8)), key[:, 1] & mask.take(np.clip(length - 8, 0, 8))
        word = self.table.find(low, high)
        long = length > _KEY
        word[long] = -1
        missed = np.flatnonzero(word < 0)
        if self.table.n + len(missed) > CACHE_TOKENS:
            self.table.clear()
            word[:] = -1
            missed = np.arange(len(word))
        tokens = [whole[a:a + n] for a, n in zip(begin[missed].tolist(), length[missed].tolist(), strict=True)]
        place: dict[bytes, int] = {}
        order = np.array([place.setdefault(t, len(place)) for t in tokens], np.int64)
        n, n_ids = self.table.n, self.table.n_ids
        short = [t for t in place if len(t) <= _KEY]
        rest = [t for t in place if len(t) > _KEY]
        self.known.long.clear()
        ids = [self._model_ids(t.decode()) for t in short] + [self.known[t.decode()] for t in rest]
        if ids:
            at = np.array([place[t] for t in short + rest], np.int64)
            made = np.empty(len(place), np.int32)
            made[at] = self.table.add(ids)
            word[missed] = made[order]
            where = np.empty(len(place), np.int64)
            where[order] = missed
            where = where[at[:len(short)]]
            self.table.keep(low[where], high[where], word[where])
        spelt, end = self.table.spell(word)
        self.table.n, self.table.n_ids = n + len(short), n_ids + sum(len(i) // 4 for i in ids[:len(short)])   # long ones go again
        last = end[np.append(np.searchsorted(begin, text_at[1:]), len(begin)) - 1].tolist()
        return [spelt[a:b].tobytes() for a, b in zip([0, *last], last)]

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of every text."""
        out: list[bytes] = []
        held: list[tuple[int, str]] = []
        size = 0

        def cut_held() -> None:
            for (i, _), ids in zip(held, self._group([t for _, t in held]), strict=True):
                out[i] = ids
            held.clear()

        for i, text in enumerate(texts):
            out.append(b"")
            if not text:
                continue
            if not self._is_certain(text):
                out[i] = self._any(text)
            elif len(text) > 4 * _GROUP:
                out[i] = self._certain(text)
            else:
                held.append((i, text))
                size += len(text)
                if size > _GROUP:
                    cut_held()
                    size = 0
        if held:
            cut_held()
        return out


def encoder(path: str) -> Encoder:
    """The worker's encoder for this file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
