"""Byte-level pre-tokens of many texts at once, cut and looked up by numpy.

A byte-level BPE first cuts a text into pre-tokens and never merges across them.
The cuts depend on the class of each character only (letter, number, space, other),
and those classes are asked of the tokenizers library itself, for every code point, so
texts of all scripts are cut alike and as the library cuts them.

A pre-token of up to 16 bytes is two 64-bit words and a length: an exact key, no
hash of it.  ``Table`` maps such keys to numbers in a compact open table: a key has one slot,
and is there or isn't.  A worker looks all pre-tokens of a block up in a frequent table that
was sent to it, then in a table of its own, and gives the library what is in neither.
"""

from __future__ import annotations

import json
import re

import numpy as np

OTHER, LETTER, NUMBER, SPACE = range(4)
#: Code points from here on are private or unassigned but for some format characters: no letters, numbers or spaces.
ASKED = 0x40000
#: Characters in a block, about; bytes of a pre-token that the tables hold.
BLOCK, HELD = 1 << 18, 16
#: Slots of the frequent table, of a worker's own table, and entries of its dictionary of longer pre-tokens.
SENT_SLOTS, OWN_SLOTS, LONGER = 1 << 18, 1 << 20, 50_000
#: Bytes of a longer pre-token that is kept.
LONGER_BYTES = 256
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9)]
_ONES = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1] * 9, np.uint64)  # masks of the first word by length
_REST = np.array([0] * 9 + [(1 << 8 * k) - 1 for k in range(1, 8)] + [(1 << 64) - 1], np.uint64)  # and of the second

_classes: dict[str, np.ndarray] = {}


def load(path: str):
    """The tokenizer of a file, and a pattern of its added tokens (None if it has none).

    Without normalizer and with the plain byte-level pre-tokenizer; another file raises.
    """
    from tokenizers import Tokenizer

    with open(path) as f:
        config = json.load(f)
    cutter = config["pre_tokenizer"] or {}
    if config["normalizer"] or (cutter.get("type"), cutter.get("add_prefix_space"), cutter.get("use_regex")) != ("ByteLevel", False, True):
        raise ValueError(f"{path} isn't a plain byte-level BPE")
    added = [t["content"] for t in config["added_tokens"]]
    return Tokenizer.from_file(path), re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in the files' vocabularies: itself if it prints, else one from U+0100 on, in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def character_classes(path: str) -> np.ndarray:
    """The class of every code point: a character is of the class of the neighbour that the pre-tokenizer leaves it with."""
    if path not in _classes:
        cutter, found = load(path)[0].pre_tokenizer, np.full(0x110000, OTHER, np.uint8)
        marks = (("!", OTHER), ("a", LETTER), ("1", NUMBER))
        for first in range(0, ASKED, 64):
            if 0xD800 <= first < 0xE000:
                continue
            points = range(first, first + 64)
            together = "".join(map(chr, points))
            same = [value for mark, value in marks if len(cutter.pre_tokenize_str(mark + together)) == 1]
            if same:
                found[first : first + 64] = same[0]
                continue
            found[first : first + 64] = SPACE
            for mark, value in marks:
                cuts = {a for _, (a, _) in cutter.pre_tokenize_str("".join(f"{mark}{chr(c)}\n" for c in points))}
                found[[c for i, c in enumerate(points) if 3 * i + 1 not in cuts]] = value
        _classes[path] = found
    return _classes[path]


def cuts_of(points: np.ndarray, kind: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where the pre-tokens begin in ``points``, code points of class ``kind``; texts, none of them empty, begin at ``begins``."""
    n = len(points)
    first = np.empty(n, bool)
    first[0] = True
    np.not_equal(kind[1:], kind[:-1], out=first[1:])
    opens = np.zeros(n + 1, bool)
    opens[begins] = True
    opens[n] = True
    first |= opens[:n]
    start = np.flatnonzero(first)
    end = np.append(start[1:], n)
    run = kind[start]
    follows = ~opens[end]  # another run of the same text comes next
    blank = run == SPACE
    plain = points[end - 1] == 32
    # A plain space goes with the run behind it; other spaces before a run are a piece of all but the last, and the last.
    joins = blank & follows & plain
    mark = np.zeros(n + 1, bool)
    mark[start[~joins]] = True
    long = blank & (end - start > 1)
    mark[start[joins & long]] = True
    mark[end[blank & follows] - 1] = True
    behind = np.zeros(len(start), bool)  # runs that begin with the space before them
    behind[1:] = joins[:-1]
    mark[start[behind]] = False
    # A lone apostrophe, not behind such a space, takes s, t, m, d, re, ve or ll from the letters that follow.
    quote = np.flatnonzero((points[start] == 39) & (end - start == 1) & ~behind & follows)
    if len(quote):
        quote = quote[run[quote + 1] == LETTER]
        at, stop = end[quote], end[quote + 1]
        one = points[at]
        two = np.where(at + 1 < stop, points[np.minimum(at + 1, n - 1)], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        wide = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        taken = np.where(short, 1, np.where(wide, 2, 0))
        at, stop, taken = at[taken > 0], stop[taken > 0], taken[taken > 0]
        mark[at] = False
        rest = at + taken < stop
        mark[(at + taken)[rest]] = True
    return np.flatnonzero(mark[:n])


class Table:
    """Numbers by exact keys of up to ``HELD`` bytes.  A key has one slot; the last one put there stays."""

    def __init__(self, slots: int):
        self.shift = np.uint64(64 - (slots.bit_length() - 1))
        self.low, self.high = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64)
        self.size, self.value = np.zeros(slots, np.uint8), np.zeros(slots, np.int64)

    def slots(self, low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = low * _MIX[0] ^ (high + size.astype(np.uint64)) * _MIX[1]
            return ((h ^ h >> np.uint64(29)) * _MIX[2] >> self.shift).astype(np.int64)

    def get(self, low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where it isn't there.  A size is 1 at least."""
        at = self.slots(low, high, size)
        return np.where((self.low[at] == low) & (self.high[at] == high) & (self.size[at] == size), self.value[at], -1)

    def put(self, low: np.ndarray, high: np.ndarray, size: np.ndarray, value: np.ndarray) -> None:
        at = self.slots(low, high, size)
        last = len(at) - 1 - np.unique(at[::-1], return_index=True)[1]  # of keys that share a slot, all columns from one
        at = at[last]
        self.low[at], self.high[at], self.size[at], self.value[at] = low[last], high[last], size[last], value[last]


def keys_of(data: bytes, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two words of each piece of ``data``, which is followed by ``HELD`` bytes at least; longer pieces' first bytes."""
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    held = np.minimum(size, HELD)
    return words[start] & _ONES[held], words[start + 8] & _REST[held]


class Pieces:
    """Looks up what a subclass works out for each pre-token; one a worker process and file.

    ``work_out(pieces)`` gives a number from 0 for each distinct piece.
    """

    def __init__(self, path: str, classes: np.ndarray, frequent: Table | None = None):
        self.tokenizer, self.special = load(path)
        self.classes, self.frequent = classes, frequent
        self.own, self.longer, self.letters = Table(OWN_SLOTS), {}, byte_letters()

    def work_out(self, pieces: list[bytes]) -> np.ndarray:
        raise NotImplementedError

    def encoded(self, pieces: list[bytes]) -> list[list]:
        """The library's tokens of each piece; a pre-token needs no cutting, so its model is asked directly."""
        model = self.tokenizer.model
        between = chr(0x400)  # no byte's character
        spelt = between.join([p.decode("latin-1") for p in pieces]).translate(self.letters).split(between)
        return [model.tokenize(p) for p in spelt] if pieces else []

    def parts(self, text: str) -> list[str]:
        """``text`` between added tokens, and in blocks: cut before a space, where a pre-token begins in any case."""
        out = []
        for part in self.special.split(text) if self.special else [text]:
            at = 0
            while len(part) - at > BLOCK:
                to = part.find(" ", at + BLOCK)
                while to > 0 and part[to - 1].isspace():
                    to = part.find(" ", to + 1)
                if to < 0:
                    break
                out.append(part[at:to])
                at = to
            out.append(part[at:])
        return out

    def cut(self, parts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all ``parts``, where each pre-token begins in them, its bytes, and how many pre-tokens each part has."""
        whole = "".join(parts)
        data = whole.encode()
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        begins = np.cumsum(size) - size
        if not data:
            return data, np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(parts), np.int64)
        if len(data) == len(whole):
            points = np.frombuffer(data, np.uint8)
        else:
            points = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        start = cuts_of(points, self.classes[points], begins[size > 0])
        upto = np.searchsorted(start, np.append(begins, len(points)))
        if len(data) != len(whole):
            wide = np.ones(len(points), np.uint8)
            for least in (0x80, 0x800, 0x10000):
                wide += points >= least
            start = (np.cumsum(wide, dtype=np.int64) - wide)[start]
        return data, start, np.diff(np.append(start, len(data))), np.diff(upto)

    def values(self, data: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The number of each pre-token."""
        low, high = keys_of(data + bytes(HELD), start, size)
        fits = size <= HELD
        held = size.astype(np.uint8)
        out = self.frequent.get(low, high, held) if self.frequent else np.full(len(start), -1)
        out[~fits] = -1
        left = np.flatnonzero((out < 0) & fits)
        if len(left):
            out[left] = self.own.get(low[left], high[left], held[left])
        left = np.flatnonzero(out < 0)
        if len(left):
            out[left] = self._missing(data, start[left], size[left], low[left], high[left], held[left])
        return out

    def _missing(self, data, start, size, low, high, held) -> np.ndarray:
        if len(self.longer) > LONGER:
            self.longer.clear()
        number: dict[bytes, int] = {}
        each = [number.setdefault(data[a:b], len(number)) for a, b in zip(start.tolist(), (start + size).tolist(), strict=True)]
        names = list(number)
        known = [self.longer.get(x) for x in names]
        new = [i for i, v in enumerate(known) if v is None]
        found = np.array([-1 if v is None else v for v in known], np.int64)
        if new:
            found[new] = self.work_out([names[i] for i in new])
        out = found[each]
        short = size <= HELD
        self.own.put(low[short], high[short], held[short], out[short])
        self.longer |= {names[i]: int(found[i]) for i in new if HELD < len(names[i]) <= LONGER_BYTES}
        return out

    def blocks(self, texts: list[str]):
        """(values of all pre-tokens, pre-tokens of each text, added tokens of each text or None) of runs of texts of about a block."""
        parts, owner, n, chars = [], [], 0, 0
        for text in texts:
            cut = self.parts(text)
            parts += cut
            owner += [n] * len(cut)
            n, chars = n + 1, chars + len(text)
            if chars >= BLOCK:
                yield self._block(parts, owner, n)
                parts, owner, n, chars = [], [], 0, 0
        if n:
            yield self._block(parts, owner, n)

    def _block(self, parts: list[str], owner: list[int], n: int):
        values, counts, first = [], [], 0
        while first < len(parts):  # a long text is several blocks
            last, chars = first, 0
            while last < len(parts) and chars < BLOCK:
                chars += len(parts[last])
                last += 1
            data, start, size, count = self.cut(parts[first:last])
            values.append(self.values(data, start, size))
            counts.append(count)
            first = last
        return np.concatenate(values), np.bincount(owner, np.concatenate(counts), n).astype(np.int64)


def frequent_pieces(pieces: Pieces, texts: list[str], most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """The most frequent pre-tokens of up to ``HELD`` bytes of ``texts``, the rarest first: their words, sizes, and themselves."""
    parts = [p for t in texts for p in pieces.parts(t)]
    data, start, size, _ = pieces.cut(parts)
    start, size = start[size <= HELD], size[size <= HELD]
    low, high = keys_of(data + bytes(HELD), start, size)
    keys = np.zeros(len(start), [("low", "u8"), ("high", "u8"), ("size", "u1")])
    keys["low"], keys["high"], keys["size"] = low, high, size
    _, at, count = np.unique(keys, return_index=True, return_counts=True)
    at = at[np.argsort(count, kind="stable")][-most:]
    return low[at], high[at], size[at].astype(np.uint8), [data[a : a + b] for a, b in zip(start[at].tolist(), size[at].tolist(), strict=True)]
