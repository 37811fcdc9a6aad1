"""Elias-Fano sequences and a two-level n-gram trie made of them, in one flat image.

A monotone sequence of n values below u is stored in about 2 + log2(u / n) bits a value: the low bits of
each packed side by side, the high bits as the gaps of a bit vector in which value i is a one at place
(high + i). Zeros of that vector end the runs of equal high bits, so the values with given high bits are
found by two selects on zeros, without decoding the rest.

The trie has the contexts (level 1), for each where its successors begin (pointers), and the successors
(level 2). Successors rise only within a context, so each is stored plus the last value of the context
before, which makes the level one monotone sequence; a context's successors are searched relative to that.
Each successor has a quantised value. The image holds nothing but these arrays: it can be sent as bytes,
written to a file and mapped, and is read in place.
"""

from __future__ import annotations

import numpy as np

ZERO_PLACES = np.array([[p for p in range(8) if not b >> p & 1] + [0] * (8 - sum(not b >> p & 1 for p in range(8))) for b in range(256)], np.uint8)
ZEROS = np.array([8 - bin(b).count("1") for b in range(256)], np.int64)


def encode(values: np.ndarray) -> list[np.ndarray]:
    """[n, low width, places; low bits; high bits; zeros and ones before each byte of the high bits]."""
    n = len(values)
    v = values.astype(np.uint64)
    top = int(v[-1]) + 1 if n else 1
    width = min(57, max(0, (top // max(n, 1)).bit_length() - 1))
    low = np.zeros((n * width + 7) // 8 + 8, np.uint8)
    for i in range(0, n if width else 0, 1 << 16):  # a multiple of eight values fills whole bytes
        part = v[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)[:, : (width + 7) // 8]
        packed = np.packbits(np.unpackbits(part, axis=1, count=width, bitorder="little"), bitorder="little")
        low[i * width // 8 : i * width // 8 + len(packed)] = packed
    places = (v >> np.uint64(width)).astype(np.int64) + np.arange(n)
    bits = np.zeros(((int(places[-1]) + 2 if n else 1) + 7) // 8 * 8, np.uint8)
    bits[places] = 1
    high = np.packbits(bits, bitorder="little")
    zeros = np.concatenate([[0], np.cumsum(ZEROS[high])]).astype(np.uint32)
    return [np.array([n, width], np.int64), low, high, zeros]


class Sequence:
    """A sequence read in place from the arrays of `encode`."""

    def __init__(self, arrays: list[np.ndarray]):
        head, self.low, self.high, self.zeros = arrays
        self.n, self.width = int(head[0]), int(head[1])
        # eight bytes from every byte on; with the place in the first byte they hold 57 bits
        self.words = np.ndarray(len(self.low) - 7, "<u8", self.low, 0, (1,))
        self.ones = 8 * np.arange(len(self.zeros), dtype=np.int64) - self.zeros  # before each byte

    def lows(self, i: np.ndarray) -> np.ndarray:
        """The low bits of the values at i."""
        if not self.width:
            return np.zeros(len(i), np.uint64)
        at = i * self.width
        word = self.words[at >> 3] >> (at & 7).astype(np.uint64)
        return word & np.uint64((1 << self.width) - 1)

    def before(self, high: np.ndarray) -> np.ndarray:
        """How many values have high bits below `high`: the place of the zero that ends those."""
        known = int(self.zeros[-1])
        wanted = np.minimum(high, known) - 1  # number of that zero
        byte = np.searchsorted(self.zeros, np.maximum(wanted, 0), side="right") - 1
        place = byte * 8 + ZERO_PLACES[self.high[byte], np.maximum(wanted, 0) - self.zeros[byte]]
        return np.minimum(np.where(wanted < 0, 0, place - wanted), self.n)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at i."""
        byte = np.searchsorted(self.ones, i, side="right") - 1
        rest = i - self.ones[byte]
        place = byte * 8 + ZERO_PLACES[self.high[byte] ^ 0xFF, rest]
        return ((place - i).astype(np.uint64) << np.uint64(self.width)) | self.lows(i)

    def find(self, wanted: np.ndarray, lo: np.ndarray | int = 0, hi: np.ndarray | None = None) -> np.ndarray:
        """Where each wanted value stands in [lo, hi), -1 where it does not. The values with its high bits
        are few; the first that is not below it is found by halving them."""
        high = (wanted >> np.uint64(self.width)).astype(np.int64)
        low = wanted & np.uint64((1 << self.width) - 1)
        last = self.before(high + 1)
        at, end = np.maximum(self.before(high), lo), last if hi is None else np.minimum(last, hi)
        limit = end.copy()
        left = np.flatnonzero(at < end)
        while len(left):
            half = (at[left] + end[left]) // 2
            below = self.lows(half) < low[left]
            at[left[below]] = half[below] + 1
            end[left[~below]] = half[~below]
            left = left[at[left] < end[left]]
        inside = np.flatnonzero(at < limit)
        out = np.full(len(wanted), -1)
        same = self.lows(at[inside]) == low[inside]
        out[inside[same]] = at[inside[same]]
        return out


def build(context: np.ndarray, successor: np.ndarray, value: np.ndarray) -> bytes:
    """The image of a trie from distinct (context, successor) pairs sorted by both, with a 16-bit value each."""
    contexts, first = np.unique(context, return_index=True)
    ends = np.append(first[1:], len(context))
    last = successor[ends - 1].astype(np.uint64) if len(contexts) else np.zeros(0, np.uint64)
    base = np.concatenate([[np.uint64(0)], np.cumsum(last)[:-1]]).astype(np.uint64) if len(contexts) else last
    level = successor.astype(np.uint64) + np.repeat(base, ends - first)
    arrays = [*encode(contexts), *encode(np.append(first, len(context))), *encode(level), value.astype(np.uint16)]
    head = np.array([x for a in arrays for x in (a.dtype.itemsize, len(a))], np.int64)
    parts = [head.tobytes()]
    for a in arrays:
        raw = a.tobytes()
        parts.append(raw + b"\0" * (-len(raw) % 8))
    return b"".join(parts)


class Trie:
    """A trie read in place from its image: bytes, a memory map, or any other buffer."""

    KINDS = [*[np.int64, np.uint8, np.uint8, np.uint32] * 3, np.uint16]

    def __init__(self, image):
        head = np.frombuffer(image, np.int64, 2 * len(self.KINDS))
        at, arrays = head.nbytes, []
        for kind, size, n in zip(self.KINDS, head[::2].tolist(), head[1::2].tolist()):
            arrays.append(np.frombuffer(image, kind, n, at))
            at += (size * n + 7) // 8 * 8
        self.contexts, self.pointers, self.level = (Sequence(arrays[i : i + 4]) for i in (0, 4, 8))
        self.values = arrays[12]

    def find(self, context: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """Where each pair's value stands, -1 for unknown pairs."""
        out = np.full(len(context), -1)
        distinct, inverse = np.unique(context, return_inverse=True)
        place = self.contexts.find(distinct.astype(np.uint64))
        known = place >= 0
        lo, hi = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        base = np.zeros(len(place), np.uint64)
        if known.any():
            lo[known] = self.pointers.get(place[known]).astype(np.int64)
            hi[known] = self.pointers.get(place[known] + 1).astype(np.int64)
            after = known & (lo > 0)
            base[after] = self.level.get(lo[after] - 1)
            asked = known[inverse]
            at = inverse[asked]
            out[asked] = self.level.find(successor[asked].astype(np.uint64) + base[at], lo[at], hi[at])
        return out
