"""Sorted whole numbers in few bits, searched without unpacking (Elias-Fano).

n numbers below u take about 2 + log2(u / n) bits each: the low bits side by side,
the high ones in unary. All questions are asked for whole arrays at a time.
"""

from __future__ import annotations

import json

import numpy as np

U64 = np.uint64
_POPULATION = np.array([bin(i).count("1") for i in range(256)], np.uint8)
#: Place of the r-th set bit of a byte.
_SELECT = np.zeros((256, 8), np.uint8)
for _byte in range(256):
    for _rank, _bit in enumerate(i for i in range(8) if _byte >> i & 1):
        _SELECT[_byte, _rank] = _bit
_CHUNK = 1 << 16


def _packed(flags: np.ndarray) -> np.ndarray:
    """Bits as 64-bit words, lowest first."""
    data = np.packbits(flags, bitorder="little")
    return np.concatenate((data, np.zeros(-len(data) % 8, np.uint8))).view(U64)


def _bit_in_word(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The place of the rank-th set bit of each word."""
    data = np.ascontiguousarray(words).view(np.uint8).reshape(-1, 8)
    upto = np.cumsum(_POPULATION[data], axis=1, dtype=np.int64)
    byte = (upto <= rank[:, None]).sum(axis=1)
    row = np.arange(len(words))
    before = np.where(byte > 0, upto[row, byte - 1], 0)
    return 8 * byte + _SELECT[data[row, byte], rank - before]


class EliasFano:
    """Numbers that never fall, from 0 up; ``of`` compresses them, ``arrays`` is what to store."""

    def __init__(self, size: int, width: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.size, self.width, self.low, self.high, self.ones = int(size), int(width), low, high, ones
        # zeros before each word: with the ones, the directory of both kinds of bits
        self.zeros = 64 * np.arange(len(high), dtype=np.int64) - ones

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        most = int(values[-1]) + 1 if n else 1
        width = max(0, (most // max(n, 1)).bit_length() - 1)
        lows = []
        for at in range(0, n, _CHUNK):
            part = values[at : at + _CHUNK, None] >> np.arange(width)
            lows.append((part & 1).astype(bool).ravel())
        low = _packed(np.concatenate([*lows, np.zeros(64, bool)]))
        flags = np.zeros(n + (most >> width) + 2, bool)
        flags[(values >> width) + np.arange(n)] = True
        high = _packed(flags)
        ones = _POPULATION[high.view(np.uint8)].reshape(-1, 8).sum(axis=1, dtype=np.int64)
        return cls(n, width, low, high, np.cumsum(ones) - ones)

    def arrays(self) -> dict[str, np.ndarray]:
        return {"shape": np.array([self.size, self.width]), "low": self.low, "high": self.high, "ones": self.ones}

    @classmethod
    def over(cls, arrays: dict[str, np.ndarray]) -> EliasFano:
        """The same over stored arrays, which may be a mapped file."""
        return cls(*arrays["shape"], arrays["low"], arrays["high"], arrays["ones"])

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.int64)
        bit = i * self.width
        word, shift = bit >> 6, (bit & 63).astype(U64)
        out = self.low[word] >> shift
        # numpy leaves a shift by 64 undefined
        out |= np.where(shift > 0, self.low[word + 1] << (U64(64) - np.maximum(shift, U64(1))), U64(0))
        return (out & U64((1 << self.width) - 1)).astype(np.int64)

    def _select(self, rank: np.ndarray, before: np.ndarray, words: np.ndarray) -> np.ndarray:
        word = np.searchsorted(before, rank, "right") - 1
        return 64 * word + _bit_in_word(words[word], rank - before[word])

    def get(self, i: np.ndarray) -> np.ndarray:
        """The i-th numbers."""
        i = np.asarray(i, np.int64)
        out = np.zeros(len(i), np.int64)
        for at in range(0, len(i), _CHUNK):
            k = i[at : at + _CHUNK]
            high = self._select(k, self.ones, self.high) - k
            out[at : at + _CHUNK] = (high << self.width) | self._lows(k)
        return out

    def _begin(self, high: np.ndarray) -> np.ndarray:
        """How many numbers have smaller high bits."""
        out = np.zeros(len(high), np.int64)
        some = high > 0
        rank = high[some] - 1
        word = np.searchsorted(self.zeros, rank, "right") - 1
        out[some] = 64 * word + _bit_in_word(~self.high[word], rank - self.zeros[word]) - rank
        return out

    def successor(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the first numbers that are no smaller (``size`` if none is), and whether they are equal."""
        values = np.asarray(values, np.int64)
        place, equal = np.full(len(values), self.size, np.int64), np.zeros(len(values), bool)
        if not self.size:
            return place, equal
        last = int(self.get(np.array([self.size - 1]))[0])
        inside = np.flatnonzero(values <= last)
        for at in range(0, len(inside), _CHUNK):
            own = inside[at : at + _CHUNK]
            x = values[own]
            begin, stop = self._begin(x >> self.width), self._begin((x >> self.width) + 1)
            end, low = stop.copy(), x & ((1 << self.width) - 1)
            while (open_ := begin < end).any():
                middle = (begin + end) // 2
                less = self._lows(np.minimum(middle, self.size - 1)) < low
                begin, end = np.where(open_ & less, middle + 1, begin), np.where(open_ & ~less, middle, end)
            place[own] = begin
            equal[own] = (begin < stop) & (self._lows(np.minimum(begin, self.size - 1)) == low)
        return place, equal


def to_bytes(arrays: dict[str, np.ndarray]) -> bytes:
    """Named arrays in one run of bytes, each at a multiple of eight."""
    parts, index, at = [], {}, 0
    for name, array in arrays.items():
        data = np.ascontiguousarray(array).tobytes()
        index[name] = (array.dtype.str, at, len(array))
        parts.append(data + bytes(-len(data) % 8))
        at += len(parts[-1])
    head = json.dumps(index).encode()
    head += b" " * (-len(head) % 8)
    return len(head).to_bytes(8, "little") + head + b"".join(parts)


def from_bytes(data) -> dict[str, np.ndarray]:
    """The arrays, as views of the bytes (or of a mapped file)."""
    size = int.from_bytes(data[:8], "little")
    index = json.loads(bytes(data[8 : 8 + size]))
    return {name: np.frombuffer(data, kind, n, 8 + size + at) for name, (kind, at, n) in index.items()}
