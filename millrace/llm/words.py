"""Splitting texts into words and hashing them, many documents at a time (numpy, inside tasks).

A word is a run of characters other than blank, tab and the line breaks 0x0A to 0x0D. All
of these are single bytes in UTF-8, so texts are handled as their UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: What a task holds of texts at once, in bytes; one longer document is cut at white space.
SLICE_BYTES = 1 << 20

#: Bytes that part words.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


#: Bytes that part words of letters and digits: all other ASCII characters.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _odd_powers(base: int, count: int) -> np.ndarray:
    powers = np.full(count, base, dtype=np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64's finalizer)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Sums:
    """Hashes of runs of a sequence from one running sum: a polynomial modulo 2**64.

    The hash of items i..j-1 is (P[j] - P[i]) / base**i, mixed; the base is odd, so it can
    be divided by.
    """

    def __init__(self, base: int, seed: int = 0):
        self.base, self.seed = base | 1, np.uint64(seed)
        self.inverse = pow(self.base, -1, 1 << 64)
        self._up = self._down = np.empty(0, dtype=np.uint64)

    def _grown(self, count: int) -> None:
        if len(self._up) < count:
            count = max(count, 2 * len(self._up), 1024)
            self._up, self._down = _odd_powers(self.base, count), _odd_powers(self.inverse, count)

    def running(self, values: np.ndarray) -> np.ndarray:
        self._grown(len(values) + 1)
        sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self._up[: len(values)], out=sums[1:])
        return sums

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(((sums[end] - sums[start]) * self._down[start]) ^ self.seed)


_BYTES = Sums(0x9E3779B97F4A7C15)
_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def _spans(data: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    solid = np.zeros(len(data) + 2, dtype=np.int8)
    solid[1:-1] = ~between[data]
    steps = np.diff(solid)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def _hash_block(block: bytes, between: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(block, dtype=np.uint8)
    start, end = _spans(data, between)
    sums = _BYTES.running(_BYTE_CODES[data])
    return start, _BYTES.of(sums, start, end)


def hashed(texts: list[bytes], between: np.ndarray = SPACE) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(index of the first text, word hashes per text) for runs of texts of some SLICE_BYTES.

    `between`: which bytes part words; the line feed is one of them.
    """
    at = 0
    while at < len(texts):
        if len(texts[at]) > SLICE_BYTES:
            yield at, [_long(texts[at], between)]
            at += 1
            continue
        size, end = 0, at
        while end < len(texts) and (end == at or size + len(texts[end]) + 1 <= SLICE_BYTES):
            size += len(texts[end]) + 1
            end += 1
        run = texts[at:end]
        start, hashes = _hash_block(b"\n".join(run), between)
        ends = np.cumsum([len(t) + 1 for t in run])
        cuts = np.searchsorted(start, ends[:-1])
        yield at, np.split(hashes, cuts)
        at = end


def _long(text: bytes, between: np.ndarray) -> np.ndarray:
    parts, at = [], 0
    while at < len(text):
        end = min(len(text), at + SLICE_BYTES)
        while end < len(text) and not between[text[end]]:
            end += 1
        parts.append(_hash_block(text[at:end], between)[1])
        at = end
    return np.concatenate(parts)


def utf8(column) -> list[bytes]:
    """An Arrow string column as bytes per row; null is the empty text."""
    import pyarrow as pa

    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]
