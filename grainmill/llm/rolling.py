"""Words of many texts at once, as 64-bit values in numpy, and values of their n-word windows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Breaks between plain words: all of ASCII but letters and digits.
_NOT_PLAIN = np.ones(256, bool)
_NOT_PLAIN[0x30:0x3A] = _NOT_PLAIN[0x41:0x5B] = _NOT_PLAIN[0x61:0x7B] = _NOT_PLAIN[0x80:] = False
_BYTES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_FOLDED = _BYTES.copy()
_FOLDED[0x41:0x5B] = _BYTES[0x61:0x7B]
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASES = (0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)
PIECE_BYTES = 1 << 20
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ... n - 1 modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(1024, 1 << (n - 1).bit_length()), base, np.uint64)
        have[0] = 1
        have = _powers[base] = np.multiply.accumulate(have)
    return have[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 2**64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit value over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of consecutive texts: their values, and for text i the range offsets[i] .. offsets[i + 1]."""

    values: np.ndarray
    offsets: np.ndarray

    def windows(self, n: int, base: int = WORD_BASES[0]) -> np.ndarray:
        """A value for the n words from each place on; meaningless where ``inside(n)`` is false."""
        count = len(self.values)
        if count < n:
            return np.zeros(count, np.uint64)
        run = np.zeros(count + 1, np.uint64)
        np.cumsum(self.values * powers(base, count), out=run[1:])
        out = np.zeros(count, np.uint64)
        out[: count - n + 1] = mix((run[n:] - run[:-n]) * powers(inverse(base), count - n + 1))
        return out

    def inside(self, n: int) -> np.ndarray:
        """Whether the n words from each place on belong to one text."""
        ends = np.repeat(self.offsets[1:], np.diff(self.offsets))
        return np.arange(len(self.values)) + n <= ends


def _piece(texts: list[bytes], fold: bool, plain: bool) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = (_NOT_PLAIN if plain else _SPACE)[data]
    before = np.empty_like(space)
    before[0], before[1:] = True, space[:-1]
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_FOLDED if fold else _BYTES)[data] * powers(BYTE_BASE, len(data)), out=run[1:])
    values = mix((run[ends] - run[starts]) * powers(inverse(BYTE_BASE), len(data))[starts] + (ends - starts).astype(np.uint64))
    stops = np.cumsum([len(t) + 1 for t in texts])
    return values, np.searchsorted(starts, stops)


def pieces(texts: list[bytes | None], size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes together; a longer text is a range of its own."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or b"") + 1
        if held > size and i > begin:
            yield begin, i
            begin, held = i, len(text or b"") + 1
    if begin < len(texts):
        yield begin, len(texts)


def words(texts: list[bytes | None], fold: bool = False, plain: bool = False) -> Words:
    """Words of the texts (what ``bytes.split()`` gives; null has none).

    ``fold``: A-Z count as a-z; ``plain``: all ASCII signs but letters and digits separate words too.
    """
    values, counts = [], []
    for begin, end in pieces(texts):
        got, stops = _piece([t or b"" for t in texts[begin:end]], fold, plain)
        values.append(got)
        counts.append(np.diff(stops, prepend=0))
    offsets = np.concatenate([[0], *counts]).cumsum() if counts else np.zeros(1, np.int64)
    return Words(np.concatenate(values) if values else np.zeros(0, np.uint64), offsets.astype(np.int64))


def found(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which keys occur in the sorted array."""
    if not len(among):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(among, keys)
    at[at == len(among)] = 0
    return among[at] == keys


def bucket_of(values: np.ndarray, n: int) -> np.ndarray:
    """A bucket 0 .. n - 1 from the upper bits of each value, in the order of the values."""
    return (((values >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)
