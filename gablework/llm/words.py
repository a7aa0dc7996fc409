"""Words and word runs of many texts at once, as numpy arrays of hashes.

Hashes are polynomials modulo 2**64 over bytes, then over word hashes, both from prefix sums, so a run of
any length costs the same. They depend on nothing but the text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BASE, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)  # odd
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
# Words of letters and digits in one case: other ASCII characters separate, all others belong.
PLAIN = np.arange(256, dtype=np.uint8)
PLAIN[ord("A") : ord("Z") + 1] += 32
OTHER = np.ones(256, bool)
OTHER[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    known = _powers.get(int(base))
    if known is None or len(known[0]) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        up, down = np.full(size, base), np.full(size, inverse)
        up[0] = down[0] = 1
        known = _powers[int(base)] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return known[0][:n], known[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of some texts, end to end: byte places, hashes, and the first word of each text."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # of length texts + 1

    def prefix(self, base: np.uint64) -> np.ndarray:
        up, _ = powers(base, len(self.hashes))
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.hashes * up, dtype=np.uint64)])

    def runs(self, prefix: np.ndarray, base: np.uint64, at: np.ndarray, length) -> np.ndarray:
        """Hashes of runs of words that start at ``at``."""
        _, down = powers(base, len(self.hashes))
        length = np.asarray(length)
        return mix((prefix[at + length] - prefix[at]) * down[at] + length.astype(np.uint64))


def split(texts: list[bytes], blank: np.ndarray = BLANKS, fold: np.ndarray | None = None) -> Words:
    """Words of the texts; ``blank`` says which bytes separate, ``fold`` maps bytes before hashing."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    borders = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
    solid = ~blank[data]
    before = np.concatenate([[False], solid[:-1]]) if len(data) else solid
    before[borders[:-1][borders[:-1] < len(data)]] = False
    after = np.concatenate([solid[1:], [False]]) if len(data) else solid
    after[borders[1:][borders[1:] > 0] - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    up, down = powers(BASE, max(len(data), 1))
    values = _BYTE[fold[data] if fold is not None else data]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[: len(data)], dtype=np.uint64)])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)) if len(starts) else np.empty(0, np.uint64)
    return Words(data, starts, ends, hashes, np.searchsorted(starts, borders))


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each window of ``width``, by doubling; one result per full window."""
    out, covered = values, 1
    while covered < width:
        step = min(covered, width - covered)
        out = np.minimum(out[:-step], out[step:])
        covered += step
    return out
