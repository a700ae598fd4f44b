"""Circulant MinHash: all coordinates of a signature from two permutations, one of them shifted circularly."""

from __future__ import annotations

import functools
import hashlib

import numpy as np

#: Positions that shingle hashes are dealt to; the permutations are over these.
UNIVERSE = 1 << 18
#: Bands of a signature. The coordinates in each follow from the similarity (see ``rows_for``): 8 at 0.85, 6 at 0.8.
BANDS = 48
#: Chance that a pair at the limit shares no band.
MISS = 1e-6
#: Words whose hashes a Python worker keeps; beyond that, new ones are kept for one text only.
MEMO = 100_000
#: Rows of the shifted permutation that are looked up at once.
STEP = 2048
_MIX = np.uint64(0xFF51AFD7ED558CCD)

_kept: dict[bytes, int] = {}


def words_of(data: bytes) -> list[bytes]:
    """Words of a text with A to Z in lower case."""
    return data.lower().split()


def digest(words: list[bytes]) -> bytes:
    """128 bits that stand for a sequence of words: texts with the same have the same shingles."""
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    kept, new = _kept, xxhash.xxh3_64_intdigest
    found = [kept.get(w) for w in words]
    if None in found:
        fresh = {w: new(w) for w, h in zip(words, found) if h is None}
        if len(kept) < MEMO:
            kept.update(fresh)
        found = [fresh[w] if h is None else h for w, h in zip(words, found)]
    return np.array(found, dtype=np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * _MIX
    return values ^ (values >> np.uint64(29))


def shingle_set(words: list[bytes], length: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; a text of fewer words has one shingle, its whole sequence."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = word_hashes(words)
    size = min(length, len(words))
    total = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        total = mixed(total + hashes[i : len(words) - size + 1 + i])
    return np.unique(total)


@functools.cache
def permutations(universe: int, coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    """The first permutation, and for each position the second one from there on, once round."""
    rng = np.random.default_rng(20240201)
    first = rng.permutation(universe).astype(np.int32)
    second = rng.permutation(universe).astype(np.int32)
    return first, np.lib.stride_tricks.sliding_window_view(np.concatenate([second, second[:coordinates]]), coordinates)


def rows_for(similarity: float, bands: int = BANDS, miss: float = MISS) -> int:
    """The most coordinates that a band may have for a pair of this similarity to share one, but for a chance of ``miss``."""
    return max(1, max((r for r in range(1, 33) if (1 - similarity**r) ** bands <= miss), default=1))


def signature(shingles: np.ndarray, rows: int, bands: int = BANDS, universe: int = UNIVERSE) -> np.ndarray:
    """The least value of the second permutation, shifted by 0, 1, 2, ... positions, over the first one's positions."""
    first, shifted = permutations(universe, bands * rows)
    at = np.unique(first[(shingles % np.uint64(universe)).astype(np.int64)]) if len(shingles) > STEP else first[(shingles % np.uint64(universe)).astype(np.int64)]
    least = shifted[at[:STEP]].min(axis=0)
    for start in range(STEP, len(at), STEP):
        np.minimum(least, shifted[at[start : start + STEP]].min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray, rows: int, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key for each band, the number of the band being part of it."""
    table = least.reshape(bands, rows).astype(np.uint64)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + table[:, i])
    return keys.view(np.int64)
