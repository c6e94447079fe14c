"""Fast similarity sketching: a MinHash of fixed width whose every place is filled.

Round after round each element of the set is thrown into one of the places by a
fresh hash; a place keeps the smallest value of the first round that reached it.
After as many rounds as there are places, a place still empty takes the smallest
value of the whole set under a hash of its own.  So every place is filled after at
most twice as many rounds as places, two sets agree in a place with the chance of
their Jaccard similarity, and the number of agreements is concentrated as for
independent places.
"""

from __future__ import annotations

import numpy as np

from newsloom.llm.shared import mixed

_STEP = np.uint64(0xD6E8FEB86659FD93)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _seeds(first: int, last: int) -> np.ndarray:
    return mixed((np.arange(first, last, dtype=np.uint64) + np.uint64(1)) * _STEP)


def sketch(elements: np.ndarray, places: int) -> np.ndarray:
    """The sketch of a non-empty set of 64-bit ids; ``places`` is a power of two."""
    found = np.full(places, _EMPTY)
    low = np.uint64(places - 1)
    at_once = max(1, 4 * places // len(elements))  # rounds worked out together
    for first in range(0, places, at_once):
        last = min(first + at_once, places)
        hashes = mixed(elements[None, :] ^ _seeds(first, last)[:, None])
        bins = (hashes & low).astype(np.int64)
        if last - first > 1:
            rounds = np.repeat(np.arange(last - first), len(elements))
            bins, hashes = bins.ravel(), hashes.ravel()
            reached = np.full(places, last - first)
            np.minimum.at(reached, bins, rounds)
            now = reached[bins] == rounds
            bins, hashes = bins[now], hashes[now]
        made = np.full(places, _EMPTY)
        np.minimum.at(made, bins.ravel(), hashes.ravel())
        found = np.where(found == _EMPTY, made, found)
        if (found != _EMPTY).all():
            return found
    for place in np.flatnonzero(found == _EMPTY):
        found[place] = mixed(elements ^ _seeds(places + place, places + place + 1)).min()
    return found


def band_keys(places: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` places; keys of different bands differ."""
    grouped = places[: rows * bands].reshape(bands, rows)
    keys = _seeds(1 << 20, (1 << 20) + bands)
    for k in range(rows):
        keys = mixed(keys ^ grouped[:, k])
    return keys
