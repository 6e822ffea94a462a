"""Shingle sets and SuperMinHash signatures of texts, for use inside tasks.

SuperMinHash gives every element a random permutation of the signature's slots; the element offers slot p[j] the value
j + r with r in [0, 1). The ranks j of an element are correlated, each slot gets a low rank from some element, and the
estimate of the Jaccard similarity varies less than that of independent hashes. A slot that has a value of rank j needs no
higher rank, so a document stops as soon as all its slots are filled: after one or two ranks if it has many shingles.
"""

from __future__ import annotations

import numpy as np
import xxhash

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Elements that are hashed together; longer documents are cut and their parts' signatures merged by the minimum.
BLOCK = 1 << 15


def mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of the splitmix64 generator."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; A-Z lowered, words between ASCII white space.

    With fewer than k words the whole sequence is one shingle; without words the set is empty.
    """
    # Lower-casing and splitting of bytes know ASCII only, which is the definition of a word here.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=n)
    size = min(k, n)
    shingles = np.full(n - size + 1, size, dtype=np.uint64)
    for j in range(size):
        shingles = mixed((shingles ^ hashes[j : n - size + 1 + j]) + _STEP)
    return np.unique(shingles)


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that equal sets share."""
    return xxhash.xxh3_128_digest(shingles.tobytes())


def signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """One row of `slots` values per set; empty sets have no values."""
    out = np.full((len(sets), slots), _EMPTY, dtype=np.uint64)
    block: list[tuple[int, np.ndarray]] = []
    size = 0
    for i, s in enumerate(sets):
        for at in range(0, len(s), BLOCK):
            part = s[at : at + BLOCK]
            if size + len(part) > BLOCK:
                _merge(out, block, slots)
                block, size = [], 0
            block.append((i, part))
            size += len(part)
    _merge(out, block, slots)
    return out


def _merge(out: np.ndarray, block: list[tuple[int, np.ndarray]], slots: int) -> None:
    if block:
        rows = _block_signatures([p for _, p in block], slots)
        for (i, _), row in zip(block, rows, strict=True):
            np.minimum(out[i], row, out=out[i])


def _block_signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """All ranks of all elements of some sets, rank by rank, until every set's slots are filled."""
    found = np.full((len(sets), slots), _EMPTY, dtype=np.uint64)
    flat = found.reshape(-1)
    element = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    places = None
    for rank in range(slots):
        draw = mixed(element + np.uint64((rank + 1) * int(_STEP) & 0xFFFFFFFFFFFFFFFF))
        value = (draw & np.uint64(0xFFFFFFFF)) | np.uint64(rank << 32)
        # One of the slots that the element has not had yet: a step of the Fisher-Yates shuffle.
        pick = rank + ((draw >> np.uint64(32)) * np.uint64(slots - rank) >> np.uint64(32)).astype(np.int64)
        if places is None:
            slot = pick
        else:
            rows = np.arange(len(element))
            slot = places[rows, pick].astype(np.int64)
            places[rows, pick] = places[:, rank]
        np.minimum.at(flat, owner * slots + slot, value)
        unfilled = (found == _EMPTY).any(axis=1)
        stay = unfilled[owner]
        if not stay.any():
            break
        if places is None:
            element, owner, pick = element[stay], owner[stay], pick[stay]
            places = np.tile(np.arange(slots, dtype=np.int16), (len(element), 1))
            places[np.arange(len(element)), pick] = 0
        elif not stay.all():
            element, owner, places = element[stay], owner[stay], places[stay]
    return found


def band_keys(rows: np.ndarray, bands: int, per_band: int) -> np.ndarray:
    """One key per band of the signatures; the band's number is part of it."""
    keys = np.empty((len(rows), bands), dtype=np.uint64)
    for b in range(bands):
        key = np.full(len(rows), b + 1, dtype=np.uint64)
        for j in range(per_band):
            key = mixed((key ^ rows[:, b * per_band + j]) + _STEP)
        keys[:, b] = key
    return keys.view(np.int64)


def short_signature(rows: np.ndarray) -> np.ndarray:
    """16 bits of each value, for estimates."""
    return (mixed(rows) & np.uint64(0xFFFF)).astype(np.uint16)
