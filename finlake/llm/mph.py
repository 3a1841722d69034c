"""Minimal perfect hash of 64-bit keys, in levels of bit arrays, built and probed with numpy.

A level hashes the keys that are left into somewhat more bits than keys; keys alone on their bit set it, the others go
to the next level.  A key's number is the rank of its bit among all set bits.
"""

from __future__ import annotations

import numpy as np

#: Bits for each key of a level.
GAMMA = 1.5


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """Well-spread 64-bit values of 64-bit keys (multiply and shift rounds)."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def build(keys: np.ndarray) -> tuple[np.ndarray, bytes]:
    """(bits of each level, packed bit arrays) for distinct keys."""
    sizes, bits, level = [], [], 0
    while len(keys):
        size = -(-max(64, int(GAMMA * len(keys))) // 8) * 8
        at = (mix(keys, level) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        keys = keys[~alone[at]]
        level += 1
        if level > 200:
            raise ValueError("keys are not distinct")
    return np.array(sizes, np.int64), np.packbits(np.concatenate(bits)).tobytes() if bits else b""


def probe(sizes: np.ndarray, packed: bytes, keys: np.ndarray) -> np.ndarray:
    """The number of each key; of keys that were not built in, any number, or -1."""
    out = np.full(len(keys), -1, np.int64)
    if not len(sizes):
        return out
    bits = np.unpackbits(np.frombuffer(packed, np.uint8))
    rank = np.cumsum(bits, dtype=np.int64) - 1
    left, start = np.arange(len(keys)), 0
    for level, size in enumerate(sizes):
        at = start + (mix(keys[left], level) % np.uint64(size)).astype(np.int64)
        hit = bits[at] == 1
        out[left[hit]] = rank[at[hit]]
        left, start = left[~hit], start + int(size)
        if not len(left):
            break
    return out
