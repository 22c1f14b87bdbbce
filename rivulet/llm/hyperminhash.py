"""HyperMinHash registers (used inside tasks): one hash per element, dealt to
256 buckets; a bucket keeps its smallest hash compressed to a 6-bit
leading-zero count and a 10-bit mantissa."""

from __future__ import annotations

import numpy as np

from rivulet.llm.words import mix

BUCKETS = 256
MANTISSA = 10
HASH_BITS = 48
EMPTY = 0xFFFF


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 256 uint16 registers per set of distinct 64-bit hashes;
    a bucket without an element holds EMPTY."""
    n = len(sets)
    low = np.full(n * BUCKETS, np.uint64(1) << np.uint64(HASH_BITS), np.uint64)
    if n:
        size = np.fromiter(map(len, sets), np.int64, n)
        h = mix(np.concatenate(sets).astype(np.uint64))
        row = np.repeat(np.arange(n, dtype=np.int64), size)
        np.minimum.at(low, row * BUCKETS + (h & np.uint64(BUCKETS - 1)).astype(np.int64),
                      h >> np.uint64(64 - HASH_BITS))
    empty = low >> np.uint64(HASH_BITS) != 0
    length = np.frexp(low.astype(np.float64))[1].astype(np.uint64)  # exact below 2^53
    zeros = np.uint64(HASH_BITS) - np.minimum(length, np.uint64(HASH_BITS))
    tail = (low << (zeros + np.uint64(1))) & np.uint64((1 << HASH_BITS) - 1)
    reg = (zeros << np.uint64(MANTISSA)) | (tail >> np.uint64(HASH_BITS - MANTISSA))
    return np.where(empty, EMPTY, reg).astype(np.uint16).reshape(n, BUCKETS)


def densified(reg: np.ndarray) -> np.ndarray:
    """Registers with each empty bucket filled from the first non-empty one
    of its own fixed random order of buckets, so that two sets agree in a
    register with a probability near their Jaccard similarity at any size.
    Rows without any element stay EMPTY."""
    order = np.stack([np.random.default_rng(1000 + b).permutation(BUCKETS) for b in range(BUCKETS)])
    out = reg.copy()
    rows = np.flatnonzero((reg == EMPTY).any(axis=1) & (reg != EMPTY).any(axis=1))
    for t in range(BUCKETS):
        if not len(rows):
            break
        part, src = out[rows], reg[rows][:, order[:, t]]
        out[rows] = part = np.where(part == EMPTY, src, part)
        rows = rows[(part == EMPTY).any(axis=1)]
    return out


def band_keys(reg: np.ndarray, bands: int, width: int) -> np.ndarray:
    """(rows, bands) 64-bit keys, each over `width` neighbouring registers
    of the densified sketch and the number of the band."""
    d = densified(reg)[:, :bands * width].reshape(len(reg), bands, width).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), d.shape[:2]).copy()
    with np.errstate(over="ignore"):
        for j in range(width):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + d[:, :, j])
    return key


def independent_band_keys(sets: list[np.ndarray], bands: int, width: int) -> np.ndarray:
    """(sets, bands) 64-bit keys, each over the smallest values that `width`
    hash functions of its own take on a non-empty set: exact for sets so small
    that the registers of one hash function depend on each other."""
    if not sets:
        return np.zeros((0, bands), np.int64)
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    h, start = np.concatenate(sets).astype(np.uint64), np.cumsum(size) - size
    rng = np.random.default_rng(77)
    key = np.zeros((len(sets), bands), np.uint64)
    with np.errstate(over="ignore"):
        for b in range(bands):
            now = np.full(len(sets), bands + 1 + b, np.uint64)
            for salt in rng.integers(1, 1 << 63, width, dtype=np.uint64):
                low = np.minimum.reduceat(mix(h ^ salt), start)
                now = mix(now * np.uint64(0x9E3779B97F4A7C15) + low)
            key[:, b] = now
    return key.view(np.int64)


def chance_equal(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Probability that a register of two disjoint sets of these sizes agrees
    by collision: the sum over leading-zero counts z and mantissas of the
    product of both cells' probabilities. The mantissa cells of one z have
    nearly equal probabilities, so each z adds p_a(z) * p_b(z) / 2^MANTISSA."""
    la, lb = n_a / BUCKETS, n_b / BUCKETS
    total = np.zeros(len(la))
    for z in range(30):
        hi, lo = 2.0 ** -z, 2.0 ** -(z + 1)
        total += (np.exp(-la * lo) - np.exp(-la * hi)) * (np.exp(-lb * lo) - np.exp(-lb * hi))
    return total / 2 ** MANTISSA


def jaccard_estimate(reg_a, reg_b, n_a, n_b) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimates of register rows, and the number
    of registers in use each rests on: with C equal and U used registers,
    J = (C - E) / (U - E), E the equal ones expected by collision."""
    used = ((reg_a != EMPTY) | (reg_b != EMPTY)).sum(axis=1)
    equal = ((reg_a == reg_b) & (reg_a != EMPTY)).sum(axis=1)
    e = chance_equal(np.asarray(n_a, float), np.asarray(n_b, float)) * used
    return np.clip((equal - e) / np.maximum(used - e, 1e-9), 0, 1), used
