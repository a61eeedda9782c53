"""XXH64 of many byte ranges of one buffer at a time.

Ranges of one length share all steps of the hash, so each length is one run of
array operations.
"""

from __future__ import annotations

import numpy as np
import xxhash

# The primes of XXH64.
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
#: Lengths with fewer ranges than this are hashed one by one.
FEW = 24


def _rotate(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _round(lane: np.ndarray, add: np.ndarray | np.uint64 = np.uint64(0)) -> np.ndarray:
    return _rotate(add + lane * P2, 31) * P1


def _one_length(words: np.ndarray, data: np.ndarray, start: np.ndarray, length: int, seed: np.uint64) -> np.ndarray:
    at = 0
    if length >= 32:
        base = np.full(len(start), seed, dtype=np.uint64)
        lanes = [base + P1 + P2, base + P2, base, base - P1]
        while at + 32 <= length:
            for k in range(4):
                lanes[k] = _round(words[start + (at + 8 * k)], lanes[k])
            at += 32
        h = sum((_rotate(v, by) for v, by in zip(lanes, (1, 7, 12, 18))), np.uint64(0))
        for v in lanes:
            h = (h ^ _round(v)) * P1 + P4
    else:
        h = np.full(len(start), seed, dtype=np.uint64) + P5
    h = h + np.uint64(length)
    while at + 8 <= length:
        h = _rotate(h ^ _round(words[start + at]), 27) * P1 + P4
        at += 8
    if at + 4 <= length:
        h = _rotate(h ^ ((words[start + at] & np.uint64(0xFFFFFFFF)) * P1), 23) * P2 + P3
        at += 4
    while at < length:
        h = _rotate(h ^ (data[start + at].astype(np.uint64) * P5), 11) * P1
        at += 1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    return h ^ (h >> np.uint64(32))


def xxh64(data: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int) -> np.ndarray:
    """The hash of data[start : start + length] for each range (uint8 data)."""
    out = np.zeros(len(start), dtype=np.uint64)
    if not len(start):
        return out
    low, high = int(start.min()), int((start + length).max())
    part = np.concatenate([data[low:high], np.zeros(8, dtype=np.uint8)])
    words = np.ascontiguousarray(np.ndarray((len(part) - 7,), dtype="<u8", buffer=part, strides=(1,)))
    start = start - low
    short = length.astype(np.uint16) if int(length.max()) < 65536 else length  # sorted by digits
    order = np.argsort(short, kind="stable")
    distinct, first, count = np.unique(length[order], return_index=True, return_counts=True)
    with np.errstate(over="ignore"):
        for n, f, c in zip(distinct.tolist(), first.tolist(), count.tolist()):
            rows = order[f:f + c]
            if c < FEW:
                for r in rows:
                    out[r] = xxhash.xxh64_intdigest(part[start[r]:start[r] + n].tobytes(), seed)
            else:
                out[rows] = _one_length(words, part, start[rows], n, np.uint64(seed))
    return out
