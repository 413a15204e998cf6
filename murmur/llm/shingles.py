"""Hashed word shingles of whole texts in numpy.

Texts are lower-cased (A-Z) and cut into words ``[^\\x20\\x09-\\x0D]+``; both work on
UTF-8 bytes.  Word and shingle hashes have 64 bits: two of N different ones are
equal with a chance of about N * N / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from murmur.llm.common import worker_state

RUN_BYTES = 1 << 20             # bytes handled at once (a longer text is handled alone)
_P = 0x9E3779B97F4A7C15
_LANES = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                   0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9C6E6877736C46E3], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _bytes_tables() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    separator = np.zeros(256, dtype=bool)
    separator[[32, *range(9, 14)]] = True
    return lower, separator


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    def build(size: int):
        out = []
        for base in (_P, pow(_P, -1, 1 << 64)):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            out.append(np.cumprod(x, dtype=np.uint64))
        return tuple(out)

    kept = worker_state("shingle powers", lambda: build(RUN_BYTES + 64))
    return kept if n < len(kept[0]) else build(n + 1)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of a byte array."""
    lower, separator = worker_state("shingle bytes", _bytes_tables)
    gap = np.concatenate([[True], separator[data], [True]])
    starts = np.flatnonzero(gap[:-1] & ~gap[1:])
    ends = np.flatnonzero(~gap[:-1] & gap[1:])
    power, inverse = _powers(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((lower[data].astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(_P)), starts


def shingle_sets(texts: pa.Array, k: int = 4) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a string array (nulls: empty).

    A text of fewer than ``k`` words, but not none, has one: its whole sequence.
    """
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts):
        return
    body = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    sizes = np.diff(offsets)
    first = 0
    while first < len(sizes):
        total, last = 0, first
        while last < len(sizes) and (last == first or total + sizes[last] + 1 <= RUN_BYTES):
            total += int(sizes[last]) + 1
            last += 1
        # The texts of this run, a space after each.
        data = np.full(total, 32, dtype=np.uint8)
        at = np.concatenate([[0], np.cumsum(sizes[first:last] + 1)])
        for i in range(last - first):
            data[at[i]:at[i + 1] - 1] = body[offsets[first + i]:offsets[first + i + 1]]
        words, starts = word_hashes(data)
        bounds = np.searchsorted(starts, at)
        if len(words) >= k:
            lanes = sum(words[j:len(words) - k + 1 + j] * _LANES[j] for j in range(k))
            grams = mix(lanes)
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= k:
                yield np.unique(grams[a:b - k + 1])
            elif b > a:
                yield mix((words[a:b] * _LANES[:b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(int(_LANES[7]) * int(b - a) % (1 << 64)))
            else:
                yield np.zeros(0, dtype=np.uint64)
        first = last


def fingerprint(s: np.ndarray) -> int:
    """A signed 64-bit fingerprint of a set (its size and the sum of its scrambled members)."""
    x = mix(s ^ np.uint64(_P)).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(s) * int(_LANES[6]) % (1 << 64))
    return int(mix(x).view(np.int64)[0])
