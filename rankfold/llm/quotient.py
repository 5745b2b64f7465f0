"""Counting quotient filters over packed word-id n-grams, without loss.

An n-gram of ids of ``width`` bits is one key of n * width bits, held as two
halves.  A Feistel network permutes keys invertibly, so they spread evenly
whatever the words are.  The permuted key's top bits are the shard, the next
ones the quotient (a slot), and the rest, stored in full, the remainder: slot,
remainder and shard give the key back, so counters are exact.  A filter holds
for each slot the length of its run, then the sorted remainders, then the
counters, one byte each with an escape for larger values.
"""

from __future__ import annotations

import struct

import numpy as np

from rankfold.llm.bitmaps import mix

# Round constants of the permutation: any fixed odd values do.
ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
_HEAD = struct.Struct("<QBBB")


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


class Grams:
    """Keys of ``n`` ids of ``width`` bits (at most 32 each, n from 2 to 4)."""

    def __init__(self, n: int, width: int) -> None:
        self.n, self.width = n, width
        self.head = (n + 1) // 2  # words in the left half
        self.left, self.right = self.head * width, (n - self.head) * width

    def permute(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Halves of the permuted keys of the n columns ``ids``."""
        w = np.uint64(self.width)
        a, b = np.zeros(len(ids[0]), np.uint64), np.zeros(len(ids[0]), np.uint64)
        for x in ids[:self.head]:
            a = (a << w) | x.astype(np.uint64)
        for x in ids[self.head:]:
            b = (b << w) | x.astype(np.uint64)
        for i in (0, 2):
            b = b ^ (mix(a + np.uint64(ROUNDS[i])) & _mask(self.right))
            a = a ^ (mix(b + np.uint64(ROUNDS[i + 1])) & _mask(self.left))
        return a, b

    def restore(self, a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
        """The id columns of permuted keys."""
        for i in (2, 0):
            a = a ^ (mix(b + np.uint64(ROUNDS[i + 1])) & _mask(self.left))
            b = b ^ (mix(a + np.uint64(ROUNDS[i])) & _mask(self.right))
        w = self.width
        out = [(a >> np.uint64(w * (self.head - 1 - i))) & _mask(w) for i in range(self.head)]
        out += [(b >> np.uint64(w * (self.n - self.head - 1 - i))) & _mask(w) for i in range(self.n - self.head)]
        return [x.astype(np.int64) for x in out]

    def count(self, a: np.ndarray, b: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct keys and the sums of their ``counts`` (1 each by default)."""
        total = len(a)
        if not total:
            return a, b, np.empty(0, np.int64)
        order = None
        if self.left + self.right <= 64:
            key = (a << np.uint64(self.right)) | b
            if counts is None:
                key.sort()
            else:
                order = np.argsort(key, kind="stable")
                key = key[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            a, b = key[first] >> np.uint64(self.right), key[first] & _mask(self.right)
        else:
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
            a, b = a[first], b[first]
        if counts is None:
            return a, b, np.diff(np.append(first, total))
        return a, b, np.add.reduceat(counts[order], first)

    def shard_of(self, a: np.ndarray, shard_bits: int) -> np.ndarray:
        return (a >> np.uint64(self.left - shard_bits)).astype(np.int64)

    def shard_bits(self, wanted: int) -> int:
        return max(0, min(wanted, self.left))

    def filter(self, a: np.ndarray, b: np.ndarray, counts: np.ndarray, shard_bits: int) -> bytes:
        """The filter of one shard's sorted distinct keys."""
        rest = self.left - shard_bits
        slot_bits = min(rest, max(0, len(a).bit_length() - 1))
        low = rest - slot_bits
        slot = (a >> np.uint64(low)) & _mask(slot_bits)
        runs = np.bincount(slot.astype(np.int64), minlength=1 << slot_bits)
        wide_a, wide_b = -(-low // 8), -(-self.right // 8)
        return b"".join([_HEAD.pack(len(a), slot_bits, wide_a, wide_b), _small(runs),
                         _narrow(a & _mask(low), wide_a), _narrow(b, wide_b), _small(counts)])

    def entries(self, data: bytes, shard: int, shard_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys and counts of a filter."""
        size, slot_bits, wide_a, wide_b = _HEAD.unpack_from(data)
        at = _HEAD.size
        runs, at = _unsmall(data, at, 1 << slot_bits)
        rest = self.left - shard_bits
        slot = np.repeat(np.arange(1 << slot_bits, dtype=np.uint64), runs)
        a = _widen(data, at, size, wide_a)
        at += size * wide_a
        b = _widen(data, at, size, wide_b)
        counts, _ = _unsmall(data, at + size * wide_b, size)
        a |= slot << np.uint64(rest - slot_bits)
        return a | (np.uint64(shard) << np.uint64(rest) if rest < 64 else np.uint64(0)), b, counts


def _small(values: np.ndarray) -> bytes:
    """One byte each; 255 says that the value follows as 64 bits after all bytes."""
    large = values >= 255
    return np.where(large, 255, values).astype(np.uint8).tobytes() + values[large].astype("<i8").tobytes()


def _unsmall(data: bytes, at: int, size: int) -> tuple[np.ndarray, int]:
    out = np.frombuffer(data, np.uint8, size, at).astype(np.int64)
    large = np.flatnonzero(out == 255)
    out[large] = np.frombuffer(data, "<i8", len(large), at + size)
    return out, at + size + 8 * len(large)


def _narrow(values: np.ndarray, wide: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide]).tobytes()


def _widen(data: bytes, at: int, size: int, wide: int) -> np.ndarray:
    out = np.zeros((size, 8), np.uint8)
    if wide:
        out[:, :wide] = np.frombuffer(data, np.uint8, size * wide, at).reshape(size, wide)
    return out.view("<u8").reshape(-1).astype(np.uint64)
