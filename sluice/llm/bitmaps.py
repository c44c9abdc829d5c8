"""Compressed bitmaps of document numbers: per block of 65,536 numbers a container sized to its content.

A container is one byte for its kind and then either the sorted numbers ("a", two bytes each), runs of numbers ("r",
first and last, four bytes each) or all bits ("b", 8,192 bytes), whichever is shortest.
"""

from __future__ import annotations

import numpy as np

#: Numbers in a block.
BLOCK = 1 << 16


def encode(numbers: np.ndarray) -> bytes:
    """The container of sorted, distinct numbers below BLOCK."""
    numbers = numbers.astype(np.uint16)
    breaks = np.flatnonzero(np.diff(numbers.astype(np.int32)) != 1)
    firsts, lasts = np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(numbers) - 1]])
    if not len(numbers):
        return b"a"
    if 4 * len(firsts) < min(2 * len(numbers), BLOCK // 8):
        return b"r" + np.stack([numbers[firsts], numbers[lasts]], 1).tobytes()
    if 2 * len(numbers) <= BLOCK // 8:
        return b"a" + numbers.tobytes()
    bits = np.zeros(BLOCK, np.uint8)
    bits[numbers] = 1
    return b"b" + np.packbits(bits, bitorder="little").tobytes()


def _marks(container: bytes) -> np.ndarray:
    """The bits of a container, one byte each."""
    out = np.zeros(BLOCK + 1, np.int8)
    if container[:1] == b"b":
        return np.unpackbits(np.frombuffer(container, np.uint8, offset=1), bitorder="little")
    if container[:1] == b"r":
        runs = np.frombuffer(container, np.uint16, offset=1).reshape(-1, 2).astype(np.int64)
        np.add.at(out, runs[:, 0], 1)
        np.add.at(out, runs[:, 1] + 1, -1)
        return np.cumsum(out[:BLOCK]).astype(np.uint8)
    out[np.frombuffer(container, np.uint16, offset=1)] = 1
    return out[:BLOCK].astype(np.uint8)


def decode(container: bytes) -> np.ndarray:
    """The sorted numbers of a container."""
    if container[:1] == b"a":
        return np.frombuffer(container, np.uint16, offset=1)
    return np.flatnonzero(_marks(container)).astype(np.uint16)


def union(containers: list[bytes]) -> tuple[bytes, int]:
    """The container of all numbers in any of the given ones, and how many there are."""
    if len(containers) == 1:
        return containers[0], cardinality(containers[0])
    if all(c[:1] == b"a" for c in containers):
        numbers = np.unique(np.frombuffer(b"".join(c[1:] for c in containers), np.uint16))
    else:
        marks = np.zeros(BLOCK, np.uint8)
        for c in containers:
            if c[:1] == b"a":
                marks[np.frombuffer(c, np.uint16, offset=1)] = 1
            else:
                marks |= _marks(c)
        numbers = np.flatnonzero(marks)
    return encode(numbers), len(numbers)


def cardinality(container: bytes) -> int:
    """How many numbers a container holds."""
    if container[:1] == b"a":
        return len(container) // 2
    if container[:1] == b"r":
        runs = np.frombuffer(container, np.uint16, offset=1).reshape(-1, 2).astype(np.int64)
        return int((runs[:, 1] - runs[:, 0] + 1).sum())
    return int(np.bitwise_count(np.frombuffer(container, np.uint8, offset=1)).sum())


def contains(container: bytes, numbers: np.ndarray) -> np.ndarray:
    """Of each number below BLOCK whether the container holds it; asks the container as it is, whatever its kind."""
    numbers = numbers.astype(np.int64)
    if container[:1] == b"b":
        return (np.frombuffer(container, np.uint8, offset=1)[numbers >> 3] >> (numbers & 7)) & 1 > 0
    held = np.frombuffer(container, np.uint16, offset=1)
    if not len(held):
        return np.zeros(len(numbers), bool)
    if container[:1] == b"a":
        at = np.minimum(np.searchsorted(held, numbers), len(held) - 1)
        return held[at] == numbers
    firsts, lasts = held[0::2].astype(np.int64), held[1::2].astype(np.int64)
    at = np.searchsorted(firsts, numbers, side="right") - 1
    return (at >= 0) & (numbers <= lasts[np.maximum(at, 0)])
