"""Vectorised word hashes: no Python loop over words or characters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U64 = np.uint64
BLOCK = 1 << 20
#: Bytes of joined texts that are hashed at once.
JOINED = 1 << 15
_BASE = 0x9E3779B97F4A7C17
_rng = np.random.default_rng(20_240_601)
_BYTE = _rng.integers(0, 2**64, 256, dtype=U64)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: ASCII characters that are neither letters nor digits.
NOT_WORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as many as the longest text so far needs."""

    up = down = np.ones(1, dtype=U64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(cls.up):
            size = 1 << (n - 1).bit_length()
            inverse = pow(_BASE, -1, 2**64)
            for name, base in (("up", _BASE), ("down", inverse)):
                factors = np.full(size, base, dtype=U64)
                factors[0] = 1
                setattr(cls, name, np.multiply.accumulate(factors))
        return cls.up, cls.down


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words in order, A to Z lower-cased."""
    return word_and_part_hashes(text)[0]


def word_and_prefix_hashes(text: str | None, prefix: int, breaks: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and of their first `prefix` bytes."""
    return word_and_part_hashes(text, prefix, True, breaks)


def _blocks(data: np.ndarray, breaks: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Parts of `data` of about `size` bytes that end at breaks, so that memory doesn't grow with a text's length."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data):
            stop = np.flatnonzero(breaks[data[end : end + size]])
            end = min(end + (int(stop[0]) if len(stop) else size), len(data))
            if len(stop):
                break
        yield data[at:end]
        at = end


def word_and_part_hashes(text: str | None, size: int = 0, first: bool = True, breaks: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, between the bytes marked in `breaks`, and of their first (or last) `size` bytes: polynomial hashes
    from one prefix sum over the bytes of a block."""
    data = np.frombuffer((text or "").encode("utf-8", "replace").lower(), dtype=np.uint8)
    parts = [_hashes(block, size, first, breaks)[:2] for block in _blocks(data, breaks, BLOCK)]
    if not parts:
        return np.zeros(0, dtype=U64), np.zeros(0, dtype=U64)
    return parts[0] if len(parts) == 1 else tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def words_of_texts(texts: list[str | None], size: int = 0, first: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`word_and_part_hashes` of many texts in a row, and the number of words of each. The texts are joined and hashed in blocks that
    the processor's cache holds, which a text at a time leaves mostly empty."""
    encoded = [(t or "").encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b"\n".join(encoded).lower(), dtype=np.uint8)
    words, parts, starts, at = [np.zeros(0, dtype=U64)], [np.zeros(0, dtype=U64)], [np.zeros(0, dtype=np.int64)], 0
    for block in _blocks(data, _IS_SPACE, JOINED):
        own, part, begins = _hashes(block, size, first, _IS_SPACE)
        words.append(own)
        parts.append(part)
        starts.append(begins + at)
        at += len(block)
    edges = np.cumsum([len(e) + 1 for e in encoded])
    before = np.searchsorted(np.concatenate(starts), edges)
    return np.concatenate(words), np.concatenate(parts), np.diff(before, prepend=0)


def _hashes(data: np.ndarray, size: int, first: bool, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words and of their parts, and where the words begin."""
    inside = np.concatenate(([False], ~breaks[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _Powers.of(len(data))
    sums = np.concatenate((np.zeros(1, dtype=U64), np.cumsum(_BYTE[data] * up[: len(data)], dtype=U64)))

    def hashed(begins: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return mix((sums[stops] - sums[begins]) * down[begins] + (stops - begins).astype(U64))

    if not size:
        return hashed(starts, ends), np.zeros(0, dtype=U64), starts
    part = (starts, np.minimum(ends, starts + size)) if first else (np.maximum(starts, ends - size), ends)
    return hashed(starts, ends), hashed(*part), starts
