"""Words and word shingles of whole texts as 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np

_STEP = np.uint64(0x9E3779B97F4A7C15)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

# Bytes hashed at once: few enough that the 64-bit numbers made of them stay in a core's cache.
WINDOW = 1 << 15


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = x + _STEP
        x ^= x >> np.uint64(30)
        x *= _A
        x ^= x >> np.uint64(27)
        x *= _B
        x ^= x >> np.uint64(31)
        return x


_FACTOR = 0xD1342543DE82EF95


def _powers(factor: int, n: int) -> np.ndarray:
    steps = np.full(n, factor, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_POWERS, _INVERSES = _powers(_FACTOR, WINDOW), _powers(pow(_FACTOR, -1, 2 ** 64), WINDOW)
_SPACE = bytes(c in b"\t\n\x0b\x0c\r " for c in range(256))
# A random number for every byte, the same for A-Z and a-z.
_LETTERS = mix(np.arange(256, dtype=np.uint64) + np.uint64(0x51ED27))
_LETTERS[65:91] = _LETTERS[97:123]


def hash_words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word between ASCII white space; A-Z count as a-z.

    A word's hash is a polynomial in its bytes: the difference of two running sums, shifted back
    by the power of its place. Texts are taken in windows cut at white space; a word longer than
    a window is summed up over several.
    """
    hashes, starts = [], []
    data = np.frombuffer(text, np.uint8)
    at, carry, length, began = 0, 0, 0, 0
    while at < len(data):
        part = data[at:at + WINDOW]
        space = np.frombuffer(text[at:at + WINDOW].translate(_SPACE), bool)
        size = len(part)
        if at + size < len(data):
            last = np.flatnonzero(space)
            size = int(last[-1]) + 1 if len(last) else size
            part, space = part[:size], space[:size]
        with np.errstate(over="ignore"):
            sums = np.zeros(size + 1, np.uint64)
            letters = _LETTERS.take(part, mode="clip")
            letters *= _POWERS[:size]
            np.cumsum(letters, out=sums[1:])
            edge = np.flatnonzero(space[1:] != space[:-1]) + 1
            if not space[0]:
                edge = np.concatenate(([0], edge))
            if not space[-1]:
                edge = np.concatenate((edge, [size]))
            first, end = edge[0::2], edge[1::2]
            value = (sums.take(end) - sums.take(first)) * _INVERSES.take(first)
            long, place = end - first, first + at
            if length and len(first) and first[0] == 0:  # goes on from the window before
                value[0] = np.uint64((carry + int(value[0]) * pow(_FACTOR, length, 2 ** 64)) % 2 ** 64)
                long[0] += length
                place[0] = began
            elif length:
                value, long, place = (np.concatenate(([x], y)) for x, y in ((np.uint64(carry), value), (length, long), (began, place)))
            carry, length = 0, 0
            if not space[-1] and at + size < len(data):  # unfinished
                carry, length, began = int(value[-1]), int(long[-1]), int(place[-1])
                value, long, place = value[:-1], long[:-1], place[:-1]
            hashes.append(mix(value + long.astype(np.uint64) * _STEP))
            starts.append(place)
        at += size
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def hash_texts(texts: list[bytes | None]) -> list[np.ndarray]:
    """Word hashes of each text; short texts share a window."""
    out: list[np.ndarray] = []
    held: list[bytes] = []
    size = 0

    def flush() -> None:
        if held:
            hashes, starts = hash_words(b"\n".join(held))
            ends = np.cumsum([len(t) + 1 for t in held])
            out.extend(np.split(hashes, np.searchsorted(starts, ends[:-1])))
            held.clear()

    for text in texts:
        if held and size + len(text or b"") > WINDOW:
            flush()
            size = 0
        held.append(text or b"")
        size += len(held[-1]) + 1
    flush()
    return out


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; fewer words are one run; none: empty."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(n, size)
    with np.errstate(over="ignore"):
        total = np.zeros(n - width + 1, np.uint64)
        factor = np.uint64(1)
        for j in range(width):
            total += hashes[j:n - width + 1 + j] * factor
            factor = factor * _STEP + np.uint64(2)
        if width < size:
            total += np.uint64(width)
    found = np.sort(mix(total))
    return found[np.concatenate(([True], found[1:] != found[:-1]))]


def pack_set(features: np.ndarray) -> bytes:
    """A sorted set as steps between the leading 40 bits of its hashes, 4 bytes each where they fit."""
    steps = np.diff(features >> np.uint64(24), prepend=np.uint64(0))
    small = steps.max(initial=0) < 2 ** 32
    return (b"\x04" if small else b"\x08") + steps.astype(np.uint32 if small else np.uint64).tobytes()


def unpack_set(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, np.uint32 if raw[0] == 4 else np.uint64, offset=1), dtype=np.uint64)


def similar(left: np.ndarray, right: np.ndarray, numerator: int, denominator: int) -> bool:
    """Jaccard similarity of two sorted sets, not empty, is at least numerator / denominator."""
    if len(left) > len(right):
        left, right = right, left
    if denominator * len(left) < numerator * len(right):
        return False
    place = np.minimum(np.searchsorted(right, left), len(right) - 1)
    shared = int((right[place] == left).sum())
    return denominator * shared >= numerator * (len(left) + len(right) - shared)
