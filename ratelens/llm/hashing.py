"""Word and shingle hashes of one text, vectorised over its bytes.

Words are runs of bytes outside ``\\x20 \\x09-\\x0D`` of the UTF-8 text. Hashes have 64 bits and depend on nothing but
the words, so every task and every run gets the same values.
"""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(20240615)
_BYTE = _rng.integers(1, 2**64, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _rng.integers(1, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE[_IS_SPACE] = 0
_LONGEST_TABLE = 1 << 20
_tables = {"step": np.ones(1, dtype=np.uint64), "back": np.ones(1, dtype=np.uint64)}
_FACTORS = {"step": _STEP, "back": np.uint64(pow(int(_STEP), -1, 2**64))}
EMPTY = np.empty(0, dtype=np.uint64)


def _powers(name: str, size: int) -> np.ndarray:
    """Powers of the step, or of its inverse, modulo 2**64."""
    if len(_tables[name]) < size:
        steps = np.full(max(size, 1 << 16), _FACTORS[name], dtype=np.uint64)
        steps[0] = 1
        _tables[name] = np.multiply.accumulate(steps)
    return _tables[name]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the words: starts and ends (exclusive)."""
    space = _IS_SPACE[np.frombuffer(data, dtype=np.uint8)]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    return edge[0::2], edge[1::2]


def word_hashes(data: bytes) -> np.ndarray:
    """One hash per word of the text, in order."""
    starts, ends = word_bounds(data)
    if not len(starts):
        return EMPTY
    raw = np.frombuffer(data, dtype=np.uint8)[starts[0] :]
    first = starts - starts[0]
    value = _BYTE[raw]  # 0 for a space
    if len(raw) <= _LONGEST_TABLE:
        value *= _powers("step", len(raw))[: len(raw)]
        return mix(np.add.reduceat(value, first) * _powers("back", len(raw))[first])
    lengths = np.diff(np.append(first, len(raw)))
    value *= _powers("step", int(lengths.max()))[np.arange(len(raw)) - np.repeat(first, lengths)]
    return mix(np.add.reduceat(value, first))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of ``size`` words; all words as one run where there are fewer; none without words."""
    count = len(words)
    if not count:
        return EMPTY
    length = min(size, count)
    total = np.full(count - length + 1, length, dtype=np.uint64)
    for i in range(length):
        total += words[i : count - length + 1 + i] * _PLACE[i]
    return mix(total)


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a UTF-8 text with A-Z in lower case; empty for null or blank text."""
    if not text:
        return EMPTY
    hashes = shingle_hashes(word_hashes(text.lower()), size)
    hashes.sort()
    return hashes[np.concatenate(([True], hashes[1:] != hashes[:-1]))] if len(hashes) else EMPTY
