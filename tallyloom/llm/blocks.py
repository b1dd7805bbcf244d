"""Whole texts inside Arrow batches: bounded blocks, words and their hashes.

Every function here works on what one task holds of one Arrow batch, cut into blocks
of a few megabytes, so memory follows the block (or one text, if that is longer) and
not the table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 21
SEGMENT = 1 << 20
WHITE = b" \t\n\v\f\r"
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_RNG = np.random.default_rng(20)
_BYTE_VALUE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | _U64(1)
_LOWER_VALUE = _BYTE_VALUE[np.frombuffer(LOWER, np.uint8)]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(WHITE)] = True
#: Odd multipliers of the places in a window of words.
PLACES = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) | _U64(1)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, _U64), "down": np.ones(1, _U64)}


def blocks(batches: Iterable[pa.RecordBatch], column: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that each holds about ``limit`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.slice(start, end - start)
        del batch
        pa.default_memory_pool().release_unused()  # a worker lives on after its task


def raw(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit hashes (a bijection)."""
    x = x ^ (x >> _U64(32))
    x = x * _U64(0xD6E8FEB86659FD93)
    return x ^ (x >> _U64(29))


def _power(length: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < length:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(length, base, _U64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=_U64)
    return _powers["up"][:length], _powers["down"][:length]


def _segment_words(data: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    space = _IS_SPACE[data]
    padded = np.concatenate(([True], space, [True]))
    edge = np.flatnonzero(padded[1:] != padded[:-1])
    start, end = edge[0::2], edge[1::2]
    up, down = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, _U64)
    np.cumsum(value[data] * up[:-1], out=total[1:])
    return mix((total[end] - total[start]) * down[start]), start


def word_hashes(texts: Sequence[bytes | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word ``[^\\x20\\x09-\\x0D]+`` of the texts, in order, and where the
    words of each text begin in that array (one entry more than texts). ``lower``
    hashes A-Z as a-z. A null text has no words."""
    value = _LOWER_VALUE if lower else _BYTE_VALUE
    data = b"\n".join([t or b"" for t in texts])
    lengths = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    view = np.frombuffer(data, np.uint8)
    found, places, at = [], [], 0
    while at < len(view):
        end = min(at + SEGMENT, len(view))
        while end < len(view):  # a segment ends at white space
            gap = np.flatnonzero(_IS_SPACE[view[end:end + SEGMENT]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + SEGMENT, len(view))
        hashes, starts = _segment_words(view[at:end], value)
        found.append(hashes)
        places.append(starts + at)
        at = end
    hashes = np.concatenate(found) if found else np.zeros(0, _U64)
    starts = np.concatenate(places) if places else np.zeros(0, np.int64)
    return hashes, np.searchsorted(starts, offsets)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` word hashes, also across texts: the caller
    leaves out those that begin within the last words of a text."""
    n = max(0, len(words) - size + 1)
    total = np.zeros(n, _U64)
    for place in range(size):
        total += words[place:place + n] * PLACES[place]
    return mix(total)


def window_starts(bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, word place) of all windows of ``size`` words that lie inside one text."""
    per_text = np.maximum(np.diff(bounds) - size + 1, 0)
    text = np.repeat(np.arange(len(per_text)), per_text)
    inside = np.arange(per_text.sum()) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    return text, bounds[:-1][text] + inside


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over the words of each text."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]
