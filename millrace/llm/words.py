"""Words of whole Arrow batches as arrays: boundaries and 64-bit hashes, without a loop over words."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

_ROLL = 0xD1342543DE82EF95 | 1
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_SLICE = 1 << 21  # bytes or words whose 8-byte arrays are held at once

#: Byte tables: blanks split words; A to Z lowered.
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (splitmix finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array, and where each text starts and ends; null is empty."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text.

    ``starts``, ``ends``: byte positions; ``first[i]:first[i + 1]``: the words of text i.
    """

    def __init__(self, texts: pa.Array, lower: bool):
        data, self.bounds = text_bytes(texts)
        self.data = _LOWER[data] if lower else data
        inside = ~_BLANK[self.data]
        head, tail = inside.copy(), inside.copy()
        head[1:] &= ~inside[:-1]
        tail[:-1] &= ~inside[1:]
        edges = self.bounds[:-1][(self.bounds[:-1] > 0) & (self.bounds[:-1] < len(self.data))]
        head[edges] |= inside[edges]
        tail[edges - 1] |= inside[edges - 1]
        self.inside, self.starts, self.ends = inside, np.flatnonzero(head), np.flatnonzero(tail) + 1
        self.first = np.searchsorted(self.starts, self.bounds)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, family: int = 0) -> np.ndarray:
        """The sum of each word's bytes, each times a random factor of its place, with its bits spread.

        Factors that are powers of one base would give long words of two letters in the Thue-Morse order the
        hash of their complement. ``family`` (0 or 1) picks the factors; both together are a 128-bit hash.
        """
        out = np.zeros(len(self), np.uint64)
        if not len(self):
            return out
        lengths = self.ends - self.starts
        with np.errstate(over="ignore"):
            power = mix(np.arange(1, int(lengths.max()) + 2, dtype=np.uint64) * np.uint64(_SEEDS[family]))
        at = 0
        while at < len(self):
            to = max(at + 1, int(np.searchsorted(self.ends, self.starts[at] + _SLICE)))
            low, high = self.starts[at], self.ends[to - 1]
            begin = self.starts[at:to] - low
            place = np.arange(high - low) - np.repeat(begin, np.diff(np.append(begin, high - low)))
            inside = self.inside[low:high]
            place[~inside] = 0
            with np.errstate(over="ignore"):
                total = np.zeros(high - low + 1, np.uint64)
                np.cumsum((self.data[low:high].astype(np.uint64) + np.uint64(1)) * power[place] * inside, out=total[1:])
                out[at:to] = total[self.ends[at:to] - low] - total[begin]
            at = to
        return mix(out ^ (lengths.astype(np.uint64) << np.uint64(40)) ^ np.uint64(family))


def rolling(values: np.ndarray, length: int, base: int = _ROLL) -> np.ndarray:
    """Rabin-Karp hash of each run of ``length`` values, from running sums of value times power."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, inverse = np.empty(n, np.uint64), pow(base, -1, 1 << 64)
    step = max(_SLICE, 4 * length)
    up, down = powers(base, min(len(values), step + length)), powers(inverse, min(n, step))
    with np.errstate(over="ignore"):
        for at in range(0, n, step):
            to = min(n, at + step)
            total = np.zeros(to - at + length, np.uint64)
            part = values[at : to + length - 1]
            np.cumsum(part * up[: len(part)], out=total[1:])
            out[at:to] = (total[length:] - total[:-length]) * down[: to - at]
    return mix(out)


def slices(batch: pa.RecordBatch, column: str, most: int = 2 << 20):
    """Cut a batch so that the texts of a piece hold about ``most`` bytes; a longer text is a piece."""
    _, bounds = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def by_slices(batches: Iterable[pa.RecordBatch], column: str, work: Callable[[pa.RecordBatch], Iterator], most: int = 1 << 19) -> Iterator:
    """What ``work`` yields for each slice of each batch, in order; after each batch the allocators give free pages back to the system.

    Spark keeps idle workers for the next task, and what they hold counts beside the running ones.
    """
    for batch in batches:
        for part in slices(batch, column, most):
            yield from work(part)
        batch = part = None
        for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
            pool.release_unused()
