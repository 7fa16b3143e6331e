"""Text columns as numpy byte arrays: words, fingerprints, portions of a batch.

Inside a task a text column is one UTF-8 byte array with row offsets, so words
and byte windows are found and named by array operations instead of loops over
Python strings. A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PORTION_BYTES = 1 << 20
# Sums with weights modulo a power of two tell long words of a known kind badly
# apart, so those of more bytes have a digest for a name.
SUMMED_BYTES = 32


def portions(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = PORTION_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of text; a longer row comes alone."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows, one after another, and where each row starts and ends."""
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    rows = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    rows = rows.astype(np.int64)
    if data is None or rows[-1] == rows[0]:
        return np.zeros(0, np.uint8), rows - rows[0]
    return np.frombuffer(data, np.uint8)[rows[0] : rows[-1]], rows - rows[0]


def _table(word: str) -> np.ndarray:
    """Which byte values belong to a word."""
    values = np.arange(256)
    if word == "spaced":  # all but blank and \t to \r
        return ~((values == 0x20) | ((values >= 0x09) & (values <= 0x0D)))
    letters = (values | 0x20 >= 0x61) & (values | 0x20 <= 0x7A) & (values < 0x80)
    return letters | ((values >= 0x30) & (values <= 0x39)) | (values >= 0x80)


# Words between white space, and words of letters, digits and non-ASCII characters.
SPACED = _table("spaced")
ALNUM = _table("alnum")


def word_spans(
    data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the index of each row's first word (and the total)."""
    size = len(data)
    if size == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = in_word[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < size]
    opens[heads] = inside[heads]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    closes[tails] = inside[tails]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def mix(values: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit numbers that spreads every bit."""
    values = values ^ (values >> np.uint64(32))
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    return values


class Names:
    """64-bit names of byte strings, by a rolling hash over random byte values.

    ``sums`` prepares a byte array; ``of`` then names any number of its spans
    at once. Equal strings get equal names wherever they stand.
    """

    def __init__(self, seed: int, fold_case: bool = False) -> None:
        random = np.random.default_rng(seed)
        self.values = random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        if fold_case:
            self.values[65:91] = self.values[97:123]
        self.key = seed.to_bytes(8, "little")
        self.fold = bytes(c + 32 if fold_case and 65 <= c <= 90 else c for c in range(256))
        self.base = int(random.integers(1 << 40, 1 << 62)) | 1
        self.powers = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.powers) < size:
            size = max(size, PORTION_BYTES + 1)
            for name, base in (("powers", self.base), ("inverse", pow(self.base, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        steps = self.values[data]
        steps *= self.powers[: len(data)]
        np.cumsum(steps, out=total[1:])
        return total

    def every(self, sums: np.ndarray, size: int) -> np.ndarray:
        """The names of all spans of one size, wherever they start."""
        if len(sums) <= size:
            return np.zeros(0, np.uint64)
        raw = sums[size:] - sums[:-size]
        raw *= self.inverse[: len(raw)]
        raw += np.uint64(size * 0x9E3779B97F4A7C15 % (1 << 64))
        return mix(raw)

    def of(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (sums[ends] - sums[starts]) * self.inverse[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The names of words. Those of short ones are sums, those of long ones keyed digests."""
        found = self.of(self.sums(data), starts, ends)
        for i in np.flatnonzero(ends - starts > SUMMED_BYTES):
            word = data[starts[i] : ends[i]].tobytes().translate(self.fold)
            found[i] = int.from_bytes(blake2b(word, digest_size=8, key=self.key).digest(), "little")
        return found


@lru_cache(maxsize=None)
def names(seed: int, fold_case: bool = False) -> Names:
    """One instance per process, so that its tables of powers are made once."""
    return Names(seed, fold_case)


def appended(batch: pa.RecordBatch, keep: list[str], **columns: pa.Array) -> pa.RecordBatch:
    """The kept columns of a batch with new ones behind them."""
    arrays = [batch.column(name) for name in keep] + list(columns.values())
    return pa.RecordBatch.from_arrays(arrays, names=[*keep, *columns])
