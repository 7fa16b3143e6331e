"""Benchmark decontamination: a prefix-filtered set join of documents with item windows.

A window is a run of an item's words. Its words are ordered by rarity in the
corpus, and as all of them must occur, the rarest one is the prefix that a
document must share. Where a document has that word, the window's place in the
document is known: it must lie inside the document, and all its words must
stand there in order.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimstrata.llm.frames import renamed, stored, with_package
from claimstrata.llm.texts import ALNUM, appended, byte_view, names, portions, word_spans

WINDOW = 10
BLOCK_BYTES = 8 << 20
# Bytes of text that a task takes at once; its arrays are many times as large.
PORTION_TAKEN = 1 << 19
_SEED = 81
_CANDIDATES = 1 << 18
FIGURES = {
    "n_words": "long",
    "n_hit": "long",
    "n_items": "long",
    "items": "array<string>",
    "contaminated": "boolean",
}


def word_names(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit name for each word of the rows (A to Z in lower case), and where rows begin."""
    data, offsets = byte_view(column)
    starts, ends, first = word_spans(data, offsets, ALNUM)
    namer = names(_SEED, True)
    return namer.words(data, starts, ends), first


@dataclass
class Windows:
    """Distinct windows of a block of items: word numbers, and the items of each window.

    Windows of one length form one array. ``vocabulary`` is sorted; a word's
    number is its place there.
    """

    vocabulary: np.ndarray
    lengths: list[int]
    words: list[np.ndarray]
    items: list[list[np.ndarray]]


def windows(texts: list[str | None], item_ids: list[str], size: int) -> Windows:
    found, first = word_names(pa.array(texts, pa.string()))
    vocabulary, numbers = np.unique(found, return_inverse=True)
    by_length: dict[int, dict[tuple[int, ...], set[str]]] = {}
    for i, item in enumerate(item_ids):
        words = numbers[first[i] : first[i + 1]].tolist()
        length = min(size, len(words))
        for j in range(len(words) - length + 1 if length else 0):
            known = by_length.setdefault(length, {})
            known.setdefault(tuple(words[j : j + length]), set()).add(item)
    lengths = sorted(by_length)
    return Windows(
        vocabulary,
        lengths,
        [np.array(list(by_length[n]), np.int64).reshape(-1, n) for n in lengths],
        [[sorted(x) for x in by_length[n].values()] for n in lengths],
    )


class Index:
    """Windows under their rarest word."""

    def __init__(self, held: Windows, frequency: np.ndarray) -> None:
        self.vocabulary = held.vocabulary
        self.parts = []
        for length, words, items in zip(held.lengths, held.words, held.items):
            offset = np.argmin(frequency[words], axis=1)
            prefix = words[np.arange(len(words)), offset]
            order = np.argsort(prefix, kind="stable")
            counts = np.bincount(prefix, minlength=len(self.vocabulary))
            begin = np.cumsum(counts) - counts
            self.parts.append((length, words[order], offset[order], begin, counts, [items[i] for i in order]))

    def numbers(self, found: np.ndarray) -> np.ndarray:
        """Word numbers of names, -1 for words that no item has."""
        if not len(self.vocabulary):
            return np.full(len(found), -1, np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, found), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == found, at, -1)

    def hits(self, found: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, list]]:
        """For each length: where its windows occur, which ones, and the items of all of them."""
        numbers = self.numbers(found)
        known = np.flatnonzero(numbers >= 0)
        row = np.searchsorted(first, known, "right") - 1
        for length, words, offset, begin, counts, items in self.parts:
            times = counts[numbers[known]]
            total = np.cumsum(times)
            step = 0
            while step < len(known):
                base = total[step - 1] if step else 0
                stop = max(step + 1, int(np.searchsorted(total, base + _CANDIDATES, "right")))
                reps = times[step:stop]
                place = np.repeat(known[step:stop], reps)
                rows = np.repeat(row[step:stop], reps)
                inner = np.arange(len(place)) - np.repeat(np.cumsum(reps) - reps, reps)
                which = begin[numbers[place]] + inner
                start = place - offset[which]
                fits = (start >= first[rows]) & (start + length <= first[rows + 1])
                start, which = start[fits], which[fits]
                for j in range(length):
                    same = numbers[start + j] == words[which, j]
                    start, which = start[same], which[same]
                yield length, start, which, items
                step = stop


def _load(items: DataFrame, block_bytes: int) -> list[tuple[list[str | None], list[str]]]:
    """The different rows of the items, in blocks by their size."""
    sized = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").distinct()
    total = sized.agg(F.sum(F.octet_length("text") + F.octet_length("item") + 16)).first()[0] or 0
    count = max(1, -(-int(total) // block_bytes))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    return [sized.where(part == i) for i in range(count)]


def _frequency(docs: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """How often each word of the vocabulary occurs in all documents."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary) + 1, np.int64)
        index = Index(Windows(vocabulary, [], [], []), np.zeros(0))
        for part in portions(batches, "text", PORTION_TAKEN):
            numbers = index.numbers(word_names(part.column("text"))[0])
            total += np.bincount(numbers + 1, minlength=len(total))
        at = np.flatnonzero(total[1:])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[1:][at])], names=["word", "n"])

    counted = docs.select("text").mapInArrow(count, "word long, n long")
    rows = counted.groupBy("word").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(len(vocabulary), np.int64)
    total[rows["word"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return total


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    size: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    prefix: str = "",
) -> DataFrame:
    """Every row with ``n_words``, ``n_hit``, ``n_items``, ``items`` and ``contaminated``,
    names that begin with ``prefix``.

    Words are runs of letters, digits and non-ASCII characters, A to Z in
    lower case. A window is ``size`` consecutive words of an item, or a whole
    item of fewer words. A document's word is hit if it lies inside any
    occurrence of a window; ``items`` are the ids (text, sorted) of the items
    with an occurring window.

    A null or empty text has no words; an item without words has no windows.
    Items of one id are one item, a null id counts as an empty text. Documents
    are judged alone, so ties and repeated rows get equal results. Columns of
    the five names are replaced. Without items nothing is hit; without
    documents the result is empty.

    The items are read in blocks of about ``block_bytes``, which bounds what a
    task holds: one block is usual, and each further one is another pass over
    the documents (an item is not cut). Per block the corpus frequency of its
    words is counted over all documents, which orders words by rarity. No
    document is shuffled.
    """
    with_package(docs.sparkSession)
    new = tuple(prefix + name for name in FIGURES)
    docs, made = renamed(docs.select(*(f"`{name}`" for name in docs.columns if name not in new)), "text")
    keep = docs.columns
    schema = ", ".join(f"`{name}` {kind}" for name, kind in docs.dtypes)
    blocks = _load(items, block_bytes)
    state = "_hits array<long>, _items array<string>"
    frame = docs.withColumn("_hits", F.lit(None).cast("array<long>")).withColumn("_items", F.lit(None).cast("array<string>"))
    for i, block in enumerate(blocks):
        rows = block.toPandas()
        held = windows([x if isinstance(x, str) else None for x in rows["text"]], list(rows["item"]), size)
        index = Index(held, _frequency(docs, held.vocabulary))
        last = i == len(blocks) - 1
        figures = ", ".join(f"`{name}` {kind}" for name, kind in zip(new, FIGURES.values()))
        frame = frame.mapInArrow(_matcher(index, keep, new, last), f"{schema}, {figures if last else state}")
        if not last:
            frame = stored(frame, "decontaminate")
    return frame.select(*(F.col(inner).alias(name) for name, inner in made.items()), *new)


def _matcher(index: Index, keep: list[str], new: tuple[str, ...], last: bool):
    def match(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches, "text", PORTION_TAKEN):
            found, first = word_names(part.column("text"))
            hit = np.zeros(len(found) + 1, np.int64)
            rows = part.num_rows
            ids: list[set[str]] = [set(x or ()) for x in part.column("_items").to_pylist()]
            for row, spans in enumerate(part.column("_hits").to_pylist()):
                for a, b in zip((spans or [])[::2], (spans or [])[1::2]):
                    hit[first[row] + a] += 1
                    hit[first[row] + b] -= 1
            for length, start, which, items in index.hits(found, first):
                np.add.at(hit, start, 1)
                np.add.at(hit, start + length, -1)
                row = np.searchsorted(first, start, "right") - 1
                for r, w in np.unique(np.stack([row, which], 1), axis=0) if len(row) else ():
                    ids[r].update(items[w])
            flags = np.cumsum(hit[:-1]) > 0
            held = [sorted(x) for x in ids]
            if last:
                total = np.r_[0, np.cumsum(flags)]
                n_hit = total[first[1:]] - total[first[:-1]]
                made = (
                    pa.array(np.diff(first), pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array([len(x) for x in held], pa.int64()),
                    pa.array(held, pa.list_(pa.string())),
                    pa.array(n_hit > 0),
                )
                yield appended(part, keep, **dict(zip(new, made)))
            else:
                yield appended(
                    part,
                    keep,
                    _hits=pa.array([_spans(flags[first[i] : first[i + 1]]) for i in range(rows)], pa.list_(pa.int64())),
                    _items=pa.array(held, pa.list_(pa.string())),
                )

    return match


def _spans(flags: np.ndarray) -> list[int]:
    """Start and end of each run of true flags, one after another."""
    return np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8))).tolist()


def items_digest(items):
    """Lower-case hex SHA-256 of the ids, joined by commas."""
    return F.sha2(F.array_join(items, ","), 256)


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows without a hit, with the columns they had."""
    found = decontaminate(docs, items, size, prefix="_benchmark_")
    return found.where("NOT _benchmark_contaminated").select(*docs.columns)
