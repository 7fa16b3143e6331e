"""Removing repeated byte strings of a corpus by prefix-free parsing.

A rolling hash of ``TRIGGER`` bytes marks triggers in the text, the same ones
wherever the same bytes stand; a phrase runs from one trigger to the end of the
next. The distinct phrases are the dictionary, the texts as sequences of
phrases the parse. What starts at a byte is a suffix of a dictionary phrase
followed by a suffix of the parse, so the order of all suffixes of the corpus
comes from those two orders. To find what repeats only neighbours that agree
in ``least`` bytes matter, and three exchanges find them:

1. the dictionary in order: a phrase that occurs once cuts the text, as no
   window over it can occur twice;
2. the parse in order: the parse suffixes after each remaining trigger, with
   the phrase before. Equal neighbours are repeats for all bytes of the phrase
   at once, which settles the inside of every long copy;
3. suffixes of dictionary phrases with the parse that follows, only next to
   the ends of copies, where the first two orders leave the answer open.

Orders are by 64-bit or 128-bit names instead of by bytes: equal strings are
neighbours in either, which is all that is asked. Each exchange sorts slices of
names in bucket tasks and answers each block of documents with one bit or two
per name, so neither a dictionary nor the result passes through one place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimstrata.llm.frames import shuffle_partitions, with_package
from claimstrata.llm.texts import PORTION_BYTES, byte_view, names

LEAST = 200
TRIGGER = 12
MEAN_PHRASE = 24
BLOCKS_PER_PARTITION = 3

_SEEDS = (51, 52)
DEAD, SETTLED, PARTNER, OPEN = 0, 1, 2, 3


class Parsed:
    """A portion of documents as bytes, with its triggers, phrases and names.

    ``live`` and ``gaps`` are set when the dictionary, ``open`` and ``settled``
    when the parse is known.
    """

    live: np.ndarray
    gaps: tuple[np.ndarray, np.ndarray, np.ndarray]
    open: np.ndarray
    settled: np.ndarray

    def __init__(self, data: np.ndarray, offsets: np.ndarray, least: int) -> None:
        self.data, self.offsets, self.least = data, offsets, least
        # Bytes after a trigger that name its neighbourhood. Windows that start
        # farther before their first trigger are compared one by one.
        self.reach = least // 2
        self.namers = [names(seed) for seed in _SEEDS]
        self.sums: dict[int, np.ndarray] = {}
        size = len(data)
        hashed = self.namers[0].every(self._sums(0), TRIGGER)
        marks = hashed < np.uint64((1 << 64) // MEAN_PHRASE)
        for back in range(1, TRIGGER):  # a trigger does not cross documents
            at = offsets[1:-1] - back
            marks[at[(at >= 0) & (at < len(marks))]] = False
        self.triggers = np.flatnonzero(marks)
        row = np.searchsorted(offsets, self.triggers, "right") - 1
        self.begin, self.end = offsets[row], offsets[row + 1]
        self.after_first = np.r_[False, row[1:] == row[:-1]][: len(row)]
        self.before = np.r_[-1, self.triggers[:-1]][: len(row)]
        paired = np.flatnonzero(self.after_first)
        self.phrase_start = self.before[paired]
        self.phrase_end = self.triggers[paired] + TRIGGER
        # Windows of ``least`` bytes inside a document.
        fits = np.zeros(size + 1, np.int32)
        long = np.flatnonzero(np.diff(offsets) >= least)
        np.add.at(fits, offsets[long], 1)
        np.add.at(fits, offsets[long + 1] - least + 1, -1)
        self.fits = np.cumsum(fits[:-1], dtype=np.int32) > 0

    def _sums(self, which: int) -> np.ndarray:
        if which not in self.sums:
            self.sums[which] = self.namers[which].sums(self.data)
        return self.sums[which]

    def release(self) -> None:
        """Give back what names need; it is made again when it is asked for."""
        self.sums = {}

    def named(self, which: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, np.uint64)
        return self.namers[which].of(self._sums(which), starts, ends)

    def phrases(self) -> np.ndarray:
        return self.named(0, self.phrase_start, self.phrase_end)

    def alive(self, repeated: np.ndarray) -> np.ndarray:
        """Windows that do not hold a phrase which occurs once; ``repeated`` is by phrase."""
        change = np.zeros(len(self.data) + 1, np.int32)
        once = ~repeated
        start, end = self.phrase_start[once], self.phrase_end[once]
        row = np.searchsorted(self.offsets, start, "right") - 1
        low = np.maximum(end - self.least, self.offsets[row])
        inside = low <= start
        np.add.at(change, low[inside], 1)
        change[start[inside] + 1] -= 1
        return self.fits & (np.cumsum(change[:-1], dtype=np.int32) == 0)

    def find_gaps(self, live: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The triggers that are the first of a live window near by, and where those windows begin."""
        low = np.where(self.after_first, self.before + 1, self.begin)
        near = np.maximum(low, self.triggers - self.reach)
        total = np.zeros(len(live) + 1, np.int32)
        np.cumsum(live, out=total[1:], dtype=np.int32)
        return np.flatnonzero(total[np.minimum(self.triggers + 1, len(live))] > total[near]), low, near

    def suffixes(self, at: np.ndarray) -> np.ndarray:
        """Per gap: the name after its trigger, and the name of phrase and parse suffix (0 if cut)."""
        trigger = self.triggers[at]
        entry = np.zeros((len(at), 3), np.uint64)
        entry[:, 0] = self.named(0, trigger, trigger + self.reach)
        whole = np.flatnonzero(self.after_first[at] & (trigger + self.least <= self.end[at]))
        start, end = self.before[at][whole], trigger[whole] + self.least
        for i in (0, 1):
            entry[whole, 1 + i] = self.named(i, start, end) | np.uint64(1)
        return entry

    def unsettled(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows to compare one by one, and a flag for windows that are known to repeat."""
        at, low, near = self.gaps
        size = len(self.data)
        settled = _cover(size, low[at], self.triggers[at], (code == SETTLED) | (code == PARTNER))
        wanted = _cover(size, near[at], self.triggers[at], (code == PARTNER) | (code == OPEN))
        close = _cover(size, near, self.triggers, np.ones(len(near), bool))
        return np.flatnonzero(self.live & (wanted | ~close)), settled & self.fits

    def windows(self, at: np.ndarray) -> np.ndarray:
        return np.stack([self.named(i, at, at + self.least) for i in (0, 1)], 1)


def _portions(table: pa.Table) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    sizes = pc.fill_null(pc.binary_length(table.column("text")), 0).to_numpy()
    ends = np.cumsum(sizes.astype(np.int64))
    start = 0
    while start < table.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + PORTION_BYTES // 4, "right")))
        part = table.slice(start, stop - start)
        yield part, *byte_view(part.column("text").combine_chunks())
        start = stop


def _key(rows: np.ndarray) -> np.ndarray:
    """The column that tells rows apart: the second where it is set, or else the first."""
    return rows[:, 0] if rows.shape[1] == 1 else np.where(rows[:, 1] > 0, rows[:, 1], rows[:, 0])


def _ordered(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal rows are neighbours, and where each row differs from the one before."""
    keys = _key(rows)
    order = np.argsort(keys, kind="stable")
    keys, moved = keys[order], rows[order]
    new = np.r_[True, (moved[1:] != moved[:-1]).any(axis=1)][: len(rows)]
    if (new[1:] & (keys[1:] == keys[:-1])).any():  # different rows of one key
        order = np.lexsort(rows.T[::-1])
        moved = rows[order]
        new = np.r_[True, (moved[1:] != moved[:-1]).any(axis=1)][: len(rows)]
    return order, new


def _counted(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows of a matrix, ordered by the first column, whether each occurs
    twice or more, and the place of every row among them."""
    order, new = _ordered(rows)
    head = np.flatnonzero(new)
    again = np.diff(np.r_[head, len(rows)]) > 1
    by_first = np.argsort(rows[order[head], 0], kind="stable")
    moved = np.empty(len(head), np.int64)
    moved[by_first] = np.arange(len(head))
    place = np.empty(len(rows), np.int64)
    place[order] = moved[np.cumsum(new) - 1]
    return rows[order[head[by_first]]], again[by_first], place


def _slices(rows: np.ndarray, buckets: int) -> np.ndarray:
    """Where the slice of each bucket begins in rows ordered by their first name."""
    bounds = np.array([(i << 64) // buckets for i in range(buckets)], np.uint64)
    return np.r_[np.searchsorted(rows[:, 0], bounds), len(rows)]


class _Block:
    """A block of documents with the answers it got so far, from which it goes through the
    exchanges again. Of its portions it holds bytes, triggers and flags, and the sums that
    names need of one at a time."""

    def __init__(self, docs: pa.Table, answers: pa.Table | None, least: int) -> None:
        self.answers: dict[int, np.ndarray] = {}
        if answers is not None and answers.num_rows:
            steps = answers.column("step").to_numpy()
            order = np.lexsort((answers.column("bucket").to_numpy(), steps))
            codes = answers.column("codes").to_pylist()
            for step in np.unique(steps):
                held = [codes[i] for i in order if steps[i] == step]
                self.answers[int(step)] = np.frombuffer(b"".join(held), np.uint8)
        self.tables, self.parsed = [], []
        for part, data, offsets in _portions(docs):
            self.tables.append(part)
            self.parsed.append(Parsed(data, offsets, least))
            self.parsed[-1].release()
        self._entries: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._places: dict[int, list[np.ndarray]] = {}

    def entries(self, step: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct entries of an exchange, ordered, and whether each repeats here."""
        while len(self._entries) < step:
            self._collect(len(self._entries) + 1)
        return self._entries[step]

    def codes(self, step: int) -> list[np.ndarray]:
        """The answers of an exchange to the entries of each portion."""
        self.entries(step)
        return [self.answers[step][place] if len(place) else np.zeros(0, np.uint8) for place in self._places[step]]

    def _collect(self, step: int) -> None:
        found, width = [], {1: 1, 2: 3, 3: 2}[step]
        told = self.codes(step - 1) if step > 1 else [None] * len(self.parsed)
        for p, code in zip(self.parsed, told):
            if step == 1:
                found.append(p.phrases()[:, None])
            elif step == 2:
                p.live = p.alive(code > 0)
                p.gaps = p.find_gaps(p.live)
                found.append(p.suffixes(p.gaps[0]))
            else:
                p.open, p.settled = p.unsettled(code)
                found.append(p.windows(p.open))
            p.release()
        rows, again, place = _counted(np.concatenate([np.zeros((0, width), np.uint64), *found]))
        self._entries[step] = rows, again
        self._places[step] = np.split(place, np.cumsum([len(x) for x in found])[:-1]) if found else []


def _cover(size: int, low: np.ndarray, high: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Which places lie in one of the chosen spans; no two begin or end at the same place."""
    change = np.zeros(size + 1, np.int32)
    change[low[chosen]] += 1
    change[high[chosen] + 1] -= 1
    return np.cumsum(change[:-1], dtype=np.int32) > 0


def _send(step: int, least: int, buckets: int):
    def send(docs: pa.Table, answers: pa.Table | None = None) -> pa.Table:
        if not docs.num_rows:
            return pa.table({"block": pa.array([], pa.int64()), "bucket": pa.array([], pa.int32()), "names": pa.array([], pa.binary()), "again": pa.array([], pa.binary())})
        block = docs.column("block")[0].as_py()
        rows, again = _Block(docs, answers, least).entries(step)
        cuts = _slices(rows, buckets)
        used = [i for i in range(buckets) if cuts[i] < cuts[i + 1]]
        return pa.table(
            {
                "block": pa.array([block] * len(used), pa.int64()),
                "bucket": pa.array(used, pa.int32()),
                "names": pa.array([rows[cuts[i] : cuts[i + 1]].tobytes() for i in used], pa.binary()),
                "again": pa.array([again[cuts[i] : cuts[i + 1]].tobytes() for i in used], pa.binary()),
            }
        )

    if step == 1:
        return lambda docs: send(docs)
    return send


def _answer(step: int, width: int):
    """One slice of an order: which names stand more than once, for every block that sent them."""

    def answer(table: pa.Table) -> pa.Table:
        held = table.column("names").to_pylist()
        rows = np.frombuffer(b"".join(held), np.uint64).reshape(-1, width)
        again = np.frombuffer(b"".join(table.column("again").to_pylist()), np.bool_)
        order, new = _ordered(rows)
        head = np.flatnonzero(new)
        sizes = np.diff(np.r_[head, len(rows)])
        repeats = (sizes > 1) | (np.add.reduceat(again[order].astype(np.int64), head) > 0)
        codes = np.empty(len(rows), np.uint8)
        if step == 2:
            entry = rows[order[head]]
            solved = (entry[:, 1] > 0) & repeats
            group = np.unique(entry[:, 0], return_inverse=True)[1]
            unsolved = np.bincount(group, ~solved) > 0
            company = np.bincount(group, np.where(repeats, 2, 1)) > 1
            code = np.where(solved, np.where(unsolved[group], PARTNER, SETTLED), np.where(company[group], OPEN, DEAD))
        else:
            code = repeats
        codes[order] = np.repeat(code, sizes)
        ends = np.cumsum([len(x) // (8 * width) for x in held])
        return pa.table(
            {
                "block": table.column("block"),
                "step": pa.array(np.full(len(held), step, np.int32)),
                "bucket": table.column("bucket"),
                "codes": pa.array([codes[a:b].tobytes() for a, b in zip(np.r_[0, ends[:-1]], ends)], pa.binary()),
            }
        )

    return answer


def _finish(least: int):
    def finish(docs: pa.Table, answers: pa.Table) -> pa.Table:
        block = _Block(docs, answers, least)
        out = []
        for code, part, p in zip(block.codes(3), block.tables, block.parsed):
            repeats = p.settled
            repeats[p.open[code > 0]] = True
            starts = np.flatnonzero(repeats)
            gone = _cover(len(p.data), starts, starts + least - 1, np.ones(len(starts), bool))
            out.append(_rows(part, p, gone))
        return pa.concat_tables(out)

    return finish


def _rows(part: pa.Table, p: Parsed, gone: np.ndarray) -> pa.Table:
    total = np.r_[0, np.cumsum(gone)]
    opens = gone.copy()
    opens[1:] &= ~gone[:-1]
    heads = p.offsets[:-1][p.offsets[:-1] < len(gone)]
    opens[heads] = gone[heads]
    spans = np.r_[0, np.cumsum(opens)]
    left = p.data[~gone].tobytes()
    ends = p.offsets - total[p.offsets]
    kept = [left[a:b] for a, b in zip(ends[:-1], ends[1:])]
    return pa.table(
        {
            "doc_id": part.column("doc_id"),
            "n_bytes": pa.array(np.diff(p.offsets)),
            "n_removed": pa.array(np.diff(total[p.offsets])),
            "n_spans": pa.array(np.diff(spans[p.offsets])),
            "kept": pa.array(kept, pa.binary()),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept]),
        }
    )


def remove_repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256`` for every row.

    A byte goes if a string of ``least`` bytes over it also starts anywhere
    else in the texts (UTF-8 bytes), the same text included; strings may
    overlap, never cross texts, and are judged on the input. ``kept`` are the
    remaining bytes, which need not be whole characters.

    A null text counts as an empty one: nothing is removed. Repeated rows are
    texts like others, so all of them lose what they share. A null id is kept
    as it is. Columns other than ``doc_id`` and ``text`` are ignored. An empty
    table gives an empty one.

    Documents are dealt to blocks by hash, in one shuffle that every step
    reads; a block and a bucket grow with the data over the number of shuffle
    partitions. A block sends each name once with a mark if it repeats there,
    so a string of a third of the corpus costs a bucket one name per block.
    What a name stands for is decided by 128 bits (phrases that occur once by
    64, where an equal name only costs work).
    """
    if least < 2 * TRIGGER:
        raise ValueError(f"least must be {2 * TRIGGER} or more")
    spark = with_package(docs.sparkSession)
    parts = shuffle_partitions(spark)
    blocks, buckets = BLOCKS_PER_PARTITION * parts, -(-parts // 4)
    text_hash = F.xxhash64("doc_id", F.xxhash64("text"))
    dealt = docs.select("doc_id", "text", F.pmod(text_hash, F.lit(blocks)).cast("long").alias("block"))
    by_block = dealt.groupBy("block")
    sent = "block long, bucket int, names binary, again binary"
    told = "block long, step int, bucket int, codes binary"
    answers = None
    for step, width in ((1, 1), (2, 3), (3, 2)):
        if answers is None:
            entries = by_block.applyInArrow(_send(step, least, buckets), sent)
        else:
            known = answers.groupBy("block")
            entries = by_block.cogroup(known).applyInArrow(_send(step, least, buckets), sent)
        answer = entries.groupBy("bucket").applyInArrow(_answer(step, width), told)
        answers = answer if answers is None else answers.unionByName(answer)
    id_type = dict(docs.dtypes)["doc_id"]
    made = f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(_finish(least), made)
