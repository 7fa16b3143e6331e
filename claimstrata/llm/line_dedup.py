"""Line deduplication by an exact set-similarity join.

A line is the set of its words, ordered by rarity. Two lines of Jaccard
similarity 0.8 or more share a word among the first fifth (and one) of either.
If their first common word is rare, they meet on it. If not, all their common
words are frequent, and they meet on two that follow each other in both lines,
within the first two fifths. Lines of up to three words are that similar only
if their word sets are equal, and meet on the whole set. Lines that meet are
compared word by word if their lengths, the positions of what they share and a
bitmap of their words allow the similarity.

Tasks read the texts as byte arrays and take lines, sets and keys from them by
array operations; Spark shuffles keys and joins. Lines of one word set are one
class, named by its number of words, 38 bits of a hash and the bitmap.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from claimstrata.llm.frames import shuffle_partitions, stored, with_package
from claimstrata.llm.near_dup import distinct
from claimstrata.llm.texts import SPACED, byte_view, mix, names, portions, word_spans

# Classes of words that are counted; up to so many small numbers go to every task.
RARITY_BUCKETS = 1 << 22
# Lines of so many words are similar to those of the same word set only.
WHOLE = 3
# Words of a class that occurs less often than 2**RARE_LEVEL - 1 times are rare.
RARE_LEVEL = 10
# Two neighbours that both occur at least 2**COMMON_LEVEL - 1 times meet by length too.
COMMON_LEVEL = 20
# Classes of lines, keys and documents by which those are picked that have something to compare.
PICKED = 1 << 23
KEY_CLASSES = 1 << 26
DOCUMENT_CLASSES = 1 << 20
PARTS_PER_PARTITION = 8
# Numbers of words, and places of a key among them, have so many bits, hashes of a word set so many.
NUMBER_BITS, HASH_BITS = 25, 38
# The place of a key made of two words has this bit besides.
PAIR = 1 << (NUMBER_BITS - 1)

_SEED = 211
_BLOCK = 4096
_NAME_BITS = np.uint64(58)
_NAME = np.uint64((1 << 58) - 1)
_HELD_WORDS = 1 << 22
_HELD_SETS = 1 << 20
_HELD_ROWS = 1 << 17
_OUT_ROWS = 1 << 16
_LINE = "\n"


# Word counts.


def _count(buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = np.zeros(buckets, np.int64), [], 0
        for part in portions(batches, "text"):
            data, offsets = byte_view(part.column("text"))
            starts, ends, _ = word_spans(data, offsets, SPACED)
            held.append((names(_SEED).words(data, starts, ends) % np.uint64(buckets)).astype(np.int64))
            size += len(starts)
            if size > _HELD_WORDS:
                total += np.bincount(np.concatenate(held), minlength=buckets)
                held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=buckets)
        found = np.flatnonzero(total)
        for i in range(0, len(found), _OUT_ROWS):
            some = found[i : i + _OUT_ROWS]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    return run


def _packed(block: pa.Table) -> pa.Table:
    """The levels of one block of word classes as bytes."""
    made = np.zeros(_BLOCK, np.uint8)
    made[block.column("at").to_numpy()] = block.column("level").to_numpy()
    return pa.table({"block": block.column("block").slice(0, 1), "levels": pa.array([made.tobytes()], pa.binary())})


def word_levels(docs: DataFrame, buckets: int = RARITY_BUCKETS) -> np.ndarray:
    """By class of words the logarithm of how often its words occur in all texts; 0 for once.

    One byte for each of ``buckets`` classes, whatever the size of the data.
    """
    counts = docs.select("text").mapInArrow(_count(buckets), "bucket long, n long")
    total = counts.groupBy("bucket").agg(F.sum("n").alias("n"))
    level = F.when(F.col("n") > 1, F.least(F.floor(F.log2(F.col("n") + 1)), F.lit(31))).otherwise(0)
    placed = total.select(
        F.floor(F.col("bucket") / _BLOCK).cast("long").alias("block"),
        F.pmod("bucket", F.lit(_BLOCK)).alias("at"),
        level.cast("int").alias("level"),
    )
    levels = np.zeros(-(-buckets // _BLOCK) * _BLOCK, np.uint8)
    for row in placed.groupBy("block").applyInArrow(_packed, "block long, levels binary").collect():
        levels[row.block * _BLOCK :][:_BLOCK] = np.frombuffer(row.levels, np.uint8)
    return levels[:buckets]


# Lines and their keys.


@dataclass
class Lines:
    """The lines with a word of some rows, and their different words, rarest first."""

    row: np.ndarray
    line_no: np.ndarray
    n_chars: np.ndarray
    words: np.ndarray
    first: np.ndarray
    whole: np.ndarray
    kind: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @property
    def n(self) -> np.ndarray:
        return np.diff(self.first)


def lines_of(column: pa.Array, levels: np.ndarray | None) -> Lines:
    """Without levels the words are in the order of their names."""
    data, offsets = byte_view(column)
    starts, ends, first = word_spans(data, offsets, SPACED)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Lines(none, none, none, none.astype(np.uint64), np.zeros(1, np.int64), *4 * [none.astype(np.uint64)])
    name = names(_SEED).words(data, starts, ends)
    key = name & _NAME
    if levels is not None:
        key |= levels[(name % np.uint64(len(levels))).astype(np.int64)].astype(np.uint64) << _NAME_BITS
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    breaks = np.flatnonzero(data == ord(_LINE))
    before = np.searchsorted(breaks, starts)
    number = before - np.searchsorted(breaks, offsets[:-1])[owner]
    new = np.r_[True, (owner[1:] != owner[:-1]) | (number[1:] != number[:-1])]
    heads = np.flatnonzero(new)
    row, line_no, before = owner[heads], number[heads], before[heads]

    edges = np.r_[breaks, len(data)]
    begin = np.where(line_no > 0, edges[before - 1] + 1, offsets[row])
    end = np.minimum(edges[before], offsets[row + 1])
    signs = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]

    words, line = distinct(key, np.cumsum(new) - 1)
    size = np.bincount(line, minlength=len(heads))
    place = np.r_[0, np.cumsum(size)]
    plain = words & _NAME
    if size.max() >= PAIR:
        raise ValueError(f"a line has {size.max()} different words; {PAIR} are too many")
    whole = mix(np.add.reduceat(mix(plain + np.uint64(1)), place[:-1]) + size.astype(np.uint64))
    kind = whole >> np.uint64(64 - HASH_BITS) << np.uint64(NUMBER_BITS) | size.astype(np.uint64)
    # Each word turns one of 128 bits.
    bit = np.left_shift(np.uint64(1), plain & np.uint64(63))
    upper = plain & np.uint64(64) != 0
    low, high = (np.bitwise_xor.reduceat(np.where(half, bit, np.uint64(0)), place[:-1]) for half in (~upper, upper))
    return Lines(row, line_no, signs[end] - signs[begin], words, place, whole, kind, low, high)


def line_keys(lines: Lines) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``line, key, at``: the keys on which similar lines must meet, and where in the line's order they stand.

    ``at`` has the bit ``PAIR`` where the key is made of two words.

    Let x have n words, a of them not in y, and y have b others. Jaccard 0.8
    means a + 0.8 b <= 0.2 n, so the first common word has a position (from 0)
    of at most n div 5. If it is rare it is a key of both lines. If not, the r
    rare words of x, and those of y, are all on one side only. Each of the
    a + b words on one side only can stand between at most one pair of
    successive common words, and the rare ones stand before all of them. So
    one of the first a + b - r + 1 such pairs has no word between it in either
    line, and its first word has a position of at most 2a + b - r. The largest
    2a + b is 2 (n div 5), and one more where n leaves a rest of 4. Hence the
    keys: the rare words up to position n div 5, and if there are no more than
    n div 5 of them, the pairs of neighbours from position r to that bound less r.
    So many pairs exist if the n - a common words are at least a + b - r + 2,
    which holds from four words on (a = 0 and b at most 1 for four; a + b at
    most 1 for five). Up to ``WHOLE`` words a and b are 0, and the hash of all
    the words is the only key.

    A word that occurs once in all texts meets nothing and gives no key. Pairs
    of very frequent words are keys together with the class of the line's
    length (a power of 1.25) and with the next one: similar lines differ by
    one class at most, and a key that many lines share is dealt out by length.
    """
    n = lines.n
    first = lines.first[:-1]
    if not len(n):
        return first, lines.words, first
    part = n // 5
    level = (lines.words >> _NAME_BITS).astype(np.int64)
    rank = np.arange(len(lines.words)) - np.repeat(first, n)
    rare = (level < RARE_LEVEL) & (rank <= np.repeat(part, n))
    r = np.add.reduceat(rare.astype(np.int64), first)
    whole = n <= WHOLE

    single = np.flatnonzero(rare & (level > 0) & ~np.repeat(whole, n))
    line = [np.flatnonzero(whole), np.repeat(np.arange(len(n)), n)[single]]
    key = [lines.whole[whole], mix(lines.words[single] + np.uint64(5))]
    at = [np.zeros(whole.sum(), np.int64), rank[single]]

    reach = np.minimum(n, 2 * part + (n % 5 == 4) + 2)
    pairs = np.where(whole | (r > part), 0, np.maximum(reach - 1 - 2 * r, 0))
    of = np.repeat(np.arange(len(n)), pairs)
    step = np.arange(len(of)) - np.repeat(np.cumsum(pairs) - pairs, pairs) + r[of]
    one, two = lines.words[first[of] + step], lines.words[first[of] + step + 1]
    made = mix(mix(one + np.uint64(7)) + two)
    common = np.minimum(one, two) >> _NAME_BITS >= COMMON_LEVEL
    scale = np.floor(np.log(n[of]) / np.log(1.25) + 1e-9).astype(np.uint64)
    sized = mix(made + scale + np.uint64(1))
    line += [of, of[common]]
    key += [np.where(common, sized, made), mix(made + scale + np.uint64(2))[common]]
    at += [step | PAIR, step[common] | PAIR]
    return np.concatenate(line), np.concatenate(key), np.concatenate(at)


_FOUND = (
    "line_no int, n_chars long, kind long, low long, high long, keys array<long>, ats array<long>"
)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


def _lists(owner: np.ndarray, values: np.ndarray, size: int) -> pa.Array:
    order = np.argsort(owner, kind="stable")
    ends = np.r_[0, np.cumsum(np.bincount(owner, minlength=size))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values[order], pa.int64()))


def _found(levels):
    """Lines with their figures; the keys of a word set go with its first line in the task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(levels.value, np.uint8)
        sent: set[tuple[int, int, int]] = set()
        for part in portions(batches, "text"):
            lines = lines_of(part.column("text"), table)
            size = len(lines.row)
            fresh = np.zeros(size, bool)
            for i, name in enumerate(zip(lines.kind.tolist(), lines.low.tolist(), lines.high.tolist())):
                if name not in sent:
                    sent.add(name)
                    fresh[i] = True
            if len(sent) > _HELD_SETS:
                sent.clear()
            owner, key, at = line_keys(lines)
            keep = fresh[owner]
            owner, key, at = owner[keep], key[keep], at[keep]
            taken = pa.array(lines.row)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id").take(taken),
                    part.column("th").take(taken),
                    pa.array(lines.line_no, pa.int32()),
                    pa.array(lines.n_chars, pa.int64()),
                    *(_signed(x) for x in (lines.kind, lines.low, lines.high)),
                    _lists(owner, key.view(np.int64), size),
                    _lists(owner, at, size),
                ],
                names=["id", "th", *(x.split(" ")[0] for x in _FOUND.split(", "))],
            )

    return run


# Lines that meet.


_CLASS = ("kind", "low", "high")
_OTHER = ("o_kind", "o_low", "o_high")
_ROW = ("key", *_CLASS, "n", "at", "pair")


def _unpacked(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """The columns of a batch of keys. Keys stay signed, as Spark has sorted them."""
    rows = {name: batch.column(name).to_numpy() for name in ("key", *_CLASS)}
    spot = batch.column("spot").to_numpy()
    return rows | {
        "n": rows["kind"] & ((1 << NUMBER_BITS) - 1),
        "at": spot & (PAIR - 1),
        "pair": spot & PAIR != 0,
    }


def _allowed(x: dict, y: dict, differ: np.ndarray) -> np.ndarray:
    """Whether sizes, positions and bitmaps of lines that share a key allow the similarity.

    At least as many words as bits differ are in one of the lines only. Similar
    lines whose first common word is rare need to meet on that one alone, and
    before it they share nothing.
    """
    small, large = np.minimum(x["n"], y["n"]), np.maximum(x["n"], y["n"])
    room = np.minimum(x["n"] - x["at"], y["n"] - y["at"])
    room += np.where(x["pair"], np.minimum(x["at"], y["at"]), 0)
    total = small + large
    return (9 * differ <= total) & (5 * small >= 4 * large) & (9 * room >= 4 * total)


def _pairs(rows: dict, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which pairs of rows may be similar, with the difference of their bitmaps, and which are of one class."""
    x, y = ({name: rows[name][i] for name in _ROW if name != "key"} for i in (left, right))
    low, high = x["low"] ^ y["low"], x["high"] ^ y["high"]
    # Bits count alike in signed numbers but for the sign.
    differ = sum(np.bitwise_count(half.view(np.uint64)).astype(np.int64) for half in (low, high))
    same = (x["kind"] == y["kind"]) & (differ == 0)
    return _allowed(x, y, differ) & ~same, differ, same


def _lead(rows: dict) -> tuple[list, np.ndarray]:
    """Pairs of a line and the line that leads it, for rows sorted by key and place.

    The earliest line of a key leads those that may be similar to it, the
    earliest of the others leads of those, and so on. Returns pairs of row
    numbers with the difference of their bitmaps, and which rows lead.
    """
    key = rows["key"]
    leads = np.zeros(len(key), bool)
    left, pairs = np.arange(len(key)), []
    while len(left):
        new = np.r_[True, key[left][1:] != key[left][:-1]]
        leader = left[np.flatnonzero(new)[np.cumsum(new) - 1]]
        leads[left[new]] = True
        rest = ~new
        left, leader = left[rest], leader[rest]
        led, differ, same = _pairs(rows, left, leader)
        pairs.append((left[led], leader[led], differ[led]))
        left = left[~(led | same)]
        # A row without another one of its key needs no further look.
        if len(left):
            k = key[left]
            alone = np.r_[True, k[1:] != k[:-1]] & np.r_[k[1:] != k[:-1], True]
            leads[left[alone]] = True
            left = left[~alone]
    return pairs, leads


def _unled(rows: dict, leads: np.ndarray, of: np.ndarray) -> Iterator[tuple]:
    """Pairs of leading rows and the earlier rows of their key that are led, some at a time."""
    key = rows["key"]
    led = np.flatnonzero(~leads)
    # Led rows of the key before each leading row.
    begin = np.searchsorted(led, np.searchsorted(key, key[of]))
    many = np.searchsorted(led, of) - begin
    of, begin, many = of[many > 0], begin[many > 0], many[many > 0]
    total = np.cumsum(many)
    start = 0
    while start < len(of):
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + _HELD_WORDS, "right")))
        sizes = many[start:stop]
        left = np.repeat(of[start:stop], sizes)
        step = np.arange(len(left)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        right = led[np.repeat(begin[start:stop], sizes) + step]
        near, differ, _ = _pairs(rows, left, right)
        yield left[near], right[near], differ[near]
        start = stop


_LED = ", ".join(f"{name} long" for name in (*_CLASS, *_OTHER)) + ", differ int"


def _leaders(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates of a partition that is sorted by key and place.

    Of a key that fills the buffer only the leaders are held on to. A later
    line of it that no leader leads is sent without a partner; it has to meet
    the lines that were let go elsewhere.
    """
    held: dict[str, np.ndarray] = {}
    waiting: list[dict[str, np.ndarray]] = []

    def settled(last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal held
        parts = [held, *waiting] if held else waiting
        held = {name: np.concatenate([part[name] for part in parts]) for name in parts[0]} if parts else {}
        waiting.clear()
        if not held or not len(held["key"]):
            return
        key, old = held["key"], held["old"]
        tail = 0
        if not last and key[0] != key[-1]:
            tail = int(np.flatnonzero(key != key[-1])[-1] + 1)
        whole = tail or len(key)
        rows = {name: held[name][:whole] for name in _ROW}
        pairs, leads = _lead(rows)
        # Rows of the key from which some were let go before.
        cut = (rows["key"] == key[0]) & old[0]
        pairs += _unled(rows, leads, np.flatnonzero(leads & ~cut))
        x, y, differ = (np.concatenate([p[i] for p in pairs]) for i in range(3))
        fresh = ~old[:whole][x]
        x, y, differ = x[fresh], y[fresh], differ[fresh]
        bare = np.flatnonzero(leads & cut & ~old[:whole])
        none = pa.nulls(len(bare), pa.int64())
        of = np.concatenate([x, bare])
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array(rows[name][of]) for name in _CLASS),
                *(pa.concat_arrays([pa.array(rows[name][y]), none]) for name in _CLASS),
                pa.concat_arrays([pa.array(differ, pa.int32()), none.cast(pa.int32())]),
            ],
            names=[field.split(" ")[0] for field in _LED.split(", ")],
        )
        if tail or last:
            held = {name: values[whole:] for name, values in held.items()}
        else:
            held = {name: values[leads] for name, values in held.items()}
            held["old"][:] = True

    size = 0
    for batch in batches:
        waiting.append(_unpacked(batch) | {"old": np.zeros(batch.num_rows, bool)})
        size += batch.num_rows
        if size > _HELD_ROWS:
            yield from settled(False)
            size = int((~held["old"]).sum())
    yield from settled(True)


# Comparison of word sets.


def _sets(picked):
    """The word sets of lines whose class is picked, once for each task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = _flags(picked.value)
        sent: set[tuple[int, int, int]] = set()
        for part in portions(batches, "text"):
            lines = lines_of(part.column("text"), None)
            number = lines.kind >> np.uint64(NUMBER_BITS)
            fresh = []
            for i in np.flatnonzero(flags[(number % np.uint64(PICKED)).astype(np.int64)]).tolist():
                name = int(lines.kind[i]), int(lines.low[i]), int(lines.high[i])
                if name not in sent:
                    sent.add(name)
                    fresh.append(i)
            if len(sent) > _HELD_SETS:
                sent.clear()
            words = [lines.words[lines.first[i] : lines.first[i + 1]].tobytes() for i in fresh]
            yield pa.RecordBatch.from_arrays(
                [*(_signed(x[fresh]) for x in (lines.kind, lines.low, lines.high)), pa.array(words, pa.binary())],
                names=[*_CLASS, "words"],
            )

    return run


def _compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        alike = []
        for one, two in zip(batch.column("x"), batch.column("y")):
            x, y = (np.frombuffer(side.as_buffer(), np.uint64) for side in (one, two))
            at = np.minimum(np.searchsorted(x, y), len(x) - 1)
            alike.append(bool(9 * np.count_nonzero(x[at] == y) >= 4 * (len(x) + len(y))))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in _CLASS), pa.array(alike, pa.bool_())], names=[*_CLASS, "alike"]
        )


def _bits(values: DataFrame, size: int) -> bytes:
    """A bit for each class of the numbers in the only column, by their remainder."""
    # Spark counts the bits of a bitmap from 1, and a remainder from 0.
    number = F.pmod(F.col(values.columns[0]), F.lit(size)) + 1
    made = values.groupBy(F.bitmap_bucket_number(number).alias("at")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")
    )
    block = 4096
    bits = bytearray(size // 8)
    for row in made.collect():
        bits[(row["at"] - 1) * block : row["at"] * block] = row["bits"]
    return bytes(bits)


def _flags(bits: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").astype(bool)


def _holding(picked):
    """The classes of documents that hold a picked line."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = _flags(picked.value)
        for batch in batches:
            number = (batch.column("kind").to_numpy() >> NUMBER_BITS) % PICKED
            held = np.unique(batch.column("th").to_numpy()[flags[number]] % DOCUMENT_CLASSES)
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64())], names=["number"])

    return run


def _judged(docs: DataFrame, found: DataFrame, pairs: DataFrame) -> DataFrame:
    """The first of each pair of classes with ``alike``, from the word sets of both."""
    sides = pairs.select("kind").unionByName(pairs.select(F.col("o_kind").alias("kind")))
    picked = docs.sparkSession.sparkContext.broadcast(_bits(sides.select(F.shiftright("kind", NUMBER_BITS)), PICKED))
    lines = found.where(F.size("keys") > 0).select("th", "kind")
    some = F.broadcast(lines.mapInArrow(_holding(picked), "number long").distinct())
    number = F.pmod("th", F.lit(DOCUMENT_CLASSES)).alias("number")
    texts = docs.select("text", number).join(some, "number", "left_semi").select("text")
    held = texts.mapInArrow(_sets(picked), "kind long, low long, high long, words binary")
    sets = stored(held.groupBy(*_CLASS).agg(F.first("words").alias("words")), "line_sets")
    both = pairs.join(sets.withColumnRenamed("words", "x"), [*_CLASS])
    both = both.join(sets.toDF(*_OTHER, "y"), [*_OTHER])
    return both.select(*_CLASS, "x", "y").mapInArrow(_compared, "kind long, low long, high long, alike boolean")


def _index(found: DataFrame) -> DataFrame:
    """A row for each key of each line whose keys were sent; ``spot`` is the line number, then the key's place."""
    each = F.explode(F.arrays_zip("keys", "ats")).alias("k")
    rows = found.where(F.size("keys") > 0).select("id", "line_no", *_CLASS, each)
    spot = F.shiftleft(F.col("line_no").cast("long"), NUMBER_BITS).bitwiseOR(F.col("k.ats"))
    return rows.select(F.col("k.keys").alias("key"), "id", spot.alias("spot"), *_CLASS)


def _with_keys(opened):
    """The rows of ``_index`` whose keys are open ones, and some others."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = _flags(opened.value)
        for batch in batches:
            keys, owner = pc.list_flatten(batch.column("keys")), pc.list_parent_indices(batch.column("keys"))
            take = np.flatnonzero(flags[keys.to_numpy() % KEY_CLASSES])
            owner = owner.take(pa.array(take))
            ats = pc.list_flatten(batch.column("ats")).take(pa.array(take)).to_numpy()
            line_no = batch.column("line_no").take(owner).to_numpy().astype(np.int64)
            spot = pa.array(line_no << NUMBER_BITS | ats, pa.int64())
            rest = [batch.column(name).take(owner) for name in _CLASS]
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(take)), batch.column("id").take(owner), spot, *rest], names=["key", "id", "spot", *_CLASS]
            )

    return run


def _meeting() -> Column:
    """The condition on which an open class ``x`` meets a line ``y`` that begins earlier."""
    n, on = (F.col(f"{side}.kind").bitwiseAND(F.lit((1 << NUMBER_BITS) - 1)) for side in "xy")
    at, o_at = (F.col(f"{side}.spot").bitwiseAND(F.lit(PAIR - 1)) for side in "xy")
    pair = F.col("x.spot").bitwiseAND(F.lit(PAIR)) != 0
    small, large = F.least(n, on), F.greatest(n, on)
    room = F.least(n - at, on - o_at) + F.when(pair, F.least(at, o_at)).otherwise(0)
    differ = sum(F.bit_count(F.col(f"x.{half}").bitwiseXOR(F.col(f"y.{half}"))) for half in ("low", "high"))
    x, y = (F.struct(F.col(f"{side}.id"), F.shiftright(f"{side}.spot", NUMBER_BITS).alias("line_no")) for side in "xy")
    return (
        (F.col("x.key") == F.col("y.key"))
        & (5 * small >= 4 * large)
        & (9 * room >= 4 * (small + large))
        & (9 * differ <= small + large)
        & (y < x)
        & ~((F.col("x.kind") == F.col("y.kind")) & (differ == 0))
    )


def _repeating(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The classes to which a class that begins earlier is similar.

    One earlier class is enough. Under each key a line is held against the
    line that leads it, so the members of a large group of variants are not
    all paired up, and one that none leads against all earlier ones. Of these
    candidates the one whose bitmap differs least is compared; classes that it
    does not settle meet all that begin earlier.
    """
    index = _index(found)
    sorted_rows = index.repartition("key").sortWithinPartitions("key", "id", "spot", "kind")
    led = sorted_rows.select("key", "spot", *_CLASS).mapInArrow(_leaders, _LED)
    partner = F.when(F.col("o_kind").isNotNull(), F.struct("differ", *_OTHER))
    closest = stored(led.groupBy(*_CLASS).agg(F.min(partner).alias("o")), "led_lines")
    pairs = closest.where("o IS NOT NULL").select(*_CLASS, *(f"o.{name}" for name in _OTHER))
    judged = stored(_judged(docs, found, pairs), "judged_lines")
    alike = judged.where("alike").select(*_CLASS)
    again = judged.where("NOT alike").select(*_CLASS).unionByName(closest.where("o IS NULL").select(*_CLASS))
    if again.isEmpty():
        return alike

    # Only a class's first line counts, as others may follow the line it meets.
    mine = index.join(again, [*_CLASS], "left_semi")
    begin = mine.groupBy("key", *_CLASS).agg(F.min(F.struct("id", "spot")).alias("first"))
    begin = stored(begin.select("key", "first.id", "first.spot", *_CLASS), "open_keys")
    # Keys that no open line has are not shuffled again.
    opened = docs.sparkSession.sparkContext.broadcast(_bits(begin.select("key"), KEY_CLASSES))
    lines = found.where(F.size("keys") > 0).select("id", "line_no", *_CLASS, "keys", "ats")
    other = lines.mapInArrow(_with_keys(opened), begin.schema)
    every = begin.alias("x").join(other.alias("y"), _meeting())
    every = every.select(
        *(F.col(f"x.{name}") for name in _CLASS), *(F.col(f"y.{name}").alias(o) for name, o in zip(_CLASS, _OTHER))
    )
    rest = _judged(docs, found, stored(every.distinct(), "open_lines"))
    return alike.unionByName(rest.where("alike").select(*_CLASS).distinct())


def removed_lines(docs: DataFrame, buckets: int = RARITY_BUCKETS) -> DataFrame:
    """``id, th, line_no, n_chars`` of every line that repeats an earlier one."""
    spark = with_package(docs.sparkSession)
    levels = spark.sparkContext.broadcast(word_levels(docs, buckets).tobytes())
    read = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("th"), F.coalesce("text", F.lit("")).alias("text"))
    fields = [*read.select("id", "th").schema.fields, *StructType.fromDDL(_FOUND).fields]
    found = stored(read.mapInArrow(_found(levels), StructType(fields)), "found_lines")

    place = F.struct("id", "line_no")
    classes = found.groupBy(*_CLASS).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies"))
    repeating = _repeating(read, found).withColumn("repeats", F.lit(True))
    cut = classes.join(repeating, [*_CLASS], "left").where("repeats OR copies > 1")
    # A class that repeats goes whole, any other but for its first line.
    cut = cut.select(*_CLASS, "copies", F.when(F.col("repeats"), None).otherwise(F.col("first")).alias("first"))
    cut = stored(cut, "cut_lines")

    # Classes of many copies are few and broadcast, so their lines are not gathered.
    parts = PARTS_PER_PARTITION * shuffle_partitions(spark)
    limit = -(-(cut.agg(F.sum("copies")).first()[0] or 0) // parts)
    lines = found.select("id", "th", "line_no", "n_chars", *_CLASS)
    hot = F.broadcast(cut.where(F.col("copies") > limit).drop("copies"))
    cold = cut.where(F.col("copies") <= limit).drop("copies")
    met = lines.join(hot, [*_CLASS]).unionByName(
        lines.join(hot.select(*_CLASS), [*_CLASS], "left_anti").join(cold, [*_CLASS])
    )
    later = F.col("first").isNull() | (place > F.col("first"))
    return met.where(later).select("id", "th", "line_no", "n_chars")


def line_figures(docs: DataFrame, buckets: int = RARITY_BUCKETS) -> DataFrame:
    """``doc_id, n_lines, n_removed, chars_removed, removed`` (line numbers) for every row.

    Lines end at a line feed. A line takes part if it has a word (a run
    without white space); it is removed if an earlier line of the corpus has a
    word set of Jaccard similarity 0.8 or more to its own, whether or not that
    line stays. Lines are ordered by document id (null first), then line number.

    A null text has no lines, an empty one a single empty line that stays.
    Rows equal in id and text are one document; of rows that share only the id,
    equal lines of one number both stay. Words count as equal if 58 bits of
    their names are, and word sets if 38 bits of a hash, the number
    of words and 128 bits of their bitmap are. A line of more than 16
    million different words is an error. Other columns are ignored.
    An empty table gives an empty one.

    Texts are read three times and not shuffled: for the word counts, for lines
    and keys, and for the word sets of lines that have a candidate; a fourth
    time where a line's closest candidate is not similar to it. A line of a
    third of all rows costs one row with keys for each task. Rarity is a byte
    for each of ``buckets`` classes of words, and a bit for each of ``PICKED``
    classes of lines picks those to compare, whatever the size of the data.
    No candidate is capped, and groups of similar lines are not paired up in full.
    """
    gone = removed_lines(docs, buckets).distinct().groupBy("id", "th").agg(
        F.count(F.lit(1)).alias("n_removed"),
        F.sum("n_chars").alias("chars_removed"),
        F.sort_array(F.collect_list("line_no")).alias("removed"),
    )
    rows = docs.select(
        F.col("doc_id").alias("doc_id"),
        F.xxhash64("text").alias("th0"),
        (F.length("text") - F.length(F.replace("text", F.lit(_LINE))) + 1).cast("long").alias("n_lines"),
    )
    found = rows.join(gone, rows["doc_id"].eqNullSafe(gone["id"]) & (rows["th0"] == gone["th"]), "left")
    return found.select(
        "doc_id",
        F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("chars_removed", F.lit(0)).cast("long").alias("chars_removed"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
    )


def _holds_word(line: Column) -> Column:
    return F.length(F.trim(F.translate(line, "\t\x0b\x0c\r", "    "))) > 0


def drop_lines(docs: DataFrame, buckets: int = RARITY_BUCKETS) -> DataFrame:
    """Rows with the lines that stay; ``n_chars`` follows the text, other columns are kept, whatever their names.

    A document that had words and lost all of them to removed lines goes. One
    that had none, a null or empty text too, stays as it is. Only documents
    that may lose a line are shuffled, with a column for the whole row.
    """
    gone = removed_lines(docs, buckets).distinct().groupBy("id", "th").agg(F.collect_list("line_no").alias("removed"))
    gone = stored(gone, "removed_lines")
    row = F.struct(*(F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(docs.columns)))
    keyed = docs.select(row.alias("row"), F.col("doc_id").alias("key_id"), F.xxhash64("text").alias("key_th"))
    number = F.pmod("th", F.lit(1 << 20)).alias("number")
    some = F.broadcast(gone.select(number).distinct())
    mine = F.pmod("key_th", F.lit(1 << 20)) == F.col("number")
    same = F.col("key_id").eqNullSafe(F.col("id")) & (F.col("key_th") == F.col("th"))
    touched = keyed.join(some, mine, "left_semi").join(gone, same, "left")
    untouched = keyed.join(some, mine, "left_anti")

    place = {name: i for i, name in enumerate(docs.columns)}
    text = F.col(f"row.c{place['text']}")
    lines = F.split(text, _LINE)
    numbers = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("removed"))
    left = F.array_join(F.transform(numbers, lambda i: F.get(lines, i)), _LINE)
    # Only lines with words are removed.
    worded = F.exists(numbers, lambda i: _holds_word(F.get(lines, i)))
    none = F.col("removed").isNull()
    touched = touched.where(none | worded)
    changed = {name: F.col(f"row.c{i}") for name, i in place.items()}
    changed["text"] = F.when(none, text).otherwise(left)
    if "n_chars" in place:
        length = F.length(left).cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(none, changed["n_chars"]).otherwise(length)
    made = touched.select(*(column.alias(name) for name, column in changed.items()))
    return made.unionByName(untouched.select(*(F.col(f"row.c{i}").alias(name) for name, i in place.items())))
