"""How far the sources of a language differ in their use of terms.

Every source of a language, a group, gives each kept term a share of a billion
that depends on nothing but the group and the term's count there. So the
distance of two groups needs only their joint table: how many terms have count
c in the one and d in the other. With an indicator column for every (group,
count level), all joint tables are one product of the transposed indicator
matrix with itself. It is made in blocks of terms and of groups; each block
prices its joint counts, and the prices add up. Counts are whole numbers below
2**24, so the products are exact in single precision.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimstrata.llm.frames import stored, with_package

# Fixed values of the contract.
LEAST_DOCUMENTS = 30
SMOOTHING = 5
UNIT = 1_000_000_000
MOST_TERMS = 50

# Terms and groups of one block, columns of one product, and terms a task holds.
TERM_BLOCK = 512
GROUP_BLOCK = 32
COLUMN_BLOCK = 2048
HELD_TERMS = 400_000
CHUNK_BYTES = 1 << 20

# Letters and everything beyond ASCII stay, A-Z in lower case; the rest parts terms.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of about a megabyte; no term is cut."""
    folded = text.translate(_FOLD)
    start = 0
    while start < len(folded):
        end = folded.find(b" ", start + CHUNK_BYTES)
        end = len(folded) if end < 0 else end
        yield folded[start:end].split()
        start = end


class _Partial:
    """Counts of a task's rows until they are handed on: occurrences and documents."""

    fields = (
        ("lang", pa.string()),
        ("source", pa.string()),
        ("term", pa.string()),
        ("n", pa.int64()),
        ("docs", pa.int64()),
    )

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        self.held = 0

    def add(self, group: tuple[str, str], text: bytes) -> None:
        count, docs = self.groups.setdefault(group, (Counter(), Counter()))
        before = len(count)
        parts = terms(text)
        first = next(parts, [])
        seen = set(first)
        count.update(first)
        for part in parts:
            count.update(part)
            seen.update(part)
        docs.update(seen)
        self.held += len(count) - before

    def rows(self) -> Iterator[pa.RecordBatch]:
        """One row per group and term, and one without term for each group."""
        for (lang, source), (count, docs) in self.groups.items():
            found = list(count)
            columns = (
                [lang] * (len(found) + 1),
                [source] * (len(found) + 1),
                pa.array([None, *found], pa.binary()).cast(pa.string()),
                [0, *count.values()],
                [0, *(docs[term] for term in found)],
            )
            arrays = [pa.array(x, kind) for x, (_, kind) in zip(columns, self.fields)]
            yield pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in self.fields])
        self.groups, self.held = {}, 0


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    partial = _Partial()
    for batch in batches:
        langs, sources, texts = (batch.column(name) for name in ("lang", "source", "text"))
        for i in range(batch.num_rows):
            partial.add((langs[i].as_py(), sources[i].as_py()), texts[i].as_buffer().to_pybytes())
            if partial.held > HELD_TERMS:
                yield from partial.rows()
    yield from partial.rows()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``, and a row without term for every group."""
    with_package(docs.sparkSession)
    read = docs.select(*(F.coalesce(F.col(name), F.lit("")).alias(name) for name in ("lang", "source", "text")))
    partial = read.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, kept: Column) -> Column:
    """The share of a term, exact for counts of any size."""
    wide = "decimal({},0)"
    over = (F.lit(UNIT).cast(wide.format(10)) * (count + SMOOTHING).cast(wide.format(20)))
    under = (total + SMOOTHING * kept).cast(wide.format(20))
    return F.call_function("div", over, under) + 1


def _with_shares(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Kept terms by group with the shares of group and language, and the groups with their figures."""
    counts = stored(term_counts(docs), "terms")
    by_term = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(
        F.sum("n").alias("lang_n"), F.sum("docs").alias("lang_docs")
    )
    kept = stored(by_term.where(F.col("lang_docs") >= least).select("lang", "term", "lang_n"), "kept_terms")
    langs = kept.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count(F.lit(1)).alias("v"))
    used = stored(counts.where("term IS NOT NULL").drop("docs").join(kept, ["lang", "term"]), "used_terms")
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    none = {name: F.coalesce(name, F.lit(0).cast("long")) for name in ("total", "lang_total", "v")}
    groups = counts.where("term IS NULL").select("lang", "source")
    groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").withColumns(none)
    groups = groups.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    nothing = F.when(F.col("v") > 0, _share(F.lit(0).cast("long"), F.col("total"), F.col("v")))
    groups = stored(groups.withColumn("p0", nothing), "groups")
    shared = used.join(groups, ["lang", "source"]).withColumns(
        {
            "p": _share(F.col("n"), F.col("total"), F.col("v")),
            "q": _share(F.col("lang_n"), F.col("lang_total"), F.col("v")),
        }
    )
    return shared, groups


def _one_hot(counts: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indicator columns for (group, count level) of a terms x groups block.

    Returns the matrix, the share that stands for each column and the first
    column of each group.
    """
    columns, prices, starts = [], [], []
    for group in range(counts.shape[1]):
        levels, first, code = np.unique(counts[:, group], return_index=True, return_inverse=True)
        made = np.zeros((len(counts), len(levels)), np.float32)
        made[np.arange(len(counts)), code] = 1
        starts.append(sum(map(len, prices)))
        columns.append(made)
        prices.append(shares[first, group])
    return np.concatenate(columns, axis=1), np.concatenate(prices), np.array(starts)


def _priced(left: tuple, right: tuple) -> np.ndarray:
    """The distance over a block's terms for each pair of groups, from the joint tables."""
    (x, p, x_starts), (y, q, y_starts) = left, right
    total = np.zeros((len(x_starts), len(y_starts)), np.int64)
    for i in range(0, x.shape[1], COLUMN_BLOCK):
        rows = slice(i, i + COLUMN_BLOCK)
        owner_x = np.searchsorted(x_starts, np.arange(x.shape[1])[rows], "right") - 1
        for j in range(0, y.shape[1], COLUMN_BLOCK):
            cols = slice(j, j + COLUMN_BLOCK)
            owner_y = np.searchsorted(y_starts, np.arange(y.shape[1])[cols], "right") - 1
            joint = (x[:, rows].T @ y[:, cols]).astype(np.int64)
            joint *= np.abs(p[rows, None] - q[None, cols])
            # Columns of one group follow each other, so a group's sum is a run.
            heads_x = np.flatnonzero(np.r_[True, owner_x[1:] != owner_x[:-1]])
            heads_y = np.flatnonzero(np.r_[True, owner_y[1:] != owner_y[:-1]])
            sums = np.add.reduceat(np.add.reduceat(joint, heads_x, 0), heads_y, 1)
            total[np.ix_(owner_x[heads_x], owner_y[heads_y])] += sums
    return total


def _tile(block: pa.Table) -> pa.Table:
    """Partial distances of the pairs of one block of terms and two blocks of groups."""
    lang, one, two = (block.column(name)[0].as_py() for name in ("lang", "one", "two"))
    place = block.column("place").to_numpy()
    head = np.asarray(block.column("term").is_null())
    places = place[head]
    order = np.argsort(places)
    places = places[order]
    names = block.column("source").filter(pa.array(head)).take(pa.array(order)).to_pylist()
    nothing = np.nan_to_num(block.column("p").to_numpy()[head][order]).astype(np.int64)
    whole = int(block.column("n").to_numpy()[head][0])

    rows = block.filter(pa.array(~head))
    codes = rows.column("term").combine_chunks().dictionary_encode()
    at = np.searchsorted(places, rows.column("place").to_numpy())
    size = len(codes.dictionary)
    term = codes.indices.to_numpy(zero_copy_only=False)
    counts = np.zeros((size, len(places)), np.int64)
    counts[term, at] = rows.column("n").to_numpy()
    shares = np.broadcast_to(nothing, counts.shape).copy()
    shares[term, at] = rows.column("p").to_numpy()

    cut = int(np.searchsorted(places, (one + 1) * GROUP_BLOCK)) if one != two else len(places)
    second = 0 if one == two else cut
    # Terms of the block that none of these groups has are a joint count of (0, 0).
    distance = (whole - size) * np.abs(nothing[:cut, None] - nothing[None, second:])
    if size:
        left = _one_hot(counts[:, :cut], shares[:, :cut])
        right = left if one == two else _one_hot(counts[:, second:], shares[:, second:])
        distance += _priced(left, right)
    x, y = np.meshgrid(np.arange(cut), second + np.arange(len(places) - second), indexing="ij")
    apart = x != y
    x, y, distance = x[apart], y[apart], distance[apart]
    if one != two:  # Blocks of a block with itself hold both directions already.
        x, y, distance = np.r_[x, y], np.r_[y, x], np.r_[distance, distance]
    names = np.array(names, object)
    return pa.table(
        {
            "lang": pa.array([lang] * len(x), pa.string()),
            "source": pa.array(names[x], pa.string()),
            "item": pa.array(names[y], pa.string()),
            "value": pa.array(distance, pa.int64()),
        }
    )


def _distances(shared: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for both directions of every pair of groups of a language."""
    # Terms of like frequency have like levels, so they share blocks. A class of
    # frequency is cut into as many blocks as its terms fill.
    scale = F.floor(F.log2("lang_n")).cast("int").alias("scale")
    kept = shared.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n"))
    sizes = kept.groupBy("lang", scale).agg(F.ceil(F.count(F.lit(1)) / TERM_BLOCK).cast("int").alias("blocks"))
    part = F.pmod(F.xxhash64("term"), "blocks").cast("int").alias("part")

    def dealt(terms_: DataFrame) -> DataFrame:
        return terms_.withColumn("scale", scale).join(F.broadcast(sizes), ["lang", "scale"]).select(
            "lang", "scale", part, *(name for name in ("place", "source", "term", "n", "p") if name in terms_.columns)
        )

    # A language without kept terms has one block, of groups alone.
    parts = dealt(kept).groupBy("lang", "scale", "part").agg(F.count(F.lit(1)).alias("n"))
    bare = groups.where("v = 0").select("lang", F.lit(-1).alias("scale"), F.lit(0).alias("part"), F.lit(0).alias("n"))
    heads = groups.join(parts.unionByName(bare.distinct()), "lang").select(
        "lang", "scale", "part", "place", "source", F.lit(None).cast("string").alias("term"),
        F.col("n").cast("long").alias("n"), F.col("p0").alias("p"),
    )
    rows = dealt(shared)
    last = groups.groupBy("lang").agg(F.floor(F.max("place") / GROUP_BLOCK).cast("int").alias("last"))
    own = F.floor(F.col("place") / GROUP_BLOCK).cast("int")
    tiles = rows.unionByName(heads).join(F.broadcast(last), "lang").withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("last")))
    )
    tiles = tiles.select(
        "lang", "scale", "part", F.least(own, "other").alias("one"), F.greatest(own, "other").alias("two"),
        "place", "source", "term", "n", "p",
    )
    partial = tiles.groupBy("lang", "scale", "part", "one", "two").applyInArrow(
        _tile, "lang string, source string, item string, value long"
    )
    return partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, most: int = MOST_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank`` from ``lang, source, text``.

    Part ``pair``: the distance of a source to each other source of its
    language, the sum of absolute differences of shares over all kept terms.
    Part ``term``: up to ``most`` terms that the source uses more than its
    language, with the difference. Ranks run from 1 by value, then by item.
    Shares, sums and ranks are exact.

    Terms are runs of letters and non-ASCII characters, A-Z in lower case; a
    term is kept if at least ``least`` documents of the language have it.
    Rows that repeat are documents of their own. A null text, language or
    source is an empty one. A group without terms takes part with the count 0,
    and where a language keeps no term all its distances are 0. Other columns
    are ignored, whatever their names; an empty table gives an empty one.

    Tasks count their texts before the shuffle and hold a bounded number of
    different terms and a megabyte of a long text. A product is of about
    ``TERM_BLOCK`` terms (hashing deals them out) and ``GROUP_BLOCK`` groups on
    either side. Broadcast are sizes by language and power of two of the
    term frequency. The pairs are as many as the result has.
    """
    shared, groups = _with_shares(docs, least)
    ahead = F.col("p") - F.col("q")
    used = shared.where("n > 0 AND p > q").select("lang", "source", F.col("term").alias("item"), ahead.alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    parts = []
    for name, rows in (("pair", _distances(shared, groups)), ("term", used)):
        ranked = rows.withColumn("rank", F.row_number().over(by_value))
        if name == "term":
            ranked = ranked.where(F.col("rank") <= most)
        parts.append(ranked.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank"))
    return parts[0].unionByName(parts[1])
