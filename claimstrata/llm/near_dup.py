"""Near-duplicate documents by MinHash with tensored banding, verified on full sets.

A document is its set of word shingles. Two collections of ``COLLECTION`` hash
rows with ``ROWS`` MinHash values each give a key for every pair of a row of
the first and a row of the second, so 64 tables cost 32 MinHash values instead
of 256. Documents that share a key are candidates. At the similarity 0.8 a pair
shares a key with probability ``(1 - (1 - 0.8**2)**8)**2``, above 0.999.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimstrata.llm.frames import components, dealt, renamed, shuffle_partitions, stored, with_package
from claimstrata.llm.texts import SPACED, byte_view, mix, names, portions, word_spans

COLLECTION = 8
ROWS = 2
HASHES = 2 * COLLECTION * ROWS
# Of 32 MinHash values a pair of similarity 0.8 has 15 or more in common with
# a probability above 0.9999.
LEAST_COMMON = 15
# Documents with a common key are compared pair by pair up to this number;
# larger groups are joined to families and compared block by block.
SMALL = 32
BLOCK = 512
_SEED = 101
# Similarity of 80 in 100.
PART, WHOLE = 80, 100


def shingles(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle names of each row, sorted, and the row of each.

    A shingle is ``size`` consecutive words (no white space inside, A to Z in
    lower case); a row of fewer words is one shingle.
    """
    data, offsets = byte_view(column)
    starts, ends, first = word_spans(data, offsets, SPACED)
    namer = names(_SEED, True)
    words = namer.words(data, starts, ends)
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(counts)), counts)
    found, rows = [], []
    for length in range(1, size + 1):
        if length == size:
            left = first[1:][owner] - np.arange(len(words))
            at = np.flatnonzero(left >= size)
        else:
            at = first[:-1][counts == length]
        name = np.full(len(at), length, np.uint64)
        for k in range(length):
            name = mix(name * np.uint64(0x9E3779B97F4A7C15) + words[at + k])
        found.append(name)
        rows.append(owner[at])
    return distinct(np.concatenate(found), np.concatenate(rows))


def distinct(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values of each row, ordered by row and value."""
    order = np.argsort(values, kind="stable")
    rows = rows[order]
    if len(rows) and rows.max() < 1 << 16:  # sorted by counting
        order = order[np.argsort(rows.astype(np.uint16), kind="stable")]
        rows = np.sort(rows)
    else:
        again = np.argsort(rows, kind="stable")
        order, rows = order[again], rows[again]
    values = values[order]
    new = np.r_[True, (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])][: len(values)]
    return values[new], rows[new]


def _minima(values: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """MinHash values, one row of the result per hash function."""
    random = np.random.default_rng(_SEED)
    made = np.empty((HASHES, len(heads)), np.uint64)
    for i in range(HASHES):
        factor, other = random.integers(1 << 40, 1 << 63, 2, dtype=np.uint64) | np.uint64(1)
        hashed = values * factor
        hashed ^= hashed >> np.uint64(31)
        hashed *= other
        made[i] = np.minimum.reduceat(hashed, heads)
    return made


def _sign(size: int):
    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches, "text"):
            values, rows = shingles(part.column("text"), size)
            count = np.bincount(rows, minlength=part.num_rows)
            full = np.flatnonzero(count)
            heads = (np.cumsum(count) - count)[full]
            name = np.zeros((part.num_rows, 2), np.uint64)
            bands = np.zeros((part.num_rows, 2 * COLLECTION), np.uint64)
            sketch = np.zeros((part.num_rows, HASHES), np.uint8)
            if len(full):
                name[full, 0] = np.add.reduceat(mix(values + np.uint64(1)), heads)
                name[full, 1] = np.add.reduceat(mix(values * np.uint64(3) + np.uint64(2)), heads)
                low = _minima(values, heads)
                sketch[full] = (mix(low) & np.uint64(255)).astype(np.uint8).T
                for i in range(2 * COLLECTION):
                    key = np.full(len(full), i, np.uint64)
                    for j in range(ROWS):
                        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + low[i * ROWS + j])
                    bands[full, i] = key
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("h1"),
                    part.column("h2"),
                    pa.array(count, pa.int64()),
                    _fixed(name),
                    _fixed(bands),
                    _fixed(sketch),
                ],
                names=["doc_id", "h1", "h2", "n", "name", "bands", "sketch"],
            )

    return sign


def _fixed(rows: np.ndarray) -> pa.Array:
    """One binary value per row of a matrix."""
    return pa.array([row.tobytes() for row in rows], pa.binary())


def _emit(buckets: int):
    """Keys of classes, packed by bucket. A key that many classes of this task
    share is sent once, for the smallest of them; the others link to that one."""

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        ids = np.concatenate([b.column("cid").to_numpy() for b in held])
        bands = np.concatenate([_matrix(b.column("bands"), np.uint64) for b in held])
        left, right = bands[:, :COLLECTION], bands[:, COLLECTION:]
        for i in range(COLLECTION):
            keys = np.concatenate(
                [mix(left[:, i] + mix(right[:, j] + np.uint64(i * COLLECTION + j))) for j in range(COLLECTION)]
            )
            owner = np.tile(ids, COLLECTION)
            order = np.lexsort((owner, keys))
            keys, owner = keys[order], owner[order]
            head = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            sizes = np.diff(np.r_[head, len(keys)])
            many = np.repeat(sizes > SMALL, sizes)
            lead = np.repeat(owner[head], sizes)
            first = np.zeros(len(keys), bool)
            first[head] = True
            send = ~many | first
            bucket = (keys >> np.uint64(32)) % np.uint64(buckets)
            for b in np.unique(bucket):
                here = bucket == b
                go, link = here & send, here & many & ~first
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(b)], pa.int32()),
                        pa.array([keys[go].tobytes()], pa.binary()),
                        pa.array([owner[go].tobytes()], pa.binary()),
                        pa.array([many[go].astype(np.uint8).tobytes()], pa.binary()),
                        pa.array([np.stack([lead[link], owner[link]], 1).tobytes()], pa.binary()),
                    ],
                    names=["bucket", "keys", "ids", "many", "links"],
                )

    return emit


def _matrix(column: pa.Array, kind) -> np.ndarray:
    rows = [np.frombuffer(x, kind) for x in column.to_pylist()]
    return np.stack(rows) if rows else np.zeros((0, 0), kind)


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _pair_up(table: pa.Table) -> pa.Table:
    """The candidate pairs of a bucket, and the links inside its large groups."""
    keys, ids = _joined(table.column("keys"), np.uint64), _joined(table.column("ids"), np.int64)
    many = _joined(table.column("many"), np.uint8)
    links = _joined(table.column("links"), np.int64).reshape(-1, 2)
    order = np.lexsort((ids, keys))
    keys, ids, many = keys[order], ids[order], many[order]
    head = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[head, len(keys)])
    large = sizes > SMALL
    if len(head):
        large |= np.maximum.reduceat(many, head) > 0
    spread = np.repeat(large, sizes)
    lead = np.repeat(ids[head], sizes)[spread]
    linked = np.concatenate([links, np.stack([lead, ids[spread]], 1)])
    linked = linked[linked[:, 0] != linked[:, 1]]
    pairs = [np.zeros((0, 2), np.int64)]
    for size in range(2, SMALL + 1):
        groups = head[(sizes == size) & ~large]
        if len(groups):
            members = ids[groups[:, None] + np.arange(size)]
            a, b = np.triu_indices(size, 1)
            pairs.append(np.stack([members[:, a].ravel(), members[:, b].ravel()], 1))
    pairs, linked = _unique(np.concatenate(pairs)), _unique(linked)
    both = np.concatenate([pairs, linked])
    family = np.r_[np.zeros(len(pairs), bool), np.ones(len(linked), bool)]
    return pa.table({"a": both[:, 0], "b": both[:, 1], "family": family})


def _unique(pairs: np.ndarray) -> np.ndarray:
    pairs = np.sort(pairs, axis=1)
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    pairs = pairs[order]
    return pairs[np.r_[True, (pairs[1:] != pairs[:-1]).any(axis=1)][: len(pairs)]]


def _alike(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sizes allow the similarity and whose sketches agree often enough."""
    for batch in batches:
        if not batch.num_rows:
            continue
        n, m = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
        a, b = _matrix(batch.column("sketch_a"), np.uint8), _matrix(batch.column("sketch_b"), np.uint8)
        keep = (a == b).sum(axis=1) >= LEAST_COMMON
        keep &= WHOLE * np.minimum(n, m) >= PART * np.maximum(n, m)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _verify(size: int):
    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches, "text_a"):
            x, row_x = shingles(part.column("text_a"), size)
            y, row_y = shingles(part.column("text_b"), size)
            both = distinct(np.r_[x, y], np.r_[row_x, row_y])[1]
            union = np.bincount(both, minlength=part.num_rows)
            total = np.bincount(row_x, minlength=part.num_rows) + np.bincount(row_y, minlength=part.num_rows)
            keep = WHOLE * (total - union) >= PART * union
            yield part.select(["a", "b"]).filter(pa.array(keep))

    return verify


def _connect(size: int):
    """Links that connect what is similar within one group of texts.

    A search from one text to the next: each text that is reached is compared
    with all that are not yet, by counting common shingles, and the search
    ends early when everything is reached.
    """

    def connect(table: pa.Table) -> pa.Table:
        ids = table.column("cid").to_numpy()
        values, rows = shingles(table.column("text").combine_chunks(), size)
        counts = np.bincount(rows, minlength=len(ids))
        begin = np.cumsum(counts) - counts
        _, numbers = np.unique(values, return_inverse=True)
        order = np.argsort(numbers, kind="stable")
        owners = rows[order]
        df = np.bincount(numbers, minlength=1)
        post = np.cumsum(df) - df
        waiting = np.ones(len(ids), bool)
        links: list[np.ndarray] = []
        while waiting.any():
            seed = int(np.flatnonzero(waiting)[0])
            waiting[seed] = False
            queue = [seed]
            while queue and waiting.any():
                at = queue.pop()
                mine = numbers[begin[at] : begin[at] + counts[at]]
                reps = df[mine]
                where = np.repeat(post[mine] - np.cumsum(reps) + reps, reps) + np.arange(reps.sum())
                common = np.bincount(owners[where], minlength=len(ids))
                union = counts + counts[at] - common
                found = np.flatnonzero(waiting & (WHOLE * common >= PART * union) & (common > 0))
                waiting[found] = False
                queue.extend(found.tolist())
                links.append(np.stack([np.full(len(found), ids[at]), ids[found]], 1))
        made = np.concatenate(links) if links else np.zeros((0, 2), np.int64)
        return pa.table({"a": made[:, 0].astype(np.int64), "b": made[:, 1].astype(np.int64)})

    return connect


def near_duplicates(docs: DataFrame, size: int = 2) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` (the text's hashes and the group) for every row.

    A document's set is its distinct shingles of ``size`` words; with fewer
    words the whole sequence is the one shingle. Documents are linked if 100
    times the common shingles are at least 80 times the union, confirmed on the
    whole sets. ``component_id`` is the smallest id reachable over links, the
    row's own included, and ``kept`` marks the row with that id.

    Null and empty texts, and texts of white space alone, have no shingles and
    are linked with nothing. Ids that are null never become a component's id
    unless it has no other; they are then kept. Repeated rows get equal
    results. Columns other than ``doc_id`` and ``text`` are ignored. An empty
    table gives an empty one.

    Scale: equal sets are one class, so copies cost one signature each. Keys
    of classes are exchanged in packed arrays. A key that over ``SMALL``
    classes share makes no pairs: its classes are joined to a family, and
    families are compared in blocks of ``BLOCK`` texts, each block with each,
    by a search that stops when all are connected. So no task holds more than
    two blocks, no candidate is left out, and no group's pairs are stored. The
    work of a family grows with the square of its blocks unless they connect.
    Intermediate tables go to the shared folder; joins shuffle them, so that
    the driver holds none of them.
    """
    spark = with_package(docs.sparkSession)
    parts = shuffle_partitions(spark)
    source = docs.select(
        "doc_id", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(7), "text").alias("h2")
    )
    id_type = dict(docs.dtypes)["doc_id"]
    signed = source.mapInArrow(
        _sign(size),
        f"doc_id {id_type}, h1 long, h2 long, n long, name binary, bands binary, sketch binary",
    )
    signed = stored(signed, "signed")
    classes = signed.where("n > 0").groupBy("name").agg(
        F.min("doc_id").alias("id"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "h1", "h2")).alias("sample"),
        F.first("n").alias("n"),
        F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch"),
    )
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")

    packed = classes.select("cid", "bands").mapInArrow(
        _emit(parts), "bucket int, keys binary, ids binary, many binary, links binary"
    )
    found = packed.groupBy("bucket").applyInArrow(_pair_up, "a long, b long, family boolean")
    found = stored(found, "candidates")

    side = classes.select("cid", "n", "sketch")
    pairs = found.where("NOT family").select("a", "b").distinct()
    for end in ("a", "b"):
        pairs = pairs.join(dealt(side.toDF(end, f"n_{end}", f"sketch_{end}")), end)
    pairs = stored(pairs.mapInArrow(_alike, "a long, b long"), "pairs")

    families = components(found.where("family").select("a", "b"))
    families = stored(families, "families")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("cid")).unionByName(families.select(F.col("node").alias("cid")))
    needed = needed.distinct().join(dealt(classes.select("cid", "sample.doc_id", "sample.h1", "sample.h2")), "cid")
    match = (
        source["doc_id"].eqNullSafe(needed["doc_id"])
        & (source["h1"] == needed["h1"])
        & (source["h2"] == needed["h2"])
    )
    texts = source.join(dealt(needed), match).select(needed["cid"], source["text"]).dropDuplicates(["cid"])
    texts = stored(texts, "texts")

    for end in ("a", "b"):
        pairs = pairs.join(dealt(texts.toDF(end, f"text_{end}")), end)
    links = pairs.mapInArrow(_verify(size), "a long, b long")

    sizes = families.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    members = families.join(dealt(sizes), "label")
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    members = members.select(
        F.col("node").alias("cid"),
        "label",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
    )
    groups = members.join(dealt(texts), "cid").groupBy("label", "low", "high")
    links = links.unionByName(groups.applyInArrow(_connect(size), "a long, b long"))

    labels = components(links)
    named = classes.select("cid", "id", "name").join(dealt(labels), F.col("cid") == F.col("node"))
    best = named.groupBy("label").agg(F.min("id").alias("component_id"))
    linked = named.join(dealt(best), "label").select("name", "component_id", "label")
    alone = classes.select("name", "id", "cid")
    chosen = alone.join(dealt(linked), "name", "left").select(
        "name", F.coalesce("component_id", "id").alias("component_id"), F.coalesce("label", "cid").alias("group")
    )
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    result = signed.join(dealt(chosen), "name", "left").withColumn("component_id", own)
    return result.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        "h1",
        "h2",
        "group",
    )


def keep_one(docs: DataFrame, size: int = 5) -> DataFrame:
    """One row of each group of near-duplicates, with the columns it had.

    The smallest id stays (null last), of several texts of that id the one of
    the smallest hashes. Rows equal in id and text are one row; texts without
    words are in no group and stay.
    """
    found = near_duplicates(docs, size)
    one = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "h1", "h2")).alias("one")
    best = found.where("group IS NOT NULL").groupBy("group").agg(one).select("one.doc_id", "one.h1", "one.h2")
    found = best.unionByName(found.where("group IS NULL").select("doc_id", "h1", "h2"))
    found = found.select(F.col("doc_id").alias("_id"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2")).distinct()
    rows, made = renamed(docs, "doc_id", "text")
    rows = rows.withColumns({"_t1": F.xxhash64("text"), "_t2": F.xxhash64(F.lit(7), "text")})
    match = rows["doc_id"].eqNullSafe(F.col("_id")) & (F.col("_t1") == F.col("_h1")) & (F.col("_t2") == F.col("_h2"))
    kept = rows.join(dealt(found), match, "left_semi").dropDuplicates(["doc_id", "_t1", "_t2"])
    return kept.select(*(F.col(inner).alias(name) for name, inner in made.items()))
