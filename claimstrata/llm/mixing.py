"""Mixing sources to target weights by proportionate fair scheduling, in DataFrame functions."""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimstrata.llm.frames import renamed, stored

RESOLUTION = 1000
TEMPERATURE = 0.5
MAX_LANES = 1000
BLOCK_ROWS = 16
_BUCKET_DIGITS = 3  # of the hexadecimal order key: 4,096 buckets per lane


_FINE = 1024  # whole-number weights are in parts of so many
_STEP = "struct<p:bigint,c:bigint,ahead:boolean>"


def _sizes(docs: DataFrame, temperature: float) -> DataFrame:
    """``source, _rows, _weight`` of every source; the weight is a whole number, exact in sums."""
    sizes = docs.groupBy("source").agg(F.count(F.lit(1)).alias("_rows"))
    weight = F.greatest(F.lit(1), F.round(F.pow(F.col("_rows"), F.lit(temperature)) * _FINE)).cast("long")
    return sizes.withColumn("_weight", weight)


def tempered_shares(
    docs: DataFrame,
    resolution: int = RESOLUTION,
    temperature: float = TEMPERATURE,
    max_lanes: int = MAX_LANES,
) -> DataFrame:
    """``source, share``: whole-number weights near ``resolution`` in all.

    A source weighs its rows to the power ``temperature``, over all rows. Of
    the ``max_lanes`` largest sources (ties by name) those are listed whose
    share of all sources rounds to a unit or more, so the table is bounded and
    no share is lifted; null is a source of its own.
    """
    return _listed(_sizes(docs, temperature), resolution, temperature, max_lanes)


def _listed(sizes: DataFrame, resolution: int, temperature: float, max_lanes: int) -> DataFrame:
    whole = sizes.agg(F.sum("_weight")).first()[0] or 1
    top = sizes.orderBy(F.desc("_rows"), F.asc_nulls_first("source")).limit(max_lanes)
    top = top.where(2 * resolution * F.col("_weight") >= whole)
    weight = F.pow(F.col("_rows"), F.lit(temperature))
    total = F.sum(weight).over(Window.partitionBy(F.lit(1)))
    share = F.greatest(F.lit(1), F.round(weight / total * resolution)).cast("long")
    return top.select("source", share.alias("share"))


def _ways(weights: Mapping[int, int]) -> dict[int, list[tuple[int, int, bool]]]:
    """For each item the steps from it to the root of a Huffman tree: parent's weight, own weight, side."""
    ways: dict[int, list[tuple[int, int, bool]]] = {item: [] for item in weights}
    heap = [(weight, item, [item]) for item, weight in weights.items()]
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        for ahead, (weight, _, items) in ((True, a), (False, b)):
            for item in items:
                ways[item].append((a[0] + b[0], weight, ahead))
        heapq.heappush(heap, (a[0] + b[0], min(a[1], b[1]), a[2] + b[2]))
    return ways


def _array(way: list[tuple[int, int, bool]]) -> Column:
    steps = [F.struct(F.lit(p).alias("p"), F.lit(c).alias("c"), F.lit(ahead).alias("ahead")) for p, c, ahead in way]
    return F.array(*steps).cast(f"array<{_STEP}>")


def _paths(rest: DataFrame, ways: Mapping[int, list[tuple[int, int, bool]]]) -> DataFrame:
    """``_own, _path``: for each source not listed the steps from its blocks to the slots.

    Sources of one class, whose rows differ by less than a factor of two, are
    the leaves of a binary tree in the order of a hash; the classes, at most
    63, are those of a Huffman tree. A node's weight is the sum of its sources'.
    """
    key = F.md5(F.coalesce(F.col("source").cast("string"), F.lit("")))
    rest = rest.withColumns({"_key": key, "_slice": F.substring(key, 1, _BUCKET_DIGITS)})
    counts = rest.groupBy("_class", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_class").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(
        "_class",
        "_slice",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"),
        F.sum("_n").over(Window.partitionBy("_class")).alias("_all"),
    )
    inside = Window.partitionBy("_class", "_slice").orderBy("_key", F.asc_nulls_first("source"))
    leaves = rest.withColumn("_rank", F.row_number().over(inside)).join(first, ["_class", "_slice"])
    leaves = leaves.withColumn("_rank", F.col("_first") + F.col("_rank") - 1)
    # Levels up to the one with a single node, which bears the class.
    top = F.length(F.bin(F.col("_all") - 1))
    leaves = leaves.select(
        F.col("source").alias("_own"), "_class", "_rank", "_weight", F.explode(F.sequence(F.lit(0), top)).alias("_level")
    )
    leaves = leaves.withColumn("_node", F.expr("shiftright(_rank, _level)"))
    nodes = leaves.groupBy("_class", "_level", "_node").agg(F.sum("_weight").alias("_sum"))
    borne = leaves.join(nodes, ["_class", "_level", "_node"])
    step = F.struct("_level", F.col("_sum").alias("c"), (F.col("_node") % 2 == 0).alias("ahead"))
    found = borne.groupBy("_own", "_class").agg(F.sort_array(F.collect_list(step)).alias("_up"))
    up = "transform(slice(_up, 1, size(_up) - 1), (s, i) -> named_struct('p', _up[i + 1].c, 'c', s.c, 'ahead', s.ahead))"
    up = F.filter(F.expr(up).cast(f"array<{_STEP}>"), lambda s: s["p"] > s["c"])
    above = F.lit(None).cast(f"array<{_STEP}>")
    for item, way in ways.items():
        above = F.when(F.col("_class") == item, _array(way)).otherwise(above)
    return found.select("_own", F.concat(up, above).alias("_path"))


# A node's turns are dealt to its two sides by their exact weights: of the first t the side
# behind has ceil(t * c / p) and the one ahead floor(t * c / p), so no two meet in a slot.
_CLIMB = """aggregate(_path, _at, (k, s) -> IF(
    s.ahead,
    (cast(k + 1 AS decimal(20, 0)) * cast(s.p AS decimal(17, 0)) - 1) div cast(s.c AS decimal(17, 0)),
    (cast(k AS decimal(20, 0)) * cast(s.p AS decimal(17, 0))) div cast(s.c AS decimal(17, 0))
))"""


def _schedule(shares: DataFrame) -> DataFrame:
    """``lane, turn, slot`` of one period, earliest deadline first.

    The period has as many slots as the shares add up to. Block ``j`` of a lane
    with share ``a`` is released at slot ``floor(j * period / a)`` and due by
    ``ceil((j + 1) * period / a)``; of the released blocks the one due first
    (then the lane that comes first) takes the slot. Both lists are bounded by
    the resolution and the number of lanes, so one row holds them.
    """
    lanes = shares.agg(F.array_sort(F.collect_list(F.struct("lane", "share"))).alias("lanes"))
    period = F.aggregate("lanes", F.lit(0).cast("long"), lambda total, x: total + x["share"])
    lanes = lanes.select("lanes", period.alias("period")).where("period > 0")

    def due(x: Column, used: Column) -> Column:
        return F.ceil((used + 1) * F.col("period") / x["share"])

    def step(state: Column, slot: Column) -> Column:
        def claim(x: Column, i: Column) -> Column:
            used = F.get(state["used"], i)
            ready = (used < x["share"]) & (F.floor(used * F.col("period") / x["share"]) <= slot)
            return F.when(ready, F.struct(due(x, used).alias("due"), i.alias("at")))

        at = F.array_min(F.transform("lanes", claim))["at"]
        return F.struct(
            F.transform(state["used"], lambda n, i: F.when(i == at, n + 1).otherwise(n)).alias("used"),
            F.concat(state["order"], F.array(at)).alias("order"),
        )

    start = F.struct(
        F.transform("lanes", lambda x: F.lit(0).cast("long")).alias("used"),
        F.array().cast("array<int>").alias("order"),
    )
    order = F.aggregate(F.sequence(F.lit(0).cast("long"), F.col("period") - 1), start, step)["order"]
    slots = lanes.select("lanes", "period", F.posexplode(order).alias("slot", "at"))
    rows = slots.select(F.get("lanes", F.col("at"))["lane"].alias("lane"), F.get("lanes", F.col("at"))["share"].alias("share"), "period", "slot")
    turn = F.row_number().over(Window.partitionBy("lane").orderBy("slot")) - 1
    return rows.withColumn("turn", turn)


def interleave(
    docs: DataFrame,
    weights: Mapping[str | None, int] | None = None,
    block_rows: int = BLOCK_ROWS,
    resolution: int = RESOLUTION,
    temperature: float = TEMPERATURE,
    max_lanes: int = MAX_LANES,
) -> DataFrame:
    """Every row with its ``block``, ``slot`` and ``place``: sort by slot and place to read the mix.

    Each source's rows, in the order of the MD5 of their id, form blocks of
    ``block_rows``. Source weights are whole numbers, given or from
    ``tempered_shares``; their sum is the period. Blocks get release times and
    deadlines from the weight, and earliest deadline first deals the slots of
    one period; the schedule repeats with the period, so block ``j`` of a
    source with share ``a`` stands in period ``j div a``. In every first ``t``
    slots a source with weight ``w`` of the period holds more than ``w t - 1``
    and less than ``w t + 1`` blocks, as long as it has blocks. A source that
    ends leaves its later slots empty; the others keep their proportions.

    Sources whose share of all rounds to no unit, or beyond the ``max_lanes``
    largest, are dealt by a tree with their exact weights: each node's turns go
    to its two sides in closed form. The listed sources together are one
    of its leaves; they then hold less than two blocks more or less than their
    part of the slots, and every other source less than six (a step
    of the tree adds less than one block of its node, and nodes grow).

    Rows are whole: none is dropped, sampled or repeated. A null source is a
    source. Sources that given weights do not name share one lane of share 1.
    A row without id orders by an empty text; rows that tie in everything but
    other columns take their order from those. Columns named ``block``,
    ``slot`` or ``place`` are replaced. An empty table gives an empty one.

    The rank of a row in its source comes from counts per slice of the order
    key and a row number inside the slice, so the largest source is spread
    over thousands of groups. One period's schedule, bounded by
    ``resolution + max_lanes`` rows, is broadcast. The tree is made by
    groupings, one row for each source and level; only the weights of
    at most 63 classes of sources come to the driver.
    """
    spark = docs.sparkSession
    docs = docs.drop("block", "slot", "place")
    docs, made = renamed(docs, "doc_id", "source")
    if weights is None:
        sizes = stored(_sizes(docs, temperature), "sizes")
        shares = stored(_listed(sizes, resolution, temperature, max_lanes), "shares")
        apart = sizes["source"].eqNullSafe(F.col("_source"))
        rest = sizes.join(F.broadcast(shares.select(F.col("source").alias("_source"))), apart, "left_anti")
        rest = rest.withColumn("_class", F.length(F.bin("_rows")))
        classes = {r["_class"]: r["_w"] for r in rest.groupBy("_class").agg(F.sum("_weight").alias("_w")).collect()}
    else:
        classes = {}
        # The period is the sum of the weights, so a common factor goes.
        common = math.gcd(*(int(v) for v in weights.values())) or 1
        given = [(k, int(v) // common) for k, v in weights.items()]
        shares = spark.createDataFrame(given, "source string, share long")
    lane = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.asc_nulls_first("source")))
    shares = shares.withColumn("lane", lane)

    named = F.broadcast(shares.select(F.col("source").alias("_source"), F.col("lane").alias("_lane")))
    rows = docs.join(named, docs["source"].eqNullSafe(F.col("_source")), "left").drop("_source")
    rows = rows.withColumn("_lane", F.coalesce("_lane", F.lit(0)))
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = rows.withColumn("_key", key).withColumn("_slice", F.substring("_key", 1, _BUCKET_DIGITS))
    mine = ["_lane"]
    if classes:
        rows = rows.withColumn("_own", F.when(F.col("_lane") == 0, F.col("source")))
        mine = ["_lane", "_own"]

    narrow = docs.join(named, docs["source"].eqNullSafe(F.col("_source")), "left")
    narrow = narrow.select(
        F.coalesce("_lane", F.lit(0)).alias("_lane"),
        F.when(F.col("_lane").isNull(), F.col("source")).alias("_own"),
        F.substring(key, 1, _BUCKET_DIGITS).alias("_slice"),
    )
    counts = narrow.groupBy(*mine, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*mine).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(*mine, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))

    scheduled = shares.select("share", "lane")
    if weights is not None:
        unnamed = counts.where("_lane = 0").limit(1)
        unnamed = unnamed.select(F.lit(1).cast("long").alias("share"), F.lit(0).alias("lane"))
        scheduled = scheduled.unionByName(unnamed)
    period = _schedule(scheduled)
    period = period.select(
        F.col("lane").alias("_lane"), F.col("share").alias("_share"), F.col("period").alias("_period"), F.col("slot").alias("_slot"), F.col("turn").alias("_turn")
    )

    ties = [F.col(name) for name in docs.columns if name not in ("doc_id", "source") and _orders(docs, name)]
    inside = Window.partitionBy(*mine, "_slice").orderBy("_key", F.col("doc_id"), *ties)
    ranked = rows.withColumn("_rank", F.row_number().over(inside))
    first = first.toDF(*(f"{name}_1" for name in first.columns[:-1]), "_first")
    same = [ranked[name].eqNullSafe(first[f"{name}_1"]) for name in (*mine, "_slice")]
    ranked = ranked.join(first, same).drop(*first.columns[:-1])
    ranked = ranked.withColumn("_rank", F.col("_first") + F.col("_rank") - 1)
    ranked = ranked.withColumn("block", F.floor(F.col("_rank") / block_rows).cast("long"))
    how = "left" if classes else "inner"
    shared = F.broadcast(period.select("_lane", "_share", "_period").distinct())
    ranked = ranked.join(shared, "_lane", how).withColumn("_turn", (F.col("block") % F.col("_share")).cast("int"))
    ranked = ranked.join(F.broadcast(period.select("_lane", "_turn", "_slot")), ["_lane", "_turn"], how)
    slot = (F.floor(F.col("block") / F.col("_share")) * F.col("_period") + F.col("_slot")).cast("long")
    if classes:
        listed = sizes.agg(F.sum("_weight")).first()[0] - sum(classes.values())
        # Classes count from 1; the listed sources, if any, are the leaf 0.
        ways = _ways(classes | ({0: listed} if listed else {}))
        paths = _paths(rest, {item: way for item, way in ways.items() if item}).withColumn("_none", F.lit(0))
        own = (F.col("_lane") == F.col("_none")) & ranked["_own"].eqNullSafe(paths["_own"])
        ranked = ranked.join(paths, own, "left")
        ranked = ranked.withColumns(
            {"_path": F.coalesce("_path", _array(ways.get(0, []))), "_at": F.coalesce(slot, "block")}
        )
        slot = F.expr(_CLIMB)
    return ranked.select(
        *(F.col(inner).alias(name) for name, inner in made.items()),
        "block",
        slot.alias("slot"),
        (F.col("_rank") % block_rows).cast("int").alias("place"),
    )


def _orders(docs: DataFrame, name: str) -> bool:
    """Whether rows can be sorted by the column; maps cannot."""
    return "map<" not in dict(docs.dtypes)[name] and "variant" not in dict(docs.dtypes)[name]
