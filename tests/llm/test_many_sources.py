"""More sources than lanes, and sources far below a unit, keep their own weight in the mix."""

import math
from collections import defaultdict

import pytest

from claimstrata.llm import mixing


def blocks(spark, sizes, **options):
    """Slots of each source's blocks, after checking that rows are whole and blocks in order."""
    rows = [(i, source) for i, source in enumerate(s for s, n in sizes.items() for _ in range(n))]
    docs = spark.createDataFrame(rows, "doc_id long, source string").repartition(3)
    got = mixing.interleave(docs, **options).collect()
    assert sorted((row.doc_id, row.source) for row in got) == rows
    slots = defaultdict(dict)
    for row in got:
        assert slots[row.source].setdefault(row.block, row.slot) == row.slot
    taken = [slot for held in slots.values() for slot in held.values()]
    assert len(set(taken)) == len(taken)
    for held in slots.values():
        assert sorted(held) == list(range(len(held)))
        assert sorted(held.values()) == [held[i] for i in range(len(held))]
    return {source: [held[i] for i in range(len(held))] for source, held in slots.items()}


def farthest(slots, sizes, temperature=0.5, shares=None):
    """The most blocks by which a source, as long as it has blocks, is off its part of the slots.

    The part is exact, but for sources in ``shares``: these split their sum as the whole numbers say.
    """
    weight = {s: n**temperature for s, n in sizes.items()}
    shares = shares or {}
    listed = sum(weight[s] for s in shares)
    for source, share in shares.items():
        weight[source] = listed * share / sum(shares.values())
    worst = 0
    for source, held in slots.items():
        part = weight[source] / sum(weight.values())
        worst = max([worst, *(abs(j - t * part) for j, t in enumerate(held)), *(abs(j + 1 - (t + 1) * part) for j, t in enumerate(held))])
    return worst


def test_more_sources_than_lanes(spark):
    sizes = {None: 3} | {f"host{i}": 3 for i in range(2_999)}
    slots = blocks(spark, sizes, block_rows=1)
    assert farthest(slots, sizes) < 3
    assert max(max(held) for held in slots.values()) < 3 * 3_000


@pytest.mark.parametrize("lanes", [1, 5, 1000])
def test_sources_of_all_sizes(spark, lanes):
    sizes = {f"s{i}": 1 + 4_000 // (i + 1) ** 2 for i in range(120)}
    slots = blocks(spark, sizes, block_rows=1, max_lanes=lanes, resolution=50)
    docs = spark.createDataFrame([(s,) for s, n in sizes.items() for _ in range(n)], "source string")
    shares = {r.source: r.share for r in mixing.tempered_shares(docs, 50, max_lanes=lanes).collect()}
    assert 0 < len(shares) < len(sizes)
    assert farthest(slots, sizes, shares=shares) < 6
    held = {s: slots[s] for s in shares}
    assert farthest(held, sizes, shares=shares) < 2


def test_a_tiny_source_is_not_lifted(spark):
    sizes = {"large": 3_000, "small": 5}
    slots = blocks(spark, sizes, block_rows=1, temperature=1.0, resolution=100)
    assert farthest(slots, sizes, 1.0) < 2


def test_tree_of_classes_has_every_weight():
    ways = mixing._ways({3: 7, 1: 2, 2: 2, 0: 40})
    assert {item: way[0][1] for item, way in ways.items()} == {3: 7, 1: 2, 2: 2, 0: 40}
    assert all(way[-1][0] == 51 and math.prod(c <= p for p, c, _ in way) for way in ways.values())
