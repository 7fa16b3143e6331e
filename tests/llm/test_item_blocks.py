"""Repeated rows of a benchmark do not fill a block."""

from claimstrata.llm import decontaminate


def test_repeated_items_count_once(spark):
    rows = [(1, "the same passage again")] * 300 + [(i, f"passage number {i}") for i in range(2, 30)]
    items = spark.createDataFrame(rows, "item_id long, text string")
    blocks = [[tuple(row) for row in block.collect()] for block in decontaminate._load(items, 400)]
    held = [row for block in blocks for row in block]
    assert sorted(held) == sorted({(str(i), text) for i, text in rows})
    assert 1 < len(blocks) < 10
