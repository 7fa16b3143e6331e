"""What a worker holds of a batch of texts is bound by portions, not by the batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from claimstrata.llm import decontaminate
from claimstrata.llm.texts import PORTION_BYTES, Names

ITEM = "one two three four five six seven eight nine ten"


def test_tables_of_names_are_as_long_as_a_portion():
    namer = Names(5)
    namer.sums(np.zeros(10, np.uint8))
    assert len(namer.powers) == len(namer.inverse) == PORTION_BYTES + 1


def test_a_text_longer_than_a_portion_has_names_everywhere():
    namer = Names(5)
    namer.sums(np.zeros(10, np.uint8))
    data = np.frombuffer(b"word " * (PORTION_BYTES // 2), np.uint8)
    starts = np.array([0, len(data) // 2 // 5 * 5, len(data) - 5])
    assert len(set(namer.words(data, starts, starts + 4).tolist())) == 1


def test_a_batch_is_matched_in_portions_of_half_a_megabyte():
    held = decontaminate.windows([ITEM], ["item"], 10)
    index = decontaminate.Index(held, np.ones(len(held.vocabulary), np.int64))
    filler = "x " * 50_000
    texts = [filler + ITEM, filler, None, ITEM.upper(), ""] * 5
    batch = pa.RecordBatch.from_arrays(
        [pa.array(texts), pa.nulls(25, pa.list_(pa.int64())), pa.nulls(25, pa.list_(pa.string()))],
        names=["text", "_hits", "_items"],
    )
    names = tuple(decontaminate.FIGURES)
    parts = list(decontaminate._matcher(index, ["text"], names, True)(iter([batch])))
    made = pa.Table.from_batches(parts)
    assert len(parts) > 1
    assert made.column("n_hit").to_pylist() == [10, 0, 0, 10, 0] * 5
    assert made.column("items").to_pylist() == [["item"], [], [], ["item"], []] * 5
