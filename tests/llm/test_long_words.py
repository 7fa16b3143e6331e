"""Long words of a kind that weighted sums modulo a power of two do not tell apart."""

import brute
import pytest

from claimstrata.llm import decontaminate, near_dup


def words_of(size):
    """A sequence of two letters by the parity of bits, and the same with the letters changed."""
    parity = [i.bit_count() & 1 for i in range(size)]
    return tuple("".join(letters[x] for x in parity) for letters in ("ab", "ba"))


@pytest.mark.parametrize("size", [128, 512, 1024, 4096])
def test_documents_of_such_words_are_not_linked(spark, size):
    texts = [*words_of(size), "x y z"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs, size=2).collect()}
    assert got == {0: 0, 1: 1, 2: 2}


@pytest.mark.parametrize("size", [128, 512, 1024, 4096])
def test_such_words_hit_only_their_item(spark, size):
    one, two = words_of(size)
    texts = [one, two, one.upper()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(1, one)], "item_id long, text string")
    got = decontaminate.decontaminate(docs, items).orderBy("doc_id").collect()
    want = brute.decontaminate(texts, [(1, one)])
    assert [(r.n_words, r.n_hit, r.n_items) for r in got] == [w[:3] for w in want]
    assert [r.n_hit for r in got] == [1, 0, 1]
