"""One document of each group of near-duplicates stays, whatever the ids."""

from claimstrata.llm import near_dup


def test_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(100))
    other = " ".join(f"v{i}" for i in range(100))
    rows = [(None, text), (None, text + " a"), (None, text + " b"), (7, other), (7, other + " a"), (7, other), (8, other + " b")]
    rows += [(9, ""), (9, None), (None, ""), (5, "alone here"), (None, "alone too"), (None, "alone too")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(row.doc_id, row.text) for row in near_dup.keep_one(docs).collect()]
    assert len(got) == len(set(got)) and set(got) <= set(rows)
    assert [i for i, t in got if t and t.startswith("w0")] == [None]
    assert [i for i, t in got if t and t.startswith("v0")] == [7]
    assert {x for x in got if not x[1] or "alone" in x[1]} == set(rows[7:])
