"""Lines of few words take part in line deduplication like all others."""

import random
from collections import Counter, defaultdict

import brute
import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from claimstrata.llm import line_dedup
from claimstrata.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def removed(docs):
    """``id, line, length`` of lines that go, with every line that has a word."""
    lines = [
        (doc_id, i, frozenset(brute.words(line)), len(line))
        for doc_id, text in sorted(docs)
        for i, line in enumerate(text.split("\n"))
    ]
    places, first, cut = defaultdict(list), {}, {}
    for doc_id, i, tokens, _ in lines:
        first.setdefault(tokens, (doc_id, i))
    for tokens in first:
        for token in tokens:
            places[token].append(tokens)
    for tokens in first:
        near = Counter(x for token in tokens for x in places[token])
        alike = [x for x, n in near.items() if 9 * n >= 4 * (len(tokens) + len(x))]
        cut[tokens] = min((first[x] for x in alike), default=None)
    return {(doc_id, i, n) for doc_id, i, tokens, n in lines if tokens and (doc_id, i) > cut[tokens]}


def lines_of(docs, spark, buckets):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = line_dedup.line_figures(frame, buckets).collect()
    return {(row.doc_id, i) for row in found for i in row.removed}


def test_copies_and_near_copies_of_short_lines(spark):
    docs = [
        (1, "All rights reserved.\n\n \t\none\na b c d e\nx y z"),
        (2, "All rights reserved.\n\n \t\n one one\na b c d\nz y  x\nx y"),
        (3, "reserved. rights All\nf g h i\nf g h i j\nf g h i k l\nf g h k"),
    ]
    got = lines_of(docs, spark, line_dedup.RARITY_BUCKETS)
    assert got == {x[:2] for x in removed(docs)} == {(2, 0), (2, 3), (2, 4), (2, 5), (3, 0), (3, 2)}


@pytest.mark.parametrize("buckets", [1, 7, line_dedup.RARITY_BUCKETS])
def test_short_lines_against_brute_force(spark, buckets):
    # With one bucket all words are frequent and meet in pairs.
    dice = random.Random(buckets)
    words = [f"w{i}" for i in range(14)]
    docs = [
        (i, "\n".join(" ".join(dice.sample(words, dice.randint(0, 7))) for _ in range(6))) for i in range(60)
    ]
    assert lines_of(docs, spark, buckets) == {x[:2] for x in removed(docs)}


def test_query_against_brute_force(spark):
    docs = duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'").fetchall()
    number, chars = Counter(), Counter()
    for doc_id, _, n in removed(docs):
        number[doc_id] += 1
        chars[doc_id] += n
    got = {row.doc_id: (row.n_removed, row.chars_removed) for row in QUERIES["op6_line_dedup"](spark, SF_DIR).collect()}
    assert got == {doc_id: (number[doc_id], chars[doc_id]) for doc_id, _ in docs}


def test_documents_left_without_words_go(spark):
    line = "all of these words are here"
    docs = [(1, line), (2, line), (3, f"{line}\n \n"), (4, f"{line}\nand more"), (5, ""), (6, None), (7, " \n"), (None, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {(row.doc_id, row.text) for row in corpus_pipeline.lines(spark, frame, "").collect()}
    assert got == {(1, line), (4, "and more"), (5, ""), (6, None), (7, " \n"), (None, None)}


@pytest.mark.parametrize("held", [1, 40])
def test_long_keys_are_let_go_but_for_their_leaders(spark, monkeypatch, held):
    dice = random.Random(held)
    words = [f"w{i}" for i in range(9)]
    docs = [(i, "\n".join(" ".join(dice.sample(words, dice.randint(3, 9))) for _ in range(5))) for i in range(50)]
    rows = []
    column = pa.array([text for _, text in docs])
    lines = line_dedup.lines_of(column, np.full(1, 12, np.uint8))
    owner, key, at = line_dedup.line_keys(lines)
    figures = [x.view(np.int64).tolist() for x in (lines.kind, lines.low, lines.high)]
    for i, k, p in zip(owner.tolist(), key.view(np.int64).tolist(), at.tolist()):
        rows.append((k, i << 25 | p, *(x[i] for x in figures)))
    rows.sort()
    names = ("key", "spot", "kind", "low", "high")
    table = pa.table({name: [row[j] for row in rows] for j, name in enumerate(names)})

    def found(size):
        monkeypatch.setattr(line_dedup, "_HELD_ROWS", size)
        out = pa.Table.from_batches(line_dedup._leaders(table.to_batches(max_chunksize=7)))
        rows = [(x["kind"], x["low"], x["high"], x["o_kind"]) for x in out.to_pylist()]
        bare = {x[:3] for x in rows if x[3] is None}
        return {x[:3] for x in rows} - bare, bare

    whole, none = found(1 << 17)
    some, bare = found(held)
    # What met an earlier line meets one still, or is sent on to meet them elsewhere.
    assert not none and whole and whole <= some | bare and some <= whole
