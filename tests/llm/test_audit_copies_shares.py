"""Source divergence, conversation repair and exact copies: SQL, brute force and odd rows."""

import random
from functools import lru_cache

import brute
import duckdb
import numpy as np
import pytest
from compare import assert_same, connect
from pyspark.sql import functions as F

from claimstrata.llm import divergence, exact_dedup, oracles, turn_repair
from claimstrata.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
NAMES = "id, digest, sha, place, key, spread, hot, cold, group, n, text0, size_class, head_class, length, prefix"
CLASHES = [*NAMES.split(", "), "keep_id", "kept", "group_size", "text_sha256", "term", "p", "q", "value", "rank"]
CLASHES += ["conv", "copy", "stays", "head", "repeat", "initial", "audit", "cost", "gaps", "turns"]


def with_clashes(df):
    return df.withColumns({name: F.lit("mine") for name in CLASHES})


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_matches_sql(spark, name):
    con = connect(SF_DIR)
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    types = {"boolean": "BOOLEAN"}
    import compare

    compare.TYPES |= types
    assert assert_same(df, con, oracles.ORACLES[name]) > 0


# Exact copies.

COPIES = [
    (1, "one"),
    (5, "one"),
    (5, "one"),
    (None, "one"),
    (2, None),
    (3, ""),
    (None, "lonely"),
    (None, "pair"),
    (None, "pair"),
    (7, "é" * 200_000),
    (8, "é" * 200_000),
    (9, "é" * 199_999 + "ê"),
    (10, "é" * 300 + "a"),
    (11, "é" * 300 + "b"),
]
COPY_SCHEMA = "doc_id long, text string"


def wanted_copies(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for ids in groups.values():
        known = [x for x in ids if x is not None]
        keep = max(known, default=None)
        kept = [False] * len(ids)
        kept[ids.index(keep)] = True
        out += [(i, keep, len(ids), k) for i, k in zip(ids, kept)]
    return sorted(map(repr, out))


@pytest.mark.parametrize("classes", [1, 3, exact_dedup.CLASSES])
def test_copies_of_odd_rows(spark, classes):
    docs = with_clashes(spark.createDataFrame(COPIES, COPY_SCHEMA)).repartition(3)
    found = exact_dedup.copies(docs, classes=classes)
    assert sorted(repr(tuple(row)) for row in found.collect()) == wanted_copies(COPIES)
    left = exact_dedup.drop_copies(docs, classes)
    assert left.columns == docs.columns
    rows = [(row.doc_id, (row.text or "")[:9], row.kept) for row in left.collect()]
    assert sorted(map(repr, rows)) == sorted(
        repr((i, (t or "")[:9], "mine"))
        for i, t in [(5, "one"), (3, ""), (None, "lonely"), (None, "pair"), *COPIES[10:]]
    )


def test_copies_in_a_hot_group_and_an_empty_table(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"text {i // 2}") for i in range(3000)]
    docs = spark.createDataFrame(rows, COPY_SCHEMA).repartition(8)
    found = exact_dedup.copies(docs, with_digest=True)
    assert sorted(repr(tuple(row)[:4]) for row in found.collect()) == wanted_copies(rows)
    assert exact_dedup.copies(docs.where("false")).count() == 0
    assert exact_dedup.drop_copies(docs.where("false")).count() == 0


def test_copies_run_without_python(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = exact_dedup.copies(docs, True)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# Source divergence.


def wanted_divergence(rows, least, most):
    import re
    from collections import Counter

    counts, docs, groups = {}, {}, {}
    for lang, source, text in rows:
        lang, source, text = lang or "", source or "", text or ""
        found = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text.translate(brute.LOWER))
        groups.setdefault(lang, set()).add(source)
        counts.setdefault((lang, source), Counter()).update(found)
        docs.setdefault(lang, Counter()).update(set(found))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        whole = Counter()
        for source in sources:
            whole.update(counts[lang, source])

        def shares(count):
            under = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 5) // under for t in kept}

        q, p = shares(whole), {s: shares(counts[lang, s]) for s in sources}
        for source in sources:
            pairs = [(-sum(abs(p[source][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != source]
            terms = [
                (q[t] - p[source][t], t.encode(), t) for t in kept if counts[lang, source][t] and p[source][t] > q[t]
            ]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:most])):
                out += [(lang, source, part, t, -value, i + 1) for i, (value, _, t) in enumerate(found)]
    return sorted(out)


def divergence_rows(sources):
    pick = random.Random(7)
    words = ["Ärger", "tie", "TIE", "x", "naïve", "b-c", "d2e"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [("en", f"s{pick.randrange(sources)}", " ".join(pick.choices(words, k=30))) for _ in range(200)]
    rows += [(None, None, None), (None, "a", "rare"), ("xx", "a", ""), ("xx", "b", None), ("xx", "c", "12 34")]
    return rows + [("en", "long", "word, " * 400_000), ("en", "wide", " ".join(f"a{'b' * i}" for i in range(900)))]


@pytest.mark.parametrize(("sources", "block", "least"), [(4, 512, 30), (40, 5, 3), (70, 3, 1)])
def test_divergence_of_odd_rows(spark, monkeypatch, sources, block, least):
    monkeypatch.setattr(divergence, "TERM_BLOCK", block)
    rows = divergence_rows(sources)
    docs = with_clashes(spark.createDataFrame(rows, "lang string, source string, text string")).repartition(4)
    found = divergence.divergence(docs, least, 5)
    assert sorted(map(tuple, found.collect())) == wanted_divergence(rows, least, 5)
    assert divergence.divergence(docs.where("false")).count() == 0


def test_tasks_hand_on_counts(spark, monkeypatch):
    rows = divergence_rows(3)
    partial = divergence._Partial()
    monkeypatch.setattr(divergence, "CHUNK_BYTES", 8)
    for lang, source, text in rows:
        partial.add((lang or "", source or ""), (text or "").encode())
    total = sum(sum(batch.column("n").to_pylist()) for batch in partial.rows())
    assert total == sum(len(divergence_words(text)) for _, _, text in rows) and partial.held == 0


def divergence_words(text):
    import re

    return re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")


def test_joint_tables_are_products():
    random_ = np.random.default_rng(3)
    counts = random_.integers(0, 6, (50, 7))
    shares = np.cumsum(random_.integers(1, 9, 7))[None, :] * 100 + counts * 10**8
    made, prices, starts = divergence._one_hot(counts, shares)
    distance = divergence._priced((made, prices, starts), (made, prices, starts))
    assert (distance == np.abs(shares[:, :, None] - shares[:, None, :]).sum(0)).all()


# Conversation repair.

TURNS = [
    (1, 0, "system", "Be kind."),
    (1, 1, "user", "Hi?"),
    (1, 2, "assistant", "Hello!"),
    (2, 0, "assistant", "No question"),
    (2, 5, "user", ""),
    (2, 5, "tool", "odd."),
    (2, None, None, None),
    (2, 9, "user", "Yes."),
    (2, 10, "user", "Yes."),
    (None, 1, "user", "Who?"),
    (None, 2, "user", "Who?"),
    (3, None, "", "."),
    (3, None, "", "."),
    (4, 0, "user", "x" * 300_000 + ". \t"),
    (4, 1, "assistant", "y\x0b"),
]
TURN_SCHEMA = "conv_id long, turn long, role string, text string"


def wanted_repairs(rows, turns):
    return sorted(
        repr((conv, *brute.repaired([row[1:] for row in turns if row[0] == conv]))) for conv in {r[0] for r in rows}
    )


def test_repair_of_whole_table(spark):
    rows = duckdb.connect().execute(f"SELECT * FROM '{SF_DIR}/conversations.parquet'").fetchall()
    got = QUERIES["op12_turn_repair"](spark, SF_DIR)
    assert sorted(repr(tuple(row)) for row in got.collect()) == wanted_repairs(rows, brute.damaged(rows))
    assert {name for name, _ in got.dtypes} >= {"conv_id", "repaired_sha256"}


def test_repair_of_odd_rows(spark):
    table = with_clashes(spark.createDataFrame(TURNS, TURN_SCHEMA)).repartition(3)
    for rows, turns in (
        (turn_repair.damaged(table), brute.damaged(TURNS)),
        (turn_repair.as_given(table), [(c, t, *(" " if x is None else x for x in y)) for c, t, *y in TURNS]),
    ):
        got = turn_repair.repair(rows)
        assert sorted(repr(tuple(row)) for row in got.collect()) == wanted_repairs(TURNS, turns)
    assert turn_repair.repair(turn_repair.damaged(table.where("false"))).count() == 0
    assert turn_repair.repaired_turns(turn_repair.damaged(table.where("false"))).count() == 0


def test_a_conversation_of_which_nothing_stays(spark):
    lost = next(i for i in range(1000) if not brute.damaged([(i, 0, "user", "x")]))
    rows = turn_repair.damaged(spark.createDataFrame([(lost, 0, "user", "x")], TURN_SCHEMA))
    import hashlib

    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(row) for row in turn_repair.repair(rows).collect()] == [(lost, 0, 0, 0, 0, 0, 0, "", empty)]


def test_turns_are_well_formed_and_give_the_digest(spark):
    import hashlib
    import re

    rows = turn_repair.damaged(spark.read.parquet(f"{SF_DIR}/conversations.parquet"))
    digests = {row.conv: row.repaired_sha256 for row in turn_repair.repair(rows).collect()}
    made = {}
    for row in sorted(turn_repair.repaired_turns(rows).collect()):
        made.setdefault(row.conv, []).append(row)
    for conv, digest in digests.items():
        turns = made.get(conv, [])
        assert [t.place for t in turns] == list(range(len(turns)))
        assert re.fullmatch("(s?(ua)+)?", "".join(t.role[0] for t in turns))
        assert hashlib.sha256("\n".join(f"{t.role}:{t.text}" for t in turns).encode()).hexdigest() == digest


def least_edits(rows):
    """Cost and edits from the end on: the rest of a string is least whatever stands before it."""
    keep = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    @lru_cache(None)
    def rest(i, state, inserted):
        found = [(0, "")] if i == len(rows) and state in (0, 3) else []
        following = 3 if state == 2 else 2

        def add(cost, initial, then):
            if then:
                found.append((cost + then[0], initial + then[1]))

        if inserted < 3:
            add(5, "I", rest(i, following, inserted + 1))
        if i < len(rows):
            initial, must_go, truncated = rows[i]
            add(2, "D", rest(i + 1, state, 0))
            if not must_go:
                add(1 + 5 * truncated, "R", rest(i + 1, following, 0))
                if (state, initial) in keep:
                    add(5 * truncated, "K", rest(i + 1, keep[state, initial], 0))
        return min(found, default=None)

    return rest(0, 0, 0)


@pytest.mark.parametrize("modulus", [turn_repair.MODULUS, 3])
def test_edits_are_the_least_even_when_hashes_collide(monkeypatch, modulus):
    monkeypatch.setattr(turn_repair, "MODULUS", modulus)
    monkeypatch.setattr(turn_repair, "SETTLE", 5)
    pick = random.Random(11)
    for _ in range(1500):
        rows = [(pick.choice("suaax"), pick.random() < 0.15, pick.random() < 0.3) for _ in range(pick.randrange(14))]
        audit = turn_repair.Audit()
        for row in rows:
            audit.row(*row)
        assert audit.result() == least_edits(tuple(rows))


def test_a_long_conversation_holds_few_nodes():
    pick, audit = random.Random(5), turn_repair.Audit()
    for i in range(60_000):
        audit.row(pick.choice("uuaa"), pick.random() < 0.05, pick.random() < 0.05)
    assert max(held[1].depth for held in audit.states if held) < 2 * turn_repair.SETTLE
    assert len(audit.result()[1]) >= 60_000
