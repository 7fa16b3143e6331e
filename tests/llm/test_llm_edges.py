"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import settings as examples
from hypothesis import strategies as st

import corpus_pipeline
from claimstrata.llm import (
    decontaminate,
    line_dedup,
    mixing,
    near_dup,
    parse_dedup,
    preference,
    repetition,
    token_counts,
    toxicity,
    url_rules,
)
from claimstrata.llm.queries import VOCABULARY

WORDS = [f"wörd{i}" for i in range(400)]
PASSAGE = " ".join(WORDS[:60])
LONG = " ".join(f"{w}{i}" for i in range(150) for w in WORDS)
ITEM = " ".join(WORDS[5:20])
ROWS = [
    (1, PASSAGE, "en", "a", 1),
    (2, PASSAGE + " end", "en", "a", 1),
    (2, PASSAGE + " end", "en", "a", 1),
    (3, None, None, None, None),
    (4, "", "en", None, 0),
    (None, PASSAGE + " tail", "en", "b", 9),
    (None, None, "en", "b", None),
    (5, LONG, "en", "b", 2),
    (6, " \t\n\x0b ", "en", "c", 2),
    (7, "one", "en", "c", 2),
    (8, "a\n" + PASSAGE + "\nb\n" + PASSAGE, "en", "c", 2),
    (8, "other text of one id " + " ".join(WORDS[100:160]), "en", "c", 2),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, ITEM), (1, "one"), (None, None), (2, "")], "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (1, 0), (None, 1), (5, None)], "doc_id long, toxic int")


OPERATORS = {
    "quality": lambda docs, items, labels: repetition.quality(docs),
    "tokens": lambda docs, items, labels: token_counts.count_tokens(docs, _vocabulary()),
    "toxicity": lambda docs, items, labels: toxicity.toxicity(docs, labels),
    "parse": lambda docs, items, labels: parse_dedup.remove_repeats(docs),
    "lines": lambda docs, items, labels: line_dedup.line_figures(docs),
    "benchmark": lambda docs, items, labels: decontaminate.decontaminate(docs, items),
    "mixing": lambda docs, items, labels: mixing.interleave(docs),
    "near": lambda docs, items, labels: near_dup.near_duplicates(docs),
}


def _vocabulary():
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


@pytest.mark.parametrize("name", OPERATORS)
def test_rows_are_whole_and_empty_tables_empty(docs, items, labels, name):
    assert OPERATORS[name](docs, items, labels).count() == len(ROWS)
    assert OPERATORS[name](docs.where("false"), items, labels.where("false")).count() == 0


@pytest.mark.parametrize("name", ["quality", "tokens", "toxicity", "benchmark", "mixing"])
def test_clashing_names_are_replaced(docs, items, labels, name):
    plain = OPERATORS[name](docs, items, labels)
    made = [c for c in plain.columns if c not in docs.columns]
    clash = docs.withColumns({c: docs["source"] for c in made}).withColumn("part", docs["lang"])
    result = OPERATORS[name](clash, items, labels)
    assert sorted(result.columns) == sorted([*plain.columns, "part"])
    assert result.select(*sorted(plain.columns)).dtypes == plain.select(*sorted(plain.columns)).dtypes


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_keep_columns_and_take_odd_rows(spark, docs, tmp_path, stage, items):
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    odd = docs.withColumns({"n": docs["lang"], "key": docs["n_chars"], "first": docs["text"], "kept": docs["lang"]})
    function = dict(corpus_pipeline.STAGES)[stage]
    result = function(spark, odd, str(tmp_path))
    expected = [*odd.columns, *(["block", "slot", "place"] if stage == "mix" else [])]
    assert result.columns == expected
    assert 0 < result.count() <= len(ROWS)
    assert function(spark, odd.where("false"), str(tmp_path)).count() == 0


def test_parse_of_odd_rows(docs):
    got = sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in parse_dedup.remove_repeats(docs).collect())
    assert got == sorted(brute.remove_repeats([row[1] for row in ROWS]))


@examples(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["ab", "b" * 30, "c d ", "éé", "x" * 90]), max_size=14).map("".join), min_size=1, max_size=8))
def test_parse_against_brute_force(texts):
    docs = pa.table({"doc_id": range(len(texts)), "text": texts, "block": [0] * len(texts)})
    answers = None
    for step, width in ((1, 1), (2, 3), (3, 2)):
        send = parse_dedup._send(step, 40, 2)
        sent = send(docs) if step == 1 else send(docs, answers)
        told = [parse_dedup._answer(step, width)(sent.slice(i, 1)) for i in range(sent.num_rows)]
        empty = {"block": [], "step": pa.array([], pa.int32()), "bucket": [], "codes": pa.array([], pa.binary())}
        told = pa.concat_tables(told) if told else pa.table(empty)
        answers = told if answers is None else pa.concat_tables([answers, told], promote_options="permissive")
    out = parse_dedup._finish(40)(docs, answers)
    got = list(zip(*(out.column(c).to_pylist() for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256"))))
    assert got == brute.remove_repeats(texts, 40)


@examples(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40).map(" ".join), min_size=1, max_size=6))
def test_longest_matches(texts):
    found = repetition.measured([x.encode() for x in texts], np.array([len(x) for x in texts]), repetition.Limits())
    want = [brute.quality(x) for x in texts]
    for name in want[0]:
        assert found[name].tolist() == [row[name] for row in want], name


@examples(max_examples=150, deadline=None)
@given(st.lists(st.text(), max_size=5))
def test_tokens_of_any_text(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(_vocabulary())
    texts = [*texts, "a<|endoftext|>b <|startoftext|>", "aaaaaaaa ΑΣ İ ﬁ e\u0301 \x1c\x85 don't 12"]
    want = [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.merger(_vocabulary()).count([x.encode() for x in texts]) == want


def test_blocks_of_items_agree_with_one(docs, items):
    from functools import reduce

    one = decontaminate.decontaminate(docs, items)
    many = decontaminate.decontaminate(docs, items, block_bytes=40)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items", "contaminated"]
    key = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert key(one) == key(many)
    assert one.where("contaminated").count() == 7


def test_gradients():
    random = np.random.default_rng(0)
    net = toxicity.Network(np.arange(3, dtype=np.uint64), np.zeros(3), np.zeros(toxicity.BUCKETS), 1)
    x = random.standard_normal((toxicity.WORD + toxicity.PIECE, 4)).astype(np.float32)
    ids = np.array([[0, 1], [2, 3], [1, 4], [3, 4]])
    labels = np.array([1.0, 0.0])

    def loss():
        z = net.forward(x, ids)
        return float(np.sum(np.log1p(np.exp(z)) - labels * z))

    kept = {}
    logits = net.forward(x, ids, kept)
    grads, d_x = net.backward(x, ids, kept, (1 / (1 + np.exp(-logits)) - labels).astype(np.float32))
    for name in ("Wf", "Ub", "kf", "A", "v", "w", "c"):
        at = tuple(random.integers(0, n) for n in net.weights[name].shape)
        before, step = net.weights[name][at], 1e-2
        net.weights[name][at] = before + step
        high = loss()
        net.weights[name][at] = before - step
        low = loss()
        net.weights[name][at] = before
        assert abs((high - low) / (2 * step) - grads[name][at]) < 5e-3, name
    assert d_x.shape == (4, x.shape[0])


def test_preferences_of_odd_conversations(spark):
    turns = spark.createDataFrame(
        [(0, 0, "user", "hi"), (0, 1, "assistant", "a"), (1, 0, "user", None), (1, None, None, "x"), (None, 0, "user", "lost"), (2, 0, "user", "q"), (2, 0, "user", "q")],
        "conv_id long, turn long, role string, text string",
    )
    rows = {r.conv_id: r for r in preference.format_preferences(preference.swapped_replies(turns)).collect()}
    assert set(rows) == {0, 1, 2}
    assert rows[0].prompt == "<|user|>\nhi<|end|>\n" and not rows[0].rejected
    assert [(x.text, x.trained) for x in rows[0].chosen] == [("<|assistant|>\n", False), ("a<|end|>\n", True)]
    assert rows[2].prompt_turns == 2 and not rows[2].chosen
    assert preference.format_preferences(preference.swapped_replies(turns.where("false"))).count() == 0


def test_urls_of_odd_shape(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://Example.COM", "http://a.net/fr/x?y#z", "http://net/es/", "x://example.com/en/#/en/"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, host string")
    none = spark.createDataFrame([], "url string, bad boolean")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(pages, none).collect()}
    assert got[0] == got[1] == got[2] == got[3] == ("", "", None, "allow")
    assert got[4] == ("example.com", "", None, "allow")
    assert got[5] == ("a.net", "/fr/x", "net/fr/", "block")
    assert got[6] == ("net", "/es/", "net/es/", "block")
    assert got[7] == ("example.com", "/en/", "example.com/en/", "block")


def test_large_groups_connect_without_pairs(spark):
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(300):
        words = list(base)
        words[i % 120] = f"new{i}"
        words[(i * 7) % 120] = f"other{i}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs, 2).collect()}
    want = brute.near_components(brute.shingle_sets([t for _, t in rows], 2))
    assert got == dict(enumerate(want))
