"""Toxicity scores by a bidirectional gated recurrent network with attention, trained in numpy.

A word enters as two vectors: that of the word, if the training sample knows
it, and the mean of those of its 4-byte pieces, which also speaks for unknown
words. A window of words runs through a recurrent layer in either direction,
attention pools the states, and one unit gives a logit. A text's logit is the
largest of its overlapping windows, so labels of whole texts train the network
on the windows that score highest. Two networks from different starts judge
together, and as the largest of many windows is larger by chance, the number of
windows counts against a text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimstrata.llm.frames import with_package
from claimstrata.llm.texts import ALNUM, appended, byte_view, names, portions, word_spans

_SEED = 41
HIDDEN = 8
WORD = 4
PIECE = 4
BUCKETS = 1 << 14


@dataclass(frozen=True)
class Training:
    """Up to ``rows`` labelled texts of each class train ``networks`` networks.

    Of a text of more than ``text_bytes`` bytes that many come from all over it.
    """

    rows: int = 1500
    text_bytes: int = 8_192
    window: int = 48
    stride: int = 36
    rounds: int = 10
    networks: int = 2
    batch: int = 256
    rate: float = 0.01
    least_rows: int = 3
    seed: int = 7


@dataclass
class Words:
    """The words of some texts: distinct ones with their pieces, and which one stands where."""

    names: np.ndarray
    ids: np.ndarray
    first: np.ndarray
    pieces: np.ndarray
    piece_count: np.ndarray


def read_words(column: pa.Array) -> Words:
    data, offsets = byte_view(column)
    starts, ends, first = word_spans(data, offsets, ALNUM)
    namer = names(_SEED, True)
    found = namer.of(namer.sums(data), starts, ends)
    distinct, at, ids = np.unique(found, return_index=True, return_inverse=True)
    length = ends[at] - starts[at]
    # Each distinct word between marks and with a zero behind: as many pieces as bytes.
    total = np.cumsum(length + 3)
    begin = total - length - 3
    spread = np.zeros(int(total[-1]) + 3 if len(total) else 3, np.uint8)
    inner = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    bytes_of = data[np.repeat(starts[at], length) + inner]
    upper = (bytes_of >= 65) & (bytes_of <= 90)
    spread[np.repeat(begin + 1, length) + inner] = np.where(upper, bytes_of + 32, bytes_of)
    spread[begin] = 1
    spread[begin + 1 + length] = 2
    place = np.repeat(begin, length) + inner
    code = np.zeros(len(place), np.uint32)
    for k in range(4):
        code |= spread[place + k].astype(np.uint32) << np.uint32(8 * k)
    pieces = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - 14)
    return Words(distinct, ids.astype(np.int64), first, pieces.astype(np.int64), length.astype(np.int64))


def cut(first: np.ndarray, window: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and length of every overlapping window; together they cover all words."""
    counts = np.diff(first)
    number = np.maximum(1, 1 + -(-np.maximum(counts - window, 0) // stride))
    row = np.repeat(np.arange(len(counts)), number)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
    begin = inner * stride
    return row, first[:-1][row] + begin, np.minimum(window, counts[row] - begin)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Weights by name, forward and backward passes. States are (hidden, windows) matrices."""

    def __init__(self, vocabulary: np.ndarray, word_odds: np.ndarray, piece_odds: np.ndarray, seed: int) -> None:
        random = np.random.default_rng(seed)

        def normal(*shape: int) -> np.ndarray:
            return (random.standard_normal(shape) / np.sqrt(shape[-1])).astype(np.float32)

        self.vocabulary = vocabulary
        inputs = WORD + PIECE
        self.weights = {
            "word": 0.1 * normal(len(vocabulary) + 1, WORD),
            "piece": 0.1 * normal(BUCKETS, PIECE),
            "A": normal(HIDDEN, 2 * HIDDEN),
            "v": normal(1, HIDDEN),
            "w": normal(1, 2 * HIDDEN),
            "c": np.zeros((1, 1), np.float32),
        }
        for side in ("f", "b"):
            self.weights[f"W{side}"] = normal(3 * HIDDEN, inputs)
            self.weights[f"U{side}"] = normal(3 * HIDDEN, HIDDEN)
            self.weights[f"k{side}"] = np.zeros((3 * HIDDEN, 1), np.float32)
        self.weights["word"][0] = 0
        self.weights["word"][1:, 0] = word_odds
        self.weights["piece"][:, 0] = piece_odds

    def numbers(self, found: np.ndarray) -> np.ndarray:
        """Vocabulary rows of word names, 0 for unknown words."""
        if not len(self.vocabulary):
            return np.zeros(len(found), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, found), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == found, at + 1, 0)

    def inputs(self, numbers: np.ndarray, pieces: np.ndarray, count: np.ndarray) -> np.ndarray:
        """One input vector per distinct word, as columns."""
        if not len(numbers):
            return np.zeros((WORD + PIECE, 0), np.float32)
        heads = np.cumsum(count) - count
        mean = np.add.reduceat(self.weights["piece"][pieces], heads, axis=0) / count[:, None]
        return np.concatenate([self.weights["word"][numbers], mean], 1).T.astype(np.float32)

    def _drive(self, side: str, x: np.ndarray) -> np.ndarray:
        """What each distinct word adds to the gates; the last column, for no word, keeps the state."""
        drive = self.weights[f"W{side}"] @ x + self.weights[f"k{side}"]
        rest = np.zeros((3 * HIDDEN, 1), np.float32)
        rest[:HIDDEN] = 30
        return np.ascontiguousarray(np.concatenate([drive, rest], 1), np.float32)

    def _run(self, side: str, drive: np.ndarray, ids: np.ndarray, keep: list | None) -> np.ndarray:
        steps, number = ids.shape
        weights = self.weights[f"U{side}"]
        gates, last = weights[: 2 * HIDDEN], weights[2 * HIDDEN :]
        state = np.zeros((HIDDEN, number), np.float32)
        states = np.empty((steps, HIDDEN, number), np.float32)
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            push = drive.take(ids[t], axis=1)
            zr = _sigmoid(push[: 2 * HIDDEN] + gates @ state)
            z, r = zr[:HIDDEN], zr[HIDDEN:]
            n = np.tanh(push[2 * HIDDEN :] + last @ (r * state))
            if keep is not None:
                keep.append((t, z, r, n, state))
            state = n + z * (state - n)
            states[t] = state
        return states

    def forward(self, x: np.ndarray, ids: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of windows; ``ids`` (steps, windows) are columns of ``x``, or its width for no word."""
        w = self.weights
        kept = {side: [] if keep is not None else None for side in "fb"}
        states = np.concatenate([self._run(side, self._drive(side, x), ids, kept[side]) for side in "fb"], 1)
        looks = np.tanh(np.matmul(w["A"], states))
        marks = np.matmul(w["v"], looks)[:, 0]
        marks = np.where(ids < x.shape[1], marks, np.float32(-1e9))
        shares = np.exp(marks - marks.max(axis=0))
        shares *= ids < x.shape[1]
        shares /= np.maximum(shares.sum(axis=0), 1e-9)
        pooled = np.einsum("tb,thb->hb", shares, states)
        if keep is not None:
            keep.update(kept, states=states, looks=looks, shares=shares, pooled=pooled)
        return (w["w"] @ pooled + w["c"])[0]

    def backward(self, x: np.ndarray, ids: np.ndarray, kept: dict, slope: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the weights, and of ``x``, for the slope of the loss by logit."""
        w, grads = self.weights, {}
        states, looks, shares, pooled = (kept[k] for k in ("states", "looks", "shares", "pooled"))
        grads["w"], grads["c"] = slope[None] @ pooled.T, slope.sum().reshape(1, 1)
        d_pooled = w["w"].T * slope
        d_states = shares[:, None] * d_pooled[None]
        d_shares = np.einsum("thb,hb->tb", states, d_pooled)
        d_marks = shares * (d_shares - (shares * d_shares).sum(axis=0))
        grads["v"] = np.einsum("tb,tkb->k", d_marks, looks)[None]
        d_looks = w["v"].T[None] * d_marks[:, None] * (1 - looks * looks)
        grads["A"] = np.einsum("tkb,thb->kh", d_looks, states)
        d_states += np.matmul(w["A"].T, d_looks)
        d_x = np.zeros((x.shape[1] + 1, x.shape[0]), np.float32)
        for i, side in enumerate("fb"):
            u = w[f"U{side}"]
            gates, last = u[: 2 * HIDDEN], u[2 * HIDDEN :]
            d_u, d_drive = np.zeros_like(u), np.zeros((x.shape[1] + 1, 3 * HIDDEN), np.float32)
            carry = np.zeros((HIDDEN, ids.shape[1]), np.float32)
            for t, z, r, n, state in reversed(kept[side]):
                carry = carry + d_states[t, i * HIDDEN : (i + 1) * HIDDEN]
                d_n = carry * (1 - z) * (1 - n * n)
                d_z = carry * (state - n) * z * (1 - z)
                back = last.T @ d_n
                d_r = back * state * r * (1 - r)
                push = np.concatenate([d_z, d_r, d_n])
                d_u[: 2 * HIDDEN] += push[: 2 * HIDDEN] @ state.T
                d_u[2 * HIDDEN :] += d_n @ (r * state).T
                carry = carry * z + back * r + gates.T @ push[: 2 * HIDDEN]
                np.add.at(d_drive, ids[t], push.T)
            d_drive = d_drive[:-1]
            grads[f"U{side}"], grads[f"W{side}"] = d_u, d_drive.T @ x.T
            grads[f"k{side}"] = d_drive.sum(axis=0)[:, None]
            d_x[:-1] += d_drive @ w[f"W{side}"]
        return grads, d_x[:-1]

    def logits(self, words: Words, window: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The logit of every window, with row, start and length."""
        x = self.inputs(self.numbers(words.names), words.pieces, words.piece_count)
        row, start, length = cut(words.first, window, stride)
        found = np.empty(len(row), np.float32)
        for a in range(0, len(row), 4096):
            b = min(a + 4096, len(row))
            found[a:b] = self.forward(x, laid_out(words.ids, x.shape[1], start[a:b], length[a:b], window))
        return found, row, start, length

    def best(self, words: Words, window: int, stride: int) -> np.ndarray:
        """The largest logit of each text."""
        found, row, _, _ = self.logits(words, window, stride)
        made = np.full(len(words.first) - 1, -np.inf)
        np.maximum.at(made, row, found)
        return made


@dataclass
class Committee:
    """Networks whose largest logits are averaged, and what makes a probability of that."""

    networks: list[Network]
    weights: np.ndarray

    def scores(self, words: Words, window: int, stride: int) -> np.ndarray:
        mean = np.mean([net.best(words, window, stride) for net in self.networks], axis=0)
        return _sigmoid(_features(mean, words, window, stride) @ self.weights)


def _features(logits: np.ndarray, words: Words, window: int, stride: int) -> np.ndarray:
    row, _, _ = cut(words.first, window, stride)
    windows = np.bincount(row, minlength=len(logits))
    return np.stack([np.clip(logits, -30, 30), np.log(np.maximum(windows, 1)), np.ones(len(logits))], 1)


def laid_out(ids: np.ndarray, none: int, start: np.ndarray, length: np.ndarray, window: int) -> np.ndarray:
    """Windows as columns; places behind a window's end hold ``none``."""
    steps = np.arange(int(length.max(initial=1)) or 1)[:, None]
    inside = steps < length
    if not len(ids):
        return np.full(inside.shape, none, np.int64)
    return np.where(inside, ids[np.minimum(start + steps, len(ids) - 1)], none)


def _odds(present: tuple[np.ndarray, np.ndarray], toxic: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of a class by what a text holds, and in how many texts each thing is."""
    row, thing = present
    pair = np.unique(row * np.int64(size) + thing)
    row, thing = pair // size, pair % size
    bad = np.bincount(thing, toxic[row], size) + 2.0
    good = np.bincount(thing, ~toxic[row], size) + 2.0
    share = (toxic.sum() + 2.0) / ((~toxic).sum() + 2.0)
    return np.log(bad / good / share).astype(np.float32), bad + good - 4


def fit(column: pa.Array, toxic: np.ndarray, prior: float, plan: Training) -> Committee:
    """Networks trained on texts with a label each; ``prior`` is the share of toxic texts outside."""
    words = read_words(column)
    nets = [_trained(words, toxic, replace(plan, seed=plan.seed + i)) for i in range(plan.networks)]
    mean = np.mean([net.best(words, plan.window, plan.stride) for net in nets], axis=0)
    return Committee(nets, _calibrate(_features(mean, words, plan.window, plan.stride), toxic, prior))


def _trained(words: Words, toxic: np.ndarray, plan: Training) -> Network:
    owner = np.repeat(np.arange(len(toxic)), np.diff(words.first))
    odds, rows = _odds((owner, words.ids), toxic, max(1, len(words.names)))
    known = np.flatnonzero(rows[: len(words.names)] >= plan.least_rows)
    heads = np.cumsum(words.piece_count) - words.piece_count
    held = np.unique(owner * np.int64(max(1, len(words.names))) + words.ids)
    who, which = held // max(1, len(words.names)), held % max(1, len(words.names))
    reps = words.piece_count[which]
    where = np.repeat(heads[which] - np.cumsum(reps) + reps, reps) + np.arange(reps.sum())
    piece_odds, _ = _odds((np.repeat(who, reps), words.pieces[where]), toxic, BUCKETS)
    del held, who, which, where
    net = Network(words.names[known], odds[known], piece_odds, plan.seed)
    numbers = net.numbers(words.names)

    random = np.random.default_rng(plan.seed)
    row, start, length = cut(words.first, plan.window, plan.stride)
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.weights.items()}
    step = 0
    found = np.array([odds[words.ids[a : a + n]].max(initial=0) for a, n in zip(start, length)])
    for _ in range(plan.rounds):
        best = np.lexsort((-found, row))
        top = best[np.r_[True, row[best][1:] != row[best][:-1]]]
        others = np.flatnonzero(~toxic[row])
        others = random.choice(others, min(len(others), 2 * len(toxic)), replace=False)
        chosen = random.permutation(np.unique(np.r_[top, others]))
        for a in range(0, len(chosen), plan.batch):
            step += 1
            _descend(net, words, numbers, heads, start, length, toxic[row].astype(np.float32), chosen[a : a + plan.batch], plan, moments, step)
        found = net.logits(words, plan.window, plan.stride)[0]
    return net


def _descend(net, words, numbers, heads, start, length, labels, chosen, plan, moments, step) -> None:
    ids = laid_out(words.ids, len(words.names), start[chosen], length[chosen], plan.window)
    used, ids = np.unique(np.r_[ids.ravel(), len(words.names)], return_inverse=True)
    ids = ids[:-1].reshape(-1, len(chosen))
    used = used[:-1]
    count = words.piece_count[used]
    pieces = words.pieces[np.repeat(heads[used] - np.cumsum(count) + count, count) + np.arange(count.sum())]
    x = net.inputs(numbers[used], pieces, count)
    kept: dict = {}
    logits = net.forward(x, ids, kept)
    slope = (_sigmoid(logits) - labels[chosen]) / len(chosen)
    grads, d_x = net.backward(x, ids, kept, slope.astype(np.float32))
    grads["word"] = np.zeros_like(net.weights["word"])
    np.add.at(grads["word"], numbers[used], d_x[:, :WORD])
    grads["word"][0] = 0
    grads["piece"] = np.zeros_like(net.weights["piece"])
    np.add.at(grads["piece"], pieces, np.repeat(d_x[:, WORD:] / count[:, None], count, axis=0))
    for name, grad in grads.items():
        m, v = moments[name]
        m += 0.1 * (grad - m)
        v += 0.001 * (grad * grad - v)
        rate = plan.rate * (0.3 if name in ("word", "piece") else 1.0)
        fixed = np.sqrt(v / (1 - 0.999**step)) + 1e-8
        net.weights[name] -= (rate * m / (1 - 0.9**step) / fixed).astype(np.float32)


def _calibrate(features: np.ndarray, toxic: np.ndarray, prior: float) -> np.ndarray:
    """Weights of logit, logarithm of the windows and one, so that the sum is the logit of a probability.

    The logit counts for a text and the windows count against it or not at all.
    """
    weight = np.where(toxic, prior / max(1, toxic.sum()), (1 - prior) / max(1, (~toxic).sum()))
    free = np.array([True, True, True])
    while True:
        x = features[:, free]
        beta = np.array([1.0, 0.0, 0.0])[free]
        start = beta.copy()
        for _ in range(50):
            p = _sigmoid(x @ beta)
            ridge = np.array([1e-3, 1e-3, 1e-9])[free]
            grad = x.T @ (weight * (p - toxic)) + ridge * (beta - start)
            hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
            move = np.linalg.solve(hess, grad)
            beta -= np.clip(move, -1, 1)
            if np.abs(move).max() < 1e-6:
                break
        found = np.zeros(3)
        found[free] = beta
        if found[1] <= 0:
            found[0] = max(found[0], 0.05)
            return found
        free[1] = False


def held_out(doc_id: Column) -> Column:
    """Whether a row's label must not be learned from; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def _excerpt(most: int, pieces: int = 8) -> Column:
    """The text, or pieces from all over a text of more than ``most`` bytes, of no more bytes together."""
    size = max(1, most // (4 * pieces) - 1)
    step = (F.length("text") - size) / (pieces - 1)
    some = (F.substring("text", F.floor(i * step).cast("int") + 1, F.lit(size)) for i in range(pieces))
    return F.when(F.octet_length("text") <= most, F.col("text")).otherwise(F.concat_ws(" ", *some))


def train(docs: DataFrame, labels: DataFrame, plan: Training = Training()) -> Committee | float:
    """Networks from a bounded sample of labelled rows, or the share of toxic labels.

    The sample takes up to ``plan.rows`` ids of each class that have a text, in
    the order of a hash, those with a text of at most ``plan.text_bytes`` bytes
    first; of a longer text excerpts of so many bytes come. At most
    ``2 * rows * text_bytes`` bytes come to the driver. Without rows of both
    classes there is nothing to learn and the share is the score.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    totals = {row["toxic"]: row["n"] for row in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = totals.get(True, 0), totals.get(False, 0)
    if not bad or not good:
        return float(bad > 0)
    order = ("long", F.xxhash64(F.lit(plan.seed), "doc_id"), "doc_id")
    texts = docs.select("doc_id", "text").where("text IS NOT NULL")
    long = (F.octet_length("text") > plan.text_bytes).alias("long")
    usable = known.join(texts.select("doc_id", long).groupBy("doc_id").agg(F.min("long").alias("long")), "doc_id")
    parts = [usable.where(F.col("toxic") == flag).orderBy(*order).limit(plan.rows) for flag in (True, False)]
    sample = F.broadcast(parts[0].unionByName(parts[1]).withColumnRenamed("doc_id", "_id"))
    rows = texts.join(sample, F.col("doc_id") == F.col("_id")).dropDuplicates(["doc_id"])
    rows = rows.select("doc_id", _excerpt(plan.text_bytes).alias("text"), "toxic")
    table = rows.toArrow().sort_by("doc_id")
    toxic = table.column("toxic").to_numpy().astype(bool)
    if not toxic.any() or toxic.all():
        return bad / (bad + good)
    return fit(table.column("text").combine_chunks(), toxic, bad / (bad + good), plan)


def toxicity(docs: DataFrame, labels: DataFrame, plan: Training = Training()) -> DataFrame:
    """Every row with ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    Rows whose ``crc32`` of the id as text leaves 0 modulo 5 are held out:
    their labels are never read. The text alone makes the score.

    A null or empty text has one window without words and gets that window's
    score. A null id is not held out. Equal texts get equal scores. Labels
    without id or class take no part; the highest of several labels counts;
    repeated ids train once. Columns of the three names are replaced. An empty
    table gives an empty one.

    The networks are trained in the driver on the bounded sample of ``train`` and
    sent to the tasks; their size does not depend on the data. No document is
    shuffled for scoring.
    """
    with_package(docs.sparkSession)
    net = train(docs, labels, plan)
    new = ("held_out", "score", "predicted")
    keep = [name for name in docs.columns if name not in new]
    schema = ", ".join(f"`{name}` {kind}" for name, kind in docs.select(*keep).dtypes)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches, "text"):
            if isinstance(net, float):
                found = np.full(part.num_rows, net)
            else:
                found = net.scores(read_words(part.column("text")), plan.window, plan.stride).astype(np.float64)
            yield appended(part, keep, score=pa.array(found), predicted=pa.array((found >= 0.5).astype(np.int32)))

    scored = docs.select(*keep).mapInArrow(score, f"{schema}, score double, predicted int")
    return scored.withColumn("held_out", held_out(F.col("doc_id")))
