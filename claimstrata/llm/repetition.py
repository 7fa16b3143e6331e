"""Quality rules: word figures, and repetition found with suffix arrays.

The words of many documents form one sequence of numbers in which no two
documents share a number, so one suffix array serves a whole portion and no
match crosses documents. It is built by prefix doubling that sorts only what
is still tied; the ranks of every doubling give the longest common prefixes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimstrata.llm.frames import with_package
from claimstrata.llm.texts import appended, portions

# Fixed values of the contract.
SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
LEAST_WORDS = 10
WINDOW = 5
MOST_REPEATED_PERCENT = 20


@dataclass(frozen=True)
class Limits:
    """Repeats of ``least_repeat`` words or more may cover at most ``covered_percent``
    of the words, and no repeat may be longer than ``longest`` words."""

    least_repeat: int = 10
    covered_percent: int = 20
    longest: int = 40


COLUMNS = (
    ("n_words", pa.int64()),
    ("word_chars", pa.int64()),
    ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()),
    ("n_covered_words", pa.int64()),
    ("longest_repeat", pa.int64()),
    ("base_failed", pa.bool_()),
    ("kept", pa.bool_()),
)


def suffix_array(codes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffixes that share their first number with another one, in order, and the ranks.

    ``ranks[k][i]`` names the first ``2**k`` numbers at position ``i``: equal
    names mean equal numbers. The last entry of each level stands for the end.
    Each level sorts only the suffixes that tie so far.
    """
    size = len(codes)
    order = np.argsort(codes, kind="stable")
    ranks = _levels_rank(size, order, codes[order])
    levels = [ranks]
    tied = _tied(ranks, np.arange(size))
    shared = tied
    reach = 1
    while len(tied):
        after = ranks[np.minimum(tied + reach, size)]
        keys = ranks[tied] * np.int64(size + 2) + after + 1
        order = np.argsort(keys, kind="stable")
        keys, tied = keys[order], tied[order]
        group = ranks[tied]
        head = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        place = np.arange(len(tied)) - np.repeat(head, np.diff(np.r_[head, len(tied)])) + group
        start = np.r_[True, keys[1:] != keys[:-1]]
        ranks = ranks.copy()
        ranks[tied] = place[np.maximum.accumulate(np.where(start, np.arange(len(tied)), 0))]
        levels.append(ranks)
        tied = _tied(ranks, tied)
        reach *= 2
    return shared[np.argsort(ranks[shared], kind="stable")], levels


def _levels_rank(size: int, order: np.ndarray, values: np.ndarray) -> np.ndarray:
    start = np.r_[True, values[1:] != values[:-1]] if size else np.zeros(0, bool)
    ranks = np.full(size + 1, -1, np.int64)
    ranks[order] = np.maximum.accumulate(np.where(start, np.arange(size), 0))
    return ranks


def _tied(ranks: np.ndarray, among: np.ndarray) -> np.ndarray:
    held = ranks[among]
    return among[np.bincount(held, minlength=1)[held] > 1] if len(among) else among


def longest_matches(codes: np.ndarray) -> np.ndarray:
    """For each position the length of its longest match with another position."""
    longest = np.zeros(len(codes), np.int64)
    order, levels = suffix_array(codes)
    if len(order) < 2:
        return longest
    left, right = order[:-1], order[1:]
    common = np.zeros(len(left), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        names = levels[k]
        a, b = np.minimum(left + common, len(codes)), np.minimum(right + common, len(codes))
        common += (names[a] == names[b]) * np.int64(1 << k)
    np.maximum.at(longest, left, common)
    np.maximum.at(longest, right, common)
    return longest


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Which positions lie in a maximal repeat of ``least`` or more.

    A position opens a maximal span if its match is not the rest of the match
    of the position before; the union of these spans is that of all repeats.
    """
    size = len(longest)
    opens = longest >= least
    opens[1:] &= longest[1:] != longest[:-1] - 1
    at = np.flatnonzero(opens)
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + longest[at], -1)
    return np.cumsum(change[:-1]) > 0


def measured(texts: list[bytes | None], chars: np.ndarray, limits: Limits) -> dict[str, np.ndarray]:
    """The figures and decisions for some texts; ``chars`` are their code points."""
    texts = [text or b"" for text in texts]
    words = [text.split() for text in texts]
    n_words = np.array([len(x) for x in words], np.int64)
    flat = [word for row in words for word in row]
    owner = np.repeat(np.arange(len(texts)), n_words)
    codes = pd.factorize(np.array(flat, dtype=object))[0].astype(np.int64) if flat else np.zeros(0, np.int64)
    codes += owner * np.int64(codes.max() + 1 if len(codes) else 1)
    longest = longest_matches(codes)

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.bincount(owner, flags, len(texts)).astype(np.int64)

    repeated = per_text(covered(longest, WINDOW))
    held = per_text(covered(longest, limits.least_repeat))
    longest_repeat = np.zeros(len(texts), np.int64)
    np.maximum.at(longest_repeat, owner, longest)

    blanks = np.array([len(x) - len(x.translate(None, WHITE)) for x in texts], np.int64)
    symbols = np.array([len(x) - len(x.translate(None, SYMBOLS)) for x in texts], np.int64)
    failed = (n_words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n_words)
    good = (100 * held <= limits.covered_percent * n_words) & (longest_repeat <= limits.longest)
    return {
        "n_words": n_words,
        "word_chars": chars - blanks,
        "n_symbols": symbols,
        "n_dup_lines": np.array([_repeated_lines(x) for x in texts], np.int64),
        "n_repeat_words": repeated,
        "n_covered_words": held,
        "longest_repeat": longest_repeat,
        "base_failed": failed,
        "kept": ~failed & good,
    }


def _repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def quality(docs: DataFrame, limits: Limits = Limits(), prefix: str = "") -> DataFrame:
    """Every row with its figures and ``kept``, named with ``prefix``.

    Words are runs without white space (blank, tab to carriage return). The
    base rejects texts of under 10 words or with over 20 % of their words in
    5-word windows that come twice or more; the suffix array rejects texts of
    which repeats of ``limits.least_repeat`` words cover too much or of which
    one repeat is too long. Matches may overlap themselves.

    A null or empty text has no words and is rejected. Rows are judged alone:
    ties and repeated rows get equal results. Columns that have the name of a
    figure are replaced. An empty table gives an empty one. No shuffle; a task
    holds one portion of about 1 MB of text, or one longer text, at a time.
    """
    with_package(docs.sparkSession)
    names = [prefix + name for name, _ in COLUMNS]
    keep = [name for name in docs.columns if name not in names]
    fields = ", ".join(f"`{name}` {'boolean' if pa.types.is_boolean(kind) else 'long'}" for name, (_, kind) in zip(names, COLUMNS))

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for part in portions(batches, "text"):
            column = part.column("text")
            chars = pc.fill_null(pc.utf8_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            texts = pc.cast(column, pa.binary()).to_pylist()
            found = measured(texts, chars, limits)
            made = {prefix + name: pa.array(found[name], kind) for name, kind in COLUMNS}
            yield appended(part, keep, **made)

    schema = ", ".join(f"`{name}` {kind}" for name, kind in docs.select(*keep).dtypes)
    passed = docs.select(*keep) if "text" in keep else docs
    return passed.mapInArrow(measure, f"{schema}, {fields}")


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows that ``quality`` keeps, with the columns they had."""
    return quality(docs, limits, "_quality_").where(F.col("_quality_kept")).select(*docs.columns)
