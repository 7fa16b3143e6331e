"""Token counts by byte-pair merging of many pre-tokens at once in numpy arrays.

The vocabulary file is that of a byte-level BPE with word ends. White space
always separates pre-tokens, so texts are cut at white space and each distinct
piece is counted once per task: its pre-tokens lie in one ragged array of
symbols, and every round merges the lowest-ranked pair of every sequence.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from claimstrata.llm.frames import with_package
from claimstrata.llm.texts import appended, portions

CACHE_PIECES = 400_000
_NO_RANK = np.int64(1 << 62)
# Letters and numbers assigned after Unicode 16, the version of the library's classes.
_LATER = """
    558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf
    10940-10959 10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f
    12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2
    18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff
    1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e
    2cea2-2cead 323b0-33479 3d000-3fc3f
"""
# Lower-case letters that the library's tables have and older ones of Python do not.
_LOWER = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
    **{upper: upper + 32 for upper in range(0x10D50, 0x10D66)},
    **{upper: upper + 27 for upper in range(0x16EA0, 0x16EB9)},
}


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte value in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the other byte values
    for the characters from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [value for value in range(256) if value not in plain]
    return [chr(v) if v in set(plain) else chr(256 + other.index(v)) for v in range(256)]


def later_characters() -> str:
    """A set for a pattern with the characters of ``_LATER``."""
    return "[" + "".join("-".join(chr(int(x, 16)) for x in part.split("-")) for part in _LATER.split()) + "]"


class Merger:
    """The merges of one vocabulary file, and a cache of counted pieces."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        model = parts["model"]
        vocabulary, merges = model["vocab"], model["merges"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        suffix = model.get("end_of_word_suffix") or ""
        self.size = np.int64(len(vocabulary) + 1)
        self.special = [token["content"] for token in parts["added_tokens"]]
        self.cut = regex.compile("|".join(regex.escape(x) for x in sorted(self.special, key=len, reverse=True)))
        split = next(x for x in parts["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        words = split["pattern"]["Regex"]
        self.pattern = regex.compile(words)
        # ``regex`` may know more letters and numbers than the library does.
        later = later_characters()
        self.newer = regex.compile(f"[{later}{''.join(map(chr, _LOWER))}]", regex.V1)
        for known in (r"\p{L}", r"\p{N}"):
            words = words.replace(known, f"[{known}--{later}]")
        self.older = regex.compile(words, regex.V1)
        pairs = np.array([vocabulary[a] * int(self.size) + vocabulary[b] for a, b in merges], np.int64)
        made = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        # Of a pair listed twice the later rank holds, as in the library.
        order = np.lexsort((-np.arange(len(pairs)), pairs))
        first = np.r_[True, pairs[order][1:] != pairs[order][:-1]]
        self.pairs, self.ranks = pairs[order][first], order[first].astype(np.int64)
        self.made = made
        symbols = byte_symbols()
        self.inner = np.array([vocabulary[s] for s in symbols], np.int64)
        self.last = np.array([vocabulary[s + suffix] for s in symbols], np.int64)
        self.known: dict[bytes, int] = {}

    def pretokens(self, piece: bytes) -> tuple[list[bytes], int]:
        """The pre-tokens of a piece without white space, and its special tokens."""
        text = piece.decode("utf-8")
        special = 0
        parts = [text]
        if "<|" in text:
            special = len(self.cut.findall(text))
            parts = self.cut.split(text)
        found: list[bytes] = []
        for part in parts:
            pattern = self.pattern
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
                if self.newer.search(part):
                    part, pattern = part.translate(_LOWER), self.older
            found += [x.encode("utf-8") for x in pattern.findall(part.lower())]
        return found, special

    def rank(self, keys: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.ranks[at], _NO_RANK)

    def merged(self, sequences: list[bytes]) -> np.ndarray:
        """The number of tokens of each non-empty byte sequence."""
        lengths = np.array([len(x) for x in sequences], np.int64)
        counts = lengths.copy()
        raw = np.frombuffer(b"".join(sequences), np.uint8)
        symbols = self.inner[raw]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[raw[ends]]
        owner = np.repeat(np.arange(len(sequences)), lengths)
        while len(symbols):
            ranks = self.rank(symbols[:-1] * self.size + symbols[1:])
            ranks[owner[1:] != owner[:-1]] = _NO_RANK
            ranks = np.r_[ranks, _NO_RANK]
            heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[heads, len(owner)])
            lowest = np.minimum.reduceat(ranks, heads)
            counts[owner[heads]] = sizes
            spread = np.repeat(lowest, sizes)
            active = spread < _NO_RANK
            merge = active & (ranks == spread)
            at = np.flatnonzero(merge)
            if not len(at):
                break
            # Of a run such as a a a, whose pairs overlap, every second pair merges.
            run = np.maximum.accumulate(np.where(np.r_[True, np.diff(at) != 1], np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            symbols[at] = self.made[ranks[at]]
            active[at + 1] = False
            symbols, owner = symbols[active], owner[active]
        return counts

    def learn(self, pieces: list[bytes]) -> None:
        """Count pieces that are not in the cache yet."""
        special = np.zeros(len(pieces), np.int64)
        index: dict[bytes, int] = {}
        owner, which = [], []
        for i, piece in enumerate(pieces):
            found, special[i] = self.pretokens(piece)
            for token in found:
                owner.append(i)
                which.append(index.setdefault(token, len(index)))
        if index:
            counts = self.merged(list(index))
            special += np.bincount(owner, counts[which], len(pieces)).astype(np.int64)
        self.known.update(zip(pieces, special.tolist()))

    def count(self, texts: list[bytes]) -> list[int]:
        split = [text.split() for text in texts]
        new = set().union(*split).difference(self.known)
        if len(self.known) + len(new) > CACHE_PIECES:
            self.known.clear()
            new = set().union(*split)
        self.learn(list(new))
        return [sum(map(self.known.__getitem__, pieces)) for pieces in split]


@lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    return Merger(path)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """Every row with ``n_bytes``, ``n_tokens`` and ``over_limit`` of its whole text.

    ``vocabulary`` is the path of a tokenizer file that every executor has:
    byte-level BPE whose pre-tokens never hold white space. Special strings
    inside a text count as one token each; none is added.

    A null text counts as an empty one: no bytes, no tokens. Equal texts get
    equal counts. Columns of the three names are replaced. An empty table
    gives an empty one. No shuffle; a task holds one portion of about 1 MB of
    text, or one longer text, and a cache of at most ``CACHE_PIECES`` pieces
    beside those of the portion.
    """
    with_package(docs.sparkSession)
    new = ("n_bytes", "n_tokens", "over_limit")
    keep = [name for name in docs.columns if name not in new]
    schema = ", ".join(f"`{name}` {kind}" for name, kind in docs.select(*keep).dtypes)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = merger(vocabulary)
        for part in portions(batches, "text"):
            texts = pc.fill_null(pc.cast(part.column("text"), pa.binary()), b"").to_pylist()
            tokens = np.array(merges.count(texts), np.int64)
            yield appended(
                part,
                keep,
                n_bytes=pa.array([len(x) for x in texts], pa.int64()),
                n_tokens=pa.array(tokens),
                over_limit=pa.array(tokens > limit),
            )

    return docs.select(*keep).mapInArrow(count, f"{schema}, n_bytes long, n_tokens long, over_limit boolean")
