"""Plain Python versions of the operators, slow and direct, to hold results against."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

SPACED = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text, pattern=SPACED, fold=False):
    text = text or ""
    return pattern.findall(text.translate(LOWER) if fold else text)


def in_repeats(tokens, size):
    seen = Counter(tuple(tokens[i : i + size]) for i in range(len(tokens) - size + 1))
    flags = [False] * len(tokens)
    for i in range(len(tokens) - size + 1):
        if seen[tuple(tokens[i : i + size])] > 1:
            flags[i : i + size] = [True] * size
    return sum(flags)


def quality(text, least=10, percent=20, longest=40):
    tokens, text = words(text), text or ""
    lines = [x for x in text.split("\n") if words(x)]
    repeated, held = in_repeats(tokens, 5), in_repeats(tokens, least)
    failed = len(tokens) < 10 or 100 * repeated > 20 * len(tokens)
    good = 100 * held <= percent * len(tokens) and not in_repeats(tokens, longest + 1)
    return {
        "n_words": len(tokens),
        "word_chars": sum(map(len, tokens)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated,
        "n_covered_words": held,
        "base_failed": failed,
        "kept": not failed and good,
    }


def remove_repeats(texts, least=200):
    data = [(x or "").encode() for x in texts]
    seen = Counter(hash(x[i : i + least]) for x in data for i in range(len(x) - least + 1))
    out = []
    for x in data:
        flags = bytearray(len(x))
        for i in range(len(x) - least + 1):
            if seen[hash(x[i : i + least])] > 1:
                flags[i : i + least] = b"\1" * least
        kept = bytes(b for b, gone in zip(x, flags) if not gone)
        spans = len(re.findall(b"\1+", bytes(flags)))
        out.append((len(x), sum(flags), spans, hashlib.sha256(kept).hexdigest()))
    return out


def removed_lines(docs):
    """Places (id, text, line) that go, from pairs of id and text."""
    lines = []
    for doc_id, text in docs:
        for i, line in enumerate((text or "").split("\n") if text is not None else []):
            tokens = frozenset(words(line))
            if tokens:
                lines.append(((doc_id is not None, doc_id or 0), text, i, tokens, len(line)))
    first, places = {}, defaultdict(list)
    for key, text, i, tokens, _ in lines:
        first[tokens] = min(first.get(tokens, (key, i)), (key, i))
    for tokens in first:
        for token in tokens:
            places[token].append(tokens)
    cut = dict(first)
    for tokens in first:
        near = Counter()
        for token in tokens:
            near.update(other for other in places[token] if len(other) * 5 >= 4 * len(tokens) and len(tokens) * 5 >= 4 * len(other))
        for other, common in near.items():
            if 9 * common >= 4 * (len(tokens) + len(other)):
                cut[tokens] = min(cut[tokens], first[other])
    return [(key, text, i, n) for key, text, i, tokens, n in lines if (key, i) > cut[tokens]]


def decontaminate(texts, items, size=10):
    known = defaultdict(set)
    for item, text in items:
        tokens = words(text, ALNUM, True)
        length = min(size, len(tokens))
        for i in range(len(tokens) - length + 1 if length else 0):
            known[tuple(tokens[i : i + length])].add("" if item is None else str(item))
    lengths = {len(x) for x in known}
    out = []
    for text in texts:
        tokens = words(text, ALNUM, True)
        hit, ids = set(), set()
        for length in lengths:
            for i in range(len(tokens) - length + 1):
                found = known.get(tuple(tokens[i : i + length]))
                if found:
                    hit.update(range(i, i + length))
                    ids |= found
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((len(tokens), len(hit), len(ids), digest, bool(hit)))
    return out


def shingle_sets(texts, size):
    out = []
    for text in texts:
        tokens = words(text, SPACED, True)
        if len(tokens) < size:
            out.append({tuple(tokens)} if tokens else set())
        else:
            out.append({tuple(tokens[i : i + size]) for i in range(len(tokens) - size + 1)})
    return out


def near_components(sets):
    """For each row the smallest row of its component."""
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    places = defaultdict(list)
    for i, held in enumerate(sets):
        common = Counter()
        for x in held:
            common.update(places[x])
            places[x].append(i)
        for j, n in common.items():
            if 100 * n >= 80 * (len(held) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(sets))]


def schedule(shares):
    """Slots of one period, by simulating earliest deadline first."""
    period, used, order = sum(shares), [0] * len(shares), []
    for t in range(period):
        ready = [
            (math.ceil((used[i] + 1) * period / a), i)
            for i, a in enumerate(shares)
            if used[i] < a and used[i] * period // a <= t
        ]
        due, i = min(ready)
        assert t < due
        used[i] += 1
        order.append(i)
    return order


def mined_rules(baskets, support, confidence, lift):
    """Token sets that mark bad urls, from (tokens, bad) pairs."""
    baskets = [(frozenset(t), bad) for t, bad in baskets]
    least = math.ceil(support * len(baskets))
    share = sum(bad for _, bad in baskets) / len(baskets) if baskets else 0
    tokens = Counter(x for t, bad in baskets if bad for x in t)
    level = [frozenset([x]) for x, n in tokens.items() if n >= least]
    found = []
    while level:
        grown = []
        for rule in level:
            hits = [bad for t, bad in baskets if rule <= t]
            if sum(hits) >= least:
                grown.append(rule)
                if sum(hits) / len(hits) >= confidence and sum(hits) / len(hits) / share >= lift:
                    found.append(rule)
        have = set(grown)
        level = {a | b for a, b in combinations(grown, 2) if len(a | b) == len(a) + 1}
        level = [x for x in level if all(x - {y} in have for y in x)]
    return found


def damaged(rows):
    """Rows (conv, turn, role, text) after the damage, and all conversations."""
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def repaired(turns):
    """Figures, edits and digest of one conversation's rows (turn, role, text), by trying whole strings."""
    def by_digest(row):
        turn, role, text = row
        whole = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
        return (turn is not None, turn or 0, role, whole)

    turns = sorted(turns, key=by_digest)
    known = [t for t, _, _ in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    seen, faults = set(), []
    for _, role, text in turns:
        core = text.strip(" \t\n\x0b\x0c\r")
        faults.append("b" if not core else "d" if (role, text) in seen else "t" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [role[:1] for _, role, _ in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    keep = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def offer(cells, state, entry):
        if state not in cells or entry[:2] < cells[state][:2]:
            cells[state] = entry

    def put(cells):
        for _ in range(4):
            for state, (cost, audit, made) in list(cells.items()):
                role = "assistant" if state == 2 else "user"
                offer(cells, 3 if state == 2 else 2, (cost + 5, audit + "I", (*made, role + ":")))

    cells = {0: (0, "", ())}
    put(cells)
    for (_, role, text), fault in zip(turns, faults):
        after = {}
        for state, (cost, audit, made) in cells.items():
            offer(after, state, (cost + 2, audit + "D", made))
            if fault in "bd" and fault:
                continue
            more = 5 if fault == "t" else 0
            name, following = ("assistant", 3) if state == 2 else ("user", 2)
            offer(after, following, (cost + 1 + more, audit + "R", (*made, f"{name}:{text}")))
            if (state, role[:1]) in keep:
                offer(after, keep[state, role[:1]], (cost + more, audit + "K", (*made, f"{role}:{text}")))
        put(after)
        cells = after
    cost, audit, made = min(cells[x] for x in (0, 3) if x in cells)
    digest = hashlib.sha256("\n".join(made).encode()).hexdigest()
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest)
