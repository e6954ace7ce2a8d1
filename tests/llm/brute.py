"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import re
import zlib
from itertools import combinations

ODD_TEXTS = [
    (9001, None),
    (9002, ""),
    (9003, " \n\t "),
    (9004, "!!! ??"),
    (9005, "one"),
    (9006, "ünï cödé 漢字 😀 <|endoftext|> it's 1234 a  b\r\n\r\nx" * 3),
    (9007, "same words again and again " * 20_000),
    (9008, "a very plain text of exactly these few words"),
    (9008, "a very plain text of exactly these few words"),
    (9009, "a very plain text of exactly these few words"),
    (None, "a very plain text of exactly these few words"),
    (9010, "x" * 70_000),
]

LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
VISIBLE = re.compile(rb"[^\x20\x09-\x0D]+")


def low(text):
    return (text or "").encode().translate(LOWER)


def words(text):
    return WORD.findall(low(text))


def lm_tokens(text):
    return [*VISIBLE.findall(low(text)), None]


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def shingle_set(text, k=5):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


def near_classes(texts, threshold=0.8):
    """Smallest id of the component of each id, by plain Jaccard similarity over all pairs."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(texts), 2):
        same = texts[a] is not None and texts[a] == texts[b]
        if sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) >= threshold * max(len(sets[a]), len(sets[b])):
            same = same or len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])
        if same:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in texts}


def benchmark_hits(text, items, window=10):
    """(words, hit words, sorted item ids) of one text."""
    w, hit, found = words(text), set(), set()
    for name, other in items:
        o = words(other)
        for i in range(max(1, len(o) - window + 1) if o else 0):
            piece = o[i : i + window]
            for j in range(len(w) - len(piece) + 1):
                if w[j] == piece[0] and w[j : j + len(piece)] == piece:
                    hit.update(range(j, j + len(piece)))
                    found.add(str(name))
    return len(w), len(hit), sorted(found)


def without_repeats(texts, min_words=8):
    """Texts in order, each without units that occurred before, short ones with a neighbour, and the removed spans."""
    seen, out = set(), []
    for text in texts:
        kept, spans, at = [], [], 0
        for line in (text or "").split("\n"):
            parts = re.findall(r"[^.!?。！？]+[.!?。！？]*|[.!?。！？]+", line)
            plain = [tuple(low(p).split()) for p in parts]
            gone = [False] * len(parts)
            for i, own in enumerate(plain):
                if len(own) >= min_words:
                    gone[i] = gone[i] or own in seen
                    seen.add(own)
                pair = (own, plain[i + 1]) if i + 1 < len(plain) else ((), ())
                if all(pair) and min(map(len, pair)) < min_words:
                    for j in (i, i + 1):
                        gone[j] = gone[j] or (pair in seen and len(plain[j]) < min_words)
                    seen.add(pair)
            real = [g for g, p in zip(gone, plain) if p]
            if real and all(real):
                spans.append((at, at + len(line)))
            else:
                ends = [at + sum(map(len, parts[: i + 1])) for i in range(len(parts))]
                spans += [(e - len(p), e) for e, p, g in zip(ends, parts, gone) if g]
                kept.append("".join(p for p, g in zip(parts, gone) if not g))
            at += len(line) + 1
        out.append((None if text is None else "\n".join(kept), spans))
    return out


def rows_of(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
