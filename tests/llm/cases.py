"""Hand-made documents and plain-Python versions of the text operators."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(4_000))
BASE = " ".join(f"word{i} tail{i % 7}" for i in range(60))


def awkward() -> list[tuple]:
    """Nulls, empty and very long texts, ties, repeated rows, odd white space and characters."""
    texts = [
        None, "", " \t\n", "one", "two words", BASE, BASE, BASE.replace(" ", "\n", 3), BASE + " more", BASE.upper(), LONG,
        LONG + " end", "a b c d e " * 40, "x" * 900, "é" * 450 + "z" * 450, "line\nline\nline\n", "İ ß ﬁ á ​ tail",
        "a\x1cb c\xa0d <|endoftext|> e  f\n\n g", "\U0001f600 emoji \U0001f600",
        "It was the best of times and it was the worst of times, so they said to all who came by on the road.",
    ]
    rows = [(i, t, "en", None if i % 5 == 0 else f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return [*rows, rows[5], rows[5], rows[10], (4, "the same id again", "en", "s1", 17)]


def clashing(df, *names):
    """``df`` with further columns named like those that an operator makes."""
    return df.selectExpr("*", *[f"'own' AS {n}" for n in names])


def words(text):
    return WORD.findall(text or "")


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = words(text)
    n = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {k for i in range(len(w) - 4) if n[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def shingles(text, size):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or {tuple(w)}


def jaccard_components(docs, size, percent):
    """(n_shingles, component) of each (doc_id, text); doc_ids are distinct."""
    sets = {i: shingles(t, size) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    shared = Counter(p for h in holders.values() for p in combinations(sorted(h), 2))
    for (a, b), k in shared.items():
        if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in sets}


def repeated_spans(docs, length):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) of each (doc_id, text), as a list of rows."""
    raw = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(b[k : k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone, end = bytearray(len(b)), 0
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                for j in range(max(k, end), k + length):
                    gone[j] = 1
                end = k + length
        rest = bytes(x for x, g in zip(b, gone) if not g)
        spans = len(re.findall(b"\x01+", bytes(gone)))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out
