"""The contracts of search, joins and phrases in plain Python, for small tables."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

from brute import lower

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def search(docs: list[tuple], items: list[tuple], top: int = 10) -> dict:
    """item_id -> [(rank, doc_id, score)]"""
    count = [(i, Counter(TERM.findall(lower(t or "")))) for i, t in docs]
    count = [(i, c) for i, c in count if c]
    n_docs, n_terms = len(count), sum(sum(c.values()) for _, c in count)
    df = Counter(t for _, c in count for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(TERM.findall(lower(t or "")))
    out = {}
    for item, terms in asked.items():
        rows = []
        for i, c in count:
            m = 100 - 90 + 90 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if score > 0:
                rows.append((-score, i is None, i or 0, i))
        rows.sort()
        if rows:
            out[item] = [(k, r[3], -r[0]) for k, r in enumerate(rows[:top], 1)]
    return out


def phrases(rows: list[tuple], longest: int = 4, least: int = 30, percent: int = 80, top: int = 2000) -> list[tuple]:
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text)"""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                f[lang].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, count in f.items():
        rows = []
        cand = {w: a for w, a in count.items() if len(w) > 1 and a >= least}
        longer = defaultdict(int)
        for w, a in cand.items():
            for k in range(2, len(w)):
                for i in range(len(w) - k + 1):
                    longer[w[i : i + k]] = max(longer[w[i : i + k]], a)
        for w, a in cand.items():
            if w in longer and 100 * longer[w] >= percent * a:
                continue
            score, k = min((2000000 * a // (count[w[:k]] + count[w[k:]]), k) for k in range(1, len(w)))
            rows.append((-score, -a, " ".join(w).encode(), count[w[:k]], count[w[k:]]))
        rows.sort()
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(rows[:top], 1)]
    return sorted(out)
