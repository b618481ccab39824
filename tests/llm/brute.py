"""The contracts of the registered queries in plain Python, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def shingles(text: str | None, k: int) -> frozenset:
    ws = WORD.findall(lower(text or ""))
    return frozenset(tuple(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1))) if ws else frozenset()


def near(docs: list[tuple[int, str | None]], k: int) -> dict[int, tuple]:
    """doc_id -> (n_shingles, component_id, kept), from all pairs that share a shingle."""
    sets = {i: shingles(t, k) for i, t in docs}
    top = {i: i for i in sets}

    def find(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    by: dict[frozenset, list[int]] = defaultdict(list)
    for i in sorted(sets):
        if sets[i]:
            by[sets[i]].append(i)
    for group in by.values():
        for i in group[1:]:
            top[find(i)] = find(group[0])
    holders: dict[tuple, list[int]] = defaultdict(list)
    for s, group in by.items():
        for g in s:
            holders[g].append(group[0])
    for s, group in by.items():
        a = group[0]
        shared = Counter(b for g in s for b in holders[g] if b > a)
        for b, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[b]) - n) and find(a) != find(b):
                top[find(b)] = find(a)
    least: dict[int, int] = {}
    for i in sorted(sets):
        least.setdefault(find(i), i)
    return {i: (len(s), least[find(i)], least[find(i)] == i) for i, s in sets.items()}


def decontaminated(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]], window: int = 10) -> dict[int, tuple]:
    """doc_id -> (n_words, n_hit, n_items, items_sha256, contaminated)."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows: dict[tuple, set[int]] = defaultdict(set)
    for i, t in items:
        ws = word.findall(lower(t or ""))
        for k in range(max(1, len(ws) - window + 1)) if ws and i is not None else ():
            windows[tuple(ws[k : k + window])].add(i)
    sizes = {len(w) for w in windows}
    out = {}
    for i, t in docs:
        ws, hit, found = word.findall(lower(t or "")), set(), set()
        for n in sizes:
            for k in range(len(ws) - n + 1):
                if (w := tuple(ws[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[w]
        out[i] = (len(ws), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit))
    return out


def quality(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    ws = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    count = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    hit = {k for i in range(len(ws) - 7) if count[tuple(ws[i : i + 8])] > 1 for k in range(i, i + 8)}
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), len(ws) < 20 or 100 * len(hit) > 30 * len(ws))


def unigrams(docs: list[tuple[int, str | None]]) -> dict[int, tuple]:
    """doc_id -> (held_out, n_tokens, n_known, train_tokens, base_score)."""
    end = object()
    tokens = {i: [*WORD.findall(lower(t or "")), end] for i, t in docs}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    c = Counter(w for i, ws in tokens.items() if not out[i] for w in ws)
    n, v = sum(c.values()), len(c)
    return {i: (out[i], len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in tokens.items()}


def targets(docs: list[tuple[int, str | None, str | None]]) -> tuple[dict, dict, dict]:
    """Sizes by doc_id; source sizes and targets by source."""
    size = {i: len(WORD.findall(t or "")) for i, t, _ in docs}
    of: dict = defaultdict(int)
    for i, _, s in docs:
        of[s] += size[i]
    names = sorted(of, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, free, out = 1.5 * sum(of.values()), set(names), {}
    while free:
        w = sum(weight[s] for s in free)
        full = {s for s in free if left * weight[s] / w > 2 * of[s]}
        if not full:
            out |= {s: left * weight[s] / w for s in free}
            break
        for s in full:
            out[s] = 2.0 * of[s]
        left -= sum(out[s] for s in full)
        free -= full
    return size, dict(of), out


def repeats(docs: list[tuple[int, str | None]], length: int = 200) -> dict[int, tuple]:
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256)."""
    raw = {i: (t or "").encode() for i, t in docs}
    count = Counter(b[k : k + length] for b in raw.values() for k in range(len(b) - length + 1))
    out = {}
    for i, b in raw.items():
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(gone[k] and (k == 0 or not gone[k - 1]) for k in range(len(b)))
        out[i] = (len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def private(text: str | None) -> tuple:
    """(n_email, n_ip, n_card, n_phone, base_sha256, spans)."""
    text = text or ""
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    ]
    spans = [(k, m.start(), m.end()) for k, pattern, ok in kinds for m in re.finditer(pattern, text) if ok(m[0])]
    names = [f"{k}:{a}:{b}" for k, a, b in spans]
    n = Counter(k for k, _, _ in spans)
    return (n["email"], n["ip"], n["card"], n["phone"], sha(",".join(names)), names)
