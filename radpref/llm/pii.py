"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes beside them.

The field is trained from a small labelled table, written by hand, and from snippets of the documents, by
gradient steps on the exact likelihood (forward-backward), and decoded by Viterbi, both in numpy over many
sequences at once. It finds spellings that the patterns miss (numbers without their plus sign, blanks around an at sign, cards grouped by dots).
What it finds must also pass the kind's own test (checksum, ranges, digits) and overlap no pattern's span.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radpref.llm.common import free_name, small_batches, text_or_empty, thinned
from radpref.llm.labelled import personal_examples

KINDS = ("email", "ip", "card", "phone")
#: O, then a first and an inner state of each kind.
STATES = 1 + 2 * len(KINDS)
Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]+")
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\S")
_DIGIT = re.compile(r"[0-9]")


@dataclass(frozen=True)
class PiiParams:
    """At most ``max_docs`` documents of ``max_bytes`` or less, of some twenty times as many looked through, make labelled snippets.

    The examples by hand count ``examples`` times each.
    """

    max_docs: int = 600
    max_bytes: int = 60_000
    examples: int = 20
    reach: int = 32
    longest: int = 96
    epochs: int = 40
    rate: float = 0.15
    decay: float = 1e-3
    seed: int = 11


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(int("0246813579"[int(d)]) for d in even)) % 10 == 0


def valid(kind: str, found: str) -> bool:
    """Whether a find of some kind passes that kind's own test."""
    digits = "".join(_DIGIT.findall(found))
    if kind == "email":
        local, at, domain = "".join(found.split()).partition("@")
        return bool(local and at and _DOMAIN.fullmatch(domain)) and _LOCAL.issuperset(local)
    if kind == "ip":
        parts = found.split(".")
        return len(parts) == 4 and all(x.isascii() and x.isdigit() and int(x[-4:]) <= 255 and len(x.lstrip("0")) < 4 for x in parts)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, at sign, dotted domain; every character is looked at a few times at most."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            floor = m.end()
        at = text.find("@", max(at + 1, floor))


def candidates(text: str) -> list[Span]:
    """All matches of the patterns, tested or not, by kind and place."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
            out += [(kind, m.start(), m.end()) for m in pattern.finditer(text)]
    return out


def base_spans(text: str) -> list[Span]:
    return [(k, a, b) for k, a, b in candidates(text) if k == "email" or valid(k, text[a:b])]


# --- tokens, shapes and sequences ---

_PUNCTUATION = "@.-+(),:;/_#%*&$=\"'|!?<>[]"
_DIGITS = 12  # classes of runs of digits, by length and size
_LETTERS = 8
#: One shape for each class of digits, letters, punctuation mark and other; one past either end; each twice, with white space before it or not.
SHAPES = 2 * (_DIGITS + _LETTERS + len(_PUNCTUATION) + 2)


def shape(token: str, glued: bool) -> int:
    n = len(token)
    if token.isascii() and token.isdigit():
        k = (n - 1 if n > 3 or int(token) <= 255 else 9) if n <= 4 else 4 if n <= 7 else 5 if n <= 9 else 6 if n <= 15 else 7 if n <= 19 else 8
    elif token.isalpha():
        case = 0 if token.islower() else 1 if token.isupper() else 2 if token.istitle() else 3
        k = _DIGITS + 2 * case + (n > 3)
    else:
        k = _DIGITS + _LETTERS + (_PUNCTUATION.index(token) if token in _PUNCTUATION else len(_PUNCTUATION))
    return 2 * k + glued


_EDGE = SHAPES - 1


def sequences(text: str, p: PiiParams) -> Iterator[tuple[list[int], list[int], list[int]]]:
    """Runs of tokens around digits and at signs: starts, ends, shapes.

    Nothing of the kinds is without such a token, so the rest of a text is not decoded. Runs of more than
    ``longest`` tokens are cut, at a word without one if they can.
    """
    spans: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - p.reach), min(len(text), m.end() + p.reach)
        if spans and a <= spans[-1][1]:
            spans[-1][1] = b
        else:
            spans.append([a, b])
    for a, b in spans:
        tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text, a, b)]
        at = 0
        while at < len(tokens):
            cut = len(tokens) - at
            if cut > p.longest:
                cut = next((k for k in range(p.longest, p.longest // 2, -1) if text[slice(*tokens[at + k])].isalpha()), p.longest)
            part = tokens[at : at + cut]
            at += cut
            shapes = [shape(text[s:e], k > 0 and part[k - 1][1] == s) for k, (s, e) in enumerate(part)]
            yield [s for s, _ in part], [e for _, e in part], shapes


def tags(starts: list[int], ends: list[int], spans: list[Span]) -> list[int]:
    out = [0] * len(starts)
    for kind, a, b in spans:
        first = True
        for k, (s, e) in enumerate(zip(starts, ends, strict=True)):
            if a <= s and e <= b:
                out[k] = 1 + 2 * KINDS.index(kind) + (not first)
                first = False
    return out


def spans_of(path: np.ndarray, starts: list[int], ends: list[int]) -> list[Span]:
    out: list[Span] = []
    for k, state in enumerate(path):
        if state and state % 2:
            out.append((KINDS[(state - 1) // 2], starts[k], ends[k]))
        elif state and out and k and path[k - 1] and (path[k - 1] - 1) // 2 == (state - 1) // 2:
            out[-1] = (*out[-1][:2], ends[k])
    return out


# --- the field ---


def padded(shapes: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    length = np.array([len(s) for s in shapes])
    out = np.full((len(shapes), int(length.max()) + 4), _EDGE)
    for row, s in zip(out, shapes, strict=True):
        row[2 : 2 + len(s)] = s
    return out, length


def _sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + np.squeeze(top, axis)


class ShapeField:
    """Scores of states by the shapes at five places, by two neighbouring pairs of shapes, and of transitions."""

    def __init__(self) -> None:
        self.single = np.zeros((5, SHAPES, STATES))
        self.pair = np.zeros((2, SHAPES * SHAPES, STATES))
        self.move = np.zeros((STATES, STATES))
        self.start = np.zeros(STATES)

    @staticmethod
    def pairs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, 1:-3] * SHAPES + x[:, 2:-2], x[:, 2:-2] * SHAPES + x[:, 3:-1]

    def emissions(self, x: np.ndarray) -> np.ndarray:
        t = x.shape[1] - 4
        return sum(self.single[k][x[:, k : k + t]] for k in range(5)) + sum(self.pair[k][q] for k, q in enumerate(self.pairs(x)))

    def viterbi(self, shapes: list[list[int]]) -> list[np.ndarray]:
        """Best states of each sequence. All are walked at once; shorter ones stay where they ended."""
        x, length = padded(shapes)
        e = self.emissions(x)
        score, back = self.start + e[:, 0], []
        for t in range(1, e.shape[1]):
            step = score[:, :, None] + self.move
            best = step.argmax(1)
            live = (t < length)[:, None]
            back.append(np.where(live, best, np.arange(STATES)))
            score = np.where(live, np.take_along_axis(step, best[:, None], 1)[:, 0] + e[:, t], score)
        state = score.argmax(1)
        path = [state]
        for b in reversed(back):
            state = np.take_along_axis(b, state[:, None], 1)[:, 0]
            path.append(state)
        path = np.stack(path[::-1], 1)
        return [row[:n] for row, n in zip(path, length, strict=True)]

    def likelihood(self, x: np.ndarray, length: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean log likelihood of the states y, and its gradient."""
        n, t = y.shape
        e = self.emissions(x)
        live = np.arange(t) < length[:, None]
        alpha, beta = np.zeros((n, t, STATES)), np.zeros((n, t, STATES))
        alpha[:, 0] = self.start + e[:, 0]
        for k in range(1, t):
            alpha[:, k] = np.where(live[:, k, None], _sum(alpha[:, k - 1, :, None] + self.move, 1) + e[:, k], alpha[:, k - 1])
        for k in range(t - 2, -1, -1):
            beta[:, k] = np.where(live[:, k + 1, None], _sum(self.move + (e[:, k + 1] + beta[:, k + 1])[:, None, :], 2), beta[:, k + 1])
        whole = _sum(alpha[:, -1], 1)
        each = np.exp(alpha + beta - whole[:, None, None])
        rows, cols = np.nonzero(live)
        diff = -each[rows, cols]
        diff[np.arange(len(rows)), y[rows, cols]] += 1
        single, pair = np.zeros_like(self.single), np.zeros_like(self.pair)
        for s in range(STATES):
            for k in range(5):
                single[k][:, s] = np.bincount(x[rows, cols + k], diff[:, s], SHAPES)
            for k, q in enumerate(self.pairs(x)):
                pair[k][:, s] = np.bincount(q[rows, cols], diff[:, s], SHAPES * SHAPES)
        move = np.zeros_like(self.move)
        value = float((self.start[y[:, 0]] - whole).sum() + np.take_along_axis(e, y[:, :, None], 2)[:, :, 0][live].sum())
        for k in range(1, t):
            on = live[:, k]
            move -= np.exp(alpha[on, k - 1, :, None] + self.move + (e[on, k] + beta[on, k])[:, None, :] - whole[on, None, None]).sum(0)
            np.add.at(move, (y[on, k - 1], y[on, k]), 1)
            value += float(self.move[y[on, k - 1], y[on, k]].sum())
        start = np.bincount(y[:, 0], minlength=STATES) - each[:, 0].sum(0)
        return value / n, [g / n for g in (single, pair, move, start)]


def train(rows: list[tuple[str, list[Span]]], p: PiiParams = PiiParams()) -> ShapeField:
    """Fit to labelled texts by Adam. Without any, the field finds nothing."""
    field = ShapeField()
    shapes, truth = [], []
    for text, spans in rows:
        for starts, ends, s in sequences(text, p):
            shapes.append(s)
            truth.append(tags(starts, ends, spans))
    if not shapes:
        field.start[0] = field.move[0, 0] = 1.0
        return field
    x, length = padded(shapes)
    y = np.zeros((len(truth), x.shape[1] - 4), np.int64)
    for row, s in zip(y, truth, strict=True):
        row[: len(s)] = s
    params = [field.single, field.pair, field.move, field.start]
    first, second = [np.zeros_like(a) for a in params], [np.zeros_like(a) for a in params]
    for epoch in range(1, p.epochs + 1):
        _, grads = field.likelihood(x, length, y)
        for a, g, m, v in zip(params, grads, first, second, strict=True):
            g = g - p.decay * a
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            a += p.rate * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-6)
    return field


def variants(text: str, spans: list[Span]) -> Iterator[tuple[str, list[Span]]]:
    """A labelled text, and copies of it in which one span is spelt as the patterns would not have it."""
    yield text, spans
    for kind, a, b in spans:
        old = text[a:b]
        new = {"phone": old[1:], "email": old.replace("@", " @ "), "card": re.sub(r"[\x20-]?([0-9]{4})", r".\1", old).lstrip("."), "ip": old}[kind]
        if new != old:
            moved = [(q, x + (len(new) - len(old)) * (x > a), y + (len(new) - len(old)) * (y > a)) for q, x, y in spans]
            yield text[:a] + new + text[b:], moved


def labelled_table(docs: DataFrame, p: PiiParams = PiiParams()) -> list[tuple[str, list[Span]]]:
    """The examples by hand, and snippets of a bounded sample of the documents that hold digits or at signs, labelled by the patterns.

    Spans are labelled by form alone, whether or not they pass their kind's test; overlapping ones by the first kind.
    """
    some = thinned(docs, 10 * p.max_docs, p.seed, "doc_id").where(F.col("text").rlike("[0-9@]") & (F.octet_length("text") <= p.max_bytes)).select("text")
    rows = some.orderBy(F.xxhash64("text", F.lit(p.seed)), "text").limit(p.max_docs).collect()
    out = personal_examples() * p.examples
    for r in rows:
        text, spans = r["text"], []
        for s in candidates(text):
            size = len(_DIGIT.findall(text[s[1] : s[2]]))
            if s[0] == "card" and not 16 <= size <= 19 or any(s[1] < b and a < s[2] for _, a, b in spans):
                continue
            spans.append(s)
        for starts, ends, _ in sequences(text, p):
            a, b = starts[0], ends[-1]
            out.extend(variants(text[a:b], [(k, x - a, y - a) for k, x, y in spans if a <= x and y <= b]))
    return out


def disjoint(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of the union of some spans, in order."""
    starts: list[int] = []
    ends: list[int] = []
    for a, b in sorted((a, b) for _, a, b in spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def overlaps(covered: tuple[list[int], list[int]], a: int, b: int) -> bool:
    starts, ends = covered
    k = bisect_left(starts, b) - 1  # the last that starts before b
    return k >= 0 and ends[k] > a


def all_spans(texts: list[str], field: ShapeField, p: PiiParams) -> tuple[list[list[Span]], list[list[Span]]]:
    """Of each text the patterns' spans, and the field's others."""
    base = [base_spans(t) for t in texts]
    covered = [disjoint(b) for b in base]
    work = [(i, *s) for i, t in enumerate(texts) for s in sequences(t, p)]
    more: list[list[Span]] = [[] for _ in texts]
    work.sort(key=lambda w: len(w[1]))
    for k in range(0, len(work), 512):
        part = work[k : k + 512]
        for (i, starts, ends, _), path in zip(part, field.viterbi([w[3] for w in part]), strict=True):
            for kind, a, b in spans_of(path, starts, ends) if path.any() else ():
                if valid(kind, texts[i][a:b]) and not overlaps(covered[i], a, b):  # the field's own never overlap
                    more[i].append((kind, a, b))
    return base, more


def spelt(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


def find_pii(docs: DataFrame, field: ShapeField, p: PiiParams = PiiParams()) -> DataFrame:
    """``docs`` with ``base`` and ``added``: spans as ``kind:start:end`` in code points, end exclusive. Columns of these names are replaced."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(field)
    kept = docs.drop("base", "added")
    names = [*kept.columns, "base", "added"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, more = all_spans(batch.column(batch.num_columns - 1).to_pylist(), shared.value, p)
            cols = [pa.array([spelt(s) for s in x], pa.string()) for x in (base, more)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *cols], names=names)

    out = kept.schema.add("base", "string").add("added", "string")
    return kept.withColumn(free_name("pii_text", kept.columns), text_or_empty()).mapInArrow(run, out)


def pii(docs: DataFrame, p: PiiParams = PiiParams()) -> DataFrame:
    """``doc_id``, counts of the patterns' spans by kind, their digest, all spans, and how many were added.

    A null text is an empty one, without spans. Repeated rows are read one by one. A table without digits
    and at signs trains a field that finds nothing.
    """
    found = find_pii(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), train(labelled_table(docs, p), p), p)
    each = F.filter(F.split("base", ","), lambda s: s != "")
    every = F.filter(F.concat(F.split("base", ","), F.split("added", ",")), lambda s: s != "")
    place = lambda s: F.struct(F.array_position(F.lit(list(KINDS)), F.substring_index(s, ":", 1)).alias("k"), F.substring_index(F.substring_index(s, ":", 2), ":", -1).cast("long").alias("a"), s.alias("s"))
    n = [F.size(F.filter(each, _starts(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    spans = F.array_join(F.transform(F.array_sort(F.transform(every, place)), lambda x: x["s"]), ",")
    added = F.size(F.filter(F.split("added", ","), lambda s: s != "")).cast("long")
    return found.select("doc_id", *n, F.sha2("base", 256).alias("base_sha256"), spans.alias("spans"), added.alias("n_added"))


def _starts(kind: str):
    return lambda s: s.startswith(f"{kind}:")
