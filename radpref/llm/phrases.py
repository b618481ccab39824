"""Phrase collocations: direct-address counting of pairs by tiles, repeated for longer phrases.

Words are ranked by frequency in each language and become numbers. Neighbours are pairs of numbers, and the square of
all pairs is cut into tiles: a tile that is full enough is counted by ``bincount`` over its cells, all others as sorted
coordinates. The pairs that are frequent are ranked in turn, and phrases of three words are pairs of such a number and
a word's, phrases of four likewise. Tasks add up their own counts before anything is shuffled.

Only the ``head`` most frequent words, and phrases of a length, are sent to tasks. A frequent one beyond them is known
by a 64-bit hash instead: a task tells from a bit map of such hashes, of fixed size, that it may be frequent, and what
the map lets through wrongly is dropped with its true count. So no phrase is lost, however many there are.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from radpref.llm.common import cut, drop, slices, small_batches, text_or_empty
from radpref.llm.near_dedup import mixed

#: A-Z become a-z, tabs blanks, and what ends a piece a full stop, which no word can hold.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 46 if b in b".,;:!?" or 10 <= b <= 13 else 32 if b == 9 else b for b in range(256))
_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: Numbers from here on are hashes.
_HASHED = np.uint64(1 << 63)


@dataclass(frozen=True)
class PhraseParams:
    """``head``: words, and phrases of a length, that are sent to tasks, of 64 bytes each at most. ``map_bits``: of the map of the
    others' hashes. ``tile``: side of a tile; ``full``: how many of its cells a batch must fill to be counted by ``bincount``.
    ``hold``: distinct coordinates that a task keeps before it hands them on."""

    longest: int = 4
    least: int = 30
    percent: int = 80
    top: int = 2000
    head: int = 1 << 19
    map_bits: int = 1 << 22
    tile: int = 256
    full: float = 0.05
    hold: int = 1 << 21


def pieces(text: bytes) -> list[bytes]:
    """The words of a text, and a full stop wherever a piece ends."""
    return text.translate(_FOLD).replace(b".", b" . ").split()


def hashed(u: np.ndarray, x: np.ndarray) -> np.ndarray:
    return mixed(mixed(u + _GOLD) * _GOLD + x) | _HASHED


def hashed_word(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) | 1 << 63


class Head:
    """What tasks know of one language's frequent phrases of a length: sorted (unit, word) pairs with ranks."""

    def __init__(self, unit: np.ndarray, word: np.ndarray):
        key = hashed(unit, word)
        self.order = np.argsort(key)
        self.key = key[self.order]

    def ranks(self, key: np.ndarray) -> np.ndarray:
        """Ranks from 1, 0 where a key is none of the head's."""
        if not len(self.key):
            return np.zeros(len(key), np.uint64)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.order[at] + 1, 0).astype(np.uint64)


def may_be(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether the map has the keys' bits."""
    place = key & np.uint64(len(bits) * 64 - 1)
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def units(seq: np.ndarray, heads: list[Head], maps: list[np.ndarray]) -> np.ndarray:
    """Numbers of the frequent phrases that begin at each word, as long as the heads say; 0: none. ``seq``: words' numbers, 0 ends a piece."""
    u = seq
    for k, (head, bits) in enumerate(zip(heads, maps, strict=True)):
        n = len(seq) - k - 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        x, whole = seq[k + 1 :], (u[:n] > 0) & (u[1 : n + 1] > 0)
        key = hashed(u[:n], x)
        rank = head.ranks(key)
        u = np.where(whole, np.where(rank > 0, rank, np.where(may_be(bits, key), key, np.uint64(0))), np.uint64(0))
    return u


class Counts:
    """Counts of (unit, word) pairs of one language in one task."""

    def __init__(self, p: PhraseParams):
        self.p, self.tiles = p, {}
        self.sparse: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, u: np.ndarray, x: np.ndarray) -> None:
        side = self.p.tile
        if not len(u):
            return
        small = (u < _HASHED) & (x < _HASHED)
        if not small.all():
            self._coordinates(u[~small], x[~small])
        if not small.any():
            return
        a, b = u[small].astype(np.int64), x[small].astype(np.int64)
        tile = (a // side) << 32 | b // side
        order = np.argsort(tile, kind="stable")
        a, b, tile = a[order], b[order], tile[order]
        at, start = np.unique(tile, return_index=True)
        ends = np.append(start[1:], len(tile))
        loose = []
        for t, i, j in zip(at, start, ends, strict=True):
            if t in self.tiles or (j - i >= self.p.full * side * side and (len(self.tiles) + 1) * side * side <= self.p.hold):
                cells = np.bincount(a[i:j] % side * side + b[i:j] % side, minlength=side * side)
                self.tiles[t] = self.tiles[t] + cells if t in self.tiles else cells
            else:
                loose.append((i, j))
        if loose:
            a, b = (np.concatenate([v[i:j] for i, j in loose]).astype(np.uint64) for v in (a, b))
            self._coordinates(a, b)

    def _coordinates(self, u: np.ndarray, x: np.ndarray, n: np.ndarray | None = None) -> None:
        order = np.lexsort((x, u))
        u, x = u[order], x[order]
        first = np.flatnonzero(np.r_[True, (u[1:] != u[:-1]) | (x[1:] != x[:-1])])
        n = np.diff(np.append(first, len(u))) if n is None else np.add.reduceat(n[order], first)
        self.sparse.append((u[first], x[first], n))
        self.held += len(first)

    def full(self) -> bool:
        """Adds up what is held; whether it is still too much."""
        if self.held >= self.p.hold:
            u, x, n = (np.concatenate(c) for c in zip(*self.sparse, strict=True))
            self.sparse, self.held = [], 0
            self._coordinates(u, x, n)
        return self.held >= self.p.hold // 2

    def take(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        side = self.p.tile
        parts = list(self.sparse)
        for t, cells in self.tiles.items():
            at = np.flatnonzero(cells)
            parts.append((((t >> 32) * side + at // side).astype(np.uint64), ((t & 0xFFFFFFFF) * side + at % side).astype(np.uint64), cells[at]))
        self.tiles, self.sparse, self.held = {}, [], 0
        none = np.zeros(0, np.uint64)
        return tuple(np.concatenate([none if k < 2 else np.zeros(0, np.int64), *(x[k] for x in parts)]) for k in range(3))


def word_counts(docs: DataFrame, p: PhraseParams) -> DataFrame:
    """``lang, phrase, f``: all words and how often they occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[str, dict[bytes, int]] = defaultdict(lambda: defaultdict(int))
        held = 0

        def flush() -> pa.RecordBatch:
            rows = [(lang, w, n) for lang, of in count.items() for w, n in of.items()]
            count.clear()
            lang, word, n = zip(*rows, strict=True) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(word, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())], names=["lang", "phrase", "f"])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                of, words = count[lang], pieces(text.as_buffer().to_pybytes())
                before = len(of)
                for w in words:
                    of[w] += 1
                held += len(of) - before + sum(map(len, words)) // 64
                if held > p.hold:
                    of.pop(b".", None)
                    yield flush()
                    of, held = None, 0
        for of in count.values():
            of.pop(b".", None)
        yield flush()

    each = docs.mapInArrow(run, "lang string, phrase string, f long").where("phrase != '.'")
    return each.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def headed(level: DataFrame, head: int) -> DataFrame:
    """``level`` with the ``rank`` from 1, in its language, of its most frequent phrases, ``head`` at most in all; null for the others."""
    fits = level.where(F.octet_length("phrase") <= 64)
    steps = F.floor(F.log2("f") * 16).cast("int")
    by = sorted(fits.groupBy(steps.alias("step")).count().collect(), reverse=True)  # a row for each sixteenth of a doubling
    floor, have = None, 0
    for step, n in by:
        have += n
        if have > head:
            break
        floor = step
    if floor is None:
        return level.withColumn("rank", F.lit(None).cast("long"))
    top = (F.octet_length("phrase") <= 64) & (steps >= floor)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("f"), "phrase"))
    return level.where(top).withColumn("rank", rank.cast("long")).unionByName(level.where(~top).withColumn("rank", F.lit(None).cast("long")))


def bit_map(hashes: DataFrame, p: PhraseParams) -> np.ndarray:
    """A map of the bits of a column ``number`` of hashes; its size does not depend on their number."""
    bits = np.zeros(p.map_bits // 64, np.uint64)
    place = hashes.select(F.col("number").bitwiseAND(F.lit(p.map_bits - 1)).alias("place"))
    words = place.groupBy(F.shiftright("place", 6).cast("int").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
    for at, b in words.collect():  # map_bits / 64 rows at most
        bits[at] = np.array(b, np.int64).view(np.uint64)
    return bits


def encoded(docs: DataFrame, words: dict[str, dict[bytes, int]], bits: np.ndarray, p: PhraseParams) -> DataFrame:
    """``lang, seq, far``: words' numbers of each text, 4 bytes each; 0 ends a piece or is a rare word, and 0xFFFFFFFF stands for the next of ``far``'s hashes."""
    sent = docs.sparkSession.sparkContext.broadcast((words, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, bits = sent.value
        none = not bits.any()
        mask = len(bits) * 64 - 1
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                langs, seqs, fars = part.column("lang").to_pylist(), [], []
                for lang, text in zip(langs, part.column("text"), strict=True):
                    known, ws = words.get(lang, {}), pieces(text.as_buffer().to_pybytes())
                    far: list[int] = []
                    if none:
                        seq = np.fromiter(map(known.get, ws, repeat(0)), np.uint32, len(ws))
                    else:
                        seq = np.zeros(len(ws), np.uint32)
                        for i, w in enumerate(ws):
                            k = known.get(w)
                            if k is None and w != b".":
                                h = hashed_word(w)
                                place = h & mask
                                if int(bits[place >> 6]) >> (place & 63) & 1:
                                    k = 0xFFFFFFFF
                                    far.append(h)
                            seq[i] = k or 0
                    seqs.append(seq.tobytes())
                    fars.append(np.array(far, np.uint64).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(seqs, pa.binary()), pa.array(fars, pa.binary())], names=["lang", "seq", "far"])

    out = cut(docs.mapInArrow(run, "lang string, seq binary, far binary"), "encoded")
    sent.destroy()
    return out


def pair_counts(texts: DataFrame, heads: list[dict[str, Head]], maps: list[np.ndarray], p: PhraseParams) -> DataFrame:
    """``lang, unit, word, f``: how often each frequent phrase, one word longer than the heads' units are, may stand in the texts; counts under the least go."""
    sent = texts.sparkSession.sparkContext.broadcast((heads, maps))
    empty = Head(np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    names = ["lang", "unit", "word", "f"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, maps = sent.value
        counts: dict[str, Counts] = {}

        def rows(langs: list[str]) -> pa.RecordBatch:
            taken = [counts.pop(x).take() for x in langs]
            name = pa.array([x for x, t in zip(langs, taken, strict=True) for _ in range(len(t[0]))], pa.string())
            u, x, n = (np.concatenate([np.zeros(0, np.int64), *(t[k].view(np.int64) for t in taken)]) for k in range(3))
            return pa.RecordBatch.from_arrays([name, pa.array(u), pa.array(x), pa.array(n)], names=names)

        for batch in batches:
            of = defaultdict(list)
            for lang, seq, far in zip(*(batch.column(c).to_pylist() for c in ("lang", "seq", "far")), strict=True):
                words = np.frombuffer(seq, np.uint32).astype(np.uint64)
                if far:
                    words[words == 0xFFFFFFFF] = np.frombuffer(far, np.uint64)
                of[lang] += [words, np.zeros(1, np.uint64)]
            for lang, seqs in of.items():
                seq = np.concatenate(seqs)
                u = units(seq, [h.get(lang, empty) for h in heads], maps)
                k = len(heads) + 1
                n = len(seq) - k
                if n <= 0 or not len(u):
                    continue
                whole = np.flatnonzero((u[:n] > 0) & (u[1 : n + 1] > 0))
                c = counts.setdefault(lang, Counts(p))
                c.add(u[whole], seq[k:][whole])
                if c.full():
                    yield rows([lang])
            if len(counts) > 64:
                yield rows(list(counts))
        if counts:
            yield rows(list(counts))

    found = texts.mapInArrow(run, "lang string, unit long, word long, f long").groupBy("lang", "unit", "word").agg(F.sum("f").alias("f"))
    out = cut(found.where(F.col("f") >= p.least), "pairs")
    sent.destroy()
    return out


def frequent_phrases(docs: DataFrame, p: PhraseParams) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, k, f`` of all phrases of up to the longest length that occur often enough, and ``lang, n`` of all words."""
    counted = cut(word_counts(docs, p), "words")
    total = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    level = cut(_numbered_words(counted.where(F.col("f") >= p.least), p), "level")
    known: dict[str, dict[bytes, int]] = defaultdict(dict)
    for r in level.where("rank is not null").select("lang", "phrase", "rank").toLocalIterator():  # the head, of bounded size
        known[r["lang"]][r["phrase"].encode()] = r["rank"]
    texts = encoded(docs, dict(known), bit_map(level.where("rank is null"), p), p)
    words, levels = level.select("lang", F.col("number").alias("word"), F.col("phrase").alias("last")), [level]
    heads, maps = [], []
    for k in range(2, p.longest + 1):
        pairs = pair_counts(texts, heads, maps, p)
        named = pairs.join(level.select("lang", F.col("number").alias("unit"), "phrase"), ["lang", "unit"]).join(words, ["lang", "word"])
        named = named.select("lang", "unit", "word", F.concat_ws(" ", "phrase", "last").alias("phrase"), "f")
        level = cut(_numbered_pairs(headed(named, p.head)), "level")
        levels.append(level)
        if k < p.longest:
            top: dict[str, list] = defaultdict(list)
            for r in level.where("rank is not null").select("lang", "rank", "unit", "word").toLocalIterator():  # the head, of bounded size
                top[r["lang"]].append((r["rank"], r["unit"], r["word"]))
            heads.append({x: Head(*(np.array([r[c] for r in sorted(rows)], np.int64).view(np.uint64) for c in (1, 2))) for x, rows in top.items()})
            maps.append(bit_map(level.where("rank is null"), p))
    drop(texts)
    all_of = None
    for k, lv in enumerate(levels, 1):
        one = lv.select("lang", "phrase", F.lit(k).alias("k"), "f")
        all_of = one if all_of is None else all_of.unionAll(one)
    return all_of, total


def _hashing(df: DataFrame, made, schema: str) -> DataFrame:
    """``df`` with a column ``number``: the rank, or where it is null the hash that tasks know the row by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("rank").to_pylist()
            number = [r if r is not None else h for r, h in zip(rank, made(batch), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(number, pa.int64())], names=[*batch.schema.names, "number"])

    return df.mapInArrow(run, schema)


def _numbered_words(words: DataFrame, p: PhraseParams) -> DataFrame:
    signed = lambda b: [int(np.array(hashed_word(w.encode()), np.uint64).view(np.int64)) for w in b.column("phrase").to_pylist()]
    return _hashing(headed(words.select("lang", "phrase", "f"), p.head), signed, "lang string, phrase string, f long, rank long, number long")


def _numbered_pairs(level: DataFrame) -> DataFrame:
    def made(b: pa.RecordBatch) -> list[int]:
        u, x = (b.column(c).to_numpy().view(np.uint64) for c in ("unit", "word"))
        return hashed(u, x).view(np.int64).tolist()

    return _hashing(level.select("lang", "unit", "word", "phrase", "f", "rank"), made, "lang string, unit long, word long, phrase string, f long, rank long, number long")


def scored(phrases: DataFrame) -> DataFrame:
    """``lang, phrase, k, a, l, r, score`` of phrases of two words or more: of all cuts the one that scores lowest, of equal ones the first."""
    ws = F.split("phrase", " ", -1)
    cuts = phrases.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), ws.alias("ws")).withColumn("at", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select("lang", "phrase", "k", "a", "at", F.array_join(F.slice("ws", F.lit(1), F.col("at")), " ").alias("one"), F.array_join(F.slice("ws", F.col("at") + 1, F.col("k") - F.col("at")), " ").alias("rest"))
    of = lambda part, n: phrases.select("lang", F.col("phrase").alias(part), F.col("f").alias(n))
    cuts = cuts.join(of("one", "l"), ["lang", "one"]).join(of("rest", "r"), ["lang", "rest"])
    score = F.expr("cast(2000000 as decimal(8,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    cuts = cuts.withColumn("score", score)
    best = cuts.groupBy("lang", "phrase", "k", "a").agg(F.min(F.struct("score", "at", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "k", "a", "best.l", "best.r", "best.score")


def collocations(docs: DataFrame, p: PhraseParams = PhraseParams()) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's highest-scoring phrases.

    A null text has no words, a null language is ``und``. Rows are taken as they are, repeated ones and ones of no id too;
    ties in score and count go by the phrases' bytes. An empty table gives no rows; columns but ``text`` and ``lang`` are
    not read.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text_or_empty().cast("binary").alias("text"))
    phrases, total = frequent_phrases(docs, p)
    found = cut(scored(phrases), "scored")
    ws = F.split("phrase", " ", -1)
    parts = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda w: F.transform(F.sequence(F.lit(1), F.col("k") - w + 1), lambda i: F.array_join(F.slice(ws, i, w), " "))))
    inside = found.where("k > 2").select("lang", F.explode(F.array_distinct(parts)).alias("phrase"), F.col("a").alias("longer"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    much = F.col("longer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * p.percent
    kept = found.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~much)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= p.top)
    return best.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
