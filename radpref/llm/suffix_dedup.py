"""Long repeated passages by a logarithmic family of sparse suffix arrays.

Of the suffixes of all texts only sampled ones are indexed: every stretch of ``length`` bytes holds the
start of one, chosen by what the stretch holds (its lowest hash of ``gram`` bytes, the first of equals), so
equal stretches choose alike wherever they stand. An entry keeps its suffix's first ``gram`` bytes, as
numbers that order like them, and a 128-bit digest of all the stretches that chose it and of its place in
them: entries alike in both are the same passage throughout.

Documents come in batches. A batch's entries are sorted together with those of a standing level into one
suffix array, dealt out by ranges of bytes, so that one passage may fill any number of tasks. The scan
compares each entry with its neighbours alone: those alike throughout are repeated, and of those that
share first bytes but not all the rest one of each kind is noted. Levels of equal rank merge with the
batch into one of the next, so an entry is rewritten once per doubling; higher levels are scanned with
the batch and stay.

The kinds noted are then compared on both sides of their anchors. The stretches of an entry are dealt to
cores, bytes that some neighbouring stretches have in common; cores go into a sorted array of their own,
where one without an equal neighbour rules its stretches out. Stretches left are arrayed once more, whole:
neighbours that are equal there repeat each other. Every step makes rows in proportion to its input.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radpref.llm.common import cut, drop, small_batches, text_or_empty
from radpref.llm.near_dedup import mixed


@dataclass(frozen=True)
class SuffixParams:
    """``batches``: in how many batches a whole table arrives. ``rows``: entries of a sorted array in one task.

    ``core``: as many neighbouring stretches share a core. ``length`` is at most ``gram`` + 254.
    """

    length: int = 200
    gram: int = 32
    batches: int = 4
    core: int = 24
    rows: int = 500_000
    chunk: int = 1 << 20


_R = 0x9E3779B97F4A7C15
_R_INVERSE = pow(_R, -1, 1 << 64)


class Rolling:
    """Hashes of all grams of a byte string: polynomials modulo 2 ** 64, then mixed. They only choose anchors."""

    powers = inverses = np.zeros(0, np.uint64)

    def __init__(self, raw: np.ndarray):
        if len(raw) >= len(Rolling.powers):
            n = len(raw) + 1 + (1 << 16)
            Rolling.powers, Rolling.inverses = (np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, r, np.uint64)))) for r in (_R, _R_INVERSE))
        self.total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.powers[: len(raw)], out=self.total[1:])

    def every(self, n: int) -> np.ndarray:
        """Of each stretch of n bytes."""
        k = max(0, len(self.total) - n)
        return mixed((self.total[n : n + k] - self.total[:k]) * self.inverses[:k])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def ordered_longs(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes, eight to a number, as signed numbers that order as the bytes do."""
    return (rows.view(">u8").astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)


def digests(raw: memoryview, start: np.ndarray, end: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """128 bits of each slice, two numbers a row."""
    of = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([of(raw[a:b], s) for a, b, s in zip(start.tolist(), end.tolist(), seed.tolist(), strict=True)]), np.int64).reshape(-1, 2)


def entries(texts: list[bytes], p: SuffixParams) -> tuple[np.ndarray, ...]:
    """Of all texts: which text, its first stretch's start, number of stretches, anchor, first bytes, digest."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    joined = b"".join(texts)
    raw = np.frombuffer(joined, np.uint8)
    none = np.zeros(0, np.int64)
    if len(raw) < p.length:
        return none, none, none, none, none.reshape(0, 4), none.reshape(0, 2)
    gram = Rolling(raw).every(p.gram)
    low = np.uint64((1 << 24) - 1)
    best = sliding_min((gram & ~low) | np.arange(len(gram), dtype=np.uint64), p.length - p.gram + 1) & low
    end = np.cumsum(size)
    room = np.maximum(size - p.length + 1, 0)  # stretches within each text
    which = np.repeat(np.arange(len(texts)), room)
    first = np.cumsum(room) - room
    at = np.arange(len(which)) - first[which] + (end - size)[which]
    if not len(at):
        return none, none, none, none, none.reshape(0, 4), none.reshape(0, 2)
    chosen = best[at].astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (which[1:] != which[:-1]))))
    count = np.diff(np.append(new, len(at)))
    start, anchor = at[new], chosen[new]
    longs = ordered_longs(np.ascontiguousarray(raw[anchor[:, None] + np.arange(p.gram)]))
    whole = digests(memoryview(joined), start, start + count - 1 + p.length, anchor - start)
    begin = (end - size)[which[new]]
    return which[new], start - begin, count, anchor - begin, longs, whole


def pieces(texts: list[bytes], p: SuffixParams) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in runs of about ``chunk`` bytes: whose they are, where they start in it. Longer ones are cut with an overlap."""
    who, start, part, size = [], [], [], 0
    for i, t in enumerate(texts):
        for a in range(0, max(1, len(t) - p.length + 1), p.chunk):
            part.append(t[a : a + p.chunk + p.length - 1] if len(t) > p.chunk else t)
            who.append(i)
            start.append(a)
            size += len(part[-1])
            if size >= p.chunk:
                yield who, start, part
                who, start, part, size = [], [], [], 0
            if len(t) <= p.chunk:
                break
    if part:
        yield who, start, part


_BYTES = ["k1", "k2", "k3", "k4"]
_WHOLE = ["w1", "w2"]
_CORE = ["c1", "c2"]
#: ``place`` packs what is said of an entry in its text: first stretch, how far behind it the anchor is, number of stretches, known to be repeated.
_PLACE = ["doc_id", "place"]


def packed(start: np.ndarray, anchor: np.ndarray, count: np.ndarray) -> np.ndarray:
    return (start << 17) | ((anchor - start) << 9) | (count << 1)


def unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    start = place >> 17
    return start, start + ((place >> 9) & 255), (place >> 1) & 255


def _interval(length: int) -> list[Column]:
    start, count = F.shiftright("place", 17), F.shiftright("place", 1).bitwiseAND(F.lit(255))
    return [start.alias("a"), (start + count - 1 + length).alias("b")]


def _frame(columns: list[str]) -> str:
    return ", ".join(f"{c} long" for c in columns)


def _batch(columns: list[str], values: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(v), pa.int64()) for v in values], names=columns)


def sampled_suffixes(docs: DataFrame, p: SuffixParams) -> DataFrame:
    """A batch's entries, in no order. Written down."""
    names = [*_BYTES, *_WHOLE, *_PLACE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.array(batch.column("doc_id").to_pylist(), np.int64)
            for who, offset, part in pieces([t.as_buffer().to_pybytes() for t in batch.column("text")], p):
                which, start, count, anchor, longs, whole = entries(part, p)
                base = np.array(offset, np.int64)[which]
                yield _batch(names, [*longs.T, *whole.T, ids[np.array(who)][which], packed(start + base, anchor + base, count)])

    return cut(docs.mapInArrow(run, _frame(names)), "suffixes")


# --- sorted arrays and the scan of neighbours ---


def scanned(rows: DataFrame, first: list[str], rest: list[str], name: str, p: SuffixParams, keep: bool = False) -> DataFrame:
    """``rows`` as one array sorted by ``first``, then ``rest``, then place, with what its neighbours say of each row.

    Adds ``twin`` (a neighbour has the same ``first`` and ``rest``), ``lead`` (the first of those alike) and
    ``several`` (rows of the same ``first`` differ in ``rest``). The array is dealt out by ranges and
    written down; what rows at the ends of tasks need to know of each other is two rows a task. Unless all
    rows are to be kept, those without a new mark (new twins, leads of several) go.
    """
    names, n_key, n_first = [*first, *rest, *_PLACE], len(first) + len(rest), len(first)
    rows = rows.select(*names)
    tasks = max(1, math.ceil(rows.count() / p.rows), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        whole = pa.Table.from_batches(batches)
        key = [whole.column(k).to_numpy() for k in range(n_key)]
        n = whole.num_rows
        same = np.ones(n - 1, bool)
        for c in key[:n_first]:
            same &= c[1:] == c[:-1]
        alike = same.copy()
        for c in key[n_first:]:
            alike &= c[1:] == c[:-1]
        lead = np.concatenate(([True], ~alike))
        run_of = np.cumsum(np.concatenate(([True], ~same))) - 1
        several = (np.bincount(run_of, lead) > 1)[run_of]
        twin = ~lead | np.concatenate((alike, [False]))
        ends = np.zeros(n, np.int8)
        ends[0] += 1
        ends[-1] += 2
        part = np.full(n, TaskContext.get().partitionId(), np.int32)
        for column, values in zip(("twin", "lead", "several", "ends", "part"), (twin, lead, several, ends, part), strict=True):
            whole = whole.append_column(column, pa.array(values))
        if not keep:
            new = twin & (whole.column("place").to_numpy() & 1 == 0)
            whole = whole.filter(pa.array(new | (lead & several) | (ends > 0) | (lead & (run_of == run_of[-1]))))
        yield from whole.to_batches(max_chunksize=50_000)

    schema = rows.schema.add("twin", "boolean").add("lead", "boolean").add("several", "boolean").add("ends", "byte").add("part", "integer")
    array = cut(rows.repartitionByRange(tasks, *names).sortWithinPartitions(*names).mapInArrow(run, schema), name)
    return _across_tasks(array, names, first, rest)


def _across_tasks(array: DataFrame, names: list[str], first: list[str], rest: list[str]) -> DataFrame:
    """Mend the marks of rows whose like stand in the next or the last task, too."""
    edges = array.where("ends > 0").select("part", "ends", "several", *first, *rest).collect()  # two rows a task
    several: dict[tuple, bool] = {}
    spread: dict[tuple, int] = {}
    last = None
    for r in sorted(edges, key=lambda r: (r["part"], r["ends"])):
        g, w = tuple(r[c] for c in first), tuple(r[c] for c in rest)
        if r["ends"] & 1 and last and last[0] == g:
            several[g] = several.get(g, False) or last[2] or r["several"] or last[1] != w
            if last[1] == w:
                spread.setdefault(g + w, last[3])
        elif g in several:
            several[g] |= r["several"]
        if r["ends"] & 2:
            last = (g, w, r["several"], r["part"])
    spark = array.sparkSession
    if several:
        types = ", ".join(f"{c} long" for c in first)
        known = spark.createDataFrame([(*g, s) for g, s in several.items()], f"{types}, over_several boolean")
        array = array.join(F.broadcast(known), first, "left").withColumn("several", F.col("several") | F.coalesce("over_several", F.lit(False)))
    if spread:
        types = ", ".join(f"{c} long" for c in [*first, *rest])
        known = spark.createDataFrame([(*k, part) for k, part in spread.items()], f"{types}, from_part int")
        array = array.join(F.broadcast(known), [*first, *rest], "left")
        array = array.withColumns({"twin": F.col("twin") | F.col("from_part").isNotNull(), "lead": F.col("lead") & (F.coalesce("from_part", "part") == F.col("part"))})
    return array.select(*names, "twin", "lead", "several")


# --- the family of levels ---


class SuffixIndex:
    """Takes batch after batch of documents: ``doc_id`` (unique over all batches), ``text`` (bytes).

    ``levels``: the standing arrays by rank. ``repeated``: entries found to be repeated throughout; ``noted``: one of each kind of
    those that only share first bytes with others; both grow with every batch.
    """

    def __init__(self, p: SuffixParams = SuffixParams()):
        self.p, self.levels = p, {}
        self.repeated: list[DataFrame] = []
        self.noted: list[DataFrame] = []

    def add(self, docs: DataFrame) -> None:
        batch = sampled_suffixes(docs, self.p)
        rank, merging = 0, []
        while rank in self.levels:
            merging.append(self.levels.pop(rank))
            rank += 1
        for level in self.levels.values():
            drop(self._scan(batch.unionByName(level)))
        both = batch
        for level in merging:
            both = both.unionByName(level)
        array = self._scan(both, keep=True)
        for old in (batch, *merging):
            drop(old)
        self.levels[rank] = array.select(*_BYTES, *_WHOLE, "doc_id", F.col("place").bitwiseOR(F.col("twin").cast("long")).alias("place"))

    def _scan(self, rows: DataFrame, keep: bool = False) -> DataFrame:
        array = scanned(rows, _BYTES, _WHOLE, "suffix-array", self.p, keep)
        self.repeated.append(cut(array.where("twin and place % 2 = 0").select(*_PLACE), "repeated"))
        self.noted.append(cut(array.where("lead and several").select("doc_id", (F.col("place") - F.col("place") % 2).alias("place")), "noted"))
        return array

    def intervals(self, docs: DataFrame) -> DataFrame:
        """``doc_id, a, b``: byte intervals that together cover every repeated stretch of all batches, ``docs``."""
        return _union(self.repeated).select("doc_id", *_interval(self.p.length)).unionAll(compare(docs, _union(self.noted).distinct(), self.p))

    def close(self) -> None:
        for level in self.levels.values():
            drop(level)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionAll(f)
    return out


# --- comparison on both sides of the anchors ---


def dealt(docs: DataFrame, noted: DataFrame, width: int, p: SuffixParams) -> DataFrame:
    """``c1, c2, doc_id, place``: the stretches of ``noted``, those of ``width`` neighbouring places before their anchor to
    a row, with a digest of the bytes that all stretches of these places share. Of width 1: each stretch whole."""
    wanted = noted.groupBy("doc_id").agg(F.collect_list("place").alias("places"))
    both = docs.join(wanted, "doc_id").select("doc_id", "text", "places")
    length, names = p.length, [*_CORE, *_PLACE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t, places in zip(*(batch.column(c) for c in ("doc_id", "text", "places")), strict=True):
                start, anchor, count = unpacked(places.values.to_numpy())
                low, high = (anchor - start - count + 1) // width, (anchor - start) // width  # of the places before the anchor
                each = high - low + 1
                who = np.repeat(np.arange(len(start)), each)
                k = np.arange(len(who)) - np.repeat(np.cumsum(each) - each, each) + low[who]
                begin = np.maximum(start[who], anchor[who] - (k + 1) * width + 1)
                finish = np.minimum(start[who] + count[who] - 1, anchor[who] - k * width)
                core = digests(memoryview(t.as_buffer()), anchor[who] - k * width, anchor[who] - (k + 1) * width + 1 + length, k)
                yield _batch(names, [*core.T, np.full(len(who), i.as_py(), np.int64), packed(begin, anchor[who], finish - begin + 1)])

    return cut(both.mapInArrow(run, _frame(names)), "cores")


def compare(docs: DataFrame, noted: DataFrame, p: SuffixParams) -> DataFrame:
    """Intervals ``doc_id, a, b`` of the stretches of ``noted`` that also stand at another place of it."""
    cores = dealt(docs, noted, p.core, p)
    shared = scanned(cores, _CORE, [], "core-array", p).where("twin").select(*_PLACE)
    drop(cores)
    stretches = dealt(docs, shared, 1, p)
    found = scanned(stretches, _CORE, [], "stretch-array", p).where("twin").select("doc_id", *_interval(p.length))
    drop(stretches)
    return found


def repeated_intervals(docs: DataFrame, p: SuffixParams) -> DataFrame:
    """``doc_id, a, b``: byte intervals that together cover every repeated stretch. The table arrives in ``batches``."""
    index = SuffixIndex(p)
    for b in range(p.batches):
        index.add(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(p.batches)) == b))
    index.close()
    return index.intervals(docs)


def suffix_dedup(docs: DataFrame, p: SuffixParams = SuffixParams()) -> DataFrame:
    """Take every byte out that a stretch of ``length`` bytes covers which also starts anywhere else.

    Returns ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``. A null text is empty. Rows that repeat an
    id are documents of their own (copies of each other if their texts are equal), and so are rows of no id.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    ids = docs.select("doc_id")
    if not ids.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null").isEmpty():
        # number the rows; the numbers are written down with them
        rows = cut(docs.withColumn("row", F.monotonically_increasing_id()), "rows")
        found = suffix_dedup(rows.select(F.col("row").alias("doc_id"), "text"), p)
        return found.withColumnRenamed("doc_id", "row").join(rows.select("row", "doc_id"), "row").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    marks = repeated_intervals(docs, p).groupBy("doc_id").agg(F.collect_list("a").alias("a"), F.collect_list("b").alias("b"))
    both = docs.join(marks, "doc_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, a, b in zip(*(batch.column(c) for c in ("text", "a", "b")), strict=True):
                text = t.as_buffer()
                starts, ends = merged_intervals(a.values.to_numpy(), b.values.to_numpy()) if a.is_valid else ([], [])
                kept, at = hashlib.sha256(), 0
                for x, y in zip(starts, ends, strict=True):
                    kept.update(text[at:x])
                    at = y
                kept.update(text[at:])
                out.append((len(text), sum(ends) - sum(starts), len(starts), kept.hexdigest()))
            cols = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return both.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def merged_intervals(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """The union of intervals as disjoint ones that do not touch, in order."""
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    new = np.flatnonzero(a[1:] > b[:-1]) + 1
    return a[np.concatenate(([0], new))].tolist(), b[np.concatenate((new - 1, [len(b) - 1]))].tolist()
