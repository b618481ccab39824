"""Benchmark decontamination: a prefix-filtered join of item windows against whole documents.

Each item gives windows of ten consecutive words, and a window a set of shingles of five. A window can only
occur where each of its shingles does, so one is enough to look for: the rarest, by its count over all
documents. It is the window's prefix. Where a document has a prefix, the window's place is fixed; it must lie
between the document's ends (length and position bounds), and what stands there is joined, word for word,
with the windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from radpref.llm.common import cut, free_name, slices, small_batches, text_or_empty, with_rows
from radpref.llm.near_dedup import mixed

WINDOW, SHINGLE = 10, 5
#: So many shingles, of eight bytes each, may be sent to every task to sift with. Of a larger benchmark nothing is sent: documents
#: are counted, and joined with the windows, without sifting them first.
MAX_SENT = 1 << 21
#: Bytes of letters and digits; A-Z become a-z; all others separate words. Bytes from 0x80 on are letters.
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) else 32 for b in range(256))
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_WORD_CACHE = 250_000


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class WordHashes:
    """Hashes of words, kept up to a bound, and of all shingles of some words."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        new = set(words).difference(known)
        if len(known) + len(new) > _WORD_CACHE:
            known.clear()
            new = set(words)
        for w in new:
            known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    @staticmethod
    def shingles(h: np.ndarray, k: int) -> np.ndarray:
        n = max(0, len(h) - k + 1)
        out = np.full(n, k, np.uint64)
        for i in range(k):
            out = mixed(out * _GOLD + h[i : i + n])
        return out.view(np.int64)


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """``item_id, window`` (words with a blank between), ``n`` (of words), ``shingles`` (hashes): all windows of all items. Written down."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for item, t in zip(batch.column("item_id"), batch.column("text"), strict=True):
                words = words_of(t.as_buffer().to_pybytes())
                n = min(window, len(words))
                if not n:
                    continue
                k = min(SHINGLE, n)
                s = WordHashes.shingles(hashes(words), k)
                starts = range(len(words) - n + 1)
                for a in range(0, len(starts), 10_000):
                    some = starts[a : a + 10_000]
                    lists = [s[i : i + n - k + 1] for i in some]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item.as_py()] * len(some), pa.int64()), pa.array([b" ".join(words[i : i + n]) for i in some], pa.binary()), pa.array([n] * len(some), pa.int32()), pa.array(lists, pa.list_(pa.int64()))],
                        names=["item_id", "window", "n", "shingles"],
                    )

    rows = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
    return cut(rows.mapInArrow(run, "item_id long, window binary, n int, shingles array<long>"), "item-windows")


def shingle_counts(docs: DataFrame, sizes: list[int], sift: np.ndarray | None) -> DataFrame:
    """``shingle, c``: how often shingles of some sizes stand in all documents; only those of ``sift`` (sorted), if given."""
    shared = docs.sparkSession.sparkContext.broadcast(sift)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, wanted = WordHashes(), shared.value
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                found = [np.zeros(0, np.int64)]
                for t in part.column("text"):
                    h = hashes(words_of(t.as_buffer().to_pybytes()))
                    for k in sizes:
                        s = WordHashes.shingles(h, k)
                        found.append(s if wanted is None else s[among(s, wanted)])
                key, c = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(c, pa.int64())], names=["shingle", "c"])

    return docs.select("text").mapInArrow(run, "shingle long, c long").groupBy("shingle").agg(F.sum("c").alias("c"))


def among(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which of x stand in a sorted array."""
    if not len(ordered):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)
    return ordered[at] == x


def prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """``shingle, p, n``: the rarest shingle of each window (the first of equals), its place in it, and the window's size."""
    each = windows.select("window", "n", F.posexplode("shingles").alias("p", "shingle"))
    known = each.join(counts, "shingle", "left").select("window", "n", F.struct(F.coalesce("c", F.lit(0)).alias("c"), "p", "shingle").alias("s"))
    best = known.groupBy("window").agg(F.min("s").alias("s"), F.first("n").alias("n"))
    return best.select("s.shingle", "s.p", "n").distinct()


def candidates(docs: DataFrame, sizes: list[int], window_sizes: list[int], sent: tuple[np.ndarray, ...] | None) -> DataFrame:
    """``row, start, n, window``: what stands in documents where a window could; and a row without ``window`` for each document,
    whose ``n`` is its number of words. Written down.

    ``sent``: prefixes by shingle (sorted), their places and the sizes of their windows; None: windows of
    all sizes anywhere are candidates.
    """
    shared = docs.sparkSession.sparkContext.broadcast(sent)

    def places(h: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if shared.value is None:
            for n in window_sizes:
                start = np.arange(max(0, len(h) - n + 1))
                yield start, np.full(len(start), n)
            return
        shingle, place, size = shared.value
        for k in sizes:
            s = WordHashes.shingles(h, k)
            low = np.searchsorted(shingle, s)
            at = np.flatnonzero((low < len(shingle)) & (shingle[np.minimum(low, len(shingle) - 1)] == s))
            low, high = low[at], np.searchsorted(shingle, s[at], "right")
            which = np.repeat(low - (np.cumsum(high - low) - (high - low)), high - low) + np.arange(int((high - low).sum()))
            start, n = np.repeat(at, high - low) - place[which], size[which]
            fits = (start >= 0) & (start + n <= len(h)) & (np.minimum(n, SHINGLE) == k)
            yield start[fits], n[fits]

    names, types = ["row", "start", "n", "window"], (pa.int64(), pa.int64(), pa.int64(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        out: tuple[list, ...] = ([], [], [], [])
        for batch in batches:
            for row, t in zip(batch.column("row").to_pylist(), batch.column("text"), strict=True):
                words = words_of(t.as_buffer().to_pybytes())
                found = [np.unique(np.stack(x), axis=1) for x in places(hashes(words)) if len(x[0])] if words else []
                start, n = np.concatenate(found, 1).tolist() if found else ([], [])
                for i in range(0, max(1, len(start)), 10_000):
                    a, b = start[i : i + 10_000], n[i : i + 10_000]
                    rows = ([row] * len(a), a, b, [b" ".join(words[x : x + k]) for x, k in zip(a, b, strict=True)])
                    for column, values in zip(out, rows, strict=True):
                        column.extend(values)
                    if len(out[0]) >= 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types, strict=True)], names=names)
                        out = ([], [], [], [])
                for column, value in zip(out, (row, None, len(words), None), strict=True):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types, strict=True)], names=names)

    return cut(docs.select("row", "text").mapInArrow(run, "row long, start long, n long, window binary"), "candidates")


def _sent(df: DataFrame, by: str, most: int) -> list[np.ndarray] | None:
    """A frame's columns as arrays in order of one of them; None if it has more than ``most`` rows."""
    if df.count() > most:
        return None
    table = df.toArrow()
    order = np.argsort(table[by].to_numpy(), kind="stable")
    return [table[c].to_numpy()[order] for c in df.columns]


def find_windows(rows: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_sent: int = MAX_SENT) -> DataFrame:
    """``row, n_words, hit_spans, item_ids`` of all ``rows``: ``row`` (a number of its own), ``text`` (bytes)."""
    every = item_windows(benchmark, window)
    windows = cut(every.groupBy("window").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles")), "windows")  # equal windows, equal values
    window_sizes = [r[0] for r in windows.select("n").distinct().collect()]  # at most ``window`` rows
    sizes = sorted({min(SHINGLE, n) for n in window_sizes})
    sift = _sent(windows.select(F.explode("shingles").alias("shingle")).distinct(), "shingle", max_sent)
    counts = shingle_counts(rows, sizes, sift[0] if sift else None)
    first = cut(prefixes(windows, counts), "prefixes")
    found = candidates(rows, sizes, window_sizes, _sent(first, "shingle", max_sent))
    hits = cut(found.where("window is not null").join(windows.select("window"), "window").select("row", "start", (F.col("start") + F.col("n")).alias("end"), "window"), "hits")
    order = Window.partitionBy("row").orderBy("start", "end")
    places = hits.select("row", "start", "end").distinct().withColumn("reach", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    runs = places.withColumn("run", F.count_if(F.coalesce(F.col("start") > F.col("reach"), F.lit(True))).over(order))
    spans = runs.groupBy("row", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    spans = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("hit_spans"))
    items = hits.select("row", "window").distinct().join(every.select("window", "item_id").distinct(), "window").select("row", "item_id").distinct()
    items = items.groupBy("row").agg(F.array_sort(F.collect_list("item_id")).alias("item_ids"))
    out = found.where("window is null").select("row", F.col("n").alias("n_words")).join(spans, "row", "left").join(items, "row", "left")
    none = {"hit_spans": F.array().cast("array<struct<start: bigint, end: bigint>>"), "item_ids": F.array().cast("array<bigint>")}
    return out.select("row", "n_words", *[F.coalesce(F.col(k), v).alias(k) for k, v in none.items()])


def _rows(docs: DataFrame, row: str) -> tuple[DataFrame, DataFrame]:
    """Documents with a number of their own; and just numbers and texts."""
    small_batches(docs.sparkSession)
    rows = with_rows(docs, row, "decontaminate-rows")
    return rows, rows.select(F.col(row).alias("row"), text_or_empty().cast("binary").alias("text"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_sent: int = MAX_SENT) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (runs of hit words: first, and the one after the last) and ``item_ids``.

    Null or empty texts have no words and no hits, items without words no windows, and items of fewer
    words than a window one window of them all. Items that share an id count as one; items of no id are
    left out. Repeated rows are looked through one by one. Columns named like the new ones are replaced; others
    stay, whatever their names.
    """
    docs = docs.drop("n_words", "hit_spans", "item_ids")
    row = free_name("decontaminate_row", docs.columns)
    rows, texts = _rows(docs, row)
    found = find_windows(texts, benchmark, window, max_sent).withColumnRenamed("row", free_name("found_row", [*docs.columns, row]))
    return rows.join(found, F.col(row) == F.col(found.columns[0])).drop(row, found.columns[0])


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document."""
    rows, texts = _rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "row")
    found = rows.select("row", "doc_id").join(find_windows(texts, benchmark, window), "row")
    names = F.array_join(F.array_sort(F.transform("item_ids", lambda x: x.cast("string"))), ",")
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.withColumn("n_hit", n_hit).select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
