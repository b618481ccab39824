"""Ranked lexical search by NRA: sequential reads of impact-sorted postings, intervals of scores, no random access.

Documents become rows of term numbers and counts, and these are read in shards of bounded size. In a shard each
term's postings are sorted by impact; an item reads its terms' lists side by side, in blocks that double. What has
been read of a document is the lower end of its score's interval, and for a term not met with it yet the list's next
impact is added for the upper end. Once no unread document can reach the tenth best lower end, only documents whose
upper end still does are followed, until each of their intervals is a point: then membership, ties and scores are
settled. A hash share of the documents is searched first; its tenth score of an item is a floor for all other
shards, which so give back few rows. What is left of all shards is ranked by item in Spark.

Items are taken in blocks of bounded size, each with its own vocabulary, against all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from radpref.llm.common import cut, drop, slices, small_batches, text_or_empty
from radpref.llm.decontamination import words_of

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class SearchParams:
    """``block_bytes``: text of the items that are searched for at once (sent to every task). ``postings``: of one shard, a document counting as 32 more.
    ``first_read``: postings of each list that are read at first. ``floor_share``: one document in so many is searched first."""

    top: int = 10
    block_bytes: int = 16 << 20
    postings: int = 1 << 21
    first_read: int = 64
    floor_share: int = 32


class Interval:
    """One item's reads in a shard of ``docs`` documents: lists of (document, gain), gains falling, none of them 0."""

    def __init__(self, lists: list[tuple[np.ndarray, np.ndarray]], docs: int, p: SearchParams):
        self.lists, self.docs, self.p = lists, docs, p
        self.reads = 0

    def best(self, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the highest scores, and these, of ``floor`` at least: all that may be among the first ``top``."""
        lists, top = self.lists, self.p.top
        lower, known = np.zeros(self.docs, np.int64), np.zeros((len(lists), self.docs), bool)
        at, step, need = [0] * len(lists), self.p.first_read, max(floor, 1)
        where = followed = None  # once no other document can enter
        while True:
            for t, (doc, gain) in enumerate(lists):
                d, g = doc[at[t] : at[t] + step], gain[at[t] : at[t] + step]
                at[t] = min(at[t] + step, len(doc))
                self.reads += len(d)
                if where is not None:
                    d = where[d]
                    d, g = d[d >= 0], g[d >= 0]
                lower[d] += g
                known[t, d] = True
            bound = np.array([gain[a] if a < len(gain) else 0 for (_, gain), a in zip(lists, at, strict=True)], np.int64)
            step *= 2
            if len(lower) >= top:
                need = max(need, int(np.partition(lower, len(lower) - top)[len(lower) - top]))
            if where is None and bound.sum() >= need:
                continue
            upper = lower.copy()
            for t in np.flatnonzero(bound):
                upper[~known[t]] += bound[t]
            stay = np.flatnonzero((upper >= need) & (lower > 0))
            if followed is None:
                followed = stay
            else:
                followed = followed[stay]
            lower, known, upper = lower[stay], known[:, stay], upper[stay]
            if (upper == lower).all():
                return followed, lower
            where = np.full(self.docs, -1, np.int64)
            where[followed] = np.arange(len(followed))


def postings(docs: DataFrame, vocabulary) -> DataFrame:
    """``doc_id, n, terms, counts`` of all documents: number of all terms; numbers (4 bytes each) of those of the vocabulary and how often they occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(vocabulary.value)}
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                size, terms, counts = [], [], []
                for t in part.column("text"):
                    words = words_of(t.as_buffer().to_pybytes())
                    of = np.fromiter((k for k in map(number.get, words) if k is not None), np.int32)
                    term, count = np.unique(of, return_counts=True)
                    size.append(len(words))
                    terms.append(term.tobytes())
                    counts.append(count.astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(size, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())], names=["doc_id", "n", "terms", "counts"])

    return docs.mapInArrow(run, "doc_id long, n long, terms binary, counts binary")


def holding(index: DataFrame) -> DataFrame:
    """``term, df``: in how many documents each term number stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(0, np.int64)
        for batch in batches:
            more = np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int32))
            if len(more) > len(df):
                df, more = more, df
            df[: len(more)] += more
        term = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.int32()), pa.array(df[term], pa.int64())], names=["term", "df"])

    return index.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))


def impacts(n: np.ndarray, doc: np.ndarray, count: np.ndarray, total_docs: int, total_terms: int) -> np.ndarray:
    wide = n.astype(object) if len(n) and 90 * int(n.max()) * total_docs >= 1 << 62 else n
    m = (100 - 90 + (90 * wide * total_docs) // total_terms).astype(np.int64)
    return (1_000_000_000 * count) // (1000 * count + 8 * m[doc])


def search(index: DataFrame, model, p: SearchParams) -> DataFrame:
    """``item, doc_id, score``: of each shard of the index, what may be among an item's first ones."""

    def found(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        weight, items, floors, total_docs, total_terms = model.value
        t = pa.Table.from_batches(parts)
        ids = t.column("doc_id").to_numpy()
        term = np.frombuffer(b"".join(t.column("terms").to_pylist()), np.int32)
        count = np.frombuffer(b"".join(t.column("counts").to_pylist()), np.int32).astype(np.int64)
        doc = np.repeat(np.arange(len(ids)), [len(x) // 4 for x in t.column("terms").to_pylist()])
        gain = weight[term] * impacts(t.column("n").to_numpy(), doc, count, total_docs, total_terms)
        use = gain > 0
        term, doc, gain = term[use], doc[use], gain[use]
        order = np.lexsort((-gain, term))
        term, doc, gain = term[order], doc[order], gain[order]
        ends = np.searchsorted(term, np.arange(len(weight) + 1))
        out: list[list[np.ndarray]] = [[], [], []]
        for k, (of, floor) in enumerate(zip(items, floors, strict=True)):
            lists = [(doc[ends[x] : ends[x + 1]], gain[ends[x] : ends[x + 1]]) for x in of if ends[x] < ends[x + 1]]
            if not lists:
                continue
            who, score = Interval(lists, len(ids), p).best(int(floor))
            pick = np.lexsort((ids[who], -score))[: p.top]  # an id that is null has become NaN and stands last
            for column, values in zip(out, (np.full(len(pick), k), who[pick], score[pick]), strict=True):
                column.append(values)
        item, who, score = (np.concatenate([np.zeros(0, np.int64), *c]).astype(np.int64) for c in out)
        return pa.RecordBatch.from_arrays([pa.array(item), t.column("doc_id").combine_chunks().take(pa.array(who)), pa.array(score)], names=["item", "doc_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, parts = 0, []
        for batch in batches:
            parts.append(batch)
            have += 32 * batch.num_rows + batch.column("terms").nbytes // 4
            if have >= p.postings:
                yield found(parts)
                have, parts = 0, []
        if parts:
            yield found(parts)

    return index.mapInArrow(run, "item long, doc_id long, score long")


def ranked(found: DataFrame, item: str, top: int) -> DataFrame:
    order = Window.partitionBy(item).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, terms``: the distinct terms of each item; rows that share an id are one item, those without an id too."""
    lowered = F.translate(text_or_empty(), _UPPER, _LOWER)
    each = items.select("item_id", F.explode(F.array_distinct(F.regexp_extract_all(lowered, F.lit(_TERM), F.lit(0)))).alias("term"))
    return each.groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def _search_block(docs: DataFrame, block: list, id_type: str, p: SearchParams) -> DataFrame:
    spark = docs.sparkSession
    words = sorted({t for row in block for t in row["terms"]})
    number = {t: i for i, t in enumerate(words)}
    items = [np.array([number[t] for t in row["terms"]], np.int64) for row in block]
    vocabulary = spark.sparkContext.broadcast([t.encode() for t in words])
    index = cut(postings(docs, vocabulary), "postings")
    vocabulary.destroy()
    total = index.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    weight = np.zeros(len(words), np.int64)
    for row in holding(index).collect():  # one row a term of the block
        weight[row["term"]] = math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * row["df"] + 1)))
    floors = np.ones(len(items), np.int64)
    share = index.where((F.pmod(F.xxhash64("doc_id"), F.lit(p.floor_share)) == 0) & (F.col("n") > 0))
    for part in (share, index.where("n > 0")):
        model = spark.sparkContext.broadcast((weight, items, floors.copy(), total["docs"], max(total["terms"], 1)))
        found = cut(search(part, model, p), "found")
        model.destroy()
        if part is share:
            for row in ranked(found, "item", p.top).where(F.col("rank") == p.top).collect():  # one row an item of the block
                floors[row["item"]] = row["score"]
            drop(found)
    drop(index)
    names = spark.createDataFrame([(k, row["item_id"]) for k, row in enumerate(block)], f"item long, item_id {id_type}")
    return found.join(F.broadcast(names), "item").select("item_id", "doc_id", "score")


def lexical_search(docs: DataFrame, items: DataFrame, p: SearchParams = SearchParams()) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's highest-scoring documents, of equal scores those of lower ids.

    Texts that are null have no terms; an item without terms, or whose terms stand nowhere, has no rows. Rows that share
    an ``item_id`` are one item, as are those of none. Each row of the documents is ranked on its own, repeated ids too;
    a null ``doc_id`` stands last among equal scores. Further columns of either table are left alone. Nothing is found
    in an empty table.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    terms = cut(item_terms(items), "item-terms")
    size = terms.agg(F.coalesce(F.sum(F.octet_length(F.concat_ws(" ", "terms"))), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // p.block_bytes))
    out = None
    for k in range(blocks):
        block = terms.where(F.pmod(F.xxhash64("item_id", F.lit(3)), F.lit(blocks)) == k).orderBy("item_id").collect()
        found = _search_block(docs, block, terms.schema["item_id"].dataType.simpleString(), p)
        out = found if out is None else out.unionAll(found)
    return ranked(out, "item_id", p.top).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
