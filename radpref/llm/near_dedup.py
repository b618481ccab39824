"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full sets, union-find.

SuperMinHash gives each element a random order of the signature's places, and offers place number j of that
order the value j plus a fraction. As one element's offers to different places have different whole parts,
they are correlated in the way that lowers the estimate's variance; and once every place holds a value below
j + 1, no later offer can win, so long documents stop after a step or two.

Documents of equal sets are one class from the start. Classes that share a band are candidates: first each
against the least one of its bucket, over a few bands, which settles groups of close copies; then over all
bands, where bucket and member are still apart; then, within each bucket that still holds several components,
all members against those that are not of its main component, in blocks of bounded size, buckets of equal
members once, and some bands after others, so that what is settled needs no more comparing. Pairs are
confirmed on their full sets throughout.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radpref.llm.common import cut, slices, small_batches, text_or_empty
from radpref.llm.components import components


@dataclass(frozen=True)
class NearParams:
    """Two documents of similarity 0.8 share no band once in 300,000 times (32 bands of 5 places).

    ``open_bands``: up to which band mixed buckets are worked through at a time. ``salts``: parts that a group's rows are dealt to
    while its blocks are counted out.
    """

    words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 5
    first_bands: int = 4
    block: int = 128
    block_shingles: int = 400_000
    open_bands: tuple[int, ...] = (8, 32)
    salts: int = 16


_GOLD, _M1, _M2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_WORD_CACHE = 250_000


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Distinct shingles of a text as sorted 64-bit hashes. Keeps the hashes of words seen, up to a bound."""

    def __init__(self, words: int):
        self.words, self.known = words, {}

    def __call__(self, text: bytes) -> np.ndarray:
        ws = text.lower().split()
        if not ws:
            return np.zeros(0, np.uint64)
        known = self.known
        new = [w for w in set(ws) if w not in known]
        if len(known) + len(new) > _WORD_CACHE:
            known.clear()
            new = set(ws)
        for w in new:
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws))
        k = min(self.words, len(h))  # fewer words: the whole sequence is the one shingle
        n = len(h) - k + 1
        out = np.full(n, k, np.uint64)
        for i in range(k):
            out = mixed(out * _GOLD + h[i : i + n])
        return np.unique(out)


def super_minhash(sets: list[np.ndarray], places: int) -> np.ndarray:
    """A row of ``places`` values for each non-empty set; places number 256 at most."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    doc = np.repeat(np.arange(len(sets)), size)
    h = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    sig = np.full(len(sets) * places, _EMPTY)
    order = None  # of the elements still at work: which place stands where
    for j in range(places):
        draw = mixed(h + np.uint64((j + 1) * int(_GOLD) % (1 << 64)))
        k = j + ((draw & np.uint64(0xFFFFFFFF)) % np.uint64(places - j)).astype(np.int64)
        if j == 0:
            place = k
        else:
            each = np.arange(len(h))
            place = order[each, k].astype(np.int64)
            order[each, k] = order[:, j]
        np.minimum.at(sig, doc * places + place, (draw >> np.uint64(32)) | np.uint64(j << 32))
        open_ = sig.reshape(-1, places).max(1) >= np.uint64((j + 1) << 32)
        stay = open_[doc]
        if not stay.any():
            break
        if j == 0:
            h, doc, k = h[stay], doc[stay], k[stay]
            order = np.tile(np.arange(places, dtype=np.uint8), (len(h), 1))
            order[np.arange(len(h)), k] = 0
        elif not stay.all():
            h, doc, order = h[stay], doc[stay], order[stay]
    return sig.reshape(-1, places)


def band_hashes(sig: np.ndarray, p: NearParams) -> np.ndarray:
    out = np.zeros((len(sig), p.bands), np.uint64)
    for i in range(p.rows):
        out = mixed(out * _GOLD + sig[:, i :: p.rows][:, : p.bands])
    return out


def sketches(docs: DataFrame, p: NearParams) -> DataFrame:
    """``doc_id, n, f1, f2, bands``: set size, 128-bit fingerprint of the set, band hashes. Written down."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(p.words)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                sets = [shingler(t.as_buffer().to_pybytes()) for t in part.column("text")]
                n = np.fromiter(map(len, sets), np.int64, len(sets))
                full = [s for s in sets if len(s)]
                bands = iter(band_hashes(super_minhash(full, p.bands * p.rows), p).view(np.int64))
                f1 = [int((mixed(s + _GOLD)).sum(dtype=np.uint64).view(np.int64)) for s in sets]
                f2 = [int((mixed(s ^ _M2)).sum(dtype=np.uint64).view(np.int64)) for s in sets]
                rows = [next(bands) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(rows, pa.list_(pa.int64()))], names=["doc_id", "n", "f1", "f2", "bands"])

    small_batches(docs.sparkSession)
    return cut(docs.mapInArrow(run, "doc_id long, n long, f1 long, f2 long, bands array<long>"), "sketches")


def shingle_sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``id, n, shingles`` (sorted hashes as bytes) of the documents in ``ids``. Written down."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            sets = [shingler(t.as_buffer().to_pybytes()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "n", "shingles"])

    asked = docs.join(ids.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
    return cut(asked.mapInArrow(run, "id long, n long, shingles binary"), "shingles")


def in_blocks(asked: DataFrame, p: NearParams) -> DataFrame:
    """``grp, q, m, id, comp, query``: groups dealt in blocks of so many rows, and so many shingles, a side, so that each query meets each member in one block."""
    count = lambda q: F.ceil(F.greatest(F.count_if(q) / p.block, F.sum(F.when(q, F.col("n")).otherwise(0)) / p.block_shingles, F.lit(1))).cast("int")
    blocks = asked.groupBy("grp").agg(count(F.col("query")).alias("qs"), count(~F.col("query")).alias("ms"))
    deal = lambda k: F.pmod(F.xxhash64("id"), F.col(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    salted = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(p.salts - 1))))
    rows = asked.withColumn("salt", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(p.salts)).cast("int")).join(salted, ["grp", "salt"]).drop("salt")
    queries = rows.where("query").withColumn("q", deal("qs")).withColumn("m", every("ms"))
    members = rows.where("not query").withColumn("m", deal("ms")).withColumn("q", every("qs"))
    return queries.unionByName(members).select("grp", "q", "m", "id", "comp", "query")


def confirm(asked: DataFrame, sets: DataFrame, p: NearParams) -> DataFrame:
    """Links ``a, b`` found in groups of ``asked``: ``grp, id, comp, n, query``.

    In each group, rows marked as queries are compared with all rows that aren't, and one link is kept for
    each query and component met.
    """
    dealt = in_blocks(asked, p).join(sets.select("id", "shingles"), "id")
    dealt = dealt.repartition("grp", "q", "m").sortWithinPartitions("grp", "q", "m")
    percent = p.percent

    def links(group: list[tuple]) -> Iterator[tuple[int, int]]:
        members = [(i, c, s) for i, c, s, q in group if not q]
        if not members:
            return
        ids, comps = np.array([m[0] for m in members]), np.array([m[1] for m in members])
        sizes = np.array([len(m[2]) for m in members])
        flat, at = np.concatenate([m[2] for m in members]), np.cumsum(sizes) - sizes
        for i, c, s in ((i, c, s) for i, c, s, q in group if q):
            near = np.minimum(sizes, len(s)) * 100 >= percent * np.maximum(sizes, len(s))
            near &= (comps != c) & (ids != i)
            if not near.any():
                continue
            pick = np.flatnonzero(near)
            own = flat if len(pick) * 2 > len(ids) else None
            if own is None:
                own = np.concatenate([members[k][2] for k in pick])
                start, size, who = np.cumsum(sizes[pick]) - sizes[pick], sizes[pick], pick
            else:
                start, size, who = at, sizes, np.arange(len(ids))
            where = np.minimum(np.searchsorted(s, own), len(s) - 1)
            shared = np.add.reduceat((s[where] == own).astype(np.int64), start)
            good = near[who] & (100 * shared >= percent * (size + len(s) - shared))
            _, one = np.unique(comps[who[good]], return_index=True)
            for k in who[good][one]:
                yield int(i), int(ids[k])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        key, group = None, []
        for batch in batches:
            found = []
            cols = [batch.column(c).to_pylist() for c in ("grp", "q", "m", "id", "comp", "query")]
            for g, q, m, i, c, query, s in zip(*cols, batch.column("shingles"), strict=True):
                if (g, q, m) != key:
                    found.extend(links(group))
                    key, group = (g, q, m), []
                group.append((i, c, np.frombuffer(s.as_buffer().to_pybytes(), np.uint64), query))
            yield batch_of(found)
        yield batch_of(list(links(group)))

    return cut(dealt.mapInArrow(run, "a long, b long"), "near-links")


def near_components(docs: DataFrame, p: NearParams = NearParams(), linked: Callable[[DataFrame, NearParams], DataFrame] | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    A null or empty text has an empty set and is linked with nothing. Rows that share an id are one
    document: each has its own set, and all of their links are that document's. A row of no id is a
    component of its own, without a number. An empty table gives an empty result. ``linked`` finds the
    components of rows whose ids are unique, if not these operators' own way does.
    """
    linked = linked or _components_of
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    if docs.groupBy("doc_id").count().where("count > 1 and doc_id is not null").isEmpty():
        return linked(docs, p)
    rows = cut(docs.where("doc_id is not null").withColumn("row", F.monotonically_increasing_id()), "near-rows")
    found = cut(linked(rows.select(F.col("row").alias("doc_id"), "text"), p).withColumnsRenamed({"doc_id": "row", "component_id": "near"}), "near-found")
    first = rows.groupBy("doc_id").agg(F.min("row").alias("first"))
    same = rows.select("doc_id", "row").join(first, "doc_id").select(F.col("row").alias("a"), F.col("first").alias("b"))
    known = components(same.unionAll(found.select(F.col("row").alias("a"), F.col("near").alias("b"))))
    each = rows.select("doc_id", "row").join(found, "row").join(known.withColumnRenamed("node", "row"), "row", "left").withColumn("component", F.coalesce("component", "row"))
    least = each.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    each = each.join(least, "component").select("doc_id", "n_shingles", "component_id")
    return each.unionByName(linked(docs.where("doc_id is null"), p))


def _components_of(docs: DataFrame, p: NearParams) -> DataFrame:
    sketch = sketches(docs, p)
    full = sketch.where("n > 0 and doc_id is not null")
    classes = full.groupBy("f1", "f2").agg(F.min("doc_id").alias("id"), F.max("doc_id").alias("other"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = cut(classes, "classes")
    rows = classes.select("id", "n", F.posexplode("bands").alias("band", "h"))
    shared = rows.groupBy("band", "h").agg(F.min("id").alias("pivot"), F.max("id").alias("top")).where("pivot != top").drop("top")
    members = cut(rows.join(shared, ["band", "h"]).select("band", "h", "pivot", "id", "n"), "members")
    sets = shingle_sets(docs, members.select("id").distinct(), p.words)

    def star(pairs: DataFrame) -> DataFrame:
        """Each id against the pivots it stands with."""
        pairs = pairs.where("id != pivot").select("pivot", "id", "n").distinct()
        queries = pairs.select(F.col("pivot").alias("id")).distinct().join(sets.select("id", "n"), "id")
        asked = pairs.select(F.col("pivot").alias("grp"), "id", F.col("id").alias("comp"), "n", F.lit(False).alias("query"))
        return confirm(asked.unionByName(queries.select(F.col("id").alias("grp"), "id", F.col("id").alias("comp"), "n", F.lit(True).alias("query"))), sets, p)

    links = star(members.where(F.col("band") < p.first_bands))
    known = components(links)
    apart = _apart(members, known)
    links = links.unionAll(star(apart.where("pivot_comp != comp")))
    known = components(links)
    low = 0
    for high in p.open_bands:
        found = confirm(_open_buckets(members.where((F.col("band") >= low) & (F.col("band") < high)), known), sets, p)
        links, low = links.unionAll(found), high
        known = components(links)
    lead = classes.join(known.withColumnRenamed("node", "id"), "id", "left").select("f1", "f2", "id", "other", F.coalesce("component", "id").alias("component"))
    lead = lead.where("component != id or id != other").select("f1", "f2", "component")
    out = sketch.join(lead, ["f1", "f2"], "left")
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def _open_buckets(members: DataFrame, known: DataFrame) -> DataFrame:
    """``grp, id, comp, n, query``: all members of the buckets that hold several components; queries are, once more, those not of the main one."""
    apart = cut(_apart(members, known), "apart")
    of = ["band", "h"]
    several = apart.groupBy(*of).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.bit_xor(F.xxhash64("id")).alias("all"), F.bit_xor(F.xxhash64("id", F.lit(7))).alias("too"), F.count("*").alias("k")).where("lo != hi")
    several = several.groupBy("all", "too", "k").agg(F.min(F.struct(*of)).alias("one")).select("one.*")  # buckets of the same members are one
    rows = apart.join(several, of).select(F.xxhash64(*of).alias("grp"), "id", "comp", "n")
    parts = rows.groupBy("grp", "comp").agg(F.count("*").alias("k"))
    main = parts.groupBy("grp").agg(F.max(F.struct("k", "comp"))["comp"].alias("main"))
    rows = cut(rows.join(main, "grp").select("grp", "id", "comp", "n", (F.col("comp") != F.col("main")).alias("query")), "open")
    return rows.withColumn("query", F.lit(False)).unionByName(rows.where("query"))


def _apart(members: DataFrame, known: DataFrame) -> DataFrame:
    """``members`` with the components of id and pivot so far."""
    a = known.select(F.col("node").alias("id"), F.col("component").alias("comp"))
    b = known.select(F.col("node").alias("pivot"), F.col("component").alias("pivot_comp"))
    out = members.join(a, "id", "left").join(b, "pivot", "left")
    return out.withColumns({"comp": F.coalesce("comp", "id"), "pivot_comp": F.coalesce("pivot_comp", "pivot")})


def near_duplicates(docs: DataFrame, p: NearParams = NearParams()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: of each component the smallest id is kept."""
    out = near_components(docs, p)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
