"""N-gram Jaccard join by a partitioned universe: sets alike enough agree on some segment of it, or all but agree.

All shingles are dealt to segments by hash, so many segments as the sizes of a band ask for (bands double). Two sets of
similarity p per cent differ in at most (a + b)(100 - p) / (100 + p) shingles, so if the larger one gathers more units than
that over its segments, one unit for asking who has an equal segment and two for asking who has one that differs in one
shingle at most (its one-deletion neighbourhood), one of them meets the smaller set. A set is indexed under its own
band, and asks in that and, if sets of the band below are large enough for it, there as well.

Which units a set takes goes by what they cost. Segments that no other set has cost nothing, and most sets gather all
they need from such ones. Sets that share a segment are compared with the least of it first, which settles groups of
close copies; a segment whose holders are settled costs nothing either. What then needs more asks in the segments that
fewest others hold; where even these are held by many, the one-deletion neighbourhoods are written out, each unit is
counted for the sets it would meet, and the cheapest are taken. Sets that meet are mostly alike but not enough, above all
those that meet late. They are sifted first, in blocks of bounded size, by bit maps of a few bits a shingle: each bit is
the parity of the shingles that fall to it, so two maps differ in no more bits than the sets in shingles, and no link is
lost. Links are confirmed on full sets throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from radpref.llm.common import cut, drop, slices, small_batches
from radpref.llm.components import components
from radpref.llm.near_dedup import NearParams, Shingler, confirm, in_blocks, mixed, near_components, shingle_sets

_GOLD, _SEG, _TOKEN, _BIT = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))
#: In bands up to here empty segments count as segments; in higher ones so few sets could meet in these alone that once in 10^11 pairs none other is shared.
_SMALL = 5


@dataclass(frozen=True)
class JoinParams:
    """``passes``: parts of the segments that are looked at one after another, so that no more than one of them is being sorted out by
    key at a time. ``first_share``: one segment in so many is used to settle close copies first. ``dear``: where more sets than this would meet
    at a segment that a set has to ask in, one-deletion neighbourhoods are written out for it. ``sift_block`` and ``sift_shingles``: a
    side of the blocks in which bit maps are compared."""

    words: int = 5
    percent: int = 80
    passes: int = 2
    first_share: int = 8
    dear: int = 4096
    block: int = 128
    block_shingles: int = 400_000
    sift_block: int = 1024
    sift_shingles: int = 3_200_000

    def __post_init__(self):
        if not 50 <= self.percent <= 100:
            raise ValueError("bands double, so the similarity must be 50 per cent at least")

    @property
    def blocks(self) -> NearParams:
        return NearParams(words=self.words, percent=self.percent, block=self.block, block_shingles=self.block_shingles)

    @property
    def sift_blocks(self) -> NearParams:
        return NearParams(words=self.words, percent=self.percent, block=self.sift_block, block_shingles=self.sift_shingles)

    def segments(self, band: int) -> int:
        return ((2 << band) - 1) * (100 - self.percent) // self.percent + 1

    def differing(self, a: int, b: int) -> int:
        return (a + b) * (100 - self.percent) // (100 + self.percent)


def levels(n: int, p: JoinParams) -> list[tuple[int, bool, int]]:
    """(band, own, most shingles that may differ) of the bands in which a set of so many shingles asks: its own, and the one below if sets there are large enough."""
    band = n.bit_length() - 1
    out = [(band, True, p.differing(n, n))]
    below = (1 << band) - 1
    if band and n * p.percent <= 100 * below:
        out.append((band - 1, False, p.differing(n, below)))
    return out


def place(tokens: np.ndarray, segments: int) -> np.ndarray:
    return ((mixed(tokens ^ _SEG) >> np.uint64(16)) % np.uint64(segments)).astype(np.int64)


def key_of(band: int, segment: np.ndarray, content: np.ndarray) -> np.ndarray:
    """Keys of segments by band, number and content, a sum of their shingles' hashes."""
    return mixed(content + mixed(segment.astype(np.uint64) * _GOLD + np.uint64(band + 1)))


def segment_keys(tokens: np.ndarray, p: JoinParams) -> list[np.ndarray]:
    """Keys of a set's segments in each band in which it asks; of large bands those that are not empty."""
    where, value, out = mixed(tokens ^ _SEG) >> np.uint64(16), mixed(tokens ^ _TOKEN), []
    for band, _, _ in levels(len(tokens), p):
        m = p.segments(band)
        content, at = np.zeros(m, np.uint64), (where % np.uint64(m)).astype(np.int64)
        np.add.at(content, at, value)
        each = np.arange(m) if band <= _SMALL else np.flatnonzero(np.bincount(at, minlength=m))
        out.append(key_of(band, each, content[each]))
    return out


def neighbourhood(tokens: np.ndarray, band: int, p: JoinParams) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all segments, empty ones too, and of all one-deletion neighbours with the numbers of the segments they come from."""
    m = p.segments(band)
    content, at, value = np.zeros(m, np.uint64), place(tokens, m), mixed(tokens ^ _TOKEN)
    np.add.at(content, at, value)
    each = np.arange(m)
    return key_of(band, each, content), each, key_of(band, at, content[at] - value), at


def signatures(docs: DataFrame, p: JoinParams) -> DataFrame:
    """``doc_id, n, f1, f2, own, low``: set size, 128-bit fingerprint, segment keys of the own band and of the one below. Written down."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(p.words)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                sets = [shingler(t.as_buffer().to_pybytes()) for t in part.column("text")]
                f1 = [int(mixed(s + _GOLD).sum(dtype=np.uint64).view(np.int64)) for s in sets]
                f2 = [int(mixed(s ^ _SEG).sum(dtype=np.uint64).view(np.int64)) for s in sets]
                keys = [[k.tobytes() for k in segment_keys(s, p)] if len(s) else [] for s in sets]
                own, low = ([k[i] if len(k) > i else None for k in keys] for i in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(map(len, sets), pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(own, pa.binary()), pa.array(low, pa.binary())],
                    names=["doc_id", "n", "f1", "f2", "own", "low"],
                )

    return cut(docs.mapInArrow(run, "doc_id long, n long, f1 long, f2 long, own binary, low binary"), "signatures")


def segments(signed: DataFrame, who: str, p: JoinParams, part: int) -> DataFrame:
    """``key``, the column ``who``, ``n``, ``own``, ``spare``: a row for each segment of a pass; how many a set has, in all passes, beyond those that it must ask in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n = batch.column(who).to_numpy(), batch.column("n").to_numpy()
            for k, level in enumerate(("own", "low")):
                keys = batch.column(level).to_pylist()
                size = np.array([len(x or b"") // 8 for x in keys], np.int64)
                most = np.array([levels(int(i), p)[k][2] if x is not None else 0 for i, x in zip(n, keys, strict=True)], np.int64)
                flat, of = np.frombuffer(b"".join(x for x in keys if x), np.int64), np.repeat(np.arange(len(ids)), size)
                spare, mine = size - most - 1, flat % p.passes == part
                flat, of = flat[mine], of[mine]
                for i in range(0, len(flat), 1 << 17):
                    j = of[i : i + (1 << 17)]
                    columns = [flat[i : i + len(j)], ids[j], n[j], np.full(len(j), level == "own"), spare[j]]
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["key", who, "n", "own", "spare"])

    return signed.where("n > 0").mapInArrow(run, f"key long, {who} long, n long, own boolean, spare long")


def units(sets: DataFrame, p: JoinParams) -> DataFrame:
    """``key, id, n, own, segment, whole, spare``: all segments of the sets in both bands, whole and less one shingle; units beyond those needed, were all free."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "id", "n", "own", "segment", "whole", "spare"]
        for batch in batches:
            for i, s in zip(batch.column("id").to_pylist(), batch.column("shingles"), strict=True):
                tokens = np.frombuffer(s.as_buffer().to_pybytes(), np.uint64)
                for band, own, most in levels(len(tokens), p):
                    whole, each, less, at = neighbourhood(tokens, band, p)
                    key, segment = np.concatenate([whole, less]).view(np.int64), np.concatenate([each, at])
                    full = lambda v, m=len(key): np.full(m, v)
                    columns = [key, full(i), full(len(tokens)), full(own), segment, np.arange(len(key)) < len(whole), full(2 * len(whole) - most - 1)]
                    for a in range(0, len(key), 1 << 17):
                        yield pa.RecordBatch.from_arrays([pa.array(c[a : a + (1 << 17)]) for c in columns], names=names)

    return sets.select("id", "shingles").mapInArrow(run, "key long, id long, n long, own boolean, segment long, whole boolean, spare long")


def _with_components(rows: DataFrame, known: DataFrame) -> DataFrame:
    comp = known.select(F.col("node").alias("id"), F.col("component").alias("comp"))
    return rows.join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))


def _star(members: DataFrame, sets: DataFrame, maps: DataFrame, p: JoinParams) -> DataFrame:
    """Links of sets with the least set of a segment they hold, which is the lesser one of the two."""
    pairs = members.where("id != pivot").select("pivot", "id", "n").distinct()
    least = pairs.select(F.col("pivot").alias("id")).distinct().join(sets.select("id", "n"), "id")
    rows = pairs.select(F.col("pivot").alias("grp"), "id", F.col("id").alias("comp"), "n", F.lit(False).alias("query"))
    asked = rows.unionByName(least.select(F.col("id").alias("grp"), "id", F.col("id").alias("comp"), "n", F.lit(True).alias("query")))
    return confirm_pairs(sifted(asked, maps, p).select("a", "b", F.col("b").alias("comp")), sets, p)


def contested(rows: DataFrame) -> DataFrame:
    """Those of the segments in ``rows`` that a set holds which lacks free units: if its other segments meet nobody, it must still ask in some of these."""
    lacking = rows.groupBy("id", "own").agg(F.count("*").alias("dear"), F.first("spare").alias("spare")).where("dear > spare").select("id", "own")
    return rows.join(rows.join(lacking, ["id", "own"], "left_semi").select("key").distinct(), "key", "left_semi")


def asking(members: DataFrame, known: DataFrame, p: JoinParams) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``key, id, n``: whom the cheapest whole segments let meet; ``id, own`` of sets for which these are too dear; ``id`` of all that hold one of their segments.

    A segment whose holders are one component is free. A set that lacks free units asks in its least shared ones.
    """
    rows = _with_components(members.select("key", "id", "n", "own", "spare"), known)
    sizes = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size")).where("lo != hi").select("key", "size")
    rows = cut(contested(cut(rows.join(sizes, "key"), "unsettled")), "contested")
    one = Window.partitionBy("id", "own")
    ranks = rows.withColumns({"rank": F.row_number().over(one.orderBy("size", "key")), "dear": F.count("*").over(one)})
    asks = cut(ranks.where("rank <= dear - spare").select("key", "id", "own", "size"), "asks")
    hot = asks.groupBy("id", "own").agg(F.max("size").alias("size")).where(F.col("size") > p.dear).select("id", "own")
    held = rows.join(rows.join(hot, ["id", "own"], "left_semi").select("key").distinct(), "key", "left_semi").select("id").distinct()
    keys = asks.join(hot, ["id", "own"], "left_anti").select("key").distinct()
    return rows.join(keys, "key", "left_semi").select("key", "id", "n"), hot, held


def cheapest(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """Rows of :func:`units` at keys where the cheapest units of ``hot`` sets ask."""
    at = rows.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count_if(F.col("whole") & F.col("own")).alias("equal"), F.count_if(~F.col("whole") & F.col("own")).alias("less"))
    rows = cut(rows.join(at.where("lo != hi and equal > 0").drop("lo", "hi"), "key"), "units")
    itself = F.col("own").cast("int")
    cost = rows.join(hot, ["id", "own"], "left_semi").groupBy("id", "own", "segment").agg(
        F.sum(F.when(F.col("whole"), F.col("equal") - itself).otherwise(0)).alias("first"),
        F.sum(F.when(F.col("whole"), F.col("less")).otherwise(F.col("equal"))).alias("second"),
        F.first("spare").alias("spare"),
    )
    each = cost.select("id", "own", "segment", "spare", F.posexplode(F.array("first", F.greatest("first", "second"))).alias("unit", "cost"))
    one = Window.partitionBy("id", "own")
    each = each.withColumns({"rank": F.row_number().over(one.orderBy("cost", "unit", "segment")), "dear": F.count("*").over(one)})
    taken = each.where("rank <= dear - spare").groupBy("id", "own", "segment").agg(F.count("*").alias("taken"))
    asks = rows.join(taken, ["id", "own", "segment"]).where(F.when(F.col("whole"), (F.col("equal") > itself) | ((F.col("taken") == 2) & (F.col("less") > 0))).otherwise(F.col("taken") == 2))
    return rows.join(asks.select("key").distinct(), "key", "left_semi")


def at_home(met: DataFrame, known: DataFrame) -> DataFrame:
    """``grp, id, comp, n, query``: whom to compare with whom, of sets that meet at keys.

    Where sets of several components meet, all are compared with those that are not of the main one. Such a set may meet
    the same others at many keys, so it takes them all to the largest group that it meets, and each is sent there once.
    """
    met = cut(_with_components(met, known), "met")
    parts = met.groupBy("key", "comp").agg(F.count("*").alias("k"))
    groups = parts.groupBy("key").agg(F.max(F.struct("k", "comp"))["comp"].alias("main"), F.sum("k").alias("size"), F.count("*").alias("parts")).where("parts > 1")
    met = cut(met.join(groups.drop("parts"), "key"), "groups")
    asks = met.where("comp != main")
    home = asks.groupBy("id").agg(F.max(F.struct("size", "key"))["key"].alias("grp"))
    asks = asks.join(home, "id")
    queries = asks.select("grp", "id", "comp", "n").distinct()
    members = asks.select("key", "grp").distinct().join(met.select("key", "id", "comp", "n"), "key").select("grp", "id", "comp", "n").distinct()
    return queries.withColumn("query", F.lit(True)).unionByName(members.withColumn("query", F.lit(False)))


def parities(tokens: np.ndarray, words: int) -> np.ndarray:
    """A bit map of so many 64-bit words, a power of two: each bit tells if an odd number of shingles falls to it."""
    odd = np.bincount((mixed(tokens ^ _BIT) % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(maps: np.ndarray, words: int) -> np.ndarray:
    """Rows of bit maps of so many words, made from larger ones: what falls to either half falls to their sum."""
    while maps.shape[1] > words:
        half = maps.shape[1] // 2
        maps = maps[:, :half] ^ maps[:, half:]
    return maps


def bit_maps(sets: DataFrame) -> DataFrame:
    """``id, size, bits``: two to four bits a shingle. Written down."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, bits = [], []
            for s in batch.column("shingles"):
                tokens = np.frombuffer(s.as_buffer().to_pybytes(), np.uint64)
                size.append(len(tokens))
                bits.append(parities(tokens, 1 << max(0, (2 * len(tokens) - 1).bit_length() - 6)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(size, pa.int64()), pa.array(bits, pa.binary())], names=["id", "size", "bits"])

    return cut(sets.select("id", "shingles").mapInArrow(run, "id long, size long, bits binary"), "maps")


def sift_block(queries: list[tuple], members: list[tuple], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of queries and members, ``(id, comp, size, bits)`` each, that may be linked: of other components, sizes and bit maps alike enough."""
    width: dict[int, list[int]] = {}
    for k, m in enumerate(members):
        width.setdefault(len(m[3]), []).append(k)
    of = []
    for at in width.values():
        at = np.array(at)
        maps = np.frombuffer(b"".join(members[k][3] for k in at), np.uint64).reshape(len(at), -1)
        ids, comps, sizes = (np.array([members[k][j] for k in at], np.int64) for j in range(3))
        of.append((at, maps, ids, comps, sizes))
    found_q, found_m = [], []
    for k, (i, c, n, bits) in enumerate(queries):
        own = np.frombuffer(bits, np.uint64).reshape(1, -1)
        for at, maps, ids, comps, sizes in of:
            near = np.flatnonzero((np.minimum(sizes, n) * 100 >= percent * np.maximum(sizes, n)) & (comps != c) & (ids != i))
            if len(near):
                words = min(own.shape[1], maps.shape[1])
                apart = np.bitwise_count(folded(maps[near], words) ^ folded(own, words)).sum(1, dtype=np.int64)
                good = at[near[(100 + percent) * apart <= (100 - percent) * (sizes[near] + n)]]
                found_q.append(np.full(len(good), k))
                found_m.append(good)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_q]), np.concatenate([none, *found_m])


def sifted(asked: DataFrame, maps: DataFrame, p: JoinParams) -> DataFrame:
    """``a, b, first``: pairs met in groups of ``asked`` (as of :func:`confirm`) whose bit maps don't rule a link out; whether to look at them first. Written down.

    First are, for each query and component, the pairs of least id in a block.
    """
    dealt = in_blocks(asked, p.sift_blocks).join(maps, "id")
    dealt = dealt.repartition("grp", "q", "m").sortWithinPartitions("grp", "q", "m")
    percent = p.percent

    def pairs(queries: list[tuple], members: list[tuple]) -> pa.RecordBatch:
        q, m = sift_block(queries, members, percent)
        a, b, comp = (np.array([x[j] for x in side], np.int64)[at] if len(at) else at for side, at, j in ((queries, q, 0), (members, m, 0), (members, m, 1)))
        order = np.lexsort((b, comp, a))
        a, b, comp = a[order], b[order], comp[order]
        first = np.ones(len(a), bool)
        first[1:] = (a[1:] != a[:-1]) | (comp[1:] != comp[:-1])
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(first)], names=["a", "b", "first"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sides = None, ([], [])
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("grp", "q", "m", "query", "id", "comp", "size", "bits")]
            for g, q, m, query, *row in zip(*cols, strict=True):
                if (g, q, m) != key:
                    if all(sides):
                        yield pairs(*sides)
                    key, sides = (g, q, m), ([], [])
                sides[not query].append(row)
        if all(sides):
            yield pairs(*sides)

    found = dealt.mapInArrow(run, "a long, b long, first boolean")
    return cut(found.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("first").alias("first")), "sifted")


def confirm_pairs(pairs: DataFrame, sets: DataFrame, p: JoinParams) -> DataFrame:
    """Those of the pairs ``a, b, comp`` that are links; one for each ``a`` and component of ``b`` is enough."""
    size = sets.select("id", "n")
    members = pairs.select(F.col("a").alias("grp"), F.col("b").alias("id"), "comp").join(size, "id").withColumn("query", F.lit(False))
    queries = pairs.select(F.col("a").alias("id")).distinct().join(size, "id").select("id", F.col("id").alias("grp"), F.col("id").alias("comp"), "n", F.lit(True).alias("query"))
    return confirm(members.unionByName(queries), sets, p.blocks)


def _links_met(asked: DataFrame, links: DataFrame, sets: DataFrame, maps: DataFrame, p: JoinParams) -> DataFrame:
    """``links`` and those among sets that meet in groups of ``asked``: sifted, then the first of each component confirmed, then what is still apart."""
    pairs = sifted(asked, maps, p)
    left = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = cut(sets.join(left, "id", "left_semi"), "sets-left")
    for chosen in (pairs.where("first"), pairs.where("not first")):
        known = components(links)
        near = known.select(F.col("node").alias("a"), F.col("component").alias("own"))
        far = known.select(F.col("node").alias("b"), F.col("component").alias("comp"))
        apart = chosen.join(near, "a", "left").join(far, "b", "left").select("a", "b", F.coalesce("own", "a").alias("own"), F.coalesce("comp", "b").alias("comp"))
        links = links.unionAll(confirm_pairs(apart.where("own != comp"), sets, p))
    return links


def _classes_linked(docs: DataFrame, p: JoinParams) -> DataFrame:
    signed = signatures(docs, p)
    full = signed.where("n > 0 and doc_id is not null")
    classes = cut(full.groupBy("f1", "f2").agg(F.min("doc_id").alias("id"), F.max("doc_id").alias("other"), F.first("n").alias("n")), "classes")
    passes = []
    for part in range(p.passes):
        shared = segments(full, "f1", p, part).groupBy("key").agg(F.min("f1").alias("lo"), F.max("f1").alias("hi"), F.max("own").alias("own")).where("own and lo != hi").select("key")
        shared = cut(shared, "shared")
        rows = segments(full, "doc_id", p, part).withColumnRenamed("doc_id", "id").join(shared, "key", "left_semi").join(classes.select("id"), "id", "left_semi")
        passes.append(cut(rows, "rows"))
        drop(shared)
    rows = reduce(DataFrame.unionAll, passes)
    heads = cut(signed.select("doc_id", "n", "f1", "f2"), "heads")
    drop(signed)
    held = cut(contested(rows), "held")
    drop(rows)
    members = cut(held.join(held.groupBy("key").agg(F.min("id").alias("pivot")), "key"), "members")
    drop(held)
    sets = shingle_sets(docs, members.select("id").distinct(), p.words)
    maps = bit_maps(sets)
    links = _star(members.where(F.pmod("key", F.lit(p.first_share)) == 0), sets, maps, p)
    known = components(links)
    pivot = known.select(F.col("node").alias("pivot"), F.col("component").alias("pivot_comp"))
    apart = _with_components(members, known).join(pivot, "pivot", "left").where(F.coalesce("pivot_comp", "pivot") != F.col("comp"))
    links = links.unionAll(_star(apart, sets, maps, p))
    known = components(links)
    met, hot, held = asking(members, known, p)
    drop(members)
    hot = cut(hot, "hot")
    if not hot.isEmpty():
        met = met.unionByName(cheapest(units(sets.join(held, "id", "left_semi"), p), hot).select("key", "id", "n")).distinct()
    links = _links_met(cut(at_home(met, known), "home"), links, sets, maps, p)
    drop(sets)
    known = components(links)
    lead = classes.join(known.withColumnRenamed("node", "id"), "id", "left").select("f1", "f2", "id", "other", F.coalesce("component", "id").alias("component"))
    lead = lead.where("component != id or id != other").select("f1", "f2", "component")
    out = heads.join(lead, ["f1", "f2"], "left")
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def jaccard_join(docs: DataFrame, p: JoinParams = JoinParams()) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: links are pairs of the asked similarity or more.

    A null or empty text has an empty set and is linked with nothing. Rows that share an id are one document, to
    which the links of all of them belong; a row of no id is a component of its own, without a number. Other
    columns are not read; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    return near_components(docs, p.blocks, lambda rows, _: _classes_linked(rows, p))
