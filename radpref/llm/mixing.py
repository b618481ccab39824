"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree. Built-in functions only.

Each source gets a target of words. Its texts are cut into blocks; whole rounds of all blocks, and then a
random prefix of them, make up the target exactly: that is the source's quota of blocks. How many of each
source's blocks an output shard gets is drawn by halving: a node holds a count of blocks for each source,
a row each, and its left child gets half of the blocks, drawn without replacement (run of sources after run,
and then source after source within its run, from the hypergeometric distribution of what is left); the
right child gets the rest. At the leaves the counts add up to every source's quota. A shard then takes its
count of consecutive blocks of each source's random order, so shards are disjoint, and shuffles them locally.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from radpref.llm.common import cut, free_name, numbered, with_rows
from radpref.llm.quality_rules import let


@dataclass(frozen=True)
class MixParams:
    """``block_words`` None: a document is one block, taken whole. ``shards`` is a power of two.

    With ``shard_words`` there are as many shards more as it takes for each to hold about so many words.
    ``fan``: sources, or runs of sources, drawn from within one row; ``run``: ranks of a source that are looked up together.
    """

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    max_repeats: int = 2
    block_words: int | None = 1024
    shards: int = 32
    shard_words: int | None = None
    seed: int = 20
    bucket_rows: int = 100_000
    fan: int = 256
    run: int = 64


#: So many sources, of some sixty bytes each, may be sent to every task. Of more, each one's row is copied to so many salts.
SENT_SOURCES, SALTS = 200_000, 64


def with_sources(rows: DataFrame, of_sources: DataFrame, sources: int, key: str = "source_no") -> DataFrame:
    """``rows`` (with ``row``) joined with a row for each source; a source that holds many rows does not meet its own in one task."""
    left = of_sources.withColumnRenamed(key, "joined_key")
    on = F.col(key).eqNullSafe(F.col("joined_key"))
    if sources <= SENT_SOURCES:
        return rows.join(F.broadcast(left), on).drop("joined_key")
    left = left.withColumn("joined_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    return salted.join(left, on & (F.col("salt") == F.col("joined_salt"))).drop("joined_key", "salt", "joined_salt")


def document_sizes(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """``row, doc_id, source, size``, written down: the only pass over the texts. ``row``: a number of each row's own, if there is one."""
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    row = F.monotonically_increasing_id() if row is None else row
    return cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"), row.alias("row")), "mix-sizes")


def source_targets(sizes: DataFrame, p: MixParams) -> DataFrame:
    """``source, source_no, source_size, target``: one row for each source.

    Targets are ``least(cap, weight * level)``. The level is raised until what full sources leave over is
    shared out among the others: each round adds up caps and weights, and fills at least one source more.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.get(F.array(*[F.lit(w) for w in p.weights]), (F.col("source_no") % len(p.weights)).cast("int"))
    t = numbered(by, "source_no", F.col("source").asc_nulls_last()).withColumn("weight", weight).withColumn("cap", F.col("source_size") * p.max_repeats)
    t = cut(t, "mix-sources")  # a row for each source
    first = t.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    whole, level, full = p.share * (first["size"] or 0), 0.0, -1
    if first["weight"]:
        level = whole / first["weight"]
        while True:
            over = F.col("cap") <= F.col("weight") * F.lit(level)
            r = t.agg(F.count_if(over).alias("full"), F.sum(F.when(over, F.col("cap"))).alias("caps"), F.sum(F.when(~over, F.col("weight"))).alias("left")).first()
            if r["full"] == full or not r["left"]:
                break
            full, level = r["full"], (whole - (r["caps"] or 0)) / r["left"]
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level))
    return t.select("source", "source_no", "source_size", target.alias("target"))


def uniform(*key: Column) -> Column:
    """A number in (0, 1) that the key alone decides."""
    return (F.pmod(F.xxhash64(*key), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def log_gamma(x: Column) -> Column:
    """Stirling's series, ten places further up."""
    y = x + 10.0
    shift = x
    for k in range(1, 10):
        shift = shift * (x + float(k))
    return (y - 0.5) * F.ln(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y) - F.ln(shift)


#: Constants of the ratio-of-uniforms hat: twice the root of 2 / e, and 3 less twice the root of 3 / e.
_HAT, _HAT_MORE = 2 * math.sqrt(2 / math.e), 3 - 2 * math.sqrt(3 / math.e)
_INVERTED, _TRIES = 64, 128


def hypergeometric(total: Column, marked: Column, drawn: Column, *key: Column) -> Column:
    """How many of ``drawn`` are among the ``marked`` of ``total``, as the key decides.

    Of up to 64 possible counts by the inverse of the distribution; of more by ratio of uniforms (Stadlober):
    of 128 tries the first accepted one, each being accepted more than every other time. Both are exact to
    the precision of doubles, at any size.
    """
    f = lambda c: c.cast("double")
    given = F.struct(
        f(total).alias("n"), f(marked).alias("m"), f(drawn).alias("d"),
        F.greatest(F.lit(0).cast("long"), drawn - (total - marked)).alias("low"), F.least(marked, drawn).alias("high"),
        F.floor((f(drawn) + 1) * (f(marked) + 1) / (f(total) + 2)).alias("mode"),
    )

    def draw(g: Column) -> Column:
        n, m, d = g["n"], g["m"], g["d"]
        parts = lambda x: log_gamma(x + 1) + log_gamma(m - x + 1) + log_gamma(d - x + 1) + log_gamma(n - m - d + x + 1)
        return let(parts(f(g["mode"])), lambda top: F.when(g["high"] - g["low"] < _INVERTED, inverse(g, lambda x: F.exp(top - parts(f(x))))).otherwise(ratio(g, lambda x: top - parts(f(x)))))

    def inverse(g: Column, weight) -> Column:
        each = F.transform(F.sequence(g["low"], g["high"]), lambda x: F.struct(x.alias("x"), weight(x).alias("w")))

        def pick(ws: Column) -> Column:
            whole = F.aggregate(ws, F.lit(0.0), lambda a, w: a + w["w"])
            start = F.struct(F.lit(0.0).alias("sum"), F.lit(None).cast("long").alias("x"))

            def scan(goal: Column) -> Column:
                step = lambda a, w: F.struct((a["sum"] + w["w"]).alias("sum"), F.when(a["x"].isNull() & (a["sum"] + w["w"] >= goal), w["x"]).otherwise(a["x"]).alias("x"))
                return F.aggregate(ws, start, step, lambda a: F.coalesce(a["x"], g["high"]))

            return let(whole * uniform(*key, F.lit(-1)), scan)

        return let(each, pick)

    def ratio(g: Column, log_weight) -> Column:
        mean = g["d"] * g["m"] / g["n"]
        deviation = F.sqrt(mean * (1 - g["m"] / g["n"]) * (g["n"] - g["d"]) / (g["n"] - 1) + 0.5)
        hat = let(F.struct(mean.alias("mean"), deviation.alias("s")), lambda h: F.transform(F.sequence(F.lit(0), F.lit(_TRIES - 1)), lambda k: let(
            uniform(*key, k, F.lit(0)),
            lambda u: F.struct(u.alias("u"), F.floor(h["mean"] + 0.5 + (_HAT * h["s"] + _HAT_MORE) * (uniform(*key, k, F.lit(1)) - 0.5) / u).alias("x")),
        )))
        inside = F.filter(hat, lambda t: (t["x"] >= g["low"]) & (t["x"] <= g["high"]))
        return F.coalesce(F.get(F.filter(inside, lambda t: 2 * F.ln(t["u"]) <= log_weight(t["x"])), F.lit(0))["x"], g["mode"])

    low, high = F.greatest(F.lit(0).cast("long"), drawn - (total - marked)), F.least(marked, drawn)
    return F.when(low >= high, low).otherwise(let(given, draw)).cast("long")


def half_of(rows: DataFrame, depth: int, sources: int, p: MixParams) -> DataFrame:
    """``node, source_no, left``: how many blocks of each source the left half of each node gets. ``rows``: ``node, source_no, blocks``.

    Runs of sources are drawn first, then sources within runs: a row never holds more than ``fan`` counts.
    """
    levels = max(1, math.ceil(math.log(max(2, sources), p.fan)))
    asked = None
    for level in range(levels, 0, -1):
        of = lambda k: F.floor(F.col("source_no") / float(p.fan**k)).cast("long")
        per = rows.groupBy("node", of(level).alias("grp"), of(level - 1).alias("child")).agg(F.sum("blocks").alias("blocks"))
        per = per.groupBy("node", "grp").agg(F.array_sort(F.collect_list(F.struct("child", "blocks"))).alias("c"))
        per = per.withColumn("total", F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + x["blocks"]))
        per = per.withColumn("drawn", F.floor((F.col("total") + F.col("node") % 2) / 2).cast("long")) if asked is None else per.join(asked, ["node", "grp"])
        start = F.struct("total", "drawn", F.array().cast("array<struct<child: bigint, left: bigint>>").alias("out"))

        def step(acc: Column, x: Column) -> Column:
            key = (F.lit(p.seed), F.lit(depth), F.lit(level), F.col("node"), x["child"])  # noqa: B023  called at once
            one = lambda k: F.struct((acc["total"] - x["blocks"]).alias("total"), (acc["drawn"] - k).alias("drawn"), F.concat(acc["out"], F.array(F.struct(x["child"].alias("child"), k.alias("left")))).alias("out"))
            return let(hypergeometric(acc["total"], x["blocks"], acc["drawn"], *key), one)

        drawn = per.withColumn("x", F.explode(F.aggregate("c", start, step, lambda acc: acc["out"])))
        asked = drawn.select("node", F.col("x.child").alias("grp"), F.col("x.left").alias("drawn"))
    return asked.select("node", F.col("grp").alias("source_no"), F.col("drawn").alias("left"))


def splitting_tree(quotas: DataFrame, sources: int, p: MixParams) -> DataFrame:
    """``source_no, shard, first, blocks``: how many of a source's blocks go to a shard, and how many to those before it.

    ``quotas``: ``source_no, blocks``. Leaves without blocks are left out.
    """
    rows = quotas.select(F.lit(0).cast("long").alias("node"), "source_no", "blocks")
    for depth in range(int(math.log2(p.shards))):
        halves = rows.join(half_of(rows, depth, sources, p), ["node", "source_no"])
        sides = F.array(F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("blocks")), F.struct((F.col("node") * 2 + 1).alias("node"), (F.col("blocks") - F.col("left")).alias("blocks")))
        rows = cut(halves.select("source_no", F.explode(sides).alias("h")).select("h.node", "source_no", "h.blocks").where("blocks > 0"), f"mix-tree-{depth}")
    before = Window.partitionBy("source_no").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    return rows.select("source_no", F.col("node").alias("shard"), F.coalesce(F.sum("blocks").over(before), F.lit(0)).alias("first"), "blocks")


def ordered_blocks(sizes: DataFrame, targets: DataFrame, sources: int, p: MixParams) -> DataFrame:
    """All blocks with their place, and the words before them, in their source's random order.

    A source's blocks are dealt to buckets by their hash, numbered within buckets, and moved up by what
    the buckets before hold; no task ever sees a whole source.
    """
    buckets = max(1024, sizes.count() // p.bucket_rows)
    words = F.col("size") if p.block_words is None else F.least(F.lit(p.block_words), F.col("size") - F.col("block") * p.block_words)
    last = F.lit(0).cast("long") if p.block_words is None else F.floor((F.col("size") - 1) / p.block_words).cast("long")
    rows = with_sources(sizes.where("size > 0"), targets.select("source", "source_no"), sources, "source")
    blocks = rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last))).withColumn("words", words.cast("long"))
    h = F.xxhash64(F.lit(p.seed), F.coalesce("doc_id", F.lit(-1)), "size", "block")
    blocks = blocks.withColumn("h", h).withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(buckets))).select("row", "source_no", "block", "words", "h", "bucket")
    order = Window.partitionBy("source_no", "bucket").orderBy("h", "row", "block")
    placed = blocks.withColumns({"place": F.row_number().over(order) - 1, "words_before": F.sum("words").over(order) - F.col("words")})
    full = blocks.groupBy("source_no", "bucket").agg(F.count("*").alias("n"), F.sum("words").alias("w"))
    before = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    full = full.select(F.col("source_no"), F.col("bucket"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_up"), F.coalesce(F.sum("w").over(before), F.lit(0)).alias("w_up"))
    out = placed.join(full, ["source_no", "bucket"])
    return out.select("row", "source_no", "block", "words", (F.col("place") + F.col("n_up")).alias("place"), (F.col("words_before") + F.col("w_up")).alias("words_before"))


def shards_for(targets: DataFrame, p: MixParams) -> int:
    total = targets.agg(F.sum("target")).first()[0] or 0.0
    return max(p.shards, 1 << math.ceil(math.log2(max(1.0, total / p.shard_words)))) if p.shard_words else p.shards


def dealt(taken: DataFrame, tree: DataFrame, p: MixParams) -> DataFrame:
    """``taken`` with the ``shard`` that each block's ``rank`` in its source falls to.

    Leaves and blocks meet by runs of ranks; of a run there are no more leaves than ranks.
    """
    run = lambda c: F.floor(c / float(p.run)).cast("long")
    runs = F.sequence(run(F.col("first")), run(F.col("first") + F.col("blocks") - 1))
    leaves = tree.select(F.col("source_no"), F.explode(runs).alias("run"), F.struct("first", "shard").alias("leaf"))
    leaves = leaves.groupBy("source_no", "run").agg(F.array_sort(F.collect_list("leaf")).alias("leaves"))
    at = F.element_at(F.filter("leaves", lambda x: x["first"] <= F.col("rank")), -1)["shard"]
    return taken.withColumn("run", run(F.col("rank"))).join(leaves, ["source_no", "run"]).withColumn("shard", at).drop("run", "leaves")


def mix(sizes: DataFrame, targets: DataFrame, p: MixParams = MixParams()) -> DataFrame:
    """``row, source_no, block, epoch, first_word, taken, shard, shuffle_key``: the blocks of the mix.

    Order a shard's blocks by ``shuffle_key`` for its local shuffle.
    """
    p = replace(p, shards=shards_for(targets, p))
    sources = targets.count()
    placed = cut(ordered_blocks(sizes, targets, sources, p), "mix-blocks")
    counts = placed.groupBy("source_no").agg(F.count("*").alias("n"))
    goal = targets.select("source_no", "source_size", F.rint("target").cast("long").alias("goal")).join(counts, "source_no")
    wide = with_sources(placed, goal, sources)
    rounds = F.floor(F.col("goal") / F.col("source_size")).cast("int")
    rest = F.col("goal") - F.col("source_size") * rounds - F.col("words_before")
    last = F.col("words") if p.block_words is None else F.least("words", rest)
    takes = F.concat(F.array_repeat(F.col("words"), rounds), F.when(rest > 0, F.array(last)).otherwise(F.array().cast("array<bigint>")))
    taken = wide.select("row", "source_no", "block", "place", "n", F.posexplode(takes).alias("epoch", "taken"))
    taken = taken.withColumn("rank", F.col("epoch") * F.col("n") + F.col("place"))
    quotas = cut(taken.groupBy("source_no").agg(F.count("*").alias("blocks")), "mix-quotas")  # a row for each source
    tree = splitting_tree(quotas, sources, p)
    key = F.xxhash64(F.lit(p.seed + 1), "shard", "source_no", "place", "epoch")
    first = F.col("block") * (p.block_words or 0)
    return dealt(taken, tree, p).select("row", "source_no", "block", "epoch", first.alias("first_word"), "taken", "shard", key.alias("shuffle_key"))


def mixing_report(docs: DataFrame, p: MixParams = MixParams()) -> DataFrame:
    """Per document ``doc_id, source, size, source_size, target, taken, shards``.

    ``taken`` adds up the blocks that the shards draw. Texts that are null or have no words are never taken;
    null sources are one source, the last. Rows that repeat an id are rows of their own. An empty table
    gives an empty result.
    """
    sizes = document_sizes(docs)
    targets = source_targets(sizes, p)
    taken = mix(sizes, targets, p).groupBy("row").agg(F.sum("taken").alias("taken"), F.array_sort(F.collect_set("shard")).alias("shards"))
    known = with_sources(sizes, targets, targets.count(), "source")
    return known.join(taken, "row", "left").select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "shards")


def mixed_documents(docs: DataFrame, p: MixParams = MixParams(block_words=None, shards=1, shard_words=8_000_000)) -> DataFrame:
    """The documents themselves, as often as the mix takes them, dealt to shards and shuffled within them.

    Every row counts for itself, whether its id is missing or repeated: such rows are numbered, and written
    down with their numbers. A shard is one partition; documents without words are in none. Extra columns stay,
    whatever their names.
    """
    row, shard, key, mine = (free_name(n, docs.columns) for n in ("mix_row", "mix_shard", "mix_key", "mix_taken_row"))
    rows = with_rows(docs, row, "mix-rows")
    sizes = document_sizes(rows, F.col(row))
    targets = source_targets(sizes, p)
    p = replace(p, shards=shards_for(targets, p), shard_words=None)
    chosen = cut(mix(sizes, targets, p).select(F.col("row").alias(mine), F.col("shard").cast("int").alias(shard), F.col("shuffle_key").alias(key)), "mix-chosen")
    out = rows.join(chosen, F.col(row) == F.col(mine))
    return out.repartitionById(p.shards, F.col(shard)).sortWithinPartitions(shard, key).select(docs.columns)
