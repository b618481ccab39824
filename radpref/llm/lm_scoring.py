"""Language-model scoring: prediction by partial matching over bytes, beside a word-count base.

The model is a trie of byte contexts up to ``ORDER`` bytes long, over all 256 bytes, with counts of the byte
that follows; it is kept as sparse tables, a row for each context and for each byte seen after it, and grows
with the corpus. A byte is predicted from the longest context seen; what that context has not seen costs an
escape (method D: half a count for each kind of follower), after which the next shorter context predicts
among the symbols that the longer ones have excluded. Training counts are final before scoring, so a gram
(a context and the byte after it) has one code length, worked out once by joins of the levels, and a text's
is the sum of its grams'. Of these, the commonest go to every task; the others are joined.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radpref.llm.common import cut, held_out, small_batches, text_or_empty

#: Bytes of the longest context.
ORDER = 5
#: Words whose counts go to every task; at most so many, of at most so many bytes. The others are joined.
COMMON_WORDS, COMMON_BYTES = 50_000, 64
#: Grams whose code lengths go to every task, at most: twelve bytes each.
COMMON_GRAMS = 1 << 20
_FLUSH = 200_000
_CHUNK = 1 << 20


def parts(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All texts, each with an end byte, in runs of bounded size: raw bytes, and of each piece its text and coded length.

    Before a piece stand the ``ORDER`` bytes that precede it in its text, or as many zero bytes.
    """
    raw, who, length, size = [], [], [], 0
    for i, t in enumerate(texts):
        for a in range(0, len(t) + 1, _CHUNK):
            piece = t[a : a + _CHUNK] + (b"\0" if a + _CHUNK > len(t) else b"")
            raw += [t[a - ORDER : a] if a else bytes(ORDER), piece]
            who.append(i)
            length.append(len(piece))
            size += len(piece) + ORDER
            if size >= _CHUNK:
                yield np.frombuffer(b"".join(raw), np.uint8), np.array(who), np.array(length)
                raw, who, length, size = [], [], [], 0
    if who:
        yield np.frombuffer(b"".join(raw), np.uint8), np.array(who), np.array(length)


def grams_of(raw: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gram at every coded byte, as a number of its ``ORDER`` + 1 bytes; and where each piece's begin."""
    n = len(raw) - ORDER
    key = np.zeros(n, np.int64)
    for j in range(ORDER + 1):
        key <<= 8
        key |= raw[j : j + n]
    coded = np.ones(n, bool)
    ends = np.cumsum(length + ORDER)[:-1]
    for k in range(ORDER):
        coded[ends - 1 - k] = False  # these would be coded bytes of the next piece's context
    return key[coded], np.cumsum(length) - length


def gather(docs: DataFrame) -> DataFrame:
    """``word, gram, c, n``: counts of lower-cased words (gram null) and of grams (word null); c in training rows, n in all.

    ``docs``: ``text`` and ``held_out``. Words are counted in training rows only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[bytes] = Counter()
        grams: list[list[tuple[np.ndarray, np.ndarray]]] = [[], []]

        def flush() -> Iterator[pa.RecordBatch]:
            items = list(words.items())
            words.clear()
            for i in range(0, len(items), 50_000):
                w, c = zip(*items[i : i + 50_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(w, pa.binary()), pa.nulls(len(w), pa.int64()), pa.array(c, pa.int64()), pa.array(c, pa.int64())], names=["word", "gram", "c", "n"])

        def merged(side: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            key, at = np.unique(np.concatenate([k for k, _ in side]), return_inverse=True)
            return key, np.bincount(at, np.concatenate([c for _, c in side])).astype(np.int64)

        def out(side: int) -> Iterator[pa.RecordBatch]:
            if not grams[side]:
                return
            key, c = merged(grams[side])
            grams[side] = []
            for i in range(0, len(key), 100_000):
                k, each = key[i : i + 100_000], c[i : i + 100_000]
                yield pa.RecordBatch.from_arrays([pa.nulls(len(k), pa.binary()), pa.array(k), pa.array(each * (1 - side)), pa.array(each)], names=["word", "gram", "c", "n"])

        for batch in batches:
            held = np.array(batch.column("held_out").to_pylist(), bool)
            texts = [t.as_buffer().to_pybytes().lower() for t in batch.column("text")]
            for side in (0, 1):
                mine = [t for t, h in zip(texts, held, strict=True) if h == side]
                if side == 0:
                    for t in mine:
                        words.update(t.split())
                        if len(words) > _FLUSH:
                            yield from flush()
                for raw, _, length in parts(mine):
                    grams[side].append(np.unique(grams_of(raw, length)[0], return_counts=True))
                if len(grams[side]) > 16:
                    grams[side] = [merged(grams[side])]
                    if len(grams[side][0][0]) > 2_000_000:  # memory stays bounded; Spark adds up the rest
                        yield from out(side)
        yield from flush()
        for side in (0, 1):
            yield from out(side)

    small_batches(docs.sparkSession)
    each = docs.select(text_or_empty().cast("binary").alias("text"), "held_out").mapInArrow(run, "word binary, gram long, c long, n long")
    return each.groupBy("word", "gram").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def _low(c: Column, n: int) -> Column:
    """The last n bytes of a gram or context."""
    return c.bitwiseAND(F.lit((1 << (8 * n)) - 1))


def code_lengths(grams: DataFrame) -> DataFrame:
    """``gram, n, lp``: log10 of the chance of each gram's last byte after those before it. ``grams``: ``gram, c, n``.

    Tables of a level: grams with their counts, and contexts with the number and kinds of followers, both
    among all of them and, for the next shorter context, among those that the longer one does not exclude.
    A level of k bytes has 256 ** k rows at most, so the lowest ones are broadcast.
    """
    seen = grams.where("c > 0").select("gram", "c")
    levels: dict[int, DataFrame] = {ORDER: seen.withColumnRenamed("gram", f"g{ORDER}")}
    for k in range(ORDER - 1, -1, -1):
        above = levels[k + 1]
        levels[k] = cut(above.groupBy(_low(F.col(f"g{k + 1}"), k + 1).alias(f"g{k}")).agg(F.sum("c").alias("c")), f"lm-level-{k}")
    bounded = lambda df, size: F.broadcast(df) if size <= 2 else df
    contexts: dict[int, DataFrame] = {}
    for k in range(ORDER + 1):
        rows = levels[k]
        total = [F.sum("c").alias(f"n{k}"), F.count("*").alias(f"k{k}")]
        if k == 0:
            contexts[0] = rows.agg(*total)
            continue
        below = levels[k - 1].select(F.col(f"g{k - 1}").alias("low"), F.col("c").alias("c_low"))
        ctx = F.shiftright(f"g{k}", 8)
        by = rows.join(bounded(below, k), _low(F.col(f"g{k}"), k) == F.col("low")).groupBy(ctx.alias(f"x{k}")).agg(*total, F.sum("c_low").alias("out"))
        less = contexts[k - 1].select(*([F.col(f"x{k - 1}").alias("x_low")] if k > 1 else []), F.col(f"n{k - 1}").alias("n_low"), F.col(f"k{k - 1}").alias("k_low"))
        by = by.join(bounded(less, k - 1), _low(F.col(f"x{k}"), k - 1) == F.col("x_low")) if k > 1 else by.crossJoin(F.broadcast(less))  # one row
        contexts[k] = cut(by.select(f"x{k}", f"n{k}", f"k{k}", (F.col("n_low") - F.col("out")).alias(f"n_after{k}"), (F.col("k_low") - F.col(f"k{k}")).alias(f"k_after{k}")), f"lm-contexts-{k}")
    out = grams.withColumnRenamed("c", f"c{ORDER}")
    for k in range(ORDER, 0, -1):
        out = out.join(bounded(contexts[k], k), _low(F.shiftright("gram", 8), k) == F.col(f"x{k}"), "left").drop(f"x{k}")
        low = levels[k - 1].withColumnRenamed("c", f"c{k - 1}")
        out = out.join(bounded(low, k), _low(F.col("gram"), k) == F.col(f"g{k - 1}"), "left").drop(f"g{k - 1}")
    out = out.join(F.broadcast(contexts[0]), F.lit(True), "left")  # one row
    kinds = F.coalesce("k0", F.lit(0))
    lp = -F.log10(F.greatest(F.lit(1), 256 - kinds).cast("double"))
    for k in range(ORDER + 1):
        among, kinds = F.col(f"n{k}"), F.col(f"k{k}")
        if k < ORDER:  # what the longer context has seen is excluded, if there is one
            longer = F.col(f"n{k + 1}").isNotNull()
            among, kinds = F.when(longer, F.col(f"n_after{k + 1}")).otherwise(among), F.when(longer, F.col(f"k_after{k + 1}")).otherwise(kinds)
        escape = F.coalesce(F.when(among > 0, F.log10(kinds / (2.0 * among))), F.lit(0.0))
        lp = F.when(F.col(f"c{k}") > 0, F.log10((2.0 * F.col(f"c{k}") - 1) / (2.0 * among))).otherwise(escape + lp)
    return out.select("gram", "n", lp.alias("lp"))


class CommonGrams:
    """Code lengths of some grams by number: a table by hash, and the sorted grams for those whose place another holds."""

    def __init__(self, gram: np.ndarray, lp: np.ndarray):
        """``gram`` in ascending order of how often it occurs: the commonest keep their places."""
        self.bits = max(4, int(len(gram)).bit_length() + 1)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits, np.float32)
        at = self._place(gram)
        self.keys[at], self.values[at] = gram, lp
        order = np.argsort(gram)
        self.gram, self.lp = gram[order], lp[order]

    def _place(self, gram: np.ndarray) -> np.ndarray:
        return ((gram.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def find(self, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each gram its code length, 0 where it isn't known; and which are not."""
        at = self._place(gram)
        lp = self.values[at].astype(np.float64)
        other = np.flatnonzero(self.keys[at] != gram)
        if not len(self.gram):
            return np.zeros(len(gram)), other
        g = gram[other]
        k = np.minimum(np.searchsorted(self.gram, g), len(self.gram) - 1)
        known = self.gram[k] == g
        lp[other] = np.where(known, self.lp[k], 0.0)
        return lp, other[~known]


def scores(texts: list[bytes], common: CommonGrams) -> tuple[np.ndarray, list[list[np.ndarray]]]:
    """Of each (lower-cased) text the sum over its common grams, and its other grams."""
    total, rest = np.zeros(len(texts)), [[] for _ in texts]
    for raw, who, length in parts(texts):
        gram, first = grams_of(raw, length)
        lp, other = common.find(gram)
        total += np.bincount(who, np.add.reduceat(lp, first), len(texts))
        piece = np.searchsorted(first, other, "right") - 1
        cuts = np.searchsorted(piece, np.arange(len(who) + 1))
        for i, a, b in zip(who, cuts[:-1], cuts[1:], strict=True):
            if a < b:
                rest[i].append(gram[other[a:b]])
    return total, rest


def commonest(rows: DataFrame, count: str, room: int) -> Column:
    """Which rows have the highest counts, ``room`` at most: all those from a count on."""
    step = F.floor(F.log2(count) * 8).cast("int")
    least = None
    for r in sorted(rows.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect(), reverse=True):  # at most 8 * 64 rows
        room -= r["n"]
        if room < 0:
            break
        least = r["step"]
    return F.lit(False) if least is None else step >= least


def lm_scoring(docs: DataFrame, folds: int = 7, fold: int = 2) -> DataFrame:
    """Learn from the documents outside the held-out fold and score every document.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``. ``score`` is the log10
    chance of the text's bytes, A-Z lower-cased, and of its end. A null text is an empty one: one token,
    its end. A null id counts as held out. Repeated rows are counted and scored one by one. Without
    training rows nothing is known and each byte is as likely as any other.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), held_out(F.col("doc_id"), folds, fold).alias("held_out"))
    counts = cut(gather(docs), "lm-counts")
    words = counts.where(F.col("word").isNotNull()).select("word", "c")
    ends = docs.where(~F.col("held_out")).count()
    total = words.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n, v = (total["n"] or 0) + ends, total["v"] + (ends > 0)
    short = words.where(F.octet_length("word") <= COMMON_BYTES)
    known = {bytes(r["word"]): float(np.log10(r["c"] + 1)) for r in short.where(commonest(short, "c", COMMON_WORDS)).collect()}
    model = cut(code_lengths(counts.where(F.col("gram").isNotNull()).select("gram", "c", "n")), "lm-model")
    sent = model.where(commonest(model, "n", COMMON_GRAMS)).select("gram", F.col("lp").cast("float").alias("lp"), "n").toArrow()
    order = np.argsort(sent["n"].to_numpy(), kind="stable")
    shared = spark.sparkContext.broadcast((sent["gram"].to_numpy()[order], sent["lp"].to_numpy()[order], known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, lp, common = shared.value
        frequent = CommonGrams(gram, lp)
        rest = pa.list_(pa.struct([("word", pa.binary()), ("tf", pa.int64())]))
        for batch in batches:
            ids, outs = batch.column("doc_id"), batch.column("held_out")
            texts = [t.as_buffer().to_pybytes().lower() for t in batch.column("text")]
            sums, grams = scores(texts, frequent)
            tokens, sure, base, others = [], [], [], []
            for t in texts:
                ws = t.split()
                hit = [x for w in ws if (x := common.get(w)) is not None]
                tokens.append(len(ws) + 1)
                sure.append(len(hit))
                base.append(sum(hit))
                others.append([{"word": w, "tf": k} for w, k in Counter(w for w in ws if w not in common).items()] if len(hit) < len(ws) else [])
            rare = pa.array([np.concatenate(g) if g else [] for g in grams], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, outs, pa.array(tokens, pa.int64()), pa.array(sure, pa.int64()), pa.array(base, pa.float64()), pa.array(sums, pa.float64()), pa.array(others, rest), rare], names=["doc_id", "held_out", "n_tokens", "sure", "base", "score", "rest", "grams"])

    out = "doc_id long, held_out boolean, n_tokens long, sure long, base double, score double, rest array<struct<word: binary, tf: bigint>>, grams array<bigint>"
    each = docs.withColumn("text", F.col("text").cast("binary")).mapInArrow(run, out)
    each = cut(each.withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    rare = each.select("row", F.explode("rest").alias("r")).select("row", "r.word", "r.tf")
    found = rare.join(words, "word").groupBy("row").agg(F.sum("tf").alias("rare"), F.sum(F.col("tf") * F.log10(F.col("c") + 1.0)).alias("rare_base"))
    tail = each.select("row", F.explode("grams").alias("gram")).join(model.select("gram", "lp"), "gram").groupBy("row").agg(F.sum("lp").alias("rare_score"))
    end = float(np.log10(ends + 1))
    less = float(np.log10(n + v + 1)) if n else 0.0
    joined = each.drop("rest", "grams").join(found, "row", "left").join(tail, "row", "left")
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("sure") + F.coalesce("rare", F.lit(0)) + (1 if ends else 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) + F.lit(end) - F.col("n_tokens") * F.lit(less)).alias("base_score"),
        (F.col("score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"),
    )
