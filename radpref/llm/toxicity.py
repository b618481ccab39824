"""Toxicity by subword-bag embeddings and a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (and of itself), hashed to a fixed number of buckets; each
bucket has a vector. A passage of consecutive words is the average of its words' vectors, a linear
softmax turns it into the probability of label 1, and a document scores as its worst passage, so that
length does not dilute what stands in one place. Misspelt or unseen forms share n-gram vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from radpref.llm.common import free_name, held_out, small_batches, text_or_empty, thinned

#: ASCII that separates words becomes a blank and A-Z becomes a-z; bytes of other letters stay.
_FOLD = bytes(
    (b + 32 if 65 <= b <= 90 else b) if (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) else 32
    for b in range(256)
)


@dataclass(frozen=True)
class ToxicityParams:
    """``max_docs`` labelled rows of each class at most are learnt from, none of over ``max_bytes``."""

    max_docs: int = 800
    max_bytes: int = 60_000
    buckets: int = 1 << 16
    dim: int = 8
    min_n: int = 3
    max_n: int = 5
    passage: int = 4
    min_share: float = 0.01
    epochs: int = 60
    warm_up: int = 15
    rates: tuple[float, float, float] = (0.5, 0.05, 0.2)
    decay: float = 0.001
    seed: int = 7


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def subword_ids(words: list[bytes], p: ToxicityParams) -> tuple[np.ndarray, np.ndarray]:
    """Bucket ids of all words' n-grams, one run per word, and each run's start."""
    raw = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.uint64)
    size = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    end = np.cumsum(size)
    word = np.repeat(np.arange(len(words)), size)
    left = end[word] - np.arange(len(raw))  # bytes from here to the end of the word
    keys, owners = [], []
    code = np.zeros(len(raw), np.uint64)
    for n in range(1, p.max_n + 1):
        tail = np.zeros(len(raw), np.uint64)
        tail[: len(raw) - n + 1] = raw[n - 1 :]
        code = code * np.uint64(0x9E3779B97F4A7C15) + tail + np.uint64(1)
        if n >= p.min_n:
            ok = left >= n
            keys.append(code[ok] * np.uint64(31) + np.uint64(n))
            owners.append(word[ok])
    power = np.cumprod(np.full(int(size.max()), 0xC2B2AE3D27D4EB4F, np.uint64))
    whole = np.add.reduceat(raw * power[np.arange(len(raw)) - (end - size)[word]], end - size)
    keys.append(whole)
    owners.append(np.arange(len(words)))
    key, owner = np.concatenate(keys), np.concatenate(owners)
    key ^= key >> np.uint64(29)
    key *= np.uint64(0xBF58476D1CE4E5B9)
    key ^= key >> np.uint64(32)
    order = np.argsort(owner, kind="stable")
    starts = np.searchsorted(owner[order], np.arange(len(words)))
    return (key[order] % np.uint64(p.buckets)).astype(np.int64), starts


def vocabulary_ids(words: list[bytes], p: ToxicityParams, at_once: int = 4000) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`subword_ids`, but runs' sizes, by a few words at a time: the driver that trains has little memory."""
    parts, sizes = [], []
    for i in range(0, len(words), at_once):
        ids, starts = subword_ids(words[i : i + at_once], p)
        sizes.append(np.diff(np.append(starts, len(ids))))
        parts.append(ids.astype(np.int32))
    return np.concatenate(parts), np.concatenate(sizes)


@dataclass
class ToxicityModel:
    """``bucket``: each bucket's vector times the softmax's difference of weights; ``bias`` likewise.

    Passages are scored from these scalars: averaging is linear, so the product may be taken first.
    """

    bucket: np.ndarray
    bias: float
    params: ToxicityParams

    def word_scores(self, words: list[bytes]) -> np.ndarray:
        ids, starts = subword_ids(words, self.params)
        return np.add.reduceat(self.bucket[ids], starts) / np.diff(np.append(starts, len(ids)))

    def document_score(self, values: np.ndarray) -> float:
        """Probability of label 1 in the worst passage; one starts at every word, as in training. No words: the bias alone."""
        p = self.params
        if len(values) <= p.passage:
            top = float(values.mean()) if len(values) else 0.0
        else:
            total = np.concatenate(([0.0], np.cumsum(values)))
            top = float((total[p.passage :] - total[: -p.passage]).max() / p.passage)
        return float(1 / (1 + np.exp(-np.clip(top + self.bias, -30, 30))))


def train(texts: list[bytes], labels: list[int], p: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    """Learn bucket vectors and softmax weights together by gradient descent with momentum.

    Which passage of a document is its worst is chosen by the present model in each epoch; in the first
    ones it is a long passage at random. Both classes weigh the same. A step's length follows the error
    left, and is shared out in proportion to the gradient, so that chance patterns hardly move.
    """
    rng = np.random.default_rng(p.seed)
    vocab: dict[bytes, int] = {}
    tokens = [np.fromiter((vocab.setdefault(w, len(vocab)) for w in words_of(t)), np.int32) for t in texts]
    tokens, y = [t for t in tokens if len(t)], np.array([v for t, v in zip(tokens, labels, strict=True) if len(t)], np.float64)
    if not tokens or y.min() == y.max():
        return ToxicityModel(np.zeros(p.buckets), float(np.log(y.mean() * 98 + 1) - np.log(99 - y.mean() * 98)) if tokens else float(-np.log(99)), p)
    ids, sizes = vocabulary_ids(list(vocab), p)
    del vocab
    starts = np.cumsum(sizes) - sizes
    seen = np.zeros(p.buckets, np.int64)  # documents that have the bucket
    for t in tokens:
        seen[np.unique(ids[_runs(starts, sizes, np.unique(t))])] += 1
    common = seen >= max(3, p.min_share * len(tokens))  # rarer buckets can't be told from chance and stay at nought
    emb = rng.normal(0, 0.1, (p.buckets, p.dim)) * common[:, None]
    head = np.outer(rng.normal(0, 1, p.dim), [-0.5, 0.5])
    bias = np.zeros(2)
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    speed = [np.zeros_like(a) for a in (emb, head, bias)]
    for epoch in range(p.epochs):
        spans = []
        if epoch < p.warm_up:
            for t in tokens:
                a = rng.integers(0, max(1, len(t) - 8 * p.passage))
                spans.append(t[a : a + 8 * p.passage])
        else:
            scalar = np.add.reduceat((emb @ (head[:, 1] - head[:, 0]))[ids], starts) / sizes
            spans = [t[(a := worst(scalar[t], p.passage)) : a + p.passage] for t in tokens]
        used, flat = np.unique(np.concatenate(spans), return_inverse=True)
        length = np.array([len(t) for t in spans])
        grams, count = ids[_runs(starts, sizes, used)], sizes[used]
        vec = np.add.reduceat(emb[grams], np.cumsum(count) - count) / count[:, None]
        x = np.add.reduceat(vec[flat], np.cumsum(length) - length) / length[:, None]
        z = x @ head + bias
        q = np.exp(z - z.max(1, keepdims=True))
        q /= q.sum(1, keepdims=True)
        q[np.arange(len(y)), y.astype(int)] -= 1
        dz = q * weight[:, None]
        share = np.repeat((dz @ head.T) / length[:, None], length, axis=0)
        grads = [np.zeros_like(emb), x.T @ dz, dz.sum(0)]
        for k in range(p.dim):
            back = np.bincount(flat, share[:, k], len(used)) / count
            grads[0][:, k] = np.bincount(grams, np.repeat(back, count), p.buckets) * common
        for i, (a, g, top) in enumerate(zip((emb, head, bias), grads, p.rates, strict=True)):
            speed[i] = 0.8 * speed[i] + g * (top / max(float(np.abs(g).max()), 1e-9)) * min(1.0, float(np.abs(q).mean()) * 4)
            a -= speed[i] + p.decay * a
    return ToxicityModel(emb @ (head[:, 1] - head[:, 0]), float(bias[1] - bias[0]), p)


def _runs(starts: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Positions of the entries of the given rows of a run-length table."""
    n = sizes[rows]
    return np.repeat(starts[rows] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def worst(values: np.ndarray, passage: int) -> int:
    """Start of the passage with the highest average."""
    if len(values) <= passage:
        return 0
    total = np.concatenate(([0.0], np.cumsum(values)))
    return int(np.argmax(total[passage:] - total[:-passage]))


def labelled_sample(docs: DataFrame, labels: DataFrame, p: ToxicityParams = ToxicityParams()) -> DataFrame:
    """``doc_id, text, toxic`` of at most ``max_docs`` ids a class, by a hash of the id; held-out ids stay out.

    One row an id: of repeated labels the highest counts, of an id's texts the least.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"), 5, 0)).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    order = [F.xxhash64(F.col("doc_id").cast("string"), F.lit(p.seed)), F.col("doc_id")]
    sides = [thinned(known.where(F.col("toxic") == y), p.max_docs, p.seed, "doc_id").orderBy(*order).limit(p.max_docs) for y in (1, 0)]
    sample = sides[0].unionAll(sides[1])
    body = docs.where(F.octet_length("text") <= p.max_bytes).select("doc_id", "text")
    return body.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, p: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    rows = sorted(labelled_sample(docs, labels, p).collect())  # at most 2 * max_docs rows of max_bytes
    return train([r["text"].encode() for r in rows], [r["toxic"] for r in rows], p)


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with ``toxic_score``, which replaces a column of that name. Null and empty texts score as the bias alone."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, cache = shared.value, {}
        for batch in batches:
            texts = [words_of(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in batch.column(batch.num_columns - 1)]
            new = list({w for t in texts for w in t}.difference(cache))
            if len(cache) + len(new) > 200_000:  # bounded; words seen again are scored again
                cache.clear()
                new = list({w for t in texts for w in t})
            for i in range(0, len(new), 20_000):
                part = new[i : i + 20_000]
                cache.update(zip(part, m.word_scores(part).tolist(), strict=True))
            scores = [m.document_score(np.fromiter(map(cache.__getitem__, t), np.float64, len(t))) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], names=out.names)

    out = docs.drop("toxic_score").schema.add("toxic_score", "double")
    return docs.drop("toxic_score").withColumn(free_name("toxic_score_text", docs.columns), F.col("text").cast("binary")).mapInArrow(run, out)


def toxicity(docs: DataFrame, labels: DataFrame, p: ToxicityParams = ToxicityParams()) -> DataFrame:
    """Fit on the labelled rows outside the held-out fold and score every document.

    Returns ``doc_id, held_out, score, predicted``. Nulls: a null text is an empty one; a null id counts
    as held out; labels other than 0 and 1 are not learnt from. Repeated rows are scored one by one.
    Without labels of both classes every score is near the share of label 1; without any, near 0.
    """
    model = fit(docs, labels, p)
    scored = score_documents(docs.select("doc_id", text_or_empty().alias("text")), model)
    return scored.select(
        F.col("doc_id").cast(LongType()).alias("doc_id"),
        held_out(F.col("doc_id"), 5, 0).alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"),
    )
