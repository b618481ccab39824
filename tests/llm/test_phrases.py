"""Phrase collocations against plain counting."""

import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute_search as B  # noqa: E402

from radpref.llm.phrases import Counts, PhraseParams, collocations, pieces  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, phrase string, f long, rank long"


def rows(seed=5, n=220):
    r = random.Random(seed)
    words = ["the", "Of", "été", "漢", "x-y", "\x00", "a\x01b", "😀"] + [f"w{k}" for k in range(60)]
    fixed = [" ".join(r.choice(words) for _ in range(k)) for k in (2, 3, 4, 5, 6) for _ in range(6)]

    def line():
        parts = [r.choice(fixed) if r.random() < 0.4 else words[min(int(r.paretovariate(0.6)) - 1, 60)] for _ in range(r.randint(0, 40))]
        return "".join(p + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?", "\x0b", "\x0c "]) for p in parts)

    texts = [(r.choice(["en", "en", "en", None, "und", "é"]), line()) for _ in range(n)]
    return texts + [("en", None), (None, ""), ("en", " . , "), ("one", "a b " * 20_000), ("en", "w" * 200_000), ("en", "long" * 30 + " tail")] + [("en", "same words again here")] * 40 + [("en", "w" * 100 + " then that")] * 35


def got(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def frame(spark, texts):
    return spark.createDataFrame([(k if k % 7 else None, t, lang, "p", 1, 2) for k, (lang, t) in enumerate(texts)], SCHEMA).repartition(3)


@pytest.mark.parametrize(
    "p",
    [
        PhraseParams(),
        PhraseParams(head=6, map_bits=64, tile=2, full=0.3, hold=40),  # most words are beyond the head, the map lets nearly all through
        PhraseParams(head=0, map_bits=1 << 12, least=5, top=50),
        PhraseParams(head=40, tile=8, full=0.01, hold=300, least=3, percent=60, longest=3),
    ],
)
def test_collocations(spark, p):
    texts = rows()
    want = B.phrases(texts, p.longest, p.least, p.percent, p.top)
    assert want and got(collocations(frame(spark, texts), p)) == want


def test_empty(spark):
    none = collocations(frame(spark, rows()).limit(0))
    assert none.collect() == []
    assert dict(none.dtypes) == {"lang": "string", "phrase": "string"} | {c: "bigint" for c in ("rank", "a", "l", "r", "n", "score")}
    assert collocations(frame(spark, [("en", "few words")])).collect() == []


def test_exact_beyond_64_bits(spark):
    from radpref.llm.phrases import scored

    big = 7 * 10**12
    df = spark.createDataFrame([("x", "a", 1, big), ("x", "b", 1, big + 1), ("x", "a b", 2, big)], "lang string, phrase string, k int, f long")
    assert scored(df).first()["score"] == 2000000 * big // (2 * big + 1)


def test_pieces():
    assert pieces("A b,C\td\n\x0be.\u00c9".encode()) == [b"a", b"b", b".", b"c", b"d", b".", b".", b"e", b".", "\u00c9".encode()]


@pytest.mark.parametrize(("tile", "full", "hold"), [(4, 0.0, 10**6), (4, 2.0, 10**6), (16, 0.1, 300), (256, 0.05, 1 << 21)])
def test_tiles_and_coordinates(tile, full, hold):
    r = np.random.default_rng(1)
    c, want = Counts(PhraseParams(tile=tile, full=full, hold=hold)), Counter()
    for _ in range(30):
        u, x = (r.zipf(1.3, 500).clip(1, 900).astype(np.uint64) for _ in range(2))
        far = r.random(500) < 0.1
        u[far] |= np.uint64(1 << 63)
        want.update(zip(u.tolist(), x.tolist(), strict=True))
        c.add(u, x)
        c.full()
    u, x, n = c.take()
    seen = Counter()
    for a, b, k in zip(u.tolist(), x.tolist(), n.tolist(), strict=True):
        seen[a, b] += k
    assert seen == want and c.take()[0].size == 0
