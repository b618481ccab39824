"""Ranked lexical search against plain scoring of every document."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute_search as B  # noqa: E402

from radpref.llm.lexical_search import Interval, SearchParams, lexical_search  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, term string, n string, score string"


def corpus(seed=3, n=300):
    r = random.Random(seed)
    vocab = [f"w{int(r.paretovariate(0.7))}" for _ in range(4000)] + ["Été", "漢字", "a1", "😀"]
    line = lambda k: " ".join(r.choice(vocab) + r.choice(["", ".", ",", "-x"]) for _ in range(k))
    texts = [line(r.choice([1, 5, 20, 80, 400])) for _ in range(n)]
    texts += [texts[5]] * 15 + [None, "", "...", "W1 w1 W1", "word " * 40_000, "\x00w2\x7fw3", "w1" * 50_000]
    items = [line(r.choice([1, 3, 15, 60])) for _ in range(25)] + [texts[5], None, "", "w1", "?!", "zzz unknown", "W1 W2 w2", "word", "Été 漢字"]
    return list(enumerate(texts)), list(enumerate(items))


def got(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    return {k: sorted(v) for k, v in out.items()}


def frames(spark, docs, items):
    return spark.createDataFrame([(i, t, None, "x", "y", "z") for i, t in docs], SCHEMA).repartition(3), spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, terms string")


@pytest.mark.parametrize("p", [SearchParams(), SearchParams(postings=900, first_read=1, floor_share=3, block_bytes=500)])
def test_search(spark, p):
    docs, items = corpus()
    assert got(lexical_search(*frames(spark, docs, items), p)) == B.search(docs, items)


def test_repeats_nulls_and_ties(spark):
    docs = [(4, "a b"), (4, "a b"), (None, "a b"), (2, "b a"), (9, None), (7, "a a a")] + [(100 + k, "a c") for k in range(30)]
    items = [(1, "a"), (1, "b"), (None, "c"), (None, "a c"), (5, None)]
    assert got(lexical_search(*frames(spark, docs, items))) == B.search(docs, items)


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "a b")], [(1, "a")])
    none = lexical_search(docs.limit(0), items)
    assert none.collect() == [] and lexical_search(docs, items.limit(0)).collect() == []
    assert dict(none.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}


def test_reads_stop_early():
    """A list need not be read to its end where its impacts can no longer change what is found."""
    doc = np.arange(20_000)
    one = (doc[:10], np.full(10, 10**6))
    flat = (doc, np.sort(np.r_[np.full(10, 500), np.full(19_990, 400)])[::-1])
    both = Interval([one, flat], 20_000, SearchParams(first_read=16))
    who, score = both.best(1)
    assert sorted(who[np.argsort(-score)][:10]) == list(range(10)) and set(score) == {10**6 + 500}
    assert both.reads < 200
    floor = Interval([flat], 20_000, SearchParams(first_read=16))
    assert len(floor.best(10_000)[0]) == 0 and floor.reads == 16
