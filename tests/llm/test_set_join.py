"""The Jaccard join against all pairs."""

import random
import sys
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute as B  # noqa: E402

from radpref.llm import set_join as S  # noqa: E402
from radpref.llm.near_dedup import mixed  # noqa: E402
from radpref.llm.set_join import JoinParams, folded, jaccard_join, levels, neighbourhood, parities, segment_keys, sift_block  # noqa: E402

SCHEMA = "doc_id long, text string, n long, own boolean, key string, band int"


def corpus(seed=2):
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(3000)] + ["Été", "漢字"]
    line = lambda n: [r.choice(vocab) for _ in range(n)]
    rows = [None, "", " \n", "x", "A b", "a B", "one two three four five", "one two three four six", "İ A B", "long " * 30_000, "q" * 100_000]
    for size, copies in ((4, 6), (5, 8), (6, 8), (9, 14), (12, 20), (30, 25), (64, 25), (130, 40), (400, 20)):
        base = line(size)
        for _ in range(copies):  # up to and beyond the similarity, by words changed, added at an end, and left out
            ws = list(base)
            for _ in range(r.randint(0, max(1, size // 25))):
                how = r.random()
                if how < 0.4:
                    ws[r.randrange(len(ws))] = r.choice(vocab)
                elif how < 0.7:
                    ws += line(r.randint(1, max(1, size // 20)))
                elif len(ws) > 2:
                    del ws[r.randrange(len(ws))]
            rows.append(" ".join(ws))
    passage = line(60)
    rows += [" ".join(line(r.randint(5, 200)) + passage + line(r.randint(1, 100))) for _ in range(25)]
    rows += [" ".join(line(r.randint(1, 60))) for _ in range(60)]
    rows += [rows[40]] * 5 + [rows[150].upper()] * 3
    return [(k * 7 % 1009, t) for k, t in enumerate(rows)]


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 1, True, "k", 2) for i, t in docs], SCHEMA).repartition(3)


def got(df):
    rows = df.collect()
    out = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("p", [JoinParams(), JoinParams(words=1, first_share=1000, block=3, block_shingles=200, sift_block=4, sift_shingles=300), JoinParams(words=3, first_share=1, dear=0), JoinParams(words=2, first_share=50, dear=3)])
def test_join(spark, p):
    docs = corpus()
    assert got(jaccard_join(frame(spark, docs), p)) == {i: v[:2] for i, v in B.near(docs, p.words).items()}


def test_repeats_nulls_and_empty(spark):
    same = "q r s t u v w x y"
    docs = frame(spark, [(5, "a b c d e f"), (5, "a b c d e f"), (2, "A b c d e f"), (None, "a b c d e f"), (5, same), (9, same), (9, "lone"), (4, None), (7, "z")])
    rows = jaccard_join(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((r[0] or -1, r[1], r[2]) for r in rows) == [(-1, 2, None), (2, 2, 2), (4, 0, 4), (5, 2, 2), (5, 2, 2), (5, 5, 2), (7, 1, 7), (9, 1, 2), (9, 5, 2)]
    assert jaccard_join(docs.limit(0)).collect() == []


@pytest.mark.parametrize("percent", [80, 60, 95])
def test_units_meet_whatever_is_alike(percent):
    """However the larger set gathers its units, one of them meets a set that is alike enough."""
    p, r = JoinParams(percent=percent), random.Random(1)
    sets = []
    for size in (1, 2, 3, 5, 8, 15, 16, 31, 40, 63, 64, 100, 127, 128, 300):
        base = mixed(np.array([r.getrandbits(64) for _ in range(size)], np.uint64))
        for _ in range(7):
            keep = base[np.array([r.random() > 0.07 for _ in base], bool)]
            more = mixed(np.array([r.getrandbits(64) for _ in range(r.randint(0, 1 + size // 10))], np.uint64))
            sets.append(np.unique(np.concatenate([keep, more])))
    sets = [s for s in sets if len(s)]
    alike = 0
    for a, b in combinations(sets, 2):
        a, b = (a, b) if len(a) >= len(b) else (b, a)
        shared = len(np.intersect1d(a, b))
        if 100 * shared < percent * (len(a) + len(b) - shared):
            continue
        alike += 1
        for band, own, most in levels(len(a), p):
            if band != levels(len(b), p)[0][0]:
                continue
            whole, each, less, at = neighbourhood(a, band, p)
            their, _, their_less, _ = neighbourhood(b, band, p)
            assert set(segment_keys(b, p)[0]) <= set(their) and 2 * len(whole) > most
            near = np.zeros(len(whole), int)  # how many units of each segment meet b
            near[np.isin(whole, their)] = 2
            for k, x in list(zip(at, np.isin(less, their), strict=True)) + list(zip(each, np.isin(whole, their_less), strict=True)):
                if x and not near[k]:
                    near[k] = 1
            # units that miss b: both of a segment that differs in two or more, one of a segment that differs in one
            missing = int(2 * (near == 0).sum() + (near == 1).sum())
            assert missing <= most
            break
        else:
            raise AssertionError("no common band")
    assert alike > {80: 100, 60: 200, 95: 5}[percent]


def test_bit_maps_differ_in_no_more_bits_than_sets_in_shingles():
    r = np.random.default_rng(5)
    for _ in range(300):
        base = r.integers(0, 1 << 63, r.integers(1, 400)).astype(np.uint64)
        a, b = (np.unique(np.concatenate([base[r.random(len(base)) > 0.1], r.integers(0, 1 << 63, r.integers(1, 40)).astype(np.uint64)])) for _ in range(2))
        wide = [1 << max(0, (2 * len(x) - 1).bit_length() - 6) for x in (a, b)]
        for words in {min(wide), 1}:
            x, y = (folded(parities(s, w)[None], words) for s, w in zip((a, b), wide, strict=True))
            assert (x == parities(a, words)).all() and (y == parities(b, words)).all()  # folding is a map of fewer bits
            assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_sift_keeps_all_links_and_few_others():
    r = np.random.default_rng(6)
    base = r.integers(0, 1 << 63, 300).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[r.random(300) > share], r.integers(0, 1 << 63, int(300 * share)).astype(np.uint64)])) for share in (0.02, 0.05, 0.1, 0.2, 0.3) for _ in range(12)]
    rows = [(k, k, len(s), parities(s, 1 << max(0, (2 * len(s) - 1).bit_length() - 6)).tobytes()) for k, s in enumerate(sets)]
    alike = lambda a, b: len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    true = {(i, k): alike(sets[i], sets[k]) for i in range(len(sets)) for k in range(len(sets)) if i != k}
    got = set(zip(*(x.tolist() for x in sift_block(rows, rows, 80)), strict=True))
    assert {x for x, j in true.items() if j >= 0.8} <= got
    assert len([x for x in got if true[x] < 0.7]) == 0
    same = [(i, 1, n, bits) for i, _, n, bits in rows]  # one component: nothing to find
    assert len(sift_block(same, same, 80)[0]) == 0


def test_passes_share_out_all_segments(spark):
    docs = frame(spark, [d for d in corpus() if d[1]][:120]).withColumn("text", F.col("text").cast("binary"))
    signed = S.signatures(docs, JoinParams())
    rows = lambda passes, part: sorted(map(tuple, S.segments(signed, "doc_id", JoinParams(passes=passes), part).collect()))
    parts = [rows(3, k) for k in range(3)]
    assert sorted(sum(parts, [])) == rows(1, 0)
    assert all(parts) and not {x[0] for x in parts[0]} & {x[0] for x in parts[1] + parts[2]}


def test_full_sets_are_fetched_only_for_pairs_that_may_be_links(spark, monkeypatch):
    """Of a family alike but not enough, bit maps rule out all pairs; where no segment is held by many, no neighbourhoods are made."""
    r, asked = random.Random(3), []
    line = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    base = line(200)
    docs = [(k, " ".join(base + line(60))) for k in range(20)]
    docs.append((20, docs[7][1] + " one more"))
    monkeypatch.setattr(S, "confirm", lambda rows, *more, f=S.confirm: asked.extend(rows.collect()) or f(rows, *more))
    monkeypatch.setattr(S, "units", lambda *_: pytest.fail("neighbourhoods of rare segments"))
    assert {i: c for i, (_, c) in got(jaccard_join(frame(spark, docs))).items()} == {k: k for k in range(20)} | {20: 7}
    assert {x["id"] for x in asked} == {7, 20}
