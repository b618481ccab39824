"""Operators with exact contracts against brute force, on a small table of odd cases."""

import random
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute as B  # noqa: E402

from radpref.llm.components import components  # noqa: E402
from radpref.llm.decontamination import contamination_report, decontaminate  # noqa: E402
from radpref.llm.lm_scoring import lm_scoring  # noqa: E402
from radpref.llm.mixing import MixParams, document_sizes, mix, mixed_documents, mixing_report, source_targets  # noqa: E402
from radpref.llm.near_dedup import NearParams, Shingler, near_duplicates, super_minhash  # noqa: E402
from radpref.llm.quality_rules import quality_rules  # noqa: E402
from radpref.llm.suffix_dedup import SuffixParams, suffix_dedup  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, held_out string"


def corpus(seed=1):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["Été", "naïve", "漢字", "éx"]
    sentence = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    passage = sentence(70)
    base = sentence(120)
    texts = [None, "", " \n\t ", "x", "one two", "a b c d", "İstanbul A B", "word" * 30_000, "ab " * 3000, "\x00\x1f zero", passage]
    texts += [sentence(r.randint(1, 200)) for _ in range(40)]
    texts += [f"{sentence(30)} {passage} {sentence(30)}" for _ in range(25)]
    for _ in range(40):  # near copies at all distances
        ws = base.split()
        for _ in range(r.randint(0, 8)):
            ws[r.randrange(len(ws))] = r.choice(vocab)
        texts.append(" ".join(ws))
    texts += [texts[20]] * 6 + ["line one is here\nother\nline one is here\n\n  \nother"]
    return [(i * 3, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs():
    return corpus()


@pytest.fixture(scope="module")
def frame(spark, docs):
    names = ["b", None, "a", "É", ""]
    rows = [(i, t, None, names[k % 5] if k % 3 else "b", None, 0.5, "x") for k, (i, t) in enumerate(docs)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def by_id(df, *columns):
    rows = df.select("doc_id", *columns).collect()
    out = {r["doc_id"]: tuple(r[c] for c in columns) for r in rows}
    assert len(out) == len(rows)
    return out


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates(frame, docs, words):
    assert by_id(near_duplicates(frame, NearParams(words=words)), "n_shingles", "component_id", "kept") == B.near(docs, words)


def test_near_duplicates_in_small_blocks(frame, docs):
    p = NearParams(words=4, block=4, block_shingles=300, first_bands=1)
    assert by_id(near_duplicates(frame, p), "n_shingles", "component_id", "kept") == B.near(docs, 4)


def test_near_duplicates_repeats_and_nulls(spark):
    same = "q r s t u v w x"  # five shingles of four words
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (2, "A b c d e f"), (None, "a b c d e f"), (7, "z y"), (7, "b"), (5, same), (9, same), (9, "lone"), (4, None)]
    got = sorted(map(tuple, near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), NearParams(words=4)).collect()), key=str)
    want = [(5, 3, 2, False), (5, 3, 2, False), (2, 3, 2, True), (None, 3, None, True), (7, 1, 7, True), (7, 1, 7, True), (5, 5, 2, False), (9, 5, 2, False), (9, 1, 2, False), (4, 0, 4, True)]
    assert got == sorted(want, key=str)
    assert near_duplicates(empty(spark)).count() == 0


def test_super_minhash_is_a_permutation_minimum():
    """Against the definition: each element offers place p its rank there plus a fraction."""
    sets = [Shingler(2)(" ".join(f"w{i}" for i in range(n)).encode()) for n in (2, 5, 40, 900)]
    together, alone = super_minhash(sets, 16), np.vstack([super_minhash([s], 16) for s in sets])
    assert (together == alone).all() and (together >> np.uint64(32)).max() < 16
    joined = super_minhash([np.unique(np.concatenate((sets[1], sets[2])))], 16)[0]
    assert (joined == np.minimum(together[1], together[2])).all()


def test_super_minhash_estimates_similarity():
    r = np.random.default_rng(0)
    for share in (0.5, 0.8):
        common, rest = r.integers(0, 2**63, int(600 * share), np.int64), r.integers(0, 2**63, 600 - int(600 * share), np.int64)
        half = len(rest) // 2
        a, b = (np.unique(np.concatenate((common, x)).astype(np.uint64)) for x in (rest[:half], rest[half:]))
        s = super_minhash([a, b], 256)
        assert abs((s[0] == s[1]).mean() - share) < 0.1


def test_components(spark):
    chain = [(i, i + 1) for i in range(50)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize(("rows", "core", "chunk", "batches"), [(500_000, 24, 1 << 20, 4), (1000, 5, 4096, 3)])
def test_suffix_dedup(frame, docs, rows, core, chunk, batches):
    p = SuffixParams(rows=rows, core=core, chunk=chunk, batches=batches)
    assert by_id(suffix_dedup(frame, p), "n_bytes", "n_removed", "n_spans", "kept_sha256") == B.repeats(docs)


def test_suffix_index_takes_batches_as_they_come(spark, frame, docs):
    """Levels double, every batch meets all that stands, and what is found in the end doesn't hang on the batches."""
    from radpref.llm.suffix_dedup import SuffixIndex

    p = SuffixParams()
    whole = frame.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    found = []
    for batches in (1, 3):
        index = SuffixIndex(p)
        for k in range(batches):
            index.add(whole.where(F.pmod(F.col("doc_id") / 3, F.lit(batches)) == k))
            standing = bin(k + 1)[2:]
            assert sorted(index.levels) == [i for i, bit in enumerate(reversed(standing)) if bit == "1"]
        covered = {}
        for r in index.intervals(whole).collect():
            covered.setdefault(r["doc_id"], set()).update(range(r["a"], r["b"]))
        found.append(covered)
        index.close()
    assert found[0] == found[1] and {i: len(c) for i, c in found[0].items()} == {i: n[1] for i, n in B.repeats(docs).items() if n[1]}


def test_suffix_dedup_repeats_and_nulls(spark):
    t = "".join(random.Random(3).choice("abcdefgh ") for _ in range(300))
    rows = [(1, t), (1, t), (None, t[:250]), (2, "short"), (None, None)]
    got = suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_bytes", "n_removed").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, 300, 300), (1, 300, 300), (None, 250, 250), (2, 5, 0), (None, 0, 0)], key=str)
    assert suffix_dedup(empty(spark)).count() == 0


def test_decontamination(spark, frame, docs):
    texts = dict(docs)
    items = [(1, texts[33]), (2, "one two"), (2, "x"), (3, None), (4, ""), (None, "a b c d"), (10, " ".join((texts[36] or "").split()[3:25]).upper()), (11, "éx İ")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = B.decontaminated(docs, items)
    names = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert by_id(contamination_report(frame, bench), *names) == want
    split = decontaminate(frame, bench, max_sent=3).select("doc_id", F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]).alias("n"), F.size("item_ids").alias("k"))
    assert by_id(split, "n", "k") == {i: w[1:3] for i, w in want.items()}
    assert {w[1] for w in by_id(contamination_report(frame, bench.limit(0)), *names).values()} == {0}
    assert contamination_report(empty(spark), bench).count() == 0
    nameless = spark.createDataFrame([(None, "a b c d"), (None, None)], "item_id long, text string")
    assert {i: (w[0], w[1]) for i, w in by_id(contamination_report(frame, nameless), *names).items()} == {i: (w[0], 0) for i, w in want.items()}


def test_decontamination_of_hot_words_repeats_and_clashing_names(spark):
    """Items of few different words, a passage in all documents, repeated rows, columns of the operator's own names."""
    passage = "x y x y x y x x y y x y x"
    rows = [(k % 7 if k % 5 else None, f"d{k} {passage} {k}", 1, "n", "r", "f", "w") for k in range(60)] + [(100, "y x " * 3000, 1, "n", "r", "f", "w"), (101, None, 1, "n", "r", "f", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words long, item_ids string, decontaminate_row string, found_row string, row string")
    items = [(1, passage), (2, "x y " * 5), (3, "y x"), (4, "x " * 10)]
    out = decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert set(out.columns) == {*docs.columns, "hit_spans"} and out.count() == len(rows)
    want = B.decontaminated(list(enumerate(r[1] for r in rows)), items)
    by_text = {r[1]: want[i] for i, r in enumerate(rows)}
    for r in out.collect():
        w = by_text[r["text"]]
        assert (r["n_words"], sum(s["end"] - s["start"] for s in r["hit_spans"]), len(r["item_ids"])) == w[:3] and r["row"] == "w"


def test_quality_rules(spark, frame, docs):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = by_id(quality_rules(frame), *names, "kept")
    assert {i: g[:-1] for i, g in got.items()} == {i: B.quality(t) for i, t in docs}
    assert all(not (g[-1] and g[-2]) for g in got.values())
    assert quality_rules(empty(spark)).count() == 0


def test_bad_host_takes_its_documents_along(spark):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, "bad" if i % 50 else good, "worst") for i in range(200)] + [(1000 + i, good + f" {i}", f"h{i % 9}") for i in range(300)]
    got = by_id(quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")), "kept", "base_failed", "host_rate")
    assert not any(got[i][0] for i in range(200)) and all(got[1000 + i][0] for i in range(300))
    assert not got[0][1] and 0.5 < got[0][2] < 0.98  # drawn towards the mean


def test_lm_base(spark, frame, docs):
    names = ["held_out", "n_tokens", "n_known", "train_tokens"]
    want = B.unigrams(docs)
    got = by_id(lm_scoring(frame), *names, "base_score", "score")
    assert {i: g[:4] for i, g in got.items()} == {i: w[:4] for i, w in want.items()}
    assert all(abs(got[i][4] - w[4]) < 1e-6 * max(1, abs(w[4])) for i, w in want.items())
    assert all(g[5] < 0 for g in got.values())
    assert lm_scoring(empty(spark)).count() == 0


def test_mixing(spark, frame, docs, monkeypatch):
    sources = {r["doc_id"]: r["source"] for r in frame.select("doc_id", "source").collect()}
    size, of, target = B.targets([(i, t, sources[i]) for i, t in docs])
    got = by_id(mixing_report(frame, MixParams(block_words=16, shards=8)), "size", "source_size", "target", "taken")
    taken = {s: 0 for s in of}
    for i, (n, whole, goal, k) in got.items():
        assert (n, whole) == (size[i], of[sources[i]]) and abs(goal - target[sources[i]]) < 1e-6 * max(1, goal) and k <= 2 * n
        taken[sources[i]] += k
    assert all(abs(taken[s] - target[s]) <= 1 for s in of)
    again = by_id(mixing_report(frame.repartition(5), MixParams(block_words=16, shards=8)), "size", "source_size", "target", "taken")
    assert again == got
    monkeypatch.setattr("radpref.llm.mixing.SENT_SOURCES", 2)  # sources joined by salts
    assert by_id(mixing_report(frame, MixParams(block_words=16, shards=8)), "size", "source_size", "target", "taken") == got
    assert mixing_report(empty(spark)).count() == 0


def test_mix_deals_blocks_once(spark, frame):
    p = MixParams(block_words=8, shards=16)
    sizes = document_sizes(frame)
    rows = mix(sizes, source_targets(sizes, p), p).collect()
    keys = [(r["row"], r["block"], r["epoch"]) for r in rows]
    assert len(set(keys)) == len(keys)
    count = np.bincount([r["shard"] for r in rows], minlength=16)
    assert count.max() - count.min() <= 4 and len(count) == 16  # halves of halves
    assert mixed_documents(frame, MixParams(block_words=None, shard_words=100)).columns == frame.columns


def test_hypergeometric_draws(spark):
    """Against the distribution's own chances where the support is small, and its moments where it is large."""
    import math

    from radpref.llm.mixing import hypergeometric

    draws = 20_000
    for total, marked, drawn in ((40, 13, 20), (9, 9, 4), (50, 20, 0), (2000, 900, 1000), (10**10, 3 * 10**9, 5 * 10**9), (10**6, 70, 10**6 - 10)):
        at = lambda x: F.lit(x).cast("long")
        got = np.array([r[0] for r in spark.range(draws).select(hypergeometric(at(total), at(marked), at(drawn), F.lit(5), F.col("id"))).collect()], float)
        mean = drawn * marked / total
        var = mean * (1 - marked / total) * (total - drawn) / (total - 1)
        assert got.min() >= max(0, drawn - (total - marked)) and got.max() <= min(marked, drawn)
        assert abs(got.mean() - mean) <= 5 * math.sqrt(var / draws) + 1e-9, (total, got.mean(), mean)
        assert abs(got.var() - var) <= 0.06 * var + 5 * math.sqrt(var / draws), (total, got.var(), var)  # of rare draws a fourth moment about as large as the second
        if total <= 2000:
            for x in range(max(0, drawn - (total - marked)), min(marked, drawn) + 1):
                chance = math.comb(marked, x) * math.comb(total - marked, drawn - x) / math.comb(total, drawn)
                assert abs((got == x).mean() - chance) < 5 * math.sqrt(chance / draws) + 2e-4, (total, x)


def test_splitting_tree_keeps_quotas(spark):
    """Whatever number of sources a row may hold: leaves add up, and shards are halves of halves."""
    from radpref.llm.mixing import splitting_tree

    r = random.Random(5)
    quota = {i: r.randint(0, 60) for i in range(30)}
    frame = spark.createDataFrame(list(quota.items()), "source_no long, blocks long")
    for fan in (256, 4):
        leaves = splitting_tree(frame, 30, MixParams(shards=8, fan=fan)).collect()
        for s, n in quota.items():
            mine = sorted((x["shard"], x["first"], x["blocks"]) for x in leaves if x["source_no"] == s)
            assert sum(x[2] for x in mine) == n and [x[1] for x in mine] == [sum(y[2] for y in mine[:k]) for k in range(len(mine))]
        shard = [sum(x["blocks"] for x in leaves if x["shard"] == k) for k in range(8)]
        assert max(shard) - min(shard) <= 3


def test_mixed_documents_of_any_ids(spark):
    """Rows of no id and of repeated ids count for themselves; clashing names stay; no row of a full source is lost."""
    rows = [(None if k % 3 == 0 else k % 5, f"w{k} " * (k % 7 + 1), "s", k, k, k) for k in range(60)] + [(99, None, None, 1, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_row long, mix_shard long, MIX_KEY long")
    out = mixed_documents(docs, MixParams(block_words=None, shards=1, shard_words=40))
    assert out.columns == docs.columns
    got = Counter(map(tuple, out.collect()))
    assert set(got) == {r for r in rows if r[1]} and all(1 <= n <= 2 for n in got.values())
    words = sum(n * len(r[1].split()) for r, n in got.items())
    assert abs(words - 1.5 * sum(len(r[1].split()) for r in rows[:-1])) <= 7
    assert mixed_documents(docs.limit(0)).count() == 0


def test_ids_of_unsigned_crc(spark):
    from radpref.llm.common import held_out

    got = spark.range(50).select("id", held_out(F.col("id"), 7, 2).alias("h")).collect()
    assert {r["id"]: r["h"] for r in got} == {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in range(50)}
