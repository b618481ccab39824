"""Every registered query of the engine against its SQL, on the smallest tables."""

import os
import re

import pytest

DATA = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
from radpref.queries import ORACLES, QUERIES  # noqa: E402


def plain(v):
    if v is None or v != v:
        return None
    return round(float(v), 9) if isinstance(v, (int, float)) else v


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM read_parquet('{DATA}/{name}')")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, tables, name):
    df = QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    cur = tables.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall()), key=str)
    assert got == want


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_conversation_edits(spark, tmp_path):
    import __spark_entry__

    texts = ["Über die Straße", "Uber die Strasse", "две строки\nи ещё\tодна", "две строки и еще одна", "漢字 と 😀", "漢宇 と 😁!", "eins\nzwei", "einszwei", "", None, "é , e", "e, é"]
    spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["turn"]: r for r in __spark_entry__.queries()["conversation_edits"](spark, str(tmp_path)).collect()}
    assert set(got) == set(range(1, len(texts)))
    for i, r in got.items():
        a, b = (re.sub(r"\s+", " ", re.sub(r"\s*([,.;:])\s*", r"\1 ", re.sub(r"\s+", " ", (t or "").strip().lower()))).strip() for t in texts[i - 1 : i + 1])
        want = levenshtein(a, b) if a and b else None
        assert r["distance"] == want and r["share"] == (None if want is None else round(want / max(len(a), len(b)), 4)), (a, b)
