import random

import pytest

from verdure.llm import merkle as M

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("step", [1, 2, 3])
@pytest.mark.parametrize("n,height", [(1, 0), (2, 1), (3, 2), (5, 3), (8, 3), (13, 4), (16, 4), (37, 6), (5, 4), (64, 6)])
def test_traversal(n, height, step):
    leaves = [M.digest(str(i)) for i in range(n)]
    root, paths = M.block_root(leaves, height), list(M.traverse(leaves, height, step))
    assert len(paths) == n and all(len(p) == height for p in paths)
    assert all(M.fold(x, p) == root for x, p in zip(leaves, paths))
    assert not n > 1 or M.fold(M.digest("other"), paths[0]) != root


def test_traversal_keeps_few_nodes():
    """What the growing of a subtree has at once is its own nodes and one node a level."""
    kept = {}
    leaves = [str(i) for i in range(1 << 10)]
    for _ in M._grow(leaves, 0, 8, 10, kept):
        assert len(kept) <= 4 + 2
    assert kept[8, 1] == M.block_root(leaves[256:512], 8)


def test_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice(["en", "en", "en", "en", "", None, "é", "z"]), rng.choice([None, i]), rng.choice([None, "", "héllo " * rng.randint(0, 3), "x" * 3])) for i in range(300)]
    rows += [rows[7]] * 3 + [(None, "a", "en", 1, "t"), (None, "a", "en", 1, "t"), (12, "a", "solo", 1, "w" * 300_000)]
    rows += [(1000 + i, "s", f"l{i}", i, "t") for i in range(20)]
    import zlib

    change = lambda r: (*r[:3], r[3] + 1, r[4]) if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 else r
    docs = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", LANG long")
    got = [r.asDict() for r in M.proof_digest(M.manifest(M.tampered(docs), 3)).collect()]  # several rounds of blocks on few rows
    want = M.brute(rows, change)
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["leaf"], r["proof_sha256"])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {r["verified"] for r in got} == {True, False}


def test_small_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert M.proof_digest(M.manifest(M.tampered(empty))).collect() == []
    one = M.manifest(M.leaves(spark.createDataFrame([(1, None, None, None, None)], SCHEMA))).collect()[0]
    assert one["leaf"] == M.digest("1:1", "-", "-", "-", "-") == one["subroot"] == one["root"] == one["folded_root"] and one["proof"] == []


def test_query_against_sql(spark):
    import duckdb

    from verdure.llm import queries

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    res = con.execute(queries.ORACLES["op12_merkle_manifest"])
    names = [d[0] for d in res.description]
    got = queries.QUERIES["op12_merkle_manifest"](spark, sf)
    assert sorted(names) == sorted(got.columns)
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == sorted(res.fetchall())
