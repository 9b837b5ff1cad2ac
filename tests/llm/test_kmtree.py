import numpy as np
import pytest

from verdure.llm import kmtree as K

SCHEMA = "vec_id long, embedding array<float>, label int, vec string"


def rows(n, d=16, seed=1):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(12, d))
    x = centres[rnd.integers(0, 12, n)] + 0.7 * rnd.normal(size=(n, d))
    x *= rnd.uniform(0.5, 1.5, (n, 1))
    out = [(i, [float(np.float32(v)) for v in x[i]], 0, "x") for i in range(n)]
    same = out[5][1]
    out += [(n + i, same, 1, "x") for i in range(150)]
    z = [0.0] * d
    bad = [(None, same), (9001, None), (9020, []), (9040, z), (9060, [None, *z[1:]]), (9080, [float("nan"), *same[1:]]), (9100, [float("inf"), *same[1:]]), (9120, [1.0, 2.0])]
    return out + [(i, v, 1, "x") for i, v in bad]


@pytest.mark.parametrize("block", [4096, 40])
def test_recall_and_scores(spark, block):
    data = rows(1500)
    got = [tuple(r) for r in K.search(spark.createDataFrame(data, SCHEMA).repartition(3), every=20, k=10, sample=700, most=20, block=block).collect()]
    want = K.brute([r[:2] for r in data], 20, 10)
    by = {i: np.array(v, "<f4") for i, v, _, _ in data if i is not None and v and len(v) == 16 and None not in v}
    assert len(got) == len(want) and {g[:2] for g in got} == {w[:2] for w in want}
    assert all(g[3] == float(np.cumsum(by[g[0]].astype(float) * by[g[2]].astype(float))[-1]) for g in got)
    lists = {}
    for q, r, v, s in sorted(got):
        lists.setdefault(q, []).append((-s, v))
    assert all(x == sorted(x) and q not in [v for _, v in x] for q, x in lists.items())
    assert len({g[::2] for g in got} & {w[::2] for w in want}) >= 0.9 * len(want)
    same = [g for g in got if g[0] >= 1500]  # its own class is nearest, smallest ids first
    assert same and all(w in got for w in want if w[0] >= 1500 and w[3] == max(g[3] for g in same))


def test_whole_tree_is_exact(spark):
    data = rows(300)
    got = sorted(tuple(r) for r in K.search(spark.createDataFrame(data, SCHEMA), every=20, k=400, sample=200, most=20, recall=1.0).collect())
    assert got == sorted(K.brute([r[:2] for r in data], 20, 400))


def test_few_and_none(spark):
    assert K.search(spark.createDataFrame([], SCHEMA)).collect() == []
    two = [(0, [1.0, 2.0], 0, "x"), (20, [0.5, 1.0], 0, "x")]
    assert sorted(tuple(r) for r in K.search(spark.createDataFrame(two, SCHEMA)).collect()) == [(0, 1, 20, 2.5), (20, 1, 0, 2.5)]
