import random

import pytest

from verdure.llm import simhash as S

DOCS = "doc_id long, text string, fp string"


def corpus():
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    base = [rnd.choices(vocab, k=80) for _ in range(12)]
    rows = []
    for d in range(80):
        w = list(base[d % 12])
        for _ in range(rnd.randrange(3)):
            w[rnd.randrange(80)] = rnd.choice(vocab)
        rows.append((d * 3 % 80 + 100, " ".join(w), "x"))
    rows += [(1, None, "x"), (2, " \n", "x"), (3, "A b", "x"), (4, "a  B", "x"), (5, "One", "x"), (5, "one", "x"), (6, "x y z", "x"), (None, "one", "x"), (7, "w1 " * 30000, "x")]
    return rows


@pytest.mark.parametrize("bucket", [32, 1, 2])
def test_equals_brute_force(spark, bucket):
    rows = corpus()
    got = S.near_duplicates(spark.createDataFrame(rows, DOCS).repartition(3), bucket=bucket).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(S.brute([r[:2] for r in rows]), key=key)
    assert len({r["component_id"] for r in got}) < len(rows) - 10


@pytest.mark.parametrize("bucket", [32, 1])
def test_links_of_close_fingerprints(spark, bucket):
    """A chain and a cluster of fingerprints a few bits apart, and some further away."""
    rnd = random.Random(9)
    fps, x = set(), rnd.getrandbits(64)
    for _ in range(40):
        for b in rnd.sample(range(64), rnd.choice([1, 2, 3, 5])):
            x ^= 1 << b
        fps.add(x)
    c = rnd.getrandbits(64)
    fps |= {c ^ 1 << i for i in range(64)} | {c ^ 3 << i for i in range(0, 60, 7)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = S.near_pairs(spark.createDataFrame([(f,) for f in signed], "fp long"), bucket)
    roots = {r["a"]: r["root"] for r in S.components(links).collect()}
    least = {f: f for f in signed}
    while True:
        new = {f: min(least[g] for g in signed if ((f ^ g) & (2**64 - 1)).bit_count() <= 2) for f in signed}
        if new == least:
            break
        least = new
    assert all(roots.get(f, f) == least[f] for f in signed) and len(set(least.values())) < len(signed) - 60


def test_keep_one(spark):
    df = spark.createDataFrame(corpus(), DOCS)
    kept = S.keep_one(df, S.near_duplicates(df)).collect()
    assert len(kept) == len({r["component_id"] for r in S.near_duplicates(df).collect()})


def test_empty(spark):
    assert S.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []
