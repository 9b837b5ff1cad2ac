import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from verdure.llm import mixing as M

DOCS = "doc_id long, text string, source string, size string, h string"


@given(st.lists(st.tuples(st.floats(0.01, 0.99), st.integers(1, 5000)), min_size=1, max_size=60), st.integers(0, 99))
@settings(max_examples=200, deadline=None)
def test_flight_keeps_totals(units, seed):
    pi, size = np.array([u[0] for u in units]), np.array([u[1] for u in units], float)
    a = np.column_stack([size, np.ones(len(pi))])
    p = M.flight(pi, a, np.random.default_rng(seed))
    assert ((p > 1e-9) & (p < 1 - 1e-9)).sum() <= 2 and p.min() >= 0 and p.max() <= 1
    assert np.allclose(p @ a, pi @ a, rtol=1e-5, atol=1e-4)
    assert set(np.unique(M.landing(p, size, float(pi @ size)))) <= {0.0, 1.0}


def test_flight_is_unbiased():
    pi, size = np.full(12, 0.3), np.arange(1, 13) * 1.0
    a = np.column_stack([size, np.ones(12)])
    mean = np.mean([M.flight(pi, a, np.random.default_rng(s)) for s in range(4000)], axis=0)
    assert np.abs(mean - 0.3).max() < 0.05


@given(st.lists(st.tuples(st.floats(0.01, 0.99), st.integers(1, 20_000)), min_size=1, max_size=80), st.integers(0, 99))
@settings(max_examples=100, deadline=None)
def test_long_first_keeps_sizes(units, seed):
    pi, size = np.array([u[0] for u in units]), np.array([u[1] for u in units], float)
    p = M.fly(pi, size, seed)
    assert ((p > 1e-9) & (p < 1 - 1e-9)).sum() <= 2 and p.min() >= 0 and p.max() <= 1
    assert np.isclose(p @ size, pi @ size, rtol=1e-5, atol=1e-3)


def test_inclusion_is_the_probability():
    """Flight and landing keep every document's probability, long ones' too; the sums stay near what is expected."""
    size = np.sort(np.random.default_rng(1).pareto(1.1, 300) * 20 + 1).round().clip(max=500)
    pi, runs = np.full(300, 0.3), 600
    got = np.array([M.landing(M.fly(pi, size, s), size, s + 10**6) for s in range(runs)])
    assert set(np.unique(got)) == {0.0, 1.0}
    assert np.abs(got.mean(axis=0).reshape(6, 50).mean(axis=1) - 0.3).max() < 0.01
    assert np.abs(got.mean(axis=0) - 0.3).max() < 0.08  # four standard deviations of one document
    assert np.abs(got @ size - 0.3 * size.sum()).max() < 0.01 * size.sum()
    decided = np.array([1.0, 0.0, 0.4, 1.0])
    assert {tuple(M.landing(decided, np.array([9.0, 9, 2, 9]), s)[[0, 1, 3]]) for s in range(20)} == {(1.0, 0.0, 1.0)}


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100, None: 7}, {"a": 1, "b": 5000, "c": 3, "d": 40, "é": 9}, {"x": 10}, {"a": 0, "b": 3}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long").repartition(3)
    got = {r["source"]: r["target"] for r in M.targets(df, (3, 1, 2), 1.5, 2.0).collect()}
    want = M.brute_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 * max(1, want[k]) for k in want)


def corpus():
    rnd = random.Random(2)
    rows = [(i, " ".join(["w"] * max(0, int(rnd.paretovariate(1.1) * 5))), rnd.choice(["a", "a", "a", "b", "c", "dd", None]), "x", "x") for i in range(900)]
    rows += [(5000, None, "a", "x", "x"), (5001, "", "zero", "x", "x"), (None, "one two", "b", "x", "x")] + [(7000, "r s t", "c", "x", "x")] * 4
    return rows


@pytest.mark.parametrize("block", [8192, 60])
def test_mix(spark, block):
    rows = corpus()
    df = spark.createDataFrame(rows, DOCS)
    got = M.mix(df.repartition(3), block=block).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r[0], size(r[1])) for r in rows)
    total = defaultdict(int)
    for r in rows:
        total[r[2]] += size(r[1])
    want = M.brute_targets(dict(total))
    by_doc = {r[0]: r[2] for r in rows}
    taken, docs_taken = defaultdict(int), defaultdict(float)
    for r in got:
        s = by_doc[r["doc_id"]]
        assert r["source_size"] == total[s] and abs(r["target"] - want[s]) < 1e-6
        assert r["taken"] <= 2 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[s] += r["taken"]
        docs_taken[s] += r["taken"] / r["size"] if r["size"] else 0
    for s in total:
        assert abs(taken[s] - want[s]) <= 12, (s, taken[s], want[s])
        n = sum(1 for r in rows if r[2] == s and size(r[1]))
        assert not n or abs(docs_taken[s] - n * want[s] / total[s]) <= 12
    again = M.mix(df.repartition(5), block=block).collect()
    assert Counter((r["doc_id"], r["taken"]) for r in again) == Counter((r["doc_id"], r["taken"]) for r in got)
    mixed = Counter(r["doc_id"] for r in M.mixed_documents(df, block=block).collect())
    want_rows = Counter()
    for r in got:
        if r["taken"]:
            want_rows[r["doc_id"]] += r["taken"] // r["size"]
    assert mixed == want_rows


def test_empty(spark):
    df = spark.createDataFrame([], DOCS)
    assert M.mix(df).collect() == [] and M.mixed_documents(df).collect() == []


def test_names_and_long_texts(spark):
    """Columns that differ in case, or have names of our own, stay as they are; a text of 50,000 words is a size."""
    names = ["doc_id", "DOC_ID", "text", "source", "h", "times", "c0", "verdure_h"]
    rows = [(i, "x", "w " * (50_000 if i == 3 else 5), "a", i, 1, "c", "v") for i in range(40)]
    df = spark.createDataFrame(rows, "a long, b string, c string, d string, e long, f int, g string, i string").toDF(*names)
    out = M.mixed_documents(df)
    assert out.columns == names and {tuple(r) for r in out.collect()} <= set(rows)
    got = {r["doc_id"]: r for r in M.mix(df).collect()}
    assert got[3]["size"] == 50_000 and len(got) == 40 and all(r["taken"] % r["size"] == 0 for r in got.values())


@given(st.lists(st.tuples(st.floats(0.01, 0.99), st.integers(1, 3000)), min_size=1, max_size=M.REST), st.integers(0, 99))
@settings(max_examples=60, deadline=None)
def test_landing_meets_the_sum(units, seed):
    """Against all subsets: the sum is as near as any subset's, but for a hundredth of what is expected."""
    pi, size = np.array([u[0] for u in units]), np.array([u[1] for u in units], float)
    best = min(abs(sum(s for i, s in enumerate(size) if c >> i & 1) - pi @ size) for c in range(2 ** len(units)))
    p = M.landing(pi, size, seed)
    assert set(np.unique(p)) <= {0.0, 1.0} and abs(p @ size - pi @ size) <= best + 0.01 * (pi @ size) + 1e-6


def test_landing_keeps_probabilities():
    """Where subsets near the sum allow it, twelve documents keep their probabilities."""
    pi, size = np.tile([0.2, 0.4, 0.6, 0.8], 3), np.repeat([30.0, 20, 10], 4)
    got = np.mean([M.landing(pi, size, s) for s in range(3000)], axis=0)
    assert np.abs(got - pi).max() < 0.05


def test_few_long_documents_meet_the_target():
    size = np.array([2933.0, 933, 395, 330, 233, 233, 224, 136])
    for seed in range(20):
        p = M.landing(M.fly(np.full(8, 0.82), size, seed, M.REST), size, seed + 1)
        assert abs(p @ size - 0.82 * size.sum()) <= 0.02 * size.sum()
