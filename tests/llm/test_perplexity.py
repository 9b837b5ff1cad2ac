import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from verdure.llm import perplexity as P

DOCS = "doc_id long, text string, lang string, source string, g string"


@given(st.lists(st.sampled_from(["a", "b", "c#", "é|", " ", "\n", "\n\n", "\t", " ", "x y z a b", "<>"]), max_size=30).map("".join))
@settings(max_examples=300, deadline=None)
def test_base_numbers(text):
    assert P.base_numbers(text) == P.brute_numbers(text)


def test_hash_array():
    rnd = np.random.default_rng(1)
    keys = np.unique(rnd.integers(0, 2**63, 5000))
    a = P.HashArray(keys[::2], np.arange(len(keys[::2])))
    got = a.get(keys.astype(np.uint64))
    assert (got[::2] == np.arange(len(keys[::2]))).all() and np.isnan(got[1::2]).all()
    assert np.isnan(P.HashArray(keys[:0], keys[:0]).get(keys[:3].astype(np.uint64))).all()


def corpus():
    rnd = random.Random(4)
    words = {x: ["".join(rnd.choices(a, k=rnd.randrange(2, 7))) for _ in range(60)] for x, a in (("en", "thernaiso"), ("fr", "éàulesinq"), (None, "xyzw"))}
    rows = [(i, " ".join(rnd.choices(words[x], k=rnd.randrange(5, 60))), x, "s", "g") for i in range(240) for x in [rnd.choice(["en", "en", "fr", None])]]
    rows += [(300, None, "en", "s", "g"), (301, "", None, "s", "g"), (302, "qxj zzk vvw qqq jjj kkx wwv zxq jkq vqz xkj zzz qjq zjx vkz kqv jxz wqk qvx zkw jqw xzv kjz", "en", "s", "g"), (303, "word " * 40_000, "en", "s", "g"), (303, "a b c d e f g h i j k l m", "en", "s", "g"), (None, "one", "de", "s", "g")]
    return rows


def test_scores_equal_formulas(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    want = dict(zip(((r[0], r[1]) for r in rows), P.brute_logppl([(r[2], r[1]) for r in rows])))
    for units in (P.BLOCK_UNITS, 2000, 0):  # one block a task, some, one for each document: equal scores
        got = P.score_documents(df, ["doc_id", "text"], units).collect()
        assert len(got) == len(rows)
        for r in got:
            assert math.isclose(r["verdure_logppl"], want[r["doc_id"], r["text"]], rel_tol=1e-8, abs_tol=1e-8)


def test_verdicts(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, DOCS)
    got = P.quality(df, width=2.0, short=50.0).collect()
    by = {(r["doc_id"], r["n_words"]): r for r in got}
    for d, text, *_ in rows:
        n = P.brute_numbers(text)
        r = by[d, n[0]]
        assert tuple(r[c] for c in P.NUMBERS) == n
        assert r["base_failed"] == (n[0] < 10 or 100 * n[4] > 20 * n[0])
        assert r["kept"] == (not r["base_failed"] and r["low"] <= r["logppl"] <= r["high"])
    assert not by[302, 23]["kept"] and not by[302, 23]["base_failed"]
    kept = P.filter_documents(df, width=2.0, short=50.0).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == sorted((str(d), t) for d, t, *_ in rows if by[d, P.brute_numbers(t)[0]]["kept"])
    assert 0.5 * len(rows) < len(kept) < len(rows)


def test_quartiles_of_all_documents(spark):
    rng = random.Random(4)
    rows = [(lang, round(rng.gauss(m, 0.7), 9)) for lang, m, n in (("en", 3.0, 25_000), ("de", 5.0, 7), ("fr", 2.0, 1)) for _ in range(n)] + [("it", 4.25)] * 1000 + [("it", None), ("pt", None)]
    want = {}
    for lang in ("en", "de", "fr", "it"):
        v = sorted(x for k, x in rows if k == lang and x is not None)
        want[lang] = tuple(math.floor(v[-(-q * len(v) // 4) - 1] * P.STEPS + 0.5) / P.STEPS for q in (1, 3))
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "verdure_band string, verdure_logppl double").repartition(parts)
        assert {r[0]: (r[1], r[2]) for r in P.quartiles(df).collect()} == want


def test_unseen_grams_back_off(spark):
    rows = [(i, t, "en", "s", "g") for i, t in enumerate(["the cat sat on the mat", "the dog sat on the rug", "a cat and a dog"])]
    model = P.load(P.kneser_ney(P.count_grams(spark.createDataFrame(rows, DOCS))))["en"]
    known, odd, alien = (model.logp(P.grams(P.units(t))) for t in ("the cat sat on the mat", "the dog sat on the cat", "Ж"))
    assert np.isfinite(odd).all() and np.isfinite(alien).all() and known.mean() > odd.mean() > alien.mean()
    # after a seen context all units' probabilities, unseen ones' share included, add up to one
    ctx = P.units("the")[3:6]
    alphabet = sorted({u for r in rows for u in P.units(r[1])[3:].tolist()})
    total = sum(math.exp(model.logp(P.grams(np.array([*ctx, u], np.uint16)))[0]) for u in alphabet)
    assert math.isclose(total, 1.0, rel_tol=1e-4)


@pytest.mark.parametrize("units", [P.BLOCK_UNITS, 0])
def test_empty(spark, units):
    assert P.quality(spark.createDataFrame([], DOCS), block_units=units).collect() == []


def test_names_and_languages(spark):
    """Columns that differ in case, or have names of our own, stay; null and a text of one zero byte are two languages."""
    names = ["doc_id", "DOC_ID", "text", "lang", "verdure_l", "k0", "block"]
    rows = [(i, "x", " ".join(f"{'ab' if i % 2 else 'yz'}{j}" for j in range(i, i + 40)), None if i % 2 else "\0", "v", i, "b") for i in range(30)]
    df = spark.createDataFrame(rows, "a long, b string, c string, d string, e string, f int, g string").toDF(*names)
    out = P.filter_documents(df, width=50.0)
    assert out.columns == names
    kept = {tuple(r) for r in out.collect()}
    assert kept <= set(rows) and len(kept) > 20
    want = P.brute_logppl([(r[3], r[2]) for r in rows])
    got = {r["doc_id"]: r["logppl"] for r in P.quality(df).collect()}
    assert all(math.isclose(got[r[0]], w, abs_tol=1e-8) for r, w in zip(rows, want))
