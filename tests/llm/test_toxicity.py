import zlib

import numpy as np
import pytest

from verdure.llm import queries
from verdure.llm import toxicity as T

SCHEMA = "doc_id long, text string"


def auc(scores, truth):
    order = np.argsort(scores, kind="stable")
    _, rank = np.unique(np.array(scores)[order], return_inverse=True)
    truth = np.array(truth)[order]
    pos, neg = rank[truth == 1], rank[truth == 0]
    return np.mean([(np.mean(p > neg) + np.mean(p == neg) / 2) for p in pos])


def test_risk_takes_the_positives_out_of_the_unlabelled():
    """Half of the unlabelled rows are positive: features 0 (positives) and 1 (negatives) get opposite signs although both are unlabelled as often."""
    rng = np.random.default_rng(1)
    noise = lambda: [int(f) for f in rng.choice(np.arange(2, 12), 3, replace=False)]
    toxic = [[0, *noise()] for _ in range(300)]
    unlabelled = [[i % 2, *noise()] for i in range(1000)]
    w, b = T.fit(T.Sets.of(toxic), T.Sets.of(unlabelled), 0.5, 12)
    p = lambda f: 1 / (1 + np.exp(-(b + w[f])))
    assert p(0) > 0.9 and p(1) < 0.1 and np.abs(w[2:]).max() < 1.5


def test_non_negative_risk():
    """With more features than rows the positives' part would make the negative part of the risk fall without bound."""
    toxic, unlabelled = [[i] for i in range(20)], [[i + 20] for i in range(20)]
    w, b = T.fit(T.Sets.of(toxic), T.Sets.of(unlabelled), 0.3, 40, rounds=300)
    assert np.isfinite(w).all() and np.abs(w).max() < 50


def test_toxic_rows_among_many_common_features():
    """Texts with dozens of features that are as frequent in either class, and two or three of five that only toxic ones have; one in ten rows is toxic."""
    rng = np.random.default_rng(1)

    def texts(toxic):
        own = lambda t: rng.choice(5, rng.integers(2, 4), replace=False).tolist() if t else []
        return [own(t) + (5 + rng.choice(200, rng.integers(30, 60), replace=False)).tolist() for t in toxic]

    w, b = T.fit(T.Sets.of(texts([True] * 300)), T.Sets.of(texts(rng.random(1000) < 0.1)), 0.1, 205)
    truth = rng.random(600) < 0.2
    caught = np.array([b + w[t].sum() >= 0 for t in texts(truth)])
    assert caught[truth].mean() > 0.9 and caught[~truth].mean() < 0.02


def test_no_features_leave_the_prior():
    w, b = T.fit(T.Sets.of([[]] * 12), T.Sets.of([[]] * 60), 0.1, 0)
    assert len(w) == 0 and 1 / (1 + np.exp(-b)) == pytest.approx(0.1, abs=0.02)


def test_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in queries.QUERIES["op13_toxicity"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for d, r in rows.items())
    labels = [tuple(x) for x in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic").collect() if x[0] in rows and rows[x[0]]["held_out"]]
    scores, truth = [rows[d]["score"] for d, _ in labels], [t for _, t in labels]
    assert auc(scores, truth) > 0.88
    assert np.mean([(s >= 0.5) == t for s, t in zip(scores, truth)]) > 0.93


def test_held_out_labels_are_not_read(spark):
    """Turning the labels of held-out rows round changes nothing."""
    docs = spark.createDataFrame([(i, f"word{i % 7} text rude{i}" if i % 4 else f"rude insults word{i % 7}") for i in range(200)], SCHEMA)
    own = [(i, int(i % 4 == 0)) for i in range(0, 200, 2)]
    other = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in own]
    models = [T.learn(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (own, other)]
    assert models[0].known == models[1].known and np.array_equal(models[0].weights, models[1].weights)
    assert models[0].known["insults"] >= 0 and models[0].score(T.Finder(models[0].known)("Insults, rude")) > 0.5 > models[0].score(T.Finder(models[0].known)("word1 text"))


def test_odd_rows(spark):
    labels = "doc_id long, toxic int"
    empty = spark.createDataFrame([], SCHEMA)
    assert T.learn(empty, spark.createDataFrame([], labels)) is None
    assert T.score_documents(empty, None).collect() == []
    rows = [(None, None), (1, ""), (1, ""), (2, "bad bad bad"), (3, "bad " * 300_000), (4, "fine words here"), *((i, "bad thing") for i in range(5, 40)), *((i, "fine thing") for i in range(40, 200))]
    docs = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", DOC_ID long")
    model = T.learn(docs, spark.createDataFrame([(i, int(i < 40)) for i in range(5, 200)] + [(7, 0), (None, 1), (8, None)], labels))
    got = T.score_documents(docs, model).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add(r["score"])
    assert all(len(s) == 1 for s in by.values()) and by[2] == by[3] and max(by[1]) == max(by[None]) < 0.5 < max(by[2])
    assert [r for r in got if r["doc_id"] is None][0]["held_out"]
    assert all(r["score"] == 0 for r in T.score_documents(docs, None).collect())


@pytest.mark.parametrize("word,want", [("abc", ["abc"]), ("abcde", ["abcde", "^abcd", "^abcde"])])
def test_features(word, want):
    assert T.features_of(word) == want


def test_different_words_of_a_beginning_are_counted():
    """Forms that no labelled text has count by their number; repeats of one word don't."""
    find = T.Finder({"^bome": 0, "2^bome": 1, "3^bome": 2, "bomex": 3})
    for text, want in (("bomea Bomea", {0}), ("bomea bomeb", {0, 1}), ("bomea bomeb bomec bomed", {0, 1, 2}), ("bomex x", {0, 3}), ("bom", set())):
        assert find(text) == find(text) == want
    find = T.Finder({"2^bome": 0})
    assert find("bomea") == set() and find("bomea bomeb") == {0}
    assert set(T.levels(["^bome", "^bome", "^x", "^y", "^y", "^y"])) == {"2^bome", "2^y", "3^y"}
