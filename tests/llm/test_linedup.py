import random
from collections import Counter

import pytest

from verdure.llm import linedup as L

DOCS = "doc_id long, text string, rank string, pos string"


def corpus(seed):
    rnd = random.Random(seed)
    vocab = [f"line {i}" for i in range(25)]
    runs = [rnd.choices(vocab, k=rnd.randrange(1, 7)) for _ in range(6)]
    rows = []
    for d in range(40):
        own = []
        for _ in range(rnd.randrange(1, 5)):
            own += [f"own {d} {rnd.random()}"] * rnd.randrange(2) + rnd.choice(runs)
        rows.append((d * 7 % 40, rnd.choice(["\n", "\n\n", " \r\n"]).join(own), "x", "y"))
    rows += [(50, rows[3][1], "x", "y"), (50, rows[3][1], "x", "y"), (50, "line 1\nline 2", "x", "y"), (None, rows[5][1], "x", "y"), (51, None, "x", "y"), (52, " \n\t", "x", "y"), (53, "z\nz\nz\nz\nz", "x", "y"), (54, "one line", "x", "y"), (55, "one line", "x", "y"), (56, "w" * 100_000 + "\nq", "x", "y")]
    return rows


@pytest.mark.parametrize("seed,lines", [(1, 2), (2, 1), (3, 4)])
def test_equals_brute_force(spark, seed, lines):
    rows = corpus(seed)
    got = L.dedup_lines(spark.createDataFrame(rows, DOCS).repartition(3), lines).collect()
    want = L.brute([r[:2] for r in rows], lines)
    text = lambda d, t: want[L.NULL_ID if d is None else d, t] if t else t
    kept = [(d, text(d, t), a, b) for d, t, a, b in rows if not L.lines_of(t) or text(d, t) is not None]
    assert Counter(map(tuple, got)) == Counter(kept)
    assert len(kept) < len(rows) and sum(len(r[1] or "") for r in kept) < sum(len(r[1] or "") for r in rows)


def test_earlier_runs(spark):
    rows = [r for r in corpus(4) if r[0] is not None]
    docs = {(r[0], L._h(r[1])): [s for _, s in L.lines_of(r[1])] for r in rows if r[1]}
    df = spark.createDataFrame(rows, DOCS)

    def shared(k, i, k2, j):
        a, b, n = docs[k], docs[k2], 0
        while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
            n += 1
        return n

    suffixes = sorted((*k, i) for k, own in docs.items() for i in range(len(own)))
    got = {(r["d"], r["h"], r["pos"]): r for r in L.earlier_runs(df).collect()}
    for s in suffixes:
        best = max((shared(s[:2], s[2], t[:2], t[2]) for t in suffixes if t < s), default=0)
        assert (s in got) == (best > 0)
        if best:
            r = got[s]
            assert r["lines"] == shared(s[:2], s[2], (r["to_d"], r["to_h"]), r["to_pos"]) and r["lines"] * 2 > best >= r["lines"]
            assert (r["to_d"], r["to_h"], r["to_pos"]) < s
    runs = L.maximal_runs(df).collect()
    assert runs and all(r["lines"] >= 2 for r in runs) and len(runs) < len(got)


def test_ranks_are_in_order(spark):
    pairs = [(a, b) for a in range(20) for b in range(5) for _ in range(1 + (a * b) % 3)]
    got = sorted((r["a"], r["b"], r["rank"]) for r in L.ranked(spark.createDataFrame(pairs, "a long, b long").repartition(4)).collect())
    want = [p for p in sorted(set(pairs)) if pairs.count(p) > 1]
    assert [g[:2] for g in got] == want and [g[2] for g in got] == list(range(1, len(want) + 1))


def test_empty(spark):
    assert L.dedup_lines(spark.createDataFrame([], DOCS)).collect() == []


def test_long_lines_go_alone(spark):
    """A passage on one line between different neighbours is a later copy from 50 words on; a shorter one stays."""
    long, short = " ".join(f"w{i}" for i in range(50)), " ".join(f"w{i}" for i in range(49))
    rows = [(1, f"a\n{long}\nb\n{short}", "x", "y"), (2, f"c\n{long}\nd\n{short}\ne", "x", "y"), (3, long, "x", "y"), (4, f"f\n{long}\n{long}", "x", "y"), (5, f"c\n{long}", "x", "y"), (6, short, "x", "y")]
    got = {r["doc_id"]: r["text"] for r in L.dedup_lines(spark.createDataFrame(rows, DOCS), 2, alone=50).collect()}
    assert got == {1: rows[0][1], 2: f"c\nd\n{short}\ne", 4: "f", 6: short}
    assert got == {d: t for (d, _), t in L.brute([r[:2] for r in rows], 2, 50).items() if t is not None}
    assert L.dedup_lines(spark.createDataFrame(rows, DOCS), 2).count() == 5
