import random

import numpy as np
import pytest

from verdure.llm import substrings as S
from verdure.llm import words as W


def test_word_hashes_and_bounds():
    text = "\x0b é\tbb  a\r\nbb é\x0c"
    raw = np.frombuffer(text.encode(), np.uint8)
    s, e = W.word_bounds(raw)
    assert [raw[a:b].tobytes() for a, b in zip(s, e)] == text.encode().split()
    h = W.word_hashes(raw, s, e)
    assert h[0] == h[4] and h[1] == h[3] and len(set(h.tolist())) == 3


@pytest.mark.parametrize("w", [1, 2, 3, 7, 26])
def test_window_min(w):
    v = np.random.default_rng(w).integers(0, 9, 100).astype(np.uint64)
    assert W.window_min(v, w).tolist() == [i + int(np.argmin(v[i : i + w])) for i in range(100 - w + 1)]


def corpus(seed, length):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)]
    passages = [rnd.choices(vocab, k=rnd.randrange(length - 2, 3 * length)) for _ in range(6)]
    rows = []
    for d in range(60):
        parts = []
        for _ in range(rnd.randrange(4)):
            p = list(rnd.choice(passages))
            if rnd.random() < 0.4:
                p[rnd.randrange(len(p))] = "edit"
            parts += rnd.choices(vocab, k=rnd.randrange(6)) + p
        rows.append((d, rnd.choice([" ", "\n", "  \t"]).join(parts), "x"))
    rows += [(60 + k, rows[k % 3 + 5][1], "copy") for k in range(12)]
    rows += [(90, "a " * 200, "x"), (91, "a " * 150, "x"), (92, None, "x"), (93, "", "x"), (None, rows[7][1], "x"), (95, rows[9][1], "x"), (95, rows[9][1], "x"), (95, rows[11][1] + " " + rows[9][1], "x"), (96, rows[11][1] + " " + rows[11][1], "x")]
    return rows


@pytest.mark.parametrize("seed,length,gram,group", [(1, 10, 5, 4000), (2, 10, 5, 1), (3, 12, 4, 2), (4, 50, 25, 4000), (5, 10, 4, 6)])
def test_equals_brute_force(spark, seed, length, gram, group):
    rows = corpus(seed, length)
    df = spark.createDataFrame(rows, "doc_id long, text string, own string").repartition(3)
    got = [tuple(r) for r in S.kept_digest(S.dedup_substrings(df, length, gram, group)).collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    want = S.brute([r[:2] for r in rows], length)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sum(r[2] for r in want) > 300


def test_empty(spark):
    assert S.dedup_substrings(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("group", [4000, 3])
def test_maximal_repeats(spark, group):
    """Runs of windows with one least document, against all windows of all documents; however prefixes grow."""
    length = 10
    rows = [(r[0], r[1]) for r in {r[0]: r for r in corpus(6, length) if r[0] is not None}.values()]
    words = {d: (t or "").split() for d, t in rows}
    least = {}
    for d in sorted(words):
        for i in range(len(words[d]) - length + 1):
            least.setdefault(tuple(words[d][i : i + length]), d)
    want = []
    for d, w in words.items():
        for i in range(len(w) - length + 1):
            v = least[tuple(w[i : i + length])]
            if v < d:
                if want and want[-1][0] == d and want[-1][3] == v and want[-1][1] + want[-1][2] - length + 1 == i:
                    want[-1][2] += 1
                else:
                    want.append([d, i, length, v])
    got = S.maximal_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), length, 5, group).collect()
    assert sorted((r["doc_id"], r["first"], r["n_words"], r["least_id"]) for r in got) == sorted(map(tuple, want)) and len(want) > 20


def test_long_text_and_names(spark):
    """A text of 30,000 words that another one holds in part, and columns that differ in case."""
    long = " ".join(f"w{i * i % 9973}x{i}" for i in range(30_000))
    rows = [(1, "t", long, "T"), (2, "t", " ".join(long.split()[20_000:20_120]) + " end", "T")]
    df = spark.createDataFrame(rows, "a long, b string, c string, e string").toDF("doc_id", "DOC_ID", "text", "Text")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in S.dedup_substrings(df).collect()}
    assert got == {1: (30_000, 0, long), 2: (121, 120, "end")}
    assert [tuple(r)[2:] for r in S.maximal_repeats(df).collect()] == [(0, 120, 1)]
    assert not spark.catalog.listTables()
