import random

import numpy as np
import pytest

from verdure.llm import similar as S

DOCS = "doc_id long, text string, c string"


def test_wide_fingerprints_bit_by_bit():
    texts = ["a b c d e f g", "", None, "one", "A b  c D e f h"]
    got = S.wide_fingerprints(texts, 5, 3)
    for t, fp in zip(texts, got):
        h = np.array(S.shingle_hashes(t, 5), np.uint64)
        for w in range(3):
            with np.errstate(over="ignore"):
                own = [int(x) for x in (S.mix(h + np.uint64(w) * S._STEP) if w else h)]
            assert int(fp[w]) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in own) > len(own))


def least(nodes, linked):
    out = {n: n for n in nodes}
    while True:
        new = {n: min([out[n], *(out[m] for m in nodes if linked(n, m))]) for n in nodes}
        if new == out:
            return out
        out = new


@pytest.mark.parametrize("bucket,b", [(64, 16), (1, 16), (8, 20), (2, 20)])
def test_links_equal_brute_force(spark, bucket, b, monkeypatch):
    """Components of all pairs that meet in a segment and are near enough."""
    rnd = random.Random(b)
    monkeypatch.setattr(S, "BLOCK", 16)
    rows = {}
    for base in range(6):
        x = [rnd.getrandbits(64) for _ in range(2)]
        for n in range(25):
            y = list(x)
            for _ in range(rnd.choice([0, 3, 8, 14, 20])):
                y[rnd.randrange(2)] ^= 1 << rnd.randrange(64)
            rows[base * 100 + n] = tuple(y)
    each, most = 64 // b, 18
    segs = {i: [y[w] >> s * b & (1 << b) - 1 for w in range(2) for s in range(each)] for i, y in rows.items()}
    linked = lambda i, j: sum((p ^ q).bit_count() for p, q in zip(rows[i], rows[j])) <= most and any((p ^ q).bit_count() <= 1 for p, q in zip(segs[i], segs[j]))
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    df = spark.createDataFrame([(i, signed(y[0]), signed(y[1])) for i, y in rows.items()], "c long, f0 long, f1 long")
    roots = {r["a"]: r["root"] for r in S.components(S.near_links(df, 2, b, most, bucket)).collect()}
    got = {i: roots.get(i, i) for i in rows}
    assert all(got[i] == got[j] for i in rows for j in rows if linked(i, j))  # whoever meets in a segment is together
    near = least(list(rows), lambda i, j: sum((p ^ q).bit_count() for p, q in zip(rows[i], rows[j])) <= most)
    assert all(near[i] == near[got[i]] for i in rows) and len(set(got.values())) < len(rows)  # blocks may find more, all of it near enough


def test_recall_and_precision(spark):
    rnd = random.Random(1)
    vocab = [f"w{i}" for i in range(2000)]
    rows, want = [], {}
    for g in range(60):
        base = rnd.choices(vocab, k=200)
        for n in range(3):
            w = list(base)
            for _ in range(0 if n == 0 else 2):
                w[rnd.randrange(200)] = "x%d" % rnd.randrange(10**6)
            rows.append((g * 10 + n, " ".join(w), "x"))
            want[g * 10 + n] = g * 10
        other = rnd.choices(vocab, k=200)
        other[:80] = base[:80]  # shares a passage, isn't a copy
        rows.append((g * 10 + 5, " ".join(other), "x"))
        want[g * 10 + 5] = g * 10 + 5
    got = {r["doc_id"]: r["component_id"] for r in S.similar_documents(spark.createDataFrame(rows, DOCS)).collect()}
    assert len(got) == len(rows) and sum(got[i] == want[i] for i in want) >= 0.95 * len(want)
    assert all(got[i] == i for i in want if i % 10 == 5)


def test_odd_rows_and_empty(spark):
    rows = [(3, None, "x"), (2, "", "x"), (None, "one two", "x"), (5, "one  TWO", "x"), (5, "one two", "x"), (6, "w " * 50_000, "x")]
    got = sorted((str(r["doc_id"]), str(r["component_id"])) for r in S.similar_documents(spark.createDataFrame(rows, DOCS)).collect())
    assert got == [("2", "2"), ("3", "2"), ("5", "5"), ("5", "5"), ("6", "6"), ("None", "5")]
    assert S.similar_documents(spark.createDataFrame([], DOCS)).collect() == []


def test_crowded_links_connect_what_is_near(spark, monkeypatch):
    """One large key: chains beyond a pivot's reach, far members and a tight crowd, against all pairs."""
    rnd = random.Random(3)
    monkeypatch.setattr(S, "BLOCK", 8)
    base = [rnd.getrandbits(64) for _ in range(2)]
    rows = {}
    for n in range(60):  # a crowd
        rows[n] = (base[0] ^ 1 << rnd.randrange(64), base[1] ^ 1 << rnd.randrange(64))
    for n in range(12):  # a chain that leads away, step by step
        rows[100 + n] = (base[0] ^ (1 << 5 * n) - 1, base[1])
    for n in range(40):
        rows[200 + n] = (rnd.getrandbits(64), rnd.getrandbits(64))
    for most in (3, 6, 12):
        near = least(list(rows), lambda i, j: sum((p ^ q).bit_count() for p, q in zip(rows[i], rows[j])) <= most)
        signed = lambda v: v - (1 << 64) if v >> 63 else v
        df = spark.createDataFrame([(k, i, signed(y[0]), signed(y[1])) for k in (0, 1) for i, y in rows.items()], "key long, c long, f0 long, f1 long")
        for rounds in (1, 3):
            links = S.crowded_links(df, ["f0", "f1"], most, rounds)
            assert links.count() < 6 * len(rows)
            roots = {r["a"]: r["root"] for r in S.components(links).collect()}
            assert {i: roots.get(i, i) for i in rows} == near


def test_crowded_links_compare_wide_members_when_a_round_empties_the_key(spark):
    """A is the pivot, B is near A, C is near B but not near A: C must not stay alone."""
    rows = [(0, 0), (1, 0b1111), (2, 0b1111_1111), (3, 0), (4, 1 << 40), (5, 1 << 41)]  # A, B, C and near copies of A
    df = spark.createDataFrame([(0, c, f) for c, f in rows], "key long, c long, f0 long")
    roots = {r["a"]: r["root"] for r in S.components(S.crowded_links(df, ["f0"], 4)).collect()}
    assert {c: roots.get(c, c) for c, _ in rows} == {c: 0 for c, _ in rows}


@pytest.mark.parametrize("rows", [200, 10_000, 200_000, 1_000_000, 12_000_000, 10**9])
def test_meeting_does_not_fall_with_size(rows):
    b = S.width(rows)
    assert S.meeting(0.8, b, S.words_for(0.8, b, 0.97)) >= 0.97


def test_alike_equals_all_pairs(spark, monkeypatch):
    """Chains, near copies, empty sets and far members of keys against all pairs."""
    rnd = random.Random(5)
    monkeypatch.setattr(S, "SETS", 4)
    sets = {0: [], 1: []}
    for g in range(3):
        for n in range(14):  # each is near the next ones only
            sets[10 + g * 20 + n] = range(g * 1000 + n * 6, g * 1000 + n * 6 + 100)
    for n in range(12):
        sets[100 + n] = sorted(rnd.sample(range(5000, 5130), 110))
    alike = lambda x, y: not x and not y or len({*x} & {*y}) >= 0.8 * len({*x} | {*y})
    df = spark.createDataFrame([(1, c, list(s)) for c, s in sets.items()], "key long, c long, s array<long>")
    for rounds in (1, 3):
        roots = {r["a"]: r["root"] for r in S.components(S.alike(df, 0.8, rounds)).collect()}
        assert {c: roots.get(c, c) for c in sets} == least(list(sets), lambda i, j: alike(sets[i], sets[j]))


def test_only_pairs_of_the_set_similarity_are_linked(spark):
    """Texts of 0.7 stay apart, those of 0.83 go together."""
    rnd = random.Random(6)
    rows, want = [], {}
    for g in range(40):
        base = [f"w{rnd.randrange(10**6)}" for _ in range(300)]
        for n, tail in ((0, 0), (1, 27), (2, 55)):
            rows.append((g * 10 + n, " ".join(base[: 300 - tail] + [f"t{n}_{g}_{i}" for i in range(tail)]), "x"))
            want[g * 10 + n] = g * 10 + (n if n == 2 else 0)
    got = {r["doc_id"]: r["component_id"] for r in S.similar_documents(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(got[i] == i for i in want if i % 10 == 2) and sum(got[i] == want[i] for i in want) >= 0.95 * len(want)


def test_a_group_of_near_copies_is_not_looked_up_in_itself(spark, monkeypatch):
    """What goes to the pivots is what meets a crowded key from outside its component; a group's own look-ups, some 18 for each member, stay out, and all are linked still."""
    rnd = random.Random(8)
    base = [rnd.getrandbits(64) for _ in range(2)]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    rows = [(i, signed(base[0] ^ 1 << rnd.randrange(64)), signed(base[1] ^ 1 << rnd.randrange(64))) for i in range(300)]
    rows.append((999, signed(base[0] ^ 0x0001_FFFF_FFFF_0000), signed(base[1])))  # far: looks some of the same keys up
    seen, links = [], S.crowded_links
    monkeypatch.setattr(S, "crowded_links", lambda members, *a: [seen.append(members.count()), links(members, *a)][1])
    df = spark.createDataFrame(rows, "c long, f0 long, f1 long")
    roots = {r["a"]: r["root"] for r in S.components(S.near_links(df, 2, 16, 12)).collect()}
    assert {roots.get(i, i) for i in range(300)} == {0} and roots.get(999, 999) == 999
    assert sum(seen) <= len(rows)
