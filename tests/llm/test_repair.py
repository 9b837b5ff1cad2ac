import random
from itertools import product

import pytest

from verdure.llm import repair as R

ROLES, TEXTS = ["user", "assistant", "system", "tool", "", None], ["Fine.", "cut off", "", " \n", None, "Really?", "ok!  "]
SCHEMA = "conv_id long, turn long, role string, text string"


def solve(codes):
    out, found = R.layers(codes, R.ACCEPT, (0,), True)
    return found[0], R.walk(codes, out, R.ACCEPT, 0, found[0])[0]


def test_layers_give_the_least_audit():
    """Against all edit strings of up to three rows and seven edits."""
    kinds = list(product("suax", (0, 1, 3)))

    def play(codes, audit):
        rows, s, cost = list(codes), 0, 0
        for e in audit:
            if e == "I":
                s, cost = R.NEXT[s], cost + 3
                continue
            if not rows:
                return None
            kind, f = rows.pop(0)
            if e == "D":
                cost += 4
            elif f == 1 or e == "K" and (kind not in R.STEP or R.STEP[kind][s] < 0):
                return None
            else:
                s, cost = (R.STEP[kind][s] if e == "K" else R.NEXT[s]), cost + (3 if e == "R" else 0) + (3 if f == 3 else 0)
        return None if rows or s not in (0, 3) else cost

    audits = ["".join(a) for n in range(6) for a in product("DIKR", repeat=n)]
    for n in (0, 1, 2):
        for codes in product(kinds, repeat=n):
            best = min((c, a) for a in audits for c in [play(codes, a)] if c is not None)
            assert solve(list(codes)) == best


@pytest.mark.parametrize("segment", [1, 3, 1000])
def test_against_brute_force(spark, segment):
    rng = random.Random(segment)
    rows = []
    for conv in [*range(40), None]:
        for i in range(rng.randint(1, 12)):
            role = rng.choice(ROLES) if rng.random() < 0.5 else ("user", "assistant")[i % 2]
            rows.append((conv, rng.choice([i, i, i, 3, None]), role, rng.choice(TEXTS)))
            if rng.random() < 0.2:
                rows.append(rows[-1])
    long = [(99, i, ("user", "assistant")[i % 2] if rng.random() < 0.9 else "system", f"{i % 37}{rng.choice('.x')}") for i in range(150)]
    rows += long + [(98, 0, "user", "w " * 200_000)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 5) for r in rows], SCHEMA + ", TEXT long")
    got = {r["conv_id"]: r.asDict() for r in R.report(R.repair_conversations(df, segment=segment)).collect()}
    want = {c: {"conv_id": c} | R.brute([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert got == want


def test_repaired_turns(spark):
    df = spark.createDataFrame([(1, 0, "system", "S."), (1, 1, "user", "Q?"), (1, 2, "user", "More?"), (1, 3, "assistant", "A.")], SCHEMA)
    turns = R.repaired_turns(R.repair_conversations(df)).orderBy("part", "seg", "i").collect()
    assert [(r["role"], r["text"]) for r in turns] == [("system", "S."), ("user", "Q?"), ("assistant", ""), ("user", "More?"), ("assistant", "A.")]
    assert R.report(R.repair_conversations(df)).collect()[0]["audit"] == "KKIKK"


def test_empty_and_missing(spark):
    assert R.report(R.repair_conversations(spark.createDataFrame([], SCHEMA))).collect() == []
    gone = spark.createDataFrame([(5, 0, "user", "x", 0)], SCHEMA + ", copies int")
    row = R.report(R.repair_conversations(gone, "copies")).collect()[0].asDict()
    assert row == {"conv_id": 5} | R.brute([])


def test_query_against_sql(spark):
    import duckdb

    from verdure.llm import queries

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{sf}/conversations.parquet'")
    res = con.execute(queries.ORACLES["op11_conversation_repair"])
    names = [d[0] for d in res.description]
    got = queries.QUERIES["op11_conversation_repair"](spark, sf)
    assert sorted(names) == sorted(got.columns)
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == sorted(res.fetchall())
