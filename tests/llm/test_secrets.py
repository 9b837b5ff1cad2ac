import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from verdure.llm import secrets as S

RULES = (*S.RULES, S.Rule("plain", r"(?:ab|cd)[0-9]+"), S.Rule("either", r"(?:foo[0-9]+|bar)baz"))
WORDS = ["password", "Passwd", "SECRET", "token", "api_key", "APIKEY", "'", '"', ":", "=", " ", "abc123", "a", "AKIA", "0123456789ABCDEF", "0123456789abcdef", "deadbeef", "é", "𝒳", "ghp_", "x" * 36, "-----BEGIN RSA PRIVATE KEY-----", "eyJ", ".", "foo1baz", "barbaz", "cd7", "\n"]
TEXT = st.lists(st.sampled_from(WORDS), max_size=14).map("".join)


def test_queries():
    q = {r.kind: S.trigram_query(r.pattern) for r in RULES}
    assert q["hex"] == [] and q["plain"] == []
    assert q["access"] == [frozenset({frozenset({"aki", "kia"})})]
    assert any(frozenset({"tok", "oke", "ken"}) in c for c in q["assign"])
    assert len(q["private_key"]) == 2


@given(TEXT)
@settings(max_examples=400, deadline=None)
def test_query_holds_for_every_match(text):
    low = text.lower()
    for r in RULES:
        if re.search(r.pattern, text):
            assert all(any(all(t in low for t in alt) for alt in c) for c in S.trigram_query(r.pattern))


def test_scan_equals_brute_force(spark):
    import random

    rnd = random.Random(3)
    texts = ["".join(rnd.choices(WORDS, k=rnd.randrange(14))) for _ in range(300)] + [None, "", "token=abcdef " * 3000, "password = 'abcdef' token:x", "secret=12345;secret=123456"]
    rows = [(i if i % 50 else None, t, "y") for i, t in enumerate(texts)] + [(7, "AKIA" + "A" * 16, "y"), (7, "ghp_" + "b" * 40, "y")]
    got = S.scan(spark.createDataFrame(rows, "doc_id long, text string, kinds string"), RULES).collect()
    key = lambda d: (d is None, d or 0)
    a = sorted(((key(r["doc_id"]), [tuple(s) for s in r["spans"]]) for r in got))
    b = sorted(((key(d), S.brute(t, RULES)) for d, t, _ in rows))
    assert a == b and sum(len(x[1]) for x in b) > 100


def test_empty(spark):
    assert S.digest(S.scan(spark.createDataFrame([], "doc_id long, text string"))).collect() == []


def test_no_python(spark):
    df = S.digest(S.scan(spark.createDataFrame([(1, "x")], "doc_id long, text string")))
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
