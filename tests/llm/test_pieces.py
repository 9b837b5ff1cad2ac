import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from verdure.llm import pieces as S

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")
_P = []


def model():
    if not _P:
        _P.append(S.Pieces(open(PATH, "rb").read(), remembered=3))
    return _P[0]


TEXT = st.text(max_size=25) | st.lists(st.sampled_from(["the ", " ", "  ", "▁", "tokenization", "éè", "\n", "日本", "🙂", "</s>", "<0x41>", "ing", "ab"]), max_size=9).map("".join)


@given(TEXT)
@settings(max_examples=300, deadline=None)
def test_round_trip_and_best_score(text):
    text = text.encode("utf-8", "ignore").decode()
    p = model()
    ids = np.frombuffer(p.encode(text), "<u4").tolist()
    assert p.decode(ids) == text and p.decode(p.encode(text)) == text
    scores = {i: s for _, s, i in p.automaton.values()}
    if text and S.SPACE not in text:
        marked = S.SPACE + text.replace(" ", S.SPACE)
        got = sum(scores[i] if i in scores else p.byte_score for i in ids)
        assert got == S.brute(p, marked)
        assert p.best(marked) == ids  # remembered words give the path of the whole text


def test_documents(spark):
    rows = [(1, "Hello  world\n", "x"), (2, None, "x"), (None, "", "x"), (3, "a▁b", "x"), (3, "a▁b", "x"), (4, "wörd " * 20000, "x")]
    enc = S.encode_documents(spark.createDataFrame(rows, "doc_id long, text string, pieces string"), PATH)
    got = enc.collect()
    assert all(r["exact"] for r in got) and [r["n_pieces"] for r in got if not r["pieces"]] == [0, 0]
    assert sorted((str(r["doc_id"]), r["text"]) for r in S.decode_documents(enc, PATH).collect()) == sorted((str(d), t or "") for d, t, _ in rows)
    assert S.encode_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
