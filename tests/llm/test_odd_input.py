"""Columns whose names differ in case only, and very long texts, in the operators on documents, vectors and conversations."""

import pytest

from verdure.llm import bitplanes, chat, kmtree, pieces, secrets, similar, simhash

public_tokenizers = pytest.importorskip("public_tokenizers")
LONG = " ".join(f"w{i % 977} password=abcdef{i % 7}" for i in range(10_000))
ROWS = [(1, "some words that stand here twice over", "a"), (2, "some words that stand here twice over", "b"), (3, None, None), (4, LONG, "a"), (None, "", "c")]


def run_all(docs, path):
    bitplanes.write_ids(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    found = similar.similar_documents(docs)
    out = [bitplanes.read_digests(docs.sparkSession, path), simhash.near_duplicates(docs), found, simhash.keep_one(docs, found), pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model")), secrets.digest(secrets.scan(docs))]
    return [sorted(map(repr, df.drop("DOC_ID", "Text").collect() if set(df.columns) & {"DOC_ID"} else df.collect())) for df in out[:3] + out[4:]], len(out[3].collect())


def test_documents(spark, tmp_path):
    plain = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    odd = spark.createDataFrame([(9, "other", *r) for r in ROWS], "DOC_ID long, Text string, doc_id long, text string, source string")
    want, kept = run_all(plain, str(tmp_path / "a"))
    got, kept_odd = run_all(odd, str(tmp_path / "b"))
    assert got == want and kept == kept_odd == 3


def test_vectors(spark):
    rows = [(0, [0.1, 2.0]), (1, [0.1, 0.3]), (2, [1e39, 1.0])]
    odd = spark.createDataFrame([(7, i, v) for i, v in rows], "VEC_ID long, vec_id long, embedding array<double>")
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in kmtree.search(odd, every=1, k=2).collect()}
    assert got[0, 1] == 0.1 * 0.1 + 2.0 * 0.3 and abs(got[0, 1] - 0.61) < 1e-15 and got[2, 1] == 1e39 * 0.1 + 0.3


def test_conversations(spark):
    rows = [(1, t, r, x) for t, (r, x) in enumerate([("user", "a"), ("assistant", LONG)])]
    rows += [(c, t, r, x) for c in range(2, 60) for t, (r, x) in enumerate([("system", "s"), ("user", "q"), ("assistant", "")][c % 2 :])]
    rows += [(60, 0, "human", "h"), (60, 1, "gpt", "g"), (61, 0, "user", ""), (61, 1, "assistant", "x")]
    odd = spark.createDataFrame([(5, *r) for r in rows], "Turn long, conv_id long, turn long, role string, text string")
    turns = chat.canonical(chat.as_records(odd), "conv_id", "record").collect()
    assert len({r["layout"] for r in turns}) == 8
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in turns} == {c: [(r, x) for d, _, r, x in rows if d == c] for c in {r[0] for r in rows}}
    unknown = spark.createDataFrame([(1, '{"other": 1}'), (2, '{"prompt": "a", "response": "b"}')], "id long, record string")
    got = {r["id"]: r["n_turns"] for r in chat.chat_digests(chat.format_chats(chat.canonical(unknown, "id", "record"), "id"), "id").collect()}
    assert got == {1: None, 2: 2}
