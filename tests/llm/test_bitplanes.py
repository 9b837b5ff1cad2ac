import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from verdure.llm import bitplanes as B

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, start string"


def whole_ids(texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(PATH)
    return [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("planes", ["byte", "bit"])
@pytest.mark.parametrize("n", [1, 7, 8, 1000])
def test_planes_round_trip(planes, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint64).astype("<u4")
    sizes, payload = B.shuffle_planes(ids, planes)
    assert (B.unshuffle_planes(n, planes, sizes, payload) == ids).all()


@given(st.binary(max_size=50), st.binary(max_size=50))
@settings(max_examples=60, deadline=None)
def test_crc_join(a, b):
    assert B.crc32_join(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@given(st.lists(st.text(max_size=30) | st.sampled_from(["The cat's, Été. Ẹ́ Σας ΣΑΣ. x<|endoftext|>y", "a...b 1,000., don't.", "İstanbul ß ẞ ﬁ．", "A B c,　d.", "é. ́x"]), max_size=5))
@settings(max_examples=150, deadline=None)
def test_encoder_equals_library(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    got = [np.frombuffer(x, "<u4").tolist() for x in _enc().encode(texts)]
    assert got == whole_ids(texts)


def test_case_and_closing_marks_make_no_new_words():
    texts = ["Heat HEAT, heat. hEAT heat,", "Été. ÉTÉ, été"]
    enc = B.WordEncoder(open(PATH, encoding="utf-8").read())
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == whole_ids(texts)
    assert set(enc.low) == {b"heat", "été".encode("latin-1"), b".", b","} and not enc.words


def test_texts_in_lower_case_equal_library():
    texts = ["x<|EndOfText|>Y", "<|STARTOFTEXT|>", "x<|endoftext|>y", "it'S. a\x85b \xa0c. !!. '. µ. ª, ÷. ×,", "3.14. A.B. A.., B,.", "\x1cA. Ã©. é", "ã\x81\x82", "あ", "Ÿ Y.", ".", "a.\x0bB,\n"]
    for one in (texts, *([t] for t in texts)):
        assert [np.frombuffer(x, "<u4").tolist() for x in _enc().encode(one)] == whole_ids(one)


_ENC = []


def _enc():
    if not _ENC:
        _ENC.append(B.WordEncoder(open(PATH, encoding="utf-8").read(), words=5, cores=5))
    return _ENC[0]


def brute(rows):
    out, start = [], 0
    for d, ids in rows:
        ids = ids + [1]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("planes,block", [("byte", 16), ("bit", 8), ("byte", 65536)])
def test_files(spark, tmp_path, planes, block):
    rows = [(5, "Hello there, world. " * 9, "x"), (2, None, "x"), (9, "", None), (3, "one", "x"), (7, "ä ö, <|endoftext|>\tno", "y"), (7, "ä ö, <|endoftext|>\tno", "y"), (4, "word " * 200, "z")]
    B.write_ids(spark.createDataFrame(rows, DOCS).repartition(3), str(tmp_path / "f"), PATH, block=block, planes=planes)
    got = sorted(map(tuple, B.read_digests(spark, str(tmp_path / "f")).collect()))
    ordered = sorted(rows, key=lambda r: r[0])
    assert got == sorted(brute(zip([r[0] for r in ordered], whole_ids([r[1] or "" for r in ordered]))))
    chunks = spark.read.parquet(str(tmp_path / "f" / "index")).collect()
    assert max(c["n"] for c in chunks) <= block and "payload" not in chunks[0].asDict()
    ids = b"".join(p["ids"] for p in sorted(B.read_pieces(spark, str(tmp_path / "f"), with_ids=True).collect(), key=lambda p: (p["shard"], p["first"])))
    assert len(ids) == 4 * sum(g[2] for g in got)


def test_files_empty_table_and_null_id(spark, tmp_path):
    B.write_ids(spark.createDataFrame([], DOCS), str(tmp_path / "e"), PATH)
    assert B.read_digests(spark, str(tmp_path / "e")).collect() == []
    B.write_ids(spark.createDataFrame([(None, "a", "b"), (0, "c", "d")], DOCS), str(tmp_path / "n"), PATH)
    assert [r["doc_id"] for r in B.read_digests(spark, str(tmp_path / "n")).orderBy("start").collect()] == [None, 0]
