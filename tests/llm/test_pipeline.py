from collections import Counter

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from verdure.llm import linedup, mixing, perplexity, pieces, simhash  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
        seen[name] = (before, docs.collect())
        if n < 4:
            assert docs.schema.names == spark.read.parquet(f"{SF}/documents.parquet").schema.names

    before, after = seen["quality rules"]
    base = {r["doc_id"] for r in before for n in [perplexity.brute_numbers(r["text"])] if n[0] >= 10 and 100 * n[4] <= 20 * n[0]}
    assert {r["doc_id"] for r in after} <= base and len(after) >= 0.97 * len(base)
    assert set(map(tuple, after)) <= set(map(tuple, before))

    before, after = seen["line dedup"]
    want = linedup.brute([(r["doc_id"], r["text"]) for r in before], 2, 50)
    assert {r["doc_id"]: r["text"] for r in after} == {d: t for (d, _), t in want.items() if t is not None}

    before, after = seen["near dedup"]
    grams = {r["doc_id"]: set(simhash.shingle_hashes(r["text"], 5)) for r in before}
    alike = lambda x, y: len(x & y) / len(x | y) if x or y else 1.0
    kept = {r["doc_id"] for r in after}
    assert len(after) == len(kept) and set(map(tuple, after)) <= set(map(tuple, before))
    ids = sorted(grams)
    for d in ids:  # what goes has a partner that is much alike, and of equal texts only the first can stay
        near = [e for e in ids if e != d and alike(grams[d], grams[e]) >= 0.5]
        assert d in kept or near
        assert d not in kept or not any(grams[e] == grams[d] for e in ids if e < d)
    assert all(d not in kept or e not in kept for d in ids for e in ids if d < e and alike(grams[d], grams[e]) >= 0.9)

    before, after = seen["source mixing"]
    words = lambda r: perplexity.brute_numbers(r["text"])[0]
    sizes, taken = Counter(), Counter()
    for r in before:
        sizes[r["source"]] += words(r)
    for r in after:
        taken[r["source"]] += words(r)
    for s, t in mixing.brute_targets(dict(sizes)).items():
        assert abs(taken[s] - t) <= max(30, 0.05 * t)
    assert max(Counter(r["doc_id"] for r in after).values()) <= 2

    before, after = seen["encoding"]
    import public_tokenizers

    p = pieces.Pieces(open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read())
    texts = {r["doc_id"]: r["text"] for r in before}
    assert Counter(r["doc_id"] for r in after) == Counter(r["doc_id"] for r in before)
    assert all(p.decode(r["pieces"]) == texts[r["doc_id"]] and r["exact"] for r in after)


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100


def test_empty_and_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, times int"
    odd = [(None, None, None, None, None, 1), (1, "", "en", "a", 0, 1), (1, "", "en", "a", 0, 1), (2, "one two three four five six seven eight nine ten", None, None, 3, 2), (2, "one two three four five six seven eight nine ten", None, None, 3, 2), (3, "w%d " * 3 + " ".join(f"w{i}" for i in range(30_000)), "en", "a", 1, 3)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            out.collect()
            assert name == "encoding" or out.columns == docs.columns
