"""SimHash near-dedup by multi-index hashing.

Fingerprints are 64 bits and are split into two segments of 32. If two fingerprints differ in at most two bits, their high segments differ in
at most one bit or their low segments in none. So a table holds every distinct fingerprint under its high and under its low segment; a
fingerprint looks up the ball of radius one around its high segment (33 keys) and its low segment itself, and each match's whole distance is
verified. Copies are one fingerprint, so a group of copies costs one entry.

Where more than ``bucket`` distinct fingerprints share a key, pairs would grow with the square of the bucket. These fingerprints take an
exact way that is linear in their number: two fingerprints differ in at most two bits just if the balls of radius one around them
meet, so each fingerprint is linked to the least fingerprint of each point of its ball (65 points).

Components of the links are found by alternating large-star and small-star steps, each cut by checkpoint().

Cases: a null or wordless text has fingerprint zero and is linked like others; texts of fewer words than a shingle are one shingle;
a null doc_id is larger than any other when a group's least id is taken; repeated rows stay; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .common import join_groups, long_id, numbered_columns, only, small, stored

SEED = 42
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_hashes(text: str | None, k: int) -> list[int]:
    """XXH64 of the text's k-word shingles, repeats included."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return []
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= k:
        return [h(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return [h(joined[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())]


def fingerprints(texts: list[str | None], k: int) -> np.ndarray:
    """A bit is set if it is in over half of the shingle hashes."""
    out = np.zeros(len(texts), np.uint64)
    held, at, size = [], [], 0

    def flush() -> None:
        nonlocal held, at, size
        if held:
            n = np.array([len(x) for x in held])
            bits = np.unpackbits(np.array([v for x in held for v in x], "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            sums = np.add.reduceat(bits, np.cumsum(n) - n, axis=0, dtype=np.int32)
            out[at] = np.packbits(sums * 2 > n[:, None], axis=1, bitorder="little").view("<u8")[:, 0]
        held, at, size = [], [], 0

    for i, t in enumerate(texts):
        if x := shingle_hashes(t, k):
            held.append(x)
            at.append(i)
            size += len(x)
        if size > 200_000:
            flush()
    flush()
    return out


def with_fingerprints(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, fp) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            fp = fingerprints(b.column(1).to_pylist(), k)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return only(docs, "doc_id", "text").select(long_id("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def near_pairs(fps: DataFrame, bucket: int = 32) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that differ in at most two bits: all pairs outside large buckets; inside them,
    for each point next to two or more fingerprints, each one's link to the least of them."""
    high, low = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    table = fps.select("fp", F.explode(F.array(F.struct(F.lit(0).alias("seg"), high.alias("key")), F.struct(F.lit(1).alias("seg"), low.alias("key")))).alias("e")).select("fp", "e.*")
    ball = [F.struct(F.lit(0).alias("seg"), high.bitwiseXOR(F.lit(m)).alias("key")) for m in [0, *(1 << i for i in range(32))]]
    probes = fps.select("fp", F.explode(F.array(*ball, F.struct(F.lit(1).alias("seg"), low.alias("key")))).alias("e")).select(F.col("fp").alias("probe"), "e.*")
    sizes = table.groupBy("seg", "key").agg(F.count("*").alias("size"))
    cold = sizes.filter(F.col("size") <= bucket).select("seg", "key")
    hot = sizes.filter(F.col("size") > bucket).select("seg", "key")

    pairs = probes.join(table.join(cold, ["seg", "key"], "left_semi"), ["seg", "key"]).filter("probe <> fp").filter(_distance("probe", "fp") <= 2).select(F.col("probe").alias("a"), F.col("fp").alias("b"))
    # whoever looks up a large bucket, and whoever is in it, takes the ball's points instead
    crowded = probes.join(hot, ["seg", "key"], "left_semi").select(F.col("probe").alias("fp")).distinct()
    points = crowded.select("fp", F.explode(F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(m)) for m in [*(1 << i for i in range(63)), -(1 << 63)]))).alias("point"))
    stars = points.groupBy("point").agg(F.min("fp").alias("b"), F.max("fp").alias("c")).filter("b < c").select("point", "b")
    linked = points.join(stars, "point").filter("fp <> b").filter(_distance("fp", "b") <= 2).select(F.col("fp").alias("a"), "b")
    return pairs.unionByName(linked).distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, root): of each node of the links (a, b) the least node it reaches. Large-star and small-star steps until nothing changes."""
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = stored(edges, "edges"), None
    while True:
        # large star: each node's larger neighbours go to the least of it and its neighbours
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # small star: each node's smaller neighbours and itself go to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = small.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        seen = Observation()
        edges = stored(edges.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")), "edges")
        now = (seen.get["n"], seen.get["h"])
        if now == before and (not now[0] or edges.agg(F.countDistinct("a")).first()[0] == now[0]):
            return edges.select("a", F.col("b").alias("root"))
        before = now


def near_duplicates(docs: DataFrame, k: int = 3, bucket: int = 32) -> DataFrame:
    """(doc_id, fingerprint, component_id): component_id is the least doc_id that is reached over links of at most two differing bits."""
    prints = stored(with_fingerprints(docs, k), "fingerprints")
    fps = prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    roots = components(near_pairs(fps.select("fp"), bucket))
    named = fps.join(roots, fps["fp"] == roots["a"], "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.join(ids, "root").select("fp", "component_id", "n")
    return join_groups(prints, classes, ["fp"]).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents that are the least of their component; rows of one doc_id are one document, of which one row stays.

    What goes is written as a table first: it is mostly small, and then its known size lets the join do without a shuffle of texts.
    """
    by_id = stored(found.groupBy("doc_id").agg(F.count("*").alias("rows"), F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("first")), "kept")
    extra = by_id.filter("first and rows > 1").limit(1).count() > 0
    gone = stored(by_id.filter("not first").select(F.col("doc_id").alias("gone_id")), "gone")
    plain, at = numbered_columns(docs), f"c{docs.columns.index('doc_id')}"
    out = plain.join(gone, F.col(at).cast("long").eqNullSafe(F.col("gone_id")), "left_anti")
    return (out.dropDuplicates([at]) if extra else out).toDF(*docs.columns)


def brute(rows: list[tuple[int, str | None]], k: int = 3) -> list[tuple]:
    """Fingerprints bit by bit and links over all pairs, for tests."""
    prints = []
    for _, text in rows:
        words = (text or "").encode().translate(_LOWER).split()
        grams = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
        hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)))
    comp = list(range(len(rows)))
    ids = [(d is None, d or 0) for d, _ in rows]
    changed = True
    least = list(ids)
    while changed:
        changed = False
        for i in comp:
            for j in comp:
                if (prints[i] ^ prints[j]).bit_count() <= 2 and least[j] < least[i]:
                    least[i], changed = least[j], True
    return [(d, f"{p:016x}", None if x[0] else x[1]) for (d, _), p, x in zip(rows, prints, least)]
