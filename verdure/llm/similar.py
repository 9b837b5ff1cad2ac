"""SimHash near-dedup at a set similarity: multi-index hashing over wide fingerprints.

Two sets of shingles of similarity s (shared over all) differ in about arccos(2s / (1 + s)) / pi of their SimHash bits: 15 of 100 at 0.8, which is far more than two bits of 64. So
fingerprints here have several words of 64 bits. They only find candidates: these may differ by three standard deviations more than is expected at ``similarity``.

Fingerprints are split into segments of b bits, log2 of the number of rows, so that by chance a segment is shared by one other row or fewer at every size; the first word's distance drops
chance matches where they meet. A table holds each fingerprint under each segment; lookups enumerate the ball of radius one around each segment, of which only bits that are 0 have to be set:
of two segments one bit apart one has the 0. Longer segments meet more seldom, so the number of segments, and of words that hold them, grows with b: two documents of the set similarity meet
in some segment with a probability of ``meet`` at least, whatever the number of rows (words: 4 at 10,000, 5 at 200,000, 7 at 1 million, 17 at 12 million).

Candidates' components are then settled exactly (``alike``): documents are linked where the Jaccard similarity of their sets of shingles is ``similarity`` or more, and only such links count.

Keys that more than ``bucket`` fingerprints hold: their holders are linked to the key's least one, where near enough, and what these links connect is a component from then on. Of a pair within
a component nothing is left to settle, so a large group of near copies, which shares most of its keys, isn't looked up in itself: its rows are the keys that its members hold, one for each
segment, not all that they look up. In such a key the holders outside its main component, if ``bucket`` or fewer, are looked up like those of any other key; whoever looks it up and isn't of the
main component is held against the holders that are, or, where over (b + 1) times ``bucket`` do so, meets them in ``crowded_links``. Keys with more holders outside take all who look them up there.
In crowded_links members are linked to a pivot of the key, one link each, and only what a pivot can't settle is compared in blocks, each pair of blocks giving a spanning forest of its links. No pairs of a group are written out and no group has to fit one task. After that components are taken anew; the other look-ups meet at most ``bucket`` fingerprints each, and pairs
within a component aren't made.

Cases: as in ``simhash``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_groups, long_id, only, scratch, small, stored
from .simhash import components, shingle_hashes
from .words import mix

BLOCK = 1024
SETS = 128
_STEP = np.uint64(0x9E3779B97F4A7C15)


def wide_fingerprints(texts: list[str | None], k: int, words: int) -> np.ndarray:
    """(texts, words) of 64 bits each; every word counts the bits of its own hash of the shingles."""
    out = np.zeros((len(texts), words), np.uint64)
    held, at = [], []

    def flush() -> None:
        n = np.array([len(x) for x in held])
        h = np.array([v for x in held for v in x], np.uint64)
        for w in range(words):
            with np.errstate(over="ignore"):
                own = mix(h + np.uint64(w) * _STEP) if w else h
            bits = np.unpackbits(own.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            sums = np.add.reduceat(bits, np.cumsum(n) - n, axis=0, dtype=np.int32)
            out[at, w] = np.packbits(sums * 2 > n[:, None], axis=1, bitorder="little").view("<u8")[:, 0]
        held.clear(), at.clear()

    for i, t in enumerate(texts):
        if x := shingle_hashes(t, k):
            held.append(x)
            at.append(i)
        if sum(map(len, held[-1:])) > 50_000 or len(held) >= 200:
            flush()
    if held:
        flush()
    return out


def _share(similarity: float) -> float:
    """The expected share of bits that differ."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def limit(similarity: float, bits: int, deviations: float = 3) -> int:
    """Most bits that may differ: the expected number and three standard deviations."""
    p = _share(similarity)
    return int(bits * p + deviations * math.sqrt(bits * p * (1 - p)))


def meeting(similarity: float, b: int, words: int) -> float:
    """The probability that two fingerprints of this similarity are at most one bit apart in some segment of b bits."""
    p = _share(similarity)
    return 1 - (1 - (1 - p) ** b - b * p * (1 - p) ** (b - 1)) ** (words * (64 // b))


def width(rows: int) -> int:
    """Bits of a segment."""
    return min(32, max(12, math.ceil(math.log2(max(2, rows)))))


def segments_for(similarity: float, b: int, meet: float) -> int:
    """The least number of segments with which fingerprints meet with a probability of ``meet``."""
    p = _share(similarity)
    return math.ceil(math.log(1 - meet) / math.log(1 - (1 - p) ** b - b * p * (1 - p) ** (b - 1)))


def words_for(similarity: float, b: int, meet: float) -> int:
    """The least number of words, four or more, with which fingerprints meet with a probability of ``meet``."""
    return max(4, math.ceil(segments_for(similarity, b, meet) / (64 // b)))


def forest(ca: np.ndarray, a: np.ndarray, cb: np.ndarray, b: np.ndarray, most: int, ra: np.ndarray | None = None, rb: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links of a spanning forest between the fingerprints of two blocks, by their names ``ca`` and ``cb``; one that is in both is one node. ``ra`` and ``rb`` name what they are linked to
    already; such links aren't made again."""
    names = np.concatenate([ca, cb])
    known = names if ra is None else np.concatenate([ra, rb])
    ids, at = np.unique(np.concatenate([names, known]), return_inverse=True)
    parent, at = list(range(len(ids))), at.tolist()

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in zip(at[: len(names)], at[len(names) :]):
        parent[root(i)] = root(j)
    out = []
    for i, x in enumerate(a):
        near = np.flatnonzero(np.bitwise_count(b ^ x).sum(axis=1) <= most)
        for j in near.tolist():
            r, s = root(at[i]), root(at[len(ca) + j])
            if r != s:
                parent[r] = s
                out.append((int(ca[i]), int(cb[j])))
    return out


def _away(names: list[str], others: list[str]) -> Column:
    return sum((F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(names, others)), F.lit(0))


def star_links(members: DataFrame, names: list[str], most: int) -> DataFrame:
    """Links (a, b) of the members of (key, c, f0, f1, ...) with the least one of their key, where that is near enough: one for each member at most."""
    pivot = members.groupBy("key").agg(F.min(F.struct("c", *names)).alias("pivot"))
    far = _away(names, [f"pivot.{n}" for n in names])
    linked = members.join(pivot, "key").filter((F.col("c") != F.col("pivot.c")) & (far <= most))
    return linked.select(F.col("c").alias("a"), F.col("pivot.c").alias("b")).distinct()


def crowded_links(members: DataFrame, names: list[str], most: int, rounds: int = 3) -> DataFrame:
    """Links (a, b) that connect what is near enough in each key of (key, c, f0, f1, ...), however many hold the key.

    In a round each key has a pivot, and all near enough to it are linked to it: one link each, and they need not be compared among themselves. By the triangle inequality one that is
    not near enough can be near to one that is only within twice the distance of the pivot. Such ones, and those near no pivot after the last round, are open: they alone are compared with
    the key's other members, in blocks. The rest go on to the next round.
    """
    left, links, wide = members, None, []
    pivots = [f"pivot.{n}" for n in names]
    for turn in range(rounds):
        pivot = left.groupBy("key").agg(F.min(F.struct("c", *names)).alias("pivot"))
        seen = left.join(pivot, "key").withColumn("away", _away(names, pivots))
        seen = stored(seen.select("key", "c", *names, F.col("pivot.c").alias("p"), "away"), f"pivots-{turn}")
        own = seen.filter((F.col("away") <= most) & (F.col("c") != F.col("p"))).select("key", F.col("c").alias("a"), F.col("p").alias("b"))
        links = own if links is None else links.unionByName(own)
        wide.append(seen.filter((F.col("away") > most) & (F.col("away") <= 2 * most)).select("key", "c", *names))
        left = seen.filter(F.col("away") > most).select("key", "c", *names)
        if left.isEmpty():
            if turn == 0:
                return links.select("a", "b").distinct()
            break  # what was gathered in 'wide' is still open
    opened = left
    for w in wide:
        opened = opened.unionByName(w)
    opened = stored(opened.distinct(), "open")
    both = opened.groupBy("key").agg(F.count("*").alias("n_open")).join(members.groupBy("key").agg(F.count("*").alias("n_all")), "key")
    parts = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    both = stored(both.select("key", parts("n_open").alias("parts_a"), parts("n_all").alias("parts_b")), "open-keys")
    settled = links.select("key", F.col("a").alias("c"), F.col("b").alias("p"))  # a member has one pivot in a key at most

    def dealt(rows: DataFrame, side: str, other: str) -> DataFrame:
        own = F.pmod(F.xxhash64("c", F.lit(7)), F.col(f"parts_{side}")).cast("int").alias(side)
        return rows.join(both, "key").join(settled, ["key", "c"], "left").select("key", "c", F.coalesce("p", "c").alias("p"), *names, F.lit(side).alias("side"), own, F.explode(F.sequence(F.lit(0), F.col(f"parts_{other}") - 1)).alias(other))

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("c")  # forests of many keys then share their links
        (ca, a, ra), (cb, b, rb) = ((own["c"].to_numpy(), own[names].to_numpy(np.int64).view(np.uint64), own["p"].to_numpy()) for own in (pdf[pdf["side"] == "a"], pdf[pdf["side"] == "b"]))
        return pd.DataFrame(forest(ca, a, cb, b, most, ra, rb), columns=["a", "b"], dtype="int64")

    blocks = dealt(opened, "a", "b").unionByName(dealt(members, "b", "a"))
    return links.select("a", "b").unionByName(blocks.groupBy("key", "a", "b").applyInPandas(link, "a long, b long")).distinct()


def near_links(fps: DataFrame, words: int, b: int, most: int, bucket: int = 8, segments: int | None = None, rough: int | None = None) -> DataFrame:
    """Links (a, b) between classes of fingerprints (c, f0, f1, ...) that meet in one of the first ``segments`` (default: all) and differ in ``most`` bits or fewer; in keys that few hold, also
    in ``rough`` bits of the first word or fewer (default: its share of ``most`` and four standard deviations)."""
    each, mask = 64 // b, (1 << b) - 1
    keys = [F.shiftrightunsigned(f"f{w}", s * b).bitwiseAND(F.lit(mask)).bitwiseOR(F.lit((w * each + s) << 32)) for w in range(words) for s in range(each)][:segments]
    names = [f"f{w}" for w in range(words)]
    looked_up = F.array_distinct(F.array("key", *(F.col("key").bitwiseOR(F.lit(1 << i)) for i in range(b))))
    held = fps.select(F.explode(F.array(*keys)).alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    held = stored(held, "held")
    large = held.filter(F.col("n") > bucket)
    early = None
    if not large.isEmpty():
        holders = fps.select("c", *names, F.explode(F.array(*keys)).alias("key")).join(large.select("key"), "key")
        holders = stored(holders.select("key", "c", *names), "holders")
        early = stored(star_links(holders, names, most), "early")
        fps = stored(fps.join(components(early).withColumnRenamed("a", "c"), "c", "left"), "with-roots")
        part = F.coalesce("root", "c")
        parts = holders.select("key", "c").join(fps.select("c", part.alias("part")), "c").groupBy("key", "part").agg(F.count("*").alias("m"))
        main = parts.groupBy("key").agg(F.max(F.struct("m", "part")).alias("most"), F.sum("m").alias("n"))
        main = stored(main.select("key", F.col("most.part").alias("main"), (F.col("n") - F.col("most.m")).alias("others")), "main")
        # with more holders outside the main component a key counts as having none
        crowded = stored(main.select("key", F.when(F.col("others") <= bucket, F.col("main")).alias("main")), "crowded")
    else:
        fps = fps.withColumn("root", F.lit(None).cast("long"))

    def looking(root: str) -> DataFrame:
        own = fps.select("c", "f0", root, F.explode(F.array(*keys)).alias("key"))
        return own.select(F.col("c").alias("p"), F.col("f0").alias("g"), F.col(root).alias("r"), F.explode(looked_up).alias("key"))

    few, probes = fps.select("c", "f0", "root", F.explode(F.array(*keys)).alias("key")), looking("root")
    if early is not None:
        # whoever looks up a crowded key and isn't in its main component meets the holders that are
        foreign = probes.join(crowded, (probes["key"] == crowded["key"]) & F.coalesce(F.coalesce("r", "p") != F.col("main"), F.lit(True)))
        foreign = stored(foreign.select(probes["key"], F.col("p").alias("c"), "main").distinct(), "foreign")
        # such look-ups of a key are mostly few, by chance, and are held against each of the holders; only where they are more, all go to the key's pivots
        mixed, guests = foreign.filter("main IS NULL").select("key", "c"), foreign.filter("main IS NOT NULL")
        visited = stored(guests.groupBy("key", "main").agg((F.count("*") > (b + 1) * bucket).alias("busy")), "visited")
        mine = holders.join(fps.select("c", F.coalesce("root", "c").alias("main")), "c").join(visited, ["key", "main"]).select("key", "c", *names, "busy")
        mine = stored(mine, "visited-holders")
        guests = guests.join(visited, ["key", "main"]).select("key", "c", "busy").unionByName(mixed.withColumn("busy", F.lit(True)))
        guests = stored(guests.join(fps.select("c", *names), "c").select("key", "c", *names, "busy"), "guests")
        once = guests.filter("NOT busy").select("key", F.col("c").alias("a"), *(F.col(n).alias(f"x{n}") for n in names))
        near = once.join(mine.filter("NOT busy"), "key").filter(_away([f"x{n}" for n in names], names) <= most).select("a", F.col("c").alias("b")).distinct()
        inside = guests.filter("busy").unionByName(mine.filter("busy")).select("key", "c", *names)
        early = stored(early.unionByName(near).unionByName(crowded_links(stored(inside, "inside"), names, most)), "crowded-links")
        late = components(early).select(F.col("a").alias("c"), F.col("root").alias("late"))
        fps = stored(fps.join(late, "c", "left"), "with-late-roots")
        table = fps.select("c", "f0", "root", "late", F.explode(F.array(*keys)).alias("key"))
        table = table.join(crowded.withColumn("many", F.lit(True)), "key", "left").filter(F.col("many").isNull() | (F.coalesce("root", "c") != F.col("main")))
        few, probes = table.select("key", "c", "f0", F.col("late").alias("root")), looking("late")

    # one word's distance drops chance matches before pairs are gathered
    p = most / (64 * words)
    rough = int(64 * p + 4 * math.sqrt(64 * p * (1 - p))) if rough is None else rough
    apart = (F.col("p") != F.col("c")) & F.coalesce(F.col("r") != F.col("root"), F.lit(True))
    met = probes.join(few.hint("shuffle_hash"), (probes["key"] == few["key"]) & apart & (F.bit_count(F.col("g").bitwiseXOR(F.col("f0"))) <= rough))
    pairs = met.select(F.least("p", "c").alias("a"), F.greatest("p", "c").alias("b")).distinct()
    left = fps.select(F.col("c").alias("a"), *(F.col(f"f{w}").alias(f"x{w}") for w in range(words)))
    right = fps.select(F.col("c").alias("b"), *(F.col(f"f{w}").alias(f"y{w}") for w in range(words)))
    away = _away([f"x{w}" for w in range(words)], [f"y{w}" for w in range(words)])
    links = pairs.join(left, "a").join(right, "b").filter(away <= most).select("a", "b")
    return links if early is None else links.unionByName(early)


def alike(members: DataFrame, similarity: float, rounds: int = 3) -> DataFrame:
    """Links (a, b) that connect the rows of (key, c, s), s a sorted array of distinct hashes, whose sets are of this Jaccard similarity, in each key.

    As ``crowded_links``, with Jaccard distances, for which the triangle inequality holds as well; a pair of blocks gives a spanning forest. Two empty sets are equal.
    """
    far = 1 - similarity
    left, links, wide = members, None, []
    for turn in range(rounds):
        pivot = left.groupBy("key").agg(F.min("c").alias("p"))
        pivot = pivot.join(left.select("key", F.col("c").alias("p"), F.col("s").alias("ps")), ["key", "p"])
        both = F.size(F.array_intersect("s", "ps"))
        seen = left.join(pivot, "key").select("key", "c", "p", both.alias("both"), (F.size("s") + F.size("ps") - both).alias("all"))
        seen = stored(seen.select("key", "c", "p", F.when(F.col("all") == 0, F.lit(1.0)).otherwise(F.col("both") / F.col("all")).alias("jaccard")), f"alike-{turn}")
        own = seen.filter((F.col("jaccard") >= similarity) & (F.col("c") != F.col("p"))).select("key", F.col("c").alias("a"), F.col("p").alias("b"))
        links = own if links is None else links.unionByName(own)
        rest = seen.filter(F.col("jaccard") < similarity).select("key", "c", "jaccard")
        wide.append(rest.filter(F.col("jaccard") >= 1 - 2 * far - 1e-9).select("key", "c"))
        left = members.join(rest.select("key", "c"), ["key", "c"], "left_semi")
        if rest.isEmpty():
            if turn == 0:
                return links.select("a", "b")
            break
    opened = rest.select("key", "c")
    for w in wide:
        opened = opened.unionByName(w)
    opened = stored(opened.distinct(), "alike-open")
    counts = opened.groupBy("key").agg(F.count("*").alias("n_open")).join(members.groupBy("key").agg(F.count("*").alias("n_all")), "key")
    parts = lambda n: F.ceil(F.col(n) / SETS).cast("int")
    counts = stored(counts.select("key", parts("n_open").alias("parts_a"), parts("n_all").alias("parts_b")), "alike-keys")
    settled = links.select("key", F.col("a").alias("c"), F.col("b").alias("p"))

    def dealt(rows: DataFrame, side: str, other: str) -> DataFrame:
        own = F.pmod(F.xxhash64("c", F.lit(7)), F.col(f"parts_{side}")).cast("int").alias(side)
        return rows.join(counts, "key").join(settled, ["key", "c"], "left").select("key", "c", "s", F.coalesce("p", "c").alias("p"), F.lit(side).alias("side"), own, F.explode(F.sequence(F.lit(0), F.col(f"parts_{other}") - 1)).alias(other))

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("c")  # forests of many blocks then share their links
        a, b = (list(zip(own["c"], own["s"])) for own in (pdf[pdf["side"] == "a"], pdf[pdf["side"] == "b"]))
        out, parent = [], {c: c for c in [*pdf["c"], *pdf["p"]]}

        def root(c: int) -> int:
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        for c, p in zip(pdf["c"], pdf["p"]):  # what is linked already
            parent[root(c)] = root(p)
        for c, s in a:
            for d, t in b:
                if root(c) != root(d) and min(len(s), len(t)) >= similarity * max(len(s), len(t)):
                    n = len(np.intersect1d(s, t, assume_unique=True))
                    if n >= similarity * (len(s) + len(t) - n):
                        parent[root(c)] = root(d)
                        out.append((c, d))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    blocks = dealt(members.join(opened, ["key", "c"], "left_semi"), "a", "b").unionByName(dealt(members, "b", "a"))
    return links.select("a", "b").unionByName(blocks.groupBy("key", "a", "b").applyInPandas(link, "a long, b long"))


def similar_documents(docs: DataFrame, k: int = 5, similarity: float = 0.8, words: int | None = None, bucket: int = 8, meet: float = 0.97) -> DataFrame:
    """(doc_id, component_id): component_id is the least doc_id that is reached over links; ``words`` are chosen by the number of rows unless given."""
    with scratch(docs.sparkSession):
        return stored(_similar(docs, k, similarity, words, bucket, meet), "components", keep=True)


def _similar(docs: DataFrame, k: int, similarity: float, words: int | None, bucket: int, meet: float) -> DataFrame:
    b = width(docs.count())
    words = words or words_for(similarity, b, meet)
    names = [f"f{w}" for w in range(words)]
    texts = only(docs, "doc_id", "text").select(long_id("doc_id"), F.xxhash64("text").alias("t"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            fp = wide_fingerprints(b.column(2).to_pylist(), k, words).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(np.ascontiguousarray(fp[:, w])) for w in range(words))], names=["doc_id", "t", *names])

    rows = texts.mapInArrow(run, "doc_id long, t long, " + ", ".join(f"{n} long" for n in names))
    rows = stored(rows.withColumn("c", F.xxhash64(*names)), "wide-fingerprints")
    fps = stored(rows.select("c", *names).distinct(), "classes")
    roots = components(near_links(fps, words, b, limit(similarity, 64 * words), bucket, segments_for(similarity, b, meet), limit(similarity, 64, 4)))
    # copies of a text are one node; what shares a component with another text is compared with it
    nodes = rows.groupBy("t", "c").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    nodes = stored(nodes.join(roots, nodes["c"] == roots["a"], "left").select("t", "least", "n", F.coalesce("root", "c").alias("key")), "nodes")
    several = nodes.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1").select("key")
    asked = stored(nodes.join(several, "key"), "asked")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            own = [np.unique(np.array(shingle_hashes(x, k), np.uint64).view(np.int64)) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(own, pa.list_(pa.int64()))], names=["key", "c", "s"])

    ids = asked.select("key", F.col("t").alias("u"), "least")
    found = texts.join(ids, (F.col("t") == F.col("u")) & F.col("doc_id").eqNullSafe(F.col("least"))).select("key", F.col("t").alias("c"), "text").mapInArrow(sets, "key long, c long, s array<long>")
    linked = components(alike(stored(found.dropDuplicates(["c"]), "sets"), similarity))
    named = nodes.join(linked, nodes["t"] == linked["a"], "left").select("t", "least", "n", F.coalesce("root", "t").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return join_groups(rows.select("doc_id", "t"), named.join(least, "root").select("t", "component_id", "n"), ["t"]).select("doc_id", "component_id")
