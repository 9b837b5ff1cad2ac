"""Substring dedup by prefix-partitioned suffix trees over words.

A window is ``length`` consecutive words. A word goes if a window that covers it also starts in a document with a smaller doc_id.

Every window has an anchor: of the runs of ``gram`` words inside it the first with the least hash. Equal windows have equal anchors at
equal places, so a window can repeat only where its anchor's words repeat in another document. Consecutive windows with one anchor are a
segment. The anchor's words are the prefix that splits suffixes into groups:

1. anchors found in one document only go, with all their segments (counted per anchor with a map-side combine);
2. equal segments are one class, with the least doc_id of its members; a member with a larger doc_id repeats as a whole;
3. the strings of an anchor are a group. A group of at most ``group`` strings fits in memory: its suffixes that start a window are sorted into the leaves of its subtree;
   neighbours that share ``length`` words or more are under one deep internal node, and the least doc_id under it tells which of the suffixes repeat;
4. a larger group is split by longer prefixes: its strings are cut into segments again, by anchors of more words (25, then 33, 41 and at last all 50 words of a window), and each new
   group is judged in the same way. With anchors as long as a window a group is all suffixes of one deep node, whose least doc_id Spark finds before and after the shuffle. So prefixes
   grow just where a passage is frequent, and no group has to fit one task however often it occurs.

Consecutive windows under nodes of one least doc_id are a maximal repeat (``maximal_repeats``); its words are what a later document loses.

Texts are written once into files bucketed by doc_id in the shared folder; both later joins with texts read their buckets and shuffle no text.

Cases: a null text has no words; a null doc_id counts as smaller than any other; rows of one doc_id never remove each other's words and are each judged on their own; texts shorter than a
window keep all; an empty table gives an empty result; columns other than doc_id and text are ignored, whatever their names. A very long text is an array of word hashes in its task; only
its segments that are shared go on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucketed, join_groups, long_id, only, semi_join_groups, small, stored
from .words import mix, run_hashes, window_min, word_bounds, word_hashes

NULL_ID = -(1 << 63)


def hashes_of(text: str | None) -> np.ndarray:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    return word_hashes(raw, *word_bounds(raw))


def segments(words: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, segment hash, first window and number of windows of each segment of a document."""
    grams = run_hashes(words, gram)
    at = window_min(grams, length - gram + 1)
    if not len(at):
        z = np.zeros(0, np.int64)
        return z.astype(np.uint64), z.astype(np.uint64), z, z
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    n = np.diff(np.append(first, len(at)))
    g = grams[at[first]]
    windows = run_hashes(words, length)
    # a segment is its first and its last window, their distance, and the anchor's place: together these hold every word of it
    r = mix(windows[first] ^ mix(windows[first + n - 1] + n.astype(np.uint64)) ^ mix((at[first] - first).astype(np.uint64) + np.uint64(1 << 32)))
    return g, r, first, n


def _i64(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def _segment_rows(docs: DataFrame, length: int, gram: int, full: bool) -> DataFrame:
    """A row for each segment; with ``full`` off just (g, d), once for each anchor of a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 500):
            out: list[list] = [[], [], [], [], [], []]
            for d, h, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                g, r, a, n = segments(hashes_of(text), length, gram)
                if not len(g):
                    continue
                if not full:
                    g = np.unique(g)
                    r = a = n = g[:0]
                for k, x in enumerate((g, np.full(len(g), d, np.int64), r, np.full(len(r), h, np.int64), a, n)):
                    out[k].append(x)
            if out[0]:
                cols = [_i64(np.concatenate(x)) for x in (out if full else out[:2])]
                yield pa.RecordBatch.from_arrays(cols, names=["g", "d", "r", "h", "a", "n"][: len(cols)])

    return docs.select("d", "h", "text").mapInArrow(run, "g long, d long, r long, h long, a long, n long" if full else "g long, d long")


STRINGS = "g long, d long, g0 long, r0 long, off long, n long, words binary"


def _class_words(reps: DataFrame, length: int) -> DataFrame:
    """Rows (d, h, text, list of (h, g, r, a, n)) to the strings of each class: its anchor g, the word hashes of its n windows, and where they come from: class (g0, r0), window ``off``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 500):
            rows = []
            for d, h, text, own in zip(*(c.to_pylist() for c in b.columns)):
                own = [x for x in own if x["h"] == h]
                words = hashes_of(text) if own else None
                rows += [(x["g"], d, x["g"], x["r"], 0, x["n"], words[x["a"] : x["a"] + x["n"] + length - 1].tobytes()) for x in own]
            if rows:
                yield _string_batch(rows)

    return reps.select("d", "h", "text", "own").mapInArrow(run, STRINGS)


def _string_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(),) * 6 + (pa.binary(),))], names=["g", "d", "g0", "r0", "off", "n", "words"])


def _longer_prefixes(strings: DataFrame, length: int, gram: int) -> DataFrame:
    """The strings cut into segments by anchors of ``gram`` words, which are longer than those that they had."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, d, g0, r0, off, _, words in zip(*(c.to_pylist() for c in b.columns)):
                w = np.frombuffer(words, np.uint64)
                g, _, first, n = segments(w, length, gram)
                yield _string_batch([(k, d, g0, r0, off + f, m, w[f : f + m + length - 1].tobytes()) for k, f, m in zip(g.view(np.int64).tolist(), first.tolist(), n.tolist())])

    return strings.mapInArrow(run, STRINGS)


def deep_nodes(words: list[np.ndarray], ids: np.ndarray, starts: list[int], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffix array of many strings, cut at ``length`` words: for the suffixes that start a window, (string, offset, least id under its deep node).

    Symbols are ranked, and ranks of 1, 2, 4, ... words are made from pairs of ranks until two of them cover ``length`` words.
    """
    text = np.concatenate(words)
    _, rank = np.unique(text, return_inverse=True)
    rank, width = rank.astype(np.uint64), 1
    while 2 * width <= length:
        key = np.zeros(len(rank), np.uint64)
        key[: len(rank) - width] = rank[width:] + np.uint64(1)
        _, rank = np.unique(rank << np.uint64(32) | key, return_inverse=True)
        rank, width = rank.astype(np.uint64), 2 * width
    sizes = np.array(starts)
    lens = np.array([len(w) for w in words])
    begin = np.cumsum(lens) - lens
    string = np.repeat(np.arange(len(words)), sizes)
    offset = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = begin[string] + offset
    key = rank[place] << np.uint64(32) | rank[place + length - width]
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], np.diff(key[order]) != 0])
    least = np.minimum.reduceat(ids[string[order]], np.flatnonzero(new))
    out = np.empty(len(order), ids.dtype)
    out[order] = least[np.cumsum(new) - 1]
    return string, offset, out


FLAGS = "g0 long, r0 long, i long, least long"


def _subtrees(strings: DataFrame, length: int, symbols: int = 1_500_000) -> DataFrame:
    """(g0, r0, i, least): the windows i of a class that also start in a document with a smaller id, and the least such id."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        # suffixes of two groups never share a prefix of ``length`` words: their anchors differ; so one array holds many groups
        ids, g0, r0, off = (np.array([x[k] for x in rows], np.int64) for k in (1, 2, 3, 4))
        string, offset, least = deep_nodes([np.frombuffer(x[6], np.uint64) for x in rows], ids, [x[5] for x in rows], length)
        hit = least < ids[string]
        at = string[hit]
        return pa.RecordBatch.from_arrays([_i64(c) for c in (g0[at], r0[at], off[at] + offset[hit], least[hit])], names=["g0", "r0", "i", "least"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if size >= symbols and row[0] != held[-1][0]:  # groups stay whole
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[6]) // 8
        if held:
            yield solve(held)

    return strings.repartition("g").sortWithinPartitions("g").mapInArrow(run, FLAGS)


def _whole_windows(strings: DataFrame, length: int) -> DataFrame:
    """The same for prefixes of ``length`` words: a row for each suffix, keyed by two hashes of its prefix. All of a key are under one deep node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, d, g0, r0, off, n, words in zip(*(c.to_pylist() for c in b.columns)):
                w = np.frombuffer(words, np.uint64)
                cols = (np.full(n, g0), np.full(n, r0), np.full(n, d), off + np.arange(n), run_hashes(w, length), run_hashes(mix(w), length))
                yield pa.RecordBatch.from_arrays([_i64(c) for c in cols], names=["g0", "r0", "d", "i", "k1", "k2"])

    rows = stored(strings.mapInArrow(run, "g0 long, r0 long, d long, i long, k1 long, k2 long"), "windows")
    nodes = rows.groupBy("k1", "k2").agg(F.min("d").alias("least"), F.count("*").alias("n"))
    return join_groups(rows, nodes, ["k1", "k2"]).filter("least < d").select("g0", "r0", "i", "least")


def _flags(strings: DataFrame, length: int, gram: int, group: int) -> DataFrame:
    """Groups that fit become subtrees, larger ones get longer prefixes, until all fit or prefixes are windows."""
    out, ladder = None, [gram + (length - gram) * k // 3 for k in (1, 2)]
    while True:
        strings = stored(strings, "strings")
        large = stored(strings.groupBy("g").agg(F.count("*").alias("c")).filter(F.col("c") > group).select("g"), "large")
        more = not large.isEmpty()
        one = _subtrees(strings.join(large, "g", "left_anti") if more else strings, length)
        out = one if out is None else out.unionByName(one)
        if not more:
            return out
        left = strings.join(large, "g", "left_semi").select(strings.columns)
        if not ladder:
            return out.unionByName(_whole_windows(left, length))
        strings = _longer_prefixes(left, length, ladder.pop(0))


def repeated_windows(docs: DataFrame, length: int = 50, gram: int = 25, group: int = 4000) -> tuple[DataFrame, DataFrame]:
    """The bucketed texts (d, h, text), and for each doc_id d that has any the repeated windows: own = list of (h, first, n, least)."""
    rows = only(docs, "doc_id", "text").select(F.coalesce(long_id("doc_id"), F.lit(NULL_ID)).alias("d"), F.col("text").cast("string").alias("text"))
    rows = rows.select("d", F.xxhash64("text").alias("h"), "text")
    texts = bucketed(rows, "texts", "d")

    shared = _segment_rows(rows, length, gram, False).groupBy("g").agg(F.min("d").alias("lo"), F.max("d").alias("hi"), F.count("*").alias("n")).filter("lo < hi").select("g", "n")
    members = stored(semi_join_groups(_segment_rows(rows, length, gram, True), stored(shared, "anchors"), "g", "d"), "segments")

    classes = members.groupBy("g", "r").agg(F.min(F.struct("d", "h", "a", "n")).alias("rep"), F.count("*").alias("size"))
    classes = stored(classes.select("g", "r", "rep.*", "size"), "classes")
    many = classes.groupBy("g").agg(F.count("*").alias("c")).filter("c > 1").select("g")
    own = classes.join(many, "g", "left_semi").groupBy("d").agg(F.collect_list(F.struct("h", "g", "r", "a", "n")).alias("own"))
    flags = _flags(_class_words(texts.join(own.hint("shuffle_hash"), "d"), length), length, gram, group)

    window = F.struct(F.col("i").alias("at"), F.lit(1).cast("long").alias("n"), "least")
    flags = flags.groupBy(F.col("g0").alias("g"), F.col("r0").alias("r")).agg(F.collect_list(window).alias("flags"))  # not more than a class's windows
    known = classes.select("g", "r", F.col("d").alias("first_d"), "size").join(flags, ["g", "r"], "left")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("at"), "n", F.col("first_d").alias("least")))
    # of a member with a larger doc_id every window repeats; where a flag names a still smaller one, that counts
    spans = F.concat(F.coalesce("flags", F.array().cast("array<struct<at:long,n:long,least:long>>")), F.when(F.col("d") > F.col("first_d"), whole).otherwise(F.array().cast("array<struct<at:long,n:long,least:long>>")))
    found = join_groups(members, known, ["g", "r"], "size").select("d", "h", "a", F.explode(spans).alias("s"))
    return texts, found.groupBy("d").agg(F.collect_list(F.struct("h", (F.col("a") + F.col("s.at")).alias("first"), F.col("s.n").alias("n"), F.col("s.least").alias("least"))).alias("own"))


def maximal_repeats(docs: DataFrame, length: int = 50, gram: int = 25, group: int = 4000) -> DataFrame:
    """(doc_id, h, first, n_words, least_id): the maximal runs of windows of a document that start in one document of a smaller id, the least of each window; h is a hash of the text."""
    texts, own = repeated_windows(docs, length, gram, group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for d, own in zip(*(c.to_pylist() for c in b.columns)):
                least: dict[tuple[int, int], int] = {}
                for x in own:
                    for w in range(x["first"], x["first"] + x["n"]):
                        least[x["h"], w] = min(least.get((x["h"], w), x["least"]), x["least"])
                for (h, w), v in sorted(least.items()):
                    if out and out[-1][:2] == [d, h] and out[-1][4] == v and out[-1][2] + out[-1][3] - length + 1 == w:
                        out[-1][3] += 1
                    else:
                        out.append([d, h, w, length, v])
            ids = lambda k: pa.array([None if r[k] == NULL_ID else r[k] for r in out], pa.int64())
            yield pa.RecordBatch.from_arrays([ids(0), *(pa.array([r[k] for r in out], pa.int64()) for k in (1, 2, 3)), ids(4)], names=["doc_id", "h", "first", "n_words", "least_id"])

    return own.select("d", "own").mapInArrow(run, "doc_id long, h long, first long, n_words long, least_id long")


def dedup_substrings(docs: DataFrame, length: int = 50, gram: int = 25, group: int = 4000) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text): kept words joined by one space."""
    texts, own = repeated_windows(docs, length, gram, group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 500):
            ns, gone, kept = [], [], []
            for h, text, own in zip(*(c.to_pylist() for c in b.columns[1:])):
                words = (text or "").encode().split()
                drop = np.zeros(len(words) + 1, np.int64)
                for x in own or ():
                    if x["h"] == h:
                        drop[x["first"]] += 1
                        drop[x["first"] + x["n"] + length - 1] -= 1
                drop = np.cumsum(drop[:-1]) > 0
                ns.append(len(words))
                gone.append(int(drop.sum()))
                kept.append(b" ".join(w for w, x in zip(words, drop.tolist()) if not x) if gone[-1] else b" ".join(words))
            ids = [None if d == NULL_ID else d for d in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])

    joined = texts.join(own.hint("shuffle_hash"), "d", "left").select("d", "h", "text", "own")
    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_text string")


def kept_digest(deduped: DataFrame) -> DataFrame:
    return deduped.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def brute(rows: list[tuple[int | None, str | None]], length: int = 50) -> list[tuple]:
    """The contract, word for word, for tests."""
    ids = [NULL_ID if d is None else d for d, _ in rows]
    words = [(t or "").encode().split() for _, t in rows]
    least: dict[tuple, int] = {}
    for d, w in zip(ids, words):
        for i in range(len(w) - length + 1):
            k = tuple(w[i : i + length])
            least[k] = min(least.get(k, d), d)
    out = []
    for (d, _), i, w in zip(rows, ids, words):
        gone = {p for k in range(len(w) - length + 1) if least[tuple(w[k : k + length])] < i for p in range(k, k + length)}
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out
