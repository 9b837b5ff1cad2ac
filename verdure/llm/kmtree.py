"""Approximate nearest neighbours by inner product: a hierarchical k-means tree with best-bin-first traversal.

The tree is fitted on a sample of at most ``sample`` distinct vectors; its size so is bounded, and it goes to every task. All vectors are then put into leaves.
A query walks down the tree; nodes that it passes by wait in a priority queue, nearest centroid first, and the next leaf is taken from the queue's front.
How many vectors' worth of leaves a query opens is calibrated: for ``probes`` queries the true neighbours among all vectors are found in blocks, and visits are widened
until the mean recall reaches ``recall``.

Equal vectors are one class, indexed once with its smallest ids, so a vector that a third of the rows share is one entry; every query finds its class's
result. A leaf's vectors are dealt into blocks of about ``block``, and the queries that open the leaf go to each of its blocks; a block keeps its best, and
a window with a limit keeps each query's best of all blocks.

Scores are inner products in double precision of the original vectors, summed by one routine in one order, so equal vectors score equally.

Cases: vectors that are null, zero, of another length than most, or hold null or non-finite components take no part; equal ids are rows of their own, and a query's own id is no
candidate of it; fewer candidates than k give fewer rows; an empty table gives an empty result; other columns are ignored, whatever their
names; of vectors of several lengths only the commonest length can be compared in one space.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import join_groups, long_id, only, stored


class Tree:
    """A hierarchical k-means tree: ``kids`` of each node (none: a leaf), ``leaf`` numbers of leaves, centroids."""

    def __init__(self, points: np.ndarray, branch: int, most: int, seed: int = 7):
        rnd = np.random.default_rng(seed)
        self.centre, self.kids, self.leaf, self.leaves = [points.mean(axis=0) if len(points) else np.zeros(0)], [[]], [-1], 0
        todo = [(0, points)]
        while todo:
            node, own = todo.pop()
            parts = self._split(own, branch, rnd) if len(own) > most else []
            if len(parts) < 2:
                self.leaf[node], self.leaves = self.leaves, self.leaves + 1
                continue
            for c, part in parts:
                self.centre.append(c)
                self.kids.append([])
                self.leaf.append(-1)
                self.kids[node].append(len(self.kids) - 1)
                todo.append((len(self.kids) - 1, part))
        self.block = [np.array([self.centre[k] for k in kids]) for kids in self.kids]

    @staticmethod
    def _split(own: np.ndarray, branch: int, rnd: np.random.Generator, rounds: int = 10) -> list[tuple[np.ndarray, np.ndarray]]:
        centre = own[rnd.choice(len(own), branch, replace=False)]
        for _ in range(rounds):
            near = np.argmax(own @ centre.T - 0.5 * (centre**2).sum(axis=1), axis=1)
            centre = np.array([own[near == k].mean(axis=0) if (near == k).any() else centre[k] for k in range(branch)])
        near = np.argmax(own @ centre.T - 0.5 * (centre**2).sum(axis=1), axis=1)
        return [(centre[k], own[near == k]) for k in range(branch) if (near == k).any()]

    def place(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point: at every node the nearest centroid."""
        out, todo = np.zeros(len(points), np.int32), [(0, np.arange(len(points)))]
        while todo:
            node, own = todo.pop()
            if not len(own):
                continue
            if not self.kids[node]:
                out[own] = self.leaf[node]
                continue
            c = self.block[node]
            near = np.argmax(points[own] @ c.T - 0.5 * (c**2).sum(axis=1), axis=1)
            todo += [(k, own[near == i]) for i, k in enumerate(self.kids[node])]
        return out

    def best_bins(self, query: np.ndarray, sizes: np.ndarray, budget: float) -> list[int]:
        """Leaves in best-bin-first order, until they hold ``budget`` vectors."""
        queue, out, seen = [(0.0, 0)], [], 0
        while queue and seen < budget:
            _, node = heapq.heappop(queue)
            while self.kids[node]:
                near = self.block[node] @ query
                best = int(np.argmax(near))
                for i, k in enumerate(self.kids[node]):
                    if i != best:
                        heapq.heappush(queue, (-float(near[i]), k))
                node = self.kids[node][best]
            out.append(self.leaf[node])
            seen += int(sizes[self.leaf[node]])
        return out


def scores(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each summed in one order whatever stands beside it."""
    return np.cumsum(rows.astype(np.float64) * query.astype(np.float64), axis=1)[:, -1]


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f8").reshape(len(column), -1) if len(column) else np.zeros((0, 1), "<f8")


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec): the rows that take part, the vector as little-endian floats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, out = [], []
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if i is None or not v or None in v:
                    continue
                a = np.array(v, "<f8")
                if np.isfinite(a).all() and a.any():
                    ids.append(i)
                    out.append(a.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], names=["vec_id", "vec"])

    rows = stored(only(vectors, "vec_id", "embedding").select(long_id("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(run, "vec_id long, vec binary"), "vectors")
    lengths = rows.groupBy(F.length("vec").alias("bytes")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "bytes").limit(1).collect()
    return rows.filter(F.length("vec") == (lengths[0]["bytes"] if lengths else 0))


def exact(classes: DataFrame, queries: list[tuple[int, bytes]], k: int) -> dict[int, list[tuple[float, int]]]:
    """The true k nearest classes (score, cls) of a fixed number of queries, over all classes in blocks."""
    q = np.array([np.frombuffer(v, "<f8") for _, v in queries], np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[] for _ in queries]
        for b in batches:
            ids, m = np.array(b.column(0).to_pylist(), np.int64), _matrix(b.column(1).to_pylist()).astype(np.float64)
            if not len(ids):
                continue
            s = q @ m.T
            top = np.argpartition(-s, min(k, len(ids)) - 1, axis=1)[:, :k]
            for n in range(len(queries)):
                best[n] = heapq.nlargest(k, best[n] + [(float(s[n, t]), int(ids[t])) for t in top[n]])
        rows = [(n, s, c) for n, own in enumerate(best) for s, c in own]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.float64(), pa.int64()))], names=["q", "s", "cls"])

    rows = classes.select("cls", "vec").mapInArrow(run, "q int, s double, cls long")
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s"), "cls"))).filter(F.col("r") <= k)
    out: dict[int, list] = {}
    for r in ranked.collect():  # probes times k rows: a fixed size
        out.setdefault(r["q"], []).append((r["s"], r["cls"]))
    return out


def search(
    vectors: DataFrame, every: int = 20, k: int = 20, sample: int = 20_000, branch: int = 8, most: int = 128, block: int = 4096, probes: int = 96, recall: float = 0.97
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every`` its k nearest others."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    # a class is named by its smallest id; the k + 1 smallest ids are all that any query can get from it
    hashed = rows.withColumn("vh", F.xxhash64("vec"))
    members = hashed.withColumn("r", F.row_number().over(Window.partitionBy("vh", "vec").orderBy("vec_id"))).filter(F.col("r") <= k + 1)
    classes = stored(members.groupBy("vh", "vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("cls", F.col("ids")[0]), "classes")
    names = classes.select("cls", "ids")

    total = classes.count()
    if not total:
        return spark.range(0).select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score"))
    # the sample: the least hashes of ids, so the same on every run
    points = [r["vec"] for r in classes.orderBy(F.xxhash64("cls")).limit(sample).select("vec").collect()]
    tree = Tree(_matrix(points).astype(np.float64), branch, most)
    shared = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaves = shared.value.place(_matrix(b.column(1).to_pylist()).astype(np.float64)) if b.num_rows else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaves, pa.int32())], names=["cls", "vec", "leaf"])

    placed = stored(classes.select("cls", "vec").mapInArrow(place, "cls long, vec binary, leaf int"), "leaves")
    sizes = np.zeros(tree.leaves, np.int64)
    for r in placed.groupBy("leaf").count().collect():  # a row for each leaf: bounded by the sample
        sizes[r["leaf"]] = r["count"]

    asked = hashed.filter(F.col("vec_id") % every == 0)
    asked_classes = asked.select("vh", "vec").distinct().join(classes.select("vh", "vec", "cls"), ["vh", "vec"]).select(F.col("cls").alias("q"), "vec")
    picked = [(r["q"], r["vec"]) for r in asked_classes.orderBy(F.xxhash64("q", F.lit(1))).limit(probes).collect()]
    budget = calibrate(tree, sizes, picked, exact(placed, picked, k + 1), placed, recall)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = np.maximum(1, -(-sizes // block))
        for b in batches:
            q, v, leaf, part = [], [], [], []
            for i, vec in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for n in shared.value.best_bins(np.frombuffer(vec, "<f8").astype(np.float64), sizes, budget):
                    if sizes[n]:
                        for p in range(parts[n]):
                            q.append(i), v.append(vec), leaf.append(n), part.append(p)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.binary()), pa.array(leaf, pa.int32()), pa.array(part, pa.int32())], names=["q", "vec", "leaf", "part"])

    visits = asked_classes.mapInArrow(visit, "q long, vec binary, leaf int, part int")
    parts = F.element_at(F.lit([int(max(1, -(-s // block))) for s in sizes]), F.col("leaf") + 1)
    dealt = placed.withColumn("part", F.pmod(F.xxhash64("cls"), parts).cast("int"))

    def best(asked: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(own):
            return pd.DataFrame({"q": [], "cls": [], "score": []}).astype({"q": "int64", "cls": "int64", "score": "float64"})
        own = own.sort_values("cls")
        m, ids = _matrix(own["vec"].tolist()), own["cls"].to_numpy()
        names, found, got = [], [], []
        wide = m.astype(np.float64)
        n = min(k + 1, len(ids))
        for at in range(0, len(asked), 256):
            part = asked.iloc[at : at + 256]
            qs = _matrix(part["vec"].tolist()).astype(np.float64)
            rough = qs @ wide.T
            # all that come within rounding of the n-th are scored again in the one order
            floor = -np.partition(-rough, n - 1, axis=1)[:, n - 1]
            for name, q, r, f in zip(part["q"].tolist(), qs, rough, floor):
                near = np.flatnonzero(r >= f - 1e-9 * max(1.0, abs(f)))
                s = scores(m[near], q)
                o = np.lexsort((ids[near], -s))[:n]
                names.append(np.full(len(o), name, np.int64)), found.append(ids[near][o]), got.append(s[o])
        return pd.DataFrame({"q": np.concatenate(names), "cls": np.concatenate(found), "score": np.concatenate(got)})

    found = visits.groupBy("leaf", "part").cogroup(dealt.groupBy("leaf", "part")).applyInPandas(best, "q long, cls long, score double")
    near = found.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "cls"))).filter(F.col("r") <= k + 1).drop("r")
    # each class's ids, nearest first: of each query class the list is short, and its queries share it
    listed = near.join(names, "cls").select("q", F.explode("ids").alias("vec_id"), "score")
    listed = listed.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).filter(F.col("r") <= k + 1)
    lists = listed.groupBy("q").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("neg"), "vec_id"))).alias("near"))
    # queries of one vector share its list, however many they are
    shared_lists = asked.groupBy("vh", "vec").agg(F.count("*").alias("n")).join(classes.select("vh", "vec", F.col("cls").alias("q")), ["vh", "vec"]).join(lists, "q")
    askers = join_groups(asked.select(F.col("vec_id").alias("query_id"), "vh", "vec"), shared_lists, ["vh", "vec"])
    own = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return askers.select("query_id", F.posexplode(own).alias("pos", "x")).select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.neg")).alias("score"))


def calibrate(tree: Tree, sizes: np.ndarray, picked: list[tuple[int, bytes]], truth: dict, placed: DataFrame, recall: float) -> float:
    """The least number of vectors in opened leaves at which the picked queries find ``recall`` of their true neighbours."""
    wanted = sorted({c for own in truth.values() for _, c in own})
    leaf_of = {r["cls"]: r["leaf"] for r in placed.filter(F.col("cls").isin(wanted)).select("cls", "leaf").collect()} if wanted else {}
    costs = []
    for n, (_, vec) in enumerate(picked):
        order = tree.best_bins(np.frombuffer(vec, "<f8").astype(np.float64), sizes, float("inf"))
        before = dict(zip(order, np.cumsum(sizes[order]) - sizes[order]))  # a leaf is opened if fewer than the budget are seen before it
        costs += [float(before[leaf_of[c]]) for _, c in truth.get(n, ())]
    if not costs:
        return float("inf")
    return float(np.sort(costs)[min(len(costs) - 1, int(np.ceil(recall * len(costs))))]) + 1.0


def brute(rows: list[tuple], every: int, k: int) -> list[tuple]:
    """All pairs, for tests."""
    good = [(i, np.array(v, "<f8").astype(np.float64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    wide = max((len(v) for _, v in good), key=[len(v) for _, v in good].count, default=0)
    good, out = [(i, v) for i, v in good if len(v) == wide], []
    for i, q in good:
        if i % every == 0:
            near = sorted((-float(np.cumsum(v * q)[-1]), j) for j, v in good if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(near)]
    return out
