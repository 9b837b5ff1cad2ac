"""Mixing sources to target weights by cube-method balanced sampling.

A source's target is its share of the mix. Shares go by weight, stop at ``most`` times the source's size, and what is over is reshared by weight among the
sources below. All documents of a source are taken target/size times on average: the whole part always, the rest by a balanced sample in which every
document has this rest as its inclusion probability.

The sample is drawn by the cube method. Flight: the probabilities of undecided documents move along a vector in the null space of the balancing constraints (their size and their
number over the probability), at random in one of its two directions, until one of them is 0 or 1; so the sums of sizes and documents do not change, and every document's expectation
is its probability. The longest undecided document goes first, against all shorter ones, each moved a little; so long documents are decided while there is enough to make up for them, and
what is left at the end is short. In each block of a source all but at most two documents are decided; what remains of all blocks is dealt into new blocks, until one block for each
source holds it. Its last documents, at most ``REST``, land by linear programming over their subsets (see ``landing``): they keep their expectation as well, as far as the target allows it.

Blocks are a hash of the document and hold about ``block`` documents, however large a source is. All choices come from hashes, so reruns agree.

Cases: a null text has size 0; sources are in code point order, null last, and null is a source of its own; a source of size 0 has target 0; repeated rows are
documents of their own; an empty table gives an empty result; columns other than doc_id, text and source are ignored, whatever their names. A very long
text is a size; one that is longer than all that its source takes, or leaves, is left, or taken, so that the target is met.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, long_id, numbered_columns, only, stored

REST = 12  # documents of a source that landing decides at once, by their 2 ** REST subsets


def targets(totals: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Rows (source, source_size) with target. A row for each source: summaries, so one task orders them.

    Where the reshared level is L, a source gets min(cap, weight * L). Sources in order of cap / weight fill up first; L is where the rest fits.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, map(float, weights))), ((F.row_number().over(in_order) - 1) % len(weights) + 1).cast("int"))
    rows = totals.withColumn("weight", w).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    up_to, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    rows = (
        rows.withColumn("mix", F.lit(float(share)) * F.sum("source_size").over(whole))
        .withColumn("level", (F.col("mix") - F.coalesce(F.sum("cap").over(up_to), F.lit(0.0))) / F.sum("weight").over(after))
        .withColumn("open", F.col("level") * F.col("weight") < F.col("cap"))
    )
    # the first source in this order that isn't full sets the level of all after it
    level = F.min(F.when(F.col("open"), F.struct((F.col("cap") / F.col("weight")).alias("ratio"), F.col("level").alias("level")))).over(whole)["level"]
    return rows.select("source", "source_size", F.least("cap", F.coalesce(level * F.col("weight"), F.col("cap"))).alias("target"))


def flight(pi: np.ndarray, a: np.ndarray, rnd: np.random.Generator, rest: int = 2) -> np.ndarray:
    """The cube method's flight: the sums of the two columns of ``a`` over the probabilities are kept; documents move three at a time until at most ``rest`` are between 0 and 1."""
    p, a = pi.tolist(), a.tolist()
    draws = rnd.random(len(p) + 3).tolist()
    eps, active, nxt, step = 1e-9, [], 0, 0
    undecided = sum(eps < v < 1 - eps for v in p)
    while undecided > rest:
        while len(active) < 3 and nxt < len(p):
            if eps < p[nxt] < 1 - eps:
                active.append(nxt)
            nxt += 1
        i, j, k = active
        (a1, a2), (b1, b2), (c1, c2) = a[i], a[j], a[k]
        u = (b1 * c2 - b2 * c1, c1 * a2 - c2 * a1, a1 * b2 - a2 * b1)  # null vector of the 2 by 3 matrix
        top = max(abs(v) for v in u)
        if top < 1e-12:  # the columns are parallel: two of them are enough
            u = (b1, -a1, 0.0) if abs(a1) + abs(b1) > 0 else (b2, -a2, 0.0)
            top = max(abs(v) for v in u)
        u = tuple(v / top for v in u)
        up = min((1 - p[q]) / v if v > 0 else -p[q] / v for q, v in zip(active, u) if abs(v) > 1e-12)
        down = min(p[q] / v if v > 0 else (p[q] - 1) / v for q, v in zip(active, u) if abs(v) > 1e-12)
        by = up if draws[step] * (up + down) < down else -down
        step += 1
        for q, v in zip(active, u):
            p[q] = min(1.0, max(0.0, p[q] + by * v))
        inside = [q for q in active if eps < p[q] < 1 - eps]
        for q in active:
            if q not in inside:
                p[q] = float(round(p[q]))
        if len(inside) == 3:  # rounding kept all three inside: settle the nearest
            q = min(inside, key=lambda q: min(p[q], 1 - p[q]))
            p[q] = float(round(p[q]))
            inside.remove(q)
        undecided -= 3 - len(inside)
        active = inside
    return np.array(p)


def long_first(pi: np.ndarray, size: np.ndarray, rnd: np.random.Generator, rest: int = 8) -> np.ndarray:
    """Flight steps that each decide the longest undecided document and move all shorter ones, these in proportion to what room they have, until ``rest`` documents are undecided. One of over a
    hundredth of the sizes' expected sum that the others can't make up for both ways doesn't keep its probability: it goes the way that keeps the sum."""
    eps, out = 1e-9, pi.copy()
    at = np.argsort(-size, kind="stable")
    at = at[(pi[at] > eps) & (pi[at] < 1 - eps)]
    p, s = pi[at], size[at].astype(float)
    slack = 0.01 * float(pi @ size)

    def reach(w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The step's vector, and how far it can go up and down before each document is decided."""
        u = np.concatenate([[1.0], w])
        with np.errstate(divide="ignore", invalid="ignore"):
            return u, np.where(u > 0, (1 - p) / u, np.where(u < 0, -p / u, np.inf)), np.where(u > 0, p / u, np.where(u < 0, (p - 1) / u, np.inf))

    while len(at) > rest:
        room, o = np.minimum(p[1:], 1 - p[1:]), s[1:]
        n, m, v = room.sum(), room @ o, room @ (o * o)
        det = n * v - m * m
        both = done = False
        if det > 1e-9 * n * v:  # sizes and number of the others add up to the longest one's, turned round
            b = (m - s[0] * n) / det
            kept = u, ups, downs = reach(room * ((-1 - b * m) / n + b * o))
            both, done = True, ups.min() == ups[0] and downs.min() == downs[0]
        if not done:  # documents of one size, or one so long that the number has to give way: sizes alone, each with all the room that the longest one's two ways leave it
            room = np.minimum((1 - p[1:]) / p[0], p[1:] / (1 - p[0]))
            u, ups, downs = reach(-s[0] * room / (room @ o))
            done = ups.min() >= ups[0] * (1 - 1e-9) and downs.min() >= downs[0] * (1 - 1e-9)
        if done:
            if both and len(at) > 8 * rest:  # the number is kept as well, if another document is decided first
                u, ups, downs = kept
            up, down = ups.min(), downs.min()
            rises = rnd.random() * (up + down) < down
            q = int((ups if rises else downs).argmin())
            p = np.clip(p + (up if rises else -down) * u, 0.0, 1.0)
            p[q] = np.round(p[q])
        else:  # too long for that: it goes a way that the others can make up for, if there are two as its probability says
            down, up = (1 - p[1:]) @ o >= p[0] * s[0], p[1:] @ o >= (1 - p[0]) * s[0]
            if s[0] <= slack or not (up or down):
                break  # short enough for the rest of the flight and for landing
            if both:
                u, ups, downs = kept
            rises = up and (not down or rnd.random() < p[0])
            way = ups if rises else downs
            if both and (len(at) > 8 * rest or way.min() == way[0]):  # as far as goes with the number kept
                q = int(way.argmin())
                p = np.clip(p + (way[q] if rises else -way[q]) * u, 0.0, 1.0)
                p[q] = np.round(p[q])
            else:
                room = p[1:] if rises else 1 - p[1:]
                p = np.clip(p + ((1 - p[0]) if rises else -p[0]) * np.concatenate([[1.0], -s[0] * room / (room @ o)]), 0.0, 1.0)
                p[0] = float(rises)
        left = (p > eps) & (p < 1 - eps)
        out[at[~left]] = np.round(p[~left])
        at, p, s = at[left], p[left], s[left]
    out[at] = p
    return out


def _nearest_design(pi: np.ndarray, cubes: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """(columns, weights): the distribution over the columns of ``cubes`` whose expectation is nearest to ``pi``, by the simplex method from column ``first``. A document's deviation is
    an extra column each way, of cost 1; every basis on the way is a distribution."""
    q, n = cubes.shape
    table = np.hstack([np.vstack([cubes, np.ones(n)]), np.vstack([np.eye(q), np.zeros(q)]), np.vstack([-np.eye(q), np.zeros(q)])])
    cost, right = np.concatenate([np.zeros(n), np.ones(2 * q)]), np.append(pi, 1.0)
    basis = [first] + [n + i if pi[i] >= cubes[i, first] else n + q + i for i in range(q)]
    for _ in range(100 * (q + 1)):
        own = table[:, basis]
        x = np.linalg.solve(own, right)
        gain = cost - np.linalg.solve(own.T, cost[basis]) @ table
        enter = int(gain.argmin())
        if gain[enter] > -1e-9:
            break
        way = np.linalg.solve(own, table[:, enter])
        with np.errstate(divide="ignore", invalid="ignore"):
            far = np.where(way > 1e-9, np.maximum(x, 0.0) / way, np.inf)
        basis[int(far.argmin())] = enter
    x = np.clip(np.linalg.solve(table[:, basis], right), 0.0, 1.0)
    return np.array([c for c in basis if c < n]), np.array([v for c, v in zip(basis, x) if c < n])


def landing(pi: np.ndarray, size: np.ndarray, seed: float) -> np.ndarray:
    """Decide the few documents that are left, ``REST`` at most, by linear programming; decided ones stay. Of all their subsets, those count whose sum of sizes is as near as any to what is
    expected, or within a thousandth (a hundredth, if that isn't enough) of the block's expected sum more; one is drawn from the distribution over these that is nearest to the probabilities.
    So every document keeps its expectation where the sum allows it, and the sum wins where a document is too long for both."""
    rnd, out = np.random.default_rng(int(abs(seed))), pi.copy()
    left = np.flatnonzero((out > 1e-9) & (out < 1 - 1e-9))
    if len(left):
        cubes = (np.arange(2 ** len(left)) >> np.arange(len(left))[:, None] & 1).astype(float)
        off = np.abs(size[left].astype(float) @ cubes - out[left] @ size[left])
        for slack in (0.001, 0.01):
            near = np.flatnonzero(off <= off.min() + slack * float(pi @ size))
            columns, weights = _nearest_design(out[left], cubes[:, near], int(off[near].argmin()))
            if np.abs(cubes[:, near[columns]] @ weights - out[left]).max() < 1e-6:
                break
        out[left] = cubes[:, near[rnd.choice(columns, p=weights / weights.sum())]]
    return np.round(out)


def fly(pi: np.ndarray, size: np.ndarray, seed: int, rest: int = 2) -> np.ndarray:
    """The whole flight of a block: at most ``rest`` documents, two or more, stay between 0 and 1."""
    rnd = np.random.default_rng(seed)
    return flight(long_first(pi, size, rnd, max(8, rest)), np.column_stack([size, np.ones(len(pi))]), rnd, rest)


def _round(units: DataFrame, last: bool) -> DataFrame:
    """One round of flights; the last one lands."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "doc_id", "h", "nth"], ascending=[False, True, True, True], kind="stable", na_position="first").reset_index(drop=True)
        size = pdf["size"].to_numpy(float)
        seed = int(np.bitwise_xor.reduce(pdf["h"].to_numpy(np.int64)) & 0x7FFFFFFF) + len(pdf)
        pi = fly(pdf["pi"].to_numpy(float), size, seed, REST if last else 2)
        return pdf.assign(pi=landing(pi, size, seed + 1) if last else pi)

    parts = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # blocks are few bytes and much work: they aren't put together by their bytes
    return units.repartition(parts, "source_no", "blk").groupBy("source_no", "blk").applyInPandas(run, units.schema)


def balanced_sample(units: DataFrame, block: int = 8192) -> DataFrame:
    """With blocks of three or more, two documents of a block go on. ``pi`` of units (source_no, doc_id, h, nth, size, pi) becomes 0 or 1, balanced in each source; written between the rounds."""
    decided = None
    left = stored(units.filter("pi > 1e-9 and pi < 1 - 1e-9").withColumn("blk", F.lit(0)), "units")
    sure = units.filter("not (pi > 1e-9 and pi < 1 - 1e-9)").withColumn("pi", F.round("pi"))
    turn = 0
    while True:
        counts = left.groupBy("source_no").agg(F.ceil(F.count("*") / block).alias("blocks"))
        most = counts.agg(F.max("blocks")).first()[0]
        if most is None:
            return sure if decided is None else sure.unionByName(decided)
        dealt = left.drop("blk").join(counts, "source_no").withColumn("blk", F.pmod(F.xxhash64("h", "nth", F.lit(turn)), F.col("blocks")).cast("int")).drop("blocks")
        done = stored(_round(dealt.select(left.columns), most == 1), f"round-{turn}")
        settled = done.filter("pi = 0 or pi = 1").select(sure.columns)
        decided = settled if decided is None else decided.unionByName(settled)
        if most == 1:
            return sure.unionByName(decided)
        left, turn = done.filter("not (pi = 0 or pi = 1)"), turn + 1


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, block: int = 8192) -> DataFrame:
    """(doc_id, size, source_size, target, taken, h, nth): ``taken`` is in words; a document is taken taken / size times. h and nth tell rows of one doc_id apart."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    # rows that are alike but for their place can't be told apart: they are one row with a count, then numbered
    rows = only(docs, "doc_id", "text", "source").select(long_id("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), "source", "text").alias("h"), F.col("source").cast("string").alias("source"), size.alias("size"))
    rows = rows.groupBy("doc_id", "h", "source", "size").agg(F.count("*").cast("int").alias("n"))
    rows = stored(rows.select("doc_id", "h", "source", "size", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("nth")), "sizes")
    totals = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    totals = stored(totals.withColumn("source_no", F.xxhash64("source")), "targets")
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    named = rows.join(totals.withColumnRenamed("source", "s"), rows["source"].eqNullSafe(F.col("s"))).drop("s")
    units = named.filter("size > 0").select("source_no", "doc_id", "h", "nth", "size", (rate - F.floor(rate)).cast("double").alias("pi"))
    chosen = balanced_sample(units, block).select("h", "nth", F.col("pi").cast("long").alias("extra"))
    return named.join(chosen, ["h", "nth"], "left").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * (F.floor(rate) + F.coalesce("extra", F.lit(0)))).cast("long").alias("taken"), "h", "nth"
    )


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The documents themselves, each as often as it is taken. Documents without words are in no mix. Rows that are alike in all columns but
    for their place are one row that is repeated as often as they are taken together."""
    taken = mix(docs, **how).filter("size > 0").groupBy("h").agg(F.sum(F.col("taken") / F.col("size")).cast("int").alias("times"), F.count("*").alias("rows"))
    taken = stored(taken, "taken")
    at = lambda n: F.col(f"c{docs.columns.index(n)}")
    plain = numbered_columns(docs)
    hashed = plain.withColumn("h", F.xxhash64(at("doc_id").cast("long"), at("source").cast("string"), at("text")))
    if taken.filter("rows > 1").limit(1).count():
        hashed = hashed.dropDuplicates(["h"])
    joined = hashed.join(taken.filter("times > 0").select("h", "times").hint("shuffle_hash"), "h")  # grows with the documents: shuffled at every size
    return joined.withColumn("k", F.explode(F.array_repeat(F.lit(1), F.col("times")))).select(*plain.columns).toDF(*docs.columns)


def brute_targets(sizes: dict, weights=(3, 1, 2), share: float = 1.5, most: float = 2.0) -> dict:
    """Resharing step by step, for tests."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, mix_left, open_ = {}, share * sum(sizes.values()), set(order)
    while open_:
        total = sum(w[s] for s in open_)
        full = {s for s in open_ if w[s] / total * mix_left > most * sizes[s] * (1 + 1e-12)}
        if not full:
            return out | {s: min(most * sizes[s], w[s] / total * mix_left) for s in open_}
        out |= {s: most * sizes[s] for s in full}
        mix_left -= sum(most * sizes[s] for s in full)
        open_ -= full
    return out
