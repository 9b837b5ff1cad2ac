"""Toxicity: a linear classifier by non-negative positive-unlabelled learning with balanced classes.

Confirmed toxic rows are the positives; the unlabelled rows are a sample of all rows of the learning folds, toxic ones among them unknown. With the class prior p, estimated by the share of
toxic rows among the labelled ones of these folds, the risk of a score is ``E+[loss(+)] / 2 + max(0, Eu[loss(-)] - p E+[loss(-)]) / (2 (1 - p))``: the toxic part of the unlabelled rows is
taken out of their loss, and where the difference falls below zero, which is overfitting, the step goes back up (gradient of that part alone, reversed). Both classes weigh a half, however few
rows are toxic: with weights of p and 1 - p every feature that is as frequent in either class is pushed down by the many clean rows at the start, long texts have hundreds of those, and where
they are in the flat part of the loss toxic ones never come up again. The loss is the sigmoid: bounded, so rows that are surely toxic don't make the difference negative by their size. A
score is the logistic function of the weights' sum.

Features are words and their beginnings of 4 to 6 letters, lower case, present or not in the whole text; beginnings stand for inflected forms in any language.
That a text has two or more, or three or more, different words of one beginning are further features: one such word occurs by chance in clean texts, several forms seldom do. Candidates are those of enough
positives; in how many rows of the learning folds each occurs is counted over all of these, in tasks first; the ``features`` that tell positives apart best are the model's.

Bounds: the classifier is fitted on about ``positives`` confirmed and ``unlabelled`` rows at most, chosen by a hash of doc_id, and on ``features`` features out of ``candidates``. So what the
driver gets, and what tasks get of the model, doesn't grow with the table. Counts, scores and the fold rule cover all rows.

A row is held out if 5 divides the crc32 of its doc_id as text; its label is never read. Of null doc_ids, which are held out, that of the empty text is taken.

Cases: null and empty texts have no feature, and the score that follows from that; repeated rows get the same score; of several labels of a doc_id the toxic one counts, null labels don't;
without a positive or without labelled rows all scores are 0; an empty table gives an empty result; of a very long text every word counts, once; further columns are left out, whatever
their names. ``label``, ``lang``, ``source`` and ``doc_id`` are no features.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import only, small, stored

FOLDS = 5
WORDS = re.compile(r"[^\W\d_]+")
#: Least likelihood ratio statistic (chi-squared, one degree of freedom) of a feature; 4 is the five-per-cent point.
SURE = 4
#: The same for numbers of words, of which there are many more: 11 is the one-in-a-thousand point.
SURE_MANY = 11
#: So many different words of a beginning are features of their own.
MANY = (2, 3)
#: Words whose features a task remembers at once.
REMEMBERED = 300_000


def fold(doc_id: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % FOLDS


def features_of(word: str) -> list[str]:
    """The word, and its beginnings after a caret."""
    return [word, *("^" + word[:n] for n in (4, 5, 6) if len(word) >= n)]


def levels(beginnings: Iterable[str]) -> Iterator[str]:
    """Features that tell how many different words have a beginning, 2 and 3 or more, of each word's beginnings one after the other."""
    for f, n in Counter(beginnings).items():
        for k in MANY:
            if n >= k:
                yield f"{k}{f}"


class Finder:
    """Numbers of a text's features, of the ones that are known; what a word has is remembered, for a bounded number of words."""

    def __init__(self, known: dict[str, int]):
        self.known, self.memory = known, {}
        # a beginning that is known by its numbers of words alone is found as well, under a number below 0
        own = {f[1:] for f in known if f[:1].isdigit()}
        self.beginnings = {f: known.get(f, -1 - i) for i, f in enumerate(sorted(own))}
        self.many = {n: [known.get(f"{k}{f}") for k in MANY] for f, n in self.beginnings.items()}

    def __call__(self, text: str | None) -> set[int]:
        out: set[int] = set()
        again: dict[int, int] = {}
        many = self.many
        for w in set(WORDS.findall((text or "").lower())):
            own = self.memory.get(w)
            if own is None:
                if len(self.memory) >= REMEMBERED:
                    self.memory.clear()
                own = self.memory[w] = tuple(n for f in features_of(w) if (n := self.known.get(f, self.beginnings.get(f))) is not None)
            for n in own:
                if n in out or n in again:
                    if n in many:
                        k = again[n] = again.get(n, 1) + 1
                        if k in MANY and (m := many[n][MANY.index(k)]) is not None:
                            out.add(m)
                elif n >= 0:
                    out.add(n)
                else:
                    again[n] = 1
        return out


@dataclass
class Model:
    known: dict[str, int]
    weights: np.ndarray
    bias: float

    def score(self, found: set[int]) -> float:
        """Features are added in the order of their numbers, so that equal texts get equal scores."""
        z = self.bias + float(np.sum(self.weights[sorted(found)])) if found else self.bias
        return float(1 / (1 + np.exp(-z)))


def _loss(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """1 / (1 + exp(z)) and its derivative."""
    own = 1 / (1 + np.exp(np.clip(z, -500, 500)))
    return own, -own * (1 - own)


@dataclass
class Sets:
    """Rows of features one after the other: row i has values[offsets[i]:offsets[i + 1]]."""

    offsets: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, rows: list[list[int]]) -> Sets:
        return cls(np.cumsum([0, *map(len, rows)]), np.array([f for r in rows for f in r], np.int64))

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place among ``rows``, feature) of these rows' features."""
        n = self.offsets[rows + 1] - self.offsets[rows]
        at = np.repeat(np.arange(len(rows)), n)
        return at, self.values[np.arange(len(at)) + np.repeat(self.offsets[rows] - (np.cumsum(n) - n), n)]


def fit(toxic: Sets, unlabelled: Sets, prior: float, n: int, rounds: int = 60, batches: int = 6, rate: float = 0.05, decay: float = 1e-4, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights of the n features and the bias, by Adam on the non-negative risk of balanced classes."""
    rng = np.random.default_rng(seed)
    w = np.zeros(n + 1)  # the last one is the bias
    w[n] = np.log(prior / (1 - prior))
    m, v, step = np.zeros(n + 1), np.zeros(n + 1), 0

    def scored(rows: Sets, part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, f = rows.take(part)
        return np.bincount(at, w[f], len(part)) + w[n], at, f

    def gradient(slopes: np.ndarray, at: np.ndarray, f: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(f, slopes[at], n), slopes.sum()) / len(slopes)

    for _ in range(rounds):
        for p_part, u_part in zip(np.array_split(rng.permutation(len(toxic)), batches), np.array_split(rng.permutation(len(unlabelled)), batches)):
            if not len(p_part) or not len(u_part):
                continue
            zp, ap, fp = scored(toxic, p_part)
            zu, au, fu = scored(unlabelled, u_part)
            (_, up), (lp, down), (lu, rest) = _loss(zp), _loss(-zp), _loss(-zu)
            negative = lu.mean() - prior * lp.mean()
            g = (gradient(-rest, au, fu) - prior * gradient(-down, ap, fp)) / (2 * (1 - prior))
            g = gradient(up, ap, fp) / 2 + g if negative >= 0 else -g
            g[:n] += decay * w[:n]
            step += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:n], float(w[n])


def _share(df: DataFrame, most: int, seed: int) -> Column:
    """Whether a doc_id is in a sample of about ``most`` rows of ``df`` at most."""
    n = df.count()
    return F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, most / max(1, n)))


def _counted(rows: DataFrame) -> DataFrame:
    """(feature, n): in how many texts each feature is, summed in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            both = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(both, names=["feature", "n"])

        for b in small(batches, 200):
            for text in b.column(0).to_pylist():
                own = [f for w in set(WORDS.findall((text or "").lower())) for f in features_of(w)]
                counts.update({*own, *levels(f for f in own if f[0] == "^")})
                if len(counts) > 500_000:
                    yield out()
        yield out()

    return rows.select(F.col("text")).mapInArrow(run, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def _found(rows: DataFrame, known: dict[str, int]) -> DataFrame:
    """(kind, h, found, n): of rows with a ``kind`` their features' numbers and the hash ``h``, and of all rows (kind null) in how many each feature is, summed in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, counts = Finder(known), np.zeros(len(known), np.int64)
        schema = pa.schema([("kind", pa.string()), ("h", pa.int64()), ("found", pa.list_(pa.int32())), ("n", pa.int64())])
        for b in small(batches, 200):
            kinds, hashes, found = [], [], []
            for kind, h, text in zip(*(c.to_pylist() for c in b.columns)):
                own = sorted(find(text))
                counts[own] += 1
                for k in kind or ():
                    kinds.append(k)
                    hashes.append(h)
                    found.append(own)
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(hashes, pa.int64()), pa.array(found, pa.list_(pa.int32())), pa.nulls(len(kinds), pa.int64())], schema=schema)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.string()), pa.nulls(len(at), pa.int64()), pa.array([[int(i)] for i in at], pa.list_(pa.int32())), pa.array(counts[at])], schema=schema)

    return rows.select("kind", F.xxhash64("doc_id", "text").alias("h"), "text").mapInArrow(run, "kind string, h long, found array<int>, n long")


def learn(docs: DataFrame, labels: DataFrame, positives: int = 10_000, unlabelled: int = 20_000, features: int = 4096, candidates: int = 50_000, least: int = 3) -> Model | None:
    """The model of (doc_id, text) and (doc_id, toxic); None where nothing is labelled or nothing toxic."""
    docs = only(docs, "doc_id", "text").select("doc_id", F.col("text").cast("string").alias("text")).filter(fold(F.col("doc_id")) != 0)
    marks = only(labels, "doc_id", "toxic").filter(F.col("toxic").isNotNull() & (fold(F.col("doc_id")) != 0)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = stored(marks, "marks")
    confirmed = marks.filter("toxic = 1").select("doc_id")
    chosen = confirmed.filter(_share(confirmed, positives, 1))
    known = docs.join(F.broadcast(chosen), "doc_id")  # ``positives`` ids at most, or so
    known = stored(known, "confirmed")
    n, rate = known.count(), marks.agg(F.avg("toxic")).first()[0]
    if not n:
        return None
    counted = _counted(known).filter(F.col("n") >= max(least, n // 500)).orderBy(F.desc("n"), "feature").limit(candidates).collect()
    names = {r["feature"]: i for i, r in enumerate(counted)}
    among = np.array([r["n"] for r in counted], float)
    marked = docs.withColumn("u", _share(docs, unlabelled, 2)).join(F.broadcast(chosen.withColumn("p", F.lit(True))), "doc_id", "left")
    kinds = F.array_compact(F.array(F.when(F.col("p"), F.lit("p")), F.when(F.col("u"), F.lit("u"))))
    seen = stored(_found(marked.select(kinds.alias("kind"), "doc_id", "text"), names), "found")
    of_all, rows = np.zeros(len(names)), docs.count()
    for r in seen.filter("kind IS NULL").groupBy(F.col("found")[0].alias("f")).agg(F.sum("n").alias("n")).collect():  # a row for each candidate at most
        of_all[r["f"]] = r["n"]
    # how much more often a feature is in positives, by the likelihood ratio of the two shares
    share, base = np.clip(among / n, 1e-9, 1 - 1e-9), np.clip(np.maximum(of_all, 1) / max(1, rows), 1e-9, 1 - 1e-9)
    ratio = np.where(share > base, share * np.log(share / base) + (1 - share) * np.log((1 - share) / (1 - base)), 0)
    sure = np.array([SURE_MANY if r["feature"][0].isdigit() else SURE for r in counted])
    best = [i for i in np.lexsort((np.arange(len(ratio)), -ratio))[:features].tolist() if 2 * n * ratio[i] >= sure[i]]
    number = {i: k for k, i in enumerate(best)}
    renamed = np.full(len(names), -1)
    renamed[best] = np.arange(len(best))
    mine = F.array(*(F.lit(i) for i in best)) if len(best) < 500 else F.from_json(F.lit(str(best)), "array<int>")

    def sample(kind: str) -> Sets:
        """The chosen rows' features that are the model's, in an order that doesn't depend on tasks."""
        rows = seen.filter(F.col("kind") == kind).select("h", F.array_intersect("found", mine).alias("found")).toArrow().sort_by("h")
        found = rows.column("found").combine_chunks() if rows.num_rows else pa.array([], pa.list_(pa.int32()))
        return Sets(found.offsets.to_numpy().astype(np.int64) - found.offsets[0].as_py() if len(found) else np.zeros(1, np.int64), renamed[found.flatten().to_numpy()])

    own, others = sample("p"), sample("u")
    texts = {i: f for f, i in names.items()}
    prior = min(max(rate, 0.001), 0.999)
    weights, bias = fit(own, others, prior, len(best)) if len(others) else (np.zeros(len(best)), float(np.log(prior / (1 - prior))))
    return Model({texts[i]: k for i, k in number.items()}, weights, bias)


def score_documents(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    own = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id")) == 0).alias("held_out"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Finder(model.known) if model else None
        for b in small(batches, 200):
            scores = [model.score(find(t)) if model else 0.0 for t in b.column(2).to_pylist()]
            cols = [b.column(0), b.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "held_out", "score", "predicted"])

    return own.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
