"""Quality rules with n-gram perplexity bands.

The model is one modified Kneser-Ney model for each language, over the UTF-16 units of a text's words in lower case, joined by one space, with ``order`` units to a gram (4: a
gram is one 64-bit number). Spark counts the grams of all whole documents and derives continuation counts, discounts and interpolated probabilities order by order, with joins.

There is one way at every size. Documents are written once in blocks of one language and about ``block_units`` units, with each block's distinct grams and their counts; the counts of all blocks are the
model's. Each block then asks the model for the grams that it has: a join on (language, gram), for which both sides are dealt by hash and sorted, so a task holds a range of the model at
most. What a block gets back is its sorted hash array: keys are 64-bit hashes (a bijection of grams), sorted, and the hash's top bits say where to look. A task holds one block and its
array, never the model. All numbers are doubles, and logarithms of perplexities are rounded to nine places.

A document's perplexity is judged against its language's bands, ``width`` quartile ranges below the lower and above the upper quartile of the logarithm over all documents of the
language that pass the base rules. Quartiles are made of all documents, by counts, so a verdict doesn't depend on partitions. Three ranges are the usual fence for far-out values. A short text's mean varies more, so its bands are wider, by sqrt(1 + short / units). Base rules: a document fails with fewer than ten words, or if over a fifth of its words are in five-word windows found twice or more in it.

Cases: a null text has no words and fails; a null language is a language of its own; rows of one doc_id are each judged on their own; an empty table gives an empty result; other
columns are ignored, or kept by ``filter_documents``, whatever their names. A very long text is a block of its own.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bucketed, long_id, numbered_columns, only, small, stored
from .words import mix, run_hashes, word_bounds, word_hashes

BOS, EOS, ORDER = 2, 3, 4
SYMBOLS = "#*$%&|<>"
BLANK = " \t\n\x0b\x0c\r"
SLICE = 500_000
STEPS = 4096
BLOCK_UNITS = 4_000_000


def lang_key(lang: Column) -> Column:
    """A language as a text that is never null, so that null is joined on as a language of its own."""
    return F.coalesce(F.concat(F.lit("="), lang), F.lit(""))


def units(text: str | None) -> np.ndarray:
    """The units that the model sees: three openings, the words in lower case, one end."""
    norm = b" ".join((text or "").encode().split()).decode().lower()
    own = np.frombuffer(norm.encode("utf-16-le"), "<u2")
    return np.concatenate([np.full(ORDER - 1, BOS, np.uint16), own, np.full(1, EOS, np.uint16)])


def grams(u: np.ndarray) -> np.ndarray:
    """The packed gram that ends at each unit after the openings."""
    w, n = u.astype(np.uint64), len(u) - ORDER + 1
    return w[:n] << np.uint64(48) | w[1 : n + 1] << np.uint64(32) | w[2 : n + 2] << np.uint64(16) | w[3 : n + 3]


def _slices(texts: list[str | None], langs: list[str | None]) -> Iterator[tuple[str | None, list[int], np.ndarray, np.ndarray]]:
    """Documents of one language together, some at a time: language, their places, all their grams, where each one's begin."""
    for lang in dict.fromkeys(langs):
        at, held, size = [], [], 0
        for i in (i for i, x in enumerate(langs) if x == lang):
            at.append(i)
            held.append(grams(units(texts[i])))
            size += len(held[-1])
            if size > SLICE:
                yield lang, at, np.concatenate(held), np.cumsum([0] + [len(x) for x in held])[:-1]
                at, held, size = [], [], 0
        if at:
            yield lang, at, np.concatenate(held), np.cumsum([0] + [len(x) for x in held])[:-1]


BLOCK = "block long, lang string, payload binary, g array<long>, c array<long>"


def blocks_of(rows: DataFrame, block_units: int) -> DataFrame:
    """(block, lang, payload, g, c) of rows that end with lang and text: some documents of one language together as compressed Arrow data, and their distinct grams with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        held: dict[str | None, list] = {}
        sizes: Counter[str | None] = Counter()

        def block(lang) -> pa.RecordBatch:
            nonlocal n
            own = held.pop(lang)
            del sizes[lang]
            parts = [np.unique(g, return_counts=True) for b in own for _, _, g, _ in _slices(b.column(b.num_columns - 1).to_pylist(), [lang] * b.num_rows)]
            keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            counts = np.bincount(at, weights=np.concatenate([c for _, c in parts])).astype(np.int64)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, own[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                for b in own:
                    out.write_batch(b)
            n += 1
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x)) for x in (keys.view(np.int64), counts)]
            cols = [pa.array([part << 32 | n - 1], pa.int64()), pa.array([lang], pa.string()), pa.array([sink.getvalue().to_pybytes()], pa.binary()), *lists]
            return pa.RecordBatch.from_arrays(cols, names=["block", "lang", "payload", "g", "c"])

        for b in small(batches):
            langs = np.array(b.column(b.num_columns - 2).to_pylist(), object)
            for lang in dict.fromkeys(langs.tolist()):
                own = b.take(pa.array(np.flatnonzero([x == lang for x in langs])))
                at = 0
                for i, x in enumerate(own.column(own.num_columns - 1).to_pylist()):
                    sizes[lang] += len(x or "") + ORDER
                    if sizes[lang] >= block_units:
                        held.setdefault(lang, []).append(own.slice(at, i + 1 - at))
                        yield block(lang)
                        at = i + 1
                if at < own.num_rows:
                    held.setdefault(lang, []).append(own.slice(at))
            while sum(sizes.values()) > 2 * block_units:  # many languages at once: the fullest block goes
                yield block(max(sizes, key=sizes.get))
        for lang in list(held):
            yield block(lang)

    return rows.mapInArrow(run, BLOCK)


def _gram_counts(blocks: DataFrame) -> DataFrame:
    return blocks.select("lang", F.inline(F.arrays_zip("g", "c"))).groupBy("lang", "g").agg(F.sum("c").alias("c"))


def count_grams(docs: DataFrame, block_units: int = BLOCK_UNITS) -> DataFrame:
    """(lang, g, c): how often each gram of ORDER units occurs in all documents; blocks add up before the shuffle."""
    return _gram_counts(blocks_of(_texts(docs), block_units))


def _texts(docs: DataFrame) -> DataFrame:
    return only(docs, "lang", "text").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(lang, k, g, logp, loggamma): interpolated modified Kneser-Ney probabilities of every gram of 1 to ORDER units, and, on the row of a context (k - 1 units, ``g``), the
    logarithm of the weight that it leaves to shorter grams; rows of grams have a null loggamma, rows of contexts a null logp.

    Below the top order a gram's count is the number of different units found before it.
    """
    counts = counts.withColumn("lang", lang_key(F.col("lang")))
    tables = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        tables[k] = tables[k + 1].groupBy("lang", F.col("g").bitwiseAND(F.lit((1 << 16 * k) - 1)).alias("g")).agg(F.count("*").alias("c"))
    tables = {k: stored(t, f"counts-{k}") for k, t in tables.items()}
    vocab = tables[1].groupBy("lang").agg((F.lit(1.0) / F.count("*")).alias("lower"))
    out, lower = None, None
    for k in range(1, ORDER + 1):
        n = lambda i: F.count(F.when(F.col("c") == i, 1))
        d = tables[k].groupBy("lang").agg(*(n(i).alias(f"n{i}") for i in range(1, 5)))
        y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
        cut = lambda i: F.least(F.lit(float(i)), F.greatest(F.lit(0.05), F.coalesce(i - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}")), F.lit(i / 2))))
        d = d.select("lang", *(cut(i).alias(f"d{i}") for i in (1, 2, 3)))
        rows = tables[k].join(F.broadcast(d), "lang").withColumn("ctx", F.shiftrightunsigned("g", 16) if k > 1 else F.lit(0).cast("long"))
        discount = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        ctx = rows.groupBy("lang", "ctx").agg(F.sum("c").alias("total"), F.sum(discount).alias("left"))
        ctx = stored(ctx.select("lang", "ctx", "total", (F.col("left") / F.col("total")).alias("gamma")), f"contexts-{k}")
        rows = rows.withColumn("disc", discount).join(F.broadcast(ctx) if k == 1 else ctx, ["lang", "ctx"])  # the empty context: a row for each language
        if k == 1:
            rows = rows.join(F.broadcast(vocab), "lang")
        else:
            suffix = F.col("g").bitwiseAND(F.lit((1 << 16 * (k - 1)) - 1))
            rows = rows.withColumn("suffix", suffix).join(lower.select("lang", F.col("g").alias("suffix"), F.col("p").alias("lower")), ["lang", "suffix"])
        p = (F.col("c") - F.col("disc")) / F.col("total") + F.col("gamma") * F.col("lower")
        lower = stored(rows.select("lang", "g", p.alias("p")), f"probabilities-{k}")
        own = lower.select("lang", F.lit(k).alias("k"), "g", F.log("p").alias("logp"), F.lit(None).cast("double").alias("loggamma"))
        own = own.unionByName(ctx.select("lang", F.lit(k).alias("k"), F.col("ctx").alias("g"), F.lit(None).cast("double").alias("logp"), F.log("gamma").alias("loggamma")))
        out = own if out is None else out.unionByName(own)
    return out.withColumn("lang", F.when(F.col("lang") != "", F.expr("substring(lang, 2)")))


class HashArray:
    """Numbers by 64-bit key: keys hashed and sorted, with the places where each value of the hash's top bits begins."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        h = mix(keys.view(np.uint64))
        order = np.argsort(h)
        self.h, self.v = np.append(h[order], np.uint64(0)), np.append(values[order].astype(np.float64), np.nan)
        self.bits = max(1, int(len(h)).bit_length())
        top = np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)
        self.at = np.append(np.searchsorted(h[order], top), len(h)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, NaN where a key isn't there."""
        h = mix(keys)
        top = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        pos, end = self.at[top], self.at[top + 1]
        hit = (self.h[pos] == h) & (pos < end)
        out = np.where(hit, self.v[pos], np.nan)
        rest = np.flatnonzero(~hit & (pos + 1 < end))
        while len(rest):
            pos[rest] += 1
            hit = self.h[pos[rest]] == h[rest]
            out[rest[hit]] = self.v[pos[rest[hit]]]
            rest = rest[~hit & (pos[rest] + 1 < end[rest])]
        return out


class Model:
    """One language's arrays; ``logp`` backs off from longer to shorter grams where a gram isn't in the model."""

    def __init__(self, k: np.ndarray, g: np.ndarray, logp: np.ndarray, loggamma: np.ndarray):
        is_gram = ~np.isnan(logp)
        pick = lambda n, grams: (k == n) & (is_gram == grams)
        self.grams = {n: HashArray(g[pick(n, True)], logp[pick(n, True)]) for n in range(1, ORDER + 1)}
        self.contexts = {n: HashArray(g[pick(n, False)], loggamma[pick(n, False)]) for n in range(1, ORDER + 1)}
        self.unseen = -math.log(max(1, pick(1, True).sum()) + 1)

    def logp(self, g: np.ndarray) -> np.ndarray:
        out = self.grams[ORDER].get(g).astype(np.float64)
        rest, back = np.flatnonzero(np.isnan(out)), None
        back = np.zeros(len(rest))
        for n in range(ORDER - 1, -1, -1):
            if not len(rest):
                break
            full = g[rest] & np.uint64((1 << 16 * (n + 1)) - 1)
            gamma = self.contexts[n + 1].get(full >> np.uint64(16))
            back += np.where(np.isnan(gamma), 0.0, gamma)
            got = np.full(len(rest), self.unseen) if n == 0 else self.grams[n].get(g[rest] & np.uint64((1 << 16 * n) - 1)).astype(np.float64)
            hit = ~np.isnan(got)
            out[rest[hit]] = back[hit] + got[hit]
            rest, back = rest[~hit], back[~hit]
        return out


def load(model: DataFrame) -> dict[str | None, Model]:
    """The arrays of each language, on the driver, for texts that aren't in the corpus; the caller has checked the size."""
    rows = model.withColumn("lang", lang_key(F.col("lang"))).toArrow()
    names = rows["lang"].combine_chunks().dictionary_encode()
    code = names.indices.to_numpy()
    cols = [rows[c].to_numpy() for c in ("k", "g", "logp", "loggamma")]
    own = lambda n: Model(*(c[code == n] for c in cols))
    return {x[1:] if x else None: own(n) for n, x in enumerate(names.dictionary.to_pylist())}


def base_numbers(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    raw = np.frombuffer(text.encode(), np.uint8)
    starts, ends = word_bounds(raw)
    n, repeated = len(starts), 0
    if n > 5:
        h = run_hashes(word_hashes(raw, starts, ends), 5)
        s = np.sort(h)
        twice = s[1:][s[1:] == s[:-1]]
        if len(twice):
            cover = np.zeros(n + 1, np.int64)
            at = np.flatnonzero(np.isin(h, twice))
            np.add.at(cover, at, 1)
            np.add.at(cover, at + 5, -1)
            repeated = int((np.cumsum(cover[:-1]) > 0).sum())
    lines = [x for x in text.split("\n") if x.strip(BLANK)]
    return n, len(text) - sum(map(text.count, BLANK)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated


NUMBERS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


SCORES = [*(f"verdure_{x}" for x in NUMBERS), "verdure_logppl"]


def _score(blocks: DataFrame, schema: str, columns: int) -> DataFrame:
    """Rows of (lang, payload, g, logp) as documents again, without their text, if it isn't one of the ``columns`` to keep, and with their base numbers and logppl."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for i in range(rows.num_rows):
                lang, payload, keys, logp = (rows.column(k)[i] for k in range(4))
                array = HashArray(keys.values.to_numpy(), logp.values.to_numpy())
                for b in pa.ipc.open_stream(payload.as_buffer()):
                    texts = b.column(b.num_columns - 1).to_pylist()
                    numbers = np.array([base_numbers(t) for t in texts], np.int64).reshape(-1, 5)
                    ppl = np.zeros(len(texts))
                    for _, at, g, begin in _slices(texts, [lang.as_py()] * len(texts)):
                        ppl[at] = -np.add.reduceat(array.get(g), begin) / np.diff(np.append(begin, len(g)))
                    cols = [*b.columns[:columns], *(pa.array(numbers[:, k]) for k in range(5)), pa.array(np.round(ppl, 9))]
                    yield pa.RecordBatch.from_arrays(cols, names=[*b.schema.names[:columns], *SCORES])

    return blocks.select("lang", "payload", "found.g", "found.logp").mapInArrow(run, schema)


def _scored(docs: DataFrame, keep: list[int], block_units: int) -> DataFrame:
    """The columns at the places ``keep`` as k0, k1, ..., then verdure_* columns: lang, the base numbers, logppl and base_failed, written and read again."""
    plain, at = numbered_columns(docs), docs.columns.index
    kept = plain.select(*(F.col(f"c{n}").alias(f"k{i}") for i, n in enumerate(keep)), F.col(f"c{at('lang')}").cast("string").alias("verdure_l"), F.col(f"c{at('text')}").cast("string").alias("verdure_text"))
    blocks = bucketed(blocks_of(kept, block_units), "blocks", "block")
    top = kneser_ney(stored(_gram_counts(blocks), "grams")).filter((F.col("k") == ORDER) & F.col("logp").isNotNull()).select(lang_key(F.col("lang")).alias("l"), "g", "logp")
    asked = blocks.select("block", lang_key(F.col("lang")).alias("l"), F.explode("g").alias("g"))
    found = asked.join(top, ["l", "g"]).groupBy("block").agg(F.struct(F.collect_list("g").alias("g"), F.collect_list("logp").alias("logp")).alias("found"))  # not more than a block's grams
    kinds = [f"`{n}` {k}" for n, k in kept.dtypes[:-1]]
    rows = _score(blocks.select("block", "lang", "payload").join(found.hint("shuffle_hash"), "block"), ", ".join([*kinds, *(f"{c} long" for c in SCORES[:-1]), f"{SCORES[-1]} double"]), len(kinds))
    failed = (F.col("verdure_n_words") < 10) | (100 * F.col("verdure_n_repeat_words") > 20 * F.col("verdure_n_words"))
    return stored(rows.withColumn("verdure_base_failed", failed), "scores")


def score_documents(docs: DataFrame, keep: list[str], block_units: int = BLOCK_UNITS) -> DataFrame:
    """The columns ``keep`` and the verdure_* columns."""
    rows = _scored(docs, [docs.columns.index(c) for c in keep], block_units)
    return rows.toDF(*keep, *rows.columns[len(keep) :])


def quartiles(rows: DataFrame) -> DataFrame:
    """(verdure_band, q1, q3): the lower and upper quartile of verdure_logppl in each language, to the nearest of ``STEPS`` steps in one: counts of steps are added up in order, so the result is the
    same however rows are dealt. A language has as many rows as the logarithms have steps, some hundred thousand at most, not as many as it has documents."""
    counts = rows.filter("verdure_logppl is not null").groupBy("verdure_band", F.round(F.col("verdure_logppl") * STEPS).cast("long").alias("step")).agg(F.count("*").alias("n"))
    own = Window.partitionBy("verdure_band")
    ranks = counts.withColumns({"upto": F.sum("n").over(own.orderBy("step")), "whole": F.sum("n").over(own)})
    at = lambda quarter: F.min(F.when(4 * F.col("upto") >= quarter * F.col("whole"), F.col("step"))) / STEPS
    return ranks.groupBy("verdure_band").agg(at(1).alias("q1"), at(3).alias("q3"))


def with_verdict(scored: DataFrame, width: float = 3.0, least: float = 0.01, short: float = 500.0) -> DataFrame:
    """verdure_low, verdure_high and verdure_kept. A quartile range under ``least`` counts as ``least``, so that few or equal documents don't make bands of no width."""
    lang = lang_key(F.col("verdure_l"))
    bands = quartiles(scored.filter(~F.col("verdure_base_failed")).select(lang.alias("verdure_band"), "verdure_logppl"))
    reach = F.lit(width) * F.greatest(F.col("q3") - F.col("q1"), F.lit(least))
    bands = bands.select("verdure_band", F.col("q1").alias("verdure_q1"), F.col("q3").alias("verdure_q3"), reach.alias("verdure_reach"))
    bands = stored(bands, "bands")  # a row for each language; with its size known, rows with texts aren't shuffled by language
    more = F.col("verdure_reach") * F.sqrt(1 + F.lit(short) / (F.col("verdure_word_chars") + F.col("verdure_n_words") + 1))
    rows = scored.join(bands, lang == bands["verdure_band"], "left").withColumns({"verdure_low": F.col("verdure_q1") - more, "verdure_high": F.col("verdure_q3") + more})
    kept = ~F.col("verdure_base_failed") & F.col("verdure_logppl").between(F.col("verdure_low"), F.col("verdure_high"))
    return rows.withColumn("verdure_kept", F.coalesce(kept, F.lit(False)))


def quality(docs: DataFrame, block_units: int = BLOCK_UNITS, **how) -> DataFrame:
    """doc_id, the base numbers, base_failed, kept, and the logarithm of the perplexity with its band."""
    rows = with_verdict(_scored(only(docs, "doc_id", "lang", "text").withColumn("doc_id", long_id("doc_id")), [0], block_units), **how)
    return rows.select(F.col("k0").alias("doc_id"), *(F.col(f"verdure_{c}").alias(c) for c in [*NUMBERS, "base_failed", "kept", "logppl", "low", "high"]))


def filter_documents(docs: DataFrame, block_units: int = BLOCK_UNITS, **how) -> DataFrame:
    """The documents that are kept, with all their columns."""
    rows = with_verdict(_scored(docs, list(range(len(docs.columns))), block_units), **how)
    return rows.filter("verdure_kept").select(*(f"k{n}" for n in range(len(docs.columns)))).toDF(*docs.columns)


def brute_numbers(text: str | None) -> tuple[int, int, int, int, int]:
    """The base numbers word for word, for tests."""
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    in_repeats = {p for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)), len(in_repeats)


def brute_logppl(rows: list[tuple[str | None, str | None]]) -> list[float]:
    """Modified Kneser-Ney by its formulas, gram by gram, for tests."""
    out = [0.0] * len(rows)
    for lang in {x for x, _ in rows}:
        own = {i: units(t).tolist() for i, (x, t) in enumerate(rows) if x == lang}
        count = {ORDER: Counter(tuple(u[j : j + ORDER]) for u in own.values() for j in range(len(u) - ORDER + 1))}
        for k in range(ORDER - 1, 0, -1):
            count[k] = Counter(g[1:] for g in count[k + 1])
        disc = {}
        for k, c in count.items():
            n = [sum(v == i for v in c.values()) for i in range(5)]
            y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else None
            disc[k] = [0] + [i / 2 if y is None or not n[i] else min(float(i), max(0.05, i - (i + 1) * y * n[i + 1] / n[i])) for i in (1, 2, 3)]
        ctx: dict[tuple, list] = {}
        for k, c in count.items():
            for g, v in c.items():
                own_ctx = ctx.setdefault((k, g[:-1]), [0, 0.0])
                own_ctx[0] += v
                own_ctx[1] += disc[k][min(v, 3)]

        def p(g: tuple) -> float:
            if not g:
                return 1 / len(count[1])
            v, (total, left) = count[len(g)][g], ctx[len(g), g[:-1]]
            return (v - disc[len(g)][min(v, 3)]) / total + left / total * p(g[1:])

        for i, u in own.items():
            gs = [tuple(u[j : j + ORDER]) for j in range(len(u) - ORDER + 1)]
            out[i] = -sum(math.log(p(g)) for g in gs) / len(gs)
    return out
