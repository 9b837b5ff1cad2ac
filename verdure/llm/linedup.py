"""Line dedup: a suffix array over line ids by distributed prefix doubling.

A text's lines (cut at newlines, ASCII white space around them left out; blank lines are not counted) are numbered in it, and a line's id is the 64-bit hash of its text.
A suffix starts at a line and ends with its document. Level 0 ranks suffixes by their first line, level j by their first 2**j lines: rank j of a suffix is made from its
rank j-1 and the rank j-1 of the suffix 2**(j-1) lines on. Ranks are in the order of line ids: the distinct pairs are ordered by range partitions, and a partition's ranks begin after
the count of those before it. Suffixes alone in their rank are done: their longest repeat is known to be shorter, and they leave; so only repeated lines are ever doubled.

Suffixes of one rank at level j are a longest-common-prefix interval of at least 2**j lines. To delete later copies of runs of ``lines`` lines or more, ranks are doubled up to that depth:
a longer repeat is a chain of such intervals, each one line further on in both copies, so the common prefix of a suffix and its first copy is as long as the chain goes on, and the chains that
go on at neither end are the maximal repeated runs (``later_copies``). That needs no level for each doubling of the longest repeat. ``earlier_runs`` and ``maximal_runs`` double to the longest
repeat, for reports on repeats as such, in which runs may be shorter than ``lines`` or differ in which copy they name.

A run of ``lines`` lines or more that occurs earlier (in a smaller doc_id, or further up in the same document) is a later copy: its lines are deleted, the first copy stays. Of a pattern that
repeats inside one document, with a period shorter than ``lines``, the first whole periods that hold ``lines`` lines stay. With ``alone``, later copies of a single line of that many words or
more go as well, by the ranks of level 0; so passages that stand on one line between different neighbours are caught, and short lines of clean documents stay.

Ranks that many suffixes share are joined by broadcast (``join_groups``), so a line of a third of all documents fills no task.

Cases: a null or blank text has no lines and stays as it is; rows of one doc_id and text are one document and get one result; a null doc_id counts as smaller than any
other; a document that loses all its lines is a copy as a whole and is not returned; an empty table gives an empty result; all columns of the input are kept, whatever their names. A
very long text is a list of line hashes in its task, and its repeats are doubled as often as the longest of them needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import join_groups, long_id, numbered_columns, only, scratch, small, stored

NULL_ID = -(1 << 63)


def lines_of(text: str | None) -> list[tuple[int, str]]:
    """(place among the text's pieces, stripped text) of the lines that count."""
    return [(i, s) for i, x in enumerate((text or "").split("\n")) if (s := x.strip(" \t\r\x0b\x0c"))]


def line_rows(docs: DataFrame) -> DataFrame:
    """(d, h, pos, id, words): the numbered lines of each document; d is doc_id, h a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            d, h, pos, ids, words = [], [], [], [], []
            for doc, key, text in zip(*(c.to_pylist() for c in b.columns)):
                lines = [s.encode() for _, s in lines_of(text)]
                own = [xxhash.xxh64_intdigest(s) - (1 << 63) for s in lines]
                d += [doc] * len(own)
                h += [key] * len(own)
                pos += range(len(own))
                ids += own
                words += [len(s.split()) for s in lines]
            cols = [pa.array(d, pa.int64()), pa.array(h, pa.int64()), pa.array(pos, pa.int32()), pa.array(ids, pa.int64()), pa.array(words, pa.int32())]
            yield pa.RecordBatch.from_arrays(cols, names=["d", "h", "pos", "id", "words"])

    keyed = only(docs, "doc_id", "text").select(F.coalesce(long_id("doc_id"), F.lit(NULL_ID)).alias("d"), F.xxhash64("text").alias("h"), F.col("text").cast("string").alias("text"))
    return keyed.mapInArrow(run, "d long, h long, pos int, id long, words int")


AT = ["d", "h", "pos"]


def ranked(pairs: DataFrame) -> DataFrame:
    """The ranks of ``ranks_and_total`` alone."""
    return ranks_and_total(pairs)[0]


def ranks_and_total(pairs: DataFrame) -> tuple[DataFrame, int]:
    """(a, b, n, first, rank) and the sum of n: distinct pairs that two or more suffixes share, ranked by (a, b) from 1, whatever their number. With the suffixes' places (d, h, pos), ``first`` is the least."""
    first = F.min(F.struct(*AT)) if "pos" in pairs.columns else F.lit(None).cast("struct<d:long,h:long,pos:int>")
    groups = pairs.groupBy("a", "b").agg(F.count("*").alias("n"), first.alias("first")).filter("n > 1")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, part, np.int32)), pa.array(np.arange(n + 1, n + 1 + b.num_rows, dtype=np.int64))], names=[*b.schema.names, "part", "at"])
            n += b.num_rows

    ordered = groups.repartitionByRange("a", "b").sortWithinPartitions("a", "b")
    placed = stored(ordered.mapInArrow(number, "a long, b long, n long, first struct<d:long,h:long,pos:int>, part int, at long"), "ranks")
    base, ranks, total = [], 0, 0
    for r in sorted(placed.groupBy("part").agg(F.max("at").alias("at"), F.sum("n").alias("n")).collect()):  # a row for each partition
        base.append((r["part"], ranks))
        ranks, total = ranks + r["at"], total + r["n"]
    base = placed.sparkSession.createDataFrame(base, "part int, base long")
    return placed.join(F.broadcast(base), "part").select("a", "b", "n", "first", (F.col("base") + F.col("at")).alias("rank")), total


def numbered(docs: DataFrame) -> DataFrame:
    """The stored line rows; repeated rows are one document."""
    return stored(line_rows(docs).distinct(), "lines")


def repeated_suffixes(docs: DataFrame, most_levels: int = 40, lines: DataFrame | None = None) -> list[DataFrame]:
    """For j = 0, 1, ...: (d, h, pos, rank, first) of the suffixes that share their first 2**j lines with another one, and the first suffix that does; the last level is where none is left."""
    lines = numbered(docs) if lines is None else lines
    pairs, levels = lines.select(*AT, F.col("id").alias("a"), F.lit(0).cast("long").alias("b")), []
    while True:
        ranks, total = ranks_and_total(pairs)
        levels.append(stored(join_groups(pairs, ranks, ["a", "b"], total=total).select(*AT, "rank", "first"), f"level-{len(levels)}"))
        if not total or len(levels) == most_levels:
            return levels
        last, step = levels[-1], 1 << (len(levels) - 1)
        ahead = last.select("d", "h", (F.col("pos") - step).alias("pos"), F.col("rank").alias("b"))
        both = last.select(*AT, F.col("rank").alias("a")).join(ahead, AT)  # what has no rank 2**(j-1) lines on has no repeat of 2**j lines
        pairs = stored(both.select(*AT, "a", "b"), f"pairs-{len(levels)}")


def earlier_runs(docs: DataFrame, least: int = 1, levels: list[DataFrame] | None = None) -> DataFrame:
    """(d, h, pos, to_d, to_h, to_pos, lines): for each suffix that repeats an earlier one in ``least`` lines or more, the first suffix of its deepest interval and their longest common prefix.

    The interval says that it has 2**j lines at least and fewer than twice as many; walking the levels below j down, pair by pair, finds the rest.
    """
    levels = repeated_suffixes(docs) if levels is None else levels
    found = None
    for j, level in enumerate(levels):
        if 2 << j > least or level is levels[-1]:
            rows = level.filter(~F.struct(*AT).eqNullSafe(F.col("first"))).select(*AT, F.lit(j).alias("j"), "first")
            found = rows if found is None else found.unionByName(rows)
    deep = found.groupBy(*AT).agg(F.max_by(F.struct("j", "first"), "j").alias("x"))
    out = deep.select(*AT, F.col("x.first.d").alias("to_d"), F.col("x.first.h").alias("to_h"), F.col("x.first.pos").alias("to_pos"), F.col("x.j").alias("j"), F.expr("shiftleft(1, x.j)").alias("lines"))
    out = stored(out, "deep")
    for i in range(len(levels) - 2, -1, -1):
        # of the intervals above level i the lines that follow, on both sides; one first copy can have many later ones, so its rank is looked up once
        ahead = out.filter(F.col("j") > i).withColumn("q", F.col("to_pos") + F.col("lines"))
        if i == len(levels) - 2 and ahead.isEmpty():  # below, the rows of the deepest interval are there
            continue
        own = levels[i].select("d", "h", F.col("pos").alias("p"), F.col("rank").alias("r"))
        here = ahead.withColumn("p", F.col("pos") + F.col("lines")).join(own, ["d", "h", "p"], "left").drop("p")
        here = stored(here, "ahead")
        target = ["to_d", "to_h", "q"]
        other = levels[i].select(F.col("d").alias("to_d"), F.col("h").alias("to_h"), F.col("pos").alias("q"), F.col("rank").alias("s"))
        there = here.groupBy(*target).agg(F.count("*").alias("n")).join(other, target, "left")
        more = F.when(F.col("r") == F.col("s"), F.col("lines") + (1 << i)).otherwise(F.col("lines"))
        walked = join_groups(here, there, target).withColumn("lines", more).select(out.columns)
        out = stored(walked.unionByName(out.filter(F.col("j") <= i)), "walked")
    return out.filter(F.col("lines") >= least).drop("j")


def maximal_runs(docs: DataFrame, lines: int = 2, levels: list[DataFrame] | None = None) -> DataFrame:
    """The runs of ``earlier_runs`` of at least ``lines`` lines that the run from the line before, to the line before, doesn't hold."""
    runs = earlier_runs(docs, lines, levels)
    before = runs.select("d", "h", (F.col("pos") + 1).alias("pos"), "to_d", "to_h", (F.col("to_pos") + 1).alias("to_pos"))
    return runs.join(before, [*AT, "to_d", "to_h", "to_pos"], "left_anti")


def sequences(docs: DataFrame) -> DataFrame:
    """(d, h, s, ids, words): a row for each document with its line ids, s their hash, and the words of each line; repeated rows are one document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            ids, words, whole = [], [], []
            for text in b.column(2).to_pylist():
                lines = [s.encode() for _, s in lines_of(text)]
                own = np.array([xxhash.xxh64_intdigest(s) for s in lines], np.uint64).view(np.int64)
                ids.append(own)
                words.append([len(s.split()) for s in lines])
                whole.append(xxhash.xxh64_intdigest(own.tobytes()) - (1 << 63))
            cols = [b.column(0), b.column(1), pa.array(whole, pa.int64()), pa.array(ids, pa.list_(pa.int64())), pa.array(words, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(cols, names=["d", "h", "s", "ids", "words"])

    keyed = only(docs, "doc_id", "text").select(F.coalesce(long_id("doc_id"), F.lit(NULL_ID)).alias("d"), F.xxhash64("text").alias("h"), F.col("text").cast("string").alias("text"))
    return keyed.mapInArrow(run, "d long, h long, s long, ids array<long>, words array<int>").filter(F.size("ids") > 0)


def _level(pairs: DataFrame, name: str) -> DataFrame:
    """(d, h, pos, rank, first, words) of the suffixes of (d, h, pos, a, b, words) that share (a, b) with another one; ranks are in the order of (a, b)."""
    groups = pairs.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(F.struct(*AT)).alias("first")).filter("n > 1")
    ordered = groups.repartitionByRange("a", "b").sortWithinPartitions("a", "b").withColumn("rank", F.monotonically_increasing_id())
    return stored(join_groups(pairs, stored(ordered, f"{name}-ranks"), ["a", "b"]).select(*AT, "rank", "first", "words"), name)


def later_copies(docs: DataFrame, lines: int = 2, alone: int | None = None) -> DataFrame:
    """(d, h, pos, n): the lines that are later copies, n from pos on.

    Ranks are doubled up to runs of ``lines`` lines, the last step overlapping where that is no power of two. A longer repeat is a chain of such intervals, one suffix further in both copies at
    each step, so its length is how long the chain is; chains that can't be lengthened are the maximal runs, each a row here. Documents whose lines are all those of a smaller one are
    deleted as a whole before that.
    """
    with scratch(docs.sparkSession):
        rows = stored(sequences(docs), "sequences")
        same = rows.groupBy("s").agg(F.min(F.struct("d", "h")).alias("least"), F.countDistinct("d", "h").alias("n")).filter("n > 1")
        copies = join_groups(rows.select("d", "h", "s", F.size("ids").alias("lines"), "words"), same, ["s"]).filter(F.struct("d", "h") != F.col("least"))
        copies = stored(copies.select("d", "h", "lines", "words"), "copies")
        single = F.posexplode(F.transform("words", lambda w: w >= (alone or 0))).alias("pos", "long")
        spans = copies.filter(F.col("lines") >= lines).select("d", "h", F.lit(0).alias("pos"), F.col("lines").alias("n"))
        if alone is not None:
            short = copies.filter(F.col("lines") < lines).select("d", "h", single).filter("long")
            spans = spans.unionByName(short.select(*AT, F.lit(1).alias("n")))
        firsts = rows.join(copies.select("d", "h"), ["d", "h"], "left_anti").dropDuplicates(["d", "h"])
        each = firsts.select("d", "h", F.posexplode(F.arrays_zip("ids", "words")).alias("pos", "x")).select(*AT, F.col("x.ids").alias("a"), F.lit(0).cast("long").alias("b"), "x.words")
        level, width = _level(stored(each, "lines"), "level-0"), 1
        later = ~F.struct(*AT).eqNullSafe(F.col("first"))
        if alone is not None and lines > 1:
            spans = spans.unionByName(level.filter(later & (F.col("words") >= alone)).select(*AT, F.lit(1).alias("n")))
        while width < lines:
            step = min(width, lines - width)
            ahead = F.max("rank").over(Window.partitionBy("d", "h").orderBy("pos").rangeBetween(step, step))
            pairs = level.select(*AT, F.col("rank").alias("a"), ahead.alias("b"), "words").filter("b IS NOT NULL")
            width += step
            level = _level(stored(pairs, f"pairs-{width}"), f"level-{width}")
        other = ~((F.col("d") == F.col("first.d")) & (F.col("h") == F.col("first.h")))
        cut_ = level.filter(later & (other | (F.col("pos") >= F.col("first.pos") + lines)))
        # one suffix further in both copies at each step: the same chain
        order = Window.partitionBy("d", "h").orderBy("pos")
        chain = cut_.select(*AT, F.col("first.d").alias("fd"), F.col("first.h").alias("fh"), F.col("first.pos").alias("fp"))
        last = F.lag(F.struct("pos", "fd", "fh", "fp")).over(order)
        goes_on = last.eqNullSafe(F.struct((F.col("pos") - 1).alias("pos"), "fd", "fh", (F.col("fp") - 1).alias("fp")))
        runs = chain.withColumn("new", F.when(goes_on, 0).otherwise(1)).withColumn("run", F.sum("new").over(order))
        runs = runs.groupBy("d", "h", "run").agg(F.min("pos").alias("pos"), (F.count("*") + lines - 1).cast("int").alias("n")).select(*AT, "n")
        return stored(spans.unionByName(runs), "later-copies", keep=True)


def dedup_lines(docs: DataFrame, lines: int = 2, alone: int | None = None) -> DataFrame:
    """The documents without later copies of repeated line runs; all columns are kept."""
    found = later_copies(docs, lines, alone)
    cuts = found.groupBy("d", "h").agg(F.sort_array(F.collect_list(F.struct("pos", "n"))).alias("cuts"))
    at, plain = docs.columns.index("text"), numbered_columns(docs)
    # cuts grow with the documents, so texts are shuffled at every size
    d, text = F.coalesce(F.col(f"c{docs.columns.index('doc_id')}").cast("long"), F.lit(NULL_ID)), F.col(f"c{at}")
    joined = plain.join(cuts.hint("shuffle_hash"), (d == F.col("d")) & (F.xxhash64(text) == F.col("h")), "left").select(*plain.columns, "cuts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            texts, keep = [], []
            for text, cuts in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist()):
                text = cut(text, [(c["pos"], c["n"]) for c in cuts]) if cuts else text
                keep.append(not cuts or text is not None)
                texts.append(text)
            cols = [pa.array(texts, b.schema.field(k).type) if k == at else c for k, c in enumerate(b.columns[:-1])]
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names[:-1]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(run, plain.schema).toDF(*docs.columns)


def cut(text: str, runs: list[tuple[int, int]]) -> str | None:
    """The text without the lines that runs (start, lines) cover; None if no line is left."""
    own, pieces = lines_of(text), text.split("\n")
    gone = {own[p][0] for s, n in runs for p in range(s, min(len(own), s + n))}
    if len(gone) == len(own):
        return None
    return "\n".join(x for i, x in enumerate(pieces) if i not in gone)


def brute(rows: list[tuple[int | None, str | None]], lines: int, alone: int | None = None) -> dict:
    """(doc_id, text) to the cut text, for tests."""
    keyed = sorted({(NULL_ID if d is None else d, t) for d, t in rows if t}, key=lambda r: (r[0], _h(r[1])))
    first: dict[tuple, tuple] = {}
    out = {}

    def runs(own: list[str]) -> Iterator[tuple[int, int]]:
        yield from ((i, lines) for i in range(len(own) - lines + 1))
        if alone is not None and lines > 1:
            yield from ((i, 1) for i, s in enumerate(own) if len(s.encode().split()) >= alone)

    for d, t in keyed:
        own = [s for _, s in lines_of(t)]
        for i, n in runs(own):
            first.setdefault(tuple(own[i : i + n]), (d, t, i))
    for d, t in keyed:
        own = [s for _, s in lines_of(t)]
        cuts = [(i, n) for i, n in runs(own) for f in [first[tuple(own[i : i + n])]] if f[:2] != (d, t) or i >= f[2] + n]
        out[d, t] = cut(t, cuts) if cuts else t
    return out


def _h(text: str) -> int:
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h
