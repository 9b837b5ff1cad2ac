"""Merkle dataset manifest: hashes of rows, roots of each language and of the table, and every row's proof, by fractal traversal of aligned blocks.

A leaf is the hash of a row's fields. Leaves of a language are ordered by (doc_id, leaf) and every two consecutive nodes become their hash (a lone last one its own) until one is left; these
subroots, ordered by language, likewise give the root.

Leaves are dealt by ranges and get their places from the counts of the ranges before, so a language of any size is spread. Blocks of ``2**BLOCK_HEIGHT`` consecutive leaves are whole subtrees.
Going up, each block gives its root, roots are the nodes of the next round, in blocks again, until every tree has one node. Going down, each block gets the upper proof of its root and is
traversed: a stack of subtrees of height ``STEP``, the existing ones that hold the siblings of the present leaf, the desired ones that are built meanwhile for the leaves to come, two hashes
each a leaf. So a task's memory is one block and some subtrees, and proofs come out in order, with the upper proof appended. The languages' subroots are a tree that goes the same way.

A proof is a list of steps from the leaf to the root: ``L`` or ``R`` and the sibling that stands there, or nothing where the node is alone and is hashed by itself.

Cases: null fields have their own mark, so a null and an empty text differ; a null doc_id comes first; a null language is a tree before all others; repeated rows are leaves beside each other;
an empty table gives an empty result; a very long text is hashed where it is read and never shuffled; other columns aren't part of a leaf, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import only, small, stored

#: Height of a block, and of the subtrees that its traversal keeps.
BLOCK_HEIGHT, STEP = 10, 2


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def combine(left: str | None, right: str | None) -> str | None:
    """The node above two nodes; None where there is none."""
    return None if left is None else digest(left) if right is None else digest(left, right)


def height_of(nodes: int) -> int:
    """Levels above ``nodes`` nodes until one is left."""
    return max(0, nodes - 1).bit_length()


def block_root(nodes: list[str], height: int) -> str:
    """The node ``height`` levels above a block's nodes."""
    for _ in range(height):
        nodes = [combine(*(nodes[i : i + 2] + [None])[:2]) for i in range(0, len(nodes), 2)]
    return nodes[0]


def _grow(leaves: list[str], start: int, bottom: int, top: int, kept: dict[tuple[int, int], str | None]) -> Iterator[None]:
    """Builds the subtree of height ``top`` over the leaves from ``start`` on, a node for each step, and keeps its nodes from ``bottom`` up to below its root. The stack has one node a level at most."""
    stack: list[tuple[int, str | None]] = []
    for i in range(start, start + (1 << top)):
        node, height = leaves[i] if i < len(leaves) else None, 0
        while True:
            if height >= bottom:
                kept[height, i >> height] = node
            yield
            if not stack or stack[-1][0] != height or height + 1 == top:
                break
            node, height = combine(stack.pop()[1], node), height + 1
        stack.append((height, node))


def traverse(leaves: list[str], height: int, step: int = STEP) -> Iterator[list[str]]:
    """The proof of each leaf up to ``height`` levels above, in order."""
    bottoms = list(range(0, height, step))
    tops = [min(height, b + step) for b in bottoms]
    existing: list[dict] = []
    for b, t in zip(bottoms, tops):
        kept: dict[tuple[int, int], str | None] = {}
        for _ in _grow(leaves, 0, b, t, kept):
            pass
        existing.append(kept)

    def desire(level: int, start: int) -> tuple[dict, Iterator[None]]:
        kept: dict[tuple[int, int], str | None] = {}
        return kept, _grow(leaves, start, bottoms[level], tops[level], kept)

    desired = [desire(j, 1 << t) if 1 << t < len(leaves) else None for j, t in enumerate(tops)]
    for i in range(len(leaves)):
        path = []
        for kept, b, t in zip(existing, bottoms, tops):
            for h in range(b, t):
                at = i >> h
                node = kept[h, at ^ 1]
                path.append("" if node is None else ("L" if at & 1 else "R") + node)
        yield path
        for j, t in enumerate(tops):
            if not desired[j]:
                continue
            kept, growing = desired[j]
            for _ in range(2):
                next(growing, None)
            if (i + 1) % (1 << t) == 0:  # the next leaf is in the desired subtree, which is complete
                existing[j] = kept
                ahead = i + 1 + (1 << t)
                desired[j] = desire(j, ahead) if ahead < len(leaves) else None


def fold(leaf: str, path: list[str]) -> str:
    """The root that a leaf and its proof lead to."""
    for x in path:
        leaf = digest(x[1:], leaf) if x[:1] == "L" else digest(leaf, x[1:])
    return leaf


def leaf_of(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """The hash of a row: of each field ``-`` if null, else its length in bytes, a colon and its value."""
    field = lambda c: F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
    return F.sha2(F.concat(*(field(c) for c in (doc_id, source, lang, n_chars, text))), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, tree, leaf, again): each row's leaf, its language's tree (languages after a plus sign, so that null, the empty name, comes first), and null as the leaf found later."""
    own = only(docs, "doc_id", "source", "lang", "n_chars", "text")
    return own.select("doc_id", tree_of(F.col("lang")).alias("tree"), leaf_of(*(F.col(c) for c in own.columns)).alias("leaf"), F.lit(None).cast("string").alias("again"))


def tree_of(lang: Column) -> Column:
    return F.coalesce(F.concat(F.lit("+"), lang.cast("string")), F.lit(""))


def placed(nodes: DataFrame, order: list[str], height: int) -> DataFrame:
    """``nodes`` with (block, place, size): their place in their tree by ``order``, cut into blocks of this height, and the tree's number of nodes."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, n = TaskContext.get().partitionId(), None, 0
        for b in batches:
            own = []
            for t in b.column(b.schema.get_field_index("tree")).to_pylist():
                last, n = t, n + 1 if t == last else 0
                own.append(n)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, part, np.int32)), pa.array(own, pa.int64())], names=[*b.schema.names, "part", "at"])

    sorted_ = nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    fields = ", ".join(f"{n} {t}" for n, t in nodes.dtypes)
    found = stored(sorted_.mapInArrow(number, f"{fields}, part int, at long"), "numbered")
    counts = found.groupBy("tree", "part").agg(F.count("*").alias("n"))  # a row for each tree and partition
    before, tree = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("tree")
    offsets = counts.select("tree", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.sum("n").over(tree).alias("size"))
    place = F.col("base") + F.col("at")
    return found.join(offsets, ["tree", "part"]).withColumn("place", place).withColumn("block", F.shiftright(place, height)).drop("part", "at", "base")


def _arrow(b: pa.RecordBatch, name: str) -> list:
    return b.column(b.schema.get_field_index(name)).to_pylist()


def _roots(height: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 50):
            roots = [block_root([x["leaf"] for x in items], min(height, height_of(size))) for items, size in zip(_arrow(b, "items"), _arrow(b, "size"))]
            cols = [b.column(b.schema.get_field_index("tree")), b.column(b.schema.get_field_index("block")), pa.array(_arrow(b, "size"), pa.int64()), pa.array(roots, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["tree", "place", "size", "leaf"])

    return run


def _paths(height: int, carried: dict[str, pa.DataType], folded: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks with their root's proof to their nodes' proofs, with the ``carried`` fields of the nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 1):
            for tree, items, size, upper, subroot, root in zip(*(_arrow(b, c) for c in ("tree", "items", "size", "upper", "subroot", "root"))):
                paths = [p + upper for p in traverse([x["leaf"] for x in items], min(height, height_of(size)))]
                same = lambda v: pa.array([v] * len(items), pa.string())  # noqa: B023, E731
                cols = {"tree": same(tree), "place": pa.array([x["place"] for x in items], pa.int64()), "proof": pa.array(paths, pa.list_(pa.string())), "subroot": same(subroot), "root": same(root)}
                cols |= {n: pa.array([x[n] for x in items], t) for n, t in carried.items()}
                if folded:
                    cols["folded_root"] = pa.array([fold(x["again"] or x["leaf"], p) for x, p in zip(items, paths)], pa.string())
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return run


def _blocks(nodes: DataFrame, fields: list[str]) -> DataFrame:
    """A block's nodes, in order, as one row; 2**height at most."""
    items = F.sort_array(F.collect_list(F.struct("place", *fields))).alias("items")
    return stored(nodes.groupBy("tree", "block").agg(F.first("size").alias("size"), items), "blocks")


def _climb(nodes: DataFrame, fields: list[str], height: int) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of each round, and (tree, leaf): each tree's root."""
    rounds = [_blocks(nodes, fields)]
    while True:
        up = rounds[-1].mapInArrow(_roots(height), "tree string, place long, size long, leaf string")
        shrunk = F.ceil(F.col("size") / (1 << height)).cast("long")
        up = stored(up.withColumn("size", shrunk).withColumn("block", F.shiftright("place", height)), "roots")
        if up.filter("size > 1").isEmpty():
            return rounds, up.select("tree", "leaf")
        rounds.append(_blocks(up, ["leaf"]))


_PROOF = "tree string, place long, proof array<string>, subroot string, root string"


def _descend(rounds: list[DataFrame], tops: DataFrame, height: int, carried: dict[str, pa.DataType], more: str, folded: bool = False) -> DataFrame:
    """The proofs of the first round's nodes, with the ``carried`` fields, in DDL ``more``; ``tops``: (tree, proof, subroot, root) of the trees' roots. What a root says goes down by blocks."""
    upper = tops.select("tree", F.lit(0).cast("long").alias("block"), F.col("proof").alias("upper"), "subroot", "root")
    for r in range(len(rounds) - 1, 0, -1):
        own = rounds[r].join(upper, ["tree", "block"]).mapInArrow(_paths(height, {}, False), _PROOF)
        upper = own.select("tree", F.col("place").alias("block"), F.col("proof").alias("upper"), "subroot", "root")
    return rounds[0].join(upper, ["tree", "block"]).mapInArrow(_paths(height, carried, folded), f"{_PROOF}, {more}")


def manifest(rows: DataFrame, height: int = BLOCK_HEIGHT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, folded_root) of rows like those of ``leaves``; ``folded_root`` is the root that ``again``, or the leaf where it is null, and the proof lead to."""
    rows = stored(rows.select(F.col("doc_id").cast("long").alias("doc_id"), "tree", "leaf", "again"), "leaves")
    rounds, subroots = _climb(placed(rows, ["doc_id", "leaf"], height), ["doc_id", "leaf", "again"], height)
    # the subroots are the nodes of one tree more
    tops, root = _climb(placed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "leaf"), ["name"], height), ["name", "leaf"], height)
    top = root.first()
    none, hashed = F.array().cast("array<string>"), F.lit(top["leaf"] if top else None).cast("string")
    above = root.select("tree", none.alias("proof"), hashed.alias("subroot"), hashed.alias("root"))
    above = _descend(tops, above, height, {"name": pa.string(), "leaf": pa.string()}, "name string, leaf string")
    above = stored(above.select(F.col("name").alias("tree"), "proof", F.col("leaf").alias("subroot"), "root"), "above")
    proofs = _descend(rounds, above, height, {"doc_id": pa.int64(), "leaf": pa.string()}, "doc_id long, leaf string, folded_root string", True)
    return proofs.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root")


def tampered(docs: DataFrame) -> DataFrame:
    """``leaves`` with ``again``: the leaf with n_chars one higher where 7 divides the crc32 of doc_id."""
    own = only(docs, "doc_id", "source", "lang", "n_chars", "text")
    hit = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 == 0
    cols = [F.col(c) for c in own.columns]
    again = leaf_of(*cols[:3], cols[3] + 1, cols[4])
    return own.select("doc_id", tree_of(F.col("lang")).alias("tree"), leaf_of(*cols).alias("leaf"), F.when(hit & cols[3].isNotNull(), again).alias("again"))


def proof_digest(rows: DataFrame) -> DataFrame:
    """The manifest with the hash of each proof's siblings instead of the proof, and whether the folded root is the root."""
    siblings = F.array_join(F.transform("proof", lambda x: F.substring(x, 2, 64)), "")
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def brute(rows: list[tuple], tampered: Callable[[tuple], tuple] | None = None) -> list[dict]:
    """(doc_id, source, lang, n_chars, text) rows to what ``proof_digest`` gives, level by level over whole lists, for tests."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: digest(*map(field, r))
    trees: dict = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r, leaf(r)))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))

    def levels(nodes: list[str]) -> list[list[str]]:
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([digest(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
        return out

    def siblings(out: list[list[str]], i: int) -> list[str]:
        path = []
        for level in out[:-1]:
            j = i ^ 1
            path.append(("L" if i & 1 else "R") + level[j] if j < len(level) else "")
            i >>= 1
        return path

    own = {}
    for n in names:
        trees[n].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        own[n] = levels([x[1] for x in trees[n]])
    top = levels([own[n][-1][0] for n in names])
    out = []
    for k, n in enumerate(names):
        for i, (r, h) in enumerate(trees[n]):
            path = siblings(own[n], i) + siblings(top, k)
            root, folded = top[-1][0], fold(leaf(tampered(r)) if tampered else h, path)
            out.append({"doc_id": r[0], "leaf": h, "subroot": own[n][-1][0], "root": root, "proof_sha256": digest(*(x[1:] for x in path)), "folded_root": folded, "verified": folded == root})
    return out
