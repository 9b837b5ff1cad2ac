"""Token ids in bit-plane shuffled files.

Documents are dealt into shards by a range of doc_id and sorted inside each. A shard's ids are one stream, cut into
blocks of a fixed number of ids. Each block is transposed into planes, either four byte planes or 32 bit planes, and each
plane is a zstandard frame of its own. A block's row holds the frames, their sizes, and the pieces of documents it covers;
``index`` repeats all but the frames, so that a reader finds a block without touching payloads.

Layout under a path: ``chunks/`` (shard, chunk, first, n, plane_bytes, payload, piece_*) and ``index/`` (the same without payload).

Cases: a null text is empty and gets just the end id; a null doc_id sorts first; repeated rows stay apart, ordered by a hash
of their text; an empty table gives empty files; columns other than doc_id and text are ignored, whatever
their names; a very long text is encoded in its task and its ids are cut into blocks like others.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import long_id, only, small

CHUNKS = (
    "shard int, chunk long, first long, n int, planes string, plane_bytes array<int>, payload binary, "
    "piece_doc array<long>, piece_ord array<long>, piece_at array<int>, piece_n array<int>"
)


def shuffle_planes(ids: np.ndarray, planes: str = "byte", level: int = 1) -> tuple[list[int], bytes]:
    """Sizes of the compressed planes, and the planes one after another. Ids are unsigned 32-bit; plane 0 is the least significant."""
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        rows = [np.ascontiguousarray(raw[:, k]).tobytes() for k in range(4)]
    else:
        bits = np.unpackbits(raw, axis=1, bitorder="little")
        rows = [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]
    z = zstandard.ZstdCompressor(level=level)
    frames = [z.compress(r) for r in rows]
    return [len(f) for f in frames], b"".join(frames)


def unshuffle_planes(n: int, planes: str, plane_bytes: list[int], payload: bytes) -> np.ndarray:
    z, at, rows = zstandard.ZstdDecompressor(), 0, []
    for size in plane_bytes:
        rows.append(np.frombuffer(z.decompress(payload[at : at + size]), dtype=np.uint8))
        at += size
    if planes == "byte":
        return np.ascontiguousarray(np.stack(rows, axis=1)).view("<u4").reshape(-1)
    bits = np.stack([np.unpackbits(r, count=n, bitorder="little") for r in rows], axis=1)
    return np.packbits(bits, axis=1, bitorder="little").view("<u4").reshape(-1)


#: Lower case in Latin-1, and a comma or full stop that closes a word, after a letter.
_LOWER = bytes(ord(chr(i).lower()) for i in range(256))
_MARK = re.compile(rb"[.,](?<=[a-z\xdf-\xf6\xf8-\xff][.,])(?![^\x20\x09-\x0D])")


class WordEncoder:
    """Ids of whole texts by the tokenizers library, remembered by word.

    This vocabulary's splitter drops white space and never joins across it, so a text's ids are those of its words in turn.
    Of a word that is letters up to U+00FF and perhaps a closing comma or full stop, letters and mark are separate for the
    splitter too and case is dropped, so the letters are looked up in lower case. All memories are bounded and are emptied when full.

    A text of characters up to U+00FF that has no special token in any case is put in lower case as a whole first, and such marks are cut off in it, so that fewer words are new.
    """

    def __init__(self, spec: str, words: int = 400_000, cores: int = 700_000):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(spec)
        self.most_words, self.most_cores = words, cores
        self.words: dict[bytes, bytes] = {}
        self.cores: dict[str, bytes] = {}
        self.low: dict[bytes, bytes] = {}
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.special = [t.content.lower().encode("utf-8") for t in self.tok.get_added_tokens_decoder().values()]
        self.marks = {m: self._whole([m])[0] for m in ".,"} | {"": b""}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_cores(self, cores: list[str]) -> None:
        self.cores.update(self._cores(cores))

    def _cores(self, cores: list[str]) -> Iterator[tuple[str, bytes]]:
        for k in range(0, len(cores), 20_000):
            part = cores[k : k + 20_000]
            ids = np.array(self.tok.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            assert len(cuts) == len(part)  # a core is one piece of the splitter, and only its last id ends a word
            raw, cuts = ids.tobytes(), (cuts * 4).tolist()
            yield from zip(part, (raw[a:b] for a, b in zip([0, *cuts], cuts)))

    def learn(self, new: set[bytes]) -> None:
        if len(self.cores) > self.most_cores:
            self.cores.clear()
        split, whole = [], []
        for w in new:
            s = w.decode("utf-8")
            core, mark = (s[:-1], s[-1]) if s[-1] in ".," else (s, "")
            if core.isalpha() and max(core) <= "\xff":
                split.append((w, core.lower(), mark))
            else:
                whole.append((w, s))
        self._learn_cores([c for c in {c for _, c, _ in split} if c not in self.cores])
        cores, marks = self.cores, self.marks
        self.words.update((w, cores[c] + marks[m]) for w, c, m in split)
        self.words.update(zip((w for w, _ in whole), self._whole([s for _, s in whole])))

    def learn_low(self, new: list[bytes]) -> None:
        """Words in lower case, in Latin-1."""
        if not new:
            return
        own = b" ".join(new).decode("latin-1").split(" ")
        self.low.update((c.encode("latin-1"), ids) for c, ids in self._cores([s for s in own if s.isalpha()]))
        rest = [(w, s) for w, s in zip(new, own) if not s.isalpha()]
        self.low.update(zip((w for w, _ in rest), self._whole([s for _, s in rest])))

    def _lowered(self, text: str) -> bytes | None:
        """The text in lower case with marks after letters cut off, in Latin-1; None if that isn't known to give the same ids."""
        try:
            raw = text.encode("latin-1").translate(_LOWER)
        except UnicodeEncodeError:
            return None
        return None if any(x in raw for x in self.special) else _MARK.sub(rb" \g<0>", raw)

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Little-endian ids of each text; few texts at a time, so that what they hold new fits the memory."""
        for k in range(0, len(texts), 500):
            if len(self.words) > self.most_words:
                self.words.clear()
            if len(self.low) > self.most_cores:
                self.low.clear()
            part = [t or "" for t in texts[k : k + 500]]
            raws = [self._lowered(t) for t in part]
            words = [t.encode("utf-8").split() if raw is None else raw.split() for t, raw in zip(part, raws)]
            known, low, new, new_low = self.words, self.low, set(), set()
            for ws, raw in zip(words, raws):
                if raw is None:
                    new.update(w for w in ws if w not in known)
                else:
                    new_low.update(ws)
            if new:
                self.learn(new)
            self.learn_low(list(new_low - low.keys()))
            for ws, raw in zip(words, raws):
                yield b"".join(map((known if raw is None else low).__getitem__, ws))


_ENCODERS: dict[int, WordEncoder] = {}


def _encoder(spec: str) -> WordEncoder:
    """One per Python worker: a worker keeps it over its tasks."""
    if (k := hash(spec)) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[k] = WordEncoder(spec)
    return _ENCODERS[k]


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, block: int = 65_536, planes: str = "byte", level: int = 1) -> None:
    """Encode whole texts with the tokenizer file at ``tokenizer`` (read once, by the driver) and write the files described above.

    The text is shuffled once, to order it; equal ranges of it are shards, however often one doc_id occurs.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())  # a vocabulary file: a fixed few MB

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = _encoder(spec.value), int(end_id).to_bytes(4, "little")
        shard, chunk, ordinal = TaskContext.get().partitionId(), 0, 0
        held, pieces, size, rows = [], [], 0, []
        limit = block * 4

        def row(data: bytes, own: list) -> dict:
            sizes, payload = shuffle_planes(np.frombuffer(data, dtype="<u4"), planes, level)
            doc, o, at, n = zip(*own)
            return dict(shard=shard, chunk=chunk, first=chunk * block, n=len(data) // 4, planes=planes, plane_bytes=sizes, payload=payload, piece_doc=list(doc), piece_ord=list(o), piece_at=list(at), piece_n=list(n))

        for b in small(batches, 200):
            ids = b.column("doc_id").to_pylist()
            for doc, data in zip(ids, enc.encode(b.column("text").to_pylist())):
                data, at = data + end, 0
                while at < len(data):
                    part = data[at : at + limit - size]
                    pieces.append((doc, ordinal, at // 4, len(part) // 4))
                    held.append(part)
                    at, size = at + len(part), size + len(part)
                    if size == limit:
                        rows.append(row(b"".join(held), pieces))
                        held, pieces, size, chunk = [], [], 0, chunk + 1
                ordinal += 1
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=ARROW)
                rows = []
        if size:
            yield pa.RecordBatch.from_pylist([row(b"".join(held), pieces)], schema=ARROW)

    ordered = (
        only(docs, "doc_id", "text").select(long_id("doc_id"), F.col("text").cast("string").alias("text"))
        .withColumn("h", F.xxhash64("text"))
        .repartitionByRange("doc_id", "h")
        .sortWithinPartitions("doc_id", "h", "text")
        .select("doc_id", "text")
    )
    ordered.mapInArrow(encode, CHUNKS).write.option("compression", "none").parquet(f"{path}/chunks")
    spark.read.parquet(f"{path}/chunks").drop("payload").write.parquet(f"{path}/index")


ARROW = pa.schema(
    [("shard", pa.int32()), ("chunk", pa.int64()), ("first", pa.int64()), ("n", pa.int32()), ("planes", pa.string()), ("plane_bytes", pa.list_(pa.int32())), ("payload", pa.binary())]
    + [("piece_doc", pa.list_(pa.int64())), ("piece_ord", pa.list_(pa.int64())), ("piece_at", pa.list_(pa.int32())), ("piece_n", pa.list_(pa.int32()))]
)


def read_pieces(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Read the files: a row for each piece of a document in a block, (doc_id, shard, ord, at, first, n, crc[, ids]).

    ``at`` is the piece's place in its document, ``first`` its place in the shard; ids are little-endian bytes.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                raw = unshuffle_planes(r["n"], r["planes"], r["plane_bytes"], r["payload"]).tobytes()
                ends = np.cumsum(r["piece_n"])
                begins = ends - r["piece_n"]
                parts = [raw[4 * a : 4 * e] for a, e in zip(begins.tolist(), ends.tolist())]
                cols = [
                    pa.array(r["piece_doc"], pa.int64()), pa.array([r["shard"]] * len(parts), pa.int32()), pa.array(r["piece_ord"], pa.int64()), pa.array(r["piece_at"], pa.int64()),
                    pa.array(r["first"] + begins, pa.int64()), pa.array(r["piece_n"], pa.int64()), pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                ]
                names = ["doc_id", "shard", "ord", "at", "first", "n", "crc"]
                if with_ids:
                    cols, names = [*cols, pa.array(parts, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, shard int, ord long, at long, first long, n long, crc long" + ", ids binary" * with_ids
    return spark.read.parquet(f"{path}/chunks").mapInArrow(decode, schema)


def _times(m: list[int], v: int) -> int:
    out, k = 0, 0
    while v:
        if v & 1:
            out ^= m[k]
        v >>= 1
        k += 1
    return out


def crc32_join(a: int, b: int, n: int) -> int:
    """The crc32 of two byte strings one after another, from theirs and the second's length: ``a`` moves on over n zero bytes."""
    m = [0xEDB88320] + [1 << k for k in range(31)]  # one zero bit
    for _ in range(3):
        m = [_times(m, x) for x in m]
    while n:
        if n & 1:
            a = _times(m, a)
        m = [_times(m, x) for x in m]
        n >>= 1
    return a ^ b


@F.pandas_udf(LongType())
def _joined_crc(pieces: pd.Series) -> pd.Series:
    def one(ps) -> int:
        crc = None
        for p in ps:
            crc = p["crc"] if crc is None else crc32_join(crc, p["crc"], 4 * p["n"])
        return crc

    return pieces.map(one)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids before it over all shards), n_tokens, ids_crc32."""
    from pyspark.sql import Window

    sums = spark.read.parquet(f"{path}/index").groupBy("shard").agg(F.sum("n").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    base = sums.select(F.col("shard").alias("s"), F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    whole = (
        read_pieces(spark, path)
        .groupBy("shard", "ord", "doc_id")
        .agg(F.min("first").alias("first"), F.sum("n").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("at", "n", "crc"))).alias("pieces"))
    )
    return whole.join(base, whole["shard"] == base["s"]).select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", _joined_crc("pieces").alias("ids_crc32")
    )
