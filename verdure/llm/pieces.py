"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi.

The automaton holds every piece of the model file. One pass over a text follows its output links: at each position they give all pieces that end there, each of which relaxes the best
score at its end. Scores are the model file's. Characters that no piece covers fall back to byte pieces, at ``byte_score`` a byte. Ties go to the longer last piece. Decoding joins
pieces and bytes again and is exact: a literal U+2581 in a text, which stands for a space in pieces, is written in byte pieces.

No piece holds the space mark after another character (checked when the model is loaded), so the best path of a text is the best paths of its marked words in turn, and words are
remembered in a bounded memory; a model of which this isn't true is run over whole texts.

Cases: a null text is empty and has no pieces; a null doc_id stays null; repeated rows stay; an empty table gives an empty result; other columns are ignored, whatever their names;
a very long text is encoded whole, in one pass in its task.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import long_id, only, small

SPACE = "▁"


class Pieces:
    """Encoder and decoder of one model. ``model`` is the content of a SentencePiece model file."""

    def __init__(self, model: bytes, byte_score: float = -1e10, remembered: int = 600_000):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.byte_ids, self.texts, pieces = [-1] * 256, {}, []
        for i in range(sp.get_piece_size()):
            text = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(text[1:-1], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.texts[i] = text
                pieces.append((text, i, float(sp.get_score(i))))
        if min(self.byte_ids) < 0:
            raise ValueError("the model has no byte pieces to fall back to")
        self.byte_of = {i: bytes([b]) for b, i in enumerate(self.byte_ids)}
        self.plain = {i: t.replace(SPACE, " ").encode() for i, t in self.texts.items()} | self.byte_of
        self.byte_score, self.most = byte_score, remembered
        self.automaton = ahocorasick.Automaton()
        for text, i, score in pieces:
            self.automaton.add_word(text, (len(text), score, i))
        self.automaton.make_automaton()
        self.apart = not any(SPACE in t.lstrip(SPACE) for t, _, _ in pieces)
        self.lines = not any("\n" in t and len(t) > 1 for t, _, _ in pieces)
        self.single = {t for t, _, _ in pieces if len(t) == 1}
        self.words: dict[str, bytes] = {}

    def best(self, marked: str) -> list[int]:
        """The best path of a marked text: in one pass each piece that ends at a position relaxes it. Pieces of one end come longest first."""
        n = len(marked)
        low = float("-inf")
        score, size_of, id_of = [0.0] + [low] * n, [0] * (n + 1), [0] * (n + 1)
        if self.single.issuperset(marked):  # then falling back is never better
            for end, (size, s, i) in self.automaton.iter(marked):
                s += score[end + 1 - size]
                if s > score[end + 1]:
                    score[end + 1], size_of[end + 1], id_of[end + 1] = s, size, i
        else:
            fall = [self.byte_score * len(c.encode()) for c in marked]
            at = 0  # positions up to here have their fallback
            for end, (size, s, i) in self.automaton.iter(marked):
                at = self._fall_back(score, size_of, id_of, fall, at, end)
                s += score[end + 1 - size]
                if s > score[end + 1]:
                    score[end + 1], size_of[end + 1], id_of[end + 1] = s, size, i
            self._fall_back(score, size_of, id_of, fall, at, n)
        out = []
        while n:
            out += [self.byte_ids[b] for b in reversed(marked[n - 1].encode())] if id_of[n] < 0 else [id_of[n]]
            n -= size_of[n]
        return out[::-1]

    @staticmethod
    def _fall_back(score: list, size_of: list, id_of: list, fall: list, at: int, to: int) -> int:
        while at < to:
            at += 1
            s = score[at - 1] + fall[at - 1]
            if s > score[at]:
                score[at], size_of[at], id_of[at] = s, 1, -1
        return at

    def _learn(self, word: str) -> bytes:
        """Ids of a marked word, whose lines, if no piece holds a newline and another character, are words of their own."""
        if "\n" in word and len(word) > 1 and self.lines:
            ids = b"".join(self._learn(w) if w not in self.words else self.words[w] for w in re.findall("[^\n]+|\n", word))
            return ids
        if len(self.words) >= self.most:
            self.words.clear()
        ids = self.words[word] = np.array(self.best(word), "<u4").tobytes()
        return ids

    def encode(self, text: str) -> bytes:
        """Little-endian ids of a text."""
        if not text:
            return b""
        out, get, learn = [], self.words.get, self._learn
        for k, part in enumerate(text.split(SPACE)):  # a literal mark isn't a space
            if k:
                out.append(np.array([self.byte_ids[b] for b in SPACE.encode()], "<u4").tobytes())
            marked = (SPACE if not k else "") + part.replace(" ", SPACE)
            if self.apart:
                out += [get(w) or learn(w) for w in re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", marked)]
            else:
                out.append(np.array(self.best(marked), "<u4").tobytes())
        return b"".join(out)

    def decode(self, ids: bytes | list[int]) -> str:
        """The text of ids: the mark in front goes, other marks are spaces, byte pieces are the bytes they name."""
        ids = np.frombuffer(ids, "<u4").tolist() if isinstance(ids, bytes) else ids
        return b"".join(map(self.plain.__getitem__, ids))[1:].decode()


_LOADED: dict[str, Pieces] = {}


def _loaded(model: bytes) -> Pieces:
    if (k := hashlib.sha256(model).hexdigest()) not in _LOADED:
        _LOADED.clear()
        _LOADED[k] = Pieces(model)
    return _LOADED[k]


def encode_documents(docs: DataFrame, model: str, check: bool = True) -> DataFrame:
    """(doc_id, pieces, n_pieces, ids_crc32, exact): ids as an array; with ``check``, whether decoding gives the text back. ``model`` is read by the driver."""
    with open(model, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file: a fixed few MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = _loaded(shared.value)
        for b in small(batches):
            texts = [t or "" for t in b.column(1).to_pylist()]
            ids = [p.encode(t) for t in texts]
            flat = pa.array(np.frombuffer(b"".join(ids), "<u4").view(np.int32))
            ends = np.cumsum([0] + [len(x) // 4 for x in ids])
            exact = [p.decode(x) == t for x, t in zip(ids, texts)] if check else [None] * len(ids)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat), pa.array(np.diff(ends), pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(exact, pa.bool_())],
                names=["doc_id", "pieces", "n_pieces", "ids_crc32", "exact"],
            )
        p.words.clear()

    return only(docs, "doc_id", "text").select(long_id("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, pieces array<int>, n_pieces long, ids_crc32 long, exact boolean")


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of encoded documents."""
    with open(model, "rb") as f:
        shared = encoded.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = _loaded(shared.value)
        for b in small(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([p.decode(x) for x in b.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return encoded.select(long_id("doc_id"), "pieces").mapInArrow(run, "doc_id long, text string")


def brute(p: Pieces, marked: str) -> float:
    """The best score of a marked text by trying all pieces at all places, for tests."""
    scores = {t: s for t, (_, s, _) in p.automaton.items()}
    best = [0.0]
    for n in range(1, len(marked) + 1):
        own = [best[n - 1] + p.byte_score * len(marked[n - 1].encode())]
        own += [best[a] + scores[marked[a:n]] for a in range(max(0, n - 60), n) if marked[a:n] in scores]
        best.append(max(own))
    return best[-1]
