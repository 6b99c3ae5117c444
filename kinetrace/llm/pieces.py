"""SentencePiece encoding and decoding, with a max-plus scan over giant documents.

The model is a BPE model. Its encoding of a text is the one sequence of pieces of which every
neighbouring pair is itself the encoding of the pair's text, so it is the best path where a pair
weighs 0 if that holds and minus infinity if not. A giant document is cut into chunks anywhere. The
state at a cut is the piece that holds the character before it; a chunk's transfer matrix says which
state at its start leads to which at its end, in max-plus. Matrices of a document are combined by an
associative scan, which fixes the states at all cuts, and every chunk is then traced back by itself.
Documents below GIANT_CHARS are one chunk, which the library encodes.

Defined cases: null counts as empty; empty texts have no pieces; characters outside the vocabulary
become byte pieces; a text that holds the model's own space mark does not come back from decoding,
and round_trip says so; repeated rows each get a row; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, dense

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
GIANT_CHARS = 1 << 16
CHUNK_CHARS = 1 << 14
NONE = -np.inf


class Pieces:
    """A model's pieces, the pairs that may stand side by side, and the library's own processor."""

    def __init__(self, proto: bytes):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        sp = self.sp
        usual = [i for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.ids = {sp.id_to_piece(i): i for i in usual}
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in usual}
        self.longest = max(map(len, self.ids), default=1)
        self.heads = {p[:k] for p in self.ids for k in range(1, len(p) + 1)}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self._pairs: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """The encoding of a short text: merge the pair of best score, the leftmost on ties."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, a: str, b: str) -> bool:
        """b may follow a; an empty a is the start of the text."""
        found = self._pairs.get((a, b))
        if found is None:
            if len(self._pairs) > 1_000_000:
                self._pairs.clear()
            found = self._pairs[a, b] = self.merged(a + b) == ([a, b] if a else [b])
        return found

    def pieces_at(self, text: str, at: int) -> Iterator[int]:
        """Ends of the pieces that start at `at`; a single character always is one."""
        stop = min(len(text), at + self.longest)
        end = at + 1
        yield end
        while end < stop and text[at:end] in self.heads:
            end += 1
            if text[at:end] in self.ids:
                yield end

    def states(self, text: str, cut: int) -> list[tuple[int, int]]:
        """Pieces (start, end) with start < cut <= end, in order."""
        return [(i, j) for i in range(max(0, cut - self.longest), cut) for j in self.pieces_at(text, i) if j >= cut]

    def paths(self, text: str, starts: list[tuple[int, int]], stop: int) -> dict[int, list[tuple[int, int]]]:
        """For each position the pieces (start, mask) that end there: bit k of the mask is set where
        the piece is reached from the k-th start state without a bad pair. Pieces start before stop."""
        ends: dict[int, list[tuple[int, int]]] = {}
        for k, (i, j) in enumerate(starts):
            ends.setdefault(j, []).append((i, 1 << k))
        for at in range(min(ends, default=0), stop):
            before = ends.get(at)
            if not before:
                continue
            for end in self.pieces_at(text, at):
                piece, mask = text[at:end], 0
                for start, m in before:
                    if self.fits(text[start:at], piece):
                        mask |= m
                if mask:
                    ends.setdefault(end, []).append((at, mask))
        return ends

    def transfer(self, text: str, starts: list[tuple[int, int]], stop: int, outs: list[tuple[int, int]]) -> np.ndarray:
        """Max-plus matrix (starts x outs) of a chunk that ends at stop."""
        ends = self.paths(text, starts, stop)
        out = np.full((len(starts), len(outs)), NONE)
        for c, (i, j) in enumerate(outs):
            for start, mask in ends.get(j, ()):
                if start == i:
                    out[[k for k in range(len(starts)) if mask >> k & 1], c] = 0.0
        return out

    def trace(self, text: str, state: tuple[int, int], stop: int, out: tuple[int, int]) -> list[str]:
        """The pieces after `state` up to and with `out`, backwards from it."""
        if state == out:
            return []
        ends = self.paths(text, [state], stop)
        pieces, (at, end) = [text[out[0] : out[1]]], out
        while at != state[1]:
            end, at = at, next(s for s, _ in ends[at] if self.fits(text[s:at], text[at:end]))
            pieces.append(text[at:end])
        return pieces[::-1]

    def numbered(self, pieces: list[str]) -> list[int]:
        out = []
        for p in pieces:
            out += [self.ids[p]] if p in self.ids else [self.bytes[b] for b in p.encode()]
        return out


@cache
def loaded(proto: bytes) -> Pieces:
    return Pieces(proto)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1, initial=NONE)


def cut_states(matrices: list[np.ndarray]) -> list[int]:
    """For a chain of transfer matrices from one start to one end state, the state at each inner cut:
    products of halves from both sides, each matrix in O(log n) products."""
    out = [0] * (len(matrices) - 1)

    def total(i: int, j: int) -> np.ndarray:
        if j - i == 1:
            return matrices[i]
        m = (i + j) // 2
        if (i, j) not in held:
            held[i, j] = product(total(i, m), total(m, j))
        return held[i, j]

    held: dict[tuple[int, int], np.ndarray] = {}

    def descend(i: int, j: int, before: np.ndarray, after: np.ndarray) -> None:
        """before: weights from the start to the states at i; after: from those at j to the end."""
        if j - i == 1:
            return
        m = (i + j) // 2
        left = product(before, total(i, m))
        right = product(total(m, j), after)
        both = left[0] + right[:, 0]
        best = int(both.argmax())
        if both[best] == NONE:
            raise ValueError("no path leads through the chunks")
        out[m - 1] = best
        descend(i, m, before, right)
        descend(m, j, left, after)

    descend(0, len(matrices), np.zeros((1, 1)), np.zeros((1, 1)))
    return out


CHUNKS = "ka long, kb long, chunk int, n_chunks int, first int, stop int, text string"


def as_chunks(text: str, longest: int, size: int) -> list[tuple[int, int, str, int]]:
    """(first, stop, text with margins, offset): a chunk is [first, stop) of its text; the margins
    hold every piece that can cross its ends."""
    out = []
    for a in range(0, len(text), size):
        b = min(a + size, len(text))
        lo, hi = max(0, a - longest), min(len(text), b + longest)
        out.append((a - lo, b - lo, text[lo:hi], lo))
    return out


def ends_of(p: Pieces, text: str, first: int, stop: int, chunk: int, n: int) -> tuple[list, list]:
    """States at both ends of a chunk; the text's start is an empty piece, its end holds the last one."""
    starts = p.states(text, first) if chunk else [(0, 0)]
    outs = p.states(text, stop)
    return starts, outs


def encode_giant(p: Pieces, text: str, size: int = CHUNK_CHARS) -> list[int]:
    """The scan over one normalised text, in one place; the table version below does the same steps."""
    chunks = as_chunks(text, p.longest, size)
    ends = [ends_of(p, t, a, b, k, len(chunks)) for k, (a, b, t, _) in enumerate(chunks)]
    mats = [p.transfer(t, s, b, o) for (a, b, t, _), (s, o) in zip(chunks, ends)]
    mats[-1] = mats[-1].max(axis=1, keepdims=True)
    picks = cut_states(mats) if len(mats) > 1 else []
    out: list[int] = []
    for k, ((a, b, t, lo), (s, o)) in enumerate(zip(chunks, ends)):
        state = s[picks[k - 1]] if k else s[0]
        last = o[picks[k]] if k < len(picks) else next(x for c, x in enumerate(o) if p.transfer(t, [state], b, [x])[0, 0] == 0)
        out += p.numbered(p.trace(t, state, b, last))
    return out


def digest(ids) -> str:
    return hashlib.sha256(np.asarray(ids, np.int32).tobytes()).hexdigest()


RESULT = "doc_id long, ka long, kb long, n_pieces long, ids_sha256 string, round_trip boolean, n_chunks int"


class Model:
    """A model file read once on the driver and broadcast (under 1 MB)."""

    def __init__(self, spark: SparkSession, path: str = MODEL):
        with open(path, "rb") as f:
            self.shared = spark.sparkContext.broadcast(f.read())

    def pieces(self) -> Pieces:
        return loaded(self.shared.value)


def encode_documents(spark: SparkSession, docs: DataFrame, model: Model, giant: int = GIANT_CHARS, size: int = CHUNK_CHARS) -> DataFrame:
    """(doc_id, n_pieces, ids_sha256, round_trip, n_chunks) of every whole text; ids_sha256 is of the
    ids as little-endian 32-bit integers."""
    scratch = Scratch(spark, "pieces", docs)
    narrow = dense(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = model.pieces()
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                out = []
                docs_, texts = (c.to_pylist() for c in part.columns)
                texts = [t or "" for t in texts]
                encoded = iter(p.sp.encode([t for t in texts if len(t) < giant], num_threads=1))
                for doc, text in zip(docs_, texts):
                    if len(text) >= giant:
                        key = np.frombuffer(hashlib.sha256(text.encode()).digest()[:16], np.int64)
                        out.append((doc, int(key[0]), int(key[1]), None, None, None, None))
                    else:
                        ids = next(encoded)
                        out.append((doc, None, None, len(ids), digest(ids), p.sp.decode(ids) == text, 1))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=[x.split()[0] for x in RESULT.split(", ")])

    rows = scratch.keep(narrow.mapInArrow(whole, RESULT), "whole")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = model.pieces()
        for batch in batches:
            for text in batch.column(1).to_pylist():
                key = np.frombuffer(hashlib.sha256(text.encode()).digest()[:16], np.int64)
                chunks = as_chunks(p.sp.normalize(text), p.longest, size)
                out = [(int(key[0]), int(key[1]), k, len(chunks), a, b, t) for k, (a, b, t, _) in enumerate(chunks)]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=[x.split()[0] for x in CHUNKS.split(", ")])

    long = narrow.where(F.char_length("text") >= giant)
    # Copies of a giant text give the same chunks once.
    chunks = long.mapInArrow(cut, CHUNKS).dropDuplicates(["ka", "kb", "chunk"])
    chunks = scratch.keep(chunks, "chunks")
    # Few rows of much work: a number of partitions of its own, which Spark doesn't put together.
    spread = chunks.repartition(min(max(1, chunks.count()), 16 * scratch.width), F.col("ka"), F.col("chunk"))

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = model.pieces()
        for batch in batches:
            out = []
            for ka, kb, k, n, a, b, text in zip(*(c.to_pylist() for c in batch.columns)):
                starts, outs = ends_of(p, text, a, b, k, n)
                m = p.transfer(text, starts, b, outs)
                out.append((ka, kb, k, n, len(starts), len(outs), (m == 0).astype(np.uint8).tobytes()))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["ka", "kb", "chunk", "n_chunks", "n_in", "n_out", "m"])

    mats = spread.mapInArrow(matrices, "ka long, kb long, chunk int, n_chunks int, n_in int, n_out int, m binary")

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        """A document's matrices: as many small ones as it has chunks."""
        pdf = pdf.sort_values("chunk")
        ms = [np.where(np.frombuffer(m, np.uint8).reshape(i, o) == 1, 0.0, NONE) for m, i, o in zip(pdf["m"], pdf["n_in"], pdf["n_out"])]
        final = ms[-1]
        ms[-1] = final.max(axis=1, keepdims=True)
        picks = cut_states(ms) if len(ms) > 1 else []
        first = [0, *picks]
        last = [*picks, int(final[first[-1]].argmax())]
        return pd.DataFrame({"ka": pdf["ka"].to_numpy(), "kb": pdf["kb"].to_numpy(), "chunk": pdf["chunk"].to_numpy(), "state": first, "final": last})

    states = mats.groupBy("ka", "kb").applyInPandas(combine, "ka long, kb long, chunk int, state int, final int")
    states = scratch.keep(states, "states")
    again = chunks.join(states, ["ka", "kb", "chunk"])

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = model.pieces()
        for batch in batches:
            out = []
            for ka, kb, k, n, a, b, text, state, final in zip(*(c.to_pylist() for c in batch.columns)):
                starts, outs = ends_of(p, text, a, b, k, n)
                out.append((ka, kb, k, n, p.numbered(p.trace(text, starts[state], b, outs[final]))))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["ka", "kb", "chunk", "n_chunks", "ids"])

    traced = again.select("ka", "kb", "chunk", "n_chunks", "first", "stop", "text", "state", "final").mapInArrow(trace, "ka long, kb long, chunk int, n_chunks int, ids array<int>")

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        ids = np.concatenate([np.asarray(x, np.int32) for x in pdf["ids"]])
        text = model.pieces().sp.decode(ids.tolist())
        key = np.frombuffer(hashlib.sha256(text.encode()).digest()[:16], np.int64)
        ka, kb = int(pdf["ka"].iloc[0]), int(pdf["kb"].iloc[0])
        return pd.DataFrame([{"ka": ka, "kb": kb, "g_pieces": len(ids), "g_sha": digest(ids), "g_trip": (int(key[0]), int(key[1])) == (ka, kb), "g_chunks": int(pdf["n_chunks"].iloc[0])}])

    done = traced.groupBy("ka", "kb").applyInPandas(finish, "ka long, kb long, g_pieces long, g_sha string, g_trip boolean, g_chunks int")
    done = scratch.keep(done, "giants")
    giants = rows.where("ka is not null").join(done, ["ka", "kb"]).select("doc_id", F.col("g_pieces").alias("n_pieces"), F.col("g_sha").alias("ids_sha256"), F.col("g_trip").alias("round_trip"), F.col("g_chunks").alias("n_chunks"))
    return scratch.finish(rows.where("ka is null").select(*giants.columns).unionByName(giants))


def decode_documents(spark: SparkSession, rows: DataFrame, model: Model) -> DataFrame:
    """rows (doc_id, ids array<int>) as (doc_id, text); null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = model.pieces()
        for batch in batches:
            texts = [p.sp.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")
