"""Operator 3: best-fit packing of tokenised documents into fixed-length sequences.

Every open sequence has a residual vector (tokens, documents, attention cost). A
piece goes, largest first, to the feasible sequence with the smallest weighted
residual norm after placing it, or with the largest weighted dot product of
residual and piece. Pieces of one length are alike and so are sequences of one
history, so the placing is worked out on classes: lengths with counts on one
side, runs of sequence numbers with a common residual on the other. The state is
bounded by the lengths there are (at most ``capacity``), not by the corpus; it
gives exactly what placing piece after piece would. The executors then look up
each piece's sequence by its length and its rank among the pieces of that length.
"""

from __future__ import annotations

import dataclasses
import struct
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigloom.llm import bpe
from sigloom.llm.shared import written


@dataclasses.dataclass(frozen=True)
class Limits:
    """What a sequence may hold, and what counts in choosing one.

    ``documents`` and ``cost`` (the sum of squared piece lengths) default to
    values that ``tokens`` implies, so that they never bind.
    """

    tokens: int = 1024
    documents: int | None = None
    cost: int | None = None
    rule: str = "norm"
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)

    @property
    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.cost or self.tokens**2], "f8")


def plan(counts: dict[int, int], limits: Limits) -> np.ndarray:
    """Placements as rows (length, first rank, first sequence, pieces to each, offset in it), ordered.

    Raises ValueError where a single piece exceeds a capacity.
    """
    full = limits.vector
    weights = np.array(limits.weights) / full
    residual = np.zeros((64, 3))
    first, many = np.zeros(64, "i8"), np.zeros(64, "i8")
    used, sequences, rows = 0, 0, []
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        piece = np.array([length, 1, length * length], "f8")
        if (piece > full).any():
            raise ValueError(f"a piece of {length} tokens exceeds {limits}")
        while left:
            fits = np.flatnonzero((many[:used] > 0) & (residual[:used] >= piece).all(axis=1))
            if len(fits):
                if limits.rule == "norm":
                    at = fits[np.argmin((((residual[fits] - piece) * weights) ** 2).sum(axis=1))]
                else:
                    at = fits[np.argmax(((residual[fits] * weights) * (piece * weights)).sum(axis=1))]
                room, start, n = residual[at].copy(), first[at], many[at]
            else:
                at, room, start, n = -1, full, sequences, left
            # the sequence just used has the least residual: by norm it is the best again while it has room, by
            # product the last of its kind; a new sequence stays the only one with room until it is full
            each = int((room // piece).min()) if limits.rule == "norm" or at < 0 else 1
            each = min(each, left)
            n = min(int(n), left // each)
            rows.append((length, rank, start, each, int(full[0] - room[0])))
            if at < 0:
                sequences += n
            else:
                first[at] += n
                many[at] -= n
            if used == len(first):
                alive = many > 0
                k = int(alive.sum())
                residual[:k], first[:k], many[:k], many[k:] = residual[alive], first[alive], many[alive], 0
                used = k
                if 2 * k > len(first):
                    residual = np.concatenate([residual, np.zeros_like(residual)])
                    first, many = np.concatenate([first, np.zeros_like(first)]), np.concatenate([many, np.zeros_like(many)])
            residual[used], first[used], many[used] = room - piece * each, start, n
            used += 1
            rank += n * each
            left -= n * each
    return np.array(sorted(rows), "i8").reshape(-1, 5)


def place(placements: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces with these lengths and ranks."""
    keys = placements[:, 0] << 44 | placements[:, 1]
    row = placements[np.searchsorted(keys, length << 44 | rank, "right") - 1]
    t = rank - row[:, 1]
    return row[:, 2] + t // row[:, 3], row[:, 4] + t % row[:, 3] * length


class Tokens(bpe.Memo):
    """The encoder's memo, filled by a library where ids are in the order of merging."""

    def __init__(self, model: bpe.Model):
        super().__init__(model)
        ranks = {b: i for i, b in enumerate(model.strings) if i not in model.special.values()}
        ordered = sorted(model.merges.values())
        self.core = None
        if all(a[1] < b[1] for a, b in zip(ordered, ordered[1:], strict=False)) and len(ranks) == len(model.strings) - len(model.special):
            self.core = tiktoken.Encoding("pieces", pat_str=bpe.PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})._core_bpe

    def __missing__(self, word: str) -> bytes:
        if self.core is None:
            return super().__missing__(word)
        ids = self.core.encode_single_piece(word.encode())
        out = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= 64:
            if len(self) >= bpe.MEMO:
                self.clear()
            self[word] = out
        return out


_codecs: dict[str, bpe.Codec] = {}


def codec_of(shared: bpe.Shared) -> bpe.Codec:
    if shared.id not in _codecs:
        _codecs.clear()
        _codecs[shared.id] = codec = bpe.Codec(shared.value)
        codec.memo = Tokens(shared.value)
    return _codecs[shared.id]


def pieces(docs: DataFrame, path: str, size: int = 1024, end: int = 2, ids: bool = False) -> DataFrame:
    """Tokenise whole texts, add id ``end`` and cut what is longer than ``size``.

    Columns doc_id, piece, start, length, ids_crc32, part and at (the piece's
    partition and its rank there among pieces of its length), and with ``ids``
    the ids. All pieces but a document's first have ``size`` ids. A null text is empty.
    """
    shared = bpe.Shared(docs.sparkSession, bpe.load_model(path))
    last = struct.pack("<I", end)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, at long" + ", ids array<int>" * ids

    def run(batches):
        from pyspark import TaskContext

        codec, part, seen = codec_of(shared), TaskContext.get().partitionId(), np.zeros(size + 1, "i8").tolist()
        for b in batches:
            row, piece, start, length, crc, at, flat = [], [], [], [], [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                x = codec.encode(text or "") + last
                n = len(x) // 4
                begin, stop, k = 0, n % size or size, 0
                while begin < n:
                    cut = x[4 * begin : 4 * stop]
                    row.append(i)
                    piece.append(k)
                    start.append(begin)
                    length.append(stop - begin)
                    crc.append(zlib.crc32(cut))
                    at.append(seen[stop - begin])
                    seen[stop - begin] += 1
                    if ids:
                        flat.append(np.frombuffer(cut, "<i4"))
                    begin, stop, k = stop, stop + size, k + 1
            columns = [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(v, pa.int64()) for v in (start, length, crc)), pa.array([part] * len(row), pa.int32()), pa.array(at, pa.int64())]
            if ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *length]), pa.int32()), pa.array(np.concatenate(flat) if flat else np.zeros(0, "i4"))))
            yield pa.record_batch(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "at", "ids"][: len(columns)])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pack(cut: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Give each row of a written table of pieces its sequence_id and offset.

    ``cut`` has length, part and at as :func:`pieces` makes them, already written
    (its ranks must not change between reads). Only the count of each length
    comes to the driver: ``limits.tokens`` numbers at most.
    """
    spark = cut.sparkSession
    counts = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(plan(totals, limits))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    ranked = cut.join(shift, ["part", "length"]).withColumn("at", F.col("at") + F.col("shift")).drop("shift", "part")
    names = [c for c in ranked.columns if c != "at"]

    def run(batches):
        for b in batches:
            s, o = place(shared.value, b.column("length").to_numpy(), b.column("at").to_numpy())
            yield pa.record_batch([*(b.column(c) for c in names), pa.array(s), pa.array(o)], names=[*names, "sequence_id", "offset"])

    schema = ranked.select(*names).schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, path: str, limits: Limits = Limits(), end: int = 2) -> DataFrame:
    """Pieces of all documents with their places; columns as the query's contract names them.

    Repeated rows are packed each on their own, null texts as empty ones, other
    columns are ignored, an empty table gives an empty one.
    """
    out = pack(written(pieces(docs, path, limits.tokens, end), "pieces"), limits)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
