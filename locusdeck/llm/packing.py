"""Packing of examples into sequences: vector bin packing by the dot-product heuristic.

An example takes tokens, one segment, and loss-bearing tokens; a sequence has a limit on each. One sequence
is filled at a time: of the waiting pieces that fit, the one whose demand has the largest dot product with what the
sequence has left goes in, so pieces that use up the scarce dimension last are put off. With ``cut``, the best piece that does not fit is
cut where the sequence is full; its rest waits on. A sequence that some other limit closes more than ``pad`` tokens early is
shortened to a power of two, as is what remains at the end, because such lengths need no padding.

Every task tokenises and packs its own split, block by block: nothing is shuffled, the
waiting pieces are bounded by POOL_TOKENS, and no sequence spans two tasks. Sequences are the same whenever a task meets its
rows in the same order, as it does when it reads files; cut the lineage of other inputs first.

Defined results: NULL counts as empty, and an example is followed by the id ``end``, so each has one id at least; examples over a limit are cut
into pieces that fit it; repeated rows and NULL ids are examples of their own; an empty table gives no rows; other
columns are ignored. Loss-bearing are the ids of ``text`` and the end id, not those of ``prompt``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusdeck.llm.byte_pairs import byte_pairs

#: A pool of this many tokens is packed until half of it is left.
POOL_TOKENS = 1 << 19
#: Padding that is accepted rather than a shorter sequence.
PAD = 16
END = 0


class Limits(NamedTuple):
    """What one sequence may hold."""

    tokens: int = 1024
    segments: int = 64
    loss: int = 1024


class Piece(NamedTuple):
    """Some ids of an example; those from ``loss_from`` on bear loss."""

    row: object
    start: int
    ids: np.ndarray
    loss_from: int
    total: int

    @property
    def loss(self) -> int:
        return max(0, len(self.ids) - max(0, self.loss_from - self.start))

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return self._replace(ids=self.ids[:at]), self._replace(start=self.start + at, ids=self.ids[at:])


def power_of_two(n: int) -> bool:
    return n > 0 and n & (n - 1) == 0


class Packer:
    """Waiting pieces of one task, and the sequences they are put into."""

    def __init__(self, limits: Limits = Limits(), cut: bool = True, pad: int = PAD):
        if min(limits) < 1:
            raise ValueError("a sequence has to hold one token, segment and loss-bearing token at least")
        self.limits, self.cut, self.pad = limits, cut, pad
        self.pieces: list[Piece | None] = []
        self.need = np.zeros((64, 3), np.int64)
        self.calm = np.zeros(64, np.int64)  # leading ids that bear no loss
        self.free: list[int] = []
        self.tokens = 0

    def _wait(self, piece: Piece) -> None:
        slot = self.free.pop() if self.free else len(self.pieces)
        if slot == len(self.pieces):
            self.pieces.append(None)
            if slot == len(self.need):
                self.need = np.concatenate([self.need, np.zeros_like(self.need)])
                self.calm = np.concatenate([self.calm, np.zeros_like(self.calm)])
        self.pieces[slot] = piece
        self.need[slot] = len(piece.ids), 1, piece.loss
        self.calm[slot] = len(piece.ids) - piece.loss
        self.tokens += len(piece.ids)

    def _take(self, slot: int) -> Piece:
        piece = self.pieces[slot]
        self.pieces[slot] = None
        self.need[slot] = self.calm[slot] = 0
        self.free.append(slot)
        self.tokens -= len(piece.ids)
        return piece

    @staticmethod
    def _most(piece: Piece, tokens: int, loss: int) -> int:
        """How many leading ids of a piece fit."""
        return min(len(piece.ids), tokens, len(piece.ids) - piece.loss + loss)

    def add(self, row: object, ids: np.ndarray, loss_from: int = 0) -> Iterator[list[Piece]]:
        """Take an example; what fills a sequence by itself comes back at once."""
        piece = Piece(row, 0, ids, loss_from, len(ids))
        while True:
            most = self._most(piece, self.limits.tokens, self.limits.loss)
            head, rest = piece.cut(most)
            if most == self.limits.tokens:
                yield [head]
            else:
                # A copy, so that a short rest does not keep a long example in memory.
                self._wait(head._replace(ids=head.ids.copy()))
            if not len(rest.ids):
                return
            piece = rest

    def _sequence(self) -> list[Piece]:
        """Fill one sequence."""
        left = np.array(self.limits, np.int64)
        scale = 1.0 / (np.array(self.limits, np.float64) ** 2)
        chosen: list[Piece] = []
        while self.tokens and left[:2].min() > 0:
            need = self.need[: len(self.pieces)]
            score = need @ (left * scale)
            fits = (need <= left).all(1) & (need[:, 0] > 0)
            slot = int(np.argmax(np.where(fits, score, -1.0)))
            if fits[slot]:
                piece = self._take(slot)
            elif not self.cut:
                break
            else:
                # With no loss left, only ids that bear none can go in.
                able = need[:, 0] > 0 if left[2] else self.calm[: len(need)] > 0
                slot = int(np.argmax(np.where(able, score, -1.0)))
                if not able[slot]:
                    break
                most = self._most(self.pieces[slot], int(left[0]), int(left[2]))
                piece, rest = self._take(slot).cut(most)
                self._wait(rest)
            chosen.append(piece)
            left -= (len(piece.ids), 1, piece.loss)
        return chosen

    def _shortened(self, chosen: list[Piece]) -> list[Piece]:
        """The sequence at a length that needs no padding; what is cut off waits on."""
        size = sum(len(p.ids) for p in chosen)
        short = self.limits.tokens - size
        if not self.cut or power_of_two(size) or short == 0 or (short <= self.pad and self.tokens):
            return chosen
        over = size - (1 << (size.bit_length() - 1))
        while over:
            last = chosen.pop()
            if len(last.ids) > over:
                kept, last = last.cut(len(last.ids) - over)
                chosen.append(kept)
            over -= len(last.ids)
            self._wait(last)
        return chosen

    def sequences(self, down_to: int = 0) -> Iterator[list[Piece]]:
        """Pack until ``down_to`` tokens at most wait on."""
        while self.tokens > down_to:
            yield self._shortened(self._sequence())


def packed(
    examples: DataFrame,
    tokenizer_file: str,
    limits: Limits = Limits(),
    cut: bool = True,
    pad: int = PAD,
    id_col: str = "doc_id",
    prompt: str | None = None,
    ids: bool = False,
) -> DataFrame:
    """A row for every piece: where it lies in its example and in its sequence; with ``ids`` also its ids.

    ``start`` counts the example's ids before the piece, ``offset`` the sequence's, ``segment`` its pieces.
    """
    before = F.col(prompt) if prompt else F.lit(None).cast("string")
    rows = examples.select(F.col(id_col).alias(id_col), before.alias("_prompt"), F.col("text").alias("_text"))
    schema = rows.select(id_col).schema
    names = ("start", "length", "ids_crc32", "doc_tokens", "loss_tokens", "sequence_id", "segment", "offset")
    for name in names:
        schema = schema.add(name, "long")
    if ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, packer = byte_pairs(tokenizer_file), Packer(limits, cut, pad)
        kind = pa.null()
        sequence = TaskContext.get().partitionId() << 33
        out: list[tuple] = []

        def put(pieces: list[Piece]) -> None:
            nonlocal sequence
            offset = 0
            for k, p in enumerate(pieces):
                data = p.ids.astype("<u4", copy=False)
                row = (p.row, p.start, len(data), zlib.crc32(data), p.total, p.loss, sequence, k, offset)
                out.append((*row, data.astype(np.int32)) if ids else row)
                offset += len(data)
            sequence += 1

        def written() -> pa.RecordBatch:
            columns = list(zip(*out))
            arrays = [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:9])]
            if ids:
                arrays.append(pa.array(columns[9], pa.list_(pa.int32())))
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, schema.names)

        for batch in batches:
            kind = batch.column(0).type
            for row, ask, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                head = tool.encode(ask) if ask else np.zeros(0, np.uint32)
                body = tool.encode(text) if text else np.zeros(0, np.uint32)
                for pieces in packer.add(row, np.concatenate([head, body, np.array([END], np.uint32)]), len(head)):
                    put(pieces)
                if packer.tokens >= POOL_TOKENS:
                    for pieces in packer.sequences(POOL_TOKENS // 2):
                        put(pieces)
                if len(out) >= 8192:
                    yield written()
        for pieces in packer.sequences():
            put(pieces)
            if len(out) >= 8192:
                yield written()
        if out:
            yield written()

    return rows.mapInArrow(run, schema)
