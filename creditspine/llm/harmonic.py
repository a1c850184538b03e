"""Harmonic packing: every length class has bins for a fixed number of pieces.

Class k holds the pieces that fill one k-th of a sequence. Documents may be cut,
so each is cut to fit its classes: full sequences first, then the largest half,
quarter, eighth ... that its rest still fills. A bin of class k is closed with its
k-th piece and has no padding. Classes need no knowledge of each other, nor do
workers: a task packs the rows it reads in one pass, without a shuffle, and holds
open only the unfinished bins, one sequence of tokens per class at most.

What is left open when a task ends is joined, longest pieces first: reciprocals
of powers of two close without gaps, so one sequence of the task stays short, and
it is cut where its length is a power of two. Sequence ids are the task's number
and a counter, so a task that runs again gives the same rows for the same input.

Defined results: a null or empty text is one piece that holds the end id. Rows
with null or repeated ids are packed like any other. An empty table gives no
rows. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditspine.llm.tokens import encoder

#: Texts encoded at a time in a task.
SLICE = 128
#: Sequences that one task can number.
PER_TASK = 1 << 33

PLACED = "start long, length long, doc_tokens long, ids binary, sequence_id long, offset long"

#: (row id, start, length, tokens of the document, ids)
Piece = tuple[int | None, int, int, int, bytes]


def reciprocal_cuts(length: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document: full sequences, then falling reciprocals of the capacity."""
    cuts = [capacity] * (length // capacity)
    part = capacity
    while part > 1:
        part //= 2
        if length & part:
            cuts.append(part)
    return cuts


def close_up(pieces: list[Piece], capacity: int) -> list[list[Piece]]:
    """Bins of the pieces that open bins held, none of them padded.

    Lengths are powers of two, so in falling order they meet every multiple of
    the capacity, and the last bin every binary digit of its length.
    """
    bins: list[list[Piece]] = []
    total = sum(p[2] for p in pieces)
    goal = 0
    for piece in sorted(pieces, key=lambda p: -p[2]):
        if not goal:
            goal = capacity if total >= capacity else 1 << (total.bit_length() - 1)
            total -= goal
            bins.append([])
        bins[-1].append(piece)
        goal -= piece[2]
    return bins


class Bins:
    """The open bins of one worker."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.open: dict[int, list[Piece]] = {}
        self.placed: list[tuple] = []

    def close(self, pieces: list[Piece]) -> None:
        at = 0
        for piece in pieces:
            self.placed.append((*piece, self.next_id, at))
            at += piece[2]
        self.next_id += 1

    def add(self, piece: Piece) -> None:
        count = self.capacity // piece[2]  # the class: so many pieces of this length fill a bin
        here = self.open.setdefault(count, [])
        here.append(piece)
        if len(here) == count:
            self.close(here)
            self.open[count] = []

    def finish(self) -> None:
        for pieces in close_up([p for bin_ in self.open.values() for p in bin_], self.capacity):
            self.close(pieces)
        self.open = {}


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, start, length, doc_tokens, ids, sequence_id, offset): one row per piece, ids as little-endian 32-bit bytes."""
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode_many
        end = np.array([end_id], dtype="<u4").tobytes()
        bins = Bins(capacity, TaskContext.get().partitionId() * PER_TASK)

        def placed() -> pa.RecordBatch:
            rows, bins.placed = bins.placed, []
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
            names = [id_col, "start", "length", "doc_tokens", "ids", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                for doc, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist())):
                    ids += end
                    total, at = len(ids) // 4, 0
                    for size in reciprocal_cuts(total, capacity):
                        bins.add((doc, at, size, total, ids[4 * at:4 * (at + size)]))
                        at += size
                if bins.placed:
                    yield placed()
        bins.finish()
        if bins.placed:
            yield placed()

    rows = docs.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return rows.mapInArrow(run, f"`{id_col}` long, {PLACED}")
