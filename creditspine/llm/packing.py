"""Best-fit packing of token pieces into sequences, improved by swaps.

Documents are encoded, closed with an end id and cut only where longer than a
sequence. Pieces are dealt by a hash of their row into groups of bounded size.
A group starts from best fit over decreasing lengths; then a local search works
on its underfull bins: from the emptiest bin it moves a piece to a bin with
room, or exchanges one piece for a smaller one, or one piece for two that are
smaller together. Every step raises the sum of squared fills, so the search ends
of itself, when no step is left between any two bins; a bin that is emptied is
gone. Pieces of bins that stay underfull are dealt and packed again, until one
group holds them all or few of them find a better place.

Defined results: a null or empty text is one piece that holds the end id. Rows
with null or repeated ids are packed like any other. An empty table gives no
rows. Only the named columns are read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditspine.llm.common import shards, store
from creditspine.llm.tokens import encoder

#: Texts encoded at a time in a task.
SLICE = 128


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, piece, start, length, ids): the token pieces of every row, ids as little-endian 32-bit bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode_many
        end = np.array([end_id], dtype="<u4").tobytes()
        step = 4 * capacity
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                rows = []
                for doc, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist())):
                    ids += end
                    rows += [(doc, n, at // 4, min(len(ids) - at, step) // 4, ids[at:at + step])
                             for n, at in enumerate(range(0, len(ids), step))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                    names=[id_col, "piece", "start", "length", "ids"],
                )

    rows = docs.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return rows.mapInArrow(run, f"`{id_col}` long, piece int, start long, length long, ids binary")


def with_checksum(pieces: DataFrame) -> DataFrame:
    """Adds ``ids_crc32`` in place of ``ids``."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of piece numbers: each piece, longest first, goes where it leaves least room."""
    room: list[int] = []  # rooms of open bins, sorted
    by_room: dict[int, list[int]] = {}
    bins: list[list[int]] = []
    for k in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[k])
        at = bisect_left(room, size)
        if at == len(room):
            here, left = len(bins), capacity
            bins.append([])
        else:
            left = room[at]
            here = by_room[left].pop()
            if not by_room[left]:
                del by_room[left]
                room.pop(at)
        bins[here].append(k)
        left -= size
        if left:
            if left not in by_room:
                by_room[left] = []
                insort(room, left)
            by_room[left].append(here)
    return bins


def _best_exchange(low: list[int], bins: list[list[int]], others: list[int], fill: np.ndarray,
                   size: np.ndarray, capacity: int) -> tuple[int, list[int], list[int], int] | None:
    """The step out of bin ``low`` that carries most: (gain, pieces out, pieces in, other bin)."""
    best = None
    mine = sorted(low, key=lambda k: -size[k])
    for o in others:
        room = capacity - fill[o]
        theirs = sorted(bins[o], key=lambda k: size[k])
        weights = [int(size[k]) for k in theirs]
        for a in mine:
            s = int(size[a])
            if s <= room and (best is None or s > best[0]):
                best = (s, [a], [], o)  # move
            # one for one: the smallest piece that makes room
            at = bisect_left(weights, s - room)
            if at < len(weights) and weights[at] < s and (best is None or s - weights[at] > best[0]):
                best = (s - weights[at], [a], [theirs[at]], o)
            # two for one, by two ends closing in
            i, j = 0, len(weights) - 1
            while i < j:
                both = weights[i] + weights[j]
                if both >= s - room:
                    if both < s and (best is None or s - both > best[0]):
                        best = (s - both, [a], [theirs[i], theirs[j]], o)
                    j -= 1
                else:
                    i += 1
            if best is not None and best[0] == room:
                break
    return best


def improve(bins: list[list[int]], size: np.ndarray, capacity: int, width: int = 64) -> list[list[int]]:
    """Local search until no step is left or the bins are as few as the tokens allow.

    The emptiest bin looks for a partner among the others, ``width`` at a time
    from the emptiest on, and takes the best step of the first lot that has one.
    A bin that found none waits until a bin changes, and then looks at that one alone.
    """
    bins = [list(b) for b in bins]
    fill = np.array([int(size[b].sum()) for b in bins], dtype=np.int64)
    least = -(-int(size.sum()) // capacity)
    alive = int((fill > 0).sum())
    seen: dict[int, set[int]] = {}  # bins that a bin tried in vain
    while alive > least:
        under = [int(b) for b in np.argsort(fill, kind="stable") if 0 < fill[b] < capacity]
        step = None
        for low in under:
            known = seen.setdefault(low, set())
            others = [b for b in under if b != low and fill[b] >= fill[low] and b not in known]
            for lo in range(0, len(others), width):
                step = _best_exchange(bins[low], bins, others[lo:lo + width], fill, size, capacity)
                if step is not None:
                    break
                known.update(others[lo:lo + width])
            if step is not None:
                break
        if step is None:
            break
        gain, out, back, o = step
        bins[low] = [k for k in bins[low] if k not in out] + back
        bins[o] = [k for k in bins[o] if k not in back] + out
        fill[low] -= gain
        fill[o] += gain
        alive -= not bins[low]
        for changed in (low, o):
            seen.pop(changed, None)
        for known in seen.values():
            known -= {low, o}
    return [b for b in bins if b]


def _place(rows: DataFrame, capacity: int, group_tokens: int, open_below: float) -> DataFrame:
    """(_row, sequence_id, offset, _open) for rows (_row, length); one task packs a group."""
    n = shards(rows.agg(F.sum("length")).first()[0] or 0, group_tokens)
    dealt = rows.withColumn("_group", F.pmod(F.xxhash64("_row", F.lit(n)), F.lit(n)).cast("int"))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_row", kind="stable")
        size = frame["length"].to_numpy()
        own, at, full = np.empty_like(size), np.empty_like(size), np.empty(len(size), dtype=bool)
        for k, b in enumerate(improve(best_fit(size, capacity), size, capacity)):
            own[b] = k
            at[b] = np.cumsum(size[b]) - size[b]
            full[b] = size[b].sum() >= open_below * capacity
        return pd.DataFrame({"_row": frame["_row"].to_numpy(), "sequence_id": own * n + int(frame["_group"].iloc[0]),
                             "offset": at, "_open": ~full})

    return dealt.groupBy("_group").applyInPandas(run, "_row long, sequence_id long, offset long, _open boolean")


def pack(pieces: DataFrame, capacity: int = 4096, group_tokens: int = 1 << 21, open_below: float = 0.995) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``; ``pieces`` needs a column ``length``, others are carried along.

    A group of about ``group_tokens`` tokens is packed in one task. Bins filled
    less than ``open_below`` are taken apart and packed again with those of other
    groups, until one group holds all or a pass leaves over half of its tokens open.
    """
    # a number, written with its row, deals even equal rows to different groups
    rows = store(pieces.withColumn("_row", F.monotonically_increasing_id()))
    left = rows.select("_row", "length")
    tokens, taken, placed = left.agg(F.sum("length")).first()[0] or 0, 0, None
    while True:
        dealt = store(_place(left, capacity, group_tokens, open_below).withColumn("sequence_id", F.col("sequence_id") + taken))
        again = store(left.join(dealt.where("_open").select("_row"), "_row"))
        still = again.agg(F.sum("length")).first()[0] or 0
        last = tokens <= group_tokens or 2 * still > tokens or not still
        done = (dealt if last else dealt.where("not _open")).drop("_open")
        placed = done if placed is None else placed.unionAll(done)
        if last:
            return rows.join(placed, "_row").drop("_row")
        taken = dealt.agg(F.max("sequence_id")).first()[0] + 1
        left, tokens = again, still


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the packed sequences themselves, from pieces that kept ``ids``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda x, p: F.concat(x, p["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
