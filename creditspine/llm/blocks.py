"""Pairs inside buckets, without forming them as rows.

Members of a bucket are cut into slices of bounded size. Two slices of a bucket
meet in one block, so a hot bucket becomes many blocks of bounded size on many
tasks. A block is compared with numpy and gives back at most a forest of links
and a count per member, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Members of a slice; two slices meet in a block.
SLICE = 1024


def deal(members: DataFrame, bucket: str, member: str, sizes: DataFrame, n_shards: int,
         slice_rows: int = SLICE) -> DataFrame:
    """Members with ``_block``, ``_side`` (0 low slice, 1 high, 2 both) and ``_shard``.

    ``sizes`` holds (bucket, n) of the buckets to compare; others are left out.
    """
    out = members.join(sizes, bucket).withColumn("_slices", F.ceil(F.col("n") / slice_rows).cast("int")).drop("n")
    out = out.withColumn("_own", F.pmod(F.xxhash64(member), F.col("_slices")).cast("int"))
    out = out.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)))
    low, high = F.least("_own", "_with"), F.greatest("_own", "_with")
    side = F.when(low == high, 2).when(F.col("_own") == low, 0).otherwise(1)
    return (
        out.withColumn("_block", F.xxhash64(bucket, low, high)).withColumn("_side", side.cast("int"))
        .withColumn("_shard", F.pmod("_block", F.lit(n_shards)).cast("int")).drop("_slices", "_own", "_with")
    )


def pairs(block: np.ndarray, side: np.ndarray, chunk: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of all blocks, in chunks of about ``chunk`` pairs.

    ``block`` must be sorted, ``side`` sorted inside a block. Inside one slice
    (side 2) each pair comes once; across slices low meets high.
    """
    n = len(block)
    if n < 2:
        return
    cut = np.flatnonzero(np.diff(block)) + 1
    start = np.repeat(np.concatenate([[0], cut]), np.diff(np.concatenate([[0], cut, [n]])))
    end = np.repeat(np.concatenate([cut, [n]]), np.diff(np.concatenate([[0], cut, [n]])))
    at = np.arange(n)
    # a row meets the rows from `first` to the end of its block
    highs = np.concatenate([[0], np.cumsum(side == 1)])
    first = np.where(side == 2, at + 1, end - (highs[end] - highs[start]))
    many = np.where(side == 1, 0, end - first)
    rows = np.flatnonzero(many > 0)
    if not len(rows):
        return
    total = np.cumsum(many[rows])
    lo = 0
    while lo < len(rows):
        base = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, base + chunk, side="right")))
        r = rows[lo:hi]
        m = many[r]
        i = np.repeat(r, m)
        j = np.repeat(first[r], m) + (np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m))
        yield i, j
        lo = hi


def forest(i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, root id) of each linked id but the roots; the root is the smallest id linked."""
    names, code = np.unique(np.concatenate([ids[i], ids[j]]), return_inverse=True)
    a, b = code[: len(i)], code[len(i):]
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    other = root != np.arange(len(names))
    return names[other], names[root[other]]
