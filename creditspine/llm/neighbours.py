"""Nearest neighbours by multi-probe p-stable hashing.

A table floors ``(a . v + b) / w`` for ``hashes`` Gaussian directions. A query
looks in its own bucket and in perturbed ones (one step down or up in some
coordinates), in the order of their estimated success: the sum of squared
distances of the query to the crossed cell edges. The width ``w`` is ``spread``
times the median distance to the k-th neighbour in a bounded sample of
``sample_rows`` vectors; every vector is indexed.

Hot buckets are cut into slices of ``slice_rows`` on different tasks, and a task
gives back at most ``k`` rows per query. A query that finds fewer than ``k``
neighbours is compared with every vector, in blocks.

Defined results: null, empty, zero or non-finite vectors and null ids take no
part. Rows that repeat an id are one candidate, at its smallest distance; a
query's own id is never its neighbour. Vectors of another length than the query
are no candidates. Ties go to the smaller id. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditspine.llm.common import shards, store, usable_vectors


def perturbations(x: np.ndarray, n: int) -> list[tuple[int, ...]]:
    """The ``n`` best sets of steps for offsets ``x`` in [0, 1): j < m is a step down, j - m one up."""
    m = len(x)
    cost = np.concatenate([x * x, (1 - x) * (1 - x)])
    order = np.argsort(cost, kind="stable")
    z = cost[order].tolist()
    steps = order.tolist()
    out: list[tuple[int, ...]] = [()]
    heap = [(z[0], (0,))]
    while heap and len(out) < n:
        score, chosen = heapq.heappop(heap)
        own = tuple(steps[k] for k in chosen)
        if len({j % m for j in own}) == len(own):
            out.append(own)
        last = chosen[-1] + 1
        if last < 2 * m:
            heapq.heappush(heap, (score - z[last - 1] + z[last], (*chosen[:-1], last)))
            heapq.heappush(heap, (score + z[last], (*chosen, last)))
    return out


class Tables:
    """Directions, offsets and bucket numbers for vectors of one length."""

    def __init__(self, dims: int, tables: int, hashes: int, width: float, seed: int):
        rng = np.random.default_rng([seed, dims])
        self.dims, self.tables, self.hashes, self.width = dims, tables, hashes, width
        self.a = rng.normal(size=(dims, tables * hashes))
        self.b = rng.uniform(0, width, tables * hashes)
        # random odd numbers mix the cells of a table to one bucket number
        self.mix = rng.integers(1 << 62, size=(tables, hashes), dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self.salt = rng.integers(1 << 62, size=tables, dtype=np.int64).astype(np.uint64)

    def cells(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = ((v @ self.a + self.b) / self.width).reshape(len(v), self.tables, self.hashes)
        low = np.floor(p)
        return low.astype(np.int64), p - low

    def buckets(self, cells: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((cells.astype(np.uint64) * self.mix).sum(axis=-1) + self.salt).astype(np.int64)

    def probes(self, v: np.ndarray, n: int) -> np.ndarray:
        """Bucket numbers to look in, for one vector."""
        low, offset = (x[0] for x in self.cells(v[None]))
        own = self.buckets(low[None])[0].astype(np.uint64)
        out = []
        with np.errstate(over="ignore"):
            for t in range(self.tables):
                step = np.concatenate([np.uint64(0) - self.mix[t], self.mix[t]])
                for steps in perturbations(offset[t], n):
                    out.append(own[t] + sum((step[j] for j in steps), np.uint64(0)))
        return np.unique(np.array(out, dtype=np.uint64).astype(np.int64))


def _by_length(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for frame in frames:
        for _, part in frame.groupby(frame["vec"].map(len), sort=True):
            yield part, np.frombuffer(b"".join(part["vec"]), dtype=np.float64).reshape(len(part), -1)


def _nearest(data: pd.DataFrame, asked: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest of each query among the rows of the buckets it asks for, in one shard."""
    out_q, out_v, out_d = [], [], []
    if len(data) and len(asked):
        data = data.sort_values("part", kind="stable")
        part, ids = data["part"].to_numpy(), data["vec_id"].to_numpy()
        length = data["vec"].map(len).to_numpy()
        for n in np.unique(length):
            own = np.flatnonzero(length == n)
            v = np.frombuffer(b"".join(data["vec"].iloc[own]), dtype=np.float64).reshape(len(own), -1)
            p, names, rows, norm = part[own], ids[own], data["row"].to_numpy()[own], (v * v).sum(axis=1)
            single = len(np.unique(names)) == len(np.unique(rows))
            for query, vec, parts in zip(asked["query_id"], asked["vec"], asked["parts"]):
                if len(vec) != n:
                    continue
                lo, hi = np.searchsorted(p, parts, "left"), np.searchsorted(p, parts, "right")
                spans = [np.arange(a, b) for a, b in zip(lo, hi) if a < b]
                if not spans:
                    continue
                at = np.concatenate(spans)
                at = at[names[at] != query]
                at = at[np.unique(rows[at], return_index=True)[1]]  # a row comes once a table
                if not len(at):
                    continue
                q = np.frombuffer(vec, dtype=np.float64)
                if len(at) > 4 * k and single:
                    # the fast product ranks roughly; its error is far below the slack kept
                    rough = norm[at] - 2 * (v[at] @ q)
                    most = np.partition(rough, 4 * k - 1)[4 * k - 1]
                    at = at[rough <= most + 1e-9 * (norm[at].max() + q @ q)]
                exact = np.sqrt(((v[at] - q) ** 2).sum(axis=1))
                order = np.lexsort((names[at], exact))
                _, first = np.unique(names[at][order], return_index=True)
                best = order[np.sort(first)[:k]]
                out_q.append(np.full(len(best), query))
                out_v.append(names[at][best])
                out_d.append(exact[best])
    if not out_q:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
    return pd.DataFrame({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_v), "score": np.concatenate(out_d)})


def _search(data: DataFrame, asked: DataFrame, queries: DataFrame, k: int, n_shards: int) -> DataFrame:
    """``data`` (part, vec_id, vec) and ``asked`` (query_id, part) meet by shards of parts."""
    shard = F.pmod(F.xxhash64("part"), F.lit(n_shards)).cast("int")
    wanted = asked.withColumn("shard", shard).groupBy("query_id", "shard").agg(F.sort_array(F.collect_set("part")).alias("parts"))
    wanted = wanted.join(queries.select("query_id", "vec"), "query_id")

    def nearest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _nearest(left, right, k)

    data = data.withColumn("shard", shard).withColumn("row", F.xxhash64("vec_id", "vec"))
    return data.groupBy("shard").cogroup(wanted.groupBy("shard")).applyInPandas(
        nearest, "query_id long, vec_id long, score double"
    )


def nearest_neighbours(df: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10,
                       tables: int = 6, hashes: int = 10, probes: int = 500, spread: float = 2.0,
                       sample_rows: int = 2000, slice_rows: int = 2048, seed: int = 11) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest rows found by Euclidean distance."""
    pack = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    rows = df.where(usable_vectors(df, id_col, vec_col)).select(
        F.col(id_col).cast("long").alias("vec_id"), pack.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks")
    )

    def as_bytes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"vec_id": f["vec_id"], "vec": [np.asarray(v, dtype=np.float64).tobytes() for v in f["v"]], "asks": f["asks"]})

    rows = store(rows.mapInPandas(as_bytes, "vec_id long, vec binary, asks boolean"))
    total = rows.count()
    width = spread * _scale(rows, total, k, sample_rows)

    def index(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, v in _by_length(frames):
            t = Tables(v.shape[1], tables, hashes, width, seed)
            yield pd.DataFrame({"vec_id": part["vec_id"].to_numpy(), "vec": part["vec"].to_numpy(), "buckets": list(t.buckets(t.cells(v)[0]))})

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, v in _by_length(frames):
            t = Tables(v.shape[1], tables, hashes, width, seed)
            yield pd.DataFrame({"query_id": part["query_id"].to_numpy(), "buckets": [t.probes(x, probes) for x in v]})

    indexed = store(rows.select("vec_id", "vec").mapInPandas(index, "vec_id long, vec binary, buckets array<long>"))
    queries = store(rows.where("asks").select(F.col("vec_id").alias("query_id"), "vec").dropDuplicates(["query_id"]))
    sizes = store(
        indexed.select(F.explode("buckets").alias("bucket")).groupBy("bucket")
        .agg(F.ceil(F.count(F.lit(1)) / slice_rows).cast("int").alias("slices"))
    )
    hot = sizes.where("slices > 1")
    data = indexed.select("vec_id", "vec", F.explode("buckets").alias("bucket")).join(hot, "bucket", "left").select(
        F.xxhash64("bucket", F.pmod(F.xxhash64("vec_id"), F.coalesce("slices", F.lit(1))).cast("int")).alias("part"), "vec_id", "vec"
    )
    asked = queries.mapInPandas(ask, "query_id long, buckets array<long>").select(
        "query_id", F.explode("buckets").alias("bucket")
    ).join(sizes, "bucket").select(
        "query_id", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "bucket"
    ).select("query_id", F.xxhash64("bucket", "slice").alias("part"))
    n_shards = shards(total * tables, 4 * slice_rows)
    found = store(_search(data, asked, queries, k, n_shards))

    least = min(k, total - 1)
    counts = found.groupBy("query_id").agg(F.count_distinct("vec_id").alias("found"))
    short = store(queries.join(counts, "query_id", "left").where(F.coalesce("found", F.lit(0)) < least).select("query_id", "vec"))
    if short.limit(1).count():
        # too few neighbours in the buckets: all vectors, in blocks
        n_blocks = shards(total, slice_rows)
        whole = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).alias("part"), "vec_id", "vec")
        every = short.select("query_id", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).cast("long").alias("part"))
        found = found.unionAll(_search(whole, every, short, k, n_blocks))
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _scale(rows: DataFrame, total: int, k: int, sample_rows: int) -> float:
    """Median distance to the k-th neighbour in a sample of about ``sample_rows`` vectors."""
    share = min(1.0, sample_rows / max(total, 1))
    picked = rows.where(F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1_000_000)) < int(share * 1_000_000))
    vecs = [r["vec"] for r in picked.select("vec").limit(2 * sample_rows).collect()]
    if not vecs:
        return 1.0
    size = max(set(map(len, vecs)), key=lambda n: sum(len(v) == n for v in vecs))
    v = np.stack([np.frombuffer(x, dtype=np.float64) for x in vecs if len(x) == size])
    if len(v) < 3:
        return 1.0
    some = v[: 200]
    d = np.sqrt(np.maximum(((some ** 2).sum(1)[:, None] + (v ** 2).sum(1)[None] - 2 * some @ v.T), 0))
    d.sort(axis=1)
    scale = float(np.median(d[:, min(k, len(v) - 1)]))
    return scale if np.isfinite(scale) and scale > 0 else 1.0
