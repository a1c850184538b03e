"""Near-duplicate embeddings by random-hyperplane sign hashing.

Each vector gets one bit string per table: the signs of its products with
random directions. Vectors of one label that agree in a whole bit string meet
in a block, where the cosine is computed on the original vectors. A pair that
meets in several tables counts in the first of them, so link counts are exact
for all pairs found. Chance of finding a pair at cosine 0.98 with 10 bits and
24 tables: 1 - (1 - 0.936^10)^24, about 0.999999.

Equal vectors of one label are compared once, as a class with a weight.

Defined results: one row per input row. A vector that is null, empty, zero or
holds null or non-finite parts, a null label or a null id links with nothing
(``n_links`` 0, ``component_id`` its own id). Vectors of different length do not
link. Rows that repeat an id are separate vectors with one name: links between
them are counted, the component has the smallest id. An empty table gives no
rows. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditspine.llm.blocks import deal, forest, pairs
from creditspine.llm.common import shards, store, usable_vectors
from creditspine.llm.components import components


def sign_keys(vectors: np.ndarray, tables: int, bits: int, seed: int) -> np.ndarray:
    """(rows, tables) integers: the sign bits of ``bits`` directions per table."""
    planes = np.random.default_rng([seed, vectors.shape[1]]).normal(size=(vectors.shape[1], tables * bits))
    signs = (vectors @ planes >= 0).reshape(len(vectors), tables, bits)
    return (signs * (1 << np.arange(bits))).sum(axis=2).astype(np.int32)


def hashed(classes: DataFrame, tables: int, bits: int, seed: int) -> DataFrame:
    """Classes with the vector as bytes of doubles and its key in every table."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, part in frame.groupby(frame["vec"].map(len), sort=True):
                v = np.stack(part["vec"].to_list()).astype(np.float64)
                keys = sign_keys(v, tables, bits, seed)
                yield pd.DataFrame({
                    "rep": part["rep"].to_numpy(), "weight": part["weight"].to_numpy(), "label": part["label"].to_numpy(),
                    "dims": v.shape[1], "vec": [x.tobytes() for x in v], "keys": list(keys),
                })

    return classes.mapInPandas(run, "rep long, weight long, label string, dims int, vec binary, keys array<int>")


def _met_before(keys: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    same = keys[i] == keys[j]
    return (same & (np.arange(keys.shape[1]) < table[i][:, None])).any(axis=1)


def _compare(rows: pd.DataFrame, least: float) -> pd.DataFrame:
    """(id, root, links): link weights per class, and a forest of the links."""
    rows = rows.sort_values(["_block", "_side"], kind="stable")
    ids, weight, table = (rows[c].to_numpy() for c in ("rep", "weight", "table"))
    block, side, dims = (rows[c].to_numpy() for c in ("_block", "_side", "dims"))
    keys = np.stack(rows["keys"].to_list())
    # vectors of one block have one length; shorter ones are padded with zeros
    v = np.zeros((len(rows), dims.max()))
    for d in np.unique(dims):
        own = np.flatnonzero(dims == d)
        v[own, :d] = np.frombuffer(b"".join(rows["vec"].iloc[own]), dtype=np.float64).reshape(len(own), d)
    # scaled by the largest part, so no square leaves the range of doubles
    v /= np.abs(v).max(axis=1, keepdims=True)
    v /= np.sqrt((v * v).sum(axis=1, keepdims=True))
    links = np.zeros(len(rows))
    left, right = [], []
    for i, j in pairs(block, side, 1 << 15):
        near = np.einsum("ij,ij->i", v[i], v[j]) >= least
        i, j = i[near], j[near]
        new = ~_met_before(keys, table, i, j) & (ids[i] != ids[j])
        i, j = i[new], j[new]
        np.add.at(links, i, weight[j])
        np.add.at(links, j, weight[i])
        left.append(i)
        right.append(j)
    i = np.concatenate(left) if left else np.array([], dtype=int)
    j = np.concatenate(right) if right else np.array([], dtype=int)
    child, root = forest(i, j, ids) if len(i) else (ids[:0], ids[:0])
    some = np.flatnonzero(links)
    return pd.DataFrame({
        "id": np.concatenate([ids[some], child]), "root": np.concatenate([ids[some], root]),
        "links": np.concatenate([links[some].astype(np.int64), np.zeros(len(child), dtype=np.int64)]),
    })


def embedding_groups(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                     least: float = 0.98, tables: int = 24, bits: int = 10, seed: int = 7) -> DataFrame:
    """(id_col, n_links, component_id, kept) for every row; ``kept`` marks the smallest id of a component."""
    base = df.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
        F.when(usable_vectors(df, id_col, vec_col) & F.col(label_col).isNotNull(),
               F.transform(F.col(vec_col), lambda x: x.cast("double") + F.lit(0.0))).alias("vec"),
    )
    # a class: equal vectors of one label
    key = F.when(F.col("vec").isNotNull(), F.struct("label", "vec"))
    rows = store(base.withColumn("class", F.md5(F.to_json(key))))
    classes = (
        rows.where("vec is not null").groupBy("class", "label", "vec")
        .agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("weight"))
        .withColumn("rep", F.xxhash64("class"))
    )
    classes = store(classes)
    coded = store(hashed(classes.select("rep", "weight", "label", "vec"), tables, bits, seed))
    members = coded.select("rep", "weight", "dims", "vec", "keys", "label", F.posexplode("keys").alias("table", "key"))
    members = members.withColumn("bucket", F.xxhash64("table", "key", "label", "dims")).drop("key", "label")
    sizes = store(coded.select("label", "dims", F.posexplode("keys").alias("table", "key"))
                  .groupBy(F.xxhash64("table", "key", "label", "dims").alias("bucket"))
                  .agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    dealt = deal(members, "bucket", "rep", sizes, shards(sizes.agg(F.sum("n")).first()[0] or 0, 4096))

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        return _compare(part, least)

    found = store(dealt.groupBy("_shard").applyInPandas(compare, "id long, root long, links long"))
    named = classes.select("rep", "low")
    counts = found.where("links > 0").groupBy("id").agg(F.sum("links").alias("links"))
    edges = (
        found.where("id <> root").join(named.select(F.col("rep").alias("id"), F.col("low").alias("a")), "id")
        .join(named.select(F.col("rep").alias("root"), F.col("low").alias("b")), "root").select("a", "b")
    )
    if rows.count() != rows.select("id").distinct().count():
        # an id with several vectors joins their classes
        edges = edges.unionAll(rows.join(classes.select("class", "low"), "class").select(F.col("id").alias("a"), F.col("low").alias("b")))
    joined = components(edges, "a", "b")
    summary = store(
        classes.join(counts, classes["rep"] == counts["id"], "left").drop("id")
        .join(joined, classes["low"] == joined["node"], "left")
        .select("class", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("component", "low").alias("component_id"))
    )
    out = rows.select("id", "class").join(summary, "class", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"), (component == F.col("id")).alias("kept"),
    )


def recall_bound(cosine: float, tables: int, bits: int) -> float:
    """Chance that a pair at this cosine meets in some table."""
    p = 1 - np.arccos(cosine) / np.pi
    return 1 - (1 - p ** bits) ** tables


