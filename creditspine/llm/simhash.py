"""SimHash near-duplicates through deletion-variant signatures.

A 64-bit fingerprint is cut into ``max_distance // 2 + 1`` segments, so of two
fingerprints within the distance at least one segment differs in at most one
bit. Every segment is indexed once per bit position with that bit wiped: two
segments that differ in at most one bit then share a variant. Equal variants
meet in an equality join and the whole distance is verified.

Defined results: a null, empty or blank text has fingerprint zero and links
like any other; a row with a null id takes no part; rows that repeat an id are
compared text by text, and the id joins the components of all its texts. An
empty table gives no rows. Only the two named columns are read, so further
columns may bear any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditspine.llm.blocks import deal, forest, pairs
from creditspine.llm.common import shards, store
from creditspine.llm.components import components

SEED = 42
BITS = 64
#: Hashes whose bits are counted at a time; bounds the memory of a long text.
CHUNK = 1 << 14
#: Largest table (of two longs) that is broadcast.
BROADCAST_ROWS = 500_000


def fingerprint(text: str | None, width: int) -> int:
    """Unsigned fingerprint of one text: bit set if set in over half the shingle hashes."""
    # bytes.lower() and bytes.split() know exactly A-Z and [\x20\x09-\x0D]
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < width:
        shingles = iter([b" ".join(words)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*[words[k:] for k in range(width)]))
        n = len(words) - width + 1
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype="<u8", count=n)
    ones = np.zeros(BITS, dtype=np.int64)
    for lo in range(0, n, CHUNK):
        part = hashes[lo:lo + CHUNK]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id_col, fp, text_hash): one signed 64-bit fingerprint per row with an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            fp = np.fromiter((fingerprint(t.as_py(), width) for t in texts), dtype="<u8", count=len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view("<i8")), batch.column(2)], names=[id_col, "fp", "text_hash"])

    text = F.col(text_col).cast("string")
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), text, text_hash(text))
    return rows.mapInArrow(run, f"`{id_col}` long, fp long, text_hash long")


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def variant_masks(max_distance: int) -> list[int]:
    """Signed masks: one per segment and wiped bit, keeping the rest of the segment."""
    n = max_distance // 2 + 1
    edges = [BITS * k // n for k in range(n + 1)]
    out = []
    for lo, hi in zip(edges, edges[1:]):
        whole = ((1 << (hi - lo)) - 1) << lo
        out += [whole & ~(1 << bit) for bit in range(lo, hi)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in out]


def linked_fingerprints(distinct: DataFrame, max_distance: int) -> DataFrame:
    """(a, b): a forest that joins the same fingerprints as all links within the distance.

    ``distinct`` holds each fingerprint once, in column ``fp``. A variant held
    by two fingerprints is their pair; one held by more goes to blocks.
    """
    masks = variant_masks(max_distance)
    # each fingerprint becomes many rows: spread them before that
    spread = distinct.select("fp").repartition(shards(distinct.count(), 16384), "fp")
    variants = spread.select("fp", F.posexplode(F.array(*[F.lit(m) for m in masks])).alias("v", "mask")).select(
        F.xxhash64("v", F.col("fp").bitwiseAND(F.col("mask"))).alias("variant"), "fp"
    )
    held = store(
        variants.groupBy("variant").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        .where("n > 1")
    )
    distance = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    twos = held.where("n = 2").where(distance <= max_distance).select("a", "b").distinct()

    many = held.where("n > 2").select("variant", "n")
    n_many, members = many.agg(F.count(F.lit(1)), F.sum("n")).first()
    # a list of shared variants of bounded size is sent to the variants; a longer one is shuffled with them
    many = F.broadcast(many) if n_many <= BROADCAST_ROWS else many
    dealt = deal(variants, "variant", "fp", many, shards(members or 0, 2048))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_block", "_side"], kind="stable")
        fp = rows["fp"].to_numpy()
        left, right = [], []
        for i, j in pairs(rows["_block"].to_numpy(), rows["_side"].to_numpy(), 1 << 20):
            near = np.bitwise_count((fp[i] ^ fp[j]).view(np.uint64)) <= max_distance
            left.append(i[near])
            right.append(j[near])
        if not left:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        a, b = forest(np.concatenate(left), np.concatenate(right), fp)
        return pd.DataFrame({"a": a, "b": b})

    found = dealt.select("_shard", "_block", "_side", "fp").groupBy("_shard").applyInPandas(compare, "a long, b long")
    return twos.unionAll(found)


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   width: int = 3, max_distance: int = 2) -> DataFrame:
    """(id_col, fp, component_id): the smallest id reachable over links, for each row."""
    rows = store(fingerprints(docs, id_col, text_col, width).drop("text_hash"))
    # a fingerprint class stands for all its copies; its name is its smallest id
    classes = store(rows.groupBy("fp").agg(F.min(id_col).alias("rep")))
    links = store(linked_fingerprints(classes, max_distance))
    ends = links.join(classes.select(F.col("fp").alias("a"), F.col("rep").alias("ra")), "a").join(
        classes.select(F.col("fp").alias("b"), F.col("rep").alias("rb")), "b"
    )
    edges = ends.select("ra", "rb")
    if rows.count() != rows.select(id_col).distinct().count():
        # an id with several texts joins their classes
        edges = edges.unionAll(rows.join(classes, "fp").select(F.col(id_col).alias("ra"), F.col("rep").alias("rb")))
    found = components(edges, "ra", "rb")
    named = store(
        classes.join(found, classes["rep"] == found["node"], "left")
        .select("fp", F.coalesce("component", "rep").alias("component_id"))
    )
    return rows.join(named, "fp").select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, max_distance: int = 2) -> DataFrame:
    """One row of each group of near copies, columns as before; rows with a null id stay.

    Groups follow from the texts alone, so rows that repeat an id with unlike
    texts all stay. The row with the smallest id stays; of rows of a group that
    repeat this id the one with the smallest hash of its text, and of rows equal
    in both the one whose other columns sort first.
    """
    rows = store(fingerprints(docs, id_col, text_col, width))
    links = store(linked_fingerprints(rows.select("fp").distinct(), max_distance))
    group = components(links, "a", "b").select(F.col("node").alias("fp"), F.col("component").alias("group"))
    held = store(rows.groupBy("fp", id_col, "text_hash").agg(F.count(F.lit(1)).alias("n")).join(group, "fp", "left").select(
        F.coalesce("group", "fp").alias("group"), F.col(id_col).alias("_held_id"), F.col("text_hash").alias("_held_hash"), "n"))
    # partial minima first, so a large group travels as one row per task
    first = held.groupBy("group").agg(F.min(F.struct("_held_id", "_held_hash")).alias("first"))
    gone = held.join(first, "group").where(F.struct("_held_id", "_held_hash") != F.col("first")).select("_held_id", "_held_hash").distinct()

    def held_in(keys: DataFrame) -> Column:
        return (docs[id_col].cast("long") == keys["_held_id"]) & (text_hash(docs[text_col].cast("string")) == keys["_held_hash"])

    out = docs.join(gone, held_in(gone), "left_anti")
    again = store(held.where("n > 1").select("_held_id", "_held_hash").distinct())
    if again.isEmpty():
        return out
    columns = [F.col(f"`{c}`") for c in docs.columns]
    order = Window.partitionBy(id_col, text_hash(F.col(text_col).cast("string"))).orderBy(*columns)
    some = out.join(again, held_in(again), "left_semi").select(F.struct(*columns).alias("row"), F.row_number().over(order).alias("first"))
    return some.where("first = 1").select("row.*").unionAll(out.join(again, held_in(again), "left_anti"))
