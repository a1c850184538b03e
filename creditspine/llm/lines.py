"""Line dedup with a sharded minimal perfect hash.

Every distinct line key has a 64-bit hash. Hashes are dealt to shards; a shard
gets a minimal perfect hash (levels of bit arrays: a key stays at the first
level where its bit is its own, its index is the rank of that bit), and at that
index a 16-bit fingerprint and the number of documents. Documents send the
hashes of their lines to the shards, probe the arrays there, and get back the
hashes that are too frequent; lines are never joined to lines. A shard with many
probes is copied to several tasks, so a line that a third of all documents hold
is probed on many.

A line is what stands between newlines. Its key is the line without
``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased. Keys of at least ``min_chars``
characters in at least ``min_docs`` documents lose all their lines.

Defined results: a null or empty text is one empty line; if that line goes, the
text is empty. Every row counts as a document, also one that repeats an id or
has none. An empty table gives no rows. All input columns are kept, only the
text is replaced; ``n_lines`` and ``n_dropped`` stand beside them in a struct.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from creditspine.llm.common import BLANK, shards, store

PAD = BLANK.encode()
LEVELS = 32
#: Bits of a level for each key that is still to be placed.
SPARE = 2


def line_hashes(text: str | None, min_chars: int) -> list[int | None]:
    """The signed 64-bit hash of the key of each line; None for keys that are too short."""
    out = []
    for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n"):
        key = line.strip(PAD).lower()  # bytes.lower() knows A-Z alone
        n = len(key) if min_chars <= 1 else len(key.decode("utf-8", "surrogatepass"))
        h = xxhash.xxh3_64_intdigest(key)
        out.append(None if n < min_chars else h - (1 << 64) if h >> 63 else h)
    return out


def _spread(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    """Place of each key at a level."""
    with np.errstate(over="ignore"):
        x = keys ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(31))) % np.uint64(bits)


def build_index(hashes: np.ndarray, counts: np.ndarray) -> dict:
    """Arrays of one shard from its distinct hashes and their counts."""
    keys = hashes.view(np.uint64)
    left = np.arange(len(keys))
    slot = np.full(len(keys), -1, dtype=np.int64)
    sizes, taken, placed = [], [], 0
    for level in range(LEVELS):
        if not len(left):
            break
        bits = SPARE * len(left)
        at = _spread(keys[left], level, bits)
        alone = np.bincount(at.astype(np.int64), minlength=bits) == 1
        own = alone[at]
        rank = np.cumsum(alone) - 1 + placed
        slot[left[own]] = rank[at[own]]
        placed += int(alone.sum())
        sizes.append(bits)
        taken.append(alone)
        left = left[~own]
    # hashes that never found a place of their own; two rounds in a billion shards
    rest = left[np.argsort(keys[left])]
    slot[rest] = placed + np.arange(len(rest))
    prints, numbers = np.empty(len(keys), dtype="<u2"), np.empty(len(keys), dtype="<u4")
    prints[slot] = (keys >> np.uint64(48)).astype(np.uint16)
    numbers[slot] = np.minimum(counts, 2**32 - 1)
    return {"sizes": np.array(sizes, dtype="<i8").tobytes(),
            "bits": np.packbits(np.concatenate(taken)).tobytes() if taken else b"",
            "rest": keys[rest].tobytes(), "prints": prints.tobytes(), "numbers": numbers.tobytes()}


def probe(index: dict, hashes: np.ndarray) -> np.ndarray:
    """Count of each hash by the arrays of its shard; 0 if the fingerprint says it is not there."""
    keys = hashes.view(np.uint64)
    sizes = np.frombuffer(index["sizes"], dtype="<i8")
    bits = np.unpackbits(np.frombuffer(index["bits"], dtype=np.uint8), count=int(sizes.sum())).astype(bool)
    rank = np.cumsum(bits) - 1
    slot = np.full(len(keys), -1, dtype=np.int64)
    left, base = np.arange(len(keys)), 0
    for level, size in enumerate(sizes.tolist()):
        at = _spread(keys[left], level, size).astype(np.int64) + base
        own = bits[at]
        slot[left[own]] = rank[at[own]]
        left, base = left[~own], base + size
    rest = np.frombuffer(index["rest"], dtype="<u8")
    if len(rest) and len(left):
        at = np.minimum(np.searchsorted(rest, keys[left]), len(rest) - 1)
        same = rest[at] == keys[left]
        slot[left[same]] = int(bits.sum()) + at[same]
    prints, numbers = np.frombuffer(index["prints"], dtype="<u2"), np.frombuffer(index["numbers"], dtype="<u4")
    if not len(numbers):
        return np.zeros(len(keys), dtype=np.int64)
    right = (slot >= 0) & (prints[slot] == (keys >> np.uint64(48)).astype(np.uint16))
    return np.where(right, numbers[slot], 0).astype(np.int64)


INDEX = "shard int, probes long, sizes binary, bits binary, rest binary, prints binary, numbers binary"


def line_index(counts: DataFrame, n_shards: int) -> DataFrame:
    """One row of arrays per shard from (h, n); ``probes`` is the sum of the counts."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        built = build_index(frame["h"].to_numpy(), frame["n"].to_numpy())
        return pd.DataFrame([{"shard": int(frame["shard"].iloc[0]), "probes": int(frame["n"].sum()), **built}])

    return counts.withColumn("shard", F.pmod("h", F.lit(n_shards)).cast("int")).groupBy("shard").applyInPandas(run, INDEX)


def _row_key(columns: list[str], text: Column) -> Column:
    """Names a row by its content: rows alike in all columns get the same lines."""
    return F.unhex(F.md5(F.concat_ws("\x01", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x02")) for c in columns], F.md5(text))))


def dedup_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_docs: int = 10, min_chars: int = 1,
                shard_keys: int = 2048) -> DataFrame:
    """(row, text, n_lines, n_dropped): ``row`` is a struct of the input, ``text`` what stays of its text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       _row_key([id_col], text).alias("key"), text.alias("text"))

    def hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines = [list({h for h in line_hashes(t.as_py(), min_chars) if h is not None}) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lines, type=pa.list_(pa.int64()))], names=["key", "lines"])

    hashed = store(rows.select("key", "text").mapInArrow(hash_lines, "key binary, lines array<long>"))
    counts = store(hashed.select(F.explode("lines").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n")))
    distinct, total = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
    n_shards = shards(distinct, shard_keys)
    index = store(line_index(counts, n_shards))

    # a shard with more probes than one block is copied; fewer than 4096 shards can have so many
    block = max(2 * shard_keys, (total or 0) // 4096)
    copies = F.ceil(F.col("probes") / block).cast("int")
    hot = F.broadcast(index.where(F.col("probes") > block).select("shard", copies.alias("copies")))
    probes = hashed.select("key", F.explode("lines").alias("h")).withColumn("shard", F.pmod("h", F.lit(n_shards)).cast("int"))
    probes = probes.join(hot, "shard", "left").withColumn(
        "copy", F.pmod(F.xxhash64("key"), F.coalesce("copies", F.lit(1))).cast("int")).drop("copies")
    copied = index.withColumn("copy", F.explode(F.sequence(F.lit(0), F.greatest(copies, F.lit(1)) - 1))).drop("probes")

    def look(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"key": [], "h": []})
        often = probe(right.iloc[0].to_dict(), left["h"].to_numpy()) >= min_docs
        return left.loc[often, ["key", "h"]]

    found = probes.groupBy("shard", "copy").cogroup(copied.groupBy("shard", "copy")).applyInPandas(look, "key binary, h long")
    dropped = store(found.groupBy("key").agg(F.collect_set("h").alias("gone")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, n_lines, n_dropped = [], [], []
            for t, gone in zip(b.column("text"), b.column("gone")):
                t = t.as_py()
                gone = set(gone.as_py() or ())
                lines = t.split("\n")
                keep = lines if not gone else [x for x, h in zip(lines, line_hashes(t, min_chars)) if h not in gone]
                out.append("\n".join(keep))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(keep))
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(out, type=pa.string()), pa.array(n_lines, type=pa.int64()),
                                              pa.array(n_dropped, type=pa.int64())], names=["row", "text", "n_lines", "n_dropped"])

    # the text travels once; in ``row`` it is left out
    slim = rows.withColumn("row", F.col("row").dropFields(f"`{text_col}`")) if len(docs.columns) > 1 else rows.withColumn("row", F.struct(F.lit(0).alias("none")))
    met = slim.join(dropped, "key", "left").select("row", "text", "gone")
    out = StructType([met.schema["row"]]).add("text", "string").add("n_lines", "long").add("n_dropped", "long")
    return met.mapInArrow(cut, out)


def drop_common_lines(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents with the lines that stay, columns as before."""
    out = dedup_lines(docs, text_col, **options)
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
