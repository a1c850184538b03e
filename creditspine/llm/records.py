"""Token ids as length-delimited binary records, with an index of offsets.

A frame is: payload length (64 bits), masked checksum of these 8 bytes, the
payload, masked checksum of the payload, one newline. Numbers are little-endian,
checksums CRC-32, masked by a turn of 15 bits and a constant so that a checksum
of data that holds checksums stays strong. The payload is: flag byte (1: id is
null), id (64 bits), bytes per token (2 or 4), number of tokens (32 bits), ids.

Spark's own text writer stores the frames, byte for byte, so any file system
works and a lost task is written again. Files follow each other in ascending
order of id: by the number of the task, then of the file, that stand in their
names. The index, a Parquet table written from the files as they are read back
and checked, has one row per record: file and its numbers, offset, length, id,
tokens ahead in the file, tokens and their checksum.

Defined results: a null or empty text is a record that holds the end id. Null
ids come first; rows that repeat an id are records of their own, in order of
a hash of their texts, and may lie in several tasks. An empty table gives no
records. Only the named columns are read. A file holds ``per_file`` records and
is read whole, so these must stay below two gigabytes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditspine.llm.tokens import encoder

#: The constant added to a turned checksum, the sizes of the parts.
MASK = 0xA282EAD8
HEAD = struct.Struct("<QI")
FIELDS = struct.Struct("<BqBI")
SLICE = 128
#: Where Spark's writers put the numbers of task and file in a file's name.
FILE_NUMBERS = {"task": r"part-(\d+)", "number": r"-c(\d+)"}


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes) -> bytes:
    """One record without its closing newline; ``ids`` are 32-bit numbers."""
    numbers = np.frombuffer(ids, dtype="<u4")
    width = 2 if len(numbers) == 0 or numbers.max() < 1 << 16 else 4
    body = numbers.astype("<u2").tobytes() if width == 2 else ids
    payload = FIELDS.pack(doc_id is None, doc_id or 0, width, len(numbers)) + body
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def unframe(data: bytes | memoryview, at: int) -> tuple[int | None, np.ndarray, int]:
    """(id, token ids, next offset) of the record at an offset; damage raises."""
    length, check = HEAD.unpack_from(data, at)
    if masked(bytes(data[at:at + 8])) != check:
        raise ValueError(f"damaged record length at {at}")
    at += HEAD.size
    payload = bytes(data[at:at + length])
    at += length
    if masked(payload) != struct.unpack_from("<I", data, at)[0] or bytes(data[at + 4:at + 5]) != b"\n":
        raise ValueError(f"damaged record before {at}")
    null, doc_id, width, n = FIELDS.unpack_from(payload)
    ids = np.frombuffer(payload, dtype=f"<u{width}", count=n, offset=FIELDS.size)
    return None if null else doc_id, ids, at + 5


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                  text_col: str = "text", per_file: int = 4096) -> None:
    """Encode every row and write ``folder/data`` and ``folder/index``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode_many
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                out = [frame(k, ids + end) for k, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist()))]
                yield pa.RecordBatch.from_arrays([pa.array(out, type=pa.binary())], names=["frame"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # an id that many rows repeat is dealt over several tasks
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text").asc()]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    frames = dealt.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value"))
    frames.write.option("maxRecordsPerFile", per_file).option("lineSep", "\n").text(f"{folder}/data")
    numbers = [F.regexp_extract("file", pattern, 1).cast("long").alias(name) for name, pattern in FILE_NUMBERS.items()]
    parsed(docs.sparkSession, folder, with_ids=False).drop("ids").select("*", *numbers).write.parquet(f"{folder}/index")


def files(spark: SparkSession, folder: str) -> DataFrame:
    read = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    return read.load(f"{folder}/data").select("path", "content")


def parsed(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Every record in the files: (file, offset, length, id, before, n_tokens, ids_crc32, ids).

    ``before`` counts the tokens of the same file ahead of the record; without
    ``with_ids`` the ids are checked and left out.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in frames:
            for path, data in zip(some["path"], some["content"]):
                rows, at, before = [], 0, 0
                while at < len(data):
                    doc, ids, end = unframe(data, at)
                    wide = ids.astype("<u4").tobytes()
                    rows.append((path.rsplit("/", 1)[1], at, end - at, doc, before, len(ids), zlib.crc32(wide), wide if with_ids else None))
                    before += len(ids)
                    at = end
                    if len(rows) == SLICE:
                        yield _table(rows, RECORD)
                        rows = []
                if rows:
                    yield _table(rows, RECORD)

    return files(spark, folder).mapInPandas(run, RECORD)


RECORD = "file string, offset long, length long, id long, before long, n_tokens long, ids_crc32 long, ids binary"


def _table(rows: list[tuple], schema: str) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
    out["id"] = out["id"].astype("Int64")
    return out


def read_records(spark: SparkSession, folder: str, id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """(id_col, start, n_tokens, ids_crc32, ids) from the files; ``start`` counts all tokens ahead."""
    index = spark.read.parquet(f"{folder}/index")
    # one row per file, in the order of the numbers in its name
    before = Window.orderBy("task", "number", "file").rowsBetween(Window.unboundedPreceding, -1)
    per_file = index.groupBy("file", "task", "number").agg(F.sum("n_tokens").alias("tokens"))
    starts = per_file.select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("ahead"))
    # the index was written from the files read back; the ids themselves are in the files alone
    rows = parsed(spark, folder) if with_ids else index.withColumn("ids", F.lit(None).cast("binary"))
    rows = rows.join(F.broadcast(starts) if starts.count() <= 100_000 else starts, "file")
    return rows.select(F.col("id").alias(id_col), (F.col("ahead") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "ids")


def read_shuffled(spark: SparkSession, folder: str, seed: int, id_col: str = "doc_id") -> DataFrame:
    """(place, id_col, ids) in an order drawn from the index by a hash of seed, file and offset.

    The order comes from the index; the records are read file by file, checked,
    and shuffled to their places, as Spark reads files of any file system.
    """
    index = spark.read.parquet(f"{folder}/index").select("file", "offset", F.xxhash64("file", "offset", F.lit(seed)).alias("place"))
    rows = parsed(spark, folder).join(index, ["file", "offset"]).select("place", F.col("id").alias(id_col), "ids")
    return rows.repartitionByRange("place").sortWithinPartitions("place")
