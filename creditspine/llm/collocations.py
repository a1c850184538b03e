"""Collocations: frequent phrases whose parts keep together, by Rabin-Karp fingerprints.

A text is cut at punctuation and line ends into pieces, those at blanks into
words. A task turns the bytes of a block into prefix polynomials with numpy; the
difference of two prefixes is the hash of the word between them. Prefix
polynomials over the word hashes do the same for phrases, so all phrases of a
length cost one subtraction each, and no word becomes a Python object. Equal
fingerprints of a task's blocks are counted together; the shuffle adds the counts
per fingerprint and keeps one occurrence pointer: hash of the text and number of
the word.

Words, pairs and longer phrases are counted one after the other. A phrase can be
frequent only if all its parts are, so a pass leaves out phrases with a part that
is missing in a bitmap of the last pass's frequent fingerprints. The bitmap has a bounded size; false positives cost work, never
rows, so results are whole at any size.

Fingerprints have 64 bits. A mark of 32 bits from a second pair of polynomials,
with bases and byte values of its own, tells phrases apart whose fingerprints
collide. The phrases of frequent fingerprints alone are read back from the texts
that the pointers name; each must give fingerprint and mark again, else the text
with the same hash that does is taken.

Defined results: a null text is empty, a null language ``und``. Ids are not
read, so repeated rows count as often as they occur. An empty table gives no
rows. Only the two named columns are read.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator, Sequence
from functools import cache
from math import ceil, log2

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditspine.llm.common import store

#: Texts taken from a batch, bytes hashed and phrases counted at a time, in a task.
TEXTS = 256
#: Phrases read back at a time.
SPANS = 1 << 14
BLOCK, GROUP = 1 << 18, 1 << 19
#: Longest word, in bytes, whose hash is a polynomial; others are hashed one by one.
LONGEST = 255
#: Bits of a bitmap chunk and of a whole bitmap, at most (32 MB).
CHUNK_BITS, MOST_BITS = 15, 28
#: Largest list of pointers that is broadcast.
BROADCAST_ROWS = 500_000
#: Odd bases of the two polynomials, constants of the bit mixer.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
MASK = (1 << 64) - 1

LOWER = bytes.maketrans(string.ascii_uppercase.encode() + b"\t.,;:!?\x0b\x0c\r", string.ascii_lowercase.encode() + b" " + b"\n" * 9)
COUNTED = "lang string, fp long, mark int, n long, key long, pos int, words int"
COLUMNS = [c.split()[0] for c in COUNTED.split(", ")]
READ = pa.schema([("lang", pa.string()), ("fp", pa.int64()), ("mark", pa.int32()), ("n", pa.int64()), ("words", pa.int32()), ("phrase", pa.string())])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[1])
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


@cache
def byte_values(k: int) -> list[int]:
    """A number for each byte, by rule."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASES[k])).tolist()


class Polynomial:
    """Hashes of words and phrases from prefix sums modulo 2^64; ``k`` chooses base and byte values."""

    def __init__(self, k: int, size: int = BLOCK + 1):
        self.k, self.base = k, BASES[k]
        self.values = np.array(byte_values(1 - k), dtype=np.uint64)
        self.grow(size)

    def grow(self, size: int) -> None:
        self.up, self.down = powers(self.base, size), powers(pow(self.base, -1, 1 << 64), size)

    def prefixes(self, values: np.ndarray) -> np.ndarray:
        if len(values) > len(self.up):
            self.grow(len(values) + 1)
        out = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self.up[:len(values)], out=out[1:], dtype=np.uint64)
        return out

    def between(self, prefixes: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return (prefixes[hi] - prefixes[lo]) * self.down[lo]

    def words(self, data: bytes, bytes_: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        out = mix(self.between(self.prefixes(self.values[bytes_]), lo, hi))
        for i in np.flatnonzero(hi - lo > LONGEST):
            out[i] = xxhash.xxh3_128_intdigest(data[lo[i]:hi[i]]) >> 64 * self.k & MASK
        return out

    def phrases(self, prefixes: np.ndarray, lo: np.ndarray, length: int) -> np.ndarray:
        return mix(self.between(prefixes, lo, lo + length) + np.uint64(length))


def language_hash(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))


def fingerprint(lang: str, words: list[bytes]) -> tuple[int, int]:
    """Fingerprint and mark of one phrase, as signed numbers; the plain form of what a block computes."""
    out = []
    for k, base in enumerate(BASES):
        values = byte_values(1 - k)
        hashes = np.array([
            sum(values[b] * pow(base, j, 1 << 64) for j, b in enumerate(w)) & MASK if len(w) <= LONGEST
            else xxhash.xxh3_128_intdigest(w) >> 64 * k & MASK for w in words
        ], dtype=np.uint64)
        short = np.array([len(w) <= LONGEST for w in words])
        hashes = mix(np.where(short, mix(hashes), hashes) ^ np.uint64(language_hash(lang)))
        total = sum(int(h) * pow(base, i, 1 << 64) for i, h in enumerate(hashes)) + len(words) & MASK
        out.append(mix(np.array([total], dtype=np.uint64)))
    return int(out[0].view(np.int64)[0]), int(out[1].astype(np.uint32).view(np.int32)[0])


def fingerprints(seeds: np.ndarray, runs: list[list[bytes]], both: tuple[Polynomial, Polynomial]) -> tuple[np.ndarray, np.ndarray]:
    """``fingerprint`` of many phrases at once; ``seeds`` has the language hash of each."""
    data = b" ".join(w for run in runs for w in run)
    size = np.array([len(run) for run in runs])
    length = np.fromiter((len(w) for run in runs for w in run), dtype=np.int64)
    hi = np.cumsum(length + 1) - 1
    bytes_, first, seed = np.frombuffer(data, dtype=np.uint8), np.cumsum(size) - size, np.repeat(seeds, size)
    out = []
    for p in both:
        prefix = p.prefixes(mix(p.words(data, bytes_, hi - length, hi) ^ seed))
        out.append(mix(p.between(prefix, first, first + size) + size.astype(np.uint64)))
    return out[0].view(np.int64), out[1].astype(np.uint32).view(np.int32)


class Bitmap:
    """Which of 2^bits ranges of fingerprints hold a frequent one."""

    def __init__(self, bits: int, data: np.ndarray):
        self.shift, self.data = np.uint64(64 - bits), data

    def holds(self, fp: np.ndarray) -> np.ndarray:
        at = fp >> self.shift
        return (self.data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


#: Part of a text: lower-cased bytes with breaks as newlines, language number, key of the text, number of its first word,
#: number of words that the part before it holds too.
Part = tuple[bytes, int, int, int, int]


def hash_block(parts: list[Part], seeds: np.ndarray, both: tuple[Polynomial, Polynomial], lengths: Sequence[int],
               known: Bitmap | None) -> Iterator[list[np.ndarray]]:
    """Every phrase in a block, per length: [fingerprint, mark, language number, key, pos, length].

    ``known`` holds the frequent phrases one word shorter than the first length.
    """
    data = b"\n".join(p[0] for p in parts)
    bytes_ = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(bytes_) + 2, dtype=np.int8)
    inside[1:-1] = (bytes_ != 32) & (bytes_ != 10)
    edges = np.flatnonzero(np.diff(inside))
    lo, hi = edges[::2], edges[1::2]
    part_at = np.cumsum([0] + [len(p[0]) + 1 for p in parts])
    first = np.searchsorted(lo, part_at)
    of = np.repeat(np.arange(len(parts)), np.diff(first))
    piece = np.cumsum(bytes_ == 10, dtype=np.int32)[lo]
    _, lang, key, number, held = (np.array(c) for c in zip(*parts))
    seed = seeds[lang][of]
    prefixes = [p.prefixes(mix(p.words(data, bytes_, lo, hi) ^ seed)) for p in both]
    shorter = lengths[0] - 1
    if known is not None and len(lo) >= shorter:
        frequent = known.holds(both[0].phrases(prefixes[0], np.arange(len(lo) - shorter + 1), shorter))
    for length in lengths:
        n = len(lo) - length + 1
        if n < 1:
            return
        whole = piece[length - 1:] == piece[:n]
        if known is not None:
            for k in range(length - shorter + 1):
                whole &= frequent[k:k + n]
        at = np.flatnonzero(whole)
        at = at[at - first[of[at]] + length > held[of[at]]]
        if len(at):
            here = of[at]
            yield [
                both[0].phrases(prefixes[0], at, length), both[1].phrases(prefixes[1], at, length).astype(np.uint32),
                lang[here].astype(np.int32), key[here], (number[here] + at - first[here]).astype(np.int32), np.full(len(at), length, dtype=np.int32),
            ]


def count_equal(held: list[list[np.ndarray]]) -> list[np.ndarray]:
    """[fingerprint, mark, language number, key, pos, length, n], one of each kind."""
    columns = [np.concatenate(c) for c in zip(*held)]
    order = np.argsort(columns[0])
    fp, mark = columns[0][order], columns[1][order]
    starts = np.flatnonzero(np.append(True, (fp[1:] != fp[:-1]) | (mark[1:] != mark[:-1])))
    return [c[order[starts]] for c in columns] + [np.diff(np.append(starts, len(order)))]


DELIMITER = re.compile(rb"[ \n]")


def parts_of(text: bytes, lang: int, key: int, length: int) -> Iterator[Part]:
    """A text in parts of about a block; each run of up to ``length`` words lies whole in one of them."""
    at, number, size, held = 0, 0, BLOCK, 0
    while len(text) - at > size:
        found = DELIMITER.search(text, at + size)
        if found is None:
            break
        part = text[at:found.start()]
        # the next part begins with the last words of this one
        back, cut = part, len(part)
        for _ in range(length - 1):
            back = back[:cut].rstrip(b" \n")
            cut = max(back.rfind(b" "), back.rfind(b"\n")) + 1
        n = len(part.split())
        if n < 2 * length:
            size *= 2
            continue
        yield part, lang, key, number, held
        at, number, size, held = at + cut, number + n - (length - 1), BLOCK, length - 1
    yield text[at:], lang, key, number, held


def counted(docs: DataFrame, lengths: Sequence[int], known=None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, fp, mark, n, key, pos, words): counts per task of the phrases of some lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Polynomial(0), Polynomial(1)
        bitmap = Bitmap(*known.value) if known is not None else None
        names: dict[str, int] = {}
        parts: list[Part] = []
        found: list[list[np.ndarray]] = []
        size = rows = 0

        def hash_parts() -> None:
            nonlocal size, rows
            if parts:
                seeds = np.array([language_hash(n) for n in names], dtype=np.uint64)
                for block in hash_block(parts, seeds, both, lengths, bitmap):
                    found.append(block)
                    rows += len(block[0])
            parts.clear()
            size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal rows
            if found:
                fp, mark, lang, key, pos, words, n = count_equal(found)
                found.clear()
                rows = 0
                langs = pa.array(list(names), type=pa.string()).take(pa.array(lang))
                columns = [langs, *map(pa.array, (fp.view(np.int64), mark.view(np.int32), n, key, pos, words))]
                yield from pa.Table.from_arrays(columns, names=COLUMNS).to_batches(max_chunksize=1 << 16)

        for some in (batch.slice(lo, TEXTS) for batch in batches for lo in range(0, batch.num_rows, TEXTS)):
            for text, lang, key in zip(*(column.to_pylist() for column in some.columns)):
                for part in parts_of(text.translate(LOWER), names.setdefault(lang, len(names)), key, lengths[-1]):
                    if size + len(part[0]) > BLOCK:
                        hash_parts()
                        if rows >= GROUP:
                            yield from flush()
                    parts.append(part)
                    size += len(part[0]) + 1
        hash_parts()
        yield from flush()

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(text.cast("binary"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")), F.xxhash64(text))
    return rows.toDF("text", "lang", "key").mapInArrow(run, COUNTED)


def bitmap(spark, frequent: DataFrame):
    """A broadcast bitmap of frequent fingerprints; its size follows their number up to a bound."""
    n = frequent.count()
    bits = min(MOST_BITS, max(CHUNK_BITS, ceil(log2(max(1, 16 * n)))))

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        held = np.zeros(1 << CHUNK_BITS, dtype=np.uint8)
        held[rows["low"].to_numpy()] = 1
        return pd.DataFrame({"chunk": [rows["chunk"].iloc[0]], "data": [np.packbits(held, bitorder="little").tobytes()]})

    at = F.shiftrightunsigned("fp", 64 - bits)
    low = at.bitwiseAND(F.lit((1 << CHUNK_BITS) - 1))
    parts = frequent.select(F.shiftright(at, CHUNK_BITS).alias("chunk"), low.alias("low")).distinct()
    data = np.zeros(1 << bits - 3, dtype=np.uint8)
    step = 1 << CHUNK_BITS - 3
    for row in parts.groupBy("chunk").applyInPandas(fill, "chunk long, data binary").collect():
        data[row["chunk"] * step:(row["chunk"] + 1) * step] = np.frombuffer(row["data"], dtype=np.uint8)
    return spark.sparkContext.broadcast((bits, data))


def frequent_fingerprints(docs: DataFrame, longest: int, least: int, **columns) -> tuple[DataFrame, DataFrame]:
    """((lang, fp, mark, n, key, pos, words) of phrases found at least ``least`` times, (lang, n) of all words)."""
    levels, known, totals = [], None, None
    for lengths in [[1], [2], list(range(3, longest + 1))]:
        lengths = [k for k in lengths if k <= longest]
        if not lengths:
            break
        if levels:
            known = bitmap(docs.sparkSession, levels[-1])
        sums = counted(docs, lengths, known, **columns).groupBy("lang", "words", "fp", "mark").agg(
            F.sum("n").alias("n"), F.min("key").alias("key"), F.min_by("pos", "key").alias("pos"))
        if totals is None:
            # rare words are folded into one row per language, for the total
            often = F.col("n") >= least
            sums = sums.select("lang", "n", *[F.when(often, F.col(c)).alias(c) for c in ("words", "fp", "mark", "key", "pos")])
            folded = store(sums.groupBy("lang", "words", "fp", "mark", "key", "pos").agg(F.sum("n").alias("n")))
            totals = folded.groupBy("lang").agg(F.sum("n").alias("n"))
            found = folded.where("fp is not null")
        else:
            found = store(sums.where(F.col("n") >= least))
        levels.append(found.select("lang", "fp", "mark", "n", "key", "pos", "words"))
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out, totals


def phrases(docs: DataFrame, found: DataFrame, text_col: str = "text") -> DataFrame:
    """(lang, phrase, words, f): the texts of frequent fingerprints, read where their pointers point."""
    spans = F.collect_list(F.struct("lang", "fp", "mark", "n", "pos", "words")).alias("spans")
    wanted = store(found.groupBy("key").agg(spans))
    names = wanted.select("key")
    names = F.broadcast(names) if names.count() <= BROADCAST_ROWS else names
    rows = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    texts = rows.join(names, "key", "left_semi").groupBy("key", "text").agg(F.count(F.lit(1)).alias("copies"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Polynomial(0), Polynomial(1)
        for batch in batches:
            for text, spans in zip(*(column.to_pylist() for column in batch.columns)):
                words = text.translate(LOWER).split()
                spans = [s for s in spans if s["pos"] + s["words"] <= len(words)]
                for some in (spans[at:at + SPANS] for at in range(0, len(spans), SPANS)):
                    runs = [words[s["pos"]:s["pos"] + s["words"]] for s in some]
                    seeds = np.array([language_hash(s["lang"]) for s in some], dtype=np.uint64)
                    again = zip(*(x.tolist() for x in fingerprints(seeds, runs, both)))
                    rows = [{**s, "phrase": b" ".join(run).decode()} for s, run, same in zip(some, runs, again)
                            if same == (s["fp"], s["mark"])]
                    yield pa.RecordBatch.from_pylist(rows, schema=READ)

    true = texts.join(wanted, "key").select(F.col("text").cast("binary"), "spans").mapInArrow(
        read, "lang string, fp long, mark int, n long, words int, phrase string")
    one = true.groupBy("lang", "fp", "mark", "n", "words").agg(F.min("phrase").alias("phrase"))
    return one.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("f"))


def _part(words: Column, start: Column | int, n: Column | int) -> Column:
    return F.array_join(F.slice(words, start, n), " ")


def scored(known: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, score): phrases of two words or more by their lowest-scoring cut."""
    word = F.split("phrase", " ")
    cuts = known.where("words > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "words", F.col("f").alias("a"), "k",
        _part(word, 1, F.col("k")).alias("head"), _part(word, F.col("k") + 1, F.col("words") - F.col("k")).alias("tail"),
    )
    left = known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    # 38 digits hold any product of counts; the quotient fits a long
    score = F.expr("cast(2000000 as decimal(8)) * cast(a as decimal(19)) div (cast(l as decimal(19)) + cast(r as decimal(19)))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return cuts.join(left, ["lang", "head"]).join(right, ["lang", "tail"]).groupBy("lang", "phrase", "words", "a").agg(
        lowest.alias("cut")
    ).select("lang", "phrase", "words", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))


def covered(known: DataFrame, longest: int) -> DataFrame:
    """(lang, phrase, longer): the highest count of a longer frequent phrase that holds the phrase."""
    word = F.split("phrase", " ")
    inside = []
    for n in range(3, longest + 1):
        within = F.array(*[_part(word, s + 1, m) for m in range(2, n) for s in range(n - m + 1)])
        inside.append(known.where(F.col("words") == n).select("lang", F.explode(within).alias("phrase"), F.col("f").alias("longer")))
    if not inside:
        return known.where("false").select("lang", "phrase", F.col("f").alias("longer"))
    out = inside[0]
    for more in inside[1:]:
        out = out.unionByName(more)
    return out.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))


def collocations(docs: DataFrame, longest: int = 4, least: int = 30, share: int = 80, top: int = 2000, **columns) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    ``share``: a phrase goes if a longer one that holds it has at least so many
    hundredths of its count.
    """
    found, totals = frequent_fingerprints(docs, longest, least, **columns)
    known = store(phrases(docs, found, columns.get("text_col", "text")))
    over = covered(known, longest)
    often = F.expr(f"cast(100 as decimal(8)) * cast(longer as decimal(19)) >= cast({int(share)} as decimal(8)) * cast(a as decimal(19))")
    kept = scored(known).join(over, ["lang", "phrase"], "left").where(~F.coalesce(often, F.lit(False)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = kept.select("lang", "phrase", "a", "l", "r", "score", rank.alias("rank")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
