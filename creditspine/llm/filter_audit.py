"""How quality filters overlap: what each removes, in every order of applying them.

Every row fails some set of the filters. Filters on a row's own text are column
expressions. One filter looks at the whole table: a text that a smaller id also
has. It is an existential self-join: rows whose hash occurs under several ids
meet, on hash and exact text, the smallest id of each such text, and a left semi
join keeps those with a larger id. Their ids are united with the ids that fail
the other filters, and counts per combination of failed filters (at most 2^n a
part) answer all n! orders without another look at the rows.

The smallest ids are aggregated before they are shuffled, so copies of a text
travel once per task on that side; on the other side the copies of a hash are
dealt over blocks of ``BLOCK`` rows, each with its own copy of the smallest id.

Defined results: a null text is empty. A row with a null id is no copy and makes
none. Rows that repeat an id are rows of their own; equal ids are not smaller. A
row has a label if any label row of its id says so; labels without an id are
ignored. A null part is the empty part. An empty table gives no rows. Only the
named columns are read.
"""

from __future__ import annotations

from itertools import combinations as subsets
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditspine.llm.common import store

#: Rows of one hash that are compared in one block.
BLOCK = 1024
#: Largest list of shared hashes (two longs each) that is broadcast.
BROADCAST_ROWS = 500_000
COPY = "E"


def own_failures(text: Column, words: Column) -> dict[str, Column]:
    """Filters on a text alone, true where it fails; ``words`` are its words, repeats included."""
    n = F.size(words)
    return {
        "A": n < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def later_copies(rows: DataFrame) -> DataFrame:
    """The rows (id, part, text, hash) whose exact text a smaller id also has: (id, part, hash)."""
    shared = store(
        rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))
        .where("high > low").select("hash", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    )
    # a list of bounded size is sent to the texts; a longer one is shuffled with them
    known = F.broadcast(shared) if shared.count() <= BROADCAST_ROWS else shared
    members = rows.where("id is not null").join(known, "hash")
    first = members.groupBy("hash", "text", "blocks").agg(F.min("id").alias("first")).select(
        "hash", "text", "first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    )
    dealt = members.withColumn("block", F.pmod(F.monotonically_increasing_id(), F.col("blocks")))
    return dealt.alias("d").join(
        first.alias("f"),
        (F.col("d.hash") == F.col("f.hash")) & (F.col("d.text") == F.col("f.text"))
        & (F.col("d.block") == F.col("f.block")) & (F.col("d.id") > F.col("f.first")),
        "left_semi",
    ).select("id", "part", "hash")


def combinations(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): rows per combination of failed filters, bit k for the k-th letter."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text")
    ).withColumn("hash", F.xxhash64("text"))
    failed = own_failures(F.col("text"), F.col("words"))
    own = rows.withColumn("words", words_of(F.col("text"))).select(
        "id", "part", "hash", sum(F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(failed.values())).alias("mask"),
        F.lit(1).cast("long").alias("n"),
    )
    copies = later_copies(rows).select("id", "part", "hash", F.lit(1 << len(failed)).alias("mask"), F.lit(0).cast("long").alias("n"))
    # rows equal in id and text fail the same filters, so they are counted together
    united = own.unionAll(copies).groupBy("id", "part", "hash").agg(F.bit_or("mask").alias("mask"), F.sum("n").alias("n"))
    per_id = united.groupBy("id", "part", "mask").agg(F.sum("n").alias("n"))
    known = labels.select(
        F.col(id_col).cast("long").alias("id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic")
    ).where("id is not null").groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    return per_id.join(known, "id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")],
    )


def states(letters: str) -> list[tuple[int, int, str, int]]:
    """(filter bit, bits of the filters before it, order, step) for every step of every order."""
    out = []
    for k, letter in enumerate(letters):
        others = [c for c in letters if c != letter]
        for size in range(len(letters)):
            for before in subsets(others, size):
                bits = sum(1 << letters.index(c) for c in before)
                rest = [c for c in others if c not in before]
                out += [(1 << k, bits, "".join(p) + letter + "".join(q), size + 1)
                        for p in permutations(before) for q in permutations(rest)]
    return out


def interactions(combos: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """(part, filter_order, step, counts): one row per part, order and step.

    ``removed`` rows fail the step's filter and none before it; ``redundant`` ones
    fail it too but are gone; ``unique_fails`` fail nothing else. ``shapley`` is
    what the filter removes summed over all orders: a row that fails m filters is
    removed by each of them in one m-th of the orders.
    """
    steps = states(letters)
    pairs = sorted({(f, b) for f, b, _, _ in steps})
    every = combos.withColumn("at", F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.lit(b).alias("b")) for f, b in pairs])))
    f, b, mask = F.col("at.f"), F.col("at.b"), F.col("mask")
    here = (mask.bitwiseAND(f) != 0) & (mask.bitwiseAND(b) == 0)

    def total(condition: Column, value: Column = F.col("n")) -> Column:
        return F.sum(F.when(condition, value).otherwise(0)).cast("long")

    sums = every.groupBy("part", f.alias("f"), b.alias("b")).agg(
        total(mask.bitwiseAND(f.bitwiseOR(b)) == 0).alias("kept"),
        total(here).alias("removed"),
        total((mask.bitwiseAND(f) != 0) & (mask.bitwiseAND(b) != 0)).alias("redundant"),
        total(mask == f).alias("unique_fails"),
        total(here, F.col("good")).alias("good_lost"),
        total(here, F.col("toxic")).alias("toxic_lost"),
        total(mask.bitwiseAND(f) != 0, F.expr(f"n * ({factorial(len(letters))} div bit_count(mask))")).alias("shapley"),
    )
    # one row per step of each order: a fixed table of n * n! rows
    orders = combos.sparkSession.createDataFrame(steps, "f int, b int, filter_order string, step int")
    return sums.join(F.broadcast(orders), ["f", "b"]).drop("f", "b")


def audit(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """The interactions of the filters A to E; see ``interactions``."""
    return interactions(store(combinations(docs, labels, **columns)))
