"""The packing search runs until no step is left; rows that repeat an id are mixed one by one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditspine.llm import mixing, packing


def steps_left(bins, size, capacity):
    """Whether any move or exchange between two bins, written plainly, raises the sum of squared fills."""
    fill = [int(size[b].sum()) for b in bins]
    for x, low in enumerate(bins):
        for y, other in enumerate(bins):
            if x == y or fill[y] < fill[x] or fill[y] == capacity:
                continue
            room = capacity - fill[y]
            for a in low:
                s = int(size[a])
                weights = [int(size[k]) for k in other]
                backs = [0, *weights, *(p + q for i, p in enumerate(weights) for q in weights[i + 1:])]
                if any(0 < s - back <= room for back in backs):
                    return True
    return False


@pytest.mark.parametrize("n, low, high", [(900, 1300, 2100), (300, 1300, 1500), (300, 200, 3000), (200, 1366, 2700)])
def test_search_ends_only_where_no_step_is_left(n, low, high):
    size = np.random.default_rng(0).integers(low, high, n)
    start = packing.best_fit(size, 4096)
    done = packing.improve(start, size, 4096)
    assert sorted(k for b in done for k in b) == list(range(n)) and all(size[b].sum() <= 4096 for b in done)
    least = -(-int(size.sum()) // 4096)
    assert len(done) <= len(start) and (len(done) == least or not steps_left(done, size, 4096))


def test_search_past_its_first_lot_saves_bins():
    size = np.random.default_rng(0).integers(1300, 2100, 900)
    assert len(packing.improve(packing.best_fit(size, 4096), size, 4096)) <= 429


def test_open_bins_meet_again_until_one_group_holds_them(spark):
    rng = np.random.default_rng(2)
    lengths = [int(x) for x in rng.integers(50, 400, 4000)]
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, length long")
    out = packing.pack(pieces, capacity=1000, group_tokens=20_000).collect()
    assert sorted(r["doc_id"] for r in out) == list(range(4000))
    bins = {}
    for r in out:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1000
    assert len(bins) <= 1.01 * sum(lengths) / 1000 + 2


def repeated(spark, key):
    """A source whose rate is 0.4; a third of its rows bear one id."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(key).cast("long")).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 2 == 0, "a b c d").otherwise(F.concat(F.lit("a b c "), F.col("id"))).alias("text"),
        F.lit("s").alias("source"))
    return rows


@pytest.mark.parametrize("key", [None, 0])
def test_rows_of_one_id_are_mixed_one_by_one(spark, key):
    docs = repeated(spark, key)
    plan = mixing.mix_plan(docs, share=0.4)
    hot = F.col("row.doc_id").eqNullSafe(F.lit(key).cast("long"))
    part, whole = plan.where(hot), plan.agg(F.sum("copies")).first()[0]
    assert plan.count() == 3000 and abs(whole - 1200) < 120
    assert part.count() >= 1000 and abs(part.agg(F.sum("copies")).first()[0] - 400) < 80
    again = mixing.mix_plan(docs.repartition(7, "text"), share=0.4)
    assert plan.exceptAll(again).count() == 0 and again.exceptAll(plan).count() == 0


def test_single_ids_draw_as_before(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.lit("s").alias("source"))
    more = docs.unionAll(spark.range(3).select(F.lit(1000).alias("doc_id"), F.lit("a").alias("text"), F.lit("t").alias("source")))
    one, two = (
        {r["id"]: r["draw"] for r in d.select(F.col("doc_id").alias("id"), mixing.uniform(17, F.col("doc_id")).alias("draw")).collect()}
        for d in (docs, more))
    assert all(two[k] == v for k, v in one.items())
