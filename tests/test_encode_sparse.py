"""Vocabularies of any size, exact cuts through tied keys, and the lifetime of intermediate tables."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from creditspine.functions import cleaning as C
from creditspine.operators import encode, projection, ranks, splits
from creditspine.plans import gold
from creditspine.sources.session import checkpoint_root, cut_lineage, delete_folder, release, scratch, scratch_scope


def test_hundred_thousand_values_encode(spark):
    n = 100_000
    df = spark.range(n + 2).select("id", F.when(F.col("id") < n, F.format_string("v%06d", "id")).alias("c"))
    known = encode.fit_dictionary(df.where(f"id < {n} or id = {n}"), "c")
    assert known.size == n
    rows = df.withColumn("c", F.when(F.col("id") == n + 1, "unseen").otherwise(F.col("c")))
    wide = encode.sparse_one_hot(rows.where(f"id % 20000 = 7 or id >= {n}"), "c", known)
    assert wide.columns == ["id", "c", "c_vec"]
    got = {r["id"]: r["c_vec"] for r in wide.collect()}
    assert len(got) == 7 and all(v.size == n for v in got.values())
    for key, v in got.items():
        assert v.indices.tolist() == ([key] if key < n else [])


def test_large_dictionaries_salt_a_hot_value(spark, monkeypatch):
    monkeypatch.setattr(encode, "BROADCAST_ROWS", 10)
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("c"))
    known = encode.fit_dictionary(df, "c")
    got = encode.index_category(df.withColumn("_hot", F.lit(1)).drop("_hot"), "c", known)
    order = {v: i for i, v in enumerate(sorted({r["c"] for r in df.collect()}))}
    assert all(r["c_index"] == order[r["c"]] for r in got.collect()) and got.count() == 3000


def test_dictionary_of_nothing(spark):
    df = spark.createDataFrame([(1, None)], "id int, c string")
    known = encode.fit_dictionary(df, "c")
    assert known.size == 0 and encode.index_category(df, "c", known).first()["c_index"] is None
    with pytest.raises(ValueError, match="no value"):
        encode.sparse_one_hot(df, "c", known)


def test_list_entries_count_repeats_and_leave_out_unseen(spark):
    df = spark.createDataFrame([(1, "Auto Loan, and Auto Loan, Payday"), (2, None), (3, ""), (4, "Payday")], "k int, t string")
    known = encode.fit_dictionary(df.where("k = 4"), F.explode(C.list_keys("t")))
    got = {tuple(r) for r in encode.list_entries(df, ["k"], "t", known).collect()}
    assert got == {(1, 0, 1), (4, 0, 1)}


def hot_table(spark, n=9000):
    """A third of the rows under one key, many of them equal."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), (F.col("id") % 5).alias("x"),
        (F.col("id") % 2).cast("int").alias("label"))


def test_split_shares_are_exact_with_a_hot_key(spark):
    df = hot_table(spark)
    out = splits.stratified_split(df, ["k"])
    got = {(r["label"], r["split"]): r["count"] for r in out.groupBy("label", "split").count().collect()}
    assert got == {(v, s): n for v in (0, 1) for s, n in (("train", 3150), ("val", 900), ("test", 450))}
    assert out.drop("split").exceptAll(df).count() == 0 and df.exceptAll(out.drop("split")).count() == 0
    assert out.exceptAll(splits.stratified_split(df.repartition(5, "x"), ["k"])).count() == 0


def test_split_of_equal_rows_only(spark):
    df = spark.range(1000).select(F.lit("a").alias("k"), F.lit(1).alias("label"))
    got = {r["split"]: r["count"] for r in splits.stratified_split(df, ["k"]).groupBy("split").count().collect()}
    assert got == {"train": 700, "val": 200, "test": 100}


def test_equal_rows_are_numbered_over_many_ranges(spark):
    rows = cut_lineage(spark.range(1000).select(F.lit(0).alias("_c"), F.lit("a").alias("k")).repartition(4))
    got = ranks._numbered_classes(rows, {0: [10, 990]}, "_c", "_n", rows_per_range=64)
    assert {r["_n"]: r["count"] for r in got.groupBy("_n").count().collect()} == {0: 10, 1: 980, 2: 10}


@pytest.mark.parametrize("n", [1, 2500, 5000, 8999, 9000, 9001])
def test_samples_are_exact_with_a_hot_key(spark, n):
    df = hot_table(spark)
    got = projection.sample_rows(df, ["k"], n, 3)
    assert got.count() == min(n, 9000) and got.columns == df.columns
    assert got.exceptAll(projection.sample_rows(df.repartition(3), ["k"], n, 3)).count() == 0
    assert got.exceptAll(df).count() == 0


def stored(spark):
    """Intermediate tables of this application."""
    folder = f"{checkpoint_root(spark)}/creditspine/{spark.sparkContext.applicationId}".replace("file:", "", 1)
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_tables_of_a_scope_go_with_it(spark, tmp_path):
    before = stored(spark)
    with scratch_scope(spark) as outer:
        kept = cut_lineage(spark.range(10))
        with scratch_scope(spark) as inner:
            assert inner.startswith(outer)
            cut_lineage(spark.range(5)).write.parquet(str(tmp_path / "out"))
        assert kept.count() == 10 and len(stored(spark) - before) == 1
    assert stored(spark) == before and spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_tables_of_a_failed_job_go_too(spark):
    before = stored(spark)
    with pytest.raises(ZeroDivisionError), scratch_scope(spark):
        cut_lineage(spark.range(10))
        1 / 0
    assert stored(spark) == before


def test_a_missing_folder_is_no_error(spark):
    delete_folder(spark, scratch(spark, uuid.uuid4().hex))


def test_release_clears_what_the_application_stored(spark, monkeypatch):
    class Context:
        applicationId = "app-of-a-test"
        getCheckpointDir = spark.sparkContext.getCheckpointDir

    class Session:
        sparkContext, conf, _jvm, _jsc = Context, spark.conf, spark._jvm, spark._jsc

    checkpoint_root(spark)
    Context.master = spark.sparkContext.master
    path = scratch(Session, "table")
    spark.range(3).write.parquet(path)
    release(Session)
    assert not os.path.exists(os.path.dirname(path.replace("file:", "", 1)))


def test_fits_read_the_joined_rows_once(spark):
    """The source is scanned by one job, though three fits and the result follow."""
    counter = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            counter.add(b.num_rows)
            yield b

    rows = [(f"L{i}", str(20 + i % 40), f"o{i % 3}") for i in range(300)]
    source = spark.createDataFrame(rows, "loan_id string, Age string, Occupation string").repartition(2)
    out = gold.attribute_features(source.mapInArrow(seen, source.schema))
    assert out.count() == 300 and counter.value == 300
