from datetime import date

import pytest
from pyspark.sql import functions as F

from creditspine.operators import joins


def frame(spark, rows, cols):
    return spark.createDataFrame(rows, cols).withColumn("snapshot_date", F.to_date("snapshot_date"))


def test_label_join_directions(spark):
    f = frame(spark, [("c", "2024-01-01", 7)], "Customer_ID string, snapshot_date string, x int")
    l = frame(spark, [("c", "2024-07-01", 1), ("c", "2024-08-01", 0)], "Customer_ID string, snapshot_date string, label int")
    assert [tuple(r) for r in joins.label_join(f, l, direction="back").collect()] == [("c", date(2024, 1, 1), 7, 1)]
    assert [tuple(r) for r in joins.label_join(f, l, direction="forward").collect()] == [("c", date(2024, 7, 1), 7, 1)]
    with pytest.raises(ValueError):
        joins.label_join(f, l, direction="sideways")


def test_month_end_is_clamped(spark):
    f = frame(spark, [("c", "2022-08-31", 7)], "Customer_ID string, snapshot_date string, x int")
    l = frame(spark, [("c", "2023-02-28", 1)], "Customer_ID string, snapshot_date string, label int")
    assert joins.label_join(f, l, direction="forward").count() == 1
    assert joins.label_join(f, l, direction="back").count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_join_equals_plain_join(spark, how):
    many = spark.range(3000).select(
        F.when(F.col("id") < 1000, 1).when(F.col("id") < 1200, None).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    one = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    plain = sorted(map(tuple, many.join(one, "k", how).collect()), key=str)
    salted = sorted(map(tuple, joins.salted_join(many, one, ["k"], how, share=0.05, salts=7).collect()), key=str)
    assert plain == salted


@pytest.mark.parametrize("inclusive", [True, False])
def test_history_means_equal_the_pair_join(spark, inclusive):
    h = spark.range(400).select(
        F.when(F.col("id") < 200, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 5).cast("string"))).alias("Customer_ID"),
        F.add_months(F.to_date(F.lit("2024-01-01")), (F.col("id") % 9).cast("int")).alias("snapshot_date"),
        F.when(F.col("id") % 7 != 0, (F.col("id") * 13 % 101)).cast("int").alias("a"), F.lit(None).cast("int").alias("b"))
    a = spark.range(60).select(
        F.when(F.col("id") < 30, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 4).cast("string"))).alias("Customer_ID"),
        F.add_months(F.to_date(F.lit("2024-01-01")), (F.col("id") % 11).cast("int")).alias("mob_date"))
    got = {r["Customer_ID"]: (round(r["avg_a"], 9), r["avg_b"]) for r in joins.history_means(h, a, ["a", "b"], inclusive).collect()}
    on = F.col("snapshot_date") <= F.col("mob_date") if inclusive else F.col("snapshot_date") < F.col("mob_date")
    want = {
        r["Customer_ID"]: (round(r["a"], 9), r["b"])
        for r in h.join(a, "Customer_ID").where(on).groupBy("Customer_ID").agg(F.avg("a").alias("a"), F.avg("b").alias("b")).collect()
    }
    assert got == want


def test_latest_record(spark):
    d = frame(spark, [("c", "2024-01-01", 1), ("c", "2024-03-01", 2), ("d", "2023-01-01", 3)],
              "Customer_ID string, snapshot_date string, x int")
    out = joins.latest_record(d)
    assert sorted(map(tuple, out.collect())) == [("c", 2), ("d", 3)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan  # one row per key before the shuffle


def test_joins_of_growing_tables_are_not_broadcast(spark, capsys):
    def table(*columns):
        return spark.range(20).select(
            F.concat(F.lit("c"), "id").alias("Customer_ID"), F.lit("2024-01-01").cast("date").alias("snapshot_date"),
            *[F.col("id").alias(c) for c in columns])

    for joined in (
        joins.feature_store(table("a"), table("b"), table("c")),
        joins.label_join(table("a"), table("label")),
        joins.join_all([table("a"), table("b")], ["Customer_ID", "snapshot_date"]),
        joins.with_labels_only(table("a"), table("label")),
        joins.prediction_labels(table("score"), table("label")),
        joins.same_date_labels(table("a"), table("label")),
    ):
        joined.collect()
        joined.explain()
        assert "Broadcast" not in capsys.readouterr().out
