import os
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from creditspine import schemas as S
from creditspine.sources import snapshots as IO

HEADER = "Customer_ID,Name,Age,SSN,Occupation,snapshot_date\n"
LINES = [
    'CUS_1,"Doe, Jo ""J""",23_,821-00-0265,_______,2024-01-01\n',
    "CUS_2,Ann,40,#F%$D@*&8,Lawyer,2024-02-01\n",
    "CUS_3,Bob,,111-22-3333,Doctor,2024-02-01\n",
    "CUS_4,Eve,50,111-22-3334,Doctor,not a date\n",
]


def test_ingest_reads_quotes_and_splits_by_month(spark, tmp_path):
    source = tmp_path / "attributes.csv"
    source.write_text(HEADER + "".join(LINES))
    mart = IO.Datamart(str(tmp_path / "mart"))
    IO.ingest_bronze(spark, str(source), mart, "attributes")
    rows = {r["Customer_ID"]: r for r in IO.read_bronze(spark, mart, "attributes").collect()}
    assert set(rows) == {"CUS_1", "CUS_2", "CUS_3"}
    assert rows["CUS_1"]["Name"] == 'Doe, Jo "J"' and rows["CUS_1"]["Age"] == "23_"
    assert rows["CUS_3"]["Age"] is None and rows["CUS_2"]["snapshot_date"] == date(2024, 2, 1)
    month = IO.read_snapshot(spark, mart.path("bronze", "attributes"), "2024-02-01")
    assert month.count() == 2
    assert "PartitionFilters: [isnotnull(snapshot_date" in month._jdf.queryExecution().executedPlan().toString()


def test_wrong_header_fails(spark, tmp_path):
    source = tmp_path / "bad.csv"
    source.write_text("Customer_ID,Age,Name,SSN,Occupation,snapshot_date\n" + LINES[1])
    with pytest.raises(Exception):
        IO.read_csv(spark, str(source), S.RAW_ATTRIBUTES).collect()


def test_rewriting_a_month_leaves_others_untouched(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.range(6).select("id", F.add_months(F.to_date(F.lit("2024-01-01")), (F.col("id") % 3).cast("int")).alias("snapshot_date"))
    IO.write_snapshot(base, path)
    before = {f for f in IO.read_history(spark, path).inputFiles() if "2024-02-01" not in f}
    redo = spark.createDataFrame([(99,)], "id long").withColumn("snapshot_date", F.to_date(F.lit("2024-02-01")))
    for _ in range(2):
        IO.write_snapshot(redo, path)
    out = IO.read_history(spark, path)
    assert {f for f in out.inputFiles() if "2024-02-01" not in f} == before
    assert sorted(r["id"] for r in out.collect()) == [0, 2, 3, 5, 99]


def test_preview_and_table(spark, tmp_path):
    IO.write_table(spark.range(5), str(tmp_path / "t"))
    IO.write_table(spark.range(2), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    IO.write_preview(spark.range(50), str(tmp_path / "p"), 10, ["id"])
    assert spark.read.option("header", True).csv(str(tmp_path / "p")).count() == 10


def test_preview_without_order_is_the_same_on_every_layout(spark, tmp_path):
    df = spark.range(200).selectExpr("id % 7 as a", "id as b")
    for name, parts in (("one", 1), ("many", 13)):
        IO.write_preview(df.repartition(parts), str(tmp_path / name), 40)
    one, many = (sorted(map(tuple, spark.read.option("header", True).csv(str(tmp_path / n)).collect())) for n in ("one", "many"))
    assert one == many and len(one) == 40


def test_month_spine(spark):
    b = spark.createDataFrame([(date(2024, 11, 17), date(2025, 2, 1))], "a date, b date")
    assert [str(r[0]) for r in IO.month_spine(b, "a", "b").collect()] == ["2024-11-01", "2024-12-01", "2025-01-01", "2025-02-01"]


def shuffle_files(spark) -> set[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (found.apply(i).getName() for i in range(found.size()))
    return {n for n in names if n.startswith("shuffle_")}


@pytest.fixture
def months(spark, tmp_path, monkeypatch):
    """600 rows over six months and no month, one of them with half of the rows, all counted as a large table."""
    monkeypatch.setattr(IO, "ONE_JOB_BYTES", 0)
    monkeypatch.setattr(IO, "PORTION_BYTES", 1)
    spark.range(600).selectExpr("id", "case when id % 2 = 0 then '2024-03-01' when id % 14 = 1 then 'not a date' "
                                "else concat('2024-0', id % 14 div 2, '-01') end as month").write.parquet(f"{tmp_path}/source")
    return spark.read.parquet(f"{tmp_path}/source").select("id", F.expr("try_cast(month as date)").alias("snapshot_date"))


def test_a_large_table_is_written_some_months_at_a_time(spark, tmp_path, months):
    path = str(tmp_path / "t")
    IO.write_snapshot(spark.sql("select -1L as id, date'2024-03-01' as snapshot_date union all select -2L, date'2025-01-01'"), path)
    parts = IO.portions(months, path, "snapshot_date")
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 600 and len(sizes) > 3
    assert all(n <= 600 / IO.PORTIONS or p.select("snapshot_date").distinct().count() == 1 for n, p in zip(sizes, parts))
    before = shuffle_files(spark)
    IO.write_snapshot(months, path)
    for _ in range(50):  # files go shortly after the write
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= before
    out = IO.read_history(spark, path)
    assert sorted(map(tuple, out.where("id >= 0").collect())) == sorted(map(tuple, months.collect()), key=lambda r: r[0])
    assert [tuple(r) for r in out.where("id < 0").collect()] == [(-2, date(2025, 1, 1))]
    assert all(f.endswith(".zstd.parquet") for f in out.inputFiles())


def test_rows_that_should_be_read_once_are_written_at_once(spark, tmp_path, months):
    path = str(tmp_path / "t")
    IO.write_snapshot(months, path)
    kept = IO.read_history(spark, path)
    assert len(IO.portions(kept, str(tmp_path / "other"), "snapshot_date")) > 1
    for rows in (kept, months.withColumn("r", F.rand()), months.dropDuplicates(["id"]), months.repartition(3),
                 months.join(months.select("id"), "id"), months.withColumn("m", months.agg(F.max("id")).scalar())):
        assert len(IO.portions(rows, path, "snapshot_date")) == 1
    assert len(IO.portions(kept, os.path.relpath(path), "snapshot_date")) == 1


def test_portions_of_any_dates(spark, tmp_path, months):
    far = months.select("id", F.expr("date_add(date'9999-12-30', cast(id % 5 as int))").alias("snapshot_date"))
    parts = IO.portions(far, str(tmp_path / "t"), "snapshot_date")
    assert [p.count() for p in parts] == [120] * 5


def test_a_small_table_is_written_at_once(spark, tmp_path, monkeypatch, months):
    monkeypatch.undo()
    assert len(IO.portions(months, str(tmp_path / "t"), "snapshot_date")) == 1
