"""How the derived tables are laid out."""

import time

from pyspark.sql import functions as F

from checks.testbed import Testbed


def test_a_file_of_one_row_group_is_spread(spark, tmp_path):
    spark.range(4000).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    small = {"spark.sql.files.maxPartitionBytes": "1k", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        table = Testbed(spark, str(tmp_path)).table("orders")
        parts = [r["count"] for r in table.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(parts) == 4000
        assert max(parts) <= 4000 / spark.sparkContext.defaultParallelism * 1.1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_stored_table_leaves_no_shuffle_files(spark, folder):
    def shuffle_files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (found.apply(i).getName() for i in range(found.size()))
        return {n for n in names if n.startswith("shuffle_")}

    bed = Testbed(spark, f"{folder}/.")  # not stored by another test
    before = shuffle_files()
    rows = bed.stored("raw_ledger")
    for _ in range(50):  # files go shortly after the write
        if shuffle_files() <= before:
            break
        time.sleep(0.1)
    assert shuffle_files() <= before
    assert rows.count() == bed.table("orders").count() * 11
