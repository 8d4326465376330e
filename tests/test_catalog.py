"""Catalog operators: database, external table, add partitions (plain folders), repair, show."""

from pyspark.sql import functions as F

from rivulet.plans import catalog
from rivulet.session import work_path


def test_plain_folders_via_add_partitions(spark):
    base = work_path(spark, "plain")
    df = spark.createDataFrame([(1, "2017-5-22"), (2, "2017-5-22"), (3, "2017-6-1")], "order_id long, d string")
    # plain folder layout (no name=value): one folder per day value
    for day in ("2017-5-22", "2017-6-1"):
        df.where(F.col("d") == day).select("order_id").write.parquet(f"{base}/{day}")
    catalog.create_database(spark, "rv_test_db", f"{work_path(spark, 'wh')}/rv_test_db.db")
    catalog.create_external_table(spark, "rv_test_db.plain_t", df.select("order_id").schema, "date_str", base)
    # the table schema gets the partition column appended
    dirs = catalog.discover_partition_dirs(spark, base)
    assert set(dirs) == {"2017-5-22", "2017-6-1"}
    assert catalog.add_partitions(spark, "rv_test_db.plain_t", "date_str", dirs) == 2
    catalog.add_partitions(spark, "rv_test_db.plain_t", "date_str", dirs)  # idempotent
    got = sorted(map(tuple, spark.table("rv_test_db.plain_t").select("order_id", "date_str").collect()))
    assert got == [(1, "2017-5-22"), (2, "2017-5-22"), (3, "2017-6-1")]
    parts = sorted(r[0] for r in catalog.show_partitions(spark, "rv_test_db.plain_t").collect())
    assert parts == ["date_str=2017-5-22", "date_str=2017-6-1"]


def test_repair_discovers_name_value_folders(spark):
    base = work_path(spark, "hive")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "order_id long, date_str string")
    df.write.partitionBy("date_str").parquet(base)
    catalog.create_database(spark, "rv_test_db", f"{work_path(spark, 'wh')}/rv_test_db.db")
    catalog.create_external_table(spark, "rv_test_db.hive_t", df.schema, "date_str", base)
    assert spark.table("rv_test_db.hive_t").count() == 0
    catalog.repair(spark, "rv_test_db.hive_t")
    assert spark.table("rv_test_db.hive_t").count() == 2
    current = spark.catalog.currentDatabase()
    catalog.use_database(spark, "rv_test_db")
    assert spark.catalog.currentDatabase() == "rv_test_db"
    catalog.use_database(spark, current)
