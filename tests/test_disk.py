"""What goes to disk: columns that a merge carries, inputs that are dealt out."""

import duckdb

from forecourt.operators import upsert
from forecourt.plans import store


def test_a_merge_carries_only_what_is_read_of_it(spark, tmp_path):
    columns = ["string(id) AS k", "if(id % 3 = 0, 'ev', 'fuel') AS line", "0 AS missing_count", "false AS is_deleted", "'text' || id AS unread"]
    spark.range(10).selectExpr(*columns).write.parquet(f"{tmp_path}/a")
    spark.range(5, 12).filter("id % 3 > 0").selectExpr(*columns).write.parquet(f"{tmp_path}/b")
    old, new = spark.read.parquet(f"{tmp_path}/a"), spark.read.parquet(f"{tmp_path}/b")
    merged = upsert.merge(old, new, key="k", delete_after=1)
    twice = upsert.merge(merged.drop("action"), new, key="k", delete_after=2)
    assert "unread" not in twice.select("action")._jdf.queryExecution().executedPlan().toString()  # both texts went through both joins
    found = {int(r.k): (r.missing_count, r.is_deleted, r.action) for r in merged.collect()}
    assert found == {0: (0, False, "keep"), 3: (0, False, "keep"), 6: (0, False, "keep"), 9: (0, False, "keep"), **{i: (1, True, "delete") for i in (1, 2, 4)}, **{i: (0, False, "update") for i in (5, 7, 8)}, **{i: (0, False, "insert") for i in (10, 11)}}


def test_inputs_that_all_cores_can_read_are_not_dealt_out(spark, tmp_path):
    for name, size in (("one", 100_000), ("many", 2_048)):
        duckdb.sql(f"COPY (SELECT i AS a, md5(i::VARCHAR) AS b FROM range(100000) r(i)) TO '{tmp_path}/{name}.parquet' (ROW_GROUP_SIZE {size})")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        dealt = {name: "Repartition" in store.spread(spark.read.parquet(f"{tmp_path}/{name}.parquet"), "a")._jdf.queryExecution().optimizedPlan().toString() for name in ("one", "many")}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept[0])
        spark.conf.set("spark.sql.files.openCostInBytes", kept[1])
    assert dealt == {"one": True, "many": False}  # both were shuffled whole, whatever their size
