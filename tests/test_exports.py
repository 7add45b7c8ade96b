"""What an export costs, and the last rows that it is made of."""

from pyspark.sql import functions as F

from forecourt.operators import normalize
from forecourt.plans import catalog, store

from .compare import spark_rows, sql_rows

SF = "/root/testdata/sf0.001"


def test_an_export_alone_writes_no_table(spark, monkeypatch):
    monkeypatch.setattr(store, "_made", {})
    monkeypatch.setattr(store, "_asked", set())
    first = catalog.export_fuel(spark, SF)
    assert not store._made  # the whole listings table, before
    plan = first._jdf.queryExecution().optimizedPlan().toString()
    assert "match_key" not in plan and "battery_health" not in plan.partition("Window")[0]
    second = catalog.export_fuel(spark, SF)
    assert store._made and spark_rows(first) == spark_rows(second) == sql_rows(SF, catalog.ORACLES["export_fuel"])


def test_last_rows_of_a_kind_compete_with_all_rows(spark):
    rows = [("a", 1, "x", "1"), ("a", 2, "y", "2"), ("b", 1, "y", "3"), ("b", 2, "x", "4"), ("c", 1, "x", None), ("d", 1, None, "5"), ("d", 1, None, "5"), (None, 9, "x", "6")]
    table = spark.createDataFrame(rows, "k string, at int, kind string, v string")
    for where in (F.col("kind") == "x", F.col("kind").isNull()):
        found = normalize.dedupe_last(table, "k", ["at"], where=where)
        assert found.columns == table.columns and sorted(map(str, found.collect())) == sorted(map(str, normalize.dedupe_last(table, "k", ["at"]).filter(where).collect()))
