"""How plans are made up, where that decides about time."""

import re

from pyspark.sql import functions as F

from forecourt.functions import numbers, text
from forecourt.operators import normalize, quality
from forecourt.plans import catalog, store

SF = "/root/testdata/sf0.001"

TEXTS = ["line", "source_platform", "source_id", "title_raw", "brand_raw", "model_raw", "price_raw", "new_car_price_raw", "mileage_raw", "reg_date_raw", "transfer_raw", "city_raw", "detail_url",
    "battery_raw", "range_raw", "battery_health_raw", "fast_charge_raw", "displacement_raw", "gearbox_raw", "emission_raw", "fetched_at"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_wide_projections_of_normalising_stay_out_of_one_method(spark):
    raw = spark.range(3).selectExpr("CASE WHEN id = 0 THEN 'ev' ELSE 'fuel' END AS line", *[f"'{t} ' || id AS {t}" for t in TEXTS[1:]])
    plan = _plan(normalize.validate(normalize.normalize(raw, "2002-01-01")))
    assert not [found for found in re.findall(r"\*\(\d+\) Project \[.*", plan) if "regexp" in found or "upper(" in found]


def test_dedupe_reads_only_what_is_asked_of_it(spark, tmp_path):
    spark.range(10).selectExpr("string(id % 3) AS k", "id AS at", "id AS a", "id AS b").write.parquet(f"{tmp_path}/t")
    last = normalize.dedupe_last(spark.read.parquet(f"{tmp_path}/t"), "k", ["at"])
    read = re.search(r"ReadSchema: (.*)", _plan(last.select("k", "a"))).group(1)
    assert "b:" not in read and "a:" in read
    assert sorted(r.at for r in last.collect()) == [7, 8, 9]


def test_first_query_of_a_shared_table_makes_only_what_it_reads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "_asked", set())
    path = str(tmp_path / "in")
    spark.range(3).write.parquet(path)
    ask = lambda: store.shared(spark, "once", [path], lambda: spark.read.parquet(path).selectExpr("id * 2 AS twice", "id AS unread")).select("twice")
    first = ask()
    assert not store.is_written(spark, "once", [path]) and "unread" not in first._jdf.queryExecution().optimizedPlan().toString()
    second = ask()
    assert store.is_written(spark, "once", [path]) and sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))


def test_normalising_uses_few_lambdas(spark):
    plan = catalog.normalized(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("transform(") < 20  # 34 before, each of them outside compiled code


def test_squeezed_texts_are_cleaned_texts(spark):
    spaces = [chr(i) for i in range(0x10000) if not 0xD800 <= i < 0xE000]
    rows = spark.createDataFrame([(f"a{c}b",) for c in spaces] + [(f"{c}甲 {c}",) for c in spaces] + [(t,) for t in (None, "", " - ", "  ", "甲 乙", "nan")], "t string")
    both = rows.select("t", text.clean_text("t").alias("want"), text.squeeze("t").alias("s")).withColumn("got", text.known("s"))
    assert both.filter("not (want <=> got)").count() == 0


def test_whole_parts_of_numbers(spark):
    rows = spark.createDataFrame([(t,) for t in ("", "0", "-0.5", "1.9", "-12.7", "99999999", "2147483647", "2147483648", "12345678.99999999", "1" * 40)], "t string")
    exact = F.when(F.col("t") != "", F.col("t").try_cast("decimal(38,8)").try_cast("bigint").try_cast("int"))
    assert rows.filter(~numbers.int_value(F.col("t")).eqNullSafe(exact)).count() == 0


def test_reconcile_joins_rows_not_fields(spark, monkeypatch):
    monkeypatch.setattr(store, "_made", {})
    plan = catalog.reconcile(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert not store._made  # writes no table of columns that it doesn't read
    assert "Expand" not in plan  # fields were turned into rows before the join


def test_reconcile_finds_what_differs(spark):
    raw = spark.createDataFrame([("a", "9万", "1元", "3万公里", "2000年5月", "甲"), ("b", None, None, None, "2001款", None)], "k string, price_raw string, new_car_price_raw string, mileage_raw string, reg_date_raw string, brand_raw string")
    clean = spark.createDataFrame([("a", 9.0, 0.5, None, 2000, 5, "乙"), ("b", 1.0, 1.0, 1, 2001, 1, "丙"), ("c", 1.0, 1.0, 1, 2001, 1, "丙")], "k string, price_wan double, new_car_price_wan double, mileage_km int, reg_year int, reg_month int, brand string")
    found = sorted(map(tuple, quality.reconcile(clean, raw, "k").select("k", "field", "expected", "actual").collect()), key=str)
    assert found == [("a", "brand", "甲", "乙"), ("a", "guide", "0.0", "0.5"), ("a", "mileage", "30000", None)]


def test_titles_are_cleaned_only_where_they_are_read(spark):
    df = catalog.normalized(spark, SF).select("line", "vehicle_key", "brand", "price_wan")
    assert "regexp_replace(title_raw" not in df._jdf.queryExecution().optimizedPlan().toString()
    fields = {t: "x" for t in TEXTS} | {"line": "ev", "title_raw": " 比亚迪　 秦PLUS 2021款 "}
    told = [("BYD", "秦"), (None, "秦"), ("byd", None), (" - ", "秦"), ("别 克", " \t")]
    raw = spark.createDataFrame([tuple((fields | {"brand_raw": b, "model_raw": m})[t] for t in TEXTS) for b, m in told], ", ".join(f"{t} string" for t in TEXTS))
    rows = normalize.normalize(raw, "2002-01-01").select("brand", "model", "title_raw").collect()
    assert [tuple(r) for r in rows] == [("比亚迪", m, "比亚迪 秦PLUS 2021款") for m in ("秦", *["秦PLUS"] * 4)]


def test_texts_with_single_blanks_need_no_squeezing(spark):
    rows = spark.createDataFrame([(t,) for t in ("a b c", "United States市", "", None, " a", "a ", "a  b", "a\tb", "甲 乙", "a\u3000b")], "t string")
    both = rows.select("t", text.clean_text("t").alias("want"), text.squeeze("t").alias("s")).withColumn("got", text.known("s"))
    assert both.filter("not (want <=> got)").count() == 0
    assert rows.filter(F.col("t").isin("a b c", "United States市", "甲 乙") & F.col("t").rlike(text.UNEVEN)).count() == 0
