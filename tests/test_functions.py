import pytest
from pyspark.sql import functions as F

from forecourt.functions import classify, keys, numbers, text

CASES = [
    (numbers.price_wan, "15.98-16.50万", 15.98), (numbers.price_wan, "1,258,000", 125.80), (numbers.price_wan, "0万", None), (numbers.price_wan, "面议", None), (numbers.price_wan, "abc", None),
    (numbers.mileage_km, "3.2万公里", 32000), (numbers.mileage_km, "58000公里", 58000), (numbers.mileage_km, "未知", None),
    (numbers.reg_year, "2019款 豪华版", 2019), (numbers.reg_month, "2019款 豪华版", None), (numbers.reg_month, "2021-03 上牌", 3),
    (numbers.range_km, "NEDC续航 468公里", 468), (numbers.range_standard, "NEDC续航 468公里", "NEDC"), (numbers.range_km, "续航面议", None),
    (numbers.displacement, "0.1L", None), (numbers.displacement, "1.5T", 1.5), (numbers.percent, "94.5%", 94.5),
    (classify.battery_type, "刀片电池", "磷酸铁锂"), (classify.gearbox, "手自一体", "AT"), (classify.emission, "国七", "未知"), (classify.emission, None, None),
    (classify.normalize_brand, "byd", "比亚迪"), (classify.normalize_brand, "Nobody", "Nobody"), (text.clean_city, "北京市", "北京"), (text.clean_text, " a　 b ", "a b"), (text.clean_text, "--", None),
]


@pytest.mark.parametrize("rule,given,expected", CASES)
def test_rule(spark, rule, given, expected):
    found = spark.createDataFrame([(given,)], "c string").select(rule("c").alias("v")).first()[0]
    assert found == expected if expected is None or isinstance(expected, str) else float(found) == pytest.approx(expected)


def test_ratio(spark):
    row = spark.sql("SELECT 15.98D a, 20.98D b, 0D z").select(numbers.safe_ratio("a", "b").alias("r"), numbers.safe_ratio("a", "z").alias("n")).first()
    assert tuple(row) == (0.7617, None)


def test_title(spark):
    titles = ["大众朗逸 2019款", "大众 朗逸 2019款", "不知名 车 2020款", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "i int, t string").select("i", classify.split_title("t").alias("s")).orderBy("i").collect()
    assert [r["s"] and tuple(r["s"]) for r in rows] == [("大众", "朗逸"), ("大众", "朗逸"), (None, "不知名车"), None]


def test_match_key(spark):
    rows = spark.createDataFrame([("a", 58000), ("a", 57200), (None, 57200)], "b string, km int")
    found = [r[0] for r in rows.select(keys.match_key("b", F.lit("m"), F.lit(2020), "km", F.lit(3))).collect()]
    assert found[0] == found[1] == "a|m|2020|03|11" and found[2] is None
