"""Raw listings derived from the order tables: the same rows in Spark and (LISTINGS_SQL) in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .store import spread

#: One SELECT that Spark and DuckDB read alike;
LISTINGS_SQL = """
SELECT CASE WHEN l_returnflag = 'A' THEN 'ev' ELSE 'fuel' END AS line,
  'src_' || CAST(l_suppkey % 3 AS string) AS source_platform,
  CAST(l_orderkey AS string) || '-' || CAST(l_linenumber AS string) AS source_id,
  CASE WHEN p_size % 10 = 0 THEN 'BYD ' WHEN p_size % 10 = 1 THEN '大众' ELSE p_brand || ' ' END || p_name || ' ' || CAST(year(l_shipdate) AS string) || '款' AS title_raw,
  CASE WHEN p_size % 10 = 0 THEN 'byd' WHEN p_size % 10 = 1 THEN ' 大众 ' ELSE p_brand END AS brand_raw,
  p_name AS model_raw,
  CASE WHEN l_linenumber = 7 THEN '面议'
       WHEN l_linenumber % 2 = 0 THEN CAST(CAST(floor(l_extendedprice) AS bigint) AS string) || '元'
       ELSE CAST(CAST(floor(l_extendedprice / 1000) AS bigint) AS string) || '万' END AS price_raw,
  CAST(CAST(floor(l_extendedprice * 1.5) AS bigint) AS string) || '元' AS new_car_price_raw,
  CASE WHEN l_linenumber = 6 THEN NULL
       WHEN l_linenumber % 2 = 0 THEN CAST(CAST(floor(l_quantity) AS bigint) * 2000 AS string) || '公里'
       ELSE CAST(CAST(floor(l_quantity) AS bigint) AS string) || '.5万公里' END AS mileage_raw,
  CASE WHEN l_linenumber = 5 THEN CAST(year(l_shipdate) AS string) || '款' ELSE CAST(year(l_shipdate) AS string) || '年' || CAST(month(l_shipdate) AS string) || '月' END AS reg_date_raw,
  CAST(l_linenumber % 4 AS string) || '次' AS transfer_raw,
  CASE WHEN n_nationkey % 9 = 8 THEN '-' ELSE n_name || '市' END AS city_raw,
  '/car/' || CAST(l_orderkey AS string) || '-' || CAST(l_linenumber AS string) || '.html' AS detail_url,
  CASE p_size % 6 WHEN 0 THEN '三元锂电池' WHEN 1 THEN '刀片电池' WHEN 2 THEN 'lfp' WHEN 3 THEN '钠电' WHEN 4 THEN '固态' ELSE NULL END AS battery_raw,
  CAST(60 + p_size % 45 AS string) || '.5%' AS battery_health_raw,
  CASE p_size % 5 WHEN 0 THEN 'CLTC续航' || CAST(200 + p_size * 9 AS string) || 'km' WHEN 1 THEN 'nedc续航 ' || CAST(200 + p_size * 9 AS string) || '公里'
       WHEN 2 THEN CAST(200 + p_size * 9 AS string) || ' 千米' WHEN 3 THEN '续航面议' ELSE '综合续航' || CAST(p_size * 60 AS string) || '公里' END AS range_raw,
  CAST(p_size * 22 AS string) || 'kW' AS fast_charge_raw,
  CAST(p_size % 9 AS string) || '.' || CAST(l_linenumber AS string) || 'T' AS displacement_raw,
  CASE p_size % 7 WHEN 0 THEN '手自一体' WHEN 1 THEN '7挡双离合' WHEN 2 THEN 'CVT无级' WHEN 3 THEN '手动' WHEN 4 THEN 'AMT' WHEN 5 THEN '单速' ELSE '其他' END AS gearbox_raw,
  CASE p_size % 6 WHEN 0 THEN '国六b' WHEN 1 THEN '国 六' WHEN 2 THEN '国五' WHEN 3 THEN '国七' WHEN 4 THEN '国六A' ELSE '--' END AS emission_raw,
  CAST(l_shipdate AS timestamp) AS fetched_at, l_partkey AS part_no, l_suppkey AS supp_no, l_extendedprice AS asked
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
"""
#: "Last" among rows of one key: the latest fetch; the rest makes the order total.
LAST = ["fetched_at", "part_no", "supp_no", "asked"]


TABLES = ("lineitem", "part", "supplier", "nation")


def listings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}
    return listings_of(spark, **tables | {"lineitem": spread(tables["lineitem"], "l_orderkey", "l_linenumber")})


def listings_of(spark: SparkSession, **tables: DataFrame) -> DataFrame:
    """The listings of tables under these names (one may be a stream)."""
    # A lambda keeps this projection, too wide for one method, out of whole-stage code: see functions.text.let().
    line = "CASE WHEN l_returnflag = 'A' THEN 'ev' ELSE 'fuel' END"
    text = LISTINGS_SQL.replace(line, f"element_at(transform(array({line}), x -> x), 1)")
    for t in tables:
        text = text.replace(f"FROM {t} ", f"FROM {{{t}}} ").replace(f"JOIN {t} ", f"JOIN {{{t}}} ")
    return spark.sql(text, **tables)
