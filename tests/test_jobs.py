"""Jobs that write and read files, and rules on rows that no registered query holds."""

import gzip

import pytest
from pyspark.sql import functions as F

from forecourt.functions import classify, keys, numbers
from forecourt.operators import frontier, ingest, ledger, market, market_state, normalize, quality, read, upsert
from forecourt.plans import store
from forecourt.sources import cards, detail, pages
from forecourt.streaming import jobs

RAW = ["source_platform", "source_id", "title_raw", "brand_raw", "model_raw", "price_raw", "new_car_price_raw", "mileage_raw", "reg_date_raw", "transfer_raw", "city_raw", "detail_url",
    "battery_raw", "range_raw", "battery_health_raw", "fast_charge_raw", "displacement_raw", "gearbox_raw", "emission_raw"]


def raw(spark, *rows):
    schema = "line string, fetched_at timestamp, " + ", ".join(f"{c} string" for c in RAW)
    return spark.createDataFrame([], schema) if not rows else spark.createDataFrame([tuple(r.get(c) for c in ["line", "fetched_at", *RAW]) for r in rows], schema)


def test_normalize_rows_of_nulls_and_extra_columns(spark):
    full = {"line": "ev", "source_platform": "src", "source_id": "1", "title_raw": "比亚迪 汉 2021款", "price_raw": "15.98-16.50万", "new_car_price_raw": "20.98万", "mileage_raw": "3.2万公里", "reg_date_raw": "2021-03", "battery_raw": "刀片", "battery_health_raw": "94%", "range_raw": "NEDC续航 468公里"}
    rows = raw(spark, full, {"line": "ev"}, {"line": "fuel", "title_raw": "面议", "price_raw": "99999999999999999999万", "mileage_raw": "9" * 40, "transfer_raw": "9" * 30}, {})
    rows = rows.withColumns({"_price": F.lit("clash"), "brand": F.lit("clash"), "vehicle_key": F.lit("clash")})
    found = normalize.validate(normalize.normalize(rows, "2024-01-01", "https://x.example.org")).collect()
    first = next(r for r in found if r["source_id"] == "1")
    assert (first["brand"], first["model"], float(first["price_wan"]), float(first["retention_rate"]), first["mileage_km"], first["reg_year"], first["reg_month"], first["battery_type"], float(first["battery_health"]), first["range_km"], first["range_standard"], first["violations"]) == ("比亚迪", "汉", 15.98, 0.7617, 32000, 2021, 3, "磷酸铁锂", 94.0, 468, "NEDC", [])
    assert all(r["violations"] for r in found if r["source_id"] is None) and len(found) == 4
    assert normalize.normalize(raw(spark), "2024-01-01").count() == 0


def test_fallback_key_and_hint(spark):
    row = spark.createDataFrame([(None, "A", "1万", "奔驰C级 2020款")], "id string, t string, p string, title string")
    key = row.select(keys.vehicle_key(F.lit("platform_name"), "id", keys.fingerprint("t", "p")).alias("k"), classify.split_title("title", F.lit("奔驰")).alias("s")).first()
    assert key["k"].startswith("platform_") and len(key["k"]) == 41 and key["s"]["brand"] == "奔驰"


def test_many_alias_lengths(spark):
    aliases = {"x" * n: f"brand{n}" for n in range(1, 100)}
    names = spark.createDataFrame([("a", "x" * 99 + "tail"), ("b", "XX"), ("c", "none"), ("d", None)], "id string, name string")
    found = {r["id"]: r["brand"] for r in classify.join_brand(names, classify.brand_dimension(spark, aliases), "id", "name").collect()}
    assert found == {"a": "brand99", "b": "brand2", "c": "none", "d": None}


def test_exact_means(spark):
    rows = spark.createDataFrame([("a", "1.01"), ("a", "1.02"), ("b", "0.01"), ("b", None), ("c", None)], "k string, v string").withColumn("v", F.col("v").cast("decimal(10,2)"))
    found = {r["k"]: r["m"] for r in rows.groupBy("k").agg(market.mean("v", 2, 2).alias("m")).collect()}
    assert found == {"a": 1.02, "b": 0.01, "c": None}  # 1.015 goes up


def listings(spark, n, line="ev"):
    clean = normalize.normalize(raw(spark, *[{"line": line, "source_platform": "s", "source_id": f"{line}{i}", "price_raw": "5万", "new_car_price_raw": "9万"} for i in range(n)]), "2024-01-01")
    return lambda ids: upsert.prepare(clean.filter(F.col("source_id").isin([f"{line}{i}" for i in ids])), "2024-01-01")


def state(table, delete_after=2):
    return sorted((r["source_id"], r["missing_count"], r["is_deleted"]) for r in table.read(delete_after).collect())


def test_runs_age_only_their_line_and_are_idempotent(spark, tmp_path):
    ev, fuel = listings(spark, 4), listings(spark, 2, "fuel")
    table = ledger.RunTable(spark, str(tmp_path / "t"), ev([]).schema, buckets=4)
    assert table.apply(ev([0, 1]).unionByName(fuel([0, 1])), "one") == {"rows": 4, "inserted_ev": 2, "updated_ev": 0, "inserted_fuel": 2, "updated_fuel": 0}
    assert table.apply(ev([1, 2]), "two") == {"rows": 2, "inserted_ev": 1, "updated_ev": 1, "inserted_fuel": 0, "updated_fuel": 0}
    assert table.apply(ev([1, 2]), "two") == {}  # the same run again
    want = [("ev0", 1, False), ("ev1", 0, False), ("ev2", 0, False), ("fuel0", 0, False), ("fuel1", 0, False)]
    assert state(table) == want
    assert table.apply(ev([]), "three")["rows"] == 0  # nothing accepted: nothing ages
    assert state(table) == want
    table._write(ev([3]).withColumn("_run", F.lit("broken")), *table._current())  # a run that broke off before its ledger row
    assert state(table) == want
    table.apply(ev([2]), "four")
    table.compact()
    table.compact()
    assert state(table) == [("ev0", 2, True), ("ev1", 1, False), ("ev2", 0, False), ("fuel0", 0, False), ("fuel1", 0, False)]
    again = ledger.RunTable(spark.newSession(), str(tmp_path / "t"), ev([]).schema, buckets=16)  # the files know their buckets
    again.apply(ev([0]), "five")
    assert state(table) == state(again) == [("ev0", 0, False), ("ev1", 2, True), ("ev2", 1, False), ("fuel0", 0, False), ("fuel1", 0, False)]


def test_empty_table(spark, tmp_path):
    table = ledger.RunTable(spark, str(tmp_path / "t"), listings(spark, 1)([]).schema)
    table.compact()
    assert table.read().count() == 0 and not table.has_run("x")


def test_a_run_writes_what_it_saw_and_no_plan_shuffles_the_table(spark, tmp_path):
    clean = spark.range(50_000).select(F.lit("ev").alias("line"), F.format_string("key%08d", "id").alias("vehicle_key"), F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("text"), F.lit(0).alias("missing_count"), F.lit(False).alias("is_deleted"))
    table = ledger.RunTable(spark, str(tmp_path / "t"), clean.schema, buckets=4)
    size = lambda: sum(f.stat().st_size for f in (tmp_path / "t").rglob("*.parquet"))
    table.apply(clean, "all")
    whole = size()
    few = clean.filter("vehicle_key < 'key00000500'")
    assert table.apply(few, "few")["updated_ev"] == 500
    assert size() - whole < 0.04 * whole
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(vehicle_key" not in plan and "SelectedBucketsCount" in plan
    merged = upsert.merge(table.read(), few, ran=True)._jdf.queryExecution().executedPlan().toString()
    assert merged.count("Exchange hashpartitioning(_k") + merged.count("Exchange hashpartitioning(vehicle_key") <= 1  # of the batch
    assert table.read().filter("missing_count = 1").count() == 49_500


def test_run_log_keeps_known_columns(spark, tmp_path):
    rows = spark.createDataFrame([("src", "x" * 3000, 1, "2024-01-01 00:00:00", None)], "source_platform string, error_detail string, odd int, started_at string, finished_at string")
    upsert.append_run_log(rows, str(tmp_path / "log"))
    upsert.append_run_log(rows.withColumn("finished_at", F.lit("2024-01-01 00:01:01.256")), str(tmp_path / "log"))
    log = upsert.read_run_log(spark, str(tmp_path / "log"))
    found = quality.log_rows(log).orderBy(F.col("seconds").asc_nulls_first()).collect()
    assert "odd" not in log.columns and [r["seconds"] for r in found] == [None, 61.3] and {len(r["detail"]) for r in found} == {300}
    assert log.agg(F.max(F.length("error_detail"))).first()[0] == 2000
    assert upsert.recent_runs(log, 1).count() == 1
    assert [r[0] for r in log.select(numbers.seconds_between("started_at", "finished_at")).collect() if r[0]] == [61.26]


def test_drift_stops_the_job(spark):
    rows = spark.createDataFrame([("a", ""), ("a", "x"), ("b", "y")], "g string, f string")
    missing = quality.field_missing(rows, ["f"], ["g"])
    assert [(r["g"], r["missing"]) for r in quality.drift_gate(missing).collect()] == [("a", 0.5)]
    with pytest.raises(ValueError, match="f"):
        quality.drift_gate(missing, fail=True)
    assert quality.drift_gate(missing.limit(0), fail=True).count() == 0


def test_pages_are_stored_and_read(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.md").write_text("---\ntitle: x\n---\nbody", "utf-8")
    (tmp_path / "raw" / "b.md.gz").write_bytes(gzip.compress(b"packed"))
    (tmp_path / "raw" / "c.html").write_text("<html>")
    found = {r["raw_ref"].rsplit("/", 1)[1]: r["body"] for r in pages.read_pages(spark, str(tmp_path / "raw"), "*.md*").collect()}
    assert found == {"a.md": "---\ntitle: x\n---\nbody", "b.md.gz": "packed"}
    given = spark.createDataFrame([("ev", "2024-01-01", "s", "https://x/1", "body", 200)], "line string, fetch_date string, source string, url string, body string, status int")
    pages.write_pages(given, str(tmp_path / "store"))
    row = spark.read.parquet(str(tmp_path / "store")).first()
    assert len(row["page_id"]) == 16 and row["size"] == 4 and row["source"] == "s"


def test_sitemaps_packed_or_broken(spark, tmp_path):
    (tmp_path / "a.xml.gz").write_bytes(gzip.compress("﻿<?xml version='1.0'?><urlset><url><loc> https://x/1?a=1&amp;b=2 </loc></url></urlset>".encode()))
    (tmp_path / "b.xml").write_text("<sitemapindex><sitemap><loc>https://x/a</loc></sitemap></sitemapindex>")
    (tmp_path / "c.xml").write_text("no map")
    rows = {r["map_url"].rsplit("/", 1)[1]: (r["is_index"], r["url"]) for r in frontier.sitemap_urls(frontier.read_sitemaps(spark, str(tmp_path))).collect()}
    assert rows == {"a.xml.gz": (False, "https://x/1?a=1&b=2"), "b.xml": (True, "https://x/a"), "c.xml": (False, None)}


CARD = """<ul class="list"><li class="car card"><a href="/car/1234567.html"><h3 class="title">  比亚迪 <b>汉</b>  2021款 </h3></a><span class="price">15.98<i>万</i></span>
<span class="info-date">2021年3月</span><em class="km">1.2万公里</em><span class="soh">电池健康度 94%</span></li><li class="car"><p>no title</li></ul>"""


def test_cards_with_their_fields(spark):
    by = {"card": "ul.list > li[class*='car']", "title": "h3.title, .name", "price": ".price", "link": "a::attr(href)", "mileage": ".none", "battery_health": ".soh"}
    sources = spark.createDataFrame([("s", "https://x.example.org/", by)], "key string, base_url string, selectors map<string,string>")
    given = spark.createDataFrame([(1, "s", CARD), (2, "s", ""), (3, "s", None), (4, "s", "<ul>" + "<li>open" * 20_000), (5, "s", "<div>" * 20_000 + CARD)], "page_id long, source string, html string")
    found, errors = cards.extract_cards(given, sources)
    rows = {r["page_id"]: r for r in found.collect()}
    assert sorted(rows) == [1, 5] and sorted(r["page_id"] for r in errors.collect()) == [2, 3, 4]
    r = rows[1]
    assert (r["title_raw"], r["price_raw"], r["reg_date_raw"], r["mileage_raw"], r["battery_health_raw"], r["source_id"], r["detail_url"], r["city_raw"]) == ("比亚迪 汉 2021款", "15.98 万", "2021年3月", "2021年3月", "电池健康度 94%", "1234567", "https://x.example.org/car/1234567.html", None)
    hits = {r["field"]: (r["hits"], r["missing"]) for r in cards.card_hits(found, ["title_raw", "city_raw"]).collect()}
    assert hits["title_raw"] == (2, False) and hits["city_raw"] == (0, True)


def test_url_of_a_page_without_one_is_its_file(spark):
    rows = spark.createDataFrame([("file:/raw/ev/123.md", "text"), ("x/9.md", "source: 'https://a/b'\n")], "r string, b string")
    assert [r[0] for r in rows.select(detail.url_of_page(F.col("r"), F.col("b"), "https://x/")).collect()] == ["https://x/123", "https://a/b"]


def test_export_has_its_contract(spark, tmp_path):
    clean = normalize.normalize(raw(spark, {"line": "ev", "source_platform": "s", "source_id": "1", "price_raw": "5万"}), "2024-01-01")
    table = upsert.prepare(clean, "2024-01-02 03:04:05")
    read.export_csv(table, "ev", str(tmp_path / "out"))
    row = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert row.columns == [read.LABELS[c] for c in read.LABELS if c not in normalize.FUEL] and row.first()["抓取时间"] == "2024-01-02 03:04:05"


def test_sources_named_by_key(spark):
    rows = spark.createDataFrame([("a", "ev", False, "http", "allowed"), ("b", "fuel", True, "fixture", "allowed"), ("c", "both", True, "http", "disallowed")], "key string, line string, enabled boolean, tier string, robots_status string")
    assert [r["key"] for r in frontier.select_sources(rows, keys=["a", "b"]).collect()] == ["a"]


def test_written_tables_follow_their_inputs(spark, tmp_path):
    path = str(tmp_path / "in.parquet")
    spark.range(3).write.parquet(path)
    made = lambda: store.written(spark, "test", [path], lambda: spark.read.parquet(path).selectExpr("id * 2 AS twice")).count()
    assert made() == 3
    spark.range(5).write.mode("overwrite").parquet(path)
    assert made() == 5


def test_states_follow_what_runs_change(spark, tmp_path):
    def batch(*rows):
        made = spark.createDataFrame([(line, key, brand, price, km) for line, key, brand, price, km in rows], "line string, vehicle_key string, brand string, price string, mileage_km int")
        made = made.withColumns({"price_wan": F.col("price").cast("decimal(10,2)"), "new_car_price_wan": F.lit("10").cast("decimal(10,2)"), "location_city": F.col("brand"), "reg_year": F.lit(2000), "reg_month": F.lit(None).cast("int")})
        return upsert.prepare(made.drop("price"), "2001-01-01")

    table = ledger.RunTable(spark, str(tmp_path / "t"), batch().schema, buckets=2)
    states = market_state.MarketStates(table)
    assert states.cells().count() == states.values().count() == 0

    def same():
        live = table.read(2).filter("not is_deleted")
        rows = lambda df: sorted(map(str, df.collect()))
        scalars = market_state.line_scalars(states.cells(2), states.values(2), "2002-01-01")
        assert rows(scalars) == rows(market.line_scalars(live, "2002-01-01").select(scalars.columns))
        assert rows(market_state.upper_median(states.values(2))) == rows(market.upper_median(live))
        assert rows(market_state.price_distribution(states.values(2))) == rows(market.distribution(live, F.col("price_wan").cast("double"), market.PRICE_EDGES))
        assert rows(market_state.top_counts(states.cells(2), "brand")) == rows(market.top_counts(live, "brand"))
        assert rows(market_state.brand_price_rank(states.cells(2), 1)) == rows(market.brand_price_rank(live, 1))
        return live.count()

    first = [("ev", "a", "x", "1.00", 10), ("ev", "b", "x", "3.10", None), ("ev", "c", "y", "2.00", 5), ("fuel", "d", None, "9.99", 7)]
    states.apply(batch(*first), "one")
    assert states.apply(batch(*first), "one") == {} and same() == 4
    states.apply(batch(("ev", "a", "y", "1.50", 11), ("ev", "e", "", None, 1)), "two")  # another brand and price, a new row
    assert same() == 5
    states.apply(batch(("ev", "c", "y", "2.00", 5)), "three")  # b falls away
    assert same() == 4
    table.compact()
    states.apply(batch(("ev", "b", "z", "0.00", 5)), "four")  # and comes back; a and e go
    assert same() == 3


def test_a_run_with_states_computes_its_batch_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def tell(key):
        seen.add(1)
        return key

    rows = spark.range(40).select(F.lit("ev").alias("line"), F.udf(tell, "string")(F.col("id").cast("string")).alias("vehicle_key"), F.lit("x").alias("brand"), F.lit("y").alias("location_city"), F.lit("1.50").cast("decimal(10,2)").alias("price_wan"),
        F.lit("10").cast("decimal(10,2)").alias("new_car_price_wan"), F.lit(7).alias("mileage_km"), F.lit(2000).alias("reg_year"), F.lit(5).alias("reg_month"))
    batch = upsert.prepare(rows, "2001-01-01")
    states = market_state.MarketStates(ledger.RunTable(spark, str(tmp_path / "t"), batch.schema, buckets=2))
    assert states.apply(batch, "one")["rows"] == 40 and seen.value == 40
    assert sorted(map(tuple, states.values().select("what", "value", "n").collect())) == [("month", 24005, 40), ("price", 150, 40)]


def test_pages_that_give_nothing_are_counted(spark, tmp_path):
    given = spark.createDataFrame([("a", None, 404), ("b", "x", 200), ("c", None, 200), ("d", None, None)], "raw_ref string, body string, status int").withColumn("fetched_at", F.lit("2001-01-01").cast("timestamp"))
    table = ledger.RunTable(spark, str(tmp_path / "t"), ingest.batch_schema(given))
    log = ingest.ingest_pages(given, table, "s", "one", "2002-01-01", "2002-01-01")
    assert [(r["business_line"], r["status"], r["pages_fetched"], r["fetched_count"], r["parsed_count"], r["error_count"]) for r in log] == [("ev", "failed", 4, 0, 0, 4), ("fuel", "failed", 4, 0, 0, 4)]
    assert log[0]["error_detail"] == "详情页成功 0; 已下架(404) 1; 风控拦截 0; 解析失败 2; 错误: b: not a detail page | c: not a detail page"
    empty = ingest.ingest_pages(given.limit(0), table, "s", "two", "2002-01-01", "2002-01-01", skipped=3, circuit_broken=True)
    assert [(r["status"], r["pages_fetched"]) for r in empty] == [("partial", 0)] * 2 and "续爬跳过 3; 已触发熔断" in empty[0]["error_detail"]
    assert table.read().count() == 0


def test_stored_rows_against_their_pages(spark):
    clean = spark.createDataFrame([("ev", "k1", "p1", "byd", 9.01, None, 10, 2001, 3), ("ev", "k2", "", "x", 1.0, 1.0, 1, None, None), ("ev", "k3", "gone", "x", 1.0, 1.0, 1, None, None), ("ev", "k4", None, "x", 1.0, 1.0, 1, None, None)], "line string, vehicle_key string, raw_ref string, brand string, price_wan double, new_car_price_wan double, mileage_km int, reg_year int, reg_month int")
    stored = spark.createDataFrame([("p1", "brand:BYD\nfull_payment:90100元\nguide_price: 120000元\nmileage:11公里\nfirst_register:2001-03"), ("p2", None)], "raw_ref string, body string")
    found = quality.reconcile_pages(clean, stored)
    assert quality.reconcile_page_counts(found).first().asDict() == {"checked": 1, "mismatches": 3, "no_ref": 2, "missing_file": 1}
    assert [(r["vehicle_key"], r["field"], r["expected"], r["actual"]) for r in quality.reconcile_page_samples(found).collect()] == [("k1", "brand", "比亚迪", "byd"), ("k1", "mileage_km", "11", "10"), ("k1", "new_car_price_wan", "12.00", None), ("k3", None, None, None)]


def test_repeats_late_rows_and_open_runs_in_a_stream(spark, tmp_path):
    def put(*rows):
        spark.createDataFrame(list(rows), "k string, ts string, id int").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    at = lambda hm: f"2024-01-01 {hm}:00"
    put(("a", at("10:00"), 2), ("a", at("10:00"), 1), ("b", at("10:10"), 3), (None, at("10:00"), 9))
    put(("a", at("10:30"), 4), ("a", at("09:40"), 5))  # the second is late, but within the delay, and the first of its run
    put(("a", at("15:00"), 6))
    put(("a", at("15:30"), 10))  # a file later the watermark holds for what comes
    put(("b", at("10:20"), 7), ("a", at("20:00"), 8))  # too late: its run has been told
    stream = spark.readStream.schema("k string, ts timestamp, id int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    job = jobs.write_each(jobs.first_rows(stream, "k", "ts", ["id"], "1 hour", "2 hours"), lambda n: str(tmp_path / "out" / f"batch={n}"), str(tmp_path / "checkpoint"), "append")
    job.awaitTermination()
    found = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "out")).select("k", F.date_format("ts", "HH:mm").alias("ts"), "id", "repeats").collect()
    assert sorted(map(tuple, found)) == [("a", "09:40", 5, 4), ("a", "15:00", 6, 2), ("b", "10:10", 3, 1)]  # the last run is still open
    assert job.lastProgress.stateOperators[0].numRowsTotal == 1


def test_rules_of_hosts(spark):
    many = [("a.org", "*", 100 + i, f"/p{i}/", False) for i in range(500)]
    rules = spark.createDataFrame([("a.org", "*", 2, "/", True), ("a.org", "*", 1, "/no", False), ("a.org", "*", 3, "/no/but", True), ("a.org", "*", 0, "/no/but/yes", True), ("a.org", "*", 9, "/no", True), ("a.org", "bot", 0, "/", False), ("b.org", "*", 1, "/x", False), *many], "host string, agent string, ord int, prefix string, allow boolean")
    urls = ["https://a.org", "https://a.org/no?x", "http://a.org/no/but", "https://a.org/no/but/yes/x", "https://a.org/p77/q", "https://b.org/y", "https://b.org/x", "https://b.org/x", "https://c.org/x", "ftp://a.org/no", None]
    found = frontier.apply_rules(spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, url string"), rules)
    assert [r["allowed"] for r in found.orderBy("i").collect()] == [True, False, False, True, True, True, False, False, True, True, True]
    assert [r["allowed"] for r in frontier.apply_rules(found.select("i", "url"), rules, open_without_rules=False).filter("i = 8").collect()] == [False]
    assert frontier.apply_rules(found.select("i", "url"), rules.limit(0)).filter("not allowed").count() == 0


def test_reject_samples_are_cut_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 2).alias("g"), "id", F.lit("t").alias("title_raw"), F.array(F.lit("rule")).alias("violations"))
    rows = rows.unionByName(spark.createDataFrame([(None, 5, "x", ["a", "b"]), (7, 1, "fine", [])], "g long, id long, title_raw string, violations array<string>"))
    found = normalize.reject_samples(rows, ["g"], ["id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Partial")
    got = {(r["g"], r["place"]): (r["rejects"], r["sample"]) for r in found.collect()}
    assert len(got) == 11 and got[None, 1] == (1, "x -> a,b") and got[0, 5] == (500, "t -> rule")


def test_a_missing_day_is_a_drop(spark):
    counts = spark.createDataFrame([("2024-01-01", "a", 10, 2), ("2024-01-03", "a", 10, 0), ("2024-01-02", "b", 9, 0)], "day string, s string, n long, errors long").withColumn("day", F.to_date("day"))
    found = {(r["day"].day, r["s"]): (r["n"], r["change"], r["share"], r["jumped"], r["dominant"], r["failing"]) for r in quality.volume_check(counts, "day", "s").collect()}
    assert found == {(1, "a"): (10, None, 1.0, False, True, True), (2, "a"): (0, -1.0, 0.0, True, False, False), (3, "a"): (10, None, 1.0, False, True, False), (1, "b"): (0, None, 0.0, False, False, False), (2, "b"): (9, None, 1.0, False, True, False), (3, "b"): (0, -1.0, 0.0, True, False, False)}
    assert quality.volume_check(counts.limit(0), "day", "s").count() == 0
