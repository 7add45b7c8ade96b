"""What a crawl would fetch next, as joins: sitemaps, sampling, permission rules and finished URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def page_urls(sources: DataFrame) -> DataFrame:
    """sources(key, url_template, max_pages) -> a row for each page 1..max_pages."""
    return sources.filter("max_pages > 0").withColumn("page", F.explode(F.sequence(F.lit(1), F.col("max_pages")))).select("key", "page", F.replace("url_template", F.lit("{page}"), F.col("page").cast("string")).alias("url"))


def _unescape(c: Column) -> Column:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def read_sitemaps(spark: SparkSession, path: str) -> DataFrame:
    """map_url (the file's path), xml of every file under path; those that end in .gz are opened."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    return files.select(F.col("_metadata.file_path").alias("map_url"), F.col("value").alias("xml"))


def sitemap_urls(sitemaps: DataFrame) -> DataFrame:
    """sitemaps(map_url, xml) -> map_url, is_index, ord, url of every <loc>; a map without one has url NULL (an error row)."""
    locs = F.regexp_extract_all("xml", F.lit(r"(?s)<(?:\w+:)?loc>\s*(.*?)\s*</(?:\w+:)?loc>"), 1)
    rows = sitemaps.select("map_url", F.contains(F.lower(F.substring("xml", 1, 2000)), F.lit("<sitemapindex")).alias("is_index"), F.posexplode_outer(locs).alias("ord", "url"))
    return rows.withColumn("url", _unescape(F.trim("url")))


def sitemap_walk(index: DataFrame, children: DataFrame, child_limit: int | None = None) -> DataFrame:
    """Two levels: the maps an index names, joined by URL, and their pages with lastmod. Children that can't be read fall out."""
    named = sitemap_urls(index).filter("is_index and url is not null").select(F.col("url").alias("child"), F.col("ord").alias("place"))
    if child_limit is not None:
        named = named.filter(F.col("place") < child_limit)
    blocks = F.regexp_extract_all("xml", F.lit(r"(?s)<url>(.*?)</url>"), 1)
    pages = children.join(named, children.map_url == named.child).select("child", "place", F.posexplode(blocks).alias("ord", "block"))
    got = lambda tag: F.nullif(F.regexp_extract("block", rf"(?s)<{tag}>\s*(.*?)\s*</{tag}>", 1), F.lit(""))
    return pages.select("child", "place", "ord", _unescape(got("loc")).alias("url"), got("lastmod").alias("lastmod")).filter("url is not null")


def even_sample(rows: DataFrame, by: str, order: str, size: int) -> DataFrame:
    """Of each group of n rows those at int(i * (n / size)), i < size; all if size <= 0 or >= n. The numbering is a window over
    one group, as the groups are single sitemaps (50 000 URLs at most by their own standard)."""
    w = Window.partitionBy(by)
    ranked = rows.withColumn("_at", F.row_number().over(w.orderBy(order)) - 1).withColumn("_n", F.count("*").over(w))
    if size <= 0:
        return ranked.drop("_at", "_n")
    # row at is picked if some i has floor(i * step) = at, in double precision; candidates lie next to at / step
    step = F.col("_n").cast("double") / size
    near = F.floor(F.col("_at") / step)
    hit = F.exists(F.array(near, near + 1), lambda i: (i >= 0) & (i < size) & (F.floor(i * step) == F.col("_at")))
    return ranked.filter((F.col("_n") <= size) | hit).drop("_at", "_n")


def dedupe_urls(rows: DataFrame, order: list[str]) -> DataFrame:
    """The first row of each URL."""
    return rows.groupBy("url").agg(F.min(F.struct(*order)).alias("first")).select("url", "first.*")


def apply_rules(urls: DataFrame, rules: DataFrame, agent: str = "*", open_without_rules: bool = True) -> DataFrame:
    """urls(url, ...) with ``allowed``: the first rule (by ord) of the URL's host whose prefix starts its path decides. No such rule: allowed;
    a host without rules at all: as ``open_without_rules`` says; other schemes than HTTP pass.

    A URL's path is cut into its prefixes of the lengths that its host's rules have, and these meet the rules by host and prefix: a host of many
    rules is many keys, and a URL meets only those that apply to it. The URLs' hosts and paths are judged once each.
    """
    own = rules.filter(F.col("agent") == agent)
    # of one prefix the first rule decides; a host has at most as many lengths as its longest prefix has characters
    by_prefix = own.groupBy("host", "prefix").agg(F.min(F.struct("ord", "allow")).alias("rule"))
    lengths = own.groupBy("host").agg(F.collect_set(F.char_length("prefix")).alias("_lengths"))
    rows = urls.withColumns({"host": F.nullif(F.regexp_extract("url", r"^https?://([^/?#]+)", 1), F.lit("")), "_path": F.coalesce(F.nullif(F.regexp_extract("url", r"^[a-z]+://[^/?#]*([^?#]*)", 1), F.lit("")), F.lit("/"))})
    met = rows.filter("host is not null").select("host", "_path").distinct().join(lengths, "host")
    cut = met.select("host", "_path", F.explode(F.filter("_lengths", lambda n: n <= F.char_length("_path"))).alias("_n")).select("host", "_path", F.expr("substring(_path, 1, _n)").alias("prefix"))
    first = cut.join(by_prefix, ["host", "prefix"]).groupBy("host", "_path").agg(F.min("rule").alias("_rule"))
    judged = rows.join(lengths.select("host", F.lit(True).alias("_known")), "host", "left").join(first, ["host", "_path"], "left")
    verdict = F.when(F.col("host").isNull(), True).when(F.col("_known").isNull(), open_without_rules).otherwise(F.coalesce("_rule.allow", F.lit(True)))
    return judged.withColumn("allowed", verdict).drop("_path", "_known", "_rule")


def query_allowed(url: str, allow_query: str) -> Column:
    return F.col(allow_query) | ~F.contains(F.col(url), F.lit("?"))


def pending(found: DataFrame, done: DataFrame) -> DataFrame:
    """URLs not finished yet; one finished with class not_found may come back."""
    return found.join(done.filter("class != 'not_found'").select("url"), "url", "left_anti")


def skipped_counts(found: DataFrame, done: DataFrame, by: str) -> DataFrame:
    hit = found.join(done.filter("class != 'not_found'").select("url", F.lit(1).alias("_done")).distinct(), "url", "left")
    return hit.groupBy(by).agg(F.count("*").alias("found"), F.count("_done").alias("skipped"), (F.count("*") - F.count("_done")).alias("pending"))


def select_sources(sources: DataFrame, line: str = "all", keys: list[str] | None = None) -> DataFrame:
    """Named sources pass as they are; else those of the line (or both) that are enabled and not disallowed. Fixtures never."""
    real = sources.filter("tier != 'fixture'")
    if keys:
        return real.filter(F.col("key").isin(*keys))
    rows = real.filter("enabled and robots_status != 'disallowed'")
    return rows if line == "all" else rows.filter(F.col("line").isin(line, "both"))


def target_lines(task="task", line="line") -> Column:
    """The lines of a task: the task's own if it names one, else the source's, else both."""
    lines = F.array(F.lit("ev"), F.lit("fuel"))
    named = lambda c: F.when(F.array_contains(lines, F.col(c)), F.array(F.col(c)))
    return F.coalesce(named(task), named(line), lines)


def verdict(enabled="enabled", status="robots_status", live="live_allowed") -> Column:
    return F.when(~F.col(enabled), "disabled").when(F.col(status) == "disallowed", "disallowed").when(~F.col(live), "live_denied").when(F.col(live), "live_allowed").otherwise("pending")
