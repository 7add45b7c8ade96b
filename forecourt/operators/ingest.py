"""Pages of one source to runs of the listing table, with the run's counters observed in the write itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..sources import detail, pages
from . import normalize, quality, upsert
from .ledger import RunTable, counters, told

#: Fields whose missing share tells of a change of the pages.
DRIFT_FIELDS = ("title_raw", "price_raw", "reg_date_raw", "mileage_raw")
KEPT = ["fetched_at", "raw_ref"]


def batch_schema(pages_of: DataFrame):
    """The schema of the rows that a run of these pages writes."""
    return _rows(pages_of, "source", "2000-01-01", "2000-01-01")[0][0].schema


def _rows(found: DataFrame, source: str, as_of: str, started_at: str, base_url: str = "", lines: Sequence[str] = ("ev", "fuel")) -> tuple[list[DataFrame], list[Observation]]:
    """Prepared rows, the validated and the parsed rows they come from, and what is observed on the way: pages by class, parsed records and
    missing fields, rows after dedupe, rejects."""
    seen = [Observation() for _ in range(4)]
    by_line = lambda name, condition: [F.count_if((F.col("line") == line) & condition).alias(f"{name}_{line}") for line in lines]
    status = pages.response_class("status") if "status" in found.columns else F.lit("ok")
    classed = found.withColumn("class", status)
    classed = classed.observe(seen[0], F.count(F.lit(1)).alias("pages"), *[F.count_if(F.col("class") == c).alias(c) for c in ("not_found", "blocked", "error")])
    judged = detail.judge_detail_pages(classed.filter("class = 'ok'"), source, base_url, keep=["fetched_at"])
    good, error = F.col("reason").isNull(), F.concat_ws(": ", "raw_ref", "reason")
    missing = [F.count_if(good & F.coalesce(F.col(c).isin("", "-"), F.lit(True))).alias(c) for c in DRIFT_FIELDS]
    judged = judged.observe(seen[1], F.count_if(good).alias("fetched"), F.count_if(~good).alias("parse_error"), *missing, *by_line("records", good), F.min(F.when(~good, error)).alias("first_error"), F.max(F.when(~good, error)).alias("last_error"))
    latest = normalize.dedupe_last(judged.filter(good), "vehicle_key", ["raw_ref"]).observe(seen[2], *by_line("parsed", F.lit(True)))
    validated = normalize.validate(normalize.normalize(latest, as_of, base_url or None, keep=KEPT))
    bad, sample = F.size("violations") > 0, F.concat_ws(" -> ", "title_raw", F.array_join("violations", ","))
    shown = [f(F.when(bad & (F.col("line") == line), sample)).alias(f"{name}_reject_{line}") for line in lines for name, f in (("first", F.min), ("last", F.max))]
    validated = validated.observe(seen[3], *by_line("rejected", bad), *shown)
    return [upsert.prepare(normalize.accepted(validated), started_at), validated, judged], seen


def ingest_pages(found: DataFrame, table: RunTable, source: str, run_id: str, as_of: str, started_at: str, base_url: str = "", lines: Sequence[str] = ("ev", "fuel"), skipped: int = 0, circuit_broken: bool = False, threshold: float = quality.DRIFT) -> list[dict]:
    """found(raw_ref, body, fetched_at and, where they were fetched, status) -> a run of the table, and a row of the run log for each line.

    One pass: pages are classed, parsed, deduplicated (of a key the record with the last raw_ref stays, over both lines), normalised,
    validated and written in one job, whose observed metrics are the counters. Counts before the dedupe's shuffle can be too high if executors
    are lost and tasks are done again; what was written is not. Of rejects and errors the first and the last by their text are named. A run that
    was written before gives no rows of the log.
    """
    if table.has_run(run_id):
        return []
    found_out: dict = {}
    for stage in range(3):
        stages, seen = _rows(found, source, as_of, started_at, base_url, lines)
        if stage == 0:
            written = table.apply(stages[0], run_id)
        else:  # nothing was accepted, or parsed: a plan that comes to nothing drops what it observed, so count what there is
            stages[stage].write.format("noop").mode("overwrite").save()
        for observed in seen[: 4 if stage < 2 else 2]:
            found_out |= told(observed)
        if "pages" in found_out:
            break
    n = lambda name: found_out.get(name) or 0
    missing = max(n(c) for c in DRIFT_FIELDS) / n("fetched") if n("fetched") else 0.0
    log = []
    for line in lines:
        parsed, rejected = n(f"parsed_{line}"), n(f"rejected_{line}")
        failed = n("error") + n("parse_error") > 0
        status = "partial" if circuit_broken else "failed" if not parsed else "partial" if failed or missing > threshold else "success"
        log.append({
            "run_id": run_id, "business_line": line, "source_platform": source, "status": status, "pages_fetched": n("pages"), "fetched_count": n("fetched"), "parsed_count": parsed, **counters(written, line),
            "dup_count": n(f"records_{line}") - parsed, "error_count": n("not_found") + n("parse_error") + n("error") + rejected, "missing_ratio": round(missing, 4), "started_at": started_at,
            "error_detail": error_detail(found_out, line, skipped, circuit_broken),
        })
    return log


def error_detail(counted: dict, line: str, skipped: int = 0, circuit_broken: bool = False) -> str:
    """What the run log says of a run, 2000 characters at most."""
    n = lambda name: counted.get(name) or 0
    both = lambda a, b: " | ".join(dict.fromkeys(x for x in (counted.get(a), counted.get(b)) if x))
    rejected, samples, errors = n(f"rejected_{line}"), both(f"first_reject_{line}", f"last_reject_{line}"), both("first_error", "last_error")
    # The words of the log.
    parts = [f"详情页成功 {n('fetched')}", f"已下架(404) {n('not_found')}", f"风控拦截 {n('blocked')}", f"解析失败 {n('parse_error')}"]
    parts += [f"续爬跳过 {skipped}"] * bool(skipped) + ["已触发熔断"] * circuit_broken
    parts += [f"校验拒收 {rejected}"] * bool(rejected) + [f"拒收样例: {samples}"] * bool(samples) + [f"错误: {errors}"] * bool(errors)
    return "; ".join(parts)[:2000]
