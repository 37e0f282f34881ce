"""The whole run as one plan per stage: route, extract, score, type, store, report."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fieldloom import schema
from fieldloom.functions.text import url_base
from fieldloom.operators.extract import Extractor, envelopes, extract, prompt, route_pages
from fieldloom.operators.report import markdown, spot_checks
from fieldloom.operators.store import Store, raw_rows
from fieldloom.operators.typed import records
from fieldloom.operators.validate import rollup, score_fields
from fieldloom.sources.pages import PAGE_GAP, fetch, page_texts
from fieldloom.sources.registry import distinct_urls, load_registry, page_list
from fieldloom.sources.robots import fetch_policies, gate, robots_get

log = logging.getLogger("fieldloom")
#: Fixed value: seconds between extraction requests.
EXTRACT_PAUSE = 3.0


def requests(registry: DataFrame, texts: DataFrame) -> DataFrame:
    """One request per entity and route: prompt, prompt_name, text, url and the route's columns."""
    spark = registry.sparkSession
    entities = registry.select(F.col("id").alias("entity_id"), "name", "country", "currency")
    routed = route_pages(entities, texts, schema.routes(spark))
    return routed.withColumn("prompt", prompt(F.col("name"), F.col("country"), F.col("currency"), F.col("url"), F.col("prompt_name"), F.col("text")))


def process(registry: DataFrame, found: DataFrame, as_of: str, run_ts: str) -> tuple[DataFrame, DataFrame]:
    """(entity_id, record) and (entity_id, rollup columns) of envelopes."""
    spark = registry.sparkSession
    entities = registry.select(F.col("id").alias("entity_id"), "name", "country", "currency")
    scores = score_fields(found, schema.routes(spark), entities, as_of)
    return records(found, entities, run_ts), rollup(scores)


def stored_rows(registry: DataFrame, found: DataFrame, as_of: str, run_ts: str) -> dict[str, DataFrame]:
    """Rows for the three tables. `universities.overall_confidence` is the quality score; the record has its own."""
    typed, reports = process(registry, found, as_of, run_ts)
    whole = {"ignoreNullFields": "false"}
    ts = F.lit(run_ts).cast("timestamp_ntz")
    report = F.struct(F.col("entity_id").alias("university_id"), "fields", "critical_issues", "overall_quality_score", "ready_for_storage")
    entities = typed.join(reports, "entity_id").select(
        F.col("entity_id").alias("id"), F.col("record.university_name").alias("name"), ts.alias("scraped_at"), F.col("overall_quality_score").alias("overall_confidence"), F.to_json("record", whole).alias("data_json")
    )
    checked = reports.select(
        F.col("entity_id").alias("university_id"), F.to_json(report, whole).alias("report_json"), F.col("overall_quality_score").alias("quality_score"),
        F.col("ready_for_storage").cast("int").alias("ready_for_storage"), ts.alias("created_at"),
    )
    return {"raw_fields": raw_rows(found, run_ts), "universities": entities, "validation_reports": checked}


def outputs(registry: DataFrame, found: DataFrame, as_of: str, run_ts: str) -> DataFrame:
    """(entity_id, json): id, name, all envelopes and the validation report, one document per entity."""
    _, reports = process(registry, found, as_of, run_ts)
    envelope = F.struct(F.col("prompt_name").alias("field"), F.try_parse_json("value_json").alias("value"), "confidence", "source_url", "raw_snippet", "needs_review", "notes")
    in_order = F.array_sort(F.collect_list(F.struct("pos", "storage_key", envelope.alias("envelope"))), lambda x, y: x["pos"] - y["pos"])
    fields = found.groupBy("entity_id").agg(F.map_from_entries(F.transform(in_order, lambda x: F.struct(x["storage_key"].alias("k"), x["envelope"].alias("v")))).alias("all"))
    body = F.struct(F.col("id").alias("university_id"), F.col("name"), F.col("all").alias("fields"), F.struct("fields", "critical_issues", "overall_quality_score", "ready_for_storage").alias("validation"))
    joined = registry.select("id", "name", F.col("id").alias("entity_id")).join(fields, "entity_id").join(reports, "entity_id")
    return joined.select("entity_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("json"))


def write_outputs(documents: DataFrame, path: str) -> None:
    """One JSON document per entity, in a folder of its own."""
    documents.write.mode("overwrite").partitionBy("entity_id").text(path)


def watched(found: DataFrame, name: str = "extraction") -> tuple[DataFrame, Observation]:
    """Envelopes whose next action also counts fields tried and found and their mean confidence, at no extra pass."""
    seen = Observation(name)
    return found.observe(seen, F.count("*").alias("tried"), F.count("value").alias("found"), F.avg("confidence").alias("confidence")), seen


def crawl(registry: DataFrame, scratch_path: str, get: Callable | None = None, robots: Callable | None = None, gap: float = PAGE_GAP, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """(entity_id, label, url, text) of a registry's pages: robots, then each distinct url fetched once, politely.

    Policies and pages are written to `scratch_path` before anything reads them, so no host is asked twice.
    """
    spark = registry.sparkSession
    pages = page_list(registry)
    asked = fetch_policies(pages.select(url_base(F.col("url")).alias("base")), robots or robots_get)
    asked.write.mode("overwrite").parquet(f"{scratch_path}/policies")
    gated = gate(distinct_urls(pages), spark.read.parquet(f"{scratch_path}/policies"))
    fetch(gated, get, gap, sleep).write.mode("overwrite").parquet(f"{scratch_path}/pages")
    return page_texts(pages, spark.read.schema(schema.FETCHED).parquet(f"{scratch_path}/pages"))


def run(
    spark: SparkSession, registry: DataFrame, texts: DataFrame, extractor: Extractor, store: Store, scratch_path: str, as_of: str, run_ts: str,
    report_path: str | None = None, pause: float = EXTRACT_PAUSE, skip_empty: bool = False, sleep: Callable[[float], None] = time.sleep,
) -> str | None:
    """Extract every field of every entity, store the three tables at once, and report.

    Replies are written to `scratch_path` before anything reads them, so the extractor is asked once per
    request. What was tried and found is logged, from a count that rides along with the first upsert. The
    report is written to `report_path`, line by line, and that path returned; without a path its text is.
    None for an empty store.
    """
    extract(requests(registry, texts), extractor, skip_empty, pause, sleep).write.mode("overwrite").parquet(scratch_path)
    found, seen = watched(envelopes(spark.read.parquet(scratch_path)))
    store.create()
    store.upsert_all(stored_rows(registry, found, as_of, run_ts))
    log.info("%(tried)s fields tried, %(found)s found, mean confidence %(confidence)s", seen.get)
    parsed = F.from_json("report_json", schema.REPORT).alias("r")
    reports = store.read("universities").select("id", "name").join(store.read("validation_reports").select(F.col("university_id").alias("id"), parsed), "id", "left").select("id", "name", "r.fields", "r.critical_issues")
    entities = store.read("universities").select(F.col("id").alias("entity_id"))
    return markdown(reports, spot_checks(store.read("raw_fields"), entities, schema.routes(spark)), report_path)


def start(spark: SparkSession, registry_path: str, extractor: Extractor, store: Store, scratch_path: str, as_of: str, run_ts: str, report_path: str | None = None, get: Callable | None = None, robots: Callable | None = None, gap: float = PAGE_GAP, **options) -> str | None:
    """From a registry file to the report: `crawl`, then `run` (which takes the options)."""
    registry = load_registry(spark, registry_path)
    texts = crawl(registry, f"{scratch_path}/crawl", get, robots, gap, options.get("sleep", time.sleep))
    return run(spark, registry, texts, extractor, store, f"{scratch_path}/replies", as_of, run_ts, report_path, **options)
