"""Queries over the driver's tables, one per group of operators, with their DuckDB twins in `oracle`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldloom import schema
from fieldloom.functions.text import PROMPT_CAP, html_to_text, normal_url, url_base
from fieldloom.operators import merge, report, store, typed, validate
from fieldloom.operators.extract import parse_reply, prompt, route_pages, value_text
from fieldloom.plans.run import outputs
from fieldloom.sources.pages import fetch_summary
from fieldloom.sources.registry import page_list
from fieldloom.sources.robots import gate

AS_OF = "1998-01-01"
RUN_TS = "2024-01-01T00:00:00"
#: Fields of the events table in the order of their names, as positions in a report.
EVENT_FIELDS = ("click", "error", "purchase", "signup", "view")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as extractions: entity, field, value, confidence, needs_review, observed_at, seq."""
    k = F.get_json_object("props", "$.k").cast("int")
    return _read(spark, sf_dir, "events").select(
        F.col("user_id").alias("entity_id"), F.col("event_type").alias("field"), "value", (k / 100).alias("confidence"), (k < 70).alias("needs_review"), F.col("ts").alias("observed_at"), F.col("event_id").alias("seq")
    )


def newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.latest(ext(spark, sf_dir), ["entity_id", "field"], ["observed_at", "seq"])


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest extraction of each key with its rule: percent for values of purchases, generic else; clicks are required."""
    value, c = F.col("value").cast("string"), F.col("confidence")
    verdict = F.when(F.col("field") == "purchase", validate.check_percent(value, c)).otherwise(validate.check_generic(F.col("field"), value, c, F.col("field") == "click"))
    return newest(spark, sf_dir).withColumn("v", verdict).select("entity_id", "field", F.round("v.score", 6).alias("score"), F.col("v.issues").alias("issues"))


def q01_html_text(spark, d):
    text = html_to_text(F.col("html"), cap=None)
    return _read(spark, d, "pages").select("page_id", text.alias("text")).select(
        "page_id", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"), F.md5(F.substring("text", 1, PROMPT_CAP)).alias("prompt_md5")
    )


def q02_fetch_summary(spark, d):
    texts = _read(spark, d, "pages").select(url_base(F.col("url")).alias("entity_id"), html_to_text(F.col("html"), cap=None).alias("text"))
    return fetch_summary(texts).withColumnRenamed("entity_id", "base")


def q03_robots_gate(spark, d):
    pages = _read(spark, d, "pages").select("page_id", "url")
    bases = pages.select(url_base(F.col("url")).alias("base")).distinct()
    rules = F.when(F.col("base").startswith("http:"), "User-agent: *\nDisallow: /de/").when(F.col("base").contains("//m."), "User-agent: *\nDisallow: /")
    policies = bases.select("base", rules.alias("rules")).filter("rules IS NOT NULL")
    return gate(pages, policies).select("page_id", "base", "allowed", F.when(F.col("allowed"), F.col("url")).alias("fetch_url"))


def q04_registry_explode(spark, d):
    """A registry of nations, each with two labelled pages, as its page list."""
    address = lambda page: F.concat(F.lit("https://"), F.lower("n_name"), F.lit(f".example/{page}"))
    held = _read(spark, d, "nation").join(_read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    registry = held.select(F.col("n_nationkey").alias("id"), F.col("r_name").alias("country"), F.create_map(F.lit("about"), address("about"), F.lit("tuition"), address("fees")).alias("pages"))
    return page_list(registry).join(registry.select(F.col("id").alias("entity_id"), "country"), "entity_id").select("entity_id", "country", "label", "url")


def q05_route_fallback(spark, d):
    labels = F.lit(["about", "tuition", "living", "scholarships", "deadlines", "visa", "employment", "courses"])
    page = _read(spark, d, "pages")
    text = F.when(F.col("page_id") % 5 != 0, html_to_text(F.col("html")))
    pages = page.select((F.col("page_id") / 8).cast("long").alias("entity_id"), F.get(labels, (F.col("page_id") % 8).cast("int")).alias("label"), F.when(F.col("page_id") % 7 != 0, F.col("url")).alias("url"), text.alias("text"))
    entities = pages.select("entity_id").distinct()
    routed = route_pages(entities, pages, schema.routes(spark))
    return routed.select("entity_id", "storage_key", F.md5("text").alias("text_md5"), "url", "used_label")


def q06_prompt_render(spark, d):
    docs = _read(spark, d, "documents")
    made = prompt(F.col("source"), F.col("lang"), F.lit("USD"), F.concat(F.lit("doc://"), F.col("doc_id").cast("string")), F.lit("about_university"), F.col("text"))
    return docs.select("doc_id", made.alias("p")).select("doc_id", F.length("p").cast("long").alias("n_chars"), F.md5("p").alias("prompt_md5"))


def q07_envelope_parse(spark, d):
    """Replies built from events in seven shapes: whole, fenced, no JSON, an array, and confidences null, text and absent."""
    k = F.get_json_object("props", "$.k")
    shape = F.col("event_id") % 7
    body = lambda c: F.concat(F.lit('{"value": '), F.col("value").cast("string"), F.lit(', "confidence": '), c, F.lit(', "needs_review": false}'))
    reply = (
        F.when(shape == 0, body(k)).when(shape == 1, F.concat(F.lit("```json\n"), body(k), F.lit("\n```"))).when(shape == 2, F.lit("no such thing")).when(shape == 3, F.lit("[1, 2]"))
        .when(shape == 4, body(F.lit("null"))).when(shape == 5, body(F.lit('"0.9"'))).otherwise(F.lit('{"value": null}'))
    )
    e = _read(spark, d, "events").select("event_id", parse_reply(reply).alias("e"))
    return e.select("event_id", F.round(value_text(F.col("e.value_json")).try_cast("double"), 6).alias("value"), F.round("e.confidence", 6).alias("confidence"), F.col("e.needs_review").alias("needs_review"), F.col("e.notes").alias("notes"))


def q08_upsert_latest(spark, d):
    return newest(spark, d).select("entity_id", "field", F.round("value", 6).alias("value"), F.round("confidence", 6).alias("confidence"), F.col("needs_review").cast("int").alias("needs_review"), "seq")


def q09_upsert_entity(spark, d):
    orders = _read(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderdate").alias("scraped_at"), "o_orderkey", F.col("o_totalprice").alias("overall_confidence"))
    newest_ = store.latest(orders, ["id"], ["scraped_at", "o_orderkey"])
    names = _read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return newest_.join(names, "id").select("id", "name", "scraped_at", F.round("overall_confidence", 2).alias("confidence"))


def _two(spark, d):
    latest_first = Window.partitionBy("entity_id", "field").orderBy(F.col("observed_at").desc(), F.col("seq").desc())
    pair = ext(spark, d).withColumn("i", F.row_number().over(latest_first) - 1).filter("i < 2")
    one = lambda i: pair.filter(F.col("i") == i).select(
        "entity_id", "field", F.when(F.col("seq") % 4 != i, F.floor(F.col("value") / 100).cast("string")).alias("value"), "confidence", F.concat(F.lit("e:"), F.col("seq").cast("string")).alias("source_url"),
        "needs_review", F.lit(None).cast("string").alias("notes"),
    )
    return one(0), one(1)


def q10_merge_sources(spark, d):
    primary, secondary = _two(spark, d)
    merged = merge.merge_sources(primary, secondary, ["entity_id", "field"])
    return merged.select("entity_id", "field", "value", F.round("confidence", 6).alias("confidence"), "source_url", "needs_review", "notes", "outcome")


def _verdicts(rows: DataFrame, verdict) -> DataFrame:
    return rows.withColumn("v", verdict).select(*[c for c in rows.columns if c in ("seq", "doc_id", "o_orderkey")], F.round("v.score", 6).alias("score"), F.array_join("v.issues", "; ").alias("issues"))


def q11_check_generic(spark, d):
    value = F.when(F.col("seq") % 6 != 0, F.col("value").cast("string"))
    return _verdicts(ext(spark, d), validate.check_generic(F.col("field"), value, F.col("confidence"), F.col("field") == "click"))


def q12_check_currency(spark, d):
    text, c = F.when(F.col("doc_id") % 9 != 0, F.col("text")), (F.col("doc_id") % 100) / 100
    notes = F.when(F.col("doc_id") % 4 == 0, "amounts in usd")
    return _verdicts(_read(spark, d, "documents"), validate.check_currency(text, c, notes, F.lit("USD")))


def q13_check_percent(spark, d):
    text = F.when(F.col("seq") % 5 == 0, F.lit("about half")).when(F.col("seq") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit(" "), F.col("value").cast("decimal(10,2)").cast("string"), F.lit("% ")))
    text = F.when(F.col("seq") % 11 == 0, F.concat(F.lit("-"), F.col("value").cast("decimal(10,2)").cast("string"))).otherwise(text)
    v = validate.check_percent(text, F.col("confidence"))
    return ext(spark, d).withColumn("v", v).select("seq", F.round("v.score", 6).alias("score"), F.size("v.issues").cast("long").alias("n_issues"), F.array_join("v.issues", "").alias("issue"))


def q14_check_deadline(spark, d):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    shape = F.col("o_orderkey") % 6
    text = F.when(shape == 0, F.lit(None)).when(shape == 1, F.concat(day, F.lit("T10:00:00+02:00"))).when(shape == 2, F.replace(day, F.lit("-"), F.lit(""))).when(shape == 3, F.concat(day, F.lit(" or so"))).when(shape == 4, F.lit("2025-02-30")).otherwise(day)
    return _verdicts(_read(spark, d, "orders"), validate.check_deadline(text, (F.col("o_orderkey") % 100) / 100, F.lit(AS_OF).cast("date")))


def _rolled(spark, d) -> DataFrame:
    """The rollup of every entity's newest extractions, by rules of the five event types."""
    routes = spark.createDataFrame([(i, f, f, f, "percent" if f == "purchase" else "generic", f == "click", f"{f} missing or implausible" if f in ("click", "purchase") else None) for i, f in enumerate(EVENT_FIELDS)], "pos int, storage_key string, report_key string, spot_name string, rule string, required boolean, critical string")
    found = newest(spark, d).select("entity_id", F.col("field").alias("storage_key"), F.col("value").cast("string").alias("value"), "confidence", F.lit(None).cast("string").alias("notes"))
    entities = _read(spark, d, "customer").select(F.col("c_custkey").alias("entity_id"), F.lit("USD").alias("currency"))
    return validate.rollup(validate.score_fields(found, routes, entities, AS_OF))


def q15_entity_quality(spark, d):
    """Every customer's score, readiness and field map; those without any event miss all fields."""
    entry = lambda x: F.concat(x["key"], F.lit("="), F.format_string("%.4f", x["value"]["score"]), F.lit(" "), F.array_join(x["value"]["issues"], ";"))
    fields = F.array_join(F.transform(F.map_entries("fields"), entry), ", ")
    return _rolled(spark, d).select("entity_id", F.round("overall_quality_score", 3).alias("quality"), F.col("ready_for_storage").alias("ready"), fields.alias("fields"))


def q16_critical_issues(spark, d):
    return _rolled(spark, d).select("entity_id", F.size("critical_issues").cast("long").alias("n_critical"), F.array_join("critical_issues", ", ").alias("critical"))


def _fields(spark) -> DataFrame:
    return spark.createDataFrame(list(enumerate(EVENT_FIELDS)), "pos int, field string")


def _full(spark, d) -> DataFrame:
    rows = scored(spark, d)
    return report.full_scores(rows, rows.select("entity_id").distinct(), _fields(spark))


def q17_field_entity_pivot(spark, d):
    """Scores of all entities in long form, each with its field's mean: a column an entity does not scale."""
    full = _full(spark, d)
    means = full.groupBy("field").agg(F.round(F.avg("score"), 6).alias("avg_score"))
    return full.join(F.broadcast(means), "field").select("field", "entity_id", F.format_string("%.6f", "score").alias("score"), "avg_score")


def q18_field_averages(spark, d):
    return report.field_averages(_full(spark, d)).select(F.coalesce("field", F.lit("(all)")).alias("field"), F.round("avg_score", 6).alias("avg_score"), F.col("n").cast("long").alias("n"))


def q19_validation_flags(spark, d):
    return report.flags(scored(spark, d))


def q20_value_preview(spark, d):
    docs = _read(spark, d, "documents")
    raw = docs.select(F.col("doc_id").alias("university_id"), F.lit("about_raw").alias("field_name"), F.to_json(F.struct("text")).alias("j")).select("university_id", "field_name", F.regexp_extract("j", r'(?s)^\{"text":(.*)\}$', 1).alias("value_json"))
    labelled = _read(spark, d, "labels").select(F.col("doc_id").alias("entity_id"))
    one = schema.routes(spark).filter("pos = 1")
    return report.spot_checks(raw, labelled, one).select("entity_id", "field", F.md5("extracted").alias("preview_md5"), F.length("extracted").cast("long").alias("n_chars"))


def q21_coverage(spark, d):
    docs = _read(spark, d, "documents").join(_read(spark, d, "labels"), "doc_id", "left")
    rows = docs.select(F.col("source").alias("storage_key"), F.col("quality").alias("value"), F.coalesce("quality", F.lit(0)).cast("double").alias("confidence"))
    return report.coverage(rows).select(F.col("storage_key").alias("source"), "extracted", "attempted", F.round("avg_confidence", 6).alias("avg_confidence"))


def q22_spot_check_rate(spark, d):
    checked = _read(spark, d, "labels").join(_read(spark, d, "documents"), "doc_id").select((F.col("quality") == (F.col("n_chars") > 200).cast("int")).alias("matched"))
    return report.match_rate(checked).select("matched", "checked", F.round("rate", 6).alias("rate"))


def q23_typed_record(spark, d):
    """Records of customers from their newest events: about from view (an object), acceptance from purchase, visa from signup."""
    keys = F.create_map(*[F.lit(x) for x in ("view", "about_raw", "purchase", "acceptance_raw", "signup", "visa_raw")])
    number = F.col("value").cast("decimal(10,2)").cast("string")
    about = F.concat(F.lit('{"founding_year": '), F.col("seq").cast("string"), F.lit(', "location_city": "c'), (F.col("seq") % 7).cast("string"), F.lit('"}'))
    value = F.when(F.col("field") == "view", about).when(F.col("field") == "purchase", F.concat(F.lit('"'), number, F.lit('%"'))).otherwise(F.concat(F.lit('"type '), (F.col("seq") % 3).cast("string"), F.lit('"')))
    found = newest(spark, d).withColumn("storage_key", F.try_element_at(keys, F.col("field"))).filter("storage_key IS NOT NULL").select(F.col("entity_id").cast("string").alias("entity_id"), "storage_key", value.alias("value_json"), "confidence", F.lit("u").alias("source_url"), "needs_review", F.lit(None).cast("string").alias("notes"))
    entities = _read(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("entity_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("country"))
    r = typed.records(found, entities, RUN_TS)
    return r.select("entity_id", F.col("record.university_name").alias("name"), F.col("record.about.founding_year").alias("founding_year"), F.col("record.about.location_city").alias("city"), F.round("record.acceptance_rate.overall_percent", 6).alias("percent"), F.col("record.visa_policy.country").alias("visa_country"), F.col("record.visa_policy.visa_type").alias("visa_type"), F.round("record.overall_confidence", 6).alias("about_confidence"))


def q24_list_text_parse(spark, d):
    item = F.concat(F.lit("{'name': '"), F.replace("p_name", F.lit("'"), F.lit("")), F.lit("', 'value': '"), F.col("p_size").cast("string"), F.lit("'}"))
    text = F.concat(F.lit("["), item, F.lit(", "), item, F.when(F.col("p_partkey") % 10 == 0, ", None]").otherwise("]"))
    parsed = typed.listed_values(text, "name string, value string")
    return _read(spark, d, "part").select("p_partkey", parsed.alias("items")).select("p_partkey", F.size("items").cast("long").alias("n_items"), F.get("items", F.lit(1))["name"].alias("second_name"), F.get("items", F.lit(0))["value"].alias("first_value"))


def q25_dedup_urls(spark, d):
    rows = _read(spark, d, "pages").select("page_id", normal_url(F.col("url")).alias("url"))
    return rows.groupBy("url").agg(F.min("page_id").alias("first_page"), F.count("*").alias("n_pages"))


def _enveloped(spark, d) -> DataFrame:
    """The newest events as envelopes of three routes: views with an object as value, purchases with a number, signups with none."""
    keys = F.create_map(*[F.lit(x) for x in ("view", "about_raw", "purchase", "acceptance_raw", "signup", "visa_raw")])
    number = F.col("value").cast("decimal(10,2)").cast("string")
    value = F.when(F.col("field") == "view", F.concat(F.lit('{"n":'), F.col("seq").cast("string"), F.lit("}"))).when(F.col("field") == "purchase", F.concat(F.lit('"'), number, F.lit('"')))
    held = newest(spark, d).withColumn("storage_key", F.try_element_at(keys, F.col("field"))).filter("storage_key IS NOT NULL").withColumn("value_json", value)
    named = F.broadcast(schema.routes(spark).select("storage_key", "pos", "prompt_name"))
    return held.join(named, "storage_key").select(
        F.col("entity_id").cast("string").alias("entity_id"), "pos", "storage_key", "prompt_name", "value_json", value_text(F.col("value_json")).alias("value"), "confidence", F.concat(F.lit("e:"), F.col("seq").cast("string")).alias("source_url"),
        F.lit(None).cast("string").alias("raw_snippet"), "needs_review", F.when(F.col("seq") % 3 == 0, "third").alias("notes"),
    )


def q26_stored_rows(spark, d):
    return store.raw_rows(_enveloped(spark, d), RUN_TS).withColumn("scraped_at", F.col("scraped_at").cast("string")).withColumn("confidence", F.round("confidence", 6))


def q27_output_documents(spark, d):
    """The JSON document of each customer with events: what it holds, read back from its text."""
    registry = _read(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("country"), F.lit("USD").alias("currency"))
    j = lambda path: F.get_json_object("json", path)
    return outputs(registry, _enveloped(spark, d), AS_OF, RUN_TS).select(
        "entity_id", j("$.name").alias("name"), F.array_join(F.json_object_keys(j("$.fields")), ",").alias("keys"), j("$.fields.about_raw.value.n").cast("long").alias("about_n"), j("$.fields.acceptance_raw.value").alias("acceptance"),
        j("$.fields.visa_raw.field").alias("visa_field"), j("$.fields.about_raw.notes").alias("about_notes"), j("$.validation.overall_quality_score").cast("double").alias("quality"), j("$.validation.ready_for_storage").cast("boolean").alias("ready"),
    )


def q28_entity_listing(spark, d):
    """Customers as stored entities, the newest order of each, as the store lists them."""
    orders = _read(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("name"), F.col("o_orderdate").alias("scraped_at"), F.col("o_totalprice").alias("overall_confidence"), "o_orderkey")
    return store.listing(store.latest(orders, ["id"], ["scraped_at", "o_orderkey"])).withColumn("confidence", F.round("confidence", 2))


def q29_upsert_second_run(spark, d):
    """Events of two runs, by even and odd number: the second replaces the keys it has and leaves the others."""
    rows = ext(spark, d).select("entity_id", "field", F.round("value", 6).alias("value"), F.round("confidence", 6).alias("confidence"), "observed_at", "seq")
    order = ["observed_at", "seq"]
    old = store.latest(rows.filter("seq % 2 = 0"), ["entity_id", "field"], order)
    return store.upserted(old, rows.filter("seq % 2 = 1"), ["entity_id", "field"], order)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("q") and name[1:3].isdigit()}
