"""Typed records from envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom import schema
from fieldloom.functions.text import number
from fieldloom.operators.extract import value_text


def truthy(value_json: Column) -> Column:
    """Whether a JSON value counts as something: not null, false, 0, "", [] or {}."""
    return F.coalesce(~value_json.isin("null", "false", '""', "[]", "{}") & ~F.coalesce(value_json.try_cast("double") == 0, F.lit(False)), F.lit(False))


def _meta(e: str) -> Column:
    return F.struct(
        F.coalesce(F.col(f"{e}.confidence"), F.lit(0.0)).alias("confidence"), F.col(f"{e}.source_url").alias("source_url"),
        F.coalesce(F.col(f"{e}.needs_review"), F.lit(False)).alias("needs_review"), F.col(f"{e}.notes").alias("notes"),
    )


def _filled(kind, **given: Column) -> Column:
    return F.struct(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kind.fields])


def records(envelopes: DataFrame, entities: DataFrame, run_ts: str) -> DataFrame:
    """(entity_id, record) with `schema.RECORD`, one row per entity; one shuffle on entity_id.

    about: only of a truthy value; an object gives its keys, anything else nulls and '' for city and country.
    A key that is there but null where text is required makes the sub-record null, and so does a value of
    the wrong type. acceptance_rate: of any value; zero and '' give a null percentage, text that is no
    number a null sub-record. visa_policy: an object gives the registry's country and its visa_type,
    anything else '' and the value as text. Parts that no rule fills are null or empty lists.
    """
    keep = ("about_raw", "acceptance_raw", "visa_raw")
    e = F.struct("value_json", "confidence", "source_url", "needs_review", "notes")
    by_key = [F.first(F.when(F.col("storage_key") == k, e), ignorenulls=True).alias(k) for k in keep]
    rows = entities.join(envelopes.filter(F.col("storage_key").isin(*keep)).groupBy("entity_id").agg(*by_key), "entity_id", "left")

    about = F.col("about_raw.value_json")
    v = F.try_parse_json(about)
    is_object = lambda x: F.coalesce(F.schema_of_variant(F.try_parse_json(x)).startswith("OBJECT"), F.lit(False))
    kind = lambda key: F.schema_of_variant(F.try_variant_get(v, f"$.{key}", "variant"))
    whole = lambda key: F.try_variant_get(v, f"$.{key}", "int")
    place = lambda key: F.when(is_object(about) & kind(key).isNotNull(), F.try_variant_get(v, f"$.{key}", "string")).otherwise("")
    bad = F.lit(False)
    for key in ("location_city", "location_country"):
        bad = bad | (is_object(about) & F.coalesce(kind(key) != "STRING", F.lit(False)))
    for key in ("founding_year", "ranking_qs"):
        bad = bad | (is_object(about) & F.coalesce(kind(key) != "VOID", F.lit(False)) & whole(key).isNull())
    typed_about = F.when(
        truthy(about) & ~bad,
        _filled(schema.ABOUT, name=F.col("name"), founding_year=whole("founding_year"), ranking_qs=whole("ranking_qs"), location_city=place("location_city"), location_country=place("location_country"), institution_type=F.try_variant_get(v, "$.institution_type", "string"), meta=_meta("about_raw")),
    )

    rate = F.col("acceptance_raw.value_json")
    percent = number(value_text(rate))
    typed_rate = F.when(rate.isNotNull() & (~truthy(rate) | percent.isNotNull()), _filled(schema.ACCEPTANCE_RATE, overall_percent=F.when(truthy(rate), percent), meta=_meta("acceptance_raw")))

    visa = F.col("visa_raw.value_json")
    typed_visa = F.when(
        truthy(visa),
        _filled(
            schema.VISA_POLICY,
            country=F.when(is_object(visa), F.coalesce("country", F.lit(""))).otherwise(""),
            visa_type=F.when(is_object(visa), F.try_variant_get(F.try_parse_json(visa), "$.visa_type", "string")).otherwise(value_text(visa)),
            key_requirements=F.array(),
            meta=_meta("visa_raw"),
        ),
    )
    empty = {f.name: F.array() for f in schema.RECORD.fields if f.dataType.typeName() == "array"}
    record = _filled(
        schema.RECORD, **empty, university_id=F.col("entity_id"), university_name=F.col("name"), about=typed_about, acceptance_rate=typed_rate, visa_policy=typed_visa,
        scrape_timestamp=F.lit(run_ts), overall_confidence=F.coalesce(F.col("about_raw.confidence"), F.lit(0.0)),
    )
    return rows.select("entity_id", record.alias("record"))


def listed_values(text: Column, item: str) -> Column:
    """A list literal in text, quoted either way, as an array of structs of type `item`; null where it does not parse."""
    return F.from_json(text, f"array<struct<{item}>>")
