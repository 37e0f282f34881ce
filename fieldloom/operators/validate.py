"""Scoring rules and the entity rollup, in long form: one row per (entity_id, field)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.functions.text import contains_code, iso_date, number

#: Thresholds and scores, and below the issues' texts.
LOW_CONFIDENCE, READY, CRITICAL = 0.7, 0.6, 0.5
OPTIONAL_MISSING, RULE_MISSING = 0.5, 0.4
CURRENCY_CAP, PERCENT_CAP, DATE_CAP = 0.7, 0.5, 0.6


def _verdict(score: Column, issue: Column) -> Column:
    return F.struct(score.cast("double").alias("score"), F.array_compact(F.array(issue.cast("string"))).alias("issues"))


def check_generic(name: Column, value: Column, confidence: Column, required: Column) -> Column:
    """Missing: 0 if required, else 0.5, with an issue. Present: the confidence, with an issue below 0.7."""
    c = F.coalesce(confidence, F.lit(0.0))
    missing = F.when(required, F.concat(name, F.lit(": missing (required)"))).otherwise(F.concat(name, F.lit(": not found (optional)")))
    low = F.when(c < LOW_CONFIDENCE, F.concat(name, F.lit(": low confidence ("), F.format_string("%.2f", c), F.lit(")")))
    return F.when(value.isNull(), _verdict(F.when(required, 0.0).otherwise(OPTIONAL_MISSING), missing)).otherwise(_verdict(c, low))


def check_currency(value: Column, confidence: Column, notes: Column, currency: Column) -> Column:
    """Missing: 0. The expected code in neither value nor notes: an issue, and at most 0.7."""
    c = F.coalesce(confidence, F.lit(0.0))
    off = ~contains_code(value, currency) & ~contains_code(F.coalesce(notes, F.lit("")), currency)
    issue = F.when(off, F.concat(F.lit("tuition: currency may not match expected "), currency))
    return F.when(value.isNull(), _verdict(F.lit(0.0), F.lit("tuition_fees: not found"))).otherwise(_verdict(F.when(off, F.least(c, F.lit(CURRENCY_CAP))).otherwise(c), issue))


def check_percent(value: Column, confidence: Column) -> Column:
    """Missing: 0.4. No number: an issue, and at most 0.5. Outside 0..100: 0."""
    c, rate = F.coalesce(confidence, F.lit(0.0)), number(value)
    return (
        F.when(value.isNull(), _verdict(F.lit(RULE_MISSING), F.lit("acceptance_rate: not found")))
        .when(rate.isNull(), _verdict(F.least(c, F.lit(PERCENT_CAP)), F.lit("acceptance_rate: could not parse as number")))
        .when((rate < 0) | (rate > 100), _verdict(F.lit(0.0), F.concat(F.lit("acceptance_rate: implausible value "), rate.cast("string"))))
        .otherwise(_verdict(c, F.lit(None)))
    )


def check_deadline(value: Column, confidence: Column, as_of: Column) -> Column:
    """Missing: 0.4. An ISO date before `as_of`: an issue, and at most 0.6. Anything else: the confidence."""
    c, past = F.coalesce(confidence, F.lit(0.0)), F.coalesce(iso_date(value) < as_of, F.lit(False))
    issue = F.when(past, F.concat(F.lit("intake_deadlines: deadline "), value, F.lit(" is in the past")))
    return F.when(value.isNull(), _verdict(F.lit(RULE_MISSING), F.lit("intake_deadlines: not found"))).otherwise(_verdict(F.when(past, F.least(c, F.lit(DATE_CAP))).otherwise(c), issue))


def score_fields(envelopes: DataFrame, routes: DataFrame, entities: DataFrame, as_of: str) -> DataFrame:
    """Every (entity, route) with its score and issues; an envelope that is absent counts as missing.

    `envelopes`: entity_id, storage_key, value (text, null if missing), confidence, notes. `entities`:
    entity_id, currency. The ten routes are broadcast; the join is on the long form's key.
    """
    full = entities.select("entity_id", "currency").crossJoin(F.broadcast(routes))
    rows = full.join(envelopes.select("entity_id", "storage_key", "value", "confidence", "notes"), ["entity_id", "storage_key"], "left")
    name = F.coalesce(F.when(F.col("required"), F.col("spot_name")), F.col("report_key"))
    verdict = (
        F.when(F.col("rule") == "currency", check_currency(F.col("value"), F.col("confidence"), F.col("notes"), F.col("currency")))
        .when(F.col("rule") == "percent", check_percent(F.col("value"), F.col("confidence")))
        .when(F.col("rule") == "date", check_deadline(F.col("value"), F.col("confidence"), F.lit(as_of).cast("date")))
        .otherwise(check_generic(name, F.col("value"), F.col("confidence"), F.col("required")))
    )
    return rows.withColumn("verdict", verdict).select("entity_id", "pos", "report_key", "critical", F.col("verdict.score").alias("score"), F.col("verdict.issues").alias("issues"))


def rollup(scores: DataFrame) -> DataFrame:
    """Per entity: mean score to three places, readiness, critical issues in rule order, and the field map. One shuffle."""
    critical = F.when(F.col("critical").isNotNull() & (F.col("score") < CRITICAL), F.struct("pos", F.col("critical").alias("msg")))
    entry = F.struct("pos", F.col("report_key").alias("key"), F.struct("score", "issues").alias("value"))
    fields = F.transform(F.array_sort(F.collect_list(entry)), lambda x: F.struct(x["key"].alias("key"), x["value"].alias("value")))
    return (
        scores.groupBy("entity_id")
        .agg(
            F.map_from_entries(fields).alias("fields"),
            F.transform(F.array_sort(F.collect_list(critical)), lambda x: x["msg"]).alias("critical_issues"),
            F.round(F.avg("score"), 3).alias("overall_quality_score"),
        )
        .withColumn("ready_for_storage", F.col("overall_quality_score") >= READY)
    )
