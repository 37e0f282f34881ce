"""Quality reports as tables, and as Markdown."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.functions.text import PREVIEW_CAP
from fieldloom.operators.extract import value_text
from fieldloom.schema import ROUTES


def full_scores(scores: DataFrame, entities: DataFrame, fields: DataFrame) -> DataFrame:
    """Every (entity_id, field) with its score, 0 where there is none."""
    grid = entities.select("entity_id").crossJoin(F.broadcast(fields.select("field", "pos")))
    return grid.join(scores.select("entity_id", "field", "score"), ["entity_id", "field"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))


def field_averages(full: DataFrame) -> DataFrame:
    """Mean score per field, and over all (field null), in one rollup; the grid is complete, so the grand mean is the mean of means."""
    return full.rollup("field").agg(F.avg("score").alias("avg_score"), F.count("*").alias("n"))


def pivot(full: DataFrame, ids: list[str]) -> DataFrame:
    """Fields by entities, and their mean."""
    wide = full.groupBy("field", "pos").pivot("entity_id", ids).agg(F.first("score"))
    return wide.join(full.groupBy("field").agg(F.avg("score").alias("avg")), "field").orderBy("pos")


def flags(scores: DataFrame) -> DataFrame:
    """(entity_id, field, issues) of fields with issues, joined by '; '."""
    return scores.filter(F.size("issues") > 0).select("entity_id", "field", F.array_join("issues", "; ").alias("issues"))


def spot_checks(raw_fields: DataFrame, entities: DataFrame, routes: DataFrame) -> DataFrame:
    """Every (entity_id, field) with the first 80 code points of its stored value, or a dash."""
    grid = entities.select("entity_id").crossJoin(F.broadcast(routes.select("pos", "storage_key", "spot_name")))
    raw = raw_fields.select(F.col("university_id").alias("entity_id"), F.col("field_name").alias("storage_key"), "value_json")
    value = F.when(F.col("value_json") != "null", value_text(F.col("value_json")))
    return grid.join(raw, ["entity_id", "storage_key"], "left").select("entity_id", "pos", F.col("spot_name").alias("field"), F.substring(F.coalesce(value, F.lit("—")), 1, PREVIEW_CAP).alias("extracted"))


def coverage(envelopes: DataFrame) -> DataFrame:
    """Per field: entities with a value, entities tried, mean confidence."""
    return envelopes.groupBy("storage_key").agg(F.count("value").alias("extracted"), F.count("*").alias("attempted"), F.avg("confidence").alias("avg_confidence"))


def match_rate(checked: DataFrame) -> DataFrame:
    """Share of spot checks whose value matched."""
    return checked.agg(F.count_if("matched").alias("matched"), F.count("*").alias("checked"), (F.count_if("matched") / F.count("*")).alias("rate"))


def _table(columns: list[str], rows: Iterable[Iterable]) -> Iterator[str]:
    """A Markdown table, line by line; bars and line breaks in cells are made harmless."""
    cell = lambda x: " ".join(str(x).replace("|", "\\|").split("\n"))
    yield from (f"| {' | '.join(map(cell, line))} |" for line in (columns, ["---"] * len(columns)))
    yield from (f"| {' | '.join(map(cell, row))} |" for row in rows)
    yield ""


def report_lines(reports: DataFrame, spots: DataFrame) -> Iterator[str]:
    """Lines of the report: a row an entity with its ten scores, the means, issues, and spot checks.

    `reports`: id, name and the rollup columns, one row per entity. Means are aggregated; rows come to the
    driver a partition at a time, in order of id, so any number of entities can be written. Nothing for an
    empty store.
    """
    ordered = reports.orderBy("id")
    if reports.isEmpty():
        return
    keys = [r.report_key for r in ROUTES]
    score = lambda key: F.coalesce(F.try_element_at("fields", F.lit(key))["score"], F.lit(0.0))
    means = reports.agg(*[F.avg(score(key)).alias(key) for key in keys]).first()
    shown = lambda values: [f"{v:.2f}" for v in (*values, sum(values) / len(values))]
    yield from ("# Field quality", "", "## Scores", "")
    scored = ordered.select("id", "name", F.array(*map(score, keys)).alias("scores"))
    yield from _table(["Entity", "Name", *keys, "Mean"], chain(([r["id"], r["name"], *shown(r["scores"])] for r in scored.toLocalIterator()), [["**all**", "", *shown([means[k] for k in keys])]]))
    yield from ("## Issues", "")
    issues = ordered.select("id", F.explode(F.map_entries("fields")).alias("f")).filter("size(f.value.issues) > 0").select("id", "f.key", F.array_join("f.value.issues", "; ").alias("issues"))
    yield from _table(["Entity", "Field", "Issues"], issues.toLocalIterator())
    yield from ("## Critical", "")
    critical = ordered.filter("size(critical_issues) > 0").select("id", F.array_join("critical_issues", ", ").alias("issues"))
    yield from _table(["Entity", "Issues"], critical.toLocalIterator())
    yield from ("## Spot checks", "")
    yield from _table(["Entity", "Field", "Extracted", "Actual", "Match"], ((s["entity_id"], s["field"], s["extracted"], "", "") for s in spots.orderBy("entity_id", "pos").toLocalIterator()))


def markdown(reports: DataFrame, spots: DataFrame, path: str | None = None) -> str | None:
    """The report as Markdown: its text, or with a path the path it was written to line by line. None, and no file, for an empty store."""
    lines = report_lines(reports, spots)
    first = next(lines, None)
    if first is None:
        return None
    if not path:
        return "\n".join([first, *lines])
    with Path(path).open("w") as out:
        out.writelines(f"{line}\n" for line in chain([first], lines))
    return path
