"""Merging two extractions of one field."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.functions.text import strip

#: What agreement adds to a confidence, and the sentences of notes.
BOOST = 0.1
AGREE = ("Cross-validated: secondary source agrees. (", ")")
CONFLICT = ("CONFLICT: primary=", " (from ", ") vs secondary=", " (from ", ")")


def merge_sources(primary: DataFrame, secondary: DataFrame, keys: list[str]) -> DataFrame:
    """One envelope per key: (keys, value, confidence, source_url, needs_review, notes, outcome).

    Both null or one side absent: the primary, or the side with a value. Values equal after stripping and
    lower-casing: the primary with 0.1 more confidence (at most 1), a note, and no review. Different: the
    primary, marked for review, with both values in its note. Values are text; a full outer join on the
    keys, nulls handled before the comparison.
    """
    columns = ("value", "confidence", "source_url", "needs_review", "notes")
    p = primary.select(*keys, F.struct(*columns).alias("p"))
    s = secondary.select(*keys, F.struct(*columns).alias("s"))
    both = p.join(s, keys, "full_outer")
    pv, sv = F.col("p.value"), F.col("s.value")
    outcome = (
        F.when(pv.isNull() & sv.isNull(), "neither").when(pv.isNull(), "secondary").when(sv.isNull(), "primary").when(F.lower(strip(pv)) == F.lower(strip(sv)), "agree").otherwise("conflict")
    )
    text = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    agree = F.struct(
        pv.alias("value"),
        F.least(F.lit(1.0), F.coalesce(F.col("p.confidence"), F.lit(0.0)) + BOOST).alias("confidence"),
        F.col("p.source_url").alias("source_url"),
        F.lit(False).alias("needs_review"),
        F.concat(F.lit(AGREE[0]), text(F.col("s.source_url")), F.lit(AGREE[1])).alias("notes"),
    )
    conflict = F.struct(
        pv.alias("value"),
        F.col("p.confidence").alias("confidence"),
        F.col("p.source_url").alias("source_url"),
        F.lit(True).alias("needs_review"),
        F.concat(*[x for said, value in zip(CONFLICT, (pv, text(F.col("p.source_url")), sv, text(F.col("s.source_url")), F.lit("")), strict=True) for x in (F.lit(said), value)]).alias("notes"),
    )
    merged = (
        F.when(F.col("outcome") == "agree", agree)
        .when(F.col("outcome") == "conflict", conflict)
        .when(F.col("outcome") == "secondary", F.col("s"))
        .otherwise(F.coalesce(F.col("p"), F.col("s")))
    )
    return both.withColumn("outcome", outcome).withColumn("m", merged).select(*keys, "m.*", "outcome")
