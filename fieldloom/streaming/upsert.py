"""Extension: pages that land in a folder, cleaned and upserted as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldloom.functions.text import html_to_text
from fieldloom.operators.store import Store

PAGES = "entity_id string, label string, url string, html string, landed_at timestamp_ntz"


def cleaned(pages: DataFrame) -> DataFrame:
    """Stateless: page text as the value of a raw field, one row per page."""
    text = html_to_text(F.col("html"))
    return pages.select(
        F.col("entity_id").alias("university_id"), F.col("label").alias("field_name"), F.to_json(F.struct(text.alias("text"))).alias("value_json"), F.when(F.length(text) > 0, 1.0).otherwise(0.0).alias("confidence"),
        F.col("url").alias("source_url"), (F.coalesce(F.length(text), F.lit(0)) == 0).cast("int").alias("needs_review"), F.lit(None).cast("string").alias("notes"), F.col("landed_at").alias("scraped_at"),
    )


def upsert_stream(spark: SparkSession, folder: str, store: Store, checkpoint: str) -> StreamingQuery:
    """Upsert what lands in `folder`, batch by batch; a batch that runs again gives the same rows."""
    store.create()
    rows = cleaned(spark.readStream.schema(PAGES).parquet(folder))
    return rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda batch, _: store.upsert("raw_fields", batch)).start()


def arrivals(pages: DataFrame, window: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Pages with and without text per window of arrival; batch or stream, with a watermark in the latter."""
    text = html_to_text(F.col("html"))
    return pages.withWatermark("landed_at", late).groupBy(F.window("landed_at", window).alias("w")).agg(F.count_if(F.length(text) > 0).alias("fetched"), F.count("*").alias("total")).select("w.start", "w.end", "fetched", "total")
