"""The entity registry: a YAML file as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.schema import REGISTRY


def load_registry(spark: SparkSession, path: str, key: str = "universities") -> DataFrame:
    """Entities (id, name, country, currency, pages) of a registry file. It is configuration, read by the driver."""
    import yaml

    with open(path) as f:
        rows = yaml.safe_load(f)[key]
    return spark.createDataFrame([{k: r.get(k) for k in REGISTRY.names} for r in rows], REGISTRY)


def page_list(registry: DataFrame) -> DataFrame:
    """(entity_id, label, url), one row per page."""
    return registry.select(F.col("id").alias("entity_id"), F.explode("pages").alias("label", "url"))


def distinct_urls(pages: DataFrame) -> DataFrame:
    """Each url once, so that pages which entities or labels share are fetched once."""
    return pages.select("url").distinct()
