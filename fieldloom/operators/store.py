"""Keyed tables: latest row per key, and replacing upserts by write-new-then-switch."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom import schema


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is last in `order`; whole rows replace whole rows.

    As max_by: rows are combined before the shuffle, so a hot key costs one row a task.
    """
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("row"))
    return best.select(*keys, "row.*").select(*rows.columns)


def ranked_latest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """`latest` by row_number, for rows with columns that have no order."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return rows.withColumn("__rank", F.row_number().over(w)).filter("__rank = 1").drop("__rank")


def upserted(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """`old` with the keys of `new` replaced; keys that `new` lacks stay."""
    fresh = latest(new, keys, order)
    return old.join(fresh.select(*keys), list(keys), "left_anti").unionByName(fresh)


def listing(entities: DataFrame) -> DataFrame:
    """Stored entities as (id, name, scraped_at, confidence)."""
    return entities.select("id", "name", "scraped_at", F.col("overall_confidence").alias("confidence"))


class Store:
    """Three Parquet tables in a folder, and numbered manifests that say which version of each table counts.

    Versions are written whole and never changed. An upsert, of one table or of all three, writes the new
    versions and then one manifest with the next number, by a rename that fails if another writer was first.
    The manifest with the highest number counts; so whatever fails before the rename changes nothing, and all
    tables of an upsert change together.
    """

    TABLES = {"universities": (schema.ENTITIES, ["id"], ["scraped_at"]), "raw_fields": (schema.RAW_FIELDS, ["university_id", "field_name"], ["scraped_at"]), "validation_reports": (schema.VALIDATION_REPORTS, ["university_id"], ["created_at"])}

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _manifest(self) -> tuple[int, dict[str, str]]:
        """Number and content (table: version) of the manifest that counts; 0 and {} for a new store."""
        folder = self._path(f"{self.root}/manifests")
        if not self._fs().exists(folder):
            return 0, {}
        names = [f.getPath().getName() for f in self._fs().listStatus(folder)]
        last = max((int(n) for n in names if n.isdigit()), default=0)
        if not last:
            return 0, {}
        return last, json.loads("\n".join(r["value"] for r in self.spark.read.text(f"{self.root}/manifests/{last:012d}").collect()))

    def _publish(self, number: int, versions: dict[str, str]) -> None:
        draft = self._path(f"{self.root}/manifests/draft-{uuid.uuid4().hex}")
        out = self._fs().create(draft, False)
        try:
            out.write(bytearray(json.dumps(versions).encode()))
        finally:
            out.close()
        final = self._path(f"{self.root}/manifests/{number:012d}")
        if self._fs().exists(final) or not self._fs().rename(draft, final):
            self._fs().delete(draft, False)
            raise RuntimeError(f"another writer has published version {number} of {self.root}")

    def _write(self, name: str, rows: DataFrame) -> str:
        version = f"{name}/v-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{version}")
        return version

    def create(self) -> None:
        """Empty tables where there are none."""
        number, versions = self._manifest()
        new = {name: self._write(name, self.spark.createDataFrame([], kind)) for name, (kind, _, _) in self.TABLES.items() if name not in versions}
        if new:
            self._publish(number + 1, versions | new)

    def _read(self, name: str, versions: dict[str, str]) -> DataFrame:
        kind: T.StructType = self.TABLES[name][0]
        return self.spark.read.schema(kind).parquet(f"{self.root}/{versions[name]}") if name in versions else self.spark.createDataFrame([], kind)

    def read(self, name: str) -> DataFrame:
        return self._read(name, self._manifest()[1])

    def upsert(self, name: str, rows: DataFrame) -> None:
        self.upsert_all({name: rows})

    def upsert_all(self, tables: dict[str, DataFrame]) -> None:
        """Upserts into several tables that readers see at once, or not at all."""
        number, versions = self._manifest()
        new = {}
        for name, rows in tables.items():
            kind, keys, order = self.TABLES[name]
            new[name] = self._write(name, upserted(self._read(name, versions), rows.select(*kind.names), keys, order))
        self._publish(number + 1, versions | new)

    def listed(self) -> DataFrame:
        """All entities: id, name, scraped_at, confidence; oldest upsert first."""
        return listing(self.read("universities")).orderBy("scraped_at", "id")

    def record(self, entity_id: str) -> str | None:
        """The stored record of an entity as JSON, or None."""
        row = self.read("universities").filter(F.col("id") == entity_id).select("data_json").first()
        return row and row["data_json"]


def raw_rows(envelopes: DataFrame, run_ts: str) -> DataFrame:
    """Envelopes (entity_id, storage_key, value_json, confidence, source_url, needs_review, notes) as stored rows."""
    return envelopes.select(
        F.col("entity_id").alias("university_id"),
        F.col("storage_key").alias("field_name"),
        F.coalesce("value_json", F.lit("null")).alias("value_json"),
        F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
        "source_url",
        F.coalesce(F.col("needs_review").cast("int"), F.lit(0)).alias("needs_review"),
        "notes",
        F.lit(run_ts).cast("timestamp_ntz").alias("scraped_at"),
    )
