"""Shared helpers: scratch tables, word splitting and hashing, whole-partition Arrow maps."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch, and bytes of their texts, that are turned into Python objects at a time.
SLICE_ROWS, SLICE_BYTES = 256, 8_000_000
#: Distinct words whose hash a worker remembers; the memory is emptied when full, which changes no result.
WORD_CACHE = 150_000

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with marks before it until no column of `df` has it (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


class Scratch:
    """Tables written once and read again, in the folder that `spark.checkpoint.dir` names.

    Where that setting is empty and the master is local (tests), a temporary folder serves; on a cluster
    an empty setting is an error. What is left is deleted when the JVM ends.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not root:
            if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            root = tempfile.mkdtemp(prefix="fieldloom-")
        self.spark = spark
        self.root = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self._fs().deleteOnExit(self._path(self.root))

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write `df` as Parquet and return the written table; its lineage ends here."""
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            self._fs().delete(self._path(f"{self.root}/{name}"), True)


#: Bits of a key filter a key, and at most (16 MB).
KEY_BITS, MOST_KEY_BITS = 16, 2**27


def parted(rows: DataFrame, key: Column, keys: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """`rows` in two parts: those whose key may be among `keys` (one column of longs), and those whose key surely is not.

    A bitmap of hashed keys, built in pieces of 32,768 bits and broadcast, tells them apart before any
    shuffle: whoever joins the first part with the keys, exactly, moves no row of the second. The bitmap is
    bounded, so beyond some 10^9 keys the second part is empty. Null keys are keys.
    """
    n = min(MOST_KEY_BITS, 2 ** max(15, (KEY_BITS * keys.count() - 1).bit_length()))
    place = lambda x: F.pmod(F.xxhash64(x), F.lit(n)) + 1
    bits = keys.select(place(keys.columns[0]).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("b"))
    names = unused(rows, "k", "b", "p")
    k, b, p = map(F.col, names)
    pieces = F.broadcast(scratch.keep(bits, f"bits-{uuid.uuid4().hex}").toDF(*names[:2]))
    at = F.bitmap_bit_position(p)
    octet = F.conv(F.hex(F.substring(b, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    marked = F.call_function("shiftright", octet, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    tested = rows.withColumn(names[2], place(key)).join(pieces, F.bitmap_bucket_number(p) == k, "left").withColumn(names[2], F.coalesce(marked, F.lit(False)))
    return tested.filter(p).select(*rows.columns), tested.filter(~p).select(*rows.columns)


class WordHashes(dict):
    """64-bit hash of a word (bytes), remembered up to WORD_CACHE words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = WordHashes()


def words(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` as UTF-8; A-Z lower-cased, all else as it is."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, tokens), np.uint64, len(tokens))


def mix(z: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    z = z ^ (z >> np.uint64(30))
    z = z * np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def shingles(hashes: np.ndarray, n: int = 5) -> np.ndarray:
    """Hash of each run of `n` words, in text order; fewer words than `n` make one shingle, none make none."""
    if not len(hashes):
        return hashes
    width = min(n, len(hashes))
    rows = len(hashes) - width + 1
    total = np.full(rows, width, np.uint64)
    for j in range(width):
        part = hashes[j : j + rows]
        total += (part ^ (part >> np.uint64(29))) * _ODD[j % 5]
        total = (total << np.uint64(7)) | (total >> np.uint64(57)) if j % 5 == 4 and j + 1 < width else total
    return mix(total)


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `rows` rows and `most` bytes of texts, or one row, so that little is held as Python objects at a time."""
    for batch in batches:
        size = np.zeros(batch.num_rows, np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
                size += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.cumsum(size)
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right"))
            end = min(at + rows, max(at + 1, end))
            yield batch.slice(at, end - at)
            at = end
