"""Repeated line runs: suffix ranks by distributed prefix doubling, intervals of common prefixes, later copies deleted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.llm.common import Scratch, parted, unused
from fieldloom.llm.quality import let

#: Words of a repeated run from which its later copies go.
MIN_WORDS = 10
_KEY = ["doc", "hash"]


def _lines(text: Column) -> Column:
    """The non-blank lines of a text as (id, words): a 64-bit hash without white space around, and a count."""
    inner = lambda x: F.regexp_replace(x, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    shape = lambda x: F.struct(F.xxhash64(inner(x)).alias("id"), F.size(F.array_remove(F.split(x, r"[\x20\x09-\x0D]+"), "")).alias("words"))
    return F.filter(F.transform(F.split(text, "\n"), shape), lambda x: x["words"] > 0)


def _ahead(column: str, n: int, window) -> Column:
    """`column` of the line `n` places on, null unless the lines between are all there."""
    return F.when(F.lead("place", n).over(window) == F.col("place") + n, F.lead(column, n).over(window)) if n else F.col(column)


def _sized(lines: DataFrame, least: int) -> DataFrame:
    """`lines` with `low` and `high`: a run of `low` to `high` lines from this one on decides about it.

    `low` lines are the fewest with `least` words. `high` is the most lines that hold fewer than `least`
    words without the first, so that these runs are also the shortest ones that end at each line. No
    decided run has more than `least` lines, as each holds a word. Null `low`: too few words follow.
    """
    w = Window.partitionBy(*_KEY).orderBy("place")
    low, high = F.lit(None).cast("int"), F.lit(1)
    total = [F.col("words")]
    for n in range(1, least):
        total.append(total[-1] + F.col("ahead")[n - 1])  # null from the first missing line on
    for n in reversed(range(least)):
        low = F.when(total[n] >= least, n + 1).otherwise(low)
    for n in range(1, least):
        high = F.when(total[n] - F.col("words") < least, n + 1).otherwise(high)
    return lines.withColumn("ahead", F.array(*[_ahead("words", n, w) for n in range(1, least)])).withColumns({"low": low, "high": F.greatest(low, high)}).drop("ahead", "words")


def _runs(ranks: DataFrame, level: int, most: int) -> DataFrame:
    """(doc, hash, place, size, a, b) of the runs to decide that have 2**level lines or more, fewer than twice as many, and `most`.

    Two runs of one size are equal if the suffixes they start agree in rank a of their first 2**level lines,
    and those that start 2**level lines before their ends agree in rank b.
    """
    half = 2**level
    w = Window.partitionBy(*_KEY).orderBy("place")
    ends = F.array(*[_ahead("rank", n, w) for n in range(min(half, most - half + 1))])
    named = ranks.withColumn("ends", ends).filter(f"low <= high AND low < {2 * half} AND high >= {half}")
    sizes = F.sequence(F.greatest("low", F.lit(half)), F.least("high", F.lit(2 * half - 1)))
    out = named.select(*_KEY, "place", F.explode(sizes).alias("size"), F.col("rank").alias("a"), "ends")
    return out.select(*_KEY, "place", "size", "a", F.get("ends", F.col("size") - half).alias("b")).filter("b IS NOT NULL")


def _doubled(ranks: DataFrame, level: int, scratch: Scratch) -> DataFrame:
    """From ranks of suffixes by their first 2**level lines to ranks by twice as many.

    The pair of a suffix's rank and that of the suffix 2**level lines on orders it by both. Pairs are counted
    map-side first, those that occur twice or more are sorted over all partitions, and the row number in that
    order is the new rank: numbers grow from partition to partition, so they need not be dense. A suffix
    whose pair occurs once, or runs past the last repeated line, agrees with no other and is dropped.
    """
    w = Window.partitionBy(*_KEY).orderBy("place")
    pairs = scratch.keep(ranks.withColumn("next", _ahead("rank", 2**level, w)).filter("next IS NOT NULL"), f"pairs-{level}")
    often = pairs.groupBy("rank", "next").count().filter("count > 1").select("rank", "next")
    order = often.repartitionByRange("rank", "next").sortWithinPartitions("rank", "next")
    order = scratch.keep(order.withColumn("new", F.monotonically_increasing_id()), f"order-{level}")
    return scratch.keep(pairs.join(order, ["rank", "next"]).select(*_KEY, "place", F.col("new").alias("rank"), "low", "high"), f"ranks-{level + 1}")


def deletions(docs: DataFrame, scratch: Scratch, least: int = MIN_WORDS) -> DataFrame:
    """(doc, hash, gone): per document with repeated runs the numbers of the non-blank lines, from 0, that go.

    Suffixes of the corpus's line sequences are ranked by prefix doubling: level 0 orders them by their first
    line's id, and each round by twice as many lines. Lines that occur once end every run, so their suffixes
    have no rank. The suffixes that agree in their first n lines are an interval of the suffix array whose
    common prefix has at least n lines; two ranks name it. Its first suffix, in order of (doc_id, text hash,
    place), is the copy that stays, and the others' n lines go. A maximal repeated run longer than `least`
    lines is the union of such runs, as each window of it is repeated too: so intervals are read off only at
    the sizes of `_sized`, and log2(least) rounds do for runs of any length.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = [F.col("doc_id").cast("long").alias("doc"), F.xxhash64(text).alias("hash")]
    lines = docs.select(*key, F.posexplode(_lines(text)).alias("place", "x")).select(*_KEY, "place", F.col("x.id").alias("rank"), "x.words")
    lines = scratch.keep(lines, "lines")
    often = scratch.keep(lines.groupBy("rank").count().filter("count > 1").select("rank"), "often")
    repeated = lines.join(often, "rank", "left_semi").dropDuplicates([*_KEY, "place"])
    ranks = scratch.keep(_sized(repeated, least).select(*_KEY, "place", "rank", "low", "high"), "ranks-0")
    runs, level = None, 0
    while 2**level <= least:
        found = _runs(ranks, level, least)
        runs = found if runs is None else runs.union(found)
        level += 1
        if 2**level <= least:
            ranks = _doubled(ranks, level - 1, scratch)
    runs = scratch.keep(runs, "runs")
    order = F.struct(F.col("doc").isNull().alias("last"), "doc", "hash", "place")
    name = ["size", "a", "b"]
    first = scratch.keep(runs.groupBy(*name).agg(F.count("*").alias("n"), F.min(order).alias("first")).filter("n > 1").select(*name, "first"), "first")
    later = runs.join(first, name).filter(F.col("first") < order)
    gone = later.groupBy(*_KEY, "place").agg(F.max("size").alias("size"))
    gone = gone.groupBy(*_KEY).agg(F.collect_list(F.sequence("place", F.col("place") + F.col("size") - 1)).alias("gone"))
    return scratch.keep(gone.select(*_KEY, F.array_sort(F.array_distinct(F.flatten("gone"))).alias("gone")), "gone")


def dedup(docs: DataFrame, scratch: Scratch | None = None, least: int = MIN_WORDS) -> tuple[DataFrame, str, str]:
    """`docs` with text without later copies of repeated runs, and the names of two columns: non-blank lines, and those deleted.

    A run is one or more adjacent non-blank lines that occur, in the same order, earlier: in a document of
    smaller doc_id (null last; equal ids by text hash) or before in the same one. Runs of fewer than
    `least` words stay. Blank lines stay where they are, unless every other line goes: then text is "".
    Rows equal in doc_id and text are one document. Null and empty texts stay as they are; texts of any
    length are read whole; other columns are kept, whatever their names; an empty table stays empty.

    Texts meet the numbers of their deleted lines by a merge join at every size; only those that may have
    any are dealt out for it, the others stay where they are read.
    """
    scratch = scratch or Scratch(docs.sparkSession, "lines")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc, hash_, n, n_gone, places, i, h = unused(docs, "doc", "hash", "n", "n_gone", "places", "i", "h")
    keyed = docs.withColumns({doc: F.col("doc_id").cast("long"), hash_: F.xxhash64(text)})
    keys = deletions(docs, scratch, least).select(F.col("doc").alias(i), F.col("hash").alias(h), F.col("gone").alias(places))
    some, none = parted(keyed, F.xxhash64(doc, hash_), keys.select(F.xxhash64(i, h).alias(i)), scratch)
    some = some.join(keys.hint("merge"), F.col(doc).eqNullSafe(F.col(i)) & (F.col(hash_) == F.col(h)), "left").drop(i, h, doc, hash_)
    joined = some.unionByName(none.drop(doc, hash_).withColumn(places, F.lit(None).cast("array<int>")))
    full = lambda x: x.rlike(r"[^\x20\x09-\x0D]")

    def rest(all_: Column) -> Column:
        numbers = F.filter(F.transform(all_, lambda x, k: F.when(full(x), k)), lambda k: k.isNotNull())
        gone = let(numbers, lambda at: F.transform(F.col(places), lambda p: F.get(at, p)))
        return F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(all_) - 1), gone), lambda k: F.get(all_, k)), "\n")

    joined = joined.withColumns({n: F.size(F.filter(F.split(text, "\n"), full)).cast("long"), n_gone: F.coalesce(F.size(places), F.lit(0)).cast("long")})
    left = F.when(F.col(places).isNull(), F.col("text")).when(F.col(n_gone) >= F.col(n), "").otherwise(let(F.split(text, "\n"), rest))
    return joined.withColumn("text", left).drop(places), n, n_gone


def line_dedup(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """One row per document: doc_id, text without later copies, n_lines and n_deleted (non-blank lines). See `dedup`."""
    out, n, n_gone = dedup(docs.select("doc_id", "text"), scratch)
    return out.select("doc_id", "text", F.col(n).alias("n_lines"), F.col(n_gone).alias("n_deleted"))


def keep_first(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """`docs` without later copies; documents of which nothing is left are gone. Columns stay as they are."""
    out, n, n_gone = dedup(docs, scratch)
    return out.filter((F.col(n_gone) == 0) | (F.col(n_gone) < F.col(n))).select(*docs.columns)
