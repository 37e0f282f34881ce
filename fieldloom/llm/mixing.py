"""Mixing sources to target weights: iterative proportional fitting, then sampling by calibrated probability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import Scratch, unused

AXES = ("source", "lang", "topic")
#: Topics by what a text is made of; the first that holds.
TOPICS = ("empty", "table", "code", "digits", "prose")


def topic(text: Column) -> Column:
    """Coarse topic of a whole text: empty, table (bars), code (braces and operators), digits, or prose."""
    n = F.length(text)
    share = lambda pattern: F.regexp_count(text, F.lit(pattern)) / n
    return (
        F.when(~text.rlike(r"[^\x20\x09-\x0D]"), "empty")
        .when(text.contains("|") & (share(r"\|") > 0.02), "table")
        .when(text.rlike(r"[{}<>=;#$%&*]") & (share(r"[{}<>=;#$%&*]") > 0.05), "code")
        .when(text.rlike("[0-9]") & (share("[0-9]") > 0.2), "digits")
        .otherwise("prose")
    )


def tokens(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a whole text."""
    return F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")).cast("long")


def goals(cells: DataFrame, axis: str, target: dict | None = None) -> DataFrame:
    """(value, goal) of each value of an axis that has tokens; goals add up to 1.

    Without a target a value's share to the power 0.5, so that small sources count for more. A value that
    the target lacks gets 0; if it lacks all, they share alike.
    """
    held = cells.filter("tokens > 0").groupBy(F.col(axis).alias("value")).agg(F.sum("tokens").alias("n"))
    if target is None:
        power = held.select("value", F.sqrt("n").alias("p"))
    else:
        given = cells.sparkSession.createDataFrame([(k, max(0.0, float(v))) for k, v in target.items()], "v string, p double")
        power = held.join(given, F.col("value").eqNullSafe(F.col("v")), "left").select("value", F.coalesce("p", F.lit(0.0)).alias("p"))
    total = power.agg(F.sum("p").alias("p"), F.count("*").alias("n")).first()
    return power.select("value", (F.col("p") / total["p"] if total["p"] else F.lit(1.0 / max(1, total["n"]))).alias("goal"))


def rake(cells: DataFrame, scratch: Scratch, targets: list[dict] | None = None, rounds: int = 100, close: float = 1e-5) -> DataFrame:
    """(source, lang, topic, tokens, weight): weights of cells so that weighted token shares meet the goals of all three axes.

    Iterative proportional fitting. Each axis in turn multiplies the weights of its values by the factors that
    bring their shares to the goals, until no share of a value was off by more than `close` before, or no
    round brings them nearer (goals that these cells cannot meet). The cells carry their weights and goals, so
    a step is one aggregation of the written cells and one join back, which writes them anew: few and small
    plans, as the driver's memory goes to plans and broadcasts. One number a round reaches the driver, however
    many cells there are. Cells without tokens get weight 1.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    held = cells.filter("tokens > 0").select(*AXES, "tokens", F.lit(1.0).alias("weight"), F.lit(0.0).alias("off"))
    for k, axis in enumerate(AXES):
        wanted = goals(cells, axis, targets and targets[k]).withColumnRenamed("goal", f"{axis}_goal")
        held = held.join(wanted, F.col(axis).eqNullSafe(F.col("value"))).drop("value")
    names = ["raked"]
    held, last = scratch.keep(held, names[0]), float("inf")
    share = F.sum(F.col("tokens") * F.col("weight")) / total
    for k in range(rounds):
        for axis in AXES:
            now = held.groupBy(F.col(axis).alias("value")).agg(share.alias("now"), F.first(f"{axis}_goal").alias("goal"))
            factor = F.when(F.col("now") > 0, F.col("goal") / F.col("now")).otherwise(0.0)
            now = now.select("value", factor.alias("factor"), F.abs(F.col("now") - F.col("goal")).alias("missed"))
            off = F.col("missed") if axis == AXES[0] else F.greatest("off", "missed")
            moved = held.join(now, F.col(axis).eqNullSafe(F.col("value"))).withColumns({"weight": F.col("weight") * F.col("factor"), "off": off})
            names.append(f"raked-{axis}-{k}")
            held = scratch.keep(moved.drop("value", "factor", "missed"), names[-1])
            scratch.drop(names[-2])
        off = held.agg(F.max("off")).first()[0] or 0.0
        if off <= close or off > 0.98 * last:
            break
        last = off
    mass = held.agg(F.sum(F.col("tokens") * F.col("weight"))).first()[0] or 1.0
    return held.select(*AXES, "tokens", (F.col("weight") * total / mass).alias("weight")).union(cells.filter("tokens <= 0").select(*AXES, "tokens", F.lit(1.0)))


def scale(cells: DataFrame, keep: float) -> float:
    """c with an expected token share of `keep` under min(1, c * weight), or as much as the weights allow.

    c meets `keep` if no cell reached 1; cells that do are set aside, and c is found again for the rest.
    """
    c, total = 0.0, cells.agg(F.sum("tokens")).first()[0] or 0
    while total:
        full = F.col("weight") * c >= 1
        r = cells.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)).alias("full"), F.sum(F.when(full, 0.0).otherwise(F.col("tokens") * F.col("weight"))).alias("rest")).first()
        if not r["rest"]:
            return c
        after = (keep * total - r["full"]) / r["rest"]
        if after <= c * (1 + 1e-12):
            return c
        c = after
    return c


def mix(docs: DataFrame, scratch: Scratch, columns: tuple[str, ...], targets: list[dict] | None = None, keep: float = 0.5, seed: int = 8, close: float = 1e-5) -> tuple[DataFrame, dict[str, str]]:
    """`columns` of `docs` with topic, tokens, weight, probability and sampled, and the names that these have there.

    Tokens of all documents are summed by (source, lang, topic), the table's distinct cells, which are
    written; `rake` fits their weights, to `close`. A document is sampled with the probability min(1, c * weight), where
    c is chosen so that a share `keep` of all tokens is expected, or as much as weights allow without
    repeats. The draw is a hash of doc_id and seed, so it repeats and equal doc_ids are drawn together; a
    null doc_id is drawn by its text. Null source and lang are values of their own, a null text is empty
    (topic empty, no tokens, weight 1); texts of any length are read whole. An empty table stays empty; input
    columns are kept as they are, whatever their names. Topics and tokens of texts are worked out anew for
    the result where it holds the texts, and written once where it does not: texts are not written again.
    """
    own = ("topic", "tokens", "draw", "weight", "probability", "sampled", "s", "l", "t")
    names = dict(zip(own, unused(docs, *own), strict=True))
    col = lambda name: F.col(names[name])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source, lang = F.col("source").cast("string"), F.col("lang").cast("string")
    draw = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), text), F.lit(seed)), F.lit(2**53)) / 2**53
    named = docs.withColumns({names["topic"]: topic(text), names["tokens"]: tokens(text), names["draw"]: draw}).select(*columns, col("topic"), col("tokens"), col("draw"))
    if "text" not in columns:
        named = scratch.keep(named, "named")
    summed = named.groupBy(source.alias("source"), lang.alias("lang"), col("topic").alias("topic")).agg(F.sum(names["tokens"]).alias("tokens"))
    weighed = scratch.keep(rake(scratch.keep(summed, "cells"), scratch, targets, close=close), "weights")
    c = scale(weighed, keep)
    table = weighed.select(F.col("source").alias(names["s"]), F.col("lang").alias(names["l"]), F.col("topic").alias(names["t"]), F.col("weight").alias(names["weight"]), F.least(F.lit(1.0), F.col("weight") * c).alias(names["probability"]))
    same = source.eqNullSafe(col("s")) & lang.eqNullSafe(col("l")) & (col("topic") == col("t"))
    joined = named.join(table, same, "left").withColumn(names["sampled"], col("draw") < col("probability"))
    return joined.drop(names["s"], names["l"], names["t"], names["draw"]), names


def mixed(docs: DataFrame, scratch: Scratch | None = None, **options) -> DataFrame:
    """One row per document: doc_id, source, lang, topic, tokens, weight, probability, sampled. See `mix`."""
    plain = ("doc_id", "source", "lang")
    out, names = mix(docs.select(*plain, "text"), scratch or Scratch(docs.sparkSession, "mixing"), plain, **options)
    return out.select(*plain, *[F.col(names[n]).alias(n) for n in ("topic", "tokens", "weight", "probability", "sampled")])


def sample(docs: DataFrame, scratch: Scratch | None = None, **options) -> DataFrame:
    """The sampled rows of `docs`, with their columns."""
    out, names = mix(docs, scratch or Scratch(docs.sparkSession, "mixing"), tuple(docs.columns), **options)
    return out.filter(F.col(names["sampled"])).select(*docs.columns)
