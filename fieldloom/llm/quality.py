"""Quality rules as weak supervision: rules vote or abstain, EM weighs them, a posterior decides."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import Scratch, unused

SPACE = r"[\x20\x09-\x0D]+"
_SYMBOL = "[#*$%&|<>]"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended", "n_distinct", "n_symbol_words", "n_symbol_lines", "n_cries", "shouted")


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once a row, however often a lambda reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column, width: int = 8) -> Column:
    """Words covered by windows of `width` words that occur twice or more in the text, by 64-bit window hashes."""

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(rows: Column) -> Column:
            same = F.filter(rows, lambda x, j: (F.get(rows, j - 1)["h"] == x["h"]).eqNullSafe(True) | (F.get(rows, j + 1)["h"] == x["h"]).eqNullSafe(True))
            return F.sort_array(F.transform(same, lambda x: x["i"]))

        start = F.struct(F.lit(-width).alias("last"), F.lit(0).cast("long").alias("total"))
        return F.aggregate(
            let(placed, twice),
            start,
            lambda acc, i: F.struct(i.alias("last"), (acc["total"] + F.least(F.lit(width), i - acc["last"])).alias("total")),
            lambda acc: acc["total"],
        )

    def windows(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (width - 1)), lambda i: F.xxhash64(F.slice(w, i, F.lit(width))))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("long")))

    return let(words, lambda w: F.when(F.size(w) > width, windows(w)).otherwise(F.lit(0).cast("long")))


def measure(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    """`docs` with the STATS of every whole text (null: empty) under the given names. No shuffle, no Python."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    held = unused(docs, "words", "lines")
    words, lines = map(F.col, held)
    marked = lambda pattern: F.when(text.rlike(_SYMBOL), F.regexp_count(text, F.lit(pattern))).otherwise(0).cast("long")
    stats = {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": marked(_SYMBOL),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": repeated_words(words),
        "n_lines": F.size(lines).cast("long"),
        "n_ended": F.size(F.filter(lines, lambda x: x.rlike(r"[.!?:;\"'’”»)][\x20\x09-\x0D]*$"))).cast("long"),
        "n_distinct": F.size(F.array_distinct(words)).cast("long"),
        "n_symbol_words": marked(_SYMBOL + r"[^\x20\x09-\x0D]*+"),
        "n_symbol_lines": marked(rf"{_SYMBOL}[^\n#*$%&|<>]*+{_SYMBOL}[^\n]*+"),
        "n_cries": F.regexp_count(text, F.lit("!!+")).cast("long"),
        "shouted": (F.upper(text) == text) & (F.lower(text) != text),
    }
    split = docs.withColumns({held[0]: F.array_remove(F.split(text, SPACE), ""), held[1]: F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    return split.withColumns({names[k]: v for k, v in stats.items()}).drop(*held)


def votes(stat) -> dict[str, Column]:
    """The rules: 1 for good, 0 for bad, null to abstain. `stat` gives the column of a measurement.

    A rule that finds nothing wrong abstains; only signs of running prose are votes for good. Each kind of
    junk is looked at by two rules or more, as one rule alone gives EM no second opinion to learn from.
    """
    n = F.greatest(stat("n_words"), F.lit(1))
    mean = stat("word_chars") / n
    return {
        "length": F.when(stat("n_words") < 20, 0),
        "word_length": F.when((mean < 2.5) | (mean > 12), 0),
        "symbols": F.when(stat("n_symbols") > 0.1 * n, 0),
        "symbol_words": F.when(stat("n_symbol_words") > 0.05 * n, 0),
        "symbol_lines": F.when(stat("n_symbol_lines") > 0.3 * stat("n_lines"), 0),
        "dup_lines": F.when((stat("n_dup_lines") >= 3) & (stat("n_dup_lines") > 0.3 * stat("n_lines")), 0),
        "repeats": F.when(stat("n_repeat_words") > 0.25 * n, 0),
        "line_ends": F.when(stat("n_ended") < 0.3 * stat("n_lines"), 0).when(stat("n_ended") >= 0.8 * stat("n_lines"), 1),
        "variety": F.when((n >= 50) & (stat("n_distinct") < 0.1 * n), 0).when((n >= 50) & (stat("n_distinct") > 0.4 * n), 1),
        "case": F.when(stat("shouted"), 0),
        "cries": F.when(stat("n_cries") > 0.05 * n, 0),
    }


#: What is believed of a rule's votes on good and on bad documents before any is seen, and for how many documents that counts.
GOOD, BAD, BELIEF = {0: 0.01, 1: 0.6, None: 0.39}, {0: 0.2, 1: 0.3, None: 0.5}, 200.0
#: Share of good documents believed beforehand.
SHARE = 0.85


def estimate(patterns: dict[tuple, int], rules: int, rounds: int = 200, close: float = 1e-9) -> tuple[float, list[dict]]:
    """EM over counted vote patterns: log prior odds of good, and per rule the log odds that each vote adds.

    A pattern is a tuple of votes (1, 0 or None) and, last, whether the document failed the base rules: those
    are known to be bad, and anchor that class. Votes are independent given the class. EM estimates the share
    of good documents and how often each rule votes which way on either class; beliefs count as BELIEF
    documents each, whatever the table's size. No patterns: the beliefs.
    """
    seen = [{p[k] for p in patterns} | {None, 0} for k in range(rules)]
    scaled = lambda d, votes_: {v: d[v] / sum(d[u] for u in votes_) for v in votes_}
    belief = [(scaled(GOOD, seen[k]), scaled(BAD, seen[k])) for k in range(rules)]
    share, fitted = SHARE, belief
    total = sum(patterns.values())

    def odds() -> list[dict]:
        return [{1: 0.0} | {v: math.log(good[v] / bad[v]) for v in good} for good, bad in fitted]

    for _ in range(rounds if total else 0):
        added, base = odds(), math.log(share / (1 - share))
        good = 0.0
        cast = [({v: 0.0 for v in s}, {v: 0.0 for v in s}) for s in seen]
        for (*p, failed), count in patterns.items():
            q = 0.0 if failed else 1 / (1 + math.exp(-max(-40.0, min(40.0, base + sum(added[k][v] for k, v in enumerate(p))))))
            good += q * count
            for k, v in enumerate(p):
                cast[k][0][v] += q * count
                cast[k][1][v] += (1 - q) * count
        before, share = share, (good + BELIEF * SHARE) / (total + BELIEF)
        fitted = [
            tuple({v: (votes_[v] + BELIEF * held[v]) / (n + BELIEF) for v in held} for votes_, held, n in zip(cast[k], belief[k], (good, total - good), strict=True))
            for k in range(rules)
        ]
        if abs(share - before) < close:
            break
    return math.log(share / (1 - share)), odds()


def judge(docs: DataFrame, scratch: Scratch, columns: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """`columns` of `docs` with the STATS, base_failed, posterior and kept, and the names that these have there.

    The measurements are written once, with the columns asked for. Vote patterns are counted over all rows
    (2**9 * 3**2 patterns at most, twice, whatever the table holds), and EM runs on the counts. base_failed:
    under 20 words, or over 30 % of words in repeated windows. kept: not base_failed, and posterior
    probability of good quality at least 0.5. Null and empty texts have zero words and fail; texts of any
    length are read whole. Every row is judged, repeated ones alike; other columns are kept as they are,
    whatever their names; an empty table stays empty.
    """
    own = (*STATS, "base_failed", "posterior", "kept")
    names = dict(zip(own, unused(docs, *own), strict=True))
    stat = lambda name: F.col(names[name])
    failed = (stat("n_words") < 20) | (100 * stat("n_repeat_words") > 30 * stat("n_words"))
    measured = measure(docs, names).withColumn(names["base_failed"], failed)
    measured = scratch.keep(measured.select(*columns, *[stat(n) for n in (*STATS, "base_failed")]), "measured")
    rules = votes(stat)
    counted = measured.select(*[v.alias(k) for k, v in rules.items()], stat("base_failed").alias("failed")).groupBy(*rules, "failed").count().collect()
    logit, odds = estimate({(*(r[k] for k in rules), r["failed"]): r["count"] for r in counted}, len(rules))
    total = F.lit(logit)
    for (_, v), o in zip(rules.items(), odds, strict=True):
        total = total + F.when(v == 1, o[1]).when(v == 0, o[0]).otherwise(o[None])
    return measured.withColumn(names["posterior"], 1 / (1 + F.exp(-total))).withColumn(names["kept"], ~stat("base_failed") & (stat("posterior") >= 0.5)), names


def quality_rules(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """One row per document: doc_id, the base measurements, base_failed, posterior, kept. See `judge`."""
    judged, held = judge(docs.select("doc_id", "text"), scratch or Scratch(docs.sparkSession, "quality"), ("doc_id",))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "posterior", "kept")
    return judged.select("doc_id", *[F.col(held[n]).alias(n) for n in names])


def keep_good(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """The rows of `docs` that the rules keep, with their columns."""
    judged, held = judge(docs, scratch or Scratch(docs.sparkSession, "quality"), tuple(docs.columns))
    return judged.filter(F.col(held["kept"])).select(*docs.columns)
