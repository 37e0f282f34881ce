"""Document fingerprints by consistent weighted sampling of word shingles."""

from __future__ import annotations

import functools
import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import mix, shingles, slices, word_hashes, words

#: Samples of a fingerprint; each takes 16 bits of it.
SAMPLES = 64
#: Terms that are sampled at a time, so that the working arrays stay small for any text.
_BLOCK = 1024
_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_ARROW = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[t]) for n, t in map(str.split, _SCHEMA.split(", "))])


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Quantiles of Gamma(2, 1) at 2**16 even steps, their logarithms, and the samples' seeds."""
    p = (np.arange(2**16) + 0.5) / 2**16
    low, high = np.zeros(2**16), np.full(2**16, 40.0)
    for _ in range(60):
        mid = (low + high) / 2
        below = 1 - np.exp(-mid) * (1 + mid) < p
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    gamma = ((low + high) / 2).astype(np.float32)
    return gamma, np.log(gamma), mix(np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def terms(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct five-word shingles of a whole text, sorted, and how often each occurs."""
    return np.unique(shingles(word_hashes(words(text))), return_counts=True)


class _Least:
    """Per sample, the least value seen so far and its term and level."""

    def __init__(self) -> None:
        self.value = np.full(SAMPLES, np.inf, np.float32)
        self.at = np.zeros(SAMPLES, np.uint64)

    def see(self, values: np.ndarray, levels: np.ndarray | None, keys: np.ndarray) -> None:
        if not len(keys):
            return
        k = values.argmin(axis=1)
        row = np.arange(SAMPLES)
        best = values[row, k]
        level = levels[row, k].astype(np.int64).view(np.uint64) if levels is not None else np.uint64(0)
        better = best < self.value
        self.value = np.where(better, best, self.value)
        self.at = np.where(better, mix(keys[k] + level * np.uint64(0xD6E8FEB86659FD93)), self.at)

    def signature(self) -> np.ndarray:
        return (self.at >> np.uint64(48)).astype(">u2") if np.isfinite(self.value[0]) else np.zeros(0, ">u2")


def sample(keys: np.ndarray, *weights: np.ndarray) -> list[np.ndarray]:
    """Signatures (improved consistent weighted sampling) of several weightings of the same terms.

    For each term and sample one hash gives r and c ~ Gamma(2, 1) and b ~ U(0, 1); with
    t = floor(ln w / r + b), the term of least ln c - r (t - b + 1) is taken, and (term, t) is the sample.
    Two weightings agree in a sample with the probability of their generalised Jaccard similarity. A
    weighting without terms has an empty signature.
    """
    gamma, log_gamma, seeds = _tables()
    found = [_Least() for _ in weights]
    for start in range(0, len(keys), _BLOCK):
        part = keys[start : start + _BLOCK]
        bits = mix(part[None, :] ^ seeds[:, None])
        r = gamma[(bits & np.uint64(0xFFFF)).astype(np.int32)]
        c = log_gamma[((bits >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int32)]
        b = (bits >> np.uint64(40)).astype(np.float32) * np.float32(2**-24)
        one = c - r * (1 - b)  # weight 1: t = 0
        for least, w in zip(found, weights, strict=True):
            w = w[start : start + _BLOCK]
            if w.min() == w.max() == 1:
                least.see(one, None, part)
                continue
            held = np.flatnonzero(w == 1)
            if len(held):
                least.see(one[:, held] if len(held) < len(w) else one, None, part[held])
            many = np.flatnonzero(w > 1)
            if len(many):
                t = np.floor(np.log(w[many].astype(np.float32)) / r[:, many] + b[:, many])
                least.see(c[:, many] - r[:, many] * (t - b[:, many] + 1), t, part[many])
    return [x.signature() for x in found]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal samples; two empty texts are alike (1), an empty and another are not (0)."""
    if len(a) != len(b):
        return 0.0
    return float(np.mean(a == b)) if len(a) else 1.0


def fingerprint(text: str | None) -> np.ndarray:
    return sample(*terms(text))[0]


def edited(text: str, following: str) -> str:
    """`text` with its last floor(n/3) code points replaced by the first as many (or all) of `following`."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _pair(text: str, other: str) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of two texts that share terms; those are sampled once."""
    (ka, wa), (kb, wb) = terms(text), terms(other)
    keys, at = np.unique(np.concatenate([ka, kb]), return_inverse=True)
    w = np.zeros((2, len(keys)), np.int64)
    w[0, at[: len(ka)]] = wa
    w[1, at[len(ka) :]] = wb
    return tuple(sample(keys, w[0], w[1]))


def _range_of(value, edges: list[int]):
    """Number of `edges` (ascending) that are at most `value`, found in two steps of about sqrt(n)."""
    if not edges:
        return F.lit(0)
    step = max(1, round(len(edges) ** 0.5))
    coarse = F.size(F.filter(F.lit(edges[::step]), lambda x: x <= value))
    fine = F.slice(F.lit(edges), (coarse - 1) * step + 1, F.lit(step))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + F.size(F.filter(fine, lambda x: x <= value)))


def fingerprints(docs: DataFrame, per_range: int = 512, max_ranges: int = 8192) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and their likeness (see `_SCHEMA`).

    The next document of a row is the next in descending doc_id order (after the last: the first); null
    doc_ids come last, and rows of one doc_id are ordered by a hash of their texts. The ids alone are cut into
    ranges of about `per_range` rows (`max_ranges` at most; then they hold more), and the rows of one doc_id,
    where they are more, by that hash. Texts are dealt out once, each to its range, and the first text of a
    range also to the range before it; a task reads its ranges in order and holds two texts, of any length. A
    null text counts as empty; an empty text has an empty fingerprint. A single document is its own next. An
    empty table gives no rows; extra columns are ignored.
    """
    place = F.coalesce(F.bitwise_not("doc_id"), F.lit(2**63 - 1))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumns({"place": place, "tie": F.xxhash64("text")})
    places = rows.select("place")
    count = places.count()
    n = min(max_ranges, count // per_range + 1)
    most = max(per_range, -(-count // max_ranges))
    often = {r["place"]: -(-r["n"] // most) for r in places.groupBy("place").agg(F.count("*").alias("n")).filter(F.col("n") > 2 * most).collect()}  # max_ranges / 2 at most
    cut = places.approxQuantile("place", [k / n for k in range(1, n)], max(1 / (4 * n), 1e-4)) if n > 1 else []
    edges = sorted({max(-(2**63), min(2**63 - 1, int(x))) for x in cut} | {*often} | {p + 1 for p in often if p < 2**63 - 1})
    parts = [1] * (len(edges) + 1)
    for p, k in often.items():
        parts[bisect_right(edges, p)] = k
    starts = list(accumulate(parts, initial=0))
    edge = _range_of(F.col("place"), edges)
    share = (F.col("tie") / F.lit(2.0**64) + 0.5) * F.get(F.lit(parts), F.col("edge"))
    part = F.get(F.lit(starts[:-1]), F.col("edge")) + F.least(F.floor(share).cast("int"), F.get(F.lit(parts), F.col("edge")) - 1)
    ranged = rows.withColumn("edge", edge).withColumn("range", part).drop("edge")
    first = {r["range"]: r["first"] for r in ranged.select("range", "place", "tie").groupBy("range").agg(F.min(F.struct("place", "tie")).alias("first")).collect()}
    filled = sorted(first)
    before = {r: filled[k - 1] for k, r in enumerate(filled)}
    number = range(starts[-1])
    first_places, first_ties = (F.lit([first[r][k] if r in first else 0 for r in number]) for k in (0, 1))
    befores = F.lit([before.get(r, -1) for r in number])
    leads = (F.get(first_places, F.col("range")) == F.col("place")) & (F.get(first_ties, F.col("range")) == F.col("tie"))
    dealt = (
        ranged.withColumn("also", F.when(leads, F.get(befores, F.col("range"))))
        .withColumn("to", F.explode(F.array_compact(F.array(F.struct("range", F.lit(0).alias("extra")), F.when(F.col("also").isNotNull(), F.struct(F.col("also").alias("range"), F.lit(1).alias("extra")))))))
        .select("to.range", "to.extra", "place", "doc_id", "text", "tie")
        .repartition(F.col("range"))
        .sortWithinPartitions("range", "extra", "place", F.col("doc_id").desc_nulls_last(), "tie", "text")
        .drop("tie")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, prev, done = None, None, None  # range; text that waits for its next; row that waits for its next's signature

        def row(doc_id, text: str, following: str) -> tuple[dict, np.ndarray]:
            other = edited(text, following)
            a, b = _pair(text, other)
            return {
                "doc_id": doc_id,
                "n_chars": len(text),
                "edited_sha256": hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest(),
                "fingerprint": a.tobytes().hex(),
                "edited_fingerprint": b.tobytes().hex(),
                "near_edited": likeness(a, b),
            }, a

        for part in slices(batches):
            out = []
            for where, extra, _, doc_id, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if where != at:
                    at, prev, done = where, None, None
                if prev is not None:
                    now = row(*prev, text)
                    if done is not None:
                        out.append(done[0] | {"near_next": likeness(done[1], now[1])})
                    done = now
                    prev = None
                    if extra:
                        out.append(done[0] | {"near_next": likeness(done[1], fingerprint(text))})
                        done = None
                if not extra:
                    prev = (doc_id, text)
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW)

    return dealt.mapInArrow(run, _SCHEMA)
