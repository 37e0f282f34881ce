"""N-gram Jaccard self-join with prefix filters under several global token orders, and its components.

Order 1 is the order of token hashes. A document's first tokens in it, more than the plain prefix, tell how
many tokens a similar document would share; documents with too few shared ones have no link and go no
further. Order 2 puts tokens rare among the rest first, so that prefixes avoid common passages; documents
that share a prefix token at admissible positions are candidates. Order 3 is order 1 reversed; a candidate
pair must also share prefix tokens under orders 1 and 3 before its sets are compared.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import Scratch, mix, shingles, slices, word_hashes, words
from fieldloom.llm.components import components

#: Two sets link when TIMES * intersection >= PART * (sum of sizes): a Jaccard similarity of at least 0.8.
TIMES, PART = 9, 4
#: Tokens of order 1 beyond the plain prefix, as a share of the set; similar documents share so many more.
MARGIN = 0.05
#: Documents whose postings are packed together, in the first and in the second exchange.
SLICE_DOCS, SET_DOCS = 2048, 256
_LOW48 = np.uint64(2**48 - 1)


def token_set(text: str | None, n: int = 5) -> np.ndarray:
    """Distinct `n`-word shingles of a whole text as sorted 64-bit hashes."""
    return np.unique(shingles(word_hashes(words(text)), n))


def least_overlap(size: int) -> int:
    """Tokens that a set of `size` shares with any similar one at least."""
    return -(-4 * size // 5)


def first_prefix(size: int) -> int:
    return min(size, size - least_overlap(size) + 1 + int(MARGIN * size))


def _six(tokens: np.ndarray) -> bytes:
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _groups(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values."""
    starts = np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]]) if len(sorted_values) else np.zeros(0, np.int64)
    return starts, np.diff(np.r_[starts, len(sorted_values)])


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Rows of sorted batches by their first column."""
    at, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[0] != at:
                if held:
                    yield at, held
                at, held = row[0], []
            held.append(row)
    if held:
        yield at, held


def _batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_POSTINGS = pa.schema([("bucket", pa.int32()), ("tokens", pa.binary()), ("docs", pa.binary()), ("known", pa.binary()), ("hashes", pa.binary())])
_TALLY = pa.schema([("doc_id", pa.int64()), ("size", pa.int32()), ("n", pa.int32()), ("hash", pa.int64())])
_SLIM = pa.schema([("slice", pa.int64()), ("doc_id", pa.int64()), ("size", pa.int32()), ("low", pa.binary())])
_SETS = pa.schema([("slice", pa.int64()), ("doc_id", pa.int64()), ("size", pa.int32()), ("tokens", pa.binary())])
_ENDS = pa.schema([("doc_id", pa.int64()), ("ends", pa.binary())])
_ENTRIES = pa.schema([("token", pa.int64()), ("doc_id", pa.int64()), ("size", pa.int32()), ("left", pa.int32())])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _postings(buckets: int, n: int) -> Callable:
    """Order-1 prefixes of SLICE_DOCS documents at a time, packed by bucket of the token.

    A token that several documents of the slice hold is known to be shared: it is credited at once and
    sent without documents, so a token of very many documents is sent once a slice. Rows with a negative
    bucket carry the slice's documents: ids, sizes, credits and set hashes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, SLICE_DOCS):
            docs = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            sets = [token_set(t, n) for t in part.column(1).to_pylist()]
            sizes = np.array([len(s) for s in sets], np.int32)
            hashes = np.array([int(mix(s).sum(dtype=np.uint64)) if len(s) else 0 for s in sets], np.uint64)
            cut = [first_prefix(len(s)) for s in sets]
            own = np.repeat(np.arange(len(sets)), cut)
            tokens = np.concatenate([s[:c] for s, c in zip(sets, cut, strict=True)] or [np.zeros(0, np.uint64)]) & _LOW48
            order = np.lexsort((tokens, tokens % np.uint64(buckets)))
            tokens, own = tokens[order], own[order]
            starts, counts = _groups(tokens)
            many = np.repeat(counts, counts) > 1
            credit = np.bincount(own[many], minlength=len(sets)).astype(np.int32)
            single, shared = counts == 1, starts[counts > 1]
            one, who, several = tokens[starts[single]], own[starts[single]], tokens[shared]
            ends = np.arange(buckets + 1, dtype=np.uint64)
            a, b = np.searchsorted(one % np.uint64(buckets), ends), np.searchsorted(several % np.uint64(buckets), ends)
            rows: list[list] = [[], [], [], [], []]
            for k in np.flatnonzero((a[1:] > a[:-1]) | (b[1:] > b[:-1])).tolist():
                for column, value in zip(rows, (k, _six(one[a[k] : a[k + 1]]), docs[who[a[k] : a[k + 1]]].tobytes(), _six(several[b[k] : b[k + 1]]), b""), strict=True):
                    column.append(value)
            if len(docs):
                for column, value in zip(rows, (-1 - int(hashes[0] % np.uint64(buckets)), sizes.tobytes(), docs.tobytes(), credit.tobytes(), hashes.tobytes()), strict=True):
                    column.append(value)
            yield _batch(_POSTINGS, *rows)

    return run


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document and bucket the number of its prefix tokens that another document holds; the slices' documents as they came."""
    for bucket, rows in _by_bucket(batches):
        if bucket < 0:
            for _, sizes, docs, credit, hashes in rows:
                yield _batch(_TALLY, np.frombuffer(docs, np.int64), np.frombuffer(sizes, np.int32), np.frombuffer(credit, np.int32), np.frombuffer(hashes, np.int64))
            continue
        tokens = _from_six(b"".join(r[1] for r in rows))
        docs = np.frombuffer(b"".join(r[2] for r in rows), np.int64)
        known = _from_six(b"".join(r[3] for r in rows))
        everything = np.sort(np.concatenate([tokens, known, known]))
        starts, counts = _groups(everything)
        shared = everything[starts[counts > 1]]
        at = np.searchsorted(shared, tokens)
        hit = np.zeros(len(tokens), bool) if not len(shared) else shared[np.minimum(at, len(shared) - 1)] == tokens
        ids, n = np.unique(docs[hit], return_counts=True)
        if len(ids):
            yield _batch(_TALLY, ids, [None] * len(ids), n.astype(np.int32), [None] * len(ids))


#: Bits of an id filter a row, and at most (16 MB).
FILTER_BITS, MOST_BITS = 16, 2**27


def _bits(ids: DataFrame, count: int) -> np.ndarray:
    """A bitmap of hashed ids (one column): FILTER_BITS bits for each of `count` rows, MOST_BITS at most.

    Spark builds it in pieces of 32,768 bits; at most 16 MB reach the driver and, as a broadcast, the tasks.
    """
    n = min(MOST_BITS, 2 ** max(15, (FILTER_BITS * count - 1).bit_length()))
    place = F.pmod(F.xxhash64(ids.columns[0]), F.lit(n))
    pieces = ids.select((place + 1).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("b")).collect()
    out = np.zeros(n // 8, np.uint8)
    for r in pieces:
        at = (r["k"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(bytes(r["b"]), np.uint8)[: len(out) - at]
    return out


def _thinned(rows: DataFrame, ids: DataFrame, count: int) -> DataFrame:
    """Rows whose doc_id is in `ids` (column doc_id), and some others, before any shuffle.

    The filter's size is bounded, so it thins less the more ids there are, and not at all beyond some 10^9.
    Whoever reads the rest joins it with `ids` exactly, by shuffle, at every size.
    """
    bits = _bits(ids, count)
    held = rows.sparkSession.sparkContext.broadcast(bits)
    names = rows.columns

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            yield batch.select(names).filter(pa.array((held.value[at >> 3] >> (at & 7)) & 1 == 1))

    return rows.withColumn("__place", F.pmod(F.xxhash64("doc_id"), F.lit(8 * len(bits)))).mapInArrow(chosen, rows.schema)


def _sets(n: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = uuid.uuid4().int >> 65, 0
        for part in slices(batches, SET_DOCS):
            sets = [token_set(t, n) for t in part.column(1).to_pylist()]
            if held + len(sets) > SET_DOCS:
                name, held = uuid.uuid4().int >> 65, 0
            held += len(sets)
            yield _batch(_SETS, [name] * len(sets), part.column(0).to_pylist(), [len(s) for s in sets], [s.tobytes() for s in sets])

    return run


_COUNTED = pa.schema([("bucket", pa.int32()), ("slice", pa.int64()), ("tokens", pa.binary()), ("counts", pa.binary())])
_REPLIES = pa.schema([("slice", pa.int64()), ("tokens", pa.binary()), ("counts", pa.binary())])


def _slim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        low = [_six(np.frombuffer(t, np.uint64)) for t in part.column(3).to_pylist()]
        yield _batch(_SLIM, *part.columns[:3], low)


def _counted(buckets: int) -> Callable:
    """Distinct tokens of each slice of sets and how many of its documents hold them, packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, rows in _by_bucket(batches):
            tokens, counts = np.unique(np.frombuffer(b"".join(r[3] for r in rows), np.uint64) & _LOW48, return_counts=True)
            order = np.argsort(tokens % np.uint64(buckets), kind="stable")
            tokens, counts = tokens[order], np.minimum(counts[order], 2**16 - 1).astype(np.uint16)
            ends = np.searchsorted(tokens % np.uint64(buckets), np.arange(buckets + 1, dtype=np.uint64))
            used = np.flatnonzero(ends[1:] > ends[:-1]).tolist()
            yield _batch(_COUNTED, used, [name] * len(used), [_six(tokens[ends[k] : ends[k + 1]]) for k in used], [counts[ends[k] : ends[k + 1]].tobytes() for k in used])

    return run


def _replies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each slice its tokens that two documents or more hold, and how many do."""
    for _, rows in _by_bucket(batches):
        parts = [_from_six(r[2]) for r in rows]
        tokens, at = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.bincount(at, np.frombuffer(b"".join(r[3] for r in rows), np.uint16), len(tokens)).astype(np.uint32)[at]
        ends = np.cumsum([0, *map(len, parts)])
        out: list[list] = [[], [], []]
        for k, (row, part) in enumerate(zip(rows, parts, strict=True)):
            df = total[ends[k] : ends[k + 1]]
            if (held := df > 1).any():
                for column, value in zip(out, (row[1], _six(part[held]), df[held].tobytes()), strict=True):
                    column.append(value)
        yield _batch(_REPLIES, *out)


def _entries(sets: pa.Table, replies: pa.Table) -> pa.Table:
    """Order-2 prefix tokens of a slice's sets that other documents hold; `left` counts the tokens from each on.

    Tokens are cut to 48 bits here: one that two tokens share can only add candidates.
    """
    tokens = _from_six(b"".join(replies.column("tokens").to_pylist()))
    df = np.frombuffer(b"".join(replies.column("counts").to_pylist()), np.uint32)
    order = np.argsort(tokens)
    tokens, df = tokens[order], df[order]
    out = []
    for doc, size, raw in zip(sets.column("doc_id").to_pylist(), sets.column("size").to_pylist(), sets.column("low").to_pylist(), strict=True):
        own = _from_six(raw)
        at = np.minimum(np.searchsorted(tokens, own), max(0, len(tokens) - 1))
        held = tokens[at] == own if len(tokens) else np.zeros(len(own), bool)
        mine, often = own[held], df[at[held]] if len(tokens) else df
        first = size - len(mine)  # tokens of no other document come first
        room = size - least_overlap(size) + 1 - first
        if room > 0 and len(mine):
            chosen = mine[np.lexsort((mine, often))[:room]]
            out.append(_batch(_ENTRIES, chosen.view(np.int64), [doc] * len(chosen), [size] * len(chosen), size - first - np.arange(len(chosen))))
    return pa.Table.from_batches(out, _ENTRIES)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets link."""
    need = -(-PART * (len(a) + len(b)) // TIMES)
    return 0 < need <= min(len(a), len(b)) and len(np.intersect1d(a, b, assume_unique=True)) >= need


def ends(tokens: np.ndarray) -> np.ndarray:
    """Prefixes of a sorted set under order 1 and under order 3, one after the other, cut to 32 bits a token."""
    p = len(tokens) - least_overlap(len(tokens)) + 1
    return np.concatenate([tokens[:p], tokens[len(tokens) - p :]]).astype("<u4") if len(tokens) else np.zeros(0, "<u4")


def sharing(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets share a prefix token under order 1 and one under order 3, as all sets that link do."""
    p, q = len(a) // 2, len(b) // 2
    return len(np.intersect1d(a[:p], b[:q])) > 0 and len(np.intersect1d(a[p:], b[q:])) > 0


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        yield _batch(_ENDS, part.column(0), [ends(np.frombuffer(t, np.uint64)).tobytes() for t in part.column(1).to_pylist()])


def _chosen(test: Callable, kind: type) -> Callable:
    """Pairs (x, y) whose two values pass `test`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            keep = [test(np.frombuffer(p, kind), np.frombuffer(q, kind)) for p, q in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
            yield part.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _paired(pairs: DataFrame, table: DataFrame, column: str, count: int) -> DataFrame:
    """Pairs (x, y) with `column` of `table` for both. Only rows that occur in a pair are dealt out.

    Merge joins at every size: a broadcast would put two Python operators into one stage, and twice the workers.
    """
    used = pairs.select(F.col("x").alias("doc_id")).union(pairs.select("y")).distinct()
    table = _thinned(table.select("doc_id", column), used, count)
    a, b = (table.select(F.col("doc_id").alias(k), F.col(column).alias(v)) for k, v in (("x", "a"), ("y", "b")))
    return pairs.join(a.hint("merge"), "x").join(b.hint("merge"), "y").select("x", "y", "a", "b")


def _linked(pairs: DataFrame, sets: DataFrame, prefixes: DataFrame, count: int, scratch: Scratch, name: str) -> DataFrame:
    """Pairs (x, y), candidates under order 2, whose sets link; sets move only for those that orders 1 and 3 let pass too."""
    near = _paired(pairs, prefixes, "ends", count).mapInArrow(_chosen(sharing, np.uint32), "x long, y long")
    near = scratch.keep(near, f"{name}-near")
    return _paired(near, sets, "tokens", count).mapInArrow(_chosen(similar, np.uint64), "x long, y long").distinct()


_ADMISSIBLE = f"{TIMES} * least(left, hub.left) >= {PART} * (size + hub.size)"


def _stars(entries: DataFrame, order: list) -> DataFrame:
    """For each token's list the pairs of its hub, the first document in `order`, with the others."""
    hub = F.struct(*order, "doc_id", "size", "left", "label")
    hubs = entries.groupBy("token").agg(F.min(hub).alias("hub"), F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("token", "hub")
    found = entries.join(hubs, "token").filter("label != hub.label").filter(_ADMISSIBLE)
    return found.select(F.least("doc_id", "hub.doc_id").alias("x"), F.greatest("doc_id", "hub.doc_id").alias("y")).distinct()


#: A little more than the largest ratio of the sizes of two sets that link, 5/4.
_RATIO = 1.2501


def _rest(entries: DataFrame) -> DataFrame:
    """All admissible pairs of a token's list that lie in different components; the smaller set comes with at most a ninth of it before the token.

    Lists are cut into classes of sizes; sets that link lie in one class or in adjacent ones.
    """
    classed = entries.withColumn("class", F.floor(F.log(F.col("size")) / F.log(F.lit(_RATIO))))
    mixed = classed.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("token")
    held = classed.join(mixed, "token", "left_semi")
    small = held.filter(f"{TIMES} * left >= {2 * PART} * size").select("token", F.explode(F.array("class", F.col("class") + 1)).alias("class"), F.struct("doc_id", "size", "left", "label").alias("hub"))
    found = held.join(small, ["token", "class"]).filter("label != hub.label AND (hub.size < size OR hub.size = size AND hub.doc_id < doc_id)").filter(_ADMISSIBLE)
    return found.select(F.least("doc_id", "hub.doc_id").alias("x"), F.greatest("doc_id", "hub.doc_id").alias("y")).distinct()


def jaccard_components(docs: DataFrame, n: int = 5, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable over links) of every document.

    Exact: the filters drop no pair of Jaccard similarity 0.8 or more (up to collisions of 64-bit hashes).
    Documents of equal sets collapse to the smallest doc_id, by aggregation. In the lists of order 2 each
    document is compared with its list's hub, the document with the fewest tokens of its own, so a group of
    near copies costs one comparison a copy; pairs left between different components are then all compared.
    Null and empty texts have the empty set, link with nothing and are their own component. Rows of one
    doc_id are one node; a row is returned for each distinct (doc_id, n_shingles). A null doc_id links with
    nothing and has a null component. An empty table gives no rows; extra columns are ignored.
    """
    scratch = scratch or Scratch(docs.sparkSession, "jaccard")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = rows.filter("doc_id IS NOT NULL")
    count = docs.count()
    buckets = min(65_536, max(64, count // 2000))

    posted = known.mapInArrow(_postings(buckets, n), _ddl(_POSTINGS)).repartition("bucket").sortWithinPartitions("bucket")
    tally = scratch.keep(posted.mapInArrow(_tally, _ddl(_TALLY)), "tally")
    sizes = tally.filter("size IS NOT NULL").select("doc_id", "size", "hash").distinct()
    shared = tally.groupBy("doc_id").agg(F.sum("n").alias("n"))
    need = 1 + F.floor(F.lit(MARGIN) * F.ceil(F.col("size") * 4 / F.lit(5.0)))
    kept = sizes.filter("size > 0").join(shared, "doc_id").filter(F.col("n") >= need).select("doc_id", "size", "hash")
    kept = scratch.keep(kept, "kept")
    classes = scratch.keep(kept.groupBy("hash", "size").agg(F.min("doc_id").alias("rep")), "classes")
    copies = scratch.keep(kept.join(classes, ["hash", "size"]).select("doc_id", "rep"), "copies")
    reps = classes.select(F.col("rep").alias("doc_id")).distinct()

    sets = scratch.keep(_thinned(known, reps, count).join(reps.hint("merge"), "doc_id", "left_semi").mapInArrow(_sets(n), _ddl(_SETS)), "sets")
    prefixes = scratch.keep(sets.select("doc_id", "tokens").mapInArrow(_ended, _ddl(_ENDS)), "ends")
    slim = sets.mapInArrow(_slim, _ddl(_SLIM))
    counted = sets.mapInArrow(_counted(buckets), _ddl(_COUNTED)).repartition("bucket").sortWithinPartitions("bucket")
    replies = counted.mapInArrow(_replies, _ddl(_REPLIES))
    entries = slim.groupBy("slice").cogroup(replies.groupBy("slice")).applyInArrow(_entries, _ddl(_ENTRIES))
    entries = scratch.keep(entries, "entries")

    edges = copies.groupBy("doc_id").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).filter("x < y").select("x", "y")
    labels = entries.select(F.col("doc_id").alias("node")).distinct().withColumn("label", F.col("node"))
    own = F.col("left") / F.col("size")
    rounds = ("hub", lambda e: _stars(e, [(-own).alias("own"), F.xxhash64("doc_id").alias("mixed")])), ("again", lambda e: _stars(e, [F.xxhash64("doc_id", F.lit(1)).alias("mixed")])), ("rest", _rest)
    for name, candidates in rounds:
        labelled = entries.join(labels.select(F.col("node").alias("doc_id"), "label"), "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))
        pairs = scratch.keep(candidates(labelled), f"{name}-pairs")
        edges = scratch.keep(edges.union(_linked(pairs, sets, prefixes, count, scratch, name)).distinct(), f"{name}-edges")
        labels = components(edges, scratch, name)

    rep = copies.groupBy("doc_id").agg(F.min("rep").alias("rep"))
    ends = sizes.select("doc_id", F.col("size").cast("long").alias("n_shingles")).distinct().join(rep, "doc_id", "left")
    ends = ends.join(labels, ends["rep"] == labels["node"], "left").select("doc_id", "n_shingles", F.coalesce("label", "rep", "doc_id").alias("component_id"))
    nameless = rows.filter("doc_id IS NULL").mapInArrow(_bare(n), "doc_id long, n_shingles long, component_id long").distinct()
    return ends.union(nameless)


def _bare(n: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sizes = [len(token_set(t, n)) for t in part.column(1).to_pylist()]
            none = pa.nulls(len(sizes), pa.int64())
            yield pa.RecordBatch.from_arrays([none, pa.array(sizes, pa.int64()), none], names=["doc_id", "n_shingles", "component_id"])

    return run


def keep_one(docs: DataFrame, n: int = 5, scratch: Scratch | None = None) -> DataFrame:
    """`docs` with one document, the smallest doc_id, of each component; rows without a doc_id stay."""
    found = jaccard_components(docs, n, scratch)
    gone = found.filter("component_id < doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
