"""Packing tokenised documents into fixed windows by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import functools
import heapq
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import slices

#: Characters on which both tokenizer libraries split alike; any other text goes to `tokenizers` itself.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-ɏͰ-ϿЀ-ӿ‐-‧‰-⁞₠-₿]*")
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = f"{PIECES}, sequence_id long, offset long"


def default_tokenizer() -> str:
    """Path of the public byte-level BPE vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.lru_cache(maxsize=2)
def _encoders(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    exact, fast = Tokenizer.from_file(path), None
    ranks = f"{path.removesuffix('.json')}.tiktoken"
    if os.path.exists(ranks):
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    return exact, fast


def token_ids(text: str, path: str, end_id: int = 1) -> np.ndarray:
    """Ids of a whole text, then `end_id`.

    The vocabulary's rank file, where it lies beside the given one, gives the same ids five times as
    fast; texts with unusual characters, special-token strings or very long unbroken runs go through
    `tokenizers`.
    """
    exact, fast = _encoders(path)
    if fast is not None and _PLAIN.fullmatch(text) and "<|endoftext|>" not in text:
        ids = fast.encode_ordinary(text)
    else:
        ids = exact.encode(text, add_special_tokens=False).ids
    ids.append(end_id)
    return np.array(ids, dtype="<u4")


def cuts(total: int, capacity: int, fine: bool, least: int = 16) -> Iterator[tuple[int, int]]:
    """Start and length of a document's pieces: full windows first, then the rest, whole or by halves.

    Differencing levels its windows with small pieces, so the rest of a `fine` document is halved down to
    pieces of at most `least` tokens.
    """
    at = 0
    while at < total:
        left = total - at
        length = capacity if left >= capacity else left - left // 2 if fine and left > least else left
        yield at, length
        at += length


def difference(lengths: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp: indices of `lengths` in `windows` parts of near-equal sums.

    Every item starts as a partition with one filled part. The two partitions of largest spread are
    merged, the fullest part of one with the emptiest of the other, until one is left.
    """
    heap = []
    for i, n in enumerate(lengths):
        parts = [(0, ())] * (windows - 1) + [(n, (i,))]
        heap.append((-n, i, parts))
    heapq.heapify(heap)
    order = len(lengths)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        merged = sorted(((x[0] + y[0], (x[1], y[1])) for x, y in zip(a, reversed(b), strict=True)), key=lambda p: p[0])
        low = merged[0][0]  # only differences matter for the order of merges
        heapq.heappush(heap, (low - merged[-1][0], order, merged))
        order += 1
    return [_leaves(tree) for _, tree in heap[0][2]] if heap else []


def _leaves(tree) -> list[int]:
    out, stack = [], [tree]
    while stack:
        for x in stack.pop():
            out.append(x) if isinstance(x, int) else stack.append(x)
    return sorted(out)


def balance(lengths: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows of at most `capacity`; one more window is tried whenever one would overflow."""
    if not lengths:
        return []
    windows = max(1, -(-sum(lengths) // capacity))
    while True:
        parts = difference(lengths, windows)
        if all(sum(lengths[i] for i in p) <= capacity for p in parts):
            return [p for p in parts if p]
        windows += 1


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, fine: int = 3) -> DataFrame:
    """Tokenise each text (null: empty) once and cut it, one document in `fine` into halves; no text leaves its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                ids = token_ids(text or "", tokenizer)
                raw = memoryview(ids.tobytes())
                for start, length in cuts(len(ids), capacity, zlib.crc32(raw) % fine == 0):
                    for column, value in zip(out, (doc_id, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)]), len(ids)), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = 2048, fine: int = 3, group: int = 8) -> DataFrame:
    """Pack all documents into windows of at most `capacity` tokens; one row per piece.

    A document (null text: empty, its end token alone) is cut into whole windows and a rest; one document
    in `fine`, by its ids, has the rest cut by halves, which gives the small pieces that level windows. Only piece lengths are dealt out, by hash of document and start;
    each task packs runs of about `group` windows by Karmarkar-Karp differencing. A run holds just less
    than `group` full windows, so that the balanced windows are nearly full; the window count of a run
    rises when one would overflow. Repeated doc_ids are packed as separate documents; a null doc_id
    stays null. An empty table gives no rows. Extra columns are ignored.
    """
    cut = pieces(docs, tokenizer or default_tokenizer(), capacity, fine)
    dealt = cut.repartition(F.xxhash64("doc_id", "start")).sortWithinPartitions("doc_id", "start", "length", "ids_crc32")
    target = max(capacity, group * (capacity - capacity // 256))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 33
        queue: list[tuple] = []
        waiting = 0

        def close(rows: list[tuple]) -> Iterator[tuple]:
            nonlocal sequence
            for part in balance([r[2] for r in rows], capacity):
                offset = 0
                for i in part:
                    yield (*rows[i], sequence, offset)
                    offset += rows[i][2]
                sequence += 1

        def take() -> list[tuple]:
            """Pieces in order of arrival as long as they fit, then those that fit the rest best."""
            nonlocal queue, waiting
            room, n = target, 0
            while n < len(queue) and queue[n][2] <= room:
                room -= queue[n][2]
                n += 1
            rows, queue = queue[:n], queue[n:]
            while (best := max((i for i, r in enumerate(queue) if r[2] <= room), key=lambda i: queue[i][2], default=None)) is not None:
                room -= queue[best][2]
                rows.append(queue.pop(best))
            waiting -= target - room
            return rows

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in PACKED.split(", ")])

        for batch in batches:
            ready: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[2] == capacity:
                    ready += close([row])
                    continue
                queue.append(row)
                waiting += row[2]
                if waiting >= 2 * target:
                    ready += close(take())
            yield flush(ready)
        ready = []
        while queue:
            ready += close(take())
        yield flush(ready)

    return dealt.mapInArrow(run, PACKED)
