"""Token counts under a unigram vocabulary, by dynamic programming over a trie of distinct pre-tokens."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import slices

#: Pre-tokens whose count a worker remembers; the memory is emptied when full, which changes no result.
COUNT_CACHE = 300_000
#: Documents whose distinct pre-tokens share one trie, and bytes of their texts at most (beyond one text).
TRIE_DOCS, TRIE_BYTES = 2048, 6_000_000
#: What a byte of a character outside the vocabulary costs, in nats.
BYTE_SCORE = -20.0


def default_vocabulary() -> str:
    """Path of the public 32k piece vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> dict[str, float]:
    """Log-probability of each piece: Zipf's law over the order of the vocabulary file, which gives ranks but no frequencies.

    Control, unknown and byte pieces are left out.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    size = model.vocab_size()
    pieces = [model.id_to_piece(i) for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    ranks = sorted(range(len(pieces)), key=lambda i: -model.get_score(model.piece_to_id(pieces[i])))
    norm = math.log(sum(1 / (r + 10) for r in range(len(pieces))))
    return {pieces[i]: -math.log(r + 10) - norm for r, i in enumerate(ranks)}


def terminal_counts(pretokens: Iterable[str], scores: dict[str, float]) -> dict[str, int]:
    """Tokens of the best segmentation of each distinct pre-token.

    Sorted pre-tokens are the depth-first walk of their trie: the stacks hold, for each node on the path,
    the best forward score and its token count. A prefix shared with the pre-token before is not scored
    again. Of equal scores the one with fewer tokens counts. A character that no piece ends with costs its
    UTF-8 bytes, one token each.
    """
    longest = max(map(len, scores), default=1)
    find = scores.get
    best, count = [0.0], [0]
    before, out = "", {}
    for word in sorted(set(pretokens)):
        k, n = 0, min(len(before), len(word))
        while k < n and before[k] == word[k]:
            k += 1
        del best[k + 1 :], count[k + 1 :]
        for end in range(k + 1, len(word) + 1):
            top, tokens = -math.inf, 0
            for start in range(max(0, end - longest), end):
                s = find(word[start:end])
                if s is not None:
                    value, c = best[start] + s, count[start] + 1
                    if value > top or value == top and c < tokens:
                        top, tokens = value, c
            size = len(word[end - 1].encode("utf-8", "surrogatepass"))
            if (value := best[end - 1] + size * BYTE_SCORE) > top:
                top, tokens = value, count[end - 1] + size
            best.append(top)
            count.append(tokens)
        out[word] = count[-1]
        before = word
    return out


_COUNTS: dict[str, dict[bytes, int]] = {}


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_pretokens, n_tokens of every whole text; no shuffle.

    Pre-tokens are the words `[^\\x20\\x09-\\x0D]+`, each with the vocabulary's word mark before it. Null and
    empty texts have no tokens; a text of any length is read whole. Rows are counted one by one, so repeated doc_ids stay repeated and a null
    doc_id stays null. Extra columns are ignored.
    """
    path = path or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = vocabulary(path)
        known = _COUNTS.setdefault(path, {})
        for part in slices(batches, TRIE_DOCS, TRIE_BYTES):
            texts = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in part.column(1).to_pylist()]
            if len(known) > COUNT_CACHE:
                known.clear()
            new = {w for words in texts for w in words} - known.keys()
            marked = {"▁" + w.decode("utf-8", "surrogatepass"): w for w in new}
            known.update((marked[w], n) for w, n in terminal_counts(marked, scores).items())
            tokens = [sum(map(known.__getitem__, words)) for words in texts]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(len, texts), pa.int64()), pa.array(tokens, pa.int64())], names=["doc_id", "n_pretokens", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")
