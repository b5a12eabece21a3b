"""Token counts under a unigram model: dynamic programming shared along the trie of distinct pre-tokens.

Distinct pre-tokens, sorted as bytes, are a trie walked depth first: two neighbours share the nodes of their longest
common prefix. The forward score of a node (the best sum of piece scores that ends there) depends on its prefix alone,
so it is computed once per node and kept on the path from the root. A terminal node stores the number of tokens.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .byte_bpe import Dictionary, load_ranks, pre_tokens, stored
from .common import id_and_text, texts


def unigram_scores(path: str) -> dict[bytes, float]:
    """Piece -> log probability. A ranked vocabulary has no probabilities; Zipf's law on the rank gives them."""
    ranks = load_ranks(path)
    total = math.log(sum(1 / (r + 1) for r in ranks.values()))
    return {piece: -math.log(rank + 1) - total for piece, rank in ranks.items()}


class Walk:
    """Forward scores and token counts on the path to the last word."""

    def __init__(self, scores: dict[bytes, float]):
        self._scores, self._longest = scores, max(map(len, scores), default=0)
        self._word, self._best, self._count = b"", [0.0], [0]

    def __call__(self, word: bytes) -> int:
        """Tokens of the best segmentation; of equal ones, of the one with fewer tokens."""
        same = 0
        for a, b in zip(self._word, word):
            if a != b:
                break
            same += 1
        best, count, scores = self._best[: same + 1], self._count[: same + 1], self._scores
        for end in range(same + 1, len(word) + 1):
            top, least = -math.inf, 0
            for start in range(max(0, end - self._longest), end):
                own = scores.get(word[start:end])
                if own is not None and (own + best[start], -count[start]) > (top, 1 - least):
                    top, least = own + best[start], count[start] + 1
            best.append(top)
            count.append(least)
        self._word, self._best, self._count = word, best, count
        return count[-1]


def counted(docs: DataFrame, scores: dict[bytes, float], pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_pre_tokens, n_tokens.

    ``scores`` must have all single bytes, so that every text has a segmentation. Null or empty text: zeros. A null
    id keeps its row, repeated rows are counted each, an empty table gives no rows, other columns are not read.
    """
    if any(bytes([b]) not in scores for b in range(256)):
        raise ValueError("the vocabulary lacks single bytes")
    words = pre_tokens(id_and_text(docs, key, text), pattern)
    held = docs.sparkSession.sparkContext.broadcast(scores)
    distinct = words.select(F.explode("words").alias("word")).distinct()
    ranged = distinct.repartitionByRange("word").sortWithinPartitions("word")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Walk(held.value)
        for batch in batches:
            found = [[count(w)] for w in texts(batch.column("word"))]
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(found, pa.list_(pa.int32()))], ["word", "ids"])

    counts = ranged.mapInArrow(walk, "word string, ids array<int>").select(F.xxhash64("word").alias("key"), "word", "ids")
    shards = stored(materialize(counts, "token-counts"))

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look_up, known = Dictionary(shards), {}
        for batch in batches:
            lists = batch.column("words")
            coded = lists.flatten().dictionary_encode()
            names = coded.dictionary.to_pylist()
            if len(known) > 1_000_000:
                known = {}
            new = [w for w in names if w not in known]
            known.update(zip(new, (int(c[0]) for c in look_up(new))))
            own = np.fromiter(map(known.__getitem__, names), np.int64, len(names))
            sums = np.r_[0, np.cumsum(own[coded.indices.to_numpy()] if len(names) else own)]
            sizes = lists.value_lengths().to_numpy().astype(np.int64)
            ends = np.r_[0, np.cumsum(sizes)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.array(sums[ends[1:]] - sums[ends[:-1]])],
                ["doc_id", "n_pre_tokens", "n_tokens"],
            )

    return words.mapInArrow(total, "doc_id long, n_pre_tokens long, n_tokens long")
