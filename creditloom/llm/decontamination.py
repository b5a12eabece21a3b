"""Benchmark passages in documents, paraphrases too, by latent semantic retrieval.

Passages of the documents are TF-IDF vectors over the benchmark's words. A randomised SVD over all passages,
summed up by the executors, gives a latent space; passages whose cosine with a benchmark item is high
are candidates, and a longest common subsequence and an answer check decide.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import id_and_text, rows_of

STRIDE = 32
RANK = 256
#: Word by benchmark vocabulary is a matrix in memory; a larger vocabulary is refused.
MAX_VOCABULARY = 1_000_000
#: A word in more than this share of the passages says nothing about an item.
COMMON = 0.05
#: An item with fewer informative words has no direction of its own.
LEAST_INFORMATIVE = 4
_LOWERED = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_TEXTS_AT_ONCE = 200
#: So many of the most frequent words are counted in pairs (a task holds a table of all pairs), and words until these counts are summed up.
_PAIRED, _COUNTED = 4096, 2**26


def tokens(text: bytes | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters and digits and of all other non-ASCII characters."""
    return text.translate(_LOWERED).split() if text else []


class Items:
    """The benchmark: its words, the items as word ids, and their answers (the last sentence)."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.ids = [r[0] for r in rows]
        self.words = [tokens(r[1].encode()) for r in rows]
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for words in self.words for w in words}))}
        if len(self.vocabulary) > MAX_VOCABULARY:
            raise ValueError(f"the benchmark may have at most {MAX_VOCABULARY} distinct words")
        self.answers = []
        for r in rows:
            sentences = [tokens(s.encode()) for s in re.split(r"[.?!\n]+", r[1])]
            sentences = [s for s in sentences if s]
            self.answers.append(sentences[-1] if sentences else [])


def blocks(found: list[bytes | None], vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word id, block, first block of each text) of the vocabulary's words in some texts.

    Blocks hold :data:`STRIDE` words and are numbered through; an empty one ends each text, so that no
    passage of two blocks reaches into the next text.
    """
    words, places, starts, at = [], [], [], 0
    for text in found:
        own = tokens(text)
        ids = np.fromiter(map(vocabulary.get, own, repeat(-1)), np.int64, len(own))
        known = np.flatnonzero(ids >= 0)
        words.append(ids[known])
        places.append(known // STRIDE + at)
        starts.append(at)
        at += -(-len(own) // STRIDE) + 1
    return np.concatenate(words), np.concatenate(places), np.array([*starts, at])


def _chunks(found: list) -> Iterator[tuple[int, list]]:
    for i in range(0, len(found), _TEXTS_AT_ONCE):
        yield i, found[i : i + _TEXTS_AT_ONCE]


def _block_sums(block: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``rows`` by ascending ``block``, for all n blocks."""
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    if len(block):
        edges = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        out[block[edges]] = np.add.reduceat(rows, edges, axis=0)
    return out


def _partial(docs: DataFrame, run, n: int) -> np.ndarray:
    """Sum over all tasks of an array of ``n`` doubles that ``run`` computes from a task's texts, added up by position."""
    width = 4096

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n)
        run((part for (found,) in rows_of(batches, "text") for _, part in _chunks(found)), total)
        parts = [total[i : i + width] for i in range(0, n, width)]
        used = [i for i, p in enumerate(parts) if p.any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array([parts[i] for i in used], pa.list_(pa.float64()))], ["part", "values"]
        )

    def add(table):
        values = sum(np.asarray(v.values) for v in table["values"])
        return pa.table({"part": table["part"].slice(0, 1).cast(pa.int64()), "values": pa.array([values], pa.list_(pa.float64()))})

    rows = docs.mapInArrow(each, "part long, values array<double>")
    summed = rows.groupBy("part").applyInArrow(add, "part long, values array<double>").collect()
    out = np.zeros(n)
    for r in summed:
        out[r["part"] * width : r["part"] * width + len(r["values"])] = r["values"]
    return out


def informative_words(docs: DataFrame, items: Items) -> dict[bytes, float]:
    """Word -> weight (idf) for the benchmark's words that stand in few passages; one pass."""
    names, size = list(items.vocabulary), len(items.vocabulary)
    vocabulary = items.vocabulary

    def count(parts: Iterator[list], total: np.ndarray) -> None:
        for part in parts:
            word, block, starts = blocks(part, vocabulary)
            total[:size] += np.bincount(np.unique(block * size + word) % size, minlength=size)
            total[size] += starts[-1] - len(part)

    counts = _partial(docs, count, size + 1)
    passages = max(counts[size], 1.0)
    # In a handful of passages a share means nothing: a word must also be frequent to be common.
    return {w: float(np.log((1 + passages) / (1 + c))) for w, c in zip(names, counts) if c <= max(COMMON * passages, 20)}


class _Pairs:
    """How often two of ``n`` words stand in one block."""

    def __init__(self, n: int):
        self._later, self._own, self.words = np.zeros((n, n), np.int32), np.zeros(n, np.int64), 0

    def add(self, word: np.ndarray, block: np.ndarray) -> None:
        """Words of ascending blocks."""
        n, flat = len(self._own), self._later.reshape(-1)
        self.words += len(word)
        self._own += np.bincount(word, minlength=n)
        for apart in range(1, len(word)):
            same = np.flatnonzero(block[apart:] == block[:-apart])
            if not len(same):
                break
            np.add.at(flat, word[same] * n + word[same + apart], 1)

    def times(self, rows: np.ndarray) -> np.ndarray:
        """The table of all pairs, those of a word with itself too, times ``rows``. The counts begin anew."""
        out = self._own[:, None] * rows
        for at in range(0, len(out), 256):
            part = slice(at, at + 256)
            out[part] += (self._later[part] + self._later[:, part].T).astype(np.float64) @ rows
        self.__init__(len(out))
        return out


def latent_basis(docs: DataFrame, weights: dict[bytes, float], rank: int = RANK, seed: int = 5, paired: int = _PAIRED) -> np.ndarray:
    """An orthonormal basis near the leading right singular vectors: one pass sums Y = A'(A W) for a random W.

    A block of words that are all among the ``paired`` most frequent ones is counted in pairs, A'A, which W meets once in a task; the
    rows of W are added up only for the others. Only an array of the size of the benchmark's vocabulary comes back.
    """
    size, rank = len(weights), min(rank, len(weights))
    vocabulary, idf = {w: i for i, w in enumerate(weights)}, np.array(list(weights.values()))
    start = np.random.default_rng(seed).standard_normal((size, rank)) * idf[:, None]
    chosen = np.sort(np.argsort(idf, kind="stable")[:paired])
    places = np.full(size, -1)
    places[chosen] = np.arange(len(chosen))

    def sketch(parts: Iterator[list], total: np.ndarray) -> None:
        gram, pairs = total.reshape(size, rank), _Pairs(len(chosen))

        def summed() -> None:
            gram[chosen] += idf[chosen][:, None] * pairs.times(start[chosen])

        for part in parts:
            word, block, starts = blocks(part, vocabulary)
            other = np.zeros(starts[-1], bool)
            other[block[places[word] < 0]] = True
            rare = other[block]
            pairs.add(places[word[~rare]], block[~rare])
            if pairs.words > _COUNTED:
                summed()
            word, block = word[rare], block[rare]
            if len(word):
                sums = _block_sums(block, start[word], starts[-1])
                order = np.argsort(word, kind="stable")
                edges = np.flatnonzero(np.r_[True, np.diff(word[order]) != 0])
                rows = np.add.reduceat(sums[block[order]], edges, axis=0)
                own = word[order][edges]
                gram[own] += idf[own][:, None] * rows
        if pairs.words:
            summed()

    return np.linalg.qr(_partial(docs, sketch, size * rank).reshape(size, rank))[0]


def common_subsequence(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence, a bit vector of ``a`` per word of ``b``."""
    places: dict[bytes, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        hit = row & places.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


class _Overlap:
    """Which passages can hold enough of an item's telling words, in the passage widened by the item's length."""

    def __init__(self, telling: list[list[int]], lengths: list[int], needed: np.ndarray, size: int):
        own = [np.unique(np.array(t, np.int64)) for t in telling]
        word = np.concatenate([*own, np.empty(0, np.int64)])
        order = np.argsort(word, kind="stable")
        self._items = np.repeat(np.arange(len(own)), np.array([len(o) for o in own], np.int64))[order]
        self._ends = np.r_[0, np.cumsum(np.bincount(word, minlength=size))]
        self._reach, self._needed = -(-np.array(lengths, np.int64) // STRIDE), needed

    def __call__(self, word: np.ndarray, block: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(passage, item), ascending: every passage of the ``n`` blocks whose surroundings hold so many words of the item."""
        many = self._ends[word + 1] - self._ends[word]
        ends = np.cumsum(many)
        at = np.arange(many.sum()) + np.repeat(self._ends[word] - ends + many, many)
        # Item by item, the blocks with a word of it; windows begin at one of these.
        places, c = np.unique(self._items[at] * (n + 1) + np.repeat(block, many), return_counts=True)
        item, sums = places // (n + 1), np.r_[0, np.cumsum(c)]
        last = np.minimum(places % (n + 1) + 2 * self._reach[item] + 2, n + 1)
        enough = np.flatnonzero(sums[places.searchsorted(item * (n + 1) + last)] - sums[:-1] >= self._needed[item])
        item, first = item[enough], places[enough] % (n + 1) - 1 - self._reach[item[enough]]
        wide = 2 * self._reach[item] + 2
        ends = np.cumsum(wide)
        passage = np.arange(wide.sum()) + np.repeat(first - ends + wide, wide)
        inside = (passage >= 0) & (passage < n)
        found = np.unique(passage[inside] * len(self._reach) + np.repeat(item, wide)[inside])
        return found // max(1, len(self._reach)), found % max(1, len(self._reach))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    cosine: float = 0.4,
    share: float = 0.75,
    paraphrase: float = 0.55,
) -> DataFrame:
    """(doc_id, item_id, subsequence, answer, cosine): items that a document repeats or paraphrases.

    Passages are pairs of neighbouring blocks of 32 words. Words in more than 5 % of all passages do not count as
    informative. Passages with less than ``paraphrase`` of an item's number of informative words, or with less of these words themselves in the
    passage widened by the item's length, cannot pass the check and are no candidates. A candidate passes if its longest common subsequence with the item, in the passage
    widened by the item's length, has ``paraphrase`` of the informative words and either ``share`` of all words or
    ``paraphrase`` of them and 0.8 of the answer, the item's last sentence. Items with fewer than four
    informative words have no direction; only all their words in a row count.

    Null or empty texts and null ids contain nothing; repeated rows give their rows once; an empty
    benchmark or an empty table gives no rows. The benchmark is a query set: it is collected, and the size of its
    vocabulary is checked. Other columns are not read.
    """
    docs = id_and_text(docs, key, text)
    rows = benchmark.selectExpr("CAST(item_id AS BIGINT) AS item_id", "CAST(text AS STRING) AS text").where("item_id IS NOT NULL AND text IS NOT NULL").distinct().collect()
    items = Items([(r["item_id"], r["text"]) for r in sorted(rows)])
    keep = [i for i, w in enumerate(items.words) if w]
    schema = "doc_id long, item_id long, subsequence double, answer double, cosine double"
    if not keep:
        return docs.sparkSession.createDataFrame([], schema)
    weights = informative_words(docs, items)
    vocabulary, idf = {w: i for i, w in enumerate(weights)}, np.array(list(weights.values()))
    telling = {i: [w for w in items.words[i] if w in vocabulary] for i in keep}
    plain = [i for i in keep if len(telling[i]) < LEAST_INFORMATIVE]
    keep = [i for i in keep if len(telling[i]) >= LEAST_INFORMATIVE]
    basis = latent_basis(docs, weights) if keep else np.zeros((len(weights), 1))
    bags = np.zeros((len(keep), len(weights)))
    for n, i in enumerate(keep):
        np.add.at(bags[n], [vocabulary[w] for w in telling[i]], 1)
    latent = ((bags * idf) @ basis).astype(np.float32)
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    needed = paraphrase * np.array([len(telling[i]) for i in keep] or [np.inf])
    projected = (basis * idf[:, None]).astype(np.float32)
    words, answers, ids = items.words, items.answers, items.ids
    overlap = _Overlap([[vocabulary[w] for w in telling[i]] for i in keep], [len(words[i]) for i in keep], needed, len(weights))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs_, found in rows_of(batches, "doc_id", "text"):
            best: dict[tuple[int, int], tuple] = {}
            for first, part in _chunks(found):
                word, block, starts = blocks(part, vocabulary)
                hits = np.bincount(block, minlength=starts[-1] + 1)
                where, which = overlap(word, block, starts[-1])
                fits = hits[where] + hits[where + 1] >= needed[which]
                where, which = where[fits], which[fits]
                used = np.zeros(starts[-1] + 1, bool)
                used[where] = used[where + 1] = True
                own = used[block]
                sums = _block_sums(block[own], projected[word[own]], starts[-1] + 1)
                vectors = sums[where] + sums[where + 1]
                close = np.einsum("ij,ij->i", vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9), latent[which])
                near = np.flatnonzero(close >= cosine)
                where, which, close = where[near], which[near], close[near]
                last, all_words = -1, []
                for p, q, near_by in zip(where.tolist(), which.tolist(), close.tolist()):
                    n = int(np.searchsorted(starts, p, "right")) - 1
                    if docs_[first + n] is None:
                        continue
                    if n != last:
                        last, all_words = n, tokens(part[n])
                    i, at = keep[q], (p - int(starts[n])) * STRIDE
                    around = all_words[max(0, at - len(words[i])) : at + 2 * STRIDE + len(words[i])]
                    if common_subsequence(telling[i], [w for w in around if w in vocabulary]) < needed[q]:
                        continue
                    got = common_subsequence(words[i], around) / len(words[i])
                    answer = common_subsequence(answers[i], around) / len(answers[i])
                    if got >= share or got >= paraphrase and answer >= 0.8:
                        at = (docs_[first + n], i)
                        best[at] = max(best.get(at, (0.0,)), (got, answer, near_by))
                if plain:
                    for n, text_ in enumerate(part):
                        spaced = b" " + b" ".join(tokens(text_)) + b" "
                        for i in plain:
                            if docs_[first + n] is not None and b" " + b" ".join(words[i]) + b" " in spaced:
                                best[docs_[first + n], i] = (1.0, 1.0, 1.0)
            rows_ = [(doc, ids[i], *values) for (doc, i), values in best.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows_], pa.int64() if k < 2 else pa.float64()) for k in range(5)],
                ["doc_id", "item_id", "subsequence", "answer", "cosine"],
            )

    found = docs.mapInArrow(search, schema)
    return materialize(found.groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in ("subsequence", "answer", "cosine")]), "leaks")
