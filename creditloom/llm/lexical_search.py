"""Ranked lexical search by pipelined term partitioning.

Documents are reduced once to the query terms they hold. The terms are dealt to owners, rare and heavy ones
first, and each owner's postings are dealt to shards of documents, so that neither a frequent term nor a large
table ends up in one task. A bundle, one per item and shard, goes through the owners in turn: a cogroup brings
it together with the owner's postings of its shard, whose integer contributions are added to the sparse
accumulators the bundle carries. After each owner the bundle sheds what can no longer be among its
``k`` best: the ``k``-th best sum so far is a floor, and what the owners to come can add at most is known from the
largest contribution of each term. The last owner selects the best of the shard, a window those of all shards.
Nothing is lost by shedding, ties included.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .common import texts

#: Query terms that one pass over the documents looks for; more items are taken in blocks.
MAX_TERMS = 200_000
OWNERS = 4
#: Postings, and pairs of item and document, of one shard.
SHARD_POSTINGS, SHARD_CELLS = 500_000, 8_000_000
_BATCH_POSTINGS = 500_000

# Letters, digits and everything beyond ASCII make terms; A-Z is lower-cased.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return text.translate(_FOLD).split() if text else []


def _items(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item, item_id, term, q) for each distinct term of each row of ``items``; item numbers the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, value in enumerate(texts(batch.column("text"))):
                found = Counter(terms_of(value))
                if found:
                    rows = [0] * len(found)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("item").slice(at, 1).take(pa.array(rows)),
                            batch.column("item_id").slice(at, 1).take(pa.array(rows)),
                            pa.array(list(found), pa.binary()).cast(pa.string()),
                            pa.array(list(found.values()), pa.int64()),
                        ],
                        ["item", "item_id", "term", "q"],
                    )

    rows = items.select(
        F.monotonically_increasing_id().alias("item"),
        F.col(f"`{key}`").cast("long").alias("item_id"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    return rows.mapInArrow(run, "item long, item_id long, term string, q long")


def _forward(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(key, doc_id, n, terms, tfs): length and query terms of each document that has a term; key numbers the rows."""
    numbers = docs.sparkSession.sparkContext.broadcast({term.encode(): i for i, term in enumerate(vocabulary)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look_up = numbers.value.get
        for batch in batches:
            rows, sizes, own, terms, tfs = [], [], [], [], []

            def packed() -> pa.RecordBatch:
                ends = pa.array(np.r_[0, np.cumsum(own)].astype(np.int32))
                kept = pa.array(rows)
                return pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").take(kept),
                        batch.column("doc_id").take(kept),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                        pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64())),
                    ],
                    ["key", "doc_id", "n", "terms", "tfs"],
                )

            for at, text in enumerate(texts(batch.column("text"))):
                words = terms_of(text)
                if not words:
                    continue
                found = Counter(map(look_up, words))
                found.pop(None, None)
                rows.append(at)
                sizes.append(len(words))
                own.append(len(found))
                terms.extend(found)
                tfs.extend(found.values())
                if len(terms) > _BATCH_POSTINGS:
                    yield packed()
                    rows, sizes, own, terms, tfs = [], [], [], [], []
            if rows:
                yield packed()

    schema = "key long, doc_id long, n long, terms array<int>, tfs array<long>"
    return docs.withColumn("key", F.monotonically_increasing_id()).mapInArrow(run, schema)


@dataclass(frozen=True)
class _Terms:
    """Of each query term: its weight, its owner, and the most that one occurrence in an item can add."""

    weight: np.ndarray
    owner: np.ndarray
    most: np.ndarray

    @classmethod
    def of(cls, stats: list, size: int, owners: int) -> _Terms:
        """From rows (term, w, df, top). Owners get an eighth, an eighth, a quarter, a half of the postings."""
        weight, df, top = (np.zeros(size, np.int64) for _ in range(3))
        for r in stats:
            weight[r["term"]], df[r["term"]], top[r["term"]] = r["w"], r["df"], r["top"]
        order = np.argsort(-weight, kind="stable")
        bounds = np.array([0.5 ** (owners - 1 - i) for i in range(owners - 1)]) * df.sum()
        owner = np.zeros(size, np.int32)
        owner[order] = np.searchsorted(bounds, np.cumsum(df[order]) - df[order], "right")
        return cls(weight, owner, weight * top)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best: highest score first, then the smallest id."""
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= floor)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))][:k]


_BUNDLE = "shard int, item long, closed boolean, keys array<long>, ids array<long>, scores array<long>"


def _values(column: pa.ChunkedArray, at: int) -> np.ndarray:
    value = column[at].values
    return np.empty(0, np.int64) if value is None else value.to_numpy(zero_copy_only=False)


def _stage(bundles: DataFrame, postings: DataFrame, asked, terms, owner: int, last: int, k: int) -> DataFrame:
    """Send the bundles past one owner.

    ``asked`` and ``terms`` are broadcasts, of each (item, terms, counts) and of the terms' :class:`_Terms`.
    """

    def run(held: pa.Table, stock: pa.Table) -> pa.Table:
        table, held = terms.value, held.combine_chunks()
        term, key, doc = (stock[c].to_numpy() for c in ("term", "key", "doc_id"))
        share = stock["share"].to_numpy()
        shard = (held if held.num_rows else stock)["shard"][0].as_py()
        mine = {held["item"][i].as_py(): i for i in range(held.num_rows)}
        carried = {item: tuple(_values(held[c], i) for c in ("keys", "ids", "scores")) for item, i in mine.items()}
        order = np.lexsort((key, term))
        term, key, doc, share = term[order], key[order], doc[order], share[order]
        # Documents of the shard that the owner or a bundle names, by place.
        every, first = np.unique(np.concatenate([key, *[c[0] for c in carried.values()]]), return_index=True)
        names = np.concatenate([doc, *[c[1] for c in carried.values()]])[first]
        place = np.searchsorted(every, key)
        starts = {int(t): (int(a), int(b)) for t, a, b in zip(*_runs(term))}
        out = {name: [] for name in ("item", "closed", "keys", "ids", "scores")}
        for item, wanted, times in asked.value:
            keys, ids, scores = carried.get(item, (every[:0], every[:0], every[:0]))
            closed = held["closed"][mine[item]].as_py() if item in mine else False
            if closed and not len(keys):
                continue
            here = table.owner[wanted] == owner
            at = np.searchsorted(every, keys)
            if closed:
                total = scores.copy()
            else:
                total = np.zeros(len(every), np.int64)
                total[at] = scores
            for t, q in zip(wanted[here].tolist(), times[here].tolist()):
                if t not in starts:
                    continue
                a, b = starts[t]
                gain = share[a:b] * (int(table.weight[t]) * q)
                if closed:
                    near = np.minimum(np.searchsorted(place[a:b], at), b - a - 1)
                    total += np.where(place[a:b][near] == at, gain[near], 0)
                else:
                    total[place[a:b]] += gain
            if closed:
                own = at
            else:
                own = np.flatnonzero(total)
                total = total[own]
            if owner == last:
                kept = _best(total, names[own], k)
                kept = kept[total[kept] > 0]
            else:
                rest = int((table.most[wanted] * times)[table.owner[wanted] > owner].sum())
                floor = int(np.partition(total, len(total) - k)[len(total) - k]) if len(total) >= k else 0
                closed = closed or rest < floor
                kept = np.flatnonzero(total + rest >= floor)
            if len(kept) or closed:
                for name, value in (("item", item), ("closed", closed), ("keys", every[own[kept]]), ("ids", names[own[kept]]), ("scores", total[kept])):
                    out[name].append(value)
        lists = {}
        for name in ("keys", "ids", "scores"):
            ends = np.r_[0, np.cumsum([len(v) for v in out[name]])].astype(np.int32)
            lists[name] = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *out[name]])))
        n = len(out["item"])
        return pa.table({"shard": pa.array([shard] * n, pa.int32()), "item": pa.array(out["item"], pa.int64()), "closed": pa.array(out["closed"], pa.bool_()), **lists})

    return bundles.groupBy("shard").cogroup(postings.groupBy("shard")).applyInArrow(run, _BUNDLE)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each distinct value of a sorted array, where it starts and where it ends."""
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.empty(0, np.int64)
    return values[starts], starts, np.r_[starts[1:], len(values)][: len(starts)]


def _searched(docs: DataFrame, asked: DataFrame, k: int, owners: int, cells: int) -> DataFrame:
    """(item, doc_id, score): the ``k`` best documents of each shard for each item of one block."""
    spark = docs.sparkSession
    rows = asked.select("item", "term", "q").collect()
    vocabulary = sorted({r["term"] for r in rows})
    number, items = {t: i for i, t in enumerate(vocabulary)}, sorted({r["item"] for r in rows})
    place = {item: i for i, item in enumerate(items)}
    lists: list[tuple[list[int], list[int]]] = [([], []) for _ in items]
    for r in rows:
        lists[place[r["item"]]][0].append(number[r["term"]])
        lists[place[r["item"]]][1].append(r["q"])
    asks = spark.sparkContext.broadcast([(i, np.array(t, np.int64), np.array(q, np.int64)) for i, (t, q) in zip(items, lists)])

    forward = materialize(_forward(docs, vocabulary), "forward")
    total = forward.agg(F.count("*").alias("docs"), F.sum("n").alias("words")).first()
    n, words = total["docs"], total["words"] or 1
    # The contract's integers: what a posting adds, before the weight of its term.
    m = f"(100L - 75L + (75L * n * {n}L) div {words}L)"
    flat = forward.selectExpr("key", "doc_id", f"{m} AS m", "inline(arrays_zip(terms, tfs))")
    flat = flat.selectExpr("key", "doc_id", "terms AS term", "(1000000000L * tfs) div (1000L * tfs + 8L * m) AS share")
    weight = f"CAST(floor(1000 * ln((2 * {n}D + 2) / (2 * df + 1))) AS BIGINT) AS w"
    stats = flat.groupBy("term").agg(F.count("*").alias("df"), F.max("share").alias("top")).selectExpr("*", weight)
    stats = stats.collect()  # a row per term of the block
    terms = spark.sparkContext.broadcast(_Terms.of(stats, len(vocabulary), owners))
    shards = max(1, -(-sum(r["df"] for r in stats) // SHARD_POSTINGS), -(-n * len(items) // cells))

    owned = spark.createDataFrame(list(enumerate(terms.value.owner.tolist())), "term int, owner int")
    flat = flat.where("doc_id IS NOT NULL").join(F.broadcast(owned), "term")  # at most the terms of a block
    flat = flat.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
    bundles = spark.createDataFrame([], _BUNDLE)
    for owner in range(owners):
        bundles = _stage(bundles, flat.where(F.col("owner") == owner), asks, terms, owner, owners - 1, k)
    found = bundles.select("item", F.explode(F.arrays_zip("ids", "scores")).alias("d"))
    return found.select("item", F.col("d.ids").alias("doc_id"), F.col("d.scores").alias("score"))


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    doc_key: str = "doc_id",
    doc_text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    owners: int = OWNERS,
    max_terms: int = MAX_TERMS,
    cells: int = SHARD_CELLS,
) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank (from 1), doc_id, score.

    All documents are ranked, whole texts, by the sum over the item's terms, repeats included. Only scores above 0
    are ranked; equal scores go by ascending doc_id. A null or empty text has no terms: as an item it has no
    rows, as a document it counts nowhere. A document with a null id counts in the statistics but cannot be
    named, so it is not ranked. Rows that repeat an id are documents, or items, of their own. Empty tables give no
    rows. Other columns are not read. A text of any length is one task's, with the number of each of its terms.
    """
    docs = docs.select(F.col(f"`{doc_key}`").cast("long").alias("doc_id"), F.col(f"`{doc_text}`").cast("string").alias("text"))
    asked = materialize(_items(items, item_key, item_text), "asked")
    blocks = max(1, -(-asked.count() // max_terms))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    found = None
    for b in range(blocks):
        part = _searched(docs, asked.where(block == b), k, owners, cells)
        found = part if found is None else found.unionByName(part)
    best = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    names = asked.groupBy("item").agg(F.first("item_id").alias("item_id"))
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")
