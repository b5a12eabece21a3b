"""Near-duplicate documents by an LSH forest over MinHash signatures.

Every distinct shingle set gets one signature. The signatures are sorted in several orders, each
beginning with other hash functions. In an order, the candidates of a set are the neighbours that
share the longest prefixes with it: in a thin region a short common prefix (``depth``) is enough,
in a dense one the neighbours are those with deep common prefixes. Regions that stay dense down to
``full_depth`` functions are searched in full for what is not connected yet, so the width of
the neighbourhood limits no result. Candidates are confirmed on the full shingle sets.

All sets are put in order once, for the closest neighbours. Only sets with more than one neighbour of
a common prefix, and those at the ends of a task's range, are looked at again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import WordHashes, components, hashed, id_and_text, release, rows_of, shingles, words_of

FUNCTIONS = 64
ORDERS = 20
KEY_FUNCTIONS = 10
_RNG = np.random.default_rng(20)
# Odd factors: each function is a permutation of the 32-bit numbers.
_A = _RNG.integers(0, 2**32, FUNCTIONS, dtype=np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 2**32, FUNCTIONS, dtype=np.uint32)
_SPREAD = [_RNG.permutation(FUNCTIONS) for _ in range(-(-ORDERS * 4 // FUNCTIONS))]
#: For each order the hash functions it sorts by: leading ones differ from order to order.
ORDER = [np.roll(_SPREAD[4 * t // FUNCTIONS], -4 * t)[:KEY_FUNCTIONS] for t in range(ORDERS)]


def signature(shingle_set: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over the set."""
    out = np.full(FUNCTIONS, 2**32 - 1, np.uint32)
    short = (shingle_set >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 1024):
        np.minimum(out, (short[None, at : at + 1024] * _A[:, None] + _B[:, None]).min(axis=1), out=out)
    return out.astype(">u4")


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, node, signature); node names the shingle set, null for an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for ids, found in rows_of(batches, "doc_id", "text"):
            sizes, nodes, signatures = [], [], []
            for text in found:
                own = np.unique(shingles(hashed(words_of(text), cache), width))
                sizes.append(len(own))
                nodes.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                signatures.append(signature(own).tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(signatures, pa.binary())],
                ["doc_id", "n_shingles", "node", "signature"],
            )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, node binary, signature binary")


def orders(sets: DataFrame, n_orders: int) -> DataFrame:
    """(order, key, node) for every set in every order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes, signatures in rows_of(batches, "node", "signature"):
            if not nodes:
                continue
            table = np.frombuffer(b"".join(signatures), ">u4").reshape(len(nodes), FUNCTIONS)
            for t in range(n_orders):
                flat = np.ascontiguousarray(table[:, ORDER[t]]).tobytes()
                keys = [flat[i : i + 4 * KEY_FUNCTIONS] for i in range(0, len(flat), 4 * KEY_FUNCTIONS)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t] * len(nodes), pa.int32()), pa.array(keys, pa.binary()), pa.array(nodes, pa.binary())],
                    ["order", "key", "node"],
                )

    return sets.mapInArrow(run, "order int, key binary, node binary")


def _in_order(rows: DataFrame) -> DataFrame:
    return rows.repartitionByRange("order", "key", "node").sortWithinPartitions("order", "key", "node")


def _same_lead(order: list[int], key: list[bytes], depth: int, step: int) -> np.ndarray:
    """Whether each row and that ``step`` places on are of one order and share ``depth`` leading functions."""
    lead = np.frombuffer(b"".join(k[: 4 * depth] for k in key), f"V{4 * depth}")
    orders_ = np.array(order, np.int32)
    return (lead[:-step] == lead[step:]) & (orders_[:-step] == orders_[step:])


def closest(sorted_rows: DataFrame, depth: int) -> DataFrame:
    """Rows of two kinds: pairs (a, b) of sets next to one another, and (order, key, node) of sets that may have other neighbours.

    These are the sets of a common prefix of ``depth`` functions that three or more share, and the first and last two sets
    of a task's range, whose neighbours may stand in another.
    """
    kinds = [("a", pa.binary()), ("b", pa.binary()), ("order", pa.int32()), ("key", pa.binary()), ("node", pa.binary())]

    def rows(*columns: list) -> pa.RecordBatch:
        n = max(map(len, columns))
        return pa.RecordBatch.from_arrays([pa.array(c or [None] * n, kind) for c, (_, kind) in zip(columns, kinds)], [name for name, _ in kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple[list, list, list] = ([], [], [])
        told, begun = np.zeros(0, bool), 0
        for part in rows_of(batches, "order", "key", "node"):
            if not part[0]:
                continue
            old = len(kept[0])
            order, key, node = (x + y for x, y in zip(kept, part))
            same = _same_lead(order, key, depth, 1)
            near = np.flatnonzero(same)
            near = near[near + 1 >= old].tolist()
            ends = [(node[i], node[i + 1]) for i in near]
            yield rows([min(e) for e in ends], [max(e) for e in ends], [], [], [])
            open_ = np.zeros(len(order), bool)
            for i in np.flatnonzero(same[:-1] & same[1:]).tolist():
                open_[i : i + 3] = True
            open_[old : old + max(0, 2 - begun)] = True
            begun += len(part[0])
            told = np.concatenate((told, np.zeros(len(part[0]), bool)))
            new = np.flatnonzero(open_ & ~told).tolist()
            yield rows([], [], *([column[i] for i in new] for column in (order, key, node)))
            kept, told = tuple(x[-2:] for x in (order, key, node)), (told | open_)[-2:]
        last = np.flatnonzero(~told).tolist()
        yield rows([], [], *([column[i] for i in last] for column in kept))

    return sorted_rows.mapInArrow(run, "a binary, b binary, order int, key binary, node binary")


def neighbours(sorted_rows: DataFrame, reach: int, depth: int) -> DataFrame:
    """Pairs (a, b) of sets at most ``reach`` places apart that share ``depth`` leading functions.

    Sets already known to be connected (same root) are no candidates, nor are two that are searched in full (``wide``), nor sets
    whose sizes are too far apart (``least``: the smallest size that a set of this size can be linked with). Runs over each
    range of the sorted orders as a stream; only ``reach`` rows are carried on.
    """
    names = ["order", "key", "node", "root", "wide", "n", "least"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple[list, ...] = tuple([] for _ in names)
        for part in rows_of(batches, *names):
            old = len(kept[0])
            order, key, node, root, wide, n, least = rows = tuple(x + y for x, y in zip(kept, part))
            a, b = [], []
            for step in range(1, min(reach, len(order) - 1) + 1):
                near = np.flatnonzero(_same_lead(order, key, depth, step))
                for i in near[near + step >= old].tolist():
                    k = i + step
                    if root[i] != root[k] and not (wide[i] and wide[k]) and n[i] >= least[k] and n[k] >= least[i]:
                        a.append(min(node[i], node[k]))
                        b.append(max(node[i], node[k]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])
            kept = tuple(x[-reach:] for x in rows)

    return sorted_rows.mapInArrow(run, "a binary, b binary").distinct()


def confirmed(pairs: DataFrame, involved: DataFrame, width: int, share: tuple[int, int]) -> DataFrame:
    """Those pairs whose full shingle sets satisfy ``den * intersection >= num * union``."""
    num, den = share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def full(text: bytes) -> set:
            w = words_of(text)
            return set(zip(*(w[k:] for k in range(width)))) if len(w) >= width else {tuple(w)}

        for a, b, first, second in rows_of(batches, "a", "b", "text_a", "text_b"):
            ok = []
            for x, y in zip(first, second):
                x, y = full(x), full(y)
                both = len(x & y)
                ok.append(den * both >= num * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(
                [pa.array([v for v, k in zip(c, ok) if k], pa.binary()) for c in (a, b)], ["a", "b"]
            )

    found = pairs.join(involved.selectExpr("node AS a", "text AS text_a"), "a")
    found = found.join(involved.selectExpr("node AS b", "text AS text_b"), "b")
    return found.select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 5,
    share: tuple[int, int] = (80, 100),
    n_orders: int = ORDERS,
    depth: int = 4,
    full_depth: int = 8,
    reach: int = 16,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Documents are linked if their sets of distinct ``width``-word shingles satisfy
    ``share[1] * |A and B| >= share[0] * |A or B|``; the component is named by its smallest id.
    Two sets at the least linked similarity s meet in one order with probability s**depth, so all
    ``n_orders`` miss them with (1 - s**depth)**n_orders: 4e-7 at 0.85, 3e-5 at 0.8.

    Null text, or text without words: size 0, a component of its own. A null id: no links; component null,
    kept. Repeated rows and repeated ids give a row each. Equal texts share one set, so a
    group of copies costs one signature. Other columns are not read.
    """
    docs = id_and_text(docs, key, text)
    num, den = share
    sets = materialize(shingle_sets(docs, width), "shingle-sets")
    # One row per set. An id that stands for two texts stands for two sets.
    reps = sets.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    signed = sets.where("node IS NOT NULL").select("node", "doc_id", "n_shingles", "signature")
    reps = materialize(signed.join(reps, ["node", "doc_id"]).dropDuplicates(["node"]), "signatures")
    spark = docs.sparkSession
    release(spark)

    # First the closest neighbours, which connect most of a group of copies; then wider ones among
    # what is still apart; last the widest, and in full the regions that are wider still.
    first = materialize(closest(_in_order(orders(reps.select("node", "signature"), n_orders)), depth), "closest")
    release(spark)
    forest = first.where("node IS NOT NULL").select("order", "key", "node")
    forest = materialize(forest.join(reps.selectExpr("node", "n_shingles AS n", f"-((-n_shingles * {num}) div {den}) AS least"), "node"), "forest")
    tried = materialize(first.where("a IS NOT NULL").select("a", "b").distinct(), "pairs")
    links = materialize(confirmed(tried, _texts(tried, reps, docs, width), width, share), "links")
    release(spark)
    roots = components(links, "roots")
    for distance in (max(1, reach // 4), reach):
        known = forest.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        if distance < reach:
            pairs = neighbours(_in_order(known.withColumn("wide", F.lit(False))), distance, depth)
        else:
            dense = _wide(known, full_depth, reach)
            known = known.join(dense.select("node", F.lit(True).alias("wide")), "node", "left").withColumn("wide", F.coalesce("wide", F.lit(False)))
            pairs = neighbours(_in_order(known), distance, depth).unionByName(_dense(dense, reps, docs, width, share))
        pairs = materialize(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        links = materialize(confirmed(pairs, _texts(pairs, reps, docs, width), width, share), "links")
        release(spark)
        tried = tried.unionByName(pairs)
        if links.limit(1).count():
            roots = components(roots.selectExpr("node AS a", "root AS b").unionByName(links), "roots")
    named = roots.join(reps.select("node", "doc_id"), "node")
    named = named.groupBy("root").agg(F.min("doc_id").alias("component_id")).join(roots, "root").select("node", "component_id")
    return (
        sets.select("doc_id", "n_shingles", "node")
        .join(reps.selectExpr("node", "doc_id AS rep"), "node", "left")
        .join(named, "node", "left")
        .selectExpr(
            "doc_id",
            "n_shingles",
            "CASE WHEN doc_id IS NOT NULL THEN coalesce(component_id, rep, doc_id) END AS component_id",
        )
        .selectExpr("*", "doc_id <=> component_id AS kept")
    )


def _wide(known: DataFrame, full_depth: int, reach: int) -> DataFrame:
    """(node, root) of the sets of regions with more than ``reach`` others that share ``full_depth`` functions, and with several roots."""
    keyed = known.selectExpr("order", f"xxhash64(substring(key, 1, {4 * full_depth})) AS lead", "node", "root")
    wide = keyed.groupBy("order", "lead").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    wide = wide.where(f"n > {reach + 1} AND low <> high").select("order", "lead")
    return materialize(keyed.join(wide, ["order", "lead"]).select("node", "root").distinct(), "dense")


def _dense(nodes: DataFrame, reps: DataFrame, docs: DataFrame, width: int, share: tuple[int, int]) -> DataFrame:
    """All pairs of ``nodes`` with several roots that can be similar enough by their rarest common shingle.

    The sets are joined on their rarest shingles: of two sets that are similar enough, each has a common
    shingle among its n - ceil(s * n) + 1 rarest (any fixed order of all shingles will do; by rarity the lists
    are shortest). At their first common shingle no more than it and what stands after it in either set can be common: pairs for which
    that is too little are none. So no link is lost, and the copies of one text, which differ by rare
    shingles, do not meet all with all.
    """
    num, den = share
    found = _texts(nodes.selectExpr("node AS a", "node AS b"), reps, docs, width).join(nodes, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for own, roots, texts_ in rows_of(batches, "node", "root", "text"):
            sets = [np.unique(shingles(hashed(words_of(t), cache), width)).view(np.int64) for t in texts_]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.binary()), pa.array(roots, pa.binary()), pa.array(sets, pa.list_(pa.int64()))],
                ["node", "root", "shingles"],
            )

    sets = materialize(found.mapInArrow(run, "node binary, root binary, shingles array<long>"), "dense-sets")
    rows = sets.selectExpr("node", "root", "bigint(size(shingles)) AS n", "explode(shingles) AS shingle")
    common = rows.groupBy("shingle").count().where("count > 1")
    ranked = rows.join(common, "shingle", "left").selectExpr(
        "*", "row_number() OVER (PARTITION BY node ORDER BY coalesce(count, 1), shingle) AS place"
    )
    # What can be common from a shingle on: it and all after it.
    prefix = ranked.where(f"count > 1 AND {den} * (n - place + 1) >= {num} * n").selectExpr("node", "root", "n", "n - place + 1 AS rest", "shingle")
    other = prefix.selectExpr("node AS b", "root AS rb", "n AS nb", "rest AS restb", "shingle")
    near = prefix.join(other, "shingle").where(f"node < b AND root <> rb AND {num + den} * least(rest, restb) >= {num} * (n + nb)")
    return near.selectExpr("node AS a", "b").distinct()


def _texts(pairs: DataFrame, reps: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(node, text) of the sets that stand in a pair."""
    nodes = pairs.selectExpr("a AS node").unionByName(pairs.selectExpr("b AS node")).distinct()
    wanted = reps.select("node", "doc_id").join(nodes, "node")
    found = docs.join(wanted, "doc_id").where("text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for nodes_, found_ in rows_of(batches, "node", "text"):
            same = [
                xxhash.xxh3_128_digest(np.unique(shingles(hashed(words_of(t), cache), width)).tobytes()) == n
                for n, t in zip(nodes_, found_)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([n for n, k in zip(nodes_, same) if k], pa.binary()),
                    pa.array([t for t, k in zip(found_, same) if k], pa.binary()).cast(pa.string()),
                ],
                ["node", "text"],
            )

    # An id may stand for several texts: only those with the set in question, and one of them.
    own = found.select("node", "text").mapInArrow(run, "node binary, text string")
    return materialize(own.groupBy("node").agg(F.min("text").alias("text")), "texts")
