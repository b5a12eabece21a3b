"""What several text operators share: words, shingles, row identity, connected components."""

from __future__ import annotations

import gc
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

#: ASCII white space, the only separators between words.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_REMEMBERED = 1_000_000
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 * 2**20


class WordHashes(dict):
    """Word -> 64-bit hash, remembering up to a million words and then starting anew."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased; bytes split at ASCII white space alone."""
    return text.lower().split() if text else []


def texts(column: pa.Array) -> list[bytes | None]:
    """The values of a string column as UTF-8 bytes, without decoding them."""
    return column.cast(pa.large_binary()).to_pylist()


def hashed(words: Sequence[bytes], cache: WordHashes) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a bijection)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` words, in order; a shorter text is one run as it is."""
    n = len(hashes)
    if n == 0:
        return hashes
    out = mixed(hashes[: max(1, n - width + 1)] + np.uint64(min(n, width)))
    for k in range(1, min(n, width)):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(out)])
    return out


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Lists of the named columns, text columns as bytes, one tuple per batch."""
    for batch in batches:
        found = []
        for name in names:
            column = batch.column(batch.schema.get_field_index(name))
            text = pa.types.is_string(column.type) or pa.types.is_large_string(column.type)
            found.append(texts(column) if text else column.to_pylist())
        yield tuple(found)


def bounded_batches(spark: SparkSession) -> None:
    """Bound the batches that go to Python tasks by bytes, unless the session does: texts may be of any length."""
    if spark.conf.get(_BATCH_BYTES, None) in (None, "-1", str(2**31 - 1), str(2**63 - 1)):
        spark.conf.set(_BATCH_BYTES, str(BATCH_BYTES))


def slices(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Pieces of ``batch`` whose rows' sizes sum up to ``most`` at most, or of one row."""
    ends, start = np.cumsum(sizes), 0
    while start < batch.num_rows:
        done = int(ends[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(start, end - start)
        start = end


def discard(spark: SparkSession, path: str) -> None:
    """Remove a written table that nothing reads any more from the shared folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished work now: Spark removes them once the driver has collected what refers to them."""
    spark.range(0, 1, 1, 1).collect()  # until the next query Spark holds on to the last one, its shuffle files included
    gc.collect()  # what Python still holds is not unused for the JVM
    spark._jvm.System.gc()


def id_and_text(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the id and the text, so that no other column can clash with what an operator adds."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (node, root), root the smallest node.

    Alternates two steps: every node's larger neighbours, then its smaller ones, are tied to its
    smallest neighbour. Each is a grouped minimum with map-side partial results and a join that
    adaptive execution can split, so a node with very many links stays cheap; the number of
    rounds grows with the logarithm of the longest chain. Each round is a written table.
    """
    edges = materialize(
        edges.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").where("a <> b").distinct(), label
    )
    while True:
        both = edges.unionByName(edges.selectExpr("b AS a", "a AS b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) AS m")
        large = both.join(least, "a").where("b > a AND b <> m").selectExpr("b AS a", "m AS b")
        large = materialize(large.distinct(), label)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").selectExpr("CASE WHEN b = m THEN a ELSE b END AS a", "m AS b")
        small = materialize(small.where("a <> b").distinct(), label)
        # Stars only: no root has a parent of its own and each node has one.
        state = small.groupBy("a").count()
        many = state.where("count > 1").limit(1).count()
        if not many and not small.join(small.selectExpr("a AS b"), "b", "left_semi").limit(1).count():
            roots = small.select("b").distinct().selectExpr("b AS node", "b AS root")
            return materialize(small.selectExpr("a AS node", "b AS root").unionByName(roots), label)
        edges = small
