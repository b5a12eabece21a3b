"""Line dedup by a sharded minimal perfect hash: lines of many documents go, the other lines stay.

One pass counts in how many documents each line's key stands, by a 128-bit hash, added up in the tasks before
anything is shuffled. The keys found in at least ``min_docs`` documents are put into a minimal perfect hash
(:mod:`perfect_hash`): one half of the hash finds the slot, the other half is the slot's fingerprint, next to it
the count. A second pass probes these arrays for every line, so no line is joined and no text is shuffled.
A key of fewer documents has no slot of its own; it is taken for another only if it hits a slot with its own 64 bits.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import perfect_hash
from .common import id_and_text, texts

_CHUNK_BYTES = 8_000_000
_COUNTED = 300_000  # distinct keys that a task holds before it hands them on


def _chunks(values: list[bytes | None]) -> Iterator[list[bytes]]:
    """Texts in turn, null as empty, a few megabytes at a time."""
    chunk, size = [], 0
    for value in values:
        chunk.append(value or b"")
        size += len(chunk[-1])
        if size > _CHUNK_BYTES:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def _key(line: bytes) -> bytes:
    # Both act on ASCII alone: white space is \x20 and \x09-\x0D, upper case is A-Z.
    return line.strip().lower()


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars)


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
    return np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])


def counted_lines(docs: DataFrame, min_docs: int, min_chars: int = 1) -> DataFrame:
    """(key, mark, n): the halves of the hash of each key found in at least ``min_docs`` rows, and in how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            key, mark = _halves(list(found))
            counts = np.fromiter(found.values(), np.int64, len(found))
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(mark.view(np.int64)), pa.array(counts)], ["key", "mark", "n"])

        for batch in batches:
            for text in texts(batch.column("text")):
                keys = {_key(line) for line in (text or b"").split(b"\n")}
                found.update([xxhash.xxh3_128_digest(k) for k in keys if _long_enough(k, min_chars)])
                if len(found) > _COUNTED:
                    yield rows()
                    found.clear()
        if found:
            yield rows()

    partial = docs.select("text").mapInArrow(run, "key long, mark long, n long")
    return partial.groupBy("key", "mark").agg(F.sum("n").alias("n")).where(F.col("n") >= max(min_docs, 1))


def deduped(docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """One row per input row: doc_id, text without the lines of many documents, n_lines, n_dropped.

    A line's key is the line without white space at its ends and with A-Z lower-cased. A key of ``min_chars`` code
    points or more that stands in ``min_docs`` rows or more loses its lines everywhere, the first document
    included; the others stay as they are, joined by \\n. A null or empty text is one empty line, whose key
    is too short to go; a text without any line left is empty. A row is a document: rows that repeat an id count each
    for itself, and a null id keeps its row. Order and ties play no part. An empty table gives no rows. Other
    columns are not read. A text is held whole by one task, with the hash of each of its lines, however long it is.
    """
    if min_chars < 1:
        raise ValueError("a line without any character cannot be told from no line")
    docs = id_and_text(docs, key, text)
    frequent = materialize(counted_lines(docs, min_docs, min_chars), "frequent-lines")
    index = perfect_hash.build(frequent, frequent.count(), "<u8", "line-index")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = index.reader()
        for batch in batches:
            at = 0
            for chunk in _chunks(texts(batch.column("text"))):
                split = [value.split(b"\n") for value in chunk]
                keys = [k if _long_enough(k := _key(line), min_chars) else b"" for lines in split for line in lines]
                tested = np.fromiter(map(bool, keys), bool, len(keys))
                gone = np.zeros(len(keys), bool)
                if tested.any():
                    gone[tested] = probe.counts(*_halves([xxhash.xxh3_128_digest(k) for k in keys if k])) > 0
                ends = np.cumsum([len(lines) for lines in split])
                starts = ends - [len(lines) for lines in split]
                dropped = np.add.reduceat(gone.astype(np.int64), starts)
                kept = [
                    value if not n else b"\n".join([line for line, out in zip(lines, gone[start:end]) if not out])
                    for value, lines, n, start, end in zip(chunk, split, dropped.tolist(), starts.tolist(), ends.tolist())
                ]
                ids = batch.column("doc_id").slice(at, len(chunk))
                at += len(chunk)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(kept, pa.binary()).cast(pa.string()), pa.array(ends - starts), pa.array(dropped)],
                    ["doc_id", "text", "n_lines", "n_dropped"],
                )

    return docs.mapInArrow(run, "doc_id long, text string, n_lines long, n_dropped long")
