"""URL rules by a Bloom filter cascade: exact membership of every url's keys, without a join.

A rule is a host with its subdomains and the beginning of a path; its key is both, joined. A url has one key for
each end of its host and each path length that a rule has. Level 1 of the cascade holds the listed keys, level 2
the keys of all urls that level 1 takes for listed though they are not, level 3 the listed keys that level 2 takes
for false, and so on until none is left. The first level that lacks a key decides, and no key of the corpus errs.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import rows_of

#: The list is a parameter that the driver holds; a longer one is refused.
MAX_RULES = 5_000_000
_HOST, _PATH = re.compile(rb"[^/?#]*"), re.compile(rb"[^?#]*")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def key(self) -> bytes:
        return (self.host + self.path).encode()


class Shape:
    """What the rules ask of a url: the most host labels and the path lengths."""

    def __init__(self, rules: Sequence[Rule]):
        self.labels = max((r.host.count(".") + 1 for r in rules), default=0)
        self.lengths = sorted({len(r.path.encode()) for r in rules}, reverse=True)

    def keys(self, host: bytes, path: bytes) -> list[bytes]:
        """The url's keys, longest first; of equal length, that of the longer host first."""
        parts = host.rsplit(b".", self.labels)
        ends = [b".".join(parts[-n:]) for n in range(min(self.labels, len(parts)), 0, -1)]
        found = [end + path[:n] for end in ends for n in self.lengths if len(path) >= n]
        return sorted(found, key=len, reverse=True)


def split(url: bytes | None) -> tuple[bytes, bytes]:
    """Host, A-Z lower-cased, and path; both empty without ``://``."""
    _, found, rest = (url or b"").partition(b"://")
    if not found:
        return b"", b""
    host = _HOST.match(rest).group()
    return host.lower(), _PATH.match(rest, len(host)).group()


@dataclass(frozen=True)
class Level:
    """A Bloom filter: bits, their number, positions per key and a seed of its own."""

    bits: np.ndarray
    size: int
    places: int
    seed: int

    @staticmethod
    def shape(keys: int, rate: float) -> tuple[int, int]:
        places = max(1, round(-math.log2(rate)))
        return max(64, math.ceil(keys * places / math.log(2))), places

    @staticmethod
    def positions(key: bytes, size: int, places: int, seed: int) -> list[int]:
        h = xxhash.xxh64_intdigest(key, seed)
        step = (h >> 32) | 1
        return [((h & 0xFFFFFFFF) * 0x9E3779B1 + i * step) % size for i in range(places)]

    def __contains__(self, key: bytes) -> bool:
        return all(self.bits[p >> 3] >> (p & 7) & 1 for p in self.positions(key, self.size, self.places, self.seed))


def _filled(positions: np.ndarray, size: int, places: int, seed: int) -> Level:
    bits = np.zeros(size, bool)
    bits[positions] = True
    return Level(np.packbits(bits, bitorder="little"), size, places, seed)


class Cascade:
    def __init__(self, levels: list[Level]):
        self.levels = levels

    def __contains__(self, key: bytes) -> bool:
        for n, level in enumerate(self.levels):
            if key not in level:
                return n % 2 == 1
        return len(self.levels) % 2 == 1


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    held = keys.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (found,) in rows_of(batches, "key"):
            yield pa.RecordBatch.from_arrays([pa.array([k for k in found if bytes(k) in held.value], pa.binary())], ["key"])

    return keys.mapInArrow(run, "key binary")


def build(listed: set[bytes], keys: DataFrame, n_keys: int) -> Cascade:
    """A cascade for ``listed``, exact on ``keys`` (one binary column, the corpus's keys, ``n_keys`` about).

    The filters grow with the list and the logarithm of ``n_keys / len(listed)``. Only bit positions of false
    positives come back from the tasks, each once, so no more than a filter has bits.
    """
    if not listed:
        return Cascade([])
    spark = keys.sparkSession
    rate = min(0.5, math.sqrt(0.5) * len(listed) / max(1, n_keys))
    size, places = Level.shape(len(listed), rate)
    where = np.array([p for k in listed for p in Level.positions(k, size, places, 1)], np.int64)
    levels = [_filled(where, size, places, 1)]
    names = spark.createDataFrame([(bytearray(k),) for k in sorted(listed)], "key binary")
    wrong = materialize(_passing(keys, levels[0]).distinct().join(names, "key", "left_anti"), "taken-for-listed")
    right = set(listed)
    while True:
        seed = len(levels) + 1
        if seed % 2 == 0:
            left = wrong.count()
            if not left:
                return Cascade(levels)
            size, places = Level.shape(left, 0.5)

            def run(batches: Iterator[pa.RecordBatch], size=size, places=places, seed=seed) -> Iterator[pa.RecordBatch]:
                for (found,) in rows_of(batches, "key"):
                    where = [p for k in found for p in Level.positions(bytes(k), size, places, seed)]
                    yield pa.RecordBatch.from_arrays([pa.array(where, pa.int64())], ["at"])

            where = np.array([r["at"] for r in wrong.mapInArrow(run, "at long").distinct().collect()], np.int64)
            levels.append(_filled(where, size, places, seed))
            right = {k for k in right if k in levels[-1]}
        else:
            if not right:
                return Cascade(levels)
            size, places = Level.shape(len(right), 0.5)
            where = np.array([p for k in right for p in Level.positions(k, size, places, seed)], np.int64)
            levels.append(_filled(where, size, places, seed))
            wrong = materialize(_passing(wrong, levels[-1]), "taken-for-listed")


def cascades(urls: DataFrame, rules: Sequence[Rule], url: str = "url") -> dict[str, Cascade]:
    """One cascade per verdict, exact on every key of every url."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    shape = Shape(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (found,) in rows_of(batches, "url"):
            keys = {k for u in found for k in shape.keys(*split(u))}
            yield pa.RecordBatch.from_arrays([pa.array(list(keys), pa.binary())], ["key"])

    keys = urls.select(F.col(f"`{url}`").cast("string").alias("url")).mapInArrow(run, "key binary")
    n_keys = keys.agg(F.approx_count_distinct("key")).first()[0]
    verdicts = {r.key: r.verdict for r in rules}
    return {v: build({k for k, own in verdicts.items() if own == v}, keys, n_keys) for v in sorted(set(verdicts.values()))}


def judged(pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """One row per input row: page_id, host, path, rule (host and path of the longest that fits, else null), verdict.

    A url that no rule fits gets ``default``. Null or empty urls and those without ``://`` have an empty host and path
    and fit no rule. A null id keeps its row, repeated rows are judged each, an empty table gives no rows, and
    other columns are not read. A key that is listed twice has its last verdict.
    """
    shape = Shape(rules)
    held = pages.sparkSession.sparkContext.broadcast(cascades(pages, rules, url))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, urls in rows_of(batches, "page_id", "url"):
            hosts, paths, names, verdicts = [], [], [], []
            for u in urls:
                host, path = split(u)
                rule, verdict = None, default
                for k in shape.keys(host, path):
                    own = next((v for v, cascade in held.value.items() if k in cascade), None)
                    if own is not None:
                        rule, verdict = k.decode(), own
                        break
                hosts.append(host.decode())
                paths.append(path.decode())
                names.append(rule)
                verdicts.append(verdict)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64())] + [pa.array(x, pa.string()) for x in (hosts, paths, names, verdicts)],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    rows = pages.select(F.col(f"`{key}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"))
    return rows.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")
