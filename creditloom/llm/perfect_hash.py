"""A sharded minimal perfect hash over 64-bit keys, kept as files in the shared folder.

Each key gets the number of a slot of its own. In level 0 every key picks one bit; a key that is alone
there is placed, the others go on to the next, smaller level. A key's slot is the number of set bits before its
own, so a level costs three bits a key and no key is stored. A shard holds the keys of one range of hashes, about
``ENTRIES`` of them whatever the size of the table; next to the bits lie a fingerprint and, if wanted, a count per
slot. A key that is not in the table finds no bit or, with the odds of the fingerprint, a wrong slot.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame

from ..session import new_path
from .common import mixed

ENTRIES = 1_000_000
_SPACE = 2  # bits of a level per key that is still to be placed
_LEVELS = 32
_SIEVE = 8  # bits per key that tell at once, for most keys that are not there, that they are not
_HELD_BYTES = 64_000_000  # of shards that cannot be mapped


def _seed(level: int) -> np.uint64:
    return np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)


def _bit(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return ((mixed(keys ^ _seed(level)) >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """The range of hashes that a key lies in; :data:`SHARD_SQL` says the same."""
    return (((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


SHARD_SQL = "CAST(shiftright(shiftrightunsigned(key, 32) * {shards}L, 32) AS INT)"


class Levels:
    """The bits of one shard: key -> slot."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray, before: np.ndarray, strays: np.ndarray):
        self.sizes, self.words, self.before, self.strays = sizes, words, before, strays

    @classmethod
    def of(cls, keys: np.ndarray) -> Levels:
        """Place ``keys``. Equal keys can never be told apart; they are the strays, behind all others."""
        rest, sizes, found = keys, [], []
        while len(rest) and len(sizes) < _LEVELS:
            size = -(-max(len(rest) * _SPACE, 64) // 64) * 64
            at = _bit(rest, len(sizes), size).astype(np.int64)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, bool)
            bits[at[alone]] = True
            sizes.append(size)
            found.append(np.packbits(bits, bitorder="little").view(np.uint64))
            rest = rest[~alone]
        words = np.concatenate(found) if found else np.empty(0, np.uint64)
        before = np.r_[0, np.cumsum(np.bitwise_count(words), dtype=np.uint32)].astype(np.uint32)
        return cls(np.array(sizes, np.int64), words, before, np.sort(rest))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where it has none. Strays have the slot of the first of their equals."""
        out = np.full(len(keys), -1, np.int64)
        left, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = _bit(keys[left], level, size).astype(np.int64) + start
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            low = word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[left[hit]] = self.before[at[hit] >> 6] + np.bitwise_count(low)
            left, start = left[~hit], start + size
        if len(left) and len(self.strays):
            at = np.searchsorted(self.strays, keys[left])
            own = (at < len(self.strays)) & (self.strays[np.minimum(at, len(self.strays) - 1)] == keys[left])
            out[left[own]] = int(self.before[-1]) + at[own]
        return out


def _save(path: str, arrays: dict[str, np.ndarray]) -> None:
    files, path = pyarrow.fs.FileSystem.from_uri(path)
    files.create_dir(path.rsplit("/", 1)[0], recursive=True)
    head = json.dumps([[name, a.dtype.str, len(a)] for name, a in arrays.items()]).encode()
    with files.open_output_stream(path) as out:
        out.write(len(head).to_bytes(8, "little") + head + b" " * (-len(head) % 8))
        for a in arrays.values():
            out.write(a.tobytes() + b"\0" * (-a.nbytes % 8))


def _load(path: str) -> tuple[dict[str, np.ndarray], int]:
    """The arrays of a file, mapped where the file system allows it, and the bytes that are held."""
    files, path = pyarrow.fs.FileSystem.from_uri(path)
    local = isinstance(files, pyarrow.fs.LocalFileSystem)
    with pa.memory_map(path) if local else files.open_input_file(path) as source:
        data = source.read_buffer()
    size = int.from_bytes(data[:8].to_pybytes(), "little")
    out, at = {}, 8 + size + -size % 8
    for name, kind, n in json.loads(data[8 : 8 + size].to_pybytes()):
        out[name] = np.frombuffer(data, np.dtype(kind), n, at)
        at += out[name].nbytes + -out[name].nbytes % 8
    return out, 0 if local else data.size


@dataclass(frozen=True)
class Index:
    """The shards' files by number; an empty range of hashes has none."""

    paths: tuple[str | None, ...]

    def reader(self) -> Reader:
        return Reader(self)


class Reader:
    """Probes an index from inside a task, shard after shard."""

    def __init__(self, index: Index):
        self._index, self._open, self._held = index, {}, 0

    def _shard(self, n: int) -> tuple[Levels, dict[str, np.ndarray]]:
        if n not in self._open:
            arrays, size = _load(self._index.paths[n])
            if self._held + size > _HELD_BYTES:
                self._open, self._held = {}, 0
            self._held += size
            levels = Levels(*(arrays.pop(name) for name in ("sizes", "words", "before", "strays")))
            self._open[n] = levels, arrays
        return self._open[n]

    def counts(self, keys: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """The count of each (key, fingerprint), 0 for one that is not in the index."""
        out = np.zeros(len(keys), np.int64)
        for n, mine in self._dealt(keys):
            levels, arrays = self._shard(n)
            own, mark, number = levels.slots(keys[mine]), arrays["mark"], arrays["n"]
            want = prints[mine].astype(mark.dtype)
            known = own >= 0
            known[known] = mark[own[known]] == want[known]
            out[mine[known]] = number[own[known]]
            if len(levels.strays):  # equal keys of different lines: look at each of them
                first = int(levels.before[-1])
                for i in np.flatnonzero((own >= first) & ~known).tolist():
                    same = np.flatnonzero((levels.strays == keys[mine[i]]) & (mark[first:] == want[i]))
                    out[mine[i]] = number[first + same[0]] if len(same) else 0
        return out

    def has(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key is in the index, up to the odds of the fingerprint for those that are not."""
        out = np.zeros(len(keys), bool)
        for n, mine in self._dealt(keys):
            levels, arrays = self._shard(n)
            asked, sieve = keys[mine], arrays["sieve"]
            low = asked & np.uint64(len(sieve) * 8 - 1)
            left = np.flatnonzero((sieve[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8)) & 1)
            own, mark = levels.slots(asked[left]), arrays["mark"]
            known = own >= 0
            known[known] = mark[own[known]] == mixed(asked[left][known]).astype(mark.dtype)
            out[mine[left]] = known
        return out

    def _dealt(self, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        if len(self._index.paths) == 1:
            if len(keys) and self._index.paths[0] is not None:
                yield 0, np.arange(len(keys))
            return
        shards = shard_of(keys, len(self._index.paths))
        order = np.argsort(shards, kind="stable")
        for mine in np.split(order, np.flatnonzero(np.diff(shards[order])) + 1):
            if len(mine) and self._index.paths[n := int(shards[mine[0]])] is not None:
                yield n, mine


def build(entries: DataFrame, n: int, mark: str | None = None, label: str = "perfect-hash") -> Index:
    """An index over ``entries``: key, and mark and n (both long) if ``mark`` names the fingerprint's type.

    ``n`` is the number of entries. Without ``mark`` a fingerprint of 32 bits is drawn from the key, whose low bits
    must be as good as random: a byte a key sieves out most that are not there. A shard is
    built by one task from about ``ENTRIES`` rows; each attempt writes a file of its own and only names
    come back to the driver.
    """
    shards = max(1, -(-n // ENTRIES))
    folder = new_path(entries.sparkSession, label)

    def write(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        keys = table["key"].to_numpy().view(np.uint64)
        levels = Levels.of(keys)
        slots = levels.slots(keys)
        placed = slots < int(levels.before[-1])
        slots[~placed] = int(levels.before[-1]) + np.argsort(np.argsort(keys[~placed], kind="stable"), kind="stable")
        arrays = {"sizes": levels.sizes, "words": levels.words, "before": levels.before, "strays": levels.strays}
        if mark is None:
            arrays["mark"] = np.empty(len(keys), np.uint32)
            arrays["mark"][slots] = mixed(keys).astype(np.uint32)
            bits = np.zeros(_SIEVE << len(keys).bit_length(), bool)
            bits[keys & np.uint64(len(bits) - 1)] = True
            arrays["sieve"] = np.packbits(bits, bitorder="little")
        else:
            arrays["mark"], arrays["n"] = np.empty(len(keys), mark), np.empty(len(keys), np.int64)
            arrays["mark"][slots] = table["mark"].to_numpy().view(np.uint64).astype(mark)
            arrays["n"][slots] = table["n"].to_numpy()
        name = f"{uuid.uuid4().hex}.mph"
        _save(f"{folder}/{name}", arrays)
        return pa.table({"shard": pa.array([table["shard"][0].as_py()], pa.int32()), "name": [name]})

    columns = ["key"] if mark is None else ["key", "mark", "n"]
    dealt = entries.selectExpr(f"{SHARD_SQL.format(shards=shards)} AS shard", *columns)
    names = {r["shard"]: r["name"] for r in dealt.groupBy("shard").applyInArrow(write, "shard int, name string").collect()}
    return Index(tuple(f"{folder}/{names[i]}" if i in names else None for i in range(shards)))
