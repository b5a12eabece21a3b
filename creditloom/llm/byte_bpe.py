"""Byte-level BPE: ranked merges folded over the bytes of distinct pre-tokens, decoding by piece.

Texts are split by the tokenizer's pattern in the JVM. Each distinct pre-token is encoded once: a fold over its
bytes merges, step by step, the adjacent pair of lowest rank, looked up in a literal rank map. The fold exists as
Spark's higher-order functions (:func:`merged`) and, 30 times faster, in the tasks (:func:`fold`).
The encoded pre-tokens form a dictionary, sorted by hash and written in shards to the shared folder;
tasks map the shards into memory, so a dictionary of any size costs them only the pages they touch.
"""

from __future__ import annotations

import base64
import heapq
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, new_path
from .common import id_and_text, slices, texts

# White space beyond ASCII, which Java's \s leaves out and the tokenizer's \s has.
_SPACES = r"\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
BUCKETS = 65536
_REMEMBERED = 150_000
# Pre-tokens that a task works on at once, and bytes of one file of the dictionary.
_AT_ONCE = 200_000
_SHARD_BYTES = 32 * 2**20
_NONE = 2**31


def load_ranks(path: str) -> dict[bytes, int]:
    """Piece -> rank from a file of base64 pieces and ranks. A tokenizer file is small and fixed."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def java_pattern(pattern: str) -> str:
    """The tokenizer's pattern for Java: its \\s and \\S widened to all Unicode white space."""
    return pattern.replace(r"[^\s", rf"[^\s{_SPACES}").replace(r"\s+(?!\S)|\s+", rf"[\s{_SPACES}]+(?![^\s{_SPACES}])|[\s{_SPACES}]+")


class RankMap:
    """A rank map as two literals: arrays of buckets, by hash, of hex pieces and of their ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        pieces: list[list[str]] = [[] for _ in range(BUCKETS)]
        values: list[list[int]] = [[] for _ in range(BUCKETS)]
        for piece, rank in ranks.items():
            at = xxhash.xxh64_intdigest(name := piece.hex(), 42) % BUCKETS
            pieces[at].append(name)
            values[at].append(rank)
        self._pieces = F.from_json(F.lit(json.dumps(pieces)), "array<array<string>>")
        self._values = F.from_json(F.lit(json.dumps(values)), "array<array<int>>")

    def rank(self, piece: Column) -> Column:
        """The rank of a hex piece, null if there is none."""
        at = F.xxhash64(piece).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")
        return F.get(F.get(self._values, at), F.array_position(F.get(self._pieces, at), piece).cast("int") - 1)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def merged(word: Column, ranks: RankMap) -> Column:
    """Token ids of one pre-token.

    The state of the fold is the list of pieces; a step merges the pair of lowest rank, all its
    places at once unless two different pairs have that rank, then only the leftmost. A step without a pair
    leaves the state as it is.
    """
    text = F.lower(F.hex(F.encode(word, "UTF-8")))
    start = F.transform(F.sequence(F.lit(1), (F.length(text) / 2).cast("int")), lambda i: F.substring(text, i * 2 - 1, F.lit(2)))

    def pair_ranks(p: Column) -> Column:
        n = F.size(p) - 1
        return F.zip_with(F.slice(p, F.lit(1), n), F.slice(p, F.lit(2), n), lambda a, b: ranks.rank(F.concat(a, b)))

    def step(p: Column, _: Column) -> Column:
        def at_least(r: Column) -> Column:
            return _let(F.array_min(r), lambda best: F.when(best.isNull(), p).otherwise(_let(F.array_position(r, best).cast("int"), lambda i: apply(p, r, best, i))))

        return F.when(F.size(p) < 2, p).otherwise(_let(pair_ranks(p), at_least))

    def apply(p: Column, r: Column, best: Column, i: Column) -> Column:
        left, right = F.element_at(p, i), F.element_at(p, i + 1)
        once = F.concat(F.slice(p, F.lit(1), i - 1), F.array(F.concat(left, right)), F.slice(p, i + 2, F.greatest(F.size(p) - i - 1, F.lit(0))))
        # Pieces as <a><b>: replacing goes from left to right and never overlaps.
        joined = F.concat(F.lit("<"), F.array_join(p, "><"), F.lit(">"))
        swapped = F.replace(joined, F.concat(F.lit("<"), left, F.lit("><"), right, F.lit(">")), F.concat(F.lit("<"), left, right, F.lit(">")))
        every = F.split(F.substring(swapped, F.lit(2), F.length(swapped) - 2), "><")
        places = F.size(F.filter(r, lambda x: x == best))
        others = F.exists(F.zip_with(r, F.slice(p, F.lit(1), F.size(r)), lambda x, a: (x == best) & (a != left)), lambda x: F.coalesce(x, F.lit(False)))
        return F.when((places > 1) & ~others, every).otherwise(once)

    whole = ranks.rank(text)
    folded = F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(start) - 1, F.lit(1))), start, step)
    return F.when(whole.isNotNull(), F.array(whole)).otherwise(F.transform(folded, ranks.rank))


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """What :func:`merged` does, on bytes; a heap of pairs keeps long pre-tokens from costing the square."""
    if word in ranks:
        return [ranks[word]]
    parts: list = [word[i : i + 1] for i in range(len(word))]
    if len(parts) <= 48:
        near = [ranks.get(a + b, _NONE) for a, b in zip(parts, parts[1:])]
        while near and (best := min(near)) != _NONE:
            i = near.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del near[i]
            if i:
                near[i - 1] = ranks.get(parts[i - 1] + parts[i], _NONE)
            if i < len(near):
                near[i] = ranks.get(parts[i] + parts[i + 1], _NONE)
        return [ranks[p] for p in parts]
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap = [(r, i, parts[i], parts[i + 1]) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i] if parts[i] is not None else len(parts)
        if j >= len(parts) or parts[i] != left or parts[j] != right:
            continue
        parts[i], parts[j] = left + right, None
        after[i] = after[j]
        if after[i] < len(parts):
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < len(parts) and (r := ranks.get(parts[k] + parts[after[k]])) is not None:
                heapq.heappush(heap, (r, k, parts[k], parts[after[k]]))
    return [ranks[p] for p in parts if p is not None]


def pre_tokens(docs: DataFrame, pattern: str) -> DataFrame:
    """(doc_id, words): matches of the pattern, in order."""
    return docs.select("doc_id", F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(java_pattern(pattern)), F.lit(0)).alias("words"))


def dictionary(words: DataFrame, ranks: dict[bytes, int], native: bool = False) -> list[tuple[int, int, str]]:
    """Shards of the encoded distinct pre-tokens, see :func:`stored`."""
    spark = words.sparkSession
    distinct = words.select(F.explode("words").alias("word")).distinct()
    if native:
        encoded = distinct.select(F.xxhash64("word").alias("key"), "word", merged(F.col("word"), RankMap(ranks)).alias("ids"))
    else:
        rank_map = spark.sparkContext.broadcast(ranks)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [fold(w, rank_map.value) for w in texts(batch.column("word"))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), batch.column("word"), pa.array(found, pa.list_(pa.int32()))], ["key", "word", "ids"]
                )

        encoded = distinct.select(F.xxhash64("word").alias("key"), "word").mapInArrow(run, "key long, word string, ids array<int>")
    return stored(materialize(encoded, "encoded"))


def stored(encoded: DataFrame) -> list[tuple[int, int, str]]:
    """Shards (first key, last key, path) of (key, word, ids), key the hash of the word, sorted by it.

    Only the shards' names and bounds come back. Each attempt of a task writes a file of its own.
    """
    folder = new_path(encoded.sparkSession, "pre-tokens")
    ranged = encoded.repartitionByRange("key", "word").sortWithinPartitions("key", "word")

    def written(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches).combine_chunks()
        files, base = pyarrow.fs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.arrow"
        with files.open_output_stream(f"{base}/{name}") as out, pa.ipc.new_file(out, table.schema) as writer:
            writer.write_table(table)
        keys = table["key"]
        return pa.RecordBatch.from_arrays([pa.array([keys[0].as_py()]), pa.array([keys[-1].as_py()]), pa.array([name])], ["first", "last", "name"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.nbytes for b in held) >= _SHARD_BYTES:
                yield written(held)
                held = []
        if held:
            yield written(held)

    found = ranged.mapInArrow(write, "first long, last long, name string").collect()
    return sorted((r["first"], r["last"], f"{folder}/{r['name']}") for r in found)


class Dictionary:
    """Looks pre-tokens up in the mapped shards."""

    def __init__(self, shards: list[tuple[int, int, str]]):
        self._firsts = np.array([s[0] for s in shards], np.int64)
        self._lasts = np.array([s[1] for s in shards], np.int64)
        self._paths = [s[2] for s in shards]
        self._open: dict[int, tuple] = {}

    def _shard(self, n: int) -> tuple:
        if n not in self._open:
            files, path = pyarrow.fs.FileSystem.from_uri(self._paths[n])
            local = isinstance(files, pyarrow.fs.LocalFileSystem)
            table = pa.ipc.open_file(pa.memory_map(path) if local else files.open_input_file(path)).read_all()
            # One batch a file: its columns are views of the mapped file, nothing is copied.
            ids = table["ids"].chunk(0)
            self._open[n] = table["key"].to_numpy(), table["word"].chunk(0), ids.offsets.to_numpy(), ids.values.to_numpy()
        return self._open[n]

    def __call__(self, words: list[str], missing: bool = False) -> list[np.ndarray | None]:
        """The ids of each word; ``missing`` words get None, else every word must be there."""
        if not self._paths:
            return [None] * len(words)
        keys = np.array([xxhash.xxh64_intdigest(w, 42) for w in words], np.uint64).view(np.int64)
        out: list = [None] * len(words)
        # A key may begin in one shard and go on in the next; try each shard whose range holds it.
        low = np.searchsorted(self._lasts, keys, "left")
        for n in np.unique(low).tolist():
            if missing and n == len(self._paths):
                continue
            mine = np.flatnonzero(low == n)
            own, names, offsets, values = self._shard(n)
            places = np.searchsorted(own, keys[mine])
            # Nearly all words are the first of their key.
            inside = np.minimum(places, len(own) - 1)
            asked = pa.array([words[i] for i in mine.tolist()], names.type)
            same = (own[inside] == keys[mine]) & pc.equal(names.take(pa.array(inside)), asked).to_numpy(zero_copy_only=False)
            for i, first, last in zip(mine[same].tolist(), offsets[inside[same]].tolist(), offsets[inside[same] + 1].tolist()):
                out[i] = values[first:last]
            for i, at in zip(mine[~same].tolist(), places[~same].tolist()):
                shard, (own_, names_, offsets_, values_) = n, (own, names, offsets, values)
                while own_[at] == keys[i] and names_[at].as_py() != words[i] or not missing and own_[at] != keys[i]:
                    at += 1
                    if at == len(own_):
                        shard, at = shard + 1, 0
                        if shard == len(self._paths):
                            break
                        own_, names_, offsets_, values_ = self._shard(shard)
                if missing and (at >= len(own_) or shard == len(self._paths) or own_[at] != keys[i]):
                    continue
                out[i] = values_[offsets_[at] : offsets_[at + 1]]
        return out


    def table(self, words: list[bytes], width: int) -> np.ndarray:
        """The ids of each word, ``width`` of them in a row; -1 for words that are not there."""
        out = np.full((len(words), width), -1, np.int64)
        if not self._paths or not words:
            return out
        keys = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in words), np.uint64, len(words)).view(np.int64)
        order = np.argsort(keys)
        keys, asked = keys[order], pa.array(words, pa.binary()).take(pa.array(order))
        low = np.searchsorted(self._lasts, keys, "left")
        for n in np.unique(low[low < len(self._paths)]).tolist():
            start, end = np.searchsorted(low, [n, n + 1]).tolist()
            own, names, offsets, values = self._shard(n)
            inside = np.minimum(np.searchsorted(own, keys[start:end]), len(own) - 1)
            hit = own[inside] == keys[start:end]
            same = hit & pc.equal(names.take(pa.array(inside)).cast(pa.binary()), asked.slice(start, end - start)).to_numpy(zero_copy_only=False)
            out[order[start:end][same]] = values[offsets[inside[same]][:, None] + np.arange(width)]
            for i in order[start:end][hit & ~same].tolist():  # not the first of its key
                found = self([words[i].decode()], missing=True)[0]
                if found is not None:
                    out[i] = found
        return out


class Remembered:
    """Ids of the words met so far, one after the other in ``pool``; starts anew beyond a number of words."""

    def __init__(self, look_up: Dictionary):
        self._look_up = look_up
        self._forget()

    def _forget(self) -> None:
        self._row: dict[str, int] = {}
        self._starts, self._used = np.zeros(1, np.int64), 0
        self.pool = np.empty(1024, np.int32)

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Start and number of each word's ids in the pool; ``words`` are distinct."""
        if len(self._row) > _REMEMBERED:
            self._forget()
        new = [w for w in words if w not in self._row]
        if new:
            found = self._look_up(new)
            self._row.update(zip(new, range(len(self._row), len(self._row) + len(new))))
            ends = self._used + np.cumsum([len(ids) for ids in found])
            if ends[-1] > len(self.pool):
                grown = np.empty(max(int(ends[-1]), 2 * len(self.pool)), np.int32)
                grown[: self._used] = self.pool[: self._used]
                self.pool = grown
            self.pool[self._used : ends[-1]] = np.concatenate(found)
            self._starts, self._used = np.r_[self._starts, ends], int(ends[-1])
        rows = np.fromiter(map(self._row.__getitem__, words), np.int64, len(words))
        return self._starts[rows], self._starts[rows + 1] - self._starts[rows]


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", native: bool = False) -> DataFrame:
    """One row per input row: doc_id, ids (array of int).

    Null or empty text: no ids. A null id keeps its row; repeated rows are encoded each for itself; an empty table
    gives no rows. Other columns are not read. A text of any length is one row; a task holds the pre-tokens of one
    batch, which is bounded by bytes, or of one text. ``native`` folds with higher-order functions; the ids are the same.
    """
    words = pre_tokens(id_and_text(docs, key, text), pattern)
    shards = dictionary(words, load_ranks(path), native)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered(Dictionary(shards))
        for whole in batches:
            for batch in slices(whole, whole.column("words").value_lengths().to_numpy(), _AT_ONCE):
                lists = batch.column("words")
                coded = lists.flatten().dictionary_encode()
                start, size = known(coded.dictionary.to_pylist())
                each = coded.indices.to_numpy()
                start, size = start[each], size[each]
                ends = np.r_[0, np.cumsum(size)]
                flat = known.pool[np.repeat(start - ends[:-1], size) + np.arange(ends[-1])]
                offsets = ends[np.r_[0, np.cumsum(lists.value_lengths().to_numpy())]]
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    return words.mapInArrow(run, "doc_id long, ids array<int>")


def decoded(ids: str | Column, path: str) -> Column:
    """The bytes of an array of ids: the pieces, a literal array, joined."""
    ranks = load_ranks(path)
    pieces = [""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece.hex()
    table = F.split(F.lit(",".join(pieces)), ",")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), ""))
