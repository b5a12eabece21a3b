"""Language-model scores from an Elias-Fano trie of words, word pairs, triples and so on up to ``order``.

Training tokens are counted by Spark. A word's number is its place in the vocabulary. A level below the words holds the sequences
of one word more: each is a number of the level above (its context, pointed at) and a word. They are cut by ranges of
contexts into shards, each written by one task to the shared folder. In a shard they are one rising sequence (context times
vocabulary size plus word, relative to the shard's first) in Elias-Fano form: low bits packed, high bits in
unary, a directory of zeros. The high bits are the monotone pointers: a sequence is found by jumping to the bucket of its high
part and searching the word there; its place is its number, the context of the next level. Beside each stands its smoothed
probability in 16 bits on a log scale, beside each context its weight. Tasks map the files into memory and look up a batch's distinct sequences shard by shard.

The model is absolute discounting, interpolated: p(w | h) = max(c(hw) - D, 0) / c(h) + D * T(h) / c(h) * p(w | h without its first word),
T(h) the number of words seen after h; p(w) = (c(w) + 1) / (N + V + 1). Where h was not seen, and at the start: the shorter history's.
"""

from __future__ import annotations

import io
import math
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, new_path
from .byte_bpe import Dictionary, stored
from .common import bounded_batches, discard, release, rows_of, words_of

#: The end of a text is a token; no word holds a line break.
END = b"\n"
DISCOUNT = 0.75
_STEP = 40 / 65535
#: Tokens looked at together in a task.
_CHUNK = 500_000
#: Training tokens behind a shard.
_SHARD = 3_000_000
#: Sequences that a task adds up before it hands them on.
_GATHERED = 4_000_000
#: Words that a task remembers.
_REMEMBERED = 400_000
#: A number in each byte of a word of 64 bits.
_BYTES = np.uint64(0x0101010101010101)
_SELECT = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[:8] for b in range(256)], np.int64)


def _save(folder: str, name: str, array: np.ndarray) -> None:
    files, base = pyarrow.fs.FileSystem.from_uri(folder)
    files.create_dir(base, recursive=True)
    with files.open_output_stream(f"{base}/{name}.npy") as out:
        data = io.BytesIO()
        np.save(data, array)
        out.write(data.getvalue())


def _load(folder: str, name: str) -> np.ndarray:
    """A file of the model, mapped where the shared folder is a file system, else read."""
    files, base = pyarrow.fs.FileSystem.from_uri(folder)
    path = f"{base}/{name}.npy"
    if isinstance(files, pyarrow.fs.LocalFileSystem):
        return np.load(path, mmap_mode="r")
    with files.open_input_file(path) as data:
        return np.load(io.BytesIO(data.read()))


class EliasFano:
    """A rising sequence of distinct numbers from 0."""

    def __init__(self, low: np.ndarray, high: np.ndarray, zeros: np.ndarray, bits: int, n: int):
        self._low, self._high, self._zeros, self._bits, self._n = low, high, zeros, bits, n

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        n, top = len(values), int(values[-1]) + 1
        bits = max(0, min(56, (top // n).bit_length() - 1))
        packed, place = [], np.arange(bits, dtype=np.uint64)
        for at in range(0, n, 80_000):
            part = values[at : at + 80_000].astype(np.uint64)
            packed.append(np.packbits(((part[:, None] >> place) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little"))
        low = np.r_[np.concatenate(packed), np.zeros(8, np.uint8)]
        unary = np.zeros(-(-(n + (top >> bits) + 2) // 64) * 64, bool)
        unary[(values >> bits) + np.arange(n)] = True
        high = np.packbits(unary, bitorder="little").view(np.uint64)
        zeros = np.r_[0, np.cumsum(64 - np.bitwise_count(high).astype(np.int64))][:-1]
        return cls(low, high, zeros, bits, n)

    @property
    def parts(self) -> list[np.ndarray]:
        return [self._low, self._high, self._zeros]

    @property
    def bits(self) -> int:
        return self._bits

    def _zero(self, j: np.ndarray) -> np.ndarray:
        """Place of the j-th zero of the unary part."""
        word = np.searchsorted(self._zeros, j, "right") - 1
        left = (j - self._zeros[word]).astype(np.uint64)
        own = ~self._high[word]
        # In each byte the bits of it and the lower ones; the byte wanted comes behind those that hold no more than what is left.
        sums = np.ascontiguousarray(np.bitwise_count(own.view(np.uint8))).view(np.uint64) * _BYTES
        high = _BYTES << np.uint64(7)
        byte = np.bitwise_count((((left * _BYTES) | high) - sums) & high).astype(np.uint64) * np.uint64(8)
        left -= ((sums << np.uint64(8)) >> byte) & np.uint64(255)
        return word * 64 + byte.astype(np.int64) + _SELECT[(own >> byte) & np.uint64(255), left]

    def _lows(self, at: np.ndarray) -> np.ndarray:
        if not self._bits:
            return np.zeros(len(at), np.int64)
        bit = at * self._bits
        # The eight bytes from each byte on, as a view.
        parts = np.ndarray(len(self._low) - 7, np.uint64, np.ascontiguousarray(self._low), strides=(1,))[bit >> 3]
        return ((parts >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self._bits) - 1)).astype(np.int64)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Index of each value, -1 if it is not in the sequence. Values lie between the first and the last."""
        bucket, low = values >> self._bits, values & ((1 << self._bits) - 1)
        end = self._zero(bucket) - bucket
        start = np.where(bucket > 0, self._zero(np.maximum(bucket - 1, 0)) - (bucket - 1), 0)
        first, last = start.copy(), end.copy()
        while (open_ := np.flatnonzero(first < last)).size:
            middle = (first[open_] + last[open_]) // 2
            less = self._lows(middle) < low[open_]
            first[open_[less]] = middle[less] + 1
            last[open_[~less]] = middle[~less]
        found = np.full(len(values), -1, np.int64)
        inside = np.flatnonzero(first < end)
        hit = inside[self._lows(first[inside]) == low[inside]]
        found[hit] = first[hit]
        return found


class ByNumber:
    """Values of words by number, in mapped shards of consecutive numbers."""

    def __init__(self, folder: str, shards: list[tuple[int, str]]):
        self._folder, self._firsts, self._names, self._open = folder, np.array([s[0] for s in shards], np.int64), [s[1] for s in shards], {}

    def __call__(self, numbers: np.ndarray) -> np.ndarray:
        out = np.zeros(len(numbers))
        shard = np.searchsorted(self._firsts, numbers, "right") - 1
        for n in np.unique(shard).tolist():
            if n not in self._open:
                self._open[n] = _load(self._folder, self._names[n])
            mine = shard == n
            out[mine] = self._open[n][numbers[mine] - self._firsts[n]]
        return out


def _by_number(rows: DataFrame, label: str) -> tuple[str, list[tuple[int, str]]]:
    """Write (id, value), ids dense, in shards; what :class:`ByNumber` takes."""
    folder = new_path(rows.sparkSession, label)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if parts:
            name = uuid.uuid4().hex
            _save(folder, name, np.concatenate([p[1] for p in parts]))
            yield pa.RecordBatch.from_arrays([pa.array([parts[0][0][0]]), pa.array([name])], ["first", "name"])

    found = rows.repartitionByRange("id").sortWithinPartitions("id").mapInArrow(write, "first long, name string").collect()
    return folder, sorted((r["first"], r["name"]) for r in found)


def _written(rows: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``rows`` as a table of their own, and its path, to be removed once it is used."""
    path = new_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), path


def _numbered(counts: DataFrame) -> tuple[DataFrame, str]:
    """Adds dense numbers ``id`` from 0, in the order of partitions; only the partitions' sizes are gathered. The table and its path."""
    counts, path = _written(counts.withColumn("at", F.monotonically_increasing_id()), "vocabulary")
    part = F.shiftright("at", 33)
    sizes = counts.groupBy(part.alias("part")).count().orderBy("part").collect()
    start, starts = 0, []
    for row in sizes:
        starts += [F.lit(row["part"]), F.lit(start)]
        start += row["count"]
    place = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    offset = F.create_map(*starts)[part] if starts else F.lit(0)
    found = _written(counts.select("word", "c", (place + offset).cast("long").alias("id")), "words")
    discard(counts.sparkSession, path)
    return found


def scored(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", order: int = 2) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    Learns from the rows for which ``held_out`` (an expression over ``doc_id``) is not true, sequences of up to ``order`` tokens. Null or
    empty text is the end token alone. A null id keeps its row; repeated rows count and are scored each; an empty table gives no rows;
    without training rows every token is unknown. Other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.withColumn("held_out", F.coalesce(held_out, F.lit(False)))

    def counted(own: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(own), pa.binary()).cast(pa.string()), pa.array(list(own.values()), pa.int64())], ["word", "c"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Counter = Counter()
        for (found,) in rows_of(batches, "text"):
            for t in found:
                own.update(words_of(t))
            own[END] += len(found)
            if len(own) > _REMEMBERED:
                yield counted(own)
                own = Counter()
        yield counted(own)

    counts = rows.where(~F.col("held_out")).select("text").mapInArrow(count, "word string, c long")
    vocabulary, path = _numbered(counts.groupBy("word").agg(F.sum("c").alias("c")))
    total, size = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    high, low = F.shiftright("c", 31).cast("int"), F.col("c").bitwiseAND(F.lit(2**31 - 1)).cast("int")
    shards = stored(vocabulary.select(F.xxhash64("word").alias("key"), "word", F.array(F.col("id").cast("int"), high, low).alias("ids"))) if size else []
    floor = total + size + 1

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look_up, known = Dictionary(shards), {}
        # Number and count of the known words, in the order of ``known``.
        table = np.empty((0, 2), np.int64)
        for keys, outs, found in rows_of(batches, "doc_id", "held_out", "text"):
            lists = [[*words_of(t), END] for t in found]
            if len(known) > _REMEMBERED:
                known, table = {}, table[:0]
            new = list(set(chain.from_iterable(lists)) - known.keys())
            known.update(zip(new, range(len(known), len(known) + len(new))))
            entries = look_up.table(new, 3)
            there = entries[:, 0] >= 0
            entries = np.stack((entries[:, 0], np.where(there, (entries[:, 1] << 31) + entries[:, 2], 0)), axis=1)
            table = np.concatenate((table, entries))
            ends = np.cumsum([0, *map(len, lists)])
            at = np.fromiter(map(known.__getitem__, chain.from_iterable(lists)), np.int64, ends[-1])
            c, starts = table[at, 1], ends[:-1]
            numbers = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(table[at, 0].astype(np.int32)))
            sure, base = (np.add.reduceat(x, starts) if len(starts) else x for x in ((c > 0).astype(np.int64), np.log10((c + 1) / floor)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(outs, pa.bool_()), numbers, pa.array(sure), pa.array(base)],
                ["doc_id", "held_out", "ids", "n_known", "base_score"],
            )

    coded = materialize(rows.mapInArrow(number, "doc_id long, held_out boolean, ids array<int>, n_known long, base_score double"), "numbered")
    levels: list[Level] = []
    if size:
        words = _by_number(vocabulary.select("id", F.col("c").cast("double")), "word-counts")
        # The model needs neither the words' table nor their dictionary: what is no longer read makes room for the levels.
        discard(spark, path)
        discard(spark, shards[0][2].rpartition("/")[0])
        for _ in range(order - 1):
            release(spark)
            levels.append(_level(coded, levels, size, total))
        release(spark)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(words, levels, floor) if size else None
        for batch in batches:
            flat, ends = _tokens(batch)
            logs = model(flat, ends[:-1]) if model else np.full(len(flat), math.log10(1 / floor))
            sums = np.add.reduceat(logs, ends[:-1]) if len(flat) else np.empty(0)
            n = len(sums)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(np.diff(ends)), batch.column("n_known"), pa.array(np.full(n, total, np.int64)), batch.column("base_score"), pa.array(sums)],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return coded.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The word numbers of a batch one after the other, and where its texts end."""
    lists = batch.column("ids")
    return lists.flatten().to_numpy().astype(np.int64), np.r_[0, np.cumsum(lists.value_lengths().to_numpy().astype(np.int64))]


def _packed(values: np.ndarray) -> bytes:
    """64-bit numbers by their bytes, all lowest ones first: the upper ones of small numbers are zeros, which compression takes away."""
    return np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<i8").ravel()


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Rising distinct sequences and their counts, of several such tables."""
    gram, c = map(np.concatenate, zip(*parts))
    order = np.argsort(gram, kind="stable")
    gram, c = gram[order], c[order]
    new = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
    return gram[new], np.add.reduceat(c, new)


class Level:
    """Sequences of one length: for a context (a number of the level above) and a word, their number, share and the context's weight."""

    _TYPES = (np.uint8, np.uint64, np.int64, np.uint16, np.float32)

    def __init__(self, folder: str, shards: list[tuple], size: int):
        self._folder, self._shards, self._size = folder, sorted(shards), size
        self._starts = np.cumsum([0, *(s[3] for s in self._shards)])
        self._contexts = np.array([s[0] // size for s in self._shards], np.int64)

    @property
    def count(self) -> int:
        return int(self._starts[-1])

    @classmethod
    def written(cls, folder: str, values: np.ndarray, c: np.ndarray, size: int) -> tuple:
        """Write a shard: all sequences, rising, of some consecutive contexts, and their counts."""
        contexts = values // size
        new = np.flatnonzero(np.r_[True, contexts[1:] != contexts[:-1]])
        # Every token of a context but the end, which is none, has a successor.
        sums, t = np.add.reduceat(c, new), np.diff(np.r_[new, len(values)])
        share = (c - DISCOUNT) / np.repeat(sums, t)
        weights = np.zeros(contexts[-1] - contexts[0] + 1, np.float32)
        weights[contexts[new] - contexts[0]] = DISCOUNT * t / sums
        coder = EliasFano.of(values - values[0])
        parts = [*coder.parts, np.minimum(65535, np.round(-np.log(share) / _STEP)).astype(np.uint16), weights]
        name, raw = uuid.uuid4().hex, [p.tobytes() for p in parts]
        _save(folder, name, np.frombuffer(b"".join(r + bytes(-len(r) % 8) for r in raw), np.uint8))
        return int(values[0]), int(values[-1]), coder.bits, len(values), [len(p) for p in parts], name

    def _open(self, n: int) -> tuple[EliasFano, np.ndarray, np.ndarray]:
        _, _, bits, length, sizes, name = self._shards[n]
        data, at, parts = _load(self._folder, name), 0, []
        for kind, items in zip(self._TYPES, sizes):
            end = at + items * np.dtype(kind).itemsize
            parts.append(data[at:end].view(kind))
            at = end + -end % 8
        return EliasFano(*parts[:3], bits, length), parts[3], parts[4]

    def __call__(self, contexts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number (-1), discounted share and weight (0 where there is none) for each context and word (-1: unknown)."""
        each, back = np.unique(contexts * (self._size + 1) + words + 1, return_inverse=True)
        contexts, words = each // (self._size + 1), each % (self._size + 1) - 1
        numbers, shares, weights = np.full(len(each), -1), np.zeros(len(each)), np.zeros(len(each))
        bounds = np.r_[np.searchsorted(contexts, self._contexts), len(each)]
        for n in np.flatnonzero(np.diff(bounds)).tolist():
            mine = slice(bounds[n], bounds[n + 1])
            first, last = self._shards[n][:2]
            coder, codes, own = self._open(n)
            place = contexts[mine] - first // self._size
            weights[mine] = np.where(place < len(own), own[np.minimum(place, len(own) - 1)], 0)
            values = contexts[mine] * self._size + words[mine]
            asked = np.flatnonzero((words[mine] >= 0) & (values >= first) & (values <= last))
            at = coder.find(values[asked] - first)
            asked, at = asked[at >= 0] + bounds[n], at[at >= 0]
            numbers[asked] = at + self._starts[n]
            shares[asked] = np.exp(-_STEP * codes[at].astype(np.float64))
        return numbers[back], shares[back], weights[back]


def _walk(flat: np.ndarray, starts: np.ndarray, levels: list[Level]) -> Iterator[tuple]:
    """Piece by piece: its place, its words, what each level says (tokens asked for, shares, weights), and the contexts of a further level."""
    begins = np.zeros(len(flat), bool)
    begins[starts] = True
    before = [-1] * (len(levels) + 1)
    for at in range(0, len(flat), _CHUNK):
        words, first = flat[at : at + _CHUNK], begins[at : at + _CHUNK]
        numbers, said = words, []
        for k in range(len(levels) + 1):
            contexts = np.r_[before[k], numbers[:-1]]
            before[k] = numbers[-1]
            contexts[first] = -1
            if k < len(levels):
                asked = np.flatnonzero(contexts >= 0)
                found, shares, weights = levels[k](contexts[asked], words[asked])
                numbers = np.full(len(words), -1)
                numbers[asked] = found
                said.append((asked, shares, weights))
        yield at, words, contexts, said


def _level(coded: DataFrame, above: list[Level], size: int, total: int) -> Level:
    """Count and write the sequences that are one token longer than those of the last level."""
    folder = new_path(coded.sparkSession, "trie")
    shards = -(-total // _SHARD)
    width = -(-(above[-1].count if above else size) // shards)

    def counted(grams: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        found, c = np.unique(np.concatenate(grams), return_counts=True)
        which = found // size // width
        cuts = np.flatnonzero(np.r_[True, (which[1:] != which[:-1]) | (np.arange(1, len(found)) % _CHUNK == 0)])
        for at, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(found)]):
            row = [which[at]], [_packed(np.diff(found[at:end], prepend=0))], [_packed(c[at:end])]
            yield pa.RecordBatch.from_arrays([pa.array(row[0], pa.int32()), *(pa.array(x, pa.binary()) for x in row[1:])], ["shard", "gram", "c"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, n = [], 0
        for batch in batches:
            flat, ends = _tokens(batch)
            for _, words, contexts, _ in _walk(flat, ends[:-1], above):
                inner = contexts >= 0
                grams.append(contexts[inner] * size + words[inner])
                n += len(grams[-1])
                if n >= _GATHERED:
                    yield from counted(grams)
                    grams, n = [], 0
        if n:
            yield from counted(grams)

    # A context's partial counts, from all tasks, go to the one task that adds them up and writes them.
    partial = coded.where(~F.col("held_out")).select("ids").mapInArrow(count, "shard int, gram binary, c binary")
    ranged = partial.repartitionById(shards, F.col("shard"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        held, most = 0, _GATHERED
        for grams, counts in rows_of(batches, "gram", "c"):
            for gram, c in zip(grams, counts):
                kept.append((np.cumsum(_unpacked(gram)), _unpacked(c)))
                held += len(kept[-1][0])
                if held > most:
                    kept = [_summed(kept)]
                    held = len(kept[0][0])
                    most = max(_GATHERED, 2 * held)
        if kept:
            shard = Level.written(folder, *_summed(kept), size)
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in shard], ["first", "last", "bits", "n", "sizes", "name"])

    found = ranged.mapInArrow(write, "first long, last long, bits long, n long, sizes array<long>, name string").collect()
    return Level(folder, [(r["first"], r["last"], r["bits"], r["n"], tuple(r["sizes"]), r["name"]) for r in found], size)


class Model:
    """Looks up log10 probabilities of tokens, the mapped files shared by all tasks of a machine."""

    def __init__(self, words: tuple, levels: list[Level], floor: int):
        self._counts, self._levels, self._floor = ByNumber(*words), levels, floor

    def __call__(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        logs = np.empty(len(flat))
        for at, words, _, said in _walk(flat, starts, self._levels):
            c = np.zeros(len(words))
            c[words >= 0] = self._counts(words[words >= 0])
            p = (c + 1) / self._floor
            for asked, shares, weights in said:
                # A context without successors (it cannot be one in training) leaves the shorter history's probability.
                p[asked] = shares + np.where(weights > 0, weights, 1.0) * p[asked]
            logs[at : at + len(words)] = np.log10(p)
        return logs
