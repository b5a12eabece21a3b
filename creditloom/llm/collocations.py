"""Phrase collocations by Toivonen's method, exact for every language.

A sample of the documents proposes the phrases that may be frequent, at a lowered threshold. One pass over all
documents then counts the proposed phrases and their negative border: the phrases that were not
proposed but whose two parts, less the last and less the first word, were. Every frequent phrase has frequent
parts, so none can hide behind the border; a border phrase that turns out frequent is a failure of the sample. It
joins the proposed ones, and a further pass counts what is new at the border, until no failure is left.

The proposed phrases are kept as a sharded perfect hash (:mod:`perfect_hash`) that tasks map, so they may be many.
A wrong hit there only makes the border wider. Occurrences are counted a few megabytes at a time and leave a task as sorted
64-bit hashes with their counts, packed by range of hashes; a range is added up by one task. Proposed phrases that
are frequent are spelled out from the sample, failures in the further passes, which meet few phrases. Two phrases
of the corpus with the same hash would be counted as one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from . import perfect_hash
from .common import bounded_batches, mixed, texts

LONGEST = 4
NO_LANGUAGE = "und"
#: One document in so many is in the sample.
SAMPLE = 8
_CHUNK_BYTES = 4_000_000
#: Text whose phrases one range of hashes holds; about as many distinct ones as a fifth of it has bytes.
_RANGE_BYTES = 16_000_000

# Fixed values: `.,;:!?` and \x0A-\x0D end a piece; space and tab part words; A-Z is lower-cased.
_END = 255  # no byte of UTF-8
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else 32 if c == 9 else _END if c in b".,;:!?" or 10 <= c <= 13 else c for c in range(256)
)
_MARK = bytes([_END])


def _slices(text: bytes | None) -> Iterator[bytes]:
    """A folded text in parts of a few megabytes, cut where a piece ends."""
    folded, start = (text or b"").translate(_FOLD), 0
    while len(folded) - start > _CHUNK_BYTES:
        cut = folded.rfind(_MARK, start, start + _CHUNK_BYTES)
        cut = cut if cut >= 0 else folded.find(_MARK, start + _CHUNK_BYTES)
        if cut < 0:
            break
        yield folded[start:cut]
        start = cut + 1
    yield folded[start:] if start else folded


@dataclass
class _Chunk:
    """Words of some documents of one language in a row, with a mark between pieces."""

    lang: str
    ids: np.ndarray  # of the words, by place
    names: list[bytes]  # by id
    hashes: np.ndarray  # by id, 0 for the mark

    @classmethod
    def of(cls, lang: str, parts: list[bytes]) -> _Chunk:
        flat = (_MARK.join(parts) + _MARK).replace(_MARK, b" " + _MARK + b" ")
        coded = pc.split_pattern(pa.array([flat], pa.large_binary()), pattern=" ").flatten().dictionary_encode()
        ids, names = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        if b"" in names:
            ids = ids[ids != names.index(b"")]
        salt = np.uint64(xxhash.xxh64_intdigest(lang, 1))  # not the words' own hash: a language may be named like a word
        own = np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names))
        own = mixed(own ^ salt) | np.uint64(1)
        if _MARK in names:
            own[names.index(_MARK)] = 0
        return cls(lang, ids, names, own)

    def grams(self) -> Iterator[tuple[int, np.ndarray]]:
        """(size, hash of the phrase of that size from each place on). Only phrases without a mark count."""
        h = found = self.hashes[self.ids]
        yield 1, found
        for size in range(2, LONGEST + 1):
            found = mixed(found[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[size - 1 :]) if len(found) else found
            yield size, found

    def phrase(self, place: int, size: int) -> bytes:
        return b" ".join([self.names[i] for i in self.ids[place : place + size].tolist()])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Chunk]:
    """The documents of a task by language; the largest language goes first when too much is held."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        for text, lang in zip(texts(batch.column("text")), batch.column("lang").to_pylist()):
            for part in _slices(text):
                held.setdefault(lang, []).append(part)
                sizes[lang] = sizes.get(lang, 0) + len(part)
                if sizes[lang] > _CHUNK_BYTES or len(sizes) > 1 and sum(sizes.values()) > 2 * _CHUNK_BYTES:
                    most = max(sizes, key=sizes.get)
                    yield _Chunk.of(most, held.pop(most))
                    del sizes[most]
    while held:
        yield _Chunk.of(*held.popitem())


class _Distinct:
    """The distinct phrases of one size at some places of a chunk."""

    def __init__(self, size: int, grams: np.ndarray, places: np.ndarray):
        coded = pa.array(grams[places]).dictionary_encode()
        self.size, self.places, self.length = size, places, len(grams)
        self.keys, self.back = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        self.n = np.bincount(self.back, minlength=len(self.keys))

    def spread(self, flags: np.ndarray) -> np.ndarray:
        """A flag per distinct phrase, as one per place of the chunk."""
        out = np.zeros(self.length, bool)
        out[self.places] = flags[self.back]
        return out

    def first(self) -> np.ndarray:
        """A place of each distinct phrase."""
        out = np.zeros(len(self.keys), np.int64)
        out[self.back] = self.places
        return out


_PACKED = "range int, size int, known boolean, lang string, keys binary, n binary"


def _packed(keys: np.ndarray, n: np.ndarray, size: int, known: bool, ranges: int) -> Iterator[pa.RecordBatch]:
    """Counts as one row per range of hashes."""
    if not len(keys):
        return
    order = np.argsort(keys)
    keys, n = keys[order], n[order].astype(np.int64)
    which = perfect_hash.shard_of(keys, ranges)
    cuts = np.r_[0, np.flatnonzero(np.diff(which)) + 1, len(keys)]
    rows = len(cuts) - 1
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(which[cuts[:-1]].astype(np.int32)),
            pa.array(np.full(rows, size, np.int32)),
            pa.array([known] * rows),
            pa.nulls(rows, pa.string()),
            pa.array([keys[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
            pa.array([n[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
        ],
        _FIELDS,
    )


def _named(chunk: _Chunk, found: _Distinct, kept: np.ndarray, frequent: bool, ranges: int) -> Iterator[pa.RecordBatch]:
    """The words of some distinct phrases: as :func:`_packed`, the size negative, names in place of counts.

    ``frequent`` says that they are known to be, else their counts in the same pass decide.
    """
    if not kept.any():
        return
    keys, places = found.keys[kept], found.first()[kept]
    order = np.argsort(keys)
    keys = keys[order]
    names = [chunk.phrase(place, found.size) for place in places[order].tolist()]
    which = perfect_hash.shard_of(keys, ranges)
    cuts = np.r_[0, np.flatnonzero(np.diff(which)) + 1, len(keys)].tolist()
    rows = len(cuts) - 1
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(which[cuts[:-1]].astype(np.int32)),
            pa.array(np.full(rows, -found.size, np.int32)),
            pa.array([frequent] * rows),
            pa.array([chunk.lang] * rows, pa.string()),
            pa.array([keys[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
            pa.array([b"\n".join(names[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary()),  # no word has a line end
        ],
        _FIELDS,
    )


_FIELDS = ["range", "size", "known", "lang", "keys", "n"]


def _totals(chunk: _Chunk) -> pa.RecordBatch:
    """Size 0: all words of a language."""
    n = np.array([(chunk.hashes[chunk.ids] != 0).sum()], np.int64).tobytes()
    row = ([0], pa.int32()), ([0], pa.int32()), ([True], pa.bool_()), ([chunk.lang], pa.string()), ([b""], pa.binary()), ([n], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(*column) for column in row], _FIELDS)


def _added(table: pa.Table, least: int) -> pa.Table:
    """The packed rows of one range added up; phrases below ``least`` go, and so do their names.

    A spelled phrase is a row of its own, with size -1.
    """
    table = table.combine_chunks()
    sizes, known = table["size"].to_numpy(), table["known"].to_numpy(zero_copy_only=False)
    kinds = {"key": pa.int64(), "size": pa.int32(), "known": pa.bool_(), "lang": pa.string(), "phrase": pa.string(), "n": pa.int64()}
    schema = pa.schema(list(kinds.items()))
    out: list[pa.Table] = []

    def add(keys, size, flag, lang, n, phrases=None):
        many = len(keys)
        columns = keys, np.full(many, size, np.int32), np.full(many, flag), pa.repeat(pa.scalar(lang, pa.string()), many), phrases or pa.nulls(many, pa.string()), n
        out.append(pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds.values())], schema))

    totals: dict[str, int] = {}
    for at in np.flatnonzero(sizes == 0).tolist():
        lang = table["lang"][at].as_py()
        totals[lang] = totals.get(lang, 0) + int(np.frombuffer(table["n"][at].as_py(), np.int64)[0])
    for lang, n in totals.items():
        add([0], 0, True, lang, [n])
    for size in range(1, LONGEST + 1):
        for flag in (False, True):
            rows = table.take(np.flatnonzero((sizes == size) & (known == flag)))
            keys = np.frombuffer(b"".join(rows["keys"].to_pylist()), np.uint64)
            if not len(keys):
                continue
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], np.frombuffer(b"".join(rows["n"].to_pylist()), np.int64)[order]
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            n = np.add.reduceat(n, starts)
            kept = n >= least
            add(keys[starts][kept].view(np.int64), size, flag, None, n[kept])
    counted = np.sort(np.r_[pa.concat_tables([schema.empty_table(), *out])["key"].to_numpy(), np.iinfo(np.int64).max])
    spelled: dict[str, dict[int, str]] = {}
    for at in np.flatnonzero(sizes < 0).tolist():
        keys = np.frombuffer(table["keys"][at].as_py(), np.int64)
        wanted = np.flatnonzero(known[at] | (counted[counted.searchsorted(keys)] == keys))
        if len(wanted):
            names = table["n"][at].as_py().split(b"\n")
            spelled.setdefault(table["lang"][at].as_py(), {}).update((int(keys[i]), names[i].decode()) for i in wanted.tolist())
    for lang, names in spelled.items():
        add(list(names), -1, True, lang, np.zeros(len(names), np.int64), list(names.values()))
    return pa.concat_tables([schema.empty_table(), *out])


def _counted(docs: DataFrame, run, least: int) -> DataFrame:
    """(key, size, known, lang, n) of the phrases that ``run`` counts, ``least`` and more."""
    rows = docs.select("lang", "text").mapInArrow(run, _PACKED)
    counted = rows.groupBy("range").applyInArrow(lambda t: _added(t, least), "key long, size int, known boolean, lang string, phrase string, n long")
    return materialize(counted, "counted")


def _words(docs: DataFrame, ranges: int, least: int) -> DataFrame:
    """Counts of all words."""

    def run(batches):
        for chunk in _chunks(batches):
            words = np.flatnonzero(chunk.hashes)
            n = np.bincount(chunk.ids, minlength=len(chunk.hashes))[words]
            yield from _packed(chunk.hashes[words][n > 0], n[n > 0], 1, True, ranges)

    return _counted(docs, run, least)


def _made_of(docs: DataFrame, words: perfect_hash.Index, ranges: int, least: int) -> DataFrame:
    """Counts of all longer phrases made of the given words."""

    def run(batches):
        probe = words.reader()
        for chunk in _chunks(batches):
            one = probe.has(chunk.hashes)[chunk.ids] & (chunk.hashes[chunk.ids] != 0)
            flags = one
            for size, grams in chunk.grams():
                if size > 1:
                    flags = flags[:-1] & one[size - 1 :]
                    found = _Distinct(size, grams, np.flatnonzero(flags))
                    yield from _packed(found.keys, found.n, size, True, ranges)

    return _counted(docs, run, least)


class _Any:
    """Membership in any of some indexes."""

    def __init__(self, indexes: Sequence[perfect_hash.Index]):
        self._readers = [index.reader() for index in indexes]

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), bool)
        for reader in self._readers:
            left = np.flatnonzero(~out)
            out[left] = reader.has(keys[left])
        return out


def _among(probe: _Any, chunk: _Chunk) -> np.ndarray:
    """Per place, whether its word is a member."""
    return (probe.has(chunk.hashes) & (chunk.hashes != 0))[chunk.ids]


def _border(docs: DataFrame, proposed: perfect_hash.Index, ranges: int, least: int) -> DataFrame:
    """Counts of the proposed phrases and of their border, and of all words per language.

    The longest border phrases are spelled too: they are few, and no further pass looks for them.
    """

    def run(batches):
        probe = _Any([proposed])
        for chunk in _chunks(batches):
            yield _totals(chunk)
            inside = np.zeros(0, bool)
            for size, grams in chunk.grams():
                # All words are at the border: their own parts are empty.
                places = np.flatnonzero(grams) if size == 1 else np.flatnonzero(inside[:-1] & inside[1:])
                found = _Distinct(size, grams, places)
                known = probe.has(found.keys)
                inside = found.spread(known)
                for flag in (False, True):
                    yield from _packed(found.keys[known == flag], found.n[known == flag], size, flag, ranges)
                if size == LONGEST:
                    yield from _named(chunk, found, ~known, False, ranges)

    return _counted(docs, run, least)


def _widened(docs: DataFrame, proposed: Sequence[perfect_hash.Index], fresh: perfect_hash.Index, ranges: int, least: int) -> DataFrame:
    """Counts of what the fresh phrases, proposed now themselves, bring to the border: phrases with a fresh part.

    All these are spelled, and so are the fresh phrases, which the first pass did not spell.
    """

    def run(batches):
        probe, newer = _Any(proposed), _Any([fresh])
        for chunk in _chunks(batches):
            every, parts = _among(probe, chunk), np.zeros(0, np.uint64)
            whole, new = every, _among(newer, chunk)
            words = _Distinct(1, chunk.hashes[chunk.ids], np.flatnonzero(new))
            yield from _named(chunk, words, np.ones(len(words.keys), bool), True, ranges)
            for size, grams in chunk.grams():
                if size > 1:
                    whole = whole[:-1] & every[size - 1 :]
                    places = np.flatnonzero((new[:-1] | new[1:]) & whole)
                    places = places[probe.has(parts[places]) & probe.has(parts[places + 1])]
                    found = _Distinct(size, grams, places)
                    known = probe.has(found.keys)
                    for flag in (False, True):
                        yield from _packed(found.keys[known == flag], found.n[known == flag], size, flag, ranges)
                    yield from _named(chunk, found, np.ones(len(known), bool), False, ranges)
                    at = np.flatnonzero(whole) if size < LONGEST else places[:0]
                    new = np.zeros(len(grams), bool)
                    new[at] = newer.has(grams[at])
                    own = _Distinct(size, grams, np.flatnonzero(new))
                    yield from _named(chunk, own, np.ones(len(own.keys), bool), True, ranges)
                parts = grams

    return _counted(docs, run, least)


def _index(keys: DataFrame) -> perfect_hash.Index:
    keys = materialize(keys.select("key").distinct(), "phrase-keys")
    return perfect_hash.build(keys, keys.count(), label="phrase-index")


def _spelled(docs: DataFrame, frequent: perfect_hash.Index, wanted: perfect_hash.Index) -> DataFrame:
    """(key, lang, phrase) of the wanted phrases, those that occur. Their words must be among the frequent ones."""

    def run(batches):
        probe, reader = _Any([frequent]), wanted.reader()
        for chunk in _chunks(batches):
            every = whole = _among(probe, chunk)
            for size, grams in chunk.grams():
                whole = whole if size == 1 else whole[:-1] & every[size - 1 :]
                places = np.flatnonzero(whole)
                found = _Distinct(size, grams, places[reader.has(grams[places])])
                names = [chunk.phrase(place, size) for place in found.first().tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.keys.view(np.int64)), pa.array([chunk.lang] * len(names), pa.string()), pa.array(names, pa.binary()).cast(pa.string())],
                    ["key", "lang", "phrase"],
                )

    return docs.select("lang", "text").mapInArrow(run, "key long, lang string, phrase string").distinct()


def frequent_phrases(docs: DataFrame, least: int = 30, sample: int = SAMPLE) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, n) of all phrases of 1 to 4 words found ``least`` times or more, and (lang, n) of all words.

    ``docs`` has doc_id, lang and text, no lang null. One document in ``sample`` proposes; its threshold is what a phrase
    that is just frequent stays below in about one sample of nine. The result does not depend on either.
    """
    expected = least / sample
    lowered = max(2, int(expected - 1.5 * math.sqrt(expected)))
    sampled = F.pmod(F.xxhash64("doc_id", "text"), F.lit(sample)) == 0
    part = materialize(docs.where(sampled).select("lang", "text"), "sample")
    bytes_ = part.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    few, many = (max(1, -(-bytes_ * times // _RANGE_BYTES)) for times in (1, sample))
    words = _words(part, few, lowered)
    longer = _made_of(part, _index(words), few, lowered)
    proposed = [_index(words.select("key").unionByName(longer.select("key")))]
    passes = [_border(docs, proposed[0], many, least)]
    while not (failures := passes[-1].where(f"NOT known AND size BETWEEN 1 AND {LONGEST - 1}")).isEmpty():
        proposed.append(_index(failures))
        passes.append(_widened(docs, proposed, proposed[-1], many, least))
    totals = passes[0].where("size = 0").select("lang", "n")
    # A wrong hit in the index of failures may have a phrase counted, to the same number, in two passes.
    found = reduce(DataFrame.unionByName, passes).where("size > 0").groupBy("key", "size").agg(F.max("n").alias("n"))
    found = materialize(found, "frequent")
    keys = _index(found)
    spelled = reduce(DataFrame.unionByName, passes).where("size = -1").select("key", "lang", "phrase")
    names = materialize(_spelled(part, keys, keys).unionByName(spelled).dropDuplicates(["key"]), "spelled")
    lacking = found.join(names, "key", "left_anti")
    if not lacking.isEmpty():  # a wrong hit took a failure for a proposed phrase
        rest = _spelled(docs.where(~F.coalesce(sampled, F.lit(False))), keys, _index(lacking))
        names = names.unionByName(rest)
    # A wrong hit in the index of keys may spell a phrase that is not frequent; it has no count.
    return materialize(found.join(names, "key").drop("key"), "phrases"), totals


def scored(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, l, r, score) of each phrase of two words and more, at its lowest-scoring cut."""
    cuts = phrases.where("size > 1").selectExpr("lang", "phrase", "size", "n AS a", "explode(sequence(1, size - 1)) AS cut")
    cuts = cuts.selectExpr("*", "substring_index(phrase, ' ', cut) AS head", "substring_index(phrase, ' ', cut - size) AS tail")
    heads = phrases.selectExpr("lang", "phrase AS head", "n AS l")
    tails = phrases.selectExpr("lang", "phrase AS tail", "n AS r")
    score = "(2000000 * CAST(a AS DECIMAL(20, 0))) div (l + r) AS score"
    lowest = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).selectExpr("*", score)
    lowest = lowest.groupBy("lang", "phrase").agg(
        F.first("size").alias("size"), F.first("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("low")
    )
    return lowest.selectExpr("lang", "phrase", "size", "a", "low.l AS l", "low.r AS r", "low.score AS score")


def _inside(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, most): the highest count of a longer phrase that holds this one."""
    parts = phrases.where("size > 2").selectExpr("lang", "n", "size", "split(phrase, ' ') AS words", "explode(sequence(2, size - 1)) AS m")
    parts = parts.selectExpr("lang", "n", "words", "m", "explode(sequence(1, size - m + 1)) AS i")
    parts = parts.selectExpr("lang", "array_join(slice(words, i, m), ' ') AS phrase", "n")
    return parts.groupBy("lang", "phrase").agg(F.max("n").alias("most"))


def collocations(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    least: int = 30,
    top: int = 2000,
    covered: int = 80,
    sample: int = SAMPLE,
) -> DataFrame:
    """The ``top`` phrases of 2 to 4 words of each language: lang, rank, phrase, a, l, r, n, score.

    Phrases do not cross the end of a piece. a counts the phrase, l and r the parts of its lowest-scoring cut, n all words of
    the language. A phrase inside a longer one that is at least ``covered`` per cent as frequent is left out. Ranks go by score,
    then count, both descending, then by the phrase's UTF-8 bytes. A null language is ``und``; a null or empty text
    has no words; a language without frequent phrases has no rows, and so has an empty table. Rows that repeat, or
    have a null id, all count. Other columns are not read. A text of any length is taken a few megabytes at a time, cut
    where a piece ends; a single piece is held whole.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.select(
        F.col(f"`{key}`").cast("string").alias("doc_id"),
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    phrases, totals = frequent_phrases(docs, least, sample)
    outer = scored(phrases).join(_inside(phrases), ["lang", "phrase"], "left")
    outer = outer.where(f"most IS NULL OR 100 * CAST(most AS DECIMAL(20, 0)) < {covered} * CAST(a AS DECIMAL(20, 0))")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = outer.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    ranked = ranked.join(totals, "lang").withColumn("rank", F.col("rank").cast("long"))
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
