"""Line dedup, lexical search and collocations against brute force, on odd rows."""

import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from creditloom.llm import collocations, lexical_search, line_dedup, perfect_hash
from creditloom.llm.common import BATCH_BYTES

SCHEMA = "doc_id long, text string, lang string, n long, `key` string, item array<int>, score double, `rank` int"


def _texts():
    source = random.Random(11)
    word = lambda: source.choice("the of and stone River naïve Straße 北京 window paper x1".split()) + source.choice(["", "", "s", "9"])
    found = [" ".join(word() for _ in range(source.randrange(1, 60))) for _ in range(150)]
    found += ["  Read MORE \t\n" + t + "\nread more\n\n" for t in found[:40]]
    found += ["good morning, dear reader! good morning dear reader\tgood  morning" + "." * (i % 2) for i in range(45)]
    found += [None, "", "\n", "\x0b \x0c", "...", "same", "same", "the the the the the", "a b c\x1fd", "x" * 300_000, "stone river " * 30_000]
    return found


@pytest.fixture(scope="module")
def rows():
    texts = _texts()
    ids = [*range(len(texts) - 3), 7, 7, None]
    return [(i, t, [None, "en", "und", "fr"][k % 4], k, "k", [1], 0.5, 3) for k, (i, t) in enumerate(zip(ids, texts))]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _key(line):
    return re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate({c: c + 32 for c in range(65, 91)})


def test_lines_of_many_documents_go(docs, rows, empty):
    for least, chars in ((10, 1), (2, 5), (1, 1)):
        found = Counter(k for r in rows for k in {_key(x) for x in (r[1] or "").split("\n")})
        want = []
        for r in rows:
            lines = (r[1] or "").split("\n")
            kept = [x for x in lines if len(_key(x)) < chars or found[_key(x)] < least]
            want.append((r[0], "\n".join(kept), len(lines), len(lines) - len(kept)))
        got = [tuple(r) for r in line_dedup.deduped(docs, min_docs=least, min_chars=chars).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert line_dedup.deduped(empty).collect() == []


def test_perfect_hash_gives_each_key_its_own_slot():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**64, 50_000, np.uint64))
    inside, outside = keys[::2], keys[1::2]
    levels = perfect_hash.Levels.of(inside)
    assert sorted(levels.slots(inside).tolist()) == list(range(len(inside)))
    assert levels.slots(outside).max() < len(inside) and not len(levels.strays)
    assert len(levels.words) * 64 < 4.5 * len(inside)


def test_equal_keys_are_told_apart_by_their_fingerprint(spark, monkeypatch):
    monkeypatch.setattr(perfect_hash, "ENTRIES", 100)
    rows = [(i * 2**50 - 2**62, i * 1_000_003**2, i + 1) for i in range(5000)] + [(77, 1, 500), (77, 2, 600)]
    index = perfect_hash.build(spark.createDataFrame(rows, "key long, mark long, n long"), len(rows), "<u8")
    keys, marks = (np.array([r[c] for r in rows], np.int64).view(np.uint64) for c in (0, 1))
    assert len(index.paths) > 40
    assert index.reader().counts(keys, marks).tolist() == [r[2] for r in rows]
    assert index.reader().counts(keys + np.uint64(1), marks + np.uint64(9)).sum() == 0
    assert index.reader().counts(keys, marks + np.uint64(9)).sum() == 0
    assert perfect_hash.build(spark.createDataFrame([], "key long"), 0).reader().has(keys).sum() == 0


def _terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def _search(rows, items, k):
    docs = [(r[0], Counter(_terms(r[1]))) for r in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n, words = len(docs), sum(size for _, _, size in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, size in docs:
            m = 100 - 75 + (75 * size * n) // words
            s = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, q in Counter(_terms(text)).items() if c[t])
            if s > 0 and i is not None:
                scored.append((-s, i))
        out += [(item, at + 1, i, -s) for at, (s, i) in enumerate(sorted(scored)[:k])]
    return out


def test_search_ranks_as_scoring_everything_does(spark, docs, rows, empty):
    asked = ["stone river", "The STONE the stone 北京", "naïve window? paper9", None, "", "nowhere", "good morning", "x1 x1s x19", "same", "of and the"]
    items = [(i, t) for i, t in enumerate(asked)] + [(None, "window"), (3, "paper")]
    table = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    for options in ({}, {"max_terms": 4}, {"cells": 300, "owners": 3}, {"owners": 1}):
        for k in (3, 10):
            got = [tuple(r) for r in lexical_search.search(docs, table, k, **options).collect()]
            assert sorted(got, key=repr) == sorted(_search(rows, items, k), key=repr), options
    assert lexical_search.search(empty, table).collect() == []
    assert lexical_search.search(docs, table.limit(0)).collect() == []


def _collocations(rows, least, top, covered):
    counts, total, out = defaultdict(Counter), Counter(), []
    for r in rows:
        lang = r[2] or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (r[1] or "").translate({c: c + 32 for c in range(65, 91)})):
            own = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(own)
            counts[lang].update(tuple(own[i : i + k]) for k in range(1, 5) for i in range(len(own) - k + 1))
    for lang, f in counts.items():
        kept = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {p[i : i + k] for p, a in kept.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= covered * f[p[i : i + k]]}
        found = []
        for p, a in kept.items():
            if p not in gone:
                score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, total[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])]
    return out


@pytest.mark.parametrize("sample", [1, 3, 1000])
def test_collocations_do_not_depend_on_the_sample(docs, rows, sample):
    """A sample of one document in 1000 proposes next to nothing: all comes from further passes."""
    for least, top in ((5, 2000), (30, 7)):
        got = [tuple(r) for r in collocations.collocations(docs, least=least, top=top, sample=sample).collect()]
        assert sorted(got) == sorted(_collocations(rows, least, top, 80))


def test_languages_named_like_words_and_empty_tables(spark, empty):
    rows = [(i, "en es de. es en de", lang, 0, "", None, None, 0) for i in range(20) for lang in ("en", "es", "de")]
    table = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in collocations.collocations(table, least=3).collect()]
    assert sorted(got) == sorted(_collocations(rows, 3, 2000, 80)) != []
    assert collocations.collocations(empty).collect() == []


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "_CHUNK_BYTES", 50)
    text = ", ".join("one two three" for _ in range(40)).encode()
    parts = list(collocations._slices(text))
    assert len(parts) > 8 and all(p.split(b"\xff")[0].split() == b"one two three".split() for p in parts)
    assert sum(p.count(b"one two three") for p in parts) == 40


def test_phrases_are_counted_in_bounded_memory(spark, docs):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)
    collocations.collocations(docs, least=3)
    assert int(spark.conf.get(name)) == BATCH_BYTES

    keys = np.arange(1, 300_001, dtype=np.uint64)
    rows = {"range": [0] * 2, "size": [2, -4], "known": [True, False], "lang": [None, "en"]}
    rows |= {"keys": [keys.tobytes(), keys[:2].tobytes()], "n": [np.full(len(keys), 30, np.int64).tobytes(), b"a b c d\ne f g h"]}
    table = pa.table(rows, pa.schema([("range", pa.int32()), ("size", pa.int32()), ("known", pa.bool_()), ("lang", pa.string()), ("keys", pa.binary()), ("n", pa.binary())]))
    tracemalloc.start()
    found = collocations._added(table, 30)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.num_rows == 300_002 and found["phrase"].drop_null().to_pylist() == ["a b c d", "e f g h"]
    assert peak < 16 * 300_000 * 6  # a few copies of what came in, no Python object per phrase
