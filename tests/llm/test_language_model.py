"""How the sequences of the language model travel and what it leaves in the shared folder."""

import os
import zlib

import numpy as np
from pyspark.sql import functions as F

from creditloom.llm import byte_bpe, language_model
from creditloom.session import scratch_dir


def test_counts_travel_in_few_bytes_and_come_back():
    source = np.random.default_rng(1)
    gram, c = np.unique(source.integers(0, 2**40, 100_000)), None
    c = source.geometric(0.9, len(gram))
    parts = [language_model._packed(np.diff(gram, prepend=0)), language_model._packed(c)]
    assert np.array_equal(np.cumsum(language_model._unpacked(parts[0])), gram) and np.array_equal(language_model._unpacked(parts[1]), c)
    assert sum(len(zlib.compress(p, 1)) for p in parts) < 5 * len(gram)
    again = language_model._summed([(gram, c), (gram[::2], c[::2]), (gram[5:6] + 1, c[:1])])
    assert np.array_equal(again[0], np.union1d(gram, gram[5:6] + 1)) and again[1].sum() == c.sum() + c[::2].sum() + c[0]


def test_merging_in_small_steps_changes_nothing_and_unused_tables_go(spark, monkeypatch):
    texts = [" ".join(f"w{(i * k * 7919) % 83}" for k in range(i % 97)) for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    before = set(os.listdir(scratch_dir(spark)))
    whole = {r.doc_id: r for r in language_model.scored(docs, F.col("doc_id") % 5 == 0, order=3).collect()}
    left = {name.split("-")[0] for name in set(os.listdir(scratch_dir(spark))) - before}
    assert not left & {"vocabulary", "words", "pre"}
    for name, value in (("_GATHERED", 700), ("_CHUNK", 300), ("_SHARD", 2000)):
        monkeypatch.setattr(language_model, name, value)
    small = {r.doc_id: r for r in language_model.scored(docs, F.col("doc_id") % 5 == 0, order=3).collect()}
    assert len(whole) == 300 and all(abs(small[k].score - r.score) < 1e-3 * max(1, -r.score) and small[k][:6] == r[:6] for k, r in whole.items())


def test_words_are_looked_up_in_bulk(spark, monkeypatch):
    rows = [(i, f"w{i}", [i, 2 * i, 7]) for i in range(500)] + [(500, "naïve 北京", [500, 1, 2])]
    words = spark.createDataFrame(rows, "n int, word string, ids array<int>").select(F.xxhash64("word").alias("key"), "word", "ids")
    monkeypatch.setattr(byte_bpe, "_SHARD_BYTES", 2000)
    look_up = byte_bpe.Dictionary(byte_bpe.stored(words.repartition(3)))
    asked = [b"w3", b"none", "naïve 北京".encode(), b"w499", b"w0", b""]
    assert look_up.table(asked, 3).tolist() == [[3, 6, 7], [-1] * 3, [500, 1, 2], [499, 998, 7], [0, 0, 7], [-1] * 3]
    assert look_up.table([], 3).shape == (0, 3) and byte_bpe.Dictionary([]).table([b"x"], 2).tolist() == [[-1, -1]]


def test_clashing_keys_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(byte_bpe.xxhash, "xxh64_intdigest", lambda word, seed=0: 1)
    words = spark.createDataFrame([(1, w, [i]) for i, w in enumerate("abcd")], "key long, word string, ids array<int>")
    look_up = byte_bpe.Dictionary(byte_bpe.stored(words))
    assert look_up.table([b"d", b"x", b"a", b"b"], 1).ravel().tolist() == [3, -1, 0, 1]
