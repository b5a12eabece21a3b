"""The corpus pipeline on planted documents: each stage on its own input, then all of them."""

import os
import random
import time

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from brute import words
from pyspark.sql import functions as F

from creditloom.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, lang string, text string, n_chars int"
_LIST = "the of and river stone cloud winter garden letter market engine window paper music bridge season".split()


def _prose(seed, n):
    source = random.Random(seed)
    return [source.choice(_LIST) + (source.choice("abcdefgh") * source.randrange(4)) for _ in range(n)]


ITEM = " ".join(_prose(90, 40)) + ". The answer is forty."
SHARED = _prose(91, 80)
LONG = _prose(1, 400)
TEXTS = {
    1: " ".join(LONG),
    2: " ".join(LONG[:200] + ["changed"] + LONG[201:]),
    3: " ".join(LONG),
    4: None,
    5: "",
    6: "too short",
    7: " ".join(["buy", "it", "now", "and", "here"] * 40),
    8: " ".join(_prose(2, 150) + SHARED + _prose(3, 150)),
    9: " ".join(_prose(4, 150) + SHARED + _prose(5, 150)),
    10: " ".join(_prose(6, 150)) + " " + ITEM + " " + " ".join(_prose(7, 150)),
    11: " ".join(_prose(8, 300)) + " naïve 北京",
    12: " ".join(_prose(9, 300)),
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, "en", t, None if t is None else len(t)) for i, t in TEXTS.items()]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def steps(spark, folder):
    """(columns, {doc_id: row}) after each stage."""
    found, docs = {}, spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, folder), name.replace(" ", "-"))
        found[name] = docs.columns, {r.doc_id: r for r in docs.collect()}
    return found


def test_each_stage_takes_what_was_planted_for_it_and_no_more(steps):
    kept = {name: set(rows) for name, (_, rows) in steps.items()}
    assert kept["quality rules"] == {1, 2, 3, 8, 9, 10, 11, 12}
    assert kept["near duplicates"] == {1, 8, 9, 10, 11, 12}
    assert kept["repeated passages"] == kept["near duplicates"]
    assert kept["decontamination"] == kept["tokens"] == {1, 8, 9, 11, 12}


def test_a_passage_stays_in_its_first_document_only(steps):
    rows = steps["repeated passages"][1]
    assert words(rows[9].text) == _prose(4, 150) + _prose(5, 150)
    assert all(r.text == TEXTS[i] for i, r in rows.items() if i != 9)
    assert all(r.n_chars == len(r.text) for r in rows.values())


def test_all_stages_but_the_last_return_the_columns_of_documents(steps):
    assert all(columns == ["doc_id", "lang", "text", "n_chars"] for name, (columns, _) in steps.items() if name != "tokens")


def test_tokens_are_the_library_s(steps):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(PATH), special_tokens={})
    before, rows = steps["decontamination"][1], steps["tokens"][1]
    for i, r in rows.items():
        assert r.ids == library.encode_ordinary(before[i].text) and r.n_tokens == len(r.ids) and r.exact


def test_run_gives_what_its_stages_give(spark, folder, steps):
    assert {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, folder).collect()} == {i: list(r.ids) for i, r in steps["tokens"][1].items()}


def test_an_empty_table_passes_all_stages(spark, folder, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def _shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for folder in folders for _, _, files in os.walk(folder) for f in files if f.startswith("shuffle_")}


def test_shuffle_files_go_with_their_stage(spark, folder, monkeypatch):
    """When a stage begins, none of the files that the stages before it wrote are left."""
    left, before = [], _shuffle_files(spark)

    def begins(spark, docs, folder):
        end = time.monotonic() + 20
        while (more := _shuffle_files(spark) - before) and time.monotonic() < end:
            time.sleep(0.2)
        left.append(len(more))
        return docs.groupBy("doc_id").agg(*(F.first(c).alias(c) for c in docs.columns if c != "doc_id")).select(docs.columns)

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("first", begins), corpus_pipeline.STAGES[1], ("second", begins), ("third", begins)])
    corpus_pipeline.run(spark, folder)
    assert left == [0, 0, 0]
