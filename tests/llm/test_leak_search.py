"""The latent basis and the choice of candidates of the benchmark search against brute force."""

import random

import numpy as np
import pytest

from creditloom.llm import decontamination


def _texts(n):
    source = random.Random(3)
    return [" ".join(f"w{min(source.randrange(60), source.randrange(90))}" for _ in range(source.randrange(200))) for _ in range(n)]


@pytest.mark.parametrize("paired", [4096, 20, 0])
def test_blocks_counted_in_pairs_give_the_sum_over_all_blocks(spark, monkeypatch, paired):
    monkeypatch.setattr(decontamination, "_COUNTED", 500)
    texts, weights = _texts(60), {f"w{i}".encode(): 1 + i / 50 for i in range(50)}
    rows = []
    for text in texts:
        words = text.encode().split()
        for at in range(0, len(words), decontamination.STRIDE):
            rows.append([words[at : at + decontamination.STRIDE].count(w) * idf for w, idf in weights.items()])
    a, idf = np.array(rows), np.array(list(weights.values()))
    start = np.random.default_rng(5).standard_normal((50, 8))
    wanted = np.linalg.qr(a.T @ (a @ start))[0]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = decontamination.latent_basis(docs, weights, rank=8, paired=paired)
    assert np.allclose(found, wanted, atol=1e-9)


def test_candidates_hold_enough_words_around_them_and_no_others_are_projected():
    source = random.Random(4)
    lengths = [source.randrange(5, 80) for _ in range(30)]
    telling = [[source.randrange(300) for _ in range(n)] for n in lengths]
    needed = 0.55 * np.array(lengths)
    vocabulary = {b"w%d" % i: i for i in range(300)}
    texts = []
    for _ in range(20):
        words = [f"w{source.randrange(2000)}" for _ in range(source.randrange(300))]
        at = source.randrange(len(words) + 1)
        texts.append(" ".join([*words[:at], *(f"w{w}" for w in source.choice(telling)), *words[at:]]).encode())
    word, block, starts = decontamination.blocks(texts, vocabulary)
    wanted = set()
    for text, first, last in zip(texts, starts, starts[1:]):
        own = decontamination.tokens(text)
        for p in range(first, last):
            at = int(p - first) * decontamination.STRIDE
            for q, n in enumerate(lengths):
                around = own[max(0, at - n) : at + 2 * decontamination.STRIDE + n]
                if sum(vocabulary.get(w, -1) in telling[q] for w in around) >= needed[q]:
                    wanted.add((int(p), q))
    found = set(zip(*(x.tolist() for x in decontamination._Overlap(telling, lengths, needed, 300)(word, block, starts[-1]))))
    assert wanted and wanted <= found
    assert len(found) < 0.2 * starts[-1] * len(lengths)
