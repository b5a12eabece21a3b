"""Each text operator against brute force, on rows with nulls, empty and long texts, ties and repeats."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter

import public_tokenizers
import pytest
import regex
import tiktoken
from brute import components, language_scores, phrases, quality, unigram_tokens, url, words
from pyspark.sql import functions as F

from creditloom.llm import (
    byte_bpe,
    decontamination,
    html_extraction,
    language_model,
    license_scan,
    minhash_dedup,
    quality_rules,
    substring_dedup,
    token_counts,
    url_filter,
)
from creditloom.llm.queries import URL_RULES

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, n long, word string, `key` string, h array<int>, score double"


def _prose(seed, n):
    source = random.Random(seed)
    return [source.choice("the of and river stone cloud winter garden letter market Straße naïve engine window paper 北京 music".split()).lower() + str(source.randrange(40)) for _ in range(n)]


def _texts():
    long, passage = _prose(1, 400), _prose(2, 80)
    near = long[:200] + ["changed"] + long[201:]
    return {
        1: " ".join(long),
        2: " ".join(near),
        3: " ".join(long),
        4: None,
        5: "",
        6: " \t\n ",
        7: "two words",
        8: "Two WORDS",
        9: "one",
        10: " ".join(_prose(3, 120) + passage + _prose(4, 120)),
        11: " ".join(_prose(5, 120) + passage + _prose(6, 120)),
        12: "the MIT License and, again, the mit license. GNU General Public License; cc by. Apache License",
        13: "a b c d e f g h\na b c d e f g h\n# $ x y z # $ %",
        14: "naïve\u00a0Straße 北京 \U0001f600 ###  x" * 3,
        15: "x" * 5000,
        16: "the of and to in the of and to in the of and to in",
    }


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, i, "w", "k", [1], 0.5) for i, t in _texts().items()]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Repeated rows and null ids."""
    rows = [(1, "one two three four", 0, "", "", None, None)] * 2 + [(None, "one two three four", 0, "", "", None, None), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def test_near_duplicates_are_those_of_all_pairs(docs):
    for width, share in ((3, (85, 100)), (5, (80, 100))):
        found = {r.doc_id: r for r in minhash_dedup.near_duplicates(docs, width=width, share=share).collect()}
        wanted = components(_texts(), width, *share)
        assert {i: r.component_id for i, r in found.items()} == wanted
        assert all(r.kept == (i == wanted[i]) for i, r in found.items())


def test_copies_that_nearly_match_do_not_meet_all_with_all(spark, monkeypatch):
    """400 texts of 90 common and 10 own words (0.818 alike, 0.85 is asked for), and two that are alike enough."""
    common = " ".join(f"c{k}" for k in range(90))
    rows = [(i, f"{common} " + " ".join(f"own{i}x{k}" for k in range(10))) for i in range(400)]
    rows += [(400 + i, f"{common} " + " ".join(f"last{k + i}" for k in range(8))) for i in range(2)]
    compared = []
    kept = minhash_dedup.confirmed
    monkeypatch.setattr(minhash_dedup, "confirmed", lambda pairs, *rest: (compared.append(pairs.count()), kept(pairs, *rest))[1])
    found = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=1, share=(85, 100)).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: min(i, 400) for i in range(402)}
    assert sum(compared) <= 100 * len(rows)


@pytest.mark.parametrize("batch", [1, 2, 5, 100])
def test_sets_with_other_neighbours_are_told_once(spark, batch):
    keys = [b"aaaa", b"aaaa", b"bbbb", b"cccc", b"cccc", b"cccc", b"cccc", b"dddd", b"eeee", b"eeee", b"ffff", b"gggg"]
    rows = [(0, bytearray(k * 10), bytearray(b"%02d" % i)) for i, k in enumerate(keys)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        found = minhash_dedup.closest(spark.createDataFrame(rows, "order int, key binary, node binary").coalesce(1), 4).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted((int(r.a), int(r.b)) for r in found if r.a) == [(0, 1), (3, 4), (4, 5), (5, 6), (8, 9)]
    assert sorted(int(r.node) for r in found if r.node) == [0, 1, 3, 4, 5, 6, 10, 11]  # three of a kind, and the ends


def test_licence_phrases_are_counted_everywhere(docs):
    table = [(t.words, t.label) for t in license_scan.PHRASES]
    for r in license_scan.scan(docs).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == phrases(_texts()[r.doc_id], table)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_quality_counts(docs):
    for r in quality_rules.judged(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == quality(_texts()[r.doc_id]), r
        assert not (r.base_failed and r.kept)


def test_trie_counts_are_those_of_each_word_alone(docs):
    scores = token_counts.unigram_scores(PATH)
    for r in token_counts.counted(docs, scores, public_tokenizers.PATTERN).collect():
        own = [w.encode() for w in regex.findall(public_tokenizers.PATTERN, _texts()[r.doc_id] or "")]
        assert (r.n_pre_tokens, r.n_tokens) == (len(own), sum(unigram_tokens(w, scores) for w in own))


@pytest.mark.parametrize("text", ["", "a", "lowering the banner", "naïve北京" * 30])
def test_a_walk_does_not_depend_on_the_words_before(text):
    scores = token_counts.unigram_scores(PATH)
    walk = token_counts.Walk(scores)
    for word in sorted({text.encode()[: i + 1] for i in range(len(text))}):
        assert walk(word) == unigram_tokens(word, scores)


def test_encoding_is_the_library_s_and_round_trips(docs):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = byte_bpe.encode(docs, PATH, public_tokenizers.PATTERN)
    for r in found.select("doc_id", "ids", F.sha2(byte_bpe.decoded("ids", PATH), 256).alias("back")).collect():
        text = _texts()[r.doc_id] or ""
        assert r.ids == library.encode_ordinary(text)
        assert r.back == hashlib.sha256(text.encode()).hexdigest()


def test_both_folds_agree(docs):
    short = docs.where("length(text) < 200")
    native = byte_bpe.encode(short, PATH, public_tokenizers.PATTERN, native=True).collect()
    assert sorted(native) == sorted(byte_bpe.encode(short, PATH, public_tokenizers.PATTERN).collect())


def test_scores_are_those_of_plain_counting(docs):
    held_out = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    condition = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    wanted = language_scores(_texts(), held_out)
    for r in language_model.scored(docs, condition).collect():
        n, known, total, base, score = wanted[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held_out(r.doc_id), n, known, total)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score, abs=2e-4 * n)


@pytest.mark.parametrize("order", [1, 3, 4])
def test_scores_of_longer_histories_are_those_of_plain_counting(docs, order, monkeypatch):
    monkeypatch.setattr(language_model, "_SHARD", 300)
    monkeypatch.setattr(language_model, "_CHUNK", 77)
    tokens = {i: [*((t or "").lower().encode().split()), b"\n"] for i, t in _texts().items()}
    train = [own for i, own in tokens.items() if i % 3]
    c = Counter(tuple(own[i : i + n]) for own in train for n in range(1, order + 1) for i in range(len(own) - n + 1))
    after = Counter(g[:-1] for g in c)
    total, size = sum(map(len, train)), after[()]

    def p(history, w):
        if not history:
            return (c[w,] + 1) / (total + size + 1)
        lower = p(history[1:], w)
        return max(c[*history, w] - 0.75, 0) / c[history] + 0.75 * after[history] / c[history] * lower if history in after else lower

    found = language_model.scored(docs, F.col("doc_id") % 3 == 0, order=order).collect()
    assert len(found) == len(tokens)
    for r in found:
        own = tokens[r.doc_id]
        wanted = sum(math.log10(p(tuple(own[max(0, i - order + 1) : i]), w)) for i, w in enumerate(own))
        assert r.score == pytest.approx(wanted, abs=2e-4 * len(own))


def test_a_model_without_training_rows(docs):
    found = language_model.scored(docs, F.lit(True)).collect()
    assert len(found) == len(_texts()) and all(r.n_known == 0 and r.train_tokens == 0 and r.score == 0 for r in found)


def test_elias_fano_finds_what_it_holds():
    import numpy as np

    source = np.random.default_rng(3)
    for top in (1, 70, 10_000, 2**50):
        values = np.unique(np.r_[0, source.integers(0, top, 900)])
        coder = language_model.EliasFano.of(values)
        assert (coder.find(values) == np.arange(len(values))).all()
        others = np.setdiff1d(source.integers(0, values[-1] + 1, 2000), values)
        assert (coder.find(others) == -1).all()


URLS = ["http://A.Example.org/en/12", "https://example.org/es/", "https://example.org/es", "x://org/", "https://b.com/fr/1?x=/de/", "https://c.com/de/#a", "https://notorg/", "://", "no url", "", None, "http://example.org?q=/es/", "http://badexample.org/es/1", "http://com/de/", "http://x..org/"]


def test_urls_are_judged_as_by_all_rules(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judged(pages, URL_RULES).collect()}
    assert found == {i: url(u, URL_RULES) for i, u in enumerate(URLS)}


def test_the_cascade_is_exact_on_every_key(spark):
    rules = [url_filter.Rule(("allow", "block")[i % 2], f"h{i}.org") for i in range(300)]
    hosts = [f"http://h{i}.org/" for i in range(4000)]
    pages = spark.createDataFrame(list(enumerate(hosts)), "page_id long, url string")
    held = url_filter.cascades(pages, rules)
    assert len(held["block"].levels) > 2
    for i in range(4000):
        assert [f"h{i}.org/".encode() in held[v] for v in ("allow", "block")] == [i < 300 and i % 2 == k for k in (0, 1)]


def test_passages_shared_by_two_documents_are_found(docs):
    found = substring_dedup.repeated_passages(docs)
    by = {r.doc_id: r for r in found.collect()}
    assert by[11].first_doc == 10 and (by[11].start, by[11].end) == (120, 200)
    assert {2, 3} <= set(by) and not {1, 10, 12, 16} & set(by)
    rest = {r.doc_id: r.text for r in substring_dedup.without_passages(docs, found).collect()}
    assert rest[3] == "" and rest[4] is None and words(rest[11]) == _prose(5, 120) + _prose(6, 120)


def test_benchmark_passages_are_found(spark, docs):
    item = " ".join(_prose(7, 40)) + ". The answer is forty."
    leak = " ".join(_prose(8, 150)) + " " + item + " " + " ".join(_prose(9, 150))
    both = docs.select("doc_id", "text").union(spark.createDataFrame([(99, leak)], "doc_id long, text string"))
    benchmark = spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(both, benchmark).collect()} == {(99, 1)}


PAGE = (
    '<html><head><title>T</title></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">Buy this now, and buy it twice.</div>'
    "<article><h1>On  trees</h1><p><b>Bold &amp; old<br>words<p>Short.</p><script>var x = '</p>';</script><ul><li>one<li>two</ul>"
    '<div class="comments"><p>I have read this and liked it very much, thanks to all.</p></div></article><footer>&copy; 2020 all rights</footer>'
)


def test_the_article_is_extracted(spark):
    rows = [(1, "u", PAGE, "t"), (2, None, None, None), (None, "u", "", ""), (4, "u", "<p", ""), (1, "u", PAGE, "t"), (5, "u", "<nav>a</nav>" * 2000, "")]
    found = html_extraction.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    text = "On trees\n\nBold & old words\n\nShort.\n\none\n\ntwo"
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in found) == sorted([(1, text, len(text))] * 2 + [(2, "", 0), (0, "", 0), (4, "", 0), (5, "", 0)])


def test_the_model_separates_most_of_its_labelled_text():
    model, right, n = html_extraction.Model(), 0, 0
    for page in html_extraction.LABELLED:
        tree = html_extraction.Tree.of(page)
        for run, odds, label in zip(tree.runs, model.marginals(tree), tree.labels):
            if run is not None:
                right, n = right + ((odds >= 0) == bool(label)), n + 1
    assert right >= 0.95 * n


def _operators():
    scores = token_counts.unigram_scores(PATH)
    return {
        "near duplicates": lambda d: minhash_dedup.near_duplicates(d),
        "licences": lambda d: license_scan.scan(d),
        "token counts": lambda d: token_counts.counted(d, scores, public_tokenizers.PATTERN),
        "quality": lambda d: quality_rules.judged(d),
        "passages": lambda d: substring_dedup.repeated_passages(d),
        "scores": lambda d: language_model.scored(d, F.col("doc_id") == 0),
        "tokens": lambda d: byte_bpe.encode(d, PATH, public_tokenizers.PATTERN),
        "urls": lambda d: url_filter.judged(d, URL_RULES, key="doc_id", url="text"),
        "pages": lambda d: html_extraction.extracted(d, key="doc_id", url="word", html="text"),
        "benchmark": lambda d: decontamination.contaminated(d, d.selectExpr("doc_id AS item_id", "text").where("item_id IS NOT NULL")),
    }


@pytest.mark.parametrize("name", list(_operators()))
def test_empty_tables_and_odd_rows(spark, odd, name):
    operator = _operators()[name]
    assert operator(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = operator(odd).count()
    if name not in ("near duplicates", "passages", "benchmark"):
        assert rows == 4
