"""Document quality by distance from language references, in DataFrame expressions only.

Two histograms describe a document: its characters by class and its common words. Each language
has reference histograms, the sums over all documents whose common words are mostly of that
language. A document is rejected if its Jensen-Shannon distance from every reference is too large,
for either histogram; histograms of too few counts decide nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import SPACE, WORD, id_and_text

# Frequent function words of each language, none of them in two lists.
COMMON_WORDS: dict[str, tuple[str, ...]] = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "with", "be", "by", "this"),
    "de": ("der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "dem", "nicht", "ein"),
    "fr": ("le", "les", "et", "un", "une", "du", "dans", "est", "que", "qui", "par", "pour", "sur", "au", "pas", "avec"),
    "es": ("el", "los", "y", "en", "una", "las", "con", "por", "del", "su", "lo", "como", "se", "al", "más", "o"),
}
# Character classes as regular expressions; every other character counts as a letter.
CHAR_CLASSES: dict[str, str] = {
    "upper": r"\p{Lu}",
    "digit": r"\p{Nd}",
    "mark": r"[.,;:!?'\"()\-]",
    "symbol": r"[#*$%&|<>\[\]{}=+_/\\@~^`]",
}
SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 5
# The character before those that stand for the common words: 64 of them fit above it in one byte each.
_FIRST_CODE = 32


@dataclass(frozen=True)
class Limits:
    """Largest distances (0 to 1) and the fewest counts for which a distance decides."""

    chars: float = 0.3
    words: float = 0.85
    min_chars: int = 200
    min_words: int = 50
    min_common: int = 20


def _apart(words: str, n: str) -> list[str]:
    """Hash of the run of five words that starts at each word, as steps over arrays."""
    return [
        f"transform({words}, w -> xxhash64(w)) AS h",
        f"zip_with(slice(h, 1, {n} - 1), slice(h, 2, {n}), (a, b) -> xxhash64(a, b)) AS h2",
        f"zip_with(slice(h2, 1, {n} - 3), slice(h2, 3, {n}), (a, b) -> xxhash64(a, b)) AS h4",
        f"zip_with(slice(h4, 1, {n} - 4), slice(h, 5, {n}), (a, b) -> xxhash64(a, b)) AS runs",
    ]


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, words, text and the base counts of each row.

    Words in repeated windows: the runs of five words are sorted by hash with their places; a run
    that equals its neighbour is repeated; each repeated run covers five words, less those that
    the next one covers too.
    """
    found = docs.selectExpr("doc_id", "coalesce(text, '') AS text").select(
        "doc_id", "text", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words")
    )
    found = found.selectExpr("*", "size(words) AS n", "array_join(words, '') AS dense")
    lines = f"filter(split(text, '\\\\n'), line -> line RLIKE '{_sql(WORD)}')"
    found = found.selectExpr(
        "*",
        "CAST(char_length(dense) AS BIGINT) AS word_chars",
        f"CAST(char_length(regexp_replace(dense, '{_sql(SYMBOLS)}', '')) AS BIGINT) AS n_symbols",
        f"{lines} AS lines",
    ).selectExpr("*", "CAST(size(lines) - size(array_distinct(lines)) AS BIGINT) AS n_dup_lines").drop("lines")
    h, h2, h4, runs = _apart("words", "greatest(n, 5)")
    for step in (h, h2, h4, runs):
        found = found.selectExpr("*", step)
    found = found.drop("h", "h2", "h4").selectExpr(
        "*", "n >= 5 AND size(array_distinct(runs)) < size(runs) AS repeats"
    )
    # Only texts that repeat something pay for the sort.
    found = found.selectExpr(
        "* EXCEPT (runs)",
        "CASE WHEN repeats THEN sort_array(transform(runs, (h, i) -> struct(h, i))) "
        "ELSE CAST(array() AS ARRAY<STRUCT<h: BIGINT, i: INT>>) END AS ranked",
    )
    found = found.selectExpr(
        "* EXCEPT (ranked)",
        "ranked",
        "zip_with(slice(ranked, 1, greatest(size(ranked) - 1, 0)), slice(ranked, 2, greatest(size(ranked), 1)), "
        "(x, y) -> x.h = y.h) AS same",
    )
    found = found.selectExpr(
        "* EXCEPT (ranked, same)",
        "sort_array(filter(zip_with(ranked, zip_with(array_prepend(same, false), array_append(same, false), (x, y) -> x OR y), "
        "(x, twice) -> CASE WHEN twice THEN x.i END), i -> i IS NOT NULL)) AS places",
    )
    covered = (
        f"aggregate(zip_with(slice(places, 1, greatest(size(places) - 1, 0)), slice(places, 2, greatest(size(places), 1)), "
        f"(x, y) -> least(y - x, {WINDOW})), 0L, (sum, x) -> sum + x)"
    )
    return found.selectExpr(
        "* EXCEPT (places)", f"CASE WHEN size(places) = 0 THEN 0L ELSE {covered} + {WINDOW} END AS n_repeat_words"
    )


def _sql(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def histograms(counted: DataFrame) -> DataFrame:
    """Adds ``chars`` (counts by class) and ``common`` (counts by common word), arrays of long.

    The words are filtered to the common ones first, each of those becomes one character, and all counts
    are taken from that short string.
    """
    known = [w for words in COMMON_WORDS.values() for w in words]
    listed = ", ".join(f"'{w}'" for w in known)
    found = counted.selectExpr(
        "*",
        f"array_join(transform(filter(transform(words, w -> lower(w)), w -> w IN ({listed})), "
        f"w -> char({_FIRST_CODE} + array_position(array({listed}), w))), '') AS codes",
    )
    counts = [
        f"CAST(char_length(codes) - char_length(replace(codes, char({_FIRST_CODE + 1 + i}), '')) AS BIGINT)" for i in range(len(known))
    ]
    classes = [f"CAST(char_length(dense) - char_length(regexp_replace(dense, '{_sql(p)}+', '')) AS BIGINT)" for p in CHAR_CLASSES.values()]
    found = found.selectExpr("*", f"array({', '.join(classes)}) AS classes", f"array({', '.join(counts)}) AS common")
    rest = "char_length(dense) - aggregate(classes, 0L, (s, x) -> s + x)"
    return found.selectExpr("* EXCEPT (codes, classes)", f"array_append(classes, {rest}) AS chars")


def _language_sums() -> list[str]:
    sums, at = [], 1
    for words in COMMON_WORDS.values():
        sums.append(f"aggregate(slice(common, {at}, {len(words)}), 0L, (s, x) -> s + x)")
        at += len(words)
    return sums


def language_references(counted: DataFrame) -> dict[str, tuple[list[int], list[int]]]:
    """Language -> (chars, common) summed over all documents whose common words are mostly its own.

    One row per language of :data:`COMMON_WORDS` comes back, whatever the number of documents.
    """
    names = list(COMMON_WORDS)
    n_chars, n_words = len(CHAR_CLASSES) + 1, sum(map(len, COMMON_WORDS.values()))
    sums = counted.selectExpr("chars", "common", f"array({', '.join(_language_sums())}) AS sums")
    best = sums.selectExpr("*", "array_max(sums) AS top").where("top > 0")
    best = best.selectExpr("*", "CAST(array_position(sums, top) AS INT) - 1 AS language")
    rows = best.groupBy("language").agg(
        *[F.sum(F.col("chars")[i]).alias(f"c{i}") for i in range(n_chars)],
        *[F.sum(F.col("common")[i]).alias(f"w{i}") for i in range(n_words)],
    )
    return {
        names[r["language"]]: ([r[f"c{i}"] for i in range(n_chars)], [r[f"w{i}"] for i in range(n_words)])
        for r in rows.collect()
    }


def distance(counts: str, n: str, reference: list[int]) -> str:
    """Jensen-Shannon distance (base 2) of an array of counts, their sum ``n``, from reference counts, as SQL."""
    total = float(sum(reference)) or 1.0
    q = "array(" + ", ".join(f"{x / total!r}D" for x in reference) + ")"
    term = (
        "(CASE WHEN x > 0 THEN x * log2(2 * x / (x + y)) ELSE 0D END + "
        "CASE WHEN y > 0 THEN y * log2(2 * y / (x + y)) ELSE 0D END) / 2"
    )
    terms = f"zip_with(transform({counts}, c -> CAST(c AS DOUBLE) / {n}), {q}, (x, y) -> {term})"
    return f"sqrt(greatest(0D, aggregate({terms}, 0D, (s, x) -> s + x)))"


def judged(docs: DataFrame, key: str = "doc_id", text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """One row per input row: doc_id, n_words, the base counts, distances, base_failed, kept.

    ``char_distance`` and ``word_distance`` are the smallest over the language references, null where
    the document has fewer than ``min_chars`` characters in words or, for the words, fewer than ``min_words``
    words or ``min_common`` common ones. The distances are computed from written counts: one pass over the texts.

    Null or empty text: no words, all counts 0, base_failed, not kept. A null id keeps its row; repeated rows are
    judged each for itself; an empty table gives an empty result. Other columns are not read.
    """
    counted = materialize(
        histograms(base_counts(id_and_text(docs, key, text))).drop("text", "words", "dense", "repeats"), "quality"
    )
    references = language_references(counted)
    sums = [f"aggregate({c}, 0L, (s, x) -> s + x) AS n_{c}" for c in ("chars", "common")]
    chars = [distance("chars", "n_chars", c) for c, _ in references.values()]
    words = [distance("common", "n_common", w) for _, w in references.values()]
    least = lambda found: f"least({', '.join(found)}, 1D)" if found else "CAST(NULL AS DOUBLE)"
    found = counted.selectExpr("*", *sums).selectExpr(
        "doc_id",
        "CAST(n AS BIGINT) AS n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        f"CASE WHEN word_chars >= {limits.min_chars} THEN {least(chars)} END AS char_distance",
        f"CASE WHEN n >= {limits.min_words} AND n_common >= {limits.min_common} THEN {least(words)} END AS word_distance",
        f"n < 10 OR 100 * n_repeat_words > 20 * n AS base_failed",
    )
    return found.selectExpr(
        "*",
        f"NOT base_failed AND coalesce(char_distance <= {limits.chars}, true) "
        f"AND coalesce(word_distance <= {limits.words}, true) AS kept",
    )
