"""Licence mentions and notices by diagonal voting, in DataFrame expressions only.

Every run of k words of every text is joined, by hash, to the places of a template where the same
run stands. A hit votes for its diagonal, place in the text less place in the template. Short
phrases need all votes on one diagonal; in notices neighbouring diagonals are merged, so that
words put in or left out cost little, and the merged span is verified.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as literal
from .common import LOWER, UPPER, id_and_text

TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    words: str
    phrase: bool = False


# Phrases that name a licence, and the wording of common notices.
PHRASES = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    Template("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    Template("apache", "licensed under the apache license version 2 0"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
)
NOTICE_RUN = 4
#: Templates are broadcast; more words than this are refused.
MAX_TEMPLATE_WORDS = 100_000


def _runs(rows: DataFrame) -> DataFrame:
    """Adds ``pairs`` and ``runs``: hashes of two and of :data:`NOTICE_RUN` words from each place on."""
    rows = rows.selectExpr("*", "size(words) AS n", "transform(words, w -> xxhash64(w)) AS h")
    rows = rows.selectExpr(
        "* EXCEPT (h)",
        "zip_with(slice(h, 1, greatest(n - 1, 0)), slice(h, 2, greatest(n - 1, 0)), (a, b) -> xxhash64(a, b)) AS pairs",
    )
    return rows.selectExpr(
        "*",
        "zip_with(slice(pairs, 1, greatest(n - 3, 0)), slice(pairs, 3, greatest(n - 3, 0)), (a, b) -> xxhash64(a, b)) AS runs",
    )


def template_places(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """(gram, template, label, phrase, place, own, votes): a row for each place of a template.

    ``own`` are the words of the run, ``votes`` the number of places. The row of template -1 matches
    a marker that every text carries once.
    """
    if sum(len(t.words.split()) for t in templates) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates may hold at most {MAX_TEMPLATE_WORDS} words in all, because they are broadcast")
    values = ", ".join(
        f"({i}, {literal(t.label)}, {str(t.phrase).lower()}, {literal(t.words)})" for i, t in enumerate(templates)
    )
    rows = spark.sql(f"SELECT * FROM VALUES {values} AS t(template, label, phrase, own)")
    rows = _runs(rows.selectExpr("template", "label", "phrase", "split(own, ' ') AS words"))
    rows = rows.selectExpr("*", "CASE WHEN phrase THEN pairs ELSE runs END AS grams", f"CASE WHEN phrase THEN 2 ELSE {NOTICE_RUN} END AS k")
    rows = rows.selectExpr("template", "label", "phrase", "k", "words", "size(grams) AS votes", "posexplode(grams) AS (place, gram)")
    rows = rows.selectExpr("gram", "template", "label", "phrase", "k", "place", "votes", "slice(words, place + 1, k) AS own")
    marker = spark.sql("SELECT 0L AS gram, -1 AS template, '' AS label, false AS phrase, 0 AS k, 0 AS place, 1 AS votes, CAST(array() AS ARRAY<STRING>) AS own")
    return rows.unionByName(marker)


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    phrases: tuple[Template, ...] = PHRASES,
    notices: tuple[Template, ...] = NOTICES,
    drift: int = 5,
    cover: float = 0.7,
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    Diagonals of a notice at most ``drift`` apart are merged; the span counts if it holds
    at least ``cover`` of the notice's runs and is at most twice as long as the notice. Each hit compares the
    words, not only their hash. ``spans`` lists (label, first word, words, share) of phrases and notices.
    ``score`` is the largest share found, 1 for a whole phrase.

    Null or empty text: no words, labels '' and score 0. A null id keeps its row; repeated rows are scanned each
    for itself; an empty table gives an empty result. Other columns are not read.
    """
    rows = id_and_text(docs, key, text).select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), F.lit(TOKEN), F.lit(0)).alias("words"),
    )
    rows = _runs(rows).selectExpr("row", "doc_id", "n", "words", "size(pairs) AS split", "concat(array(0L), pairs, runs) AS grams")
    rows = rows.selectExpr("row", "doc_id", "n", "words", "split", "posexplode(grams) AS (at, gram)")
    places = F.broadcast(template_places(docs.sparkSession, phrases + notices))
    hits = rows.join(places, "gram").where(
        f"CASE k WHEN 0 THEN at = 0 WHEN 2 THEN at BETWEEN 1 AND split ELSE at > split END"
    )
    hits = hits.selectExpr("*", "CASE k WHEN 0 THEN 0 WHEN 2 THEN at - 1 ELSE at - 1 - split END AS word")
    hits = hits.where("k = 0 OR slice(words, word + 1, k) = own")
    keys = ["row", "doc_id", "n", "template", "label", "phrase", "votes"]
    diagonals = hits.groupBy(*keys, F.expr("word - place").alias("diagonal")).agg(
        F.count("*").alias("hits"), F.min("word").alias("first"), F.max("word").alias("last"), F.collect_set("place").alias("places")
    )
    # A phrase needs all its votes on one diagonal; notices may spread over neighbouring ones.
    diagonals = diagonals.where("NOT phrase OR hits = votes")
    by_notice = "PARTITION BY row, template ORDER BY diagonal"
    merged = diagonals.selectExpr(
        "*", f"phrase OR coalesce(diagonal - lag(diagonal) OVER ({by_notice}) > {drift}, true) AS opens"
    )
    merged = merged.selectExpr("*", f"sum(int(opens)) OVER ({by_notice}) AS band")
    spans = merged.groupBy(*keys, "band").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.expr("size(array_distinct(flatten(collect_list(places)))) / first(votes)").alias("share")
    )
    spans = spans.where(
        f"template < 0 OR phrase OR (share >= {cover} AND last - first <= 2 * (votes + {NOTICE_RUN}))"
    ).selectExpr("*", f"template >= 0 AND phrase AS base", f"template >= 0 AS found")
    return spans.groupBy("row", "doc_id").agg(
        F.max("n").cast("long").alias("n_words"),
        F.count(F.expr("CASE WHEN base THEN 1 END")).alias("n_base"),
        F.min(F.expr("CASE WHEN base THEN first END")).cast("long").alias("first_word"),
        F.max(F.expr("CASE WHEN base THEN first END")).cast("long").alias("last_word"),
        F.expr("array_join(array_sort(collect_set(CASE WHEN base THEN label END)), ',')").alias("base_labels"),
        F.expr("array_join(array_sort(collect_set(CASE WHEN found THEN label END)), ',')").alias("labels"),
        F.expr("coalesce(max(CASE WHEN found THEN share END), 0D)").alias("score"),
        F.expr(
            f"sort_array(collect_list(CASE WHEN found THEN struct(first, label, last - first + CASE WHEN phrase THEN 2 ELSE {NOTICE_RUN} END AS words, share) END))"
        ).alias("spans"),
    ).drop("row")
