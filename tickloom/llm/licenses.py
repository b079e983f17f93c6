"""Licence scans by diagonal voting."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .textops import keyed, words_of

# The base phrases, and notices that the licences' own texts prescribe.
PHRASES = [
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
]
NOTICES = [
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the Software), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so",
    ),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
        "the MPL was not distributed with this file, You can obtain one at",
    ),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
PHRASE_GRAM, NOTICE_GRAM = 2, 4
MIN_COVER = 0.8
#: Diagonals of a notice that differ by up to so many words are one place with words put in or left out.
MAX_GAP = 3


def template_rows(phrases=PHRASES, notices=NOTICES) -> list[tuple[int, str, bool, int, list[str]]]:
    """(number, label, is a base phrase, gram length, words) of each template."""
    found = []
    for base, templates, k in ((True, phrases, PHRASE_GRAM), (False, notices, NOTICE_GRAM)):
        for label, text in templates:
            words = re.findall(r"[a-z0-9]+", text.lower())
            if len(words) < k:
                raise ValueError(f"a template of fewer than {k} words: {text}")
            found.append((len(found), label, base, k, words))
    return found


def _grams(spark: SparkSession, templates, k: int) -> DataFrame:
    """Hash and words of each k-gram, with its places in the templates. As many rows as template words."""
    rows = [(t, i, words[i : i + k]) for t, _, _, n, words in templates if n == k for i in range(len(words) - k + 1)]
    grams = spark.createDataFrame(rows, "t int, at int, words array<string>")
    return grams.groupBy(
        F.xxhash64(*[F.get("words", F.lit(i)) for i in range(k)]).alias(f"_h{k}"),
        F.concat_ws(" ", "words").alias(f"_gram{k}"),
    ).agg(F.collect_list(F.struct("t", "at")).alias(f"_hits{k}"))


def _word(i: int) -> Column:
    return F.get("_words", F.col("_p") + i)


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases=PHRASES,
    notices=NOTICES,
) -> DataFrame:
    """One row per input row: <id_col>, n_words, n_base, first_word, last_word, base_labels, labels,
    score, spans (array of label, start, end, cover; words from 0, end exclusive).

    Every rolling word k-gram of every whole text meets the template positions in a join on the gram's
    hash (and words). A hit votes for the diagonal text position - template position; a base phrase stands
    where all its grams vote for one diagonal. For notices, neighbouring diagonals are merged, and a span
    counts if its grams cover MIN_COVER of the notice's words. The score is the best cover, 1 for a phrase.

    Defined cases: null and empty texts have no words and no labels; a repeated row gives a repeated
    result row; null identifiers stay null; other columns are ignored.
    """
    spark = docs.sparkSession
    templates = template_rows(phrases, notices)
    about = spark.createDataFrame(
        [(t, label, base, k, len(words)) for t, label, base, k, words in templates],
        "t int, label string, base boolean, k int, length int",
    )
    words = keyed(docs, id_col, text_col).select("_row", "_id", words_of(f"_{text_col}").alias("_words"))
    # The place after the last word stands for the document itself, so that none gets lost.
    places = words.select(
        "_row", "_id", "_words", F.size("_words").alias("_n"), F.explode(F.sequence(F.lit(0), F.size("_words"))).alias("_p")
    )
    for k in (PHRASE_GRAM, NOTICE_GRAM):
        grams = F.broadcast(_grams(spark, templates, k))  # fixed templates: a few hundred rows
        mine = F.when(F.col("_p") + k <= F.col("_n"), F.xxhash64(*[_word(i) for i in range(k)]))
        same = F.concat_ws(" ", *[_word(i) for i in range(k)]) == F.col(f"_gram{k}")
        places = places.join(grams, (mine == F.col(f"_h{k}")) & same, "left").drop(f"_h{k}", f"_gram{k}")
    names = [f"_hits{k}" for k in (PHRASE_GRAM, NOTICE_GRAM)]
    none = F.array().cast("array<struct<t:int,at:int>>")
    hits = (
        places.filter((F.col("_p") == F.col("_n")) | F.col(names[0]).isNotNull() | F.col(names[1]).isNotNull())
        .select("_row", "_id", "_n", "_p", F.explode_outer(F.concat(*[F.coalesce(c, none) for c in names])).alias("_hit"))
        .select("_row", "_id", "_n", F.col("_hit.t").alias("t"), F.col("_hit.at").alias("_at"), (F.col("_p") - F.col("_hit.at")).alias("_diag"))
        .repartition("_row")  # serves all groupings below
    )
    doc = ["_row", "_id", "_n"]
    order = Window.partitionBy(*doc).orderBy("t", "_diag")
    apart = (
        F.col("base")
        | (F.lag("t").over(order) != F.col("t"))
        | (F.col("_diag") - F.lag("_diag").over(order) > MAX_GAP)
    )
    spans = (
        hits.groupBy(*doc, "t", "_diag")
        .agg(F.collect_list("_at").alias("_ats"))
        .join(F.broadcast(about), "t", "left")
        .withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("_place", F.sum("_new").over(order))
        .groupBy(*doc, "t", "label", "base", "k", "length", "_place")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("_ats"))).alias("_ats"),
            F.min(F.col("_diag") + F.array_min("_ats")).alias("_start"),
            F.max(F.col("_diag") + F.array_max("_ats") + F.col("k")).alias("_end"),
        )
        .withColumn(
            "_covered",
            F.size(F.array_distinct(F.flatten(F.transform("_ats", lambda a: F.sequence(a, a + F.col("k") - 1))))),
        )
        .withColumn("cover", F.round(F.col("_covered") / F.col("length"), 6))
        .withColumn(
            "_valid",
            F.when(F.col("base"), F.size("_ats") == F.col("length") - F.col("k") + 1).otherwise(F.col("cover") >= MIN_COVER),
        )
    )
    is_base = F.col("_valid") & F.col("base")
    labels = lambda which: F.array_join(F.sort_array(F.collect_set(F.when(which, F.col("label")))), ",")
    span = F.struct("label", F.col("_start").alias("start"), F.col("_end").alias("end"), "cover")
    return spans.groupBy(*doc).agg(
        F.count(F.when(is_base, True)).alias("n_base"),
        F.min(F.when(is_base, F.col("_start"))).cast("long").alias("first_word"),
        F.max(F.when(is_base, F.col("_start"))).cast("long").alias("last_word"),
        labels(is_base).alias("base_labels"),
        labels(F.col("_valid")).alias("labels"),
        F.coalesce(F.max(F.when(F.col("_valid"), F.when(F.col("base"), 1.0).otherwise(F.col("cover")))), F.lit(0.0)).alias("score"),
        F.sort_array(F.collect_list(F.when(F.col("_valid"), span))).alias("spans"),
    ).select(
        F.col("_id").alias(id_col), F.col("_n").cast("long").alias("n_words"), "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"
    )


def oracle_sql() -> str:
    """The same in DuckDB SQL, over the words themselves."""
    templates = ",\n".join(
        f"({t}, '{label}', {base}, {k}, '{' '.join(words)}')" for t, label, base, k, words in template_rows()
    )
    gram = {
        k: " || ' ' || ".join(["word"] + [f"lead(word, {i}) OVER w" for i in range(1, k)]) for k in (PHRASE_GRAM, NOTICE_GRAM)
    }
    return rf"""
WITH templates(t, label, base, k, body) AS (VALUES {templates}),
twords AS (SELECT t, k, unnest(string_split(body, ' ')) AS word, generate_subscripts(string_split(body, ' '), 1) - 1 AS off FROM templates),
tgrams AS (
  SELECT t, k, off, CASE k WHEN {PHRASE_GRAM} THEN {gram[PHRASE_GRAM]} ELSE {gram[NOTICE_GRAM]} END AS gram
  FROM twords WINDOW w AS (PARTITION BY t ORDER BY off)),
docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '{SEPARATORS_SQL}'), lambda x: x <> '') AS words FROM documents),
words AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS p FROM docs),
grams AS (
  SELECT doc_id, p, {gram[PHRASE_GRAM]} AS g2, {gram[NOTICE_GRAM]} AS g4 FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
hits AS (
  SELECT doc_id, t, off, p - off AS diag FROM grams JOIN tgrams ON k = {PHRASE_GRAM} AND gram = g2
  UNION ALL SELECT doc_id, t, off, p - off FROM grams JOIN tgrams ON k = {NOTICE_GRAM} AND gram = g4),
diagonals AS (SELECT doc_id, t, diag, min(off) AS lo, max(off) AS hi, list(off) AS ats FROM hits GROUP BY ALL),
marked AS (
  SELECT *, CASE WHEN base OR diag - lag(diag) OVER w <= {MAX_GAP} IS NOT TRUE THEN 1 ELSE 0 END AS fresh
  FROM diagonals JOIN templates USING (t) WINDOW w AS (PARTITION BY doc_id, t ORDER BY diag)),
placed AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, t ORDER BY diag) AS place FROM marked),
ends AS (SELECT doc_id, t, place, min(diag + lo) AS start FROM placed GROUP BY ALL),
ats AS (SELECT DISTINCT doc_id, t, place, k, unnest(ats) AS off FROM placed),
votes AS (SELECT doc_id, t, place, count(*) AS votes FROM ats GROUP BY ALL),
covered AS (SELECT doc_id, t, place, count(DISTINCT off + i) AS covered FROM ats, range({NOTICE_GRAM}) r(i) WHERE i < k GROUP BY ALL),
spans AS (
  SELECT doc_id, start, label, base,
         CASE WHEN base THEN votes = len(string_split(body, ' ')) - k + 1
              ELSE round(covered / len(string_split(body, ' ')), 6) >= {MIN_COVER} END AS valid,
         CASE WHEN base THEN 1.0 ELSE round(covered / len(string_split(body, ' ')), 6) END AS cover
  FROM ends JOIN votes USING (doc_id, t, place) JOIN covered USING (doc_id, t, place) JOIN templates USING (t)),
valid AS (SELECT * FROM spans WHERE valid)
SELECT d.doc_id, CAST(any_value(len(d.words)) AS BIGINT) AS n_words,
       count(*) FILTER (WHERE base) AS n_base,
       CAST(min(start) FILTER (WHERE base) AS BIGINT) AS first_word, CAST(max(start) FILTER (WHERE base) AS BIGINT) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
       CAST(coalesce(max(cover), 0) AS DOUBLE) AS score
FROM docs d LEFT JOIN valid v ON v.doc_id = d.doc_id GROUP BY d.doc_id"""


SEPARATORS_SQL = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
