"""License scan as an exact set-similarity join (DataFrame functions only).

A block is a line of a text and the lines after it, until these have as many
words as the longest template: license text that is wrapped over lines lies
within the block of the line where it begins. (Lines without words are passed
over; of a line without template words the block adds nothing to the next
one.) A block matches a template if it contains at least ``threshold`` of the
template's distinct words. Words are ordered by their frequency over all
blocks, rarest first; then

* prefix filter: two sets that share ``a`` words share one among the first
  ``n - a + 1`` of the template and the first ``m - a + 1`` of the block;
* length filter: a block with fewer than ``a`` template words cannot match;
* positional filter: a shared word at places i and j leaves at most
  ``1 + min(n - 1 - i, m - 1 - j)`` shared words from there on.

What passes is verified on the whole sets. Words that are in no template
cannot add to an overlap, so a block is represented by its template words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, letters_down, stage

# Phrases whose every place is reported, with their labels.
PHRASES = (("under the mit license", "mit"),
           ("apache license version 2", "apache-2"),
           ("cc by nc", "cc-by-nc"))
# Template sentences (lower-case words), with their labels.
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a "
     "copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("this work is licensed under the gnu general public license version 3",
     "gpl-3"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution "
     "noncommercial 4 0 international license", "cc-by-nc"),
    ("redistribution and use in source and binary forms with or without "
     "modification are permitted provided that the following conditions are "
     "met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public "
     "license v 2 0", "mpl-2"),
    ("all rights reserved", "all-rights-reserved"),
)
THRESHOLD = 0.8
# What separates words once A-Z are in lower case.
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def needed(n: int, threshold: float) -> int:
    """Words a block must share with a template of ``n`` distinct words."""
    return max(1, math.ceil(threshold * n - 1e-9))


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _places(words: Column, phrase: str) -> Column:
    """Starts (from 0) of the places where the phrase's words stand."""
    p = phrase.split()
    starts = F.when(F.size(words) >= len(p),
                    F.sequence(F.lit(0), F.size(words) - len(p))).otherwise(
        F.array().cast("array<int>"))

    def here(i: Column) -> Column:
        hit = words[i] == p[0]
        for k, w in enumerate(p[1:], 1):
            hit = hit & (words[i + k] == w)
        return hit
    return F.filter(starts, here)


def _runs(lines: Column, reach: int) -> Column:
    """Template words (``t``) of each block: those of a line that has any, and
    of the lines after it until these have ``reach`` words (``n``)."""
    def run(line: Column, i: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), line["t"].alias("t"))
        return F.aggregate(
            F.slice(lines, i + 2, F.lit(reach)), start,
            lambda acc, x: F.when(acc["n"] >= reach, acc).otherwise(F.struct(
                (acc["n"] + x["n"]).alias("n"),
                F.array_union(acc["t"], x["t"]).alias("t"))))["t"]
    return F.filter(F.transform(lines, lambda x, i: F.when(
        F.size(x["t"]) > 0, run(x, i))), lambda t: t.isNotNull())


def _reach(templates) -> int:
    return max(len(t.split()) for t, _ in templates)


def _read(docs: DataFrame, id_col: str, text_col: str, phrases, vocabulary,
          reach: int) -> DataFrame:
    """One pass over the texts: word counts, phrase places, and the template
    words of each block that has any."""
    text = letters_down(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    lines = docs.select(
        F.col(id_col).alias("__id"), F.monotonically_increasing_id()
        .alias("__row"), F.transform(
            F.split(text, "\n"), lambda x: F.array_remove(
                F.split(x, SEPARATORS), "")).alias("__lines"))
    words = lines.select(
        "__id", "__row", F.flatten("__lines").alias("__words"),
        F.filter(F.transform("__lines", lambda x: F.struct(
            F.array_intersect(_strings(vocabulary), x).alias("t"),
            F.size(x).alias("n"))), lambda x: x["n"] > 0).alias("__lines"))
    no_places = F.array().cast("array<int>")
    every_place = [
        F.when(F.array_contains("__words", _longest(p)),
               let(F.col("__words"), _finder(p))).otherwise(no_places)
        .alias(f"__p{i}")
        for i, (p, _) in enumerate(phrases)]
    return words.select(
        "__id", "__row", F.size("__words").cast("long").alias("n_words"),
        *every_place,
        _runs(F.col("__lines"), reach).alias("__blocks"))


def _finder(phrase: str):
    return lambda words: _places(words, phrase)


def _longest(phrase: str) -> str:
    return max(phrase.split(), key=len)


def matches(blocks: DataFrame, templates, threshold: float, row: str = "__row",
            block: str = "__block") -> DataFrame:
    """The similarity join: (``row``, ``label``, ``containment``) for every
    block (an array of distinct template words) and template that match.

    The frequencies of the template words (as many rows as the templates have
    words) and the templates' prefixes are the only things that are looked up
    by every task."""
    spark = blocks.sparkSession
    sets = [(frozenset(t.split()), label) for t, label in templates]
    vocabulary = sorted(frozenset().union(*[s for s, _ in sets]))
    seen = {r["w"]: r["n"] for r in blocks.select(
        F.explode(block).alias("w")).groupBy("w").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    order = sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    index = []
    for words, label in sets:
        ranked = sorted(words, key=rank.get)
        n, a = len(ranked), needed(len(ranked), threshold)
        index += [F.struct(
            F.lit(ranked[i]).alias("w"), F.lit(label).alias("label"),
            F.lit(i).alias("i"), F.lit(n).alias("n"), F.lit(a).alias("a"),
            _strings(ranked).alias("words")) for i in range(n - a + 1)]
    least = min(needed(len(words), threshold) for words, _ in sets)
    prefixes = spark.range(1).select(F.inline(F.array(*index)))
    long_enough = blocks.filter(F.size(block) >= least).select(
        row, F.array_intersect(_strings(order), F.col(block)).alias("b"))
    probes = long_enough.select(
        row, "b", F.size("b").alias("m"), F.posexplode(
            F.slice("b", F.lit(1), F.size("b") - least + 1))
        .alias("j", "w"))
    hits = probes.join(F.broadcast(prefixes), "w").filter(
        (F.col("m") >= F.col("a"))
        & (F.col("j") < F.col("m") - F.col("a") + 1)
        & (1 + F.least(F.col("n") - 1 - F.col("i"),
                       F.col("m") - 1 - F.col("j")) >= F.col("a")))
    overlap = F.size(F.array_intersect("words", "b"))
    return hits.filter(overlap >= F.col("a")).select(
        row, "label", (overlap / F.col("n")).alias("containment"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         phrases=PHRASES, templates=TEMPLATES, threshold: float = THRESHOLD
         ) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_words``, ``n_base``,
    ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``
    (the largest containment of a matched template, 1 where a phrase stands,
    else 0).

    * null or empty text: no words, no labels, score 0
    * null ids and repeated rows: one result row each
    * very long texts are read whole; a very long line is in one block
    * other columns are ignored; an empty table gives no rows"""
    vocabulary = sorted({w for t, _ in templates for w in t.split()})
    held = stage(_read(docs, id_col, text_col, phrases, vocabulary,
                       _reach(templates)), "licenses")
    blocks = held.select("__row", F.explode("__blocks").alias("__block"))
    found = matches(blocks, templates, threshold).groupBy("__row").agg(
        F.collect_set("label").alias("__found"),
        F.max("containment").alias("__score"))
    places = F.concat(*[F.col(f"__p{i}") for i in range(len(phrases))])
    base = F.array_sort(F.array_distinct(F.concat(*[
        F.when(F.size(f"__p{i}") > 0, F.array(F.lit(label)))
        .otherwise(F.array().cast("array<string>"))
        for i, (_, label) in enumerate(phrases)])))
    rows = held.select("__row", "__id", "n_words", places.alias("__places"),
                       base.alias("__base")).join(found, "__row", "left")
    return rows.select(
        F.col("__id").alias(id_col), "n_words",
        F.size("__places").cast("long").alias("n_base"),
        F.array_min("__places").cast("long").alias("first_word"),
        F.array_max("__places").cast("long").alias("last_word"),
        F.array_join("__base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("__base", F.coalesce(
            "__found", F.array().cast("array<string>")))), ",")
        .alias("labels"),
        F.when(F.size("__base") > 0, 1.0).otherwise(
            F.coalesce("__score", F.lit(0.0))).alias("score"))


def scan_sql(rel: str, phrases=PHRASES, templates=TEMPLATES,
             threshold: float = THRESHOLD) -> str:
    """DuckDB SQL for the same (``doc_id`` unique): every block against every
    template by counting shared words, without filters."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    ph = ", ".join(
        f"({i}, '{p}', '{lab}', {len(p.split())})"
        for i, (p, lab) in enumerate(phrases))
    te = ", ".join(f"({i}, '{t}', '{lab}', {needed(len(set(t.split())), threshold)}"
                   f", {len(set(t.split()))})"
                   for i, (t, lab) in enumerate(templates))
    return rf"""
WITH docs AS (SELECT doc_id, translate(coalesce(text, ''), '{upper}',
  '{lower}') AS t FROM {rel}),
words AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) - 1 AS i
  FROM (SELECT doc_id, regexp_extract_all(t, '{word}') AS w FROM docs)),
n AS (SELECT doc_id, count(*) AS n_words FROM words GROUP BY doc_id),
phrases(p, phrase, label, k) AS (VALUES {ph}),
pw AS (SELECT p, label, k, unnest(a) AS w, generate_subscripts(a, 1) - 1 AS o
  FROM (SELECT p, label, k, string_split(phrase, ' ') AS a FROM phrases)),
places AS (SELECT doc_id, p, label, i - o AS s FROM words
  JOIN pw ON words.w = pw.w GROUP BY doc_id, p, label, k, i - o
  HAVING count(*) = any_value(k)),
base AS (SELECT doc_id, count(*) AS n_base, min(s) AS first_word,
  max(s) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label)
  AS base_labels FROM places GROUP BY doc_id),
templates(t, body, label, a, n) AS (VALUES {te}),
tw AS (SELECT DISTINCT t, label, a, n, w FROM (SELECT t, label, a, n,
  unnest(string_split(body, ' ')) AS w FROM templates)),
lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS b
  FROM (SELECT doc_id, string_split(t, chr(10)) AS ls FROM docs)),
parts AS (SELECT doc_id, b, regexp_extract_all(line, '{word}') AS ws
  FROM lines),
nth AS (SELECT doc_id, ws, len(ws) AS n, row_number() OVER o AS k,
  sum(len(ws)) OVER o AS upto FROM parts WHERE len(ws) > 0
  WINDOW o AS (PARTITION BY doc_id ORDER BY b)),
spans AS (SELECT doc_id, k + o AS k, k AS b, upto FROM nth,
  range(0, {_reach(templates)} + 1) r(o)),
runs AS (SELECT doc_id, spans.b, nth.ws
  FROM spans JOIN nth USING (doc_id, k)
  WHERE k = spans.b OR nth.upto - nth.n - spans.upto < {_reach(templates)}),
lw AS (SELECT DISTINCT doc_id, b, w FROM (SELECT doc_id, b,
  unnest(ws) AS w FROM runs) WHERE w IN (SELECT w FROM tw)),
hits AS (SELECT doc_id, b, t, label, count(*) AS o, any_value(n) AS n
  FROM lw JOIN tw ON lw.w = tw.w GROUP BY doc_id, b, t, label
  HAVING count(*) >= any_value(a)),
best AS (SELECT doc_id, max(o / n::DOUBLE) AS score FROM hits GROUP BY doc_id),
labs AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM hits UNION SELECT doc_id, label FROM places)
  GROUP BY doc_id)
SELECT docs.doc_id, coalesce(n_words, 0) AS n_words,
  coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CASE WHEN base_labels IS NOT NULL THEN 1.0::DOUBLE
    ELSE coalesce(score, 0.0) END AS score
FROM docs LEFT JOIN n USING (doc_id) LEFT JOIN base USING (doc_id)
LEFT JOIN best USING (doc_id) LEFT JOIN labs USING (doc_id)"""
