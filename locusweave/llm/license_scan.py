"""License scan by diagonal voting, with DataFrame functions only.

All rolling word k-gram hashes of a text are joined with the positions of these hashes in the license templates; k is 3 for templates of
under 16 words, else 4. A hit votes for the diagonal ``document position - template position``, if the words of the text's gram are the template's words, so equal hashes
of other words don't count. Votes are summed by diagonal; diagonals at most ``max_shift`` apart are one alignment, so a dropped or added word doesn't split a
span, unless the alignment drifts by more than ``max_drift`` words in all: then each diagonal is a span of its own.
A span is verified by its words: those in equal grams have to cover ``min_coverage`` of the template, and all of a template of under 8 words, in which one changed
word is another license.

Base phrases are found on their own, wherever their words stand consecutively.

The list of templates is broadcast while it has at most ``MAX_BROADCAST`` grams, and joined by a shuffle beyond. Texts that share no gram with
any template are told by one set operation on their hashes and not exploded.

Null text counts as empty (no words, no labels, score 0). A null doc_id is an id like any other. Rows with equal
doc_id and text get the same result. An empty table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words, once A-Z are lower-cased.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a gram in templates of under LONG words, and in others; templates of under SHORT words have to stand whole.
K_SHORT, K_LONG, LONG, SHORT = 3, 4, 16, 8
MAX_BROADCAST = 100_000

#: Base phrases and their labels.
PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

_NOTICE = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
_WARRANTY = "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."

#: Public license texts and notices, and their labels.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsl-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl-2.0", _NOTICE.format("General Public License", "2")),
    ("gpl-3.0", _NOTICE.format("General Public License", "3")),
    ("agpl-3.0", _NOTICE.format("Affero General Public License", "3")),
    ("lgpl", _NOTICE.format("Lesser General Public License", "2.1")),
    ("gnu-warranty", _WARRANTY),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
]


def words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, UPPER, LOWER), SEPARATOR), lambda w: w != "")


def _phrase_places(found: Column, joined: Column, phrase: str) -> Column:
    """0-based places of a phrase in the array of words; the array is only searched where the joined words contain the phrase."""
    parts = phrase.split(" ")

    def here(i: Column) -> Column:
        test = F.get(found, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            test = test & (F.get(found, i + k) == part)
        return test

    return F.when(joined.contains(f" {phrase} "), F.filter(F.sequence(F.lit(0), F.size(found) - len(parts)), here)).otherwise(F.expr("array()").cast("array<int>"))


def base_matches(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), n_words, n_base, first_word, last_word, base (labels)."""
    split = docs.select("doc_id", F.xxhash64("text").alias("th"), words(F.col("text")).alias("words"))
    joined = split.withColumn("joined", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
    names = [f"p{i}" for i in range(len(PHRASES))]
    places = joined.select("doc_id", "th", F.size("words").cast("long").alias("n_words"), *(_phrase_places(F.col("words"), F.col("joined"), p).alias(n) for n, (p, _) in zip(names, PHRASES)))
    every = F.concat(*names)
    labels = F.array(*(F.when(F.size(n) > 0, F.lit(label)) for n, (_, label) in zip(names, PHRASES)))
    return places.select("doc_id", "th", "n_words", F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"), F.array_compact(labels).alias("base"))


def template_grams(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """k, hash, gram (its words), template, label, t_words, tpos of every gram of every template."""
    rows = []
    for i, (label, text) in enumerate(templates):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans(UPPER, LOWER)))
        k = K_SHORT if len(w) < LONG else K_LONG
        rows += [(k, " ".join(w[p : p + k]), w[p : p + k], i, label, len(w), p) for p in range(len(w) - k + 1)]
    grams = spark.createDataFrame(rows, "k int, gram string, w array<string>, template int, label string, t_words int, tpos int")
    return grams.withColumn("hash", _hash(F.col("k"), [F.get("w", F.lit(j)) for j in range(K_LONG)])).drop("w")


def _hash(k: Column, found: list[Column]) -> Column:
    """Of k words; what is null doesn't count."""
    return F.xxhash64(k, *found)


def _grams(found: Column, k: int, with_words: bool = False) -> Column:
    """Of each place that begins k words, their hash, or all of a gram."""
    places = F.when(F.size(found) >= k, F.sequence(F.lit(0), F.size(found) - k)).otherwise(F.expr("array()").cast("array<int>"))

    def at(i: Column) -> Column:
        hashed = _hash(F.lit(k), [F.get(found, i + j) for j in range(k)])
        return F.struct(F.lit(k).alias("k"), i.alias("pos"), hashed.alias("hash"), F.array_join(F.slice(found, i + 1, k), " ").alias("gram")) if with_words else hashed

    return F.transform(places, at)


def spans(docs: DataFrame, max_shift: int = 2, max_drift: int = 12, min_coverage: float = 0.75, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """Verified spans: doc_id, th, label, start_word, end_word (exclusive), coverage. Templates of under K_SHORT words are never found."""
    grams = template_grams(docs.sparkSession, templates or TEMPLATES)
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), words(F.col("text")).alias("words"))
    every = F.concat(*(_grams(F.col("words"), k, True) for k in (K_SHORT, K_LONG)))
    known = [r.hash for r in grams.select("hash").distinct().limit(MAX_BROADCAST + 1).collect()]
    if len(known) <= MAX_BROADCAST:
        some = F.array(*(F.lit(h) for h in sorted(known))).cast("array<bigint>")
        # no filter: Spark would push it below the words, and split the text anew for each of them
        every = F.when(F.arrays_overlap(F.concat(*(_grams(F.col("words"), k) for k in (K_SHORT, K_LONG))), some), every)
        grams = F.broadcast(grams)
    rolling = rows.select("doc_id", "th", F.explode(every).alias("g")).select("doc_id", "th", "g.*")
    hits = rolling.withColumnRenamed("gram", "found").join(grams, ["k", "hash"]).where("found = gram")
    keys = ["doc_id", "th", "template", "label", "t_words", "k"]
    votes = hits.groupBy(*keys, (F.col("pos") - F.col("tpos")).alias("diagonal")).agg(F.collect_set("tpos").alias("tpos"))
    by_template = Window.partitionBy("doc_id", "th", "template").orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(by_template) > max_shift).cast("int"), F.lit(1))
    runs = votes.withColumn("apart", apart).withColumn("run", F.sum("apart").over(by_template.rowsBetween(Window.unboundedPreceding, 0)))
    one_run = Window.partitionBy("doc_id", "th", "template", "run")
    drift = F.max("diagonal").over(one_run) - F.min("diagonal").over(one_run)
    merged = runs.withColumn("own", F.when(drift > max_drift, F.col("diagonal"))).groupBy(*keys, "run", "own").agg(
        F.min(F.array_min("tpos") + F.col("diagonal")).alias("start_word"),
        F.max(F.array_max("tpos") + F.col("diagonal") + F.col("k")).alias("end_word"),
        F.flatten(F.collect_list("tpos")).alias("tpos"),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("tpos", lambda t: F.sequence(t, t + (F.col("k") - 1))))))
    least = F.when(F.col("t_words") < SHORT, 1.0).otherwise(min_coverage)
    verified = merged.withColumn("coverage", covered / F.col("t_words")).where(F.col("coverage") >= least)
    return verified.select("doc_id", "th", "label", F.col("start_word").cast("long").alias("start_word"), F.col("end_word").cast("long").alias("end_word"), "coverage")


def scan(docs: DataFrame, **options: object) -> DataFrame:
    """One row per input row: base matches, all labels, and the best coverage as score (1 where a base phrase stands)."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.whole_text().alias("text"))
    found = spans(base, **options).groupBy("doc_id", "th").agg(F.collect_set("label").alias("more"), F.max("coverage").alias("best"), F.count(F.lit(1)).alias("spans"))
    found = found.select(F.col("doc_id").alias("other_id"), F.col("th").alias("other_th"), "more", "best", "spans")
    rows = base_matches(base).join(found, F.col("doc_id").eqNullSafe(F.col("other_id")) & (F.col("th") == F.col("other_th")), "left")
    none = F.expr("array()").cast("array<string>")
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        F.coalesce("spans", F.lit(0)).cast("long").alias("n_spans"),
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.table(spark, sf_dir, "documents"))


_VALUES = ", ".join("({}, '{}', '{}')".format(i, label, text.replace("'", "''")) for i, (label, text) in enumerate(TEMPLATES))
_PHRASES = ", ".join(f"('{phrase}', '{label}', {len(phrase.split())})" for phrase, label in PHRASES)
OP2_SQL = f"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
  '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w FROM documents),
e AS (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM d),
ph(phrase, label, n) AS (VALUES {_PHRASES}),
b AS (SELECT e.doc_id, e.i - 1 AS place, ph.label FROM e JOIN ph ON e.i + ph.n - 1 <= len(e.w) AND e.w[e.i] = string_split(ph.phrase, ' ')[1]
  AND list_aggregate(list_slice(e.w, e.i, e.i + ph.n - 1), 'string_agg', ' ') = ph.phrase),
bb AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS base FROM b GROUP BY doc_id),
tv(template, label, t) AS (VALUES {_VALUES}),
tw AS (SELECT template, label, list_filter(string_split_regex(lower(t), '[^0-9a-z]+'), lambda x: x <> '') AS w FROM tv),
tk AS (SELECT template, label, w, len(w) AS t_words, CASE WHEN len(w) < {LONG} THEN {K_SHORT} ELSE {K_LONG} END AS k FROM tw),
tg AS (SELECT template, label, t_words, k, p - 1 AS tpos, list_slice(w, p, p + k - 1) AS g FROM (SELECT *, unnest(generate_series(1, len(w) - k + 1)) AS p FROM tk) x),
v AS ({" UNION ALL ".join(f"SELECT e.doc_id, template, label, t_words, k, tpos, e.i - 1 - tpos AS diagonal FROM e JOIN (SELECT * FROM tg WHERE k = {k}) t ON list_slice(e.w, e.i, e.i + {k - 1}) = t.g" for k in (K_SHORT, K_LONG))}),
q AS (SELECT doc_id, template, label, t_words, k, diagonal, list(DISTINCT tpos) AS tpos FROM v GROUP BY ALL),
r AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) <= 2 THEN 0 ELSE 1 END AS apart FROM q),
s AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS run FROM r),
o AS (SELECT *, CASE WHEN max(diagonal) OVER (PARTITION BY doc_id, template, run) - min(diagonal) OVER (PARTITION BY doc_id, template, run) > 12 THEN diagonal END AS own FROM s),
m AS (SELECT doc_id, label, t_words, len(list_distinct(flatten(list_transform(flatten(list(tpos)), lambda x: generate_series(x, x + k - 1))))) / t_words AS coverage
  FROM o GROUP BY doc_id, template, label, t_words, k, run, own),
l AS (SELECT doc_id, list(DISTINCT label) AS more, max(coverage) AS best, count(*) AS spans FROM m WHERE coverage >= CASE WHEN t_words < {SHORT} THEN 1.0 ELSE 0.75 END GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, array_to_string(list_sort(coalesce(base, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(more, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score, coalesce(spans, 0) AS n_spans
FROM d LEFT JOIN bb USING (doc_id) LEFT JOIN l USING (doc_id)
"""
