"""License scan: phrases, and an exact set-similarity join with license notices.

A text block is a window of ``WINDOW`` words that starts every ``STRIDE`` words, so any stretch of
``STRIDE`` words lies whole in one.  A block meets a template if it holds at least ``CONTAINED`` of
the template's distinct words: ``need = ceil(CONTAINED * |T|)``.

Words are ordered by their frequency over all documents, rare first.  A block that meets a
template shares one of its first ``|T| - need + 1`` words (prefix filter), has at least ``need``
words (length filter), and from a shared word on both must have enough words left for ``need``
(positional filter).  What passes is checked whole; the filters lose no pair.  All of it is
DataFrame functions; the templates are a fixed short list, so their side is broadcast.

Documents without a prefix word (nearly all) leave before their blocks are made.  Defined cases:
null text is empty: no words, no place, score 0.  Repeated rows each get their result.  Extra
columns are ignored.  ``first_word`` and ``last_word`` are null without a place.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import ascii_lower, hash_key

WINDOW, STRIDE, CONTAINED = 96, 48, 0.9

# Phrases and labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Opening words of public license notices (at most STRIDE words each).
TEMPLATES = {
    "agpl-3.0": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license",
    "apache-2.0": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "cc-by-4.0": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "mit-notice": "released under the mit license",
    "mit-permission": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
}


def spaced(text: Column) -> Column:
    """The words in lower case, each between single spaces; '  ' without words."""
    line = F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))),
                            r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    return F.concat(F.lit(" "), F.trim(line), F.lit(" "))


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def phrase_places(line: Column, n_words: Column, phrases: dict[str, str] = PHRASES) -> dict[str, Column]:
    """n_base, first_word, last_word and base (array of labels) of spaced words."""
    back = F.reverse(line)
    count, first, last, labels = [], [], [], []
    for phrase, label in phrases.items():
        at, end = F.instr(line, f" {phrase} "), F.instr(back, f" {phrase} "[::-1])
        held = at > 0
        count.append(F.when(held, F.regexp_count(line, F.lit(f" {phrase}(?= )"))).otherwise(0))
        first.append(F.when(held, _spaces(F.substring(line, F.lit(1), at)) - 1))
        last.append(F.when(held, n_words - len(phrase.split()) - (_spaces(F.substring(back, F.lit(1), end)) - 1)))
        labels.append(F.when(held, F.lit(label)))
    total = count[0]
    for c in count[1:]:
        total = total + c
    return {"n_base": total.cast("long"), "first_word": F.least(*first).cast("long"),
            "last_word": F.greatest(*last).cast("long"),
            "base": F.array_distinct(F.array_compact(F.array(*labels)))}


def word_frequencies(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> dict[str, int]:
    """Occurrences of the given words over all documents."""
    w = docs.select(F.explode(F.split(spaced(F.col(text_col)), " ")).alias("w"))
    rows = w.where(F.col("w").isin(vocabulary)).groupBy("w").agg(F.count("*").alias("n")).collect()
    return {x: 0 for x in vocabulary} | {r.w: r.n for r in rows}  # a row a word of the templates


def ordered_templates(templates: dict[str, str], frequency: dict[str, int],
                      contained: float = CONTAINED) -> list[tuple[str, list[str], int]]:
    """(label, distinct words rare first, need) of each template."""
    out = []
    for label, text in sorted(templates.items()):
        ws = sorted(set(text.split()), key=lambda w: (frequency.get(w, 0), w))
        out.append((label, ws, ceil(contained * len(ws) - 1e-9)))
    return out


def block_matches(lines: DataFrame, templates: list[tuple[str, list[str], int]]) -> DataFrame:
    """(row, label, contained) of the blocks of ``lines`` (row, words) that meet a template."""
    spark = lines.sparkSession
    order = sorted({w for _, ws, _ in templates for w in ws},
                   key={w: i for _, ws, _ in templates for i, w in enumerate(ws)}.get)
    prefix = F.broadcast(spark.createDataFrame(
        [(w, i, label, ws, need) for label, ws, need in templates
         for i, w in enumerate(ws[:len(ws) - need + 1])],
        "word string, i int, label string, t_words array<string>, need int"))
    vocabulary = F.array(*map(F.lit, order))
    blocks = (lines.select("row", "words", F.explode(F.sequence(
        F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(STRIDE))).alias("at"))
        # the block's words that any template holds, each once
        .select("row", "at", F.array_intersect(
            F.slice("words", F.col("at") + 1, WINDOW), vocabulary).alias("b_words")))
    pairs = (blocks.withColumn("word", F.explode("b_words")).join(prefix, "word")
             .where((F.size("b_words") >= F.col("need")) & (F.size("t_words") - F.col("i") >= F.col("need"))))
    # of the shared prefix words the first (in the template's order) decides
    pairs = pairs.groupBy("row", "at", "label").agg(
        F.min("i").alias("i"), F.first("b_words").alias("b_words"),
        F.first("t_words").alias("t_words"), F.first("need").alias("need"))
    rest = F.expr("size(array_intersect(b_words, slice(t_words, i + 1, size(t_words))))")
    return (pairs.where(rest >= F.col("need"))
            .withColumn("contained", F.size(F.array_intersect("b_words", "t_words")) / F.size("t_words"))
            .where(F.size(F.array_intersect("b_words", "t_words")) >= F.col("need"))
            .select("row", "label", "contained"))


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  templates: dict[str, str] = TEMPLATES, contained: float = CONTAINED) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    spark = docs.sparkSession
    vocabulary = sorted({w for t in templates.values() for w in t.split()})
    ordered = ordered_templates(templates, word_frequencies(docs, vocabulary, text_col), contained)
    starts = sorted({w for _, ws, need in ordered for w in ws[:len(ws) - need + 1]})
    line = F.col("line")
    path = scratch_path(spark, "licenses")
    key = hash_key(0, F.col(id_col), F.md5(F.col(text_col)))
    rows = (docs.select(F.col(id_col).alias("doc_id"), key.alias("row"), spaced(F.col(text_col)).alias("line"))
            .withColumn("n_words", F.when(F.length(line) > 2, _spaces(line) - 1).otherwise(0).cast("long"))
            .withColumns(phrase_places(line, F.col("n_words"))))
    held = line.contains(f" {starts[0]} ")
    for w in starts[1:]:
        held = held | line.contains(f" {w} ")
    rows.withColumn("words", F.when(held, F.split(F.trim(line), " "))).drop("line").write.parquet(path)
    rows = spark.read.parquet(path)
    found = (block_matches(rows.where("words is not null").select("row", "words").dropDuplicates(["row"]), ordered)
             .groupBy(F.col("row").alias("r")).agg(F.collect_set("label").alias("met"),
                                                   F.max("contained").alias("best")))
    both = F.array_sort(F.array_union("base", F.coalesce("met", F.array().cast("array<string>"))))
    return (rows.drop("words").join(found, F.col("row") == F.col("r"), "left")
            .select("doc_id", "n_words", "n_base", "first_word", "last_word",
                    F.array_join(F.array_sort("base"), ",").alias("base_labels"),
                    F.array_join(both, ",").alias("labels"),
                    F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score")))


def oracle(table: str = "documents") -> str:
    """The same by brute force in SQL: every block against every template."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    phrases = " union all ".join(
        f"select doc_id, {k} n, '{label}' label, i from p where " + " and ".join(
            f"w[i + {j + 1}] = '{x}'" for j, x in enumerate(phrase.split()))
        for phrase, label in PHRASES.items() for k in [len(phrase.split())])
    t = ", ".join(f"('{label}', {sorted(set(text.split()))!r})" for label, text in sorted(TEMPLATES.items()))
    return f"""
with d as materialized (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
               '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w from {table}),
p as (select doc_id, w, unnest(range(len(w))) i from d),
places as ({phrases}),
base as (select doc_id, count(*) n_base, min(i) first_word, max(i) last_word,
                list_sort(list(distinct label)) base from places group by doc_id),
t as (select * from (values {t}) x(label, ws)),
b as (select doc_id, w[i + 1 : i + {WINDOW}] bw from p where i % {STRIDE} = 0),
met as (select doc_id, label, max(len(list_intersect(bw, ws)) / len(ws)) c from b, t
        where len(list_intersect(bw, ws)) >= ceil({CONTAINED} * len(ws) - 1e-9) group by all),
m as (select doc_id, list(distinct label) met, max(c) best from met group by doc_id)
select d.doc_id, cast(len(w) as bigint) n_words, coalesce(n_base, 0) n_base, first_word, last_word,
       coalesce(array_to_string(base, ','), '') base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(met, [])))), ',') labels,
       case when n_base > 0 then 1.0::double else coalesce(best, 0)::double end score
from d left join base using (doc_id) left join m using (doc_id)"""
