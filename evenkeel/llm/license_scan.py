"""License notices by diagonal voting.

Every run of k words of a text is hashed and joined to the places of the same
run in the license templates.  A match votes for the diagonal (place in the
text less place in the template) it lies on.  Votes are counted for each
diagonal, neighbouring diagonals are merged, as a word put in or left out
moves the rest of a notice to the next one, and a merged span counts if enough
of the template's words stand in its matching runs.  Where spans of several
notices lie on each other, the best one counts.  All of it is DataFrame operations.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import column, whole_text

#: What separates words, the phrases that always count, and their labels.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Notices, as their licenses word them.
NOTICES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
    ),
    "cc-by-4.0": ("Licensed under CC BY 4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0",),
    "gpl-2.0": ("licensed under the GNU General Public License, version 2",),
    "gpl-3.0": (
        "licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "mit": (
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
}

#: Words in a run of a notice of so many words; of others and, as the shortest has two, of a phrase.
NOTICE_RUN, LONG, PHRASE_RUN = 3, 20, 2
#: Diagonals this close are merged.
DRIFT = 4
#: Share of a notice's words that a span must hold; and of one with fewer words than that, in which a single word may
#: name another license.
SHARE, SHORT, SHARE_OF_SHORT = 0.8, 9, 0.9

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case."""
    return F.array_remove(F.split(F.translate(text, _UPPER, _LOWER), SEPARATORS, -1), "")


def run_hash(words: Sequence[str]) -> int:
    """What Spark's ``xxhash64`` gives for the words as columns."""
    seed = 42
    for w in words:
        seed = xxhash.xxh64_intdigest(w.encode(), seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def template_runs(phrases: Mapping[str, str], notices: Mapping[str, Sequence[str]]) -> list[tuple]:
    """(template, label, exact, size, n_runs, place, run, hash) of all runs of all templates, in plain Python: they are few."""
    templates = [(t, label, True, PHRASE_RUN) for t, label in phrases.items()]
    templates += [(t, label, False, NOTICE_RUN) for label, texts in notices.items() for t in texts]
    rows = []
    for number, (text, label, exact, size) in enumerate(templates):
        words = [w for w in re.split(SEPARATORS, text.translate(str.maketrans(_UPPER, _LOWER))) if w]
        size = size if len(words) >= LONG else PHRASE_RUN
        if len(words) < size:
            raise ValueError(f"a template of {size} words or more is needed: {text!r}")
        runs = [words[i : i + size] for i in range(len(words) - size + 1)]
        rows += [(number, label, exact, size, len(runs), i, " ".join(r), run_hash(r)) for i, r in enumerate(runs)]
    return rows


def _matching_runs(words: Column, size: int, hashes: list[int]) -> Column:
    """(place, run, hash) of the runs of ``size`` words whose hash is one of ``hashes``: the join's semi-join, made
    before the rows are dealt out, so that only runs which some template has become rows."""

    def at(i):
        return F.xxhash64(*(F.get(words, i + j) for j in range(size)))

    places = F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size)).otherwise(F.array().cast("array<int>"))
    found = F.filter(places, lambda i: at(i).isin(hashes))
    return F.transform(
        found,
        lambda i: F.struct(
            i.cast("long").alias("place"), F.array_join(F.slice(words, i + 1, F.lit(size)), " ").alias("run"), at(i).alias("hash")
        ),
    )


def license_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
    phrases: Mapping[str, str] = PHRASES, notices: Mapping[str, Sequence[str]] = NOTICES,
    drift: int = DRIFT, share: float = SHARE, share_of_short: float = SHARE_OF_SHORT,
) -> DataFrame:
    """(row, doc_id, n_words, label, exact, first_word, n_span, score) for every span found.

    A span begins at word ``first_word`` (from 0) and has ``n_span`` words.  A
    phrase (``exact``) must stand word by word, with score 1; of a notice ``share``
    of the words must stand in matching runs (``share_of_short`` of one under
    ``SHORT`` words), and its score is that share, less for a longer span.  Of
    notices whose spans overlap, those with the best score count.
    A row of ``docs`` without a span gives one row with nulls from ``label`` on.
    ``row`` tells rows with the same id apart.
    """
    spark: SparkSession = docs.sparkSession
    runs = template_runs(phrases, notices)
    sizes = sorted({r[3] for r in runs})
    table = F.broadcast(  # a row for each run of the templates, which are a parameter
        spark.createDataFrame(
            runs, "template int, label string, exact boolean, size int, n_runs int, at int, t_run string, t_hash long"
        )
    )
    words = docs.select(
        F.monotonically_increasing_id().alias("row"), column(id_col).alias("doc_id"), words_of(whole_text(text_col)).alias("words")
    )
    matches = words.select(
        "row", "doc_id", F.size("words").cast("long").alias("n_words"),
        F.concat(*(_matching_runs(F.col("words"), s, sorted({r[7] for r in runs if r[3] == s})) for s in sizes)).alias("found"),
    )
    # One row for each match, and one for a text without any; the only shuffle brings a text's matches together.
    each = matches.select("row", "doc_id", "n_words", F.explode_outer("found").alias("m")).select(
        "row", "doc_id", "n_words", "m.place", "m.run", "m.hash"
    )
    votes = each.join(table, (F.col("hash") == F.col("t_hash")) & (F.col("run") == F.col("t_run")), "left").repartition("row")

    per_text = ["row", "doc_id", "n_words", "template", "label", "exact", "size", "n_runs"]
    diagonals = votes.groupBy(*per_text, (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.collect_set("at").alias("at"), F.min("place").alias("first"), F.max("place").alias("last")
    )
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(order)
    apart = F.when(F.col("exact") | (gap > drift), 1).otherwise(0)
    merged = (
        diagonals.withColumn("apart", apart)
        .withColumn("span", F.sum("apart").over(order))
        .groupBy(*per_text, "span")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("at"))).alias("held"),
            F.min("first").alias("first_word"), F.max("last").alias("last"),
        )
    )
    n_span, n_template = F.col("last") - F.col("first_word") + F.col("size"), F.col("n_runs") + F.col("size") - 1
    # The template's words that matching runs cover.
    covered = F.size(F.array_distinct(F.flatten(F.transform("held", lambda at: F.sequence(at, at + F.col("size") - 1)))))
    score = covered / F.greatest(n_template, n_span)
    needed = F.when(n_template < SHORT, share_of_short).otherwise(share)
    verified = F.when(F.col("exact"), F.size("held") == F.col("n_runs")).otherwise(score >= needed)
    scored = merged.select(
        "row", "doc_id", "n_words", n_span.alias("n_span"), score.alias("score"), "first_word", "label", "exact",
        F.coalesce(verified, F.lit(False)).alias("verified"),
    )
    # Notices on the same words: a crowd of spans ends where a span begins after all before it have ended.
    end = F.when(F.col("verified") & ~F.col("exact"), F.col("first_word") + F.col("n_span"))
    in_text = Window.partitionBy("row", F.isnull(end)).orderBy("first_word", "n_span", "label")
    so_far = F.max(end).over(in_text.rowsBetween(Window.unboundedPreceding, -1))
    crowd = F.sum(F.when(F.col("first_word") < so_far, 0).otherwise(1)).over(in_text)
    best = F.max("score").over(Window.partitionBy("row", F.isnull(end), "crowd"))
    spans = scored.withColumn("crowd", crowd).withColumn("best", best)
    counts = F.col("verified") & (F.col("exact") | (F.col("score") == F.col("best")))
    of_span = ("label", "exact", "first_word", "n_span", "score")
    return spans.select("row", "doc_id", "n_words", *(F.when(counts, F.col(c)).alias(c) for c in of_span))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), one row for each row of ``docs``.

    ``n_base`` counts all places of the phrases, ``first_word`` and
    ``last_word`` are the smallest and largest begin of one (null without any),
    ``base_labels`` are the phrases' labels and ``labels`` those of phrases and
    notices (distinct, sorted, comma-joined, empty without any), ``score`` is
    the best span's score, 0 without any.

    Null text is empty and has no words.  Rows with the same id, null ids among
    them, are scanned each for itself.  An empty table gives no rows; other
    columns are ignored.
    """
    spans = license_spans(docs, id_col, text_col, **options)
    base = F.when(F.col("exact"), F.col("first_word"))

    def joined(label):
        return F.array_join(F.array_sort(F.collect_set(label)), ",")

    return spans.groupBy("row", "doc_id", "n_words").agg(
        F.count(base).alias("n_base"),
        F.min(base).alias("first_word"),
        F.max(base).alias("last_word"),
        joined(F.when(F.col("exact"), F.col("label"))).alias("base_labels"),
        joined(F.col("label")).alias("labels"),
        F.coalesce(F.max("score"), F.lit(0.0)).alias("score"),
    ).drop("row")
