"""License texts in documents, by diagonal voting.

All k-grams of words that could begin a template's k-gram are joined with the templates'
k-grams. A match votes for its diagonal, its place in the document less its place in the
template. Votes are summed by diagonal, neighbouring diagonals (a word put in or left out)
are merged, and a span counts if enough of the template was found in it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, LETTER_WORD, letter_words, literal_table, lower_ascii, rolling, whole

#: k-grams have this many words, or all words of a shorter phrase.
K = 3
#: Diagonals this close belong to one span; a span counts from this share of a template on.
NEIGHBOUR, SIMILAR = 4, 0.8

#: Base phrases and their labels (fixed values).
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Sentences by which widely used licenses are recognised (fixed values, from the licenses).
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "gpl-3.0": "licensed under the GNU General Public License, version 3",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0": "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    "and associated documentation files, to deal in the Software without restriction",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain",
}


@dataclass(frozen=True)
class Gram:
    label: str
    exact: bool
    k: int
    tpos: int
    grams: int
    gram: str


def grams(templates: dict[str, str], exact: bool) -> list[Gram]:
    """All k-grams of templates; an exact phrase is one gram, the whole of it."""
    found = []
    for text, label in ((t, n) for n, t in templates.items()):
        part = re.findall(LETTER_WORD, "".join(c.lower() if c < "\x80" else c for c in text))
        k = len(part) if exact else min(K, len(part))
        for i in range(len(part) - k + 1):
            found.append(Gram(label, exact, k, i, len(part) - k + 1, f"{k} {' '.join(part[i : i + k])}"))
    return found


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: dict[str, str] = BASE,
    templates: dict[str, str] = TEMPLATES,
) -> DataFrame:
    """Per row: id, ``n_words``, the base phrases' places and labels, all labels, ``score``.

    Every place of a base phrase counts, overlapping ones too. ``score`` is the largest share
    of a template's k-grams found in one span, 1 where a base phrase stands. Null text is
    empty: no words, no places, empty labels, score 0. Rows that repeat an id are judged one
    by one. An empty table gives an empty result; other columns are ignored. Templates are a
    parameter and must stay small (they are sent to all tasks, which is checked).
    """
    wanted = grams({label: phrase for phrase, label in base.items()}, True) + grams(templates, False)
    if sum(2 * len(g.gram) + 64 for g in wanted) > BROADCAST_BYTES:
        raise ValueError("too many license templates for one table of constants")
    table = literal_table(
        docs.sparkSession,
        [(g.label, g.exact, g.tpos, g.grams, g.gram) for g in wanted],
        ["label", "exact", "tpos", "grams", "gram"],
    ).withColumn("hash", F.xxhash64("gram"))
    sizes = sorted({g.k for g in wanted})
    first = sorted({g.gram.split(" ")[1] for g in wanted})
    # an empty word before the first one makes a row that stands for the document
    parted = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.concat(F.array(F.lit("")), letter_words(lower_ascii(whole(F.col(text_col))))).alias("part"),
    )
    rows = (
        parted.select(
            "row",
            "id",
            (F.size("part") - 1).cast("long").alias("n_words"),
            F.posexplode(rolling("part", max(sizes))).alias("at", "w"),
        )
        .where(F.col("w.w0").isin("", *first))
        .select(
            "row",
            "id",
            "n_words",
            (F.col("at") - 1).alias("pos"),
            F.explode(
                F.array(*(F.concat_ws(" ", F.lit(str(k)), *(f"w.w{j}" for j in range(k))) for k in sizes))
            ).alias("text"),
        )
        .withColumn("key", F.xxhash64("text"))
    )
    votes = (
        rows.join(F.broadcast(table), (F.col("key") == F.col("hash")) & (F.col("text") == F.col("gram")), "left")
        .where("pos = -1 OR gram IS NOT NULL")
        .groupBy("row", "id", "n_words", "label", "exact", "grams", (F.col("pos") - F.col("tpos")).alias("diagonal"))
        .agg(F.collect_set("tpos").alias("voted"), F.min("pos").alias("start"))
    )
    near = Window.partitionBy("row", "label", "exact").orderBy("diagonal")
    apart = F.col("exact") | (F.col("diagonal") - F.lag("diagonal").over(near) > NEIGHBOUR)
    spans = (
        votes.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("span", F.sum("new").over(near))
        .groupBy("row", "id", "n_words", "label", "exact", "grams", "span")
        .agg(
            (F.size(F.array_distinct(F.flatten(F.collect_list("voted")))) / F.col("grams")).alias("share"),
            F.min("start").cast("long").alias("start"),
        )
    )
    is_base = F.col("exact")
    named = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    return (
        spans.groupBy("row", "id", "n_words")
        .agg(
            F.count(F.when(is_base, 1)).alias("n_base"),
            F.min(F.when(is_base, F.col("start"))).alias("first_word"),
            F.max(F.when(is_base, F.col("start"))).alias("last_word"),
            named(is_base).alias("base_labels"),
            named(is_base | (F.col("share") >= SIMILAR)).alias("labels"),
            F.coalesce(F.max(F.when(F.col("label").isNotNull(), F.col("share"))), F.lit(0.0)).alias("score"),
        )
        .drop("row")
        .withColumnRenamed("id", id_col)
    )
