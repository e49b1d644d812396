"""License scan by diagonal voting, in DataFrame operations only.

Templates are word sequences of any length. All rolling word k-grams of a text are joined by hash to the k-gram positions
of the templates, and the words themselves are compared; a hit votes for the diagonal text position minus template
position. Votes are summed by diagonal as bit masks of matched template positions, 60 positions to a mask; neighbouring
diagonals (an inserted or lost word shifts the rest by one) are merged into spans. A span is verified by its two covers:
enough of the template's positions stand in it, and they make up enough of the span. A phrase template counts only places
where all of it stands on one diagonal, which is the phrase itself.

One pass over the texts: a text is read once, and its hits and one row that stands for the text itself meet again by the
number of the row. Everything after that stays where it is, and a row number holds no more than its own text's hits.

Nulls: a null text is empty; a text without words has n_words 0 and no label. Each row is a text of its own, whatever its
id, so rows that repeat an id and rows with a null id are scanned like any other. Extra columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import id_text

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases that label a text wherever their words stand consecutively.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Openings and key sentences of public licenses, which label a text that holds most of one of them.
NOTICES = {
    "apache": ["licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "cc-by-nc": ["licensed under cc by nc 4.0", "creative commons attribution noncommercial 4.0 international license"],
    "cc-by-sa": ["licensed under cc by sa 4.0", "creative commons attribution sharealike 4.0 international license"],
    "gpl": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"],
    "lgpl": ["under the terms of the gnu lesser general public license as published by the free software foundation"],
    "mit": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"],
    "mpl": ["this source code form is subject to the terms of the mozilla public license v 2.0"],
    "all-rights-reserved": ["all rights reserved no part of this publication may be reproduced"],
}


#: Bits of a mask that stand for template positions.
_BITS = 60
#: Gram positions of templates up to which their table is broadcast (a few hundred bytes each); a larger one is shuffled.
_MOST_BROADCAST = 100_000
#: Keys that stand for texts where they are shuffled.
_SALTS = 1024
_KIND = "template int, label string, phrase boolean, at int, grams int, template_words int, t0 string, t1 string, t2 string"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; none of null."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # lower() changes other letters as well, which matters only where one becomes a letter of a-z: the Kelvin sign does.
    low = F.when(text.contains("\u212a"), ascii_only).otherwise(F.lower(text))
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def template_grams(spark: SparkSession, phrases: dict[str, str], notices: dict[str, list[str]]) -> tuple[DataFrame, int]:
    """One row for each k-gram position of each template: two words of a phrase, three of a notice; and their number. A row
    of empty words, which no text has, is met by the row that stands for a text."""
    texts = [(phrase, label, True) for phrase, label in phrases.items()] + [(text, label, False) for label, own in notices.items() for text in own]
    rows = [(None, None, None, 0, 1, 0, "", "", None)]
    for number, (text, label, phrase) in enumerate(texts):
        words = re.findall(WORD, text.translate(_LOWER))
        if len(words) < 2:
            raise ValueError(f"a template needs two words: {text!r}")
        k = 2 if phrase or len(words) < 3 else 3
        grams = len(words) - k + 1
        rows += [(number, label, phrase, i, grams, len(words), words[i], words[i + 1], words[i + 2] if k == 3 else None) for i in range(grams)]
    return spark.createDataFrame(rows, _KIND), len(rows)


def license_scan(docs: DataFrame, phrases: dict[str, str] | None = None, notices: dict[str, list[str]] | None = None, min_cover: float = 0.6, min_density: float = 0.5, max_shift: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and the verified spans of every row.

    min_cover: least share of a notice's grams in a span; min_density: least share of these in the span's own length;
    max_shift: diagonals so far apart belong to one span.
    """
    spark = docs.sparkSession
    grams, n_grams = template_grams(spark, PHRASES if phrases is None else phrases, NOTICES if notices is None else notices)
    grams = grams.withColumn("gram", F.xxhash64("t0", "t1"))
    texts = id_text(docs, id_col, text_col).select("doc_id", F.monotonically_increasing_id().alias("row"), words_of(F.col("text")).alias("words"))
    n = F.size("words")
    rolled = texts.select("doc_id", "row", n.cast("long").alias("n_words"), "words", F.explode(F.sequence(F.lit(-1), F.greatest(n - 2, F.lit(-1)))).alias("pos"))
    word = lambda k: F.when(F.col("pos") < 0, F.lit("")).otherwise(F.get("words", F.col("pos") + k))
    same = lambda w0, w1, w2: (w0 == F.col("t0")) & (w1 == F.col("t1")) & (F.col("t2").isNull() | F.col("t2").eqNullSafe(w2))
    if n_grams <= _MOST_BROADCAST:
        hits = rolled.join(F.broadcast(grams), (F.xxhash64(word(0), word(1)) == F.col("gram")) & same(word(0), word(1), word(2)))
    else:
        # A position is shuffled with its three words alone, and the rows that stand for texts are dealt out by a salt.
        held = grams.where("t0 <> ''").unionByName(grams.where("t0 = ''").withColumn("gram", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_SALTS - 1).cast("long")))))
        gram = F.when(F.col("pos") < 0, F.pmod("row", F.lit(_SALTS))).otherwise(F.xxhash64("w0", "w1"))
        placed = rolled.select("doc_id", "row", "n_words", "pos", *[word(k).alias(f"w{k}") for k in range(3)]).withColumn("place", gram)
        hits = placed.join(held.hint("merge"), (F.col("place") == F.col("gram")) & same(F.col("w0"), F.col("w1"), F.col("w2")))

    # From here on all rows of a text are together: aggregates and windows by the row number shuffle nothing more.
    text, kind = ["row", "doc_id", "n_words"], ["template", "label", "phrase", "grams", "template_words"]
    chunk, bit = F.floor(F.col("at") / _BITS).cast("int"), (F.col("at") % _BITS).cast("int")
    voted = hits.select(*text, *kind, (F.col("pos") - F.col("at")).alias("diagonal"), "pos", chunk.alias("chunk"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("mask")).repartition("row")
    votes = voted.groupBy(*text, *kind, "diagonal", "chunk").agg(F.bit_or("mask").alias("mask"), F.min("pos").alias("low"), F.max("pos").alias("high"))
    by = W.partitionBy("row", "template").orderBy("diagonal", "chunk")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by) > F.when(F.col("phrase"), 0).otherwise(max_shift), F.lit(True)).cast("int")
    runs = votes.withColumn("apart", apart).withColumn("run", F.sum("apart").over(by))
    merged = runs.groupBy(*text, *kind, "run", "chunk").agg(F.bit_or("mask").alias("mask"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("diagonal").alias("diagonal"))
    spans = merged.groupBy(*text, *kind, "run").agg(F.sum(F.bit_count("mask")).alias("matched"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("diagonal").alias("diagonal"))
    cover = F.col("matched") / F.col("grams")
    verified = F.when(F.col("phrase"), cover == 1).otherwise((cover >= min_cover) & (F.col("matched") >= min_density * (F.col("high") - F.col("low") + 1)))

    found, base = F.col("template").isNotNull() & verified, F.col("phrase") & verified
    k = F.col("template_words") - F.col("grams") + 1
    one = F.struct("label", F.col("low").cast("long").alias("first_word"), (F.col("high") + k).cast("long").alias("end_word"), cover.alias("cover"))
    out = spans.groupBy(*text).agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("diagonal"))).cast("long").alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("base"),
        F.collect_set(F.when(found, F.col("label"))).alias("every"),
        F.coalesce(F.max(F.when(found, cover)), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(found & ~F.col("phrase"), one))).alias("spans"),
    )
    listed = lambda c: F.array_join(F.array_sort(c), ",")
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", listed("base").alias("base_labels"), listed("every").alias("labels"), "score", F.size("spans").cast("long").alias("n_spans"), "spans")
