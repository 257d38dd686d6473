"""License scans: an exact set-similarity join of text blocks with templates.

Blocks are overlapping windows of words. The words of the templates are ordered
by their frequency in the whole corpus; a block that holds enough of a template
must hold one of its rarest words (prefix filter), have enough of its words at
all (length filter) and, from the first shared word in that order on, both must
still have enough left (positional filter). What passes is compared set with set.

Only DataFrame functions are used. The templates are a parameter of fixed size,
so the index made of them is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from touchline.llm.common import stored

# Phrases whose places are the base, with their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Texts by which a license is stated.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache", "licensed under the apache license version 2.0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-nc", "licensed under cc by nc 4.0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4.0 international license"),
)

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A block begins every ``STRIDE`` words and is twice as long. Templates longer than
#: that have a stride of the next power of two, so each stands whole in a block.
STRIDE = 32
CONTAINMENT = 0.85


def _stride(words: int) -> int:
    return max(STRIDE, 1 << (words - 1).bit_length())


def words_of(text: str) -> Column:
    """Words of a text, A-Z lower-cased; none for null."""
    low = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER, LOWER)
    return F.filter(F.split(low, NO_WORD), lambda w: w != "")


def _template_words(text: str) -> list[str]:
    return list(dict.fromkeys(text.replace(".", " ").split()))


def _phrase_starts(words: str, phrase: str) -> Column:
    """Starts of a phrase, from the places of its last word."""
    parts = phrase.split()
    n = len(parts)

    def here(w: Column, i: Column) -> Column:
        fits = w == parts[-1]
        for back, part in enumerate(reversed(parts[:-1]), 1):
            fits = fits & (F.get(words, i - back) == part)
        return F.when(fits, i - (n - 1))

    found = F.filter(F.transform(words, here), lambda p: p.isNotNull())
    any_at_all = F.array_contains(words, parts[-1])
    return F.when(any_at_all, found).otherwise(F.array().cast("array<int>"))


def _labelled(starts: Column, label: str) -> Column:
    return F.transform(starts, lambda p: F.struct(F.lit(label).alias("label"), p.alias("start")))


def scan_licenses(
    docs: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """``keep`` and, of every row, ``n_words``, ``places`` (label and start of every
    base phrase), ``found`` (labels the join gives) and ``score``, the largest
    containment of a template in a block that meets the threshold, else 0.

    A null text counts as empty: no words, no places, no labels. Rows that occur
    twice stay two rows. Templates may have any length: longer ones have longer blocks.
    """
    spark = docs.sparkSession
    sets = [(label, _template_words(t)) for label, t in templates]
    ws_of = [len(t.replace(".", " ").split()) for _, t in templates]
    vocabulary = sorted({w for _, ws in sets for w in ws})

    rows = docs.select(F.struct(*keep).alias("kept"), words_of(text).alias("words"))
    # The array is made once per row: a filter on it keeps Spark from merging
    # the projection that splits the text into the one that uses its words.
    rows = rows.where(F.size("words") >= 0)
    places = F.concat(*(_labelled(_phrase_starts("words", phrase), label) for phrase, label in PHRASES))
    marked = F.transform("words", lambda w, i: F.when(w.isin(vocabulary), F.struct(w.alias("w"), i.alias("i"))))
    rows = stored(
        rows.select(
            F.monotonically_increasing_id().alias("row"),
            "kept",
            F.size("words").cast("long").alias("n_words"),
            places.alias("places"),
            F.filter(marked, lambda h: h.isNotNull()).alias("hits"),
        ),
        "license_words",
    )

    # global order of the templates' words, and the index of their prefixes; both are
    # as large as the templates, which are a parameter
    counts = rows.select(F.explode("hits.w").alias("w")).groupBy("w").count().collect()
    often = {r["w"]: r["count"] for r in counts}
    place = {w: n for n, w in enumerate(sorted(vocabulary, key=lambda w: (often.get(w, 0), w)))}
    order = spark.createDataFrame(list(place.items()) or [("", 0)], "w string, place int")
    entries = []
    for number, (label, ws) in enumerate(sets):
        ws = sorted(place[w] for w in ws)
        need = math.ceil(containment * len(ws) - 1e-9)
        entries += [(w, number, label, _stride(ws_of[number]), at, need, ws) for at, w in enumerate(ws[: len(ws) - need + 1])]
    index = spark.createDataFrame(
        entries, "place int, template int, label string, stride int, at int, need int, ws array<int>"
    )
    words = {n: w for w, n in place.items()}
    first = sorted({words[e[0]] for e in entries})

    hits = rows.select("row", "hits").where(F.arrays_overlap("hits.w", F.array(*map(F.lit, first)).cast("array<string>")))
    hits = hits.select("row", F.explode("hits").alias("h")).select("row", F.col("h.i").alias("i"), F.col("h.w").alias("w"))
    hits = hits.join(F.broadcast(order), "w")
    strides = sorted({e[3] for e in entries}) or [STRIDE]
    numbers = lambda n: ((F.col("i") / n).cast("int"), (F.col("i") / n).cast("int") - 1)
    within = [F.struct(F.lit(n).alias("stride"), block.alias("block")) for n in strides for block in numbers(n)]
    hits = hits.select("row", F.explode(F.array(*within)).alias("b"), "place").select("row", "b.stride", "b.block", "place")
    blocks = hits.groupBy("row", "stride", "block").agg(F.array_sort(F.collect_set("place")).alias("held"))  # no more than the templates' words
    pairs = blocks.select("*", F.posexplode("held").alias("pos", "place")).join(F.broadcast(index), ["place", "stride"])
    pairs = pairs.where(F.size("held") >= F.col("need"))
    # behind the first shared word, what both sides have left bounds what they can share
    pairs = pairs.groupBy("row", "stride", "block", "template").agg(
        F.min(F.struct("at", "pos")).alias("first"), *(F.first(c).alias(c) for c in ("held", "label", "need", "ws"))
    )
    left = F.least(F.size("ws") - F.col("first.at"), F.size("held") - F.col("first.pos"))
    pairs = pairs.where(left >= F.col("need"))
    shared = F.size(F.array_intersect("held", "ws"))
    linked = pairs.where(shared >= F.col("need")).select("row", "label", (shared / F.size("ws")).alias("share"))
    linked = linked.groupBy("row").agg(F.collect_set("label").alias("found"), F.max("share").alias("score"))

    whole = rows.select("row", "kept", "n_words", "places").join(linked, "row", "left")
    return whole.select(
        "kept.*",
        "n_words",
        "places",
        F.coalesce("found", F.array().cast("array<string>")).alias("found"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
