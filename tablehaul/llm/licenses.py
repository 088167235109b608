"""License notices in texts, by MinHash of overlapping windows and exact containment."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Short notices, and openings of well-known public license texts.
NOTICES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under the Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "Licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the Software without restriction"
    ),
    "Apache-2.0 text": (
        "you may not use this file except in compliance with the License. You may obtain a copy "
        "of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "GPL text": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation"
    ),
    "BSD text": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
}
#: Words of a shingle, coordinates of a signature (each a band), least share of a notice's shingles.
SIZE, COORDINATES, CONTAINED = 5, 12, 0.8


def _words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def _shingles(text: str) -> list[str]:
    words = _words(text)
    return [" ".join(words[i : i + SIZE]) for i in range(len(words) - SIZE + 1)]


def keywords(notices: dict[str, str], contained: float) -> list[str]:
    """Words without any of which a text cannot hold ``contained`` of a notice's shingles."""
    chosen: list[str] = []
    for text in notices.values():
        held = set(_shingles(text))
        while held and sum(not set(chosen) & set(s.split()) for s in held) >= contained * len(held):
            free = [s for s in held if not set(chosen) & set(s.split())]
            counts = Counter(w for s in free for w in set(s.split()))
            chosen.append(max(counts, key=lambda w: (counts[w] * len(w) ** 2, w)))
    return chosen


def _window(n: int) -> tuple[int, int]:
    """Size and step, in shingles, of windows one of which covers any run of ``n`` shingles."""
    step = -(-n // 8)
    return n + step - 1, step


def _coordinate(shingle: Column, k: Column) -> Column:
    return F.xxhash64(shingle, k.cast("int"))


def _templates(spark: SparkSession, notices: dict[str, str]) -> DataFrame:
    rows = [(name, *_window(len(set(s))), sorted(set(s))) for name, t in notices.items() if (s := _shingles(t))]
    made = spark.createDataFrame(rows, "license string, size int, step int, shingles array<string>")
    return made.select(
        "license", "size", "step",
        F.transform("shingles", lambda s: F.xxhash64(s)).alias("held"),
    ).withColumn(
        "bands",
        F.transform(
            F.sequence(F.lit(0), F.lit(COORDINATES - 1)),
            lambda k: F.array_min(F.transform("held", lambda x: _coordinate(x, k))),
        ),
    )


def find_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    notices: dict[str, str] | None = None,
    contained: float = CONTAINED,
) -> DataFrame:
    """Which document holds which notice: id, license, contained, first_word.

    Words are runs of a-z and 0-9 after lower-casing, shingles have five of them. For each length
    of notice, every document is cut into overlapping windows, one of which covers the notice
    wherever it stands. A window and a notice of which it holds 0.8 share 60 in 100 of their
    shingles or more, so of 12 MinHash coordinates, each a band, all differ with a chance of
    0.00002. A window retrieved by a band is compared exactly, with a step's more shingles on
    either side; the best share of each document and notice is returned, and the place of the
    first such window, in words.

    Only the words around those of ``keywords(notices)`` are cut into windows: one that holds none
    of them cannot reach the share.
    A null, empty or short text has no notices, nor does a notice of under five words get found. A
    row with a null or repeated id is searched like others; rows that share an id share a result.
    No rows give none. ``notices`` is a small table that becomes part of the plan; by default the
    ones of this module.
    """
    notices = NOTICES if notices is None else notices
    spark = docs.sparkSession
    known = _templates(spark, notices)
    templates = known.collect()
    sizes = sorted({(t.size, t.step) for t in templates})
    hints = keywords(notices, contained)
    if not sizes:
        kind = docs.schema[id_col].dataType.simpleString()
        return spark.createDataFrame(
            [], f"{id_col} {kind}, license string, contained double, first_word int"
        )
    text = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    words = F.split(F.btrim(F.regexp_replace(text, "[^a-z0-9]+", " ")), " ")
    likely = docs.where(F.lower(F.col(text_col)).rlike("|".join(hints)))
    worded = likely.select(F.col(id_col).alias("id"), words.alias("words")).where(F.size("words") >= SIZE)
    reach = max((size + 2 * step for size, step in sizes)) + SIZE
    held_words = F.array(*map(F.lit, hints))
    at = F.filter(
        F.sequence(F.lit(0), F.size("words") - 1),
        lambda i: F.array_contains(held_words, F.get("words", i)),
    )
    around = worded.withColumn("base", F.explode(at)).withColumn(
        "base", F.greatest(F.lit(0), F.col("base") - reach)
    )
    regions = around.select(
        "id", "base", F.slice("words", F.col("base") + 1, 2 * reach + 1).alias("words")
    ).where(F.size("words") >= SIZE)
    hashed = regions.select(
        "id", "base",
        F.transform(
            F.sequence(F.lit(0), F.size("words") - SIZE),
            lambda i: F.xxhash64(F.concat_ws(" ", F.slice("words", i + 1, SIZE))),
        ).alias("h"),
    )
    signed = hashed.withColumn(
        "lanes",
        F.transform(
            F.sequence(F.lit(0), F.lit(COORDINATES - 1)),
            lambda k: F.transform("h", lambda x: _coordinate(x, k)),
        ),
    )

    def least(k: Column, start: Column, size: int) -> Column:
        return F.array_min(F.slice(F.get("lanes", k), start + 1, size))

    def windows(size: int, step: int) -> Column:
        bands = [[t.bands[k] for t in templates if t.size == size] for k in range(COORDINATES)]
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("h") - size + step - 1), F.lit(step))
        hit = F.filter(
            starts,
            lambda s: F.exists(
                F.arrays_zip(
                    F.sequence(F.lit(0), F.lit(COORDINATES - 1)).alias("k"),
                    F.array(*[F.array(*map(F.lit, b)) for b in bands]).alias("of"),
                ),
                lambda b: F.array_contains(b["of"], least(b["k"], s, size)),
            ),
        )
        return F.transform(
            hit,
            lambda s: F.struct(
                F.lit(size).alias("size"),
                (F.col("base") + s).alias("at"),
                F.transform(
                    F.sequence(F.lit(0), F.lit(COORDINATES - 1)), lambda k: least(k, s, size)
                ).alias("bands"),
                F.slice("h", F.greatest(F.lit(1), s + 1 - step), size + 2 * step).alias("near"),
            ),
        )

    every = F.flatten(F.array(*[windows(size, step) for size, step in sizes]))
    near = signed.select("id", F.explode(every).alias("w")).select("id", "w.*")
    keys = near.select("id", "size", "at", "near", F.posexplode("bands").alias("k", "band"))
    wanted = known.select("license", "size", "held", F.posexplode("bands").alias("k", "band"))
    pairs = keys.join(wanted, ["size", "k", "band"]).dropDuplicates(["id", "license", "at", "near"])
    share = F.size(F.array_intersect("held", "near")) / F.size("held")
    found = pairs.withColumn("share", share).where(F.col("share") >= contained)
    return found.groupBy("id", "license").agg(
        F.max("share").alias("contained"),
        F.min_by("at", F.struct(-F.col("share"), "at")).alias("first_word"),
    ).withColumnRenamed("id", id_col)
