"""License scans: MinHash bands over overlapping text windows, then exact containment.

Texts become words and the words 5-word shingles.  Templates are grouped into
classes by length; a class of up to c words is looked for in windows of 2c words
that start every c words, so any copy of a template lies in a window as a whole.

The MinHash sample of a window are its k smallest shingle hashes, and each is a
band of one row: a window and a template meet if they share a band.  The k
smallest hashes of both together that both hold are in both samples, so a window
with s of u different shingles in common misses with a probability of at most
C(u - s, k) / C(u, k).  k is the least number that brings this below ``MISS`` for
every template of the class at the wanted containment.  Nothing else retrieves;
for notices of a few words k reaches the whole window and nothing can be missed.

Matches are confirmed by the share of the template's shingles that the window
holds, on the shingles' words.  Every text is read and hashed once for all
classes.  Templates are a parameter: their number and size do not depend on the
data, and they are the only broadcast.
"""

from __future__ import annotations

import math
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE, CONTAINMENT, MISS = 5, 0.8, 1e-6
#: Classes by length; longer templates add classes that double.
CLASSES = (8, 16, 128)

#: Fixed texts: notices as they are commonly written.
NOTICES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"),
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so"),
}
#: Fixed texts: whole licenses, one file each in the folder ``licenses``.
BODIES = {f"{p.stem}-text": p.read_text(encoding="utf-8") for p in sorted(Path(__file__).with_name("licenses").glob("*.txt"))}
TEMPLATES = NOTICES | BODIES
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def template_words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.translate(str.maketrans(_UPPER, _LOWER)))


def template_shingles(text: str) -> list[str]:
    w = template_words(text)
    return sorted({" ".join(w[i:i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)})


def classes_for(longest: int, classes: tuple[int, ...] = CLASSES) -> tuple[int, ...]:
    """``classes``, doubled until the last holds a template of ``longest`` words."""
    while classes[-1] < longest:
        classes += (2 * classes[-1],)
    return classes


def shared_least(text: str, containment: float = CONTAINMENT) -> int:
    """Shingles of a template that a window must hold, one at least."""
    return max(math.ceil(containment * len(template_shingles(text)) - 1e-9), 1)


def bands_for(size: int, templates: list[str], containment: float = CONTAINMENT) -> int:
    """Bands that a class of ``size`` words needs to miss a match with a probability of at most MISS."""
    most = 1
    for t in templates:
        shared = shared_least(t, containment)
        either = 2 * size - SHINGLE + 1 + len(template_shingles(t)) - shared
        miss, bands = 1.0, 0
        while miss > MISS:
            miss *= max(either - shared - bands, 0) / (either - bands)
            bands += 1
        most = max(most, bands)
    return most


def _words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lowered, F.lit("[a-z0-9]+"), F.lit(0))


def _hashes(words: Column) -> Column:
    """Hashes of the 5-word shingles of an array of words, in order."""
    return F.when(F.size(words) >= SHINGLE, F.transform(
        F.sequence(F.lit(0), F.size(words) - SHINGLE),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]))).otherwise(F.array().cast("array<bigint>"))


def _sample(hashes: Column, bands: Column) -> Column:
    """MinHash sample: the ``bands`` smallest different hashes."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), F.lit(1), bands)


def _phrases(words: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(words) - SHINGLE + 1),
                       lambda i: F.array_join(F.slice(words, i, SHINGLE), " "))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column through a generator, which keeps later filters from copying its expression."""
    return df.withColumn(name, F.explode(F.array(value)))


def _template_frame(spark: SparkSession, classes: list[tuple[int, int, list[str]]], templates: dict[str, str]) -> DataFrame:
    """license, words, size and bands of its class."""
    rows = [F.struct(F.lit(name).alias("license"), F.lit(templates[name]).alias("body"), F.lit(size).alias("size"),
                     F.lit(bands).alias("bands")) for size, bands, names in classes for name in names]
    return _once(spark.range(1).select(F.inline(F.array(*rows))), "words", _words(F.col("body"))).drop("body")


def _starts(size: int, bands: int, least: int) -> Column:
    """Windows of a class as structs (first_word, size, bands); those with fewer than ``least`` shingles cannot match."""
    last = F.size("hashes") - least
    windows = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(size)), lambda at: F.struct(
        at.alias("first_word"), F.lit(size).alias("size"), F.lit(bands).alias("bands")))
    return F.when(last >= 0, windows).otherwise(F.slice(windows, 1, 0))


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None,
                  containment: float = CONTAINMENT, classes: tuple[int, ...] = CLASSES) -> DataFrame:
    """One row per document and license found: doc_id, license, containment, first_word, n_windows.

    ``containment`` is the largest share of the template's shingles in a window;
    of the windows with at least the wanted share, ``first_word`` is the start
    of the first and ``n_windows`` the number.  Words are runs of [a-z0-9] after
    lower-casing A-Z.  Null, empty and short texts match nothing; rows that repeat
    an id are the same document and are reported together.  Templates need at
    least five words; those longer than the largest class get classes of their own.
    No templates find nothing.
    """
    spark = df.sparkSession
    templates = TEMPLATES if templates is None else templates
    sizes = {name: len(template_words(text)) for name, text in templates.items()}
    if any(n < SHINGLE for n in sizes.values()):
        raise ValueError(f"templates must have at least {SHINGLE} words")
    bounds = classes_for(max(sizes.values(), default=0), tuple(classes))
    used, starts = [], []
    for low, size in zip((0, *bounds[:-1]), bounds, strict=True):
        own = sorted(n for n in templates if low < sizes[n] <= size)
        if own:
            texts = [templates[n] for n in own]
            used.append((size, bands_for(size, texts, containment), own))
            starts.append(_starts(size, used[-1][1], min(shared_least(t, containment) for t in texts)))
    found = "doc_id", "license", "containment", "first_word", "n_windows"
    docs = _once(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t")), "words", _words(F.col("t"))).drop("t")
    if not used:
        empty = docs.where("1 = 0").selectExpr("doc_id", "'' license", "0D containment", "0 first_word", "0L n_windows")
        return empty.select(*found)
    notices = _template_frame(spark, used, templates)
    samples = (_once(_once(notices, "hashes", _hashes(F.col("words"))), "wanted", _sample(F.col("hashes"), F.col("bands")))
               .select("license", "size", "wanted", F.explode("wanted").alias("band")))
    docs = _once(docs, "hashes", _hashes(F.col("words")))
    # the starts are a column first: a generator over a plain column stays in generated code and does not copy the texts
    docs = _once(docs, "starts", F.concat(*starts))
    windows = docs.select("doc_id", "words", "hashes", F.inline("starts"))
    windows = _once(windows, "sample", _sample(
        F.slice("hashes", F.col("first_word") + 1, 2 * F.col("size") - SHINGLE + 1), F.col("bands")))
    # of the bands that a window shares with a template, the smallest speaks for it
    met = (windows.select("doc_id", "words", "first_word", "size", "sample", F.explode("sample").alias("band"))
           .join(F.broadcast(samples), ["size", "band"])
           .where(F.col("band") == F.array_min(F.array_intersect("sample", "wanted")))
           .select("doc_id", "license", "first_word", F.slice("words", F.col("first_word") + 1, 2 * F.col("size")).alias("window")))
    phrases = notices.select("license", F.array_distinct(_phrases(F.col("words"))).alias("phrases"))
    shares = _once(met.join(F.broadcast(phrases), "license"), "share",
                   F.size(F.array_intersect(_phrases(F.col("window")), F.col("phrases"))) / F.size("phrases"))
    return (shares.where(F.col("share") >= containment).groupBy("doc_id", "license")
            .agg(F.max("share").alias("containment"), F.min("first_word").alias("first_word"),
                 F.count_distinct("first_word").alias("n_windows")).select(*found))
