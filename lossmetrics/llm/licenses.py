"""License scan: TF-IDF cosine of lines to license templates, then inheritance from the nearest directory with a license.

Every line of a file is compared with the templates of all licenses as a sparse TF-IDF vector. Document frequencies of the
templates' words are counted over all files; a word of no template counts as occurring in no file. Lines are only weighed
when they hold a word without which no template reaches the threshold: for each template the shortest list of its heaviest
words whose absence leaves less than the threshold. That filter loses nothing.

Files that hold one of a few licence words are read more closely, with dampened term counts: the whole file is compared with
full licence texts, and joined passages (2 to 20 lines from each line with such a word, or from the line before it) with
headers, short texts and statements, so that wrapped statements count. A full text goes before passages and lines.

Near variants resemble each other, so a match also has to hold its licence's deciding words, as its version, and none of
those of another variant; a line that names a licence or version of no template gets none.

A file with a match has that license. A file without one takes the license of a licence file (``LICENSE``,
``COPYING``, ``NOTICE``) in its directory or the nearest one above. Directories, not files, are joined with their ancestors.

Everything is DataFrame functions. The driver gets the heaviest words of the templates, no more than the templates have.

Defined cases: a null or empty text has no license of its own; a null path is in no directory and inherits nothing; between
equal cosines, and between licence files of one directory, the first name in order wins; repeated rows are scanned alike and
all come back; an empty table gives an empty table; columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lossmetrics.llm.tables import written

THRESHOLD = 0.6
# Statements of licenses.
TEMPLATES = (
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
_GNU = (
    "This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} General Public License as published by "
    "the Free Software Foundation, either version {2} of the License, or (at your option) any later version."
)
#: Headers that span lines.
HEADERS = (
    ("AGPL-3.0", _GNU.format("program", "Affero", "3")),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("GPL-2.0", _GNU.format("program", "", "2")),
    ("GPL-3.0", _GNU.format("program", "", "3")),
    ("LGPL-2.1", _GNU.format("library", "Lesser", "2.1")),
    ("LGPL-3.0", _GNU.format("library", "Lesser", "3")),
)
_V2, _V3, _V21 = (rf"\b(version |v ?|[al]?gpl ?v?){n}\b(?! ?{no})" for n, no in (("2", "1"), ("3", "[1-9]"), ("2 1", "[0-9]")))
_CC = r"\b(nc|nd|sa|noncommercial|noderivatives|noderivs|sharealike)\b"
#: License to (pattern that its statements and headers hold, pattern that they do not hold), over words joined by spaces.
DECIDING = {
    "AGPL-3.0": (rf"\b(affero|agpl\w*)\b.*?{_V3}|\bagpl ?v?3\b", ""),
    "Apache-2.0": (r"\bapache\b.*\b(version |v)?2( 0)?\b", r"\bapache license version 1\b"),
    "BSD-2-Clause": ("", r"\bendorse or promote\b|\backnowledge?ment\b"),
    "BSD-3-Clause": (r"\bbsd style\b|\bendorse or promote\b", r"\b(2|4|two|four) clause\b"),
    "CC-BY-4.0": (r"\b4 0\b", _CC),
    "CC-BY-NC-4.0": (r"\bnc 4 0\b", r"\b(nd|sa)\b"),
    "CC-BY-NC-ND-4.0": (r"\bnc nd 4 0\b", ""),
    "CC-BY-NC-SA-4.0": (r"\bnc sa 4 0\b", ""),
    "CC-BY-ND-4.0": (r"\bby nd 4 0\b", ""),
    "CC-BY-SA-4.0": (r"\bby sa 4 0\b", ""),
    "GPL-2.0": (_V2, r"\b(affero|lesser|library general|lgpl\w*|agpl\w*)\b"),
    "GPL-3.0": (_V3, r"\b(affero|lesser|library general|lgpl\w*|agpl\w*)\b"),
    "ISC": (r"\bprovided that the above copyright notice\b", ""),
    "LGPL-2.1": (rf"\b(lesser|lgpl\w*)\b.*?{_V21}", ""),
    "LGPL-3.0": (rf"\b(lesser|lgpl\w*)\b.*?{_V3}", ""),
    "MIT": (r"\bmit\b|\bpermission notice shall be included\b", r"\bmit 0\b|\bno attribution\b"),
    "MPL-2.0": (r"\bmozilla\b.*\b(version |v ?)?2( 0)?\b", ""),
}
#: The same for whole files, where other licences are only mentioned.
DECIDING_WHOLE = {
    "BSD-2-Clause": DECIDING["BSD-2-Clause"],
    "BSD-3-Clause": (r"\bendorse or promote\b", r"\badvertising materials\b"),
    "GPL-3.0": ("", r"\bremote network interaction\b"),
    "ISC": DECIDING["ISC"],
    "MIT": (r"\bpermission notice shall be included\b", ""),
}
#: A file without any of these is compared by single lines only; every header and text holds some.
LICENCE_WORDS = ("apache", "copying", "copyright", "copyrights", "gpl", "licence", "license", "licensed", "licenses", "permission", "permitted", "redistribute", "redistribution", "redistributions", "warranties", "warranty")
PASSAGES = (2, 3, 4, 6, 9, 14, 20)
SHORT = 400
LICENSE_FILES = ("COPYING", "LICENSE", "NOTICE")
RESULTS = ["license", "basis", "cosine"]


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


@cache
def texts() -> tuple[tuple[str, str], ...]:
    """(license, full text) of the texts beside this module, with those of few words."""
    return tuple((file.stem, file.read_text(encoding="utf-8")) for file in sorted((Path(__file__).parent / "license_texts").glob("*.txt")))


def _decided(name: Column, words: Column, deciding: dict[str, tuple[str, str]]) -> Column:
    """Whether joined words hold the deciding words of the license ``name`` and none of another variant."""
    out = F.lit(True)
    for license, (held, barred) in deciding.items():
        fits = (words.rlike(held) if held else F.lit(True)) & (~words.rlike(barred) if barred else F.lit(True))
        out = F.when(name == license, fits).otherwise(out)
    return out


def _counts(words: str, *keys: str):
    """Frames of (keys, ``term``, ``tf``) from rows with a list of words."""
    return lambda df: df.select(*keys, F.explode(words).alias("term")).groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf"))


Templates = Sequence[tuple[str, str]]


def _given(spark: SparkSession, templates: Templates) -> DataFrame:
    return spark.createDataFrame(list(templates), "template string, body string").select("template", _words(F.col("body")).alias("words"))


def frequencies(files: DataFrame, text: str, *templates: Templates) -> DataFrame:
    """(``term``, ``idf``, ``rare``, ``list``) for the words of each list of templates, from one pass over all files.

    ``rare`` is the weight of a word that no file holds, as words of no template of the list are taken.
    """
    spark = files.sparkSession
    lists = [sorted({w for row in _given(spark, t).select("words").collect() for w in row["words"]}) for t in templates]  # one row a template
    seen = files.select(F.array_intersect(_words(F.coalesce(text, F.lit(""))), F.lit(sorted(set().union(*lists)))).alias("terms"))
    found = seen.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    total = files.agg(F.count(F.lit(1)).alias("files"))
    terms = spark.createDataFrame([(t, k) for k, own in enumerate(lists) for t in own], "term string, list int")
    idf = terms.join(F.broadcast(found), "term", "left").join(F.broadcast(total))
    idf = idf.select(
        "term", "list",
        (F.log((F.col("files") + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1).alias("idf"),
        (F.log(F.col("files") + F.lit(1.0)) + 1).alias("rare"),
    )
    return written(idf, "idf")


def vectors(given: DataFrame, idf: DataFrame) -> DataFrame:
    """(``template``, ``term``, ``weight``) with unit length per template, from its counted words (``template``, ``term``, ``tf``)."""
    raw = given.join(F.broadcast(idf), "term").withColumn("weight", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy("template")))
    return raw.select("template", "term", (F.col("weight") / norm).alias("weight"))


def needed_terms(weights: DataFrame, threshold: float) -> list[str]:
    """Terms of which a line must hold at least one to reach the threshold with any template."""
    rest = Window.partitionBy("template").orderBy(F.desc("weight"), "term").rowsBetween(0, Window.unboundedFollowing)
    left = weights.withColumn("left", F.sum(F.col("weight") * F.col("weight")).over(rest))
    return sorted(r["term"] for r in left.where(F.col("left") >= (threshold - 1e-9) ** 2).select("term").distinct().collect())


def own_licenses(files: DataFrame, key: str, text: str, idf: DataFrame, templates: Templates = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(``key``, ``own``, ``cosine``) of the rows with a line that matches a template; ``key`` tells rows apart."""
    weights = written(vectors(_counts("words", "template")(_given(files.sparkSession, templates)), idf), "templates")
    needed = F.lit(needed_terms(weights, threshold))
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = files.select(F.col(key), F.posexplode(F.split(whole, "\n")).alias("line", "body")).withColumn("words", _words(F.col("body")))
    lines = lines.where(F.arrays_overlap("words", needed))
    tf = _counts("words", key, "line")(lines)
    said = lines.groupBy(key, "line").agg(F.array_join(F.first("words"), " ").alias("said"))
    valued = tf.join(F.broadcast(idf), "term", "left").join(F.broadcast(idf.agg(F.max("rare").alias("most"))))
    valued = valued.withColumn("weight", F.col("tf") * F.coalesce("idf", "most")).select(key, "line", "term", "weight")
    norms = valued.groupBy(key, "line").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    dots = valued.join(F.broadcast(weights.withColumnRenamed("weight", "unit")), "term").groupBy(key, "line", "template")
    dots = dots.agg(F.sum(F.col("weight") * F.col("unit")).alias("dot"))
    scored = dots.join(norms, [key, "line"]).withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 9))
    scored = scored.where(F.col("cosine") >= threshold).join(said, [key, "line"]).where(_decided(F.col("template"), F.col("said"), DECIDING))
    best = scored.groupBy(key).agg(F.min(F.struct(-F.col("cosine"), "template")).alias("best"))
    return best.select(key, F.col("best.template").alias("own"), (-F.col("best.col1")).alias("cosine"))


def _dampened(df: DataFrame, words: str, *keys: str) -> DataFrame:
    return _counts(words, *keys)(df).withColumn("tf", 1 + F.log("tf"))


def long_templates() -> list[tuple[str, str]]:
    """Names and bodies of full texts (ending in 0) and of what joined lines are compared with (ending in 1)."""
    full = [(f"{k}|{name}|0", body) for k, (name, body) in enumerate(texts())]
    brief = [(name, body) for name, body in texts() if len(body.split()) <= SHORT]
    return full + [(f"{k}|{name}|1", body) for k, (name, body) in enumerate([*TEMPLATES, *HEADERS, *brief])]


def _once(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """One of the rows of each key; only rows of repeated keys are shuffled."""
    repeated = written(keys.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select(key), "repeated")
    return rows.join(repeated, key, "left_anti").unionByName(rows.join(repeated, key, "left_semi").dropDuplicates([key]))


def long_licenses(files: DataFrame, key: str, text: str, idf: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(``key``, ``whole``, ``own``, ``cosine``) of the rows whose whole text or joined lines match; ``whole`` is 0 for a full text."""
    near = files.select(key, F.coalesce(text, F.lit("")).alias("text"))
    near = near.where(F.arrays_overlap(_words(F.col("text")), F.lit(list(LICENCE_WORDS))))
    # The words of every line; those of a text are theirs joined, as no word goes over a line.
    near = written(_once(near.select(key, F.transform(F.split("text", "\n"), _words).alias("rows")), key, files.select(key)), "near")
    marked = F.filter(F.sequence(F.lit(1), F.size("rows")), lambda i: F.arrays_overlap(F.get("rows", i - 1), F.lit(list(LICENCE_WORDS))))
    starts = F.array_distinct(F.flatten(F.transform(marked, lambda i: F.array(F.greatest(i - 1, F.lit(1)), i))))
    # Each start takes only its own lines along, so a file of many licence words costs its length times the longest passage.
    parts = F.transform(starts, lambda i: F.struct(i.alias("start"), F.slice("rows", i, max(PASSAGES)).alias("part")))
    passages = near.select(key, F.explode(parts).alias("p")).select(key, "p.start", "p.part", F.explode(F.lit(list(PASSAGES))).alias("size"))
    passages = passages.select(key, (F.col("start") * 32 + F.col("size")).alias("unit"), F.flatten(F.slice("part", F.lit(1), F.col("size"))).alias("words"))
    units = near.select(key, F.lit(0).alias("unit"), F.flatten("rows").alias("words")).unionByName(passages).where(F.size("words") > 0)
    # Dealt out once by unit, before the words are counted: all that follows is grouped and joined by unit.
    units = written(units, "units").repartition(key, "unit")
    given = _dampened(_given(files.sparkSession, long_templates()), "words", "template")
    unit = written(vectors(given, idf).withColumnRenamed("weight", "share"), "long")
    valued = _dampened(units, "words", key, "unit").join(F.broadcast(idf), "term", "left").join(F.broadcast(idf.agg(F.max("rare").alias("most"))))
    valued = valued.withColumn("weight", F.col("tf") * F.coalesce("idf", "most"))
    norms = valued.groupBy(key, "unit").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    kind = F.substring_index("template", "|", -1) == F.when(F.col("unit") == 0, "0").otherwise("1")
    dots = valued.join(F.broadcast(unit), "term").where(kind).groupBy(key, "unit", "template").agg(F.sum(F.col("weight") * F.col("share")).alias("dot"))
    scored = dots.join(norms, [key, "unit"]).withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 9)).where(F.col("cosine") >= threshold)
    scored = scored.join(units.select(key, "unit", F.array_join("words", " ").alias("said")), [key, "unit"])
    name, whole = F.split("template", r"\|")[1], (F.col("unit") != 0).cast("int")
    fits = F.when(whole == 0, _decided(name, F.col("said"), DECIDING_WHOLE)).otherwise(_decided(name, F.col("said"), DECIDING))
    best = scored.where(fits).groupBy(key).agg(F.min(F.struct(whole.alias("whole"), (-F.col("cosine")).alias("less"), name.alias("own"))).alias("b"))
    return best.select(key, F.col("b.whole").alias("whole"), F.col("b.own").alias("own"), (-F.col("b.less")).alias("cosine"))


def _folder(path: str) -> Column:
    """Directory of a path; empty at the top."""
    return F.regexp_replace(F.col(path), r"(^|/)[^/]*$", "")


def scan(files: DataFrame, path: str = "path", text: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``files`` without its text, with ``license``, ``basis`` (header, licence file or inherited) and ``cosine``."""
    rows = files.drop(*RESULTS).withColumn("__row", F.xxhash64(path, text))
    texts_only = rows.select("__row", text)
    idf = frequencies(texts_only, text, templates, *([long_templates()] if templates is TEMPLATES else []))
    own = own_licenses(texts_only, "__row", text, idf.where("list = 0"), templates, threshold).withColumn("whole", F.lit(1))
    if templates is TEMPLATES:
        own = own.unionByName(long_licenses(texts_only, "__row", text, idf.where("list = 1"), threshold))
    own = own.groupBy("__row").agg(F.min(F.struct("whole", (-F.col("cosine")).alias("less"), "own")).alias("b"))
    own = own.select("__row", F.col("b.own").alias("own"), (-F.col("b.less")).alias("cosine"))
    own = written(own, "own")
    light = rows.drop(text).join(own, "__row", "left").withColumn("__folder", _folder(path))
    name = F.substring_index(path, "/", -1)
    is_file = F.upper(F.regexp_replace(name, r"\.[^.]*$", "")).isin(*LICENSE_FILES)
    given = light.where(is_file & F.col("own").isNotNull()).groupBy("__folder").agg(F.min(F.struct(path, "own")).alias("g"))
    given = written(given.select(F.col("__folder").alias("above"), F.col("g.own").alias("from_above")), "given")
    folders = light.where(F.col("__folder").isNotNull()).select("__folder").distinct()
    parts = F.split("__folder", "/")
    depth = F.when(F.col("__folder") == "", F.lit(0)).otherwise(F.size(parts))
    above = folders.withColumn("depth", F.explode(F.sequence(F.lit(0), depth)))
    above = above.withColumn("above", F.array_join(F.expr("slice(split(__folder, '/'), 1, depth)"), "/"))
    nearest = above.join(given, "above").groupBy("__folder").agg(F.max(F.struct("depth", "from_above")).alias("n"))
    nearest = nearest.select("__folder", F.col("n.from_above").alias("inherited"))
    done = light.withColumn("__is_file", is_file).join(nearest, "__folder", "left")
    basis = F.when(F.col("own").isNotNull(), F.when(F.col("__is_file"), "licence file").otherwise("header")).when(F.col("inherited").isNotNull(), "inherited")
    kept = [c for c in files.columns if c not in (text, *RESULTS)]
    return done.select(*kept, F.coalesce("own", "inherited").alias("license"), basis.alias("basis"), "cosine")
