"""Licence scans: TF-IDF cosine to templates, and inheritance from directories.

DataFrame functions only. A unit is a line of a file, or the whole file if its name says that it
holds a licence. Such files are also compared with the full texts in `license_texts`, and every file
is searched for SPDX identifiers, titles on a line of their own, and headers as phrases, which may
stand among other words or run over several lines. Weights are counts times inverse document frequencies over all files; a word
that no template has weighs as one that is in no file. A unit can only reach the wanted cosine if
it holds one of the words that make up most of a template's weight, so other lines are never
taken apart.

A file without a licence of its own takes that of its nearest ancestor directory that has one: the
licence that most files right in that directory carry, licence files first.
"""

from __future__ import annotations

import math
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import written

# Header lines that name common licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License",
    "CC-BY-4.0": "This work is licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "This work is licensed under CC BY-SA 4.0",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MPL-2.0": "Subject to the terms of the Mozilla Public License, version 2.0",
}
# Words, without punctuation, that stand one after the other in a header or text, whatever the lines;
# all phrases of an entry must be there.
_FSF = "as published by the free software foundation"
PHRASES = [
    *[(name, (text,)) for name, text in TEMPLATES.items()],
    ("MIT", ("licensed under the mit license",)),
    ("MIT", ("distributed under the mit license",)),
    ("MIT", ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "the above copyright notice and this permission notice shall be included in all copies")),
    ("BSD-3-Clause", ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "used to endorse or promote products derived from this software without specific prior written permission")),
    ("MPL-2.0", ("subject to the terms of the mozilla public license v 2 0",)),
    ("CC-BY-4.0", ("licensed under a creative commons attribution 4 0 international license",)),
    ("CC-BY-NC-4.0", ("licensed under a creative commons attribution noncommercial 4 0 international license",)),
    ("CC-BY-SA-4.0", ("licensed under a creative commons attribution sharealike 4 0 international license",)),
    ("AGPL-3.0", ("gnu affero general public license version 3 19 november 2007",)),
    *[
        (f"{short}-{version}", (f"gnu {kind} {_FSF} {words} {version} of the license",))
        for short, kind, versions in (
            ("GPL", "general public license", ("2", "3")), ("LGPL", "lesser general public license", ("2.1", "3")),
            ("AGPL", "affero general public license", ("3",)),
        )
        for version in versions for words in ("either version", "version")
    ],
]
PHRASES = [(re.sub(r"-([23])$", r"-\1.0", name), phrases) for name, phrases in PHRASES]
# Lines of their own.
TITLES = {
    "mit license": "MIT", "the mit license": "MIT", "the mit license mit": "MIT", "mit license mit": "MIT",
    "apache license version 2 0": "Apache-2.0", "apache license 2 0": "Apache-2.0",
    "bsd 3 clause license": "BSD-3-Clause", "mozilla public license version 2 0": "MPL-2.0",
    "gnu general public license v2 0": "GPL-2.0", "gnu general public license version 2": "GPL-2.0",
    "gnu general public license v3 0": "GPL-3.0", "gnu general public license version 3": "GPL-3.0",
    "gnu lesser general public license version 3": "LGPL-3.0",
    **{
        title: f"CC-BY{short}-4.0"
        for short, kind in (
            ("", ""), ("-NC", "noncommercial "), ("-SA", "sharealike "), ("-ND", "noderivatives "),
            ("-NC-SA", "noncommercial sharealike "), ("-NC-ND", "noncommercial noderivatives "),
        )
        for title in (
            f"attribution {kind}4 0 international",
            f"creative commons attribution {kind}4 0 international public license",
        )
    },
}
SPDX = r"(?i)SPDX-License-Identifier:[ \t]*([^\r\n]*)"
MARKS = ".,;:!?()[]{}<>\"'`/\\|*#%&$@+=_~^-\t\r\x0b\f"
NAMES = r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"
ALIKE = 0.75


def _terms(text: Column) -> Column:
    """Lower-case words without punctuation; lines stay apart by their line feeds."""
    plain = F.translate(F.lower(text), MARKS + "\n", " " * (len(MARKS) + 1))
    return F.array_remove(F.split(plain, " "), "")


def _plain_terms(text: str) -> list[str]:
    return re.sub("[" + re.escape(MARKS) + "\n]", " ", text.lower()).split()


def full_texts() -> dict[str, str]:
    """Texts of licences by name. Those of Creative Commons differ too little: titles tell them."""
    folder = Path(__file__).with_name("license_texts")
    return {f.name.removesuffix(".txt"): f.read_text() for f in sorted(folder.glob("*.txt"))}


def _frequencies(files: DataFrame, words: list[str]) -> tuple[dict[str, int], int]:
    """In how many files each of the templates' words is, and how many files there are."""
    inside = F.array_intersect(_terms(F.col("text")), F.array(*map(F.lit, words)))
    found = files.select(F.explode(F.concat(inside, F.array(F.lit("")))).alias("word"))
    counts = {r["word"]: r["count"] for r in found.groupBy("word").count().collect()}
    return counts, counts.get("", 0)


def _key_words(weights: dict[str, dict[str, float]], alike: float) -> list[str]:
    """Words of which a unit must hold one: the others of a template can't reach the cosine."""
    keys = set()
    for weight in weights.values():
        norm, rest = sum(w * w for w in weight.values()), 0.0
        for word, w in sorted(weight.items(), key=lambda x: (x[1], x[0])):
            rest += w * w
            if rest >= alike * alike * norm:
                keys.add(word)
    return sorted(keys)


def own_licenses(
    files: DataFrame, templates: dict[str, str] = TEMPLATES, alike: float = ALIKE
) -> DataFrame:
    """path, unit (number of the line with text, 0 for a whole file), license, score.

    ``files``: path, text. A row per unit whose best template has a cosine of ``alike`` or more;
    ties go to the first name.
    """
    words = {name: _plain_terms(text) for name, text in templates.items()}
    frequency, n = _frequencies(files, sorted({w for ws in words.values() for w in ws}))

    def idf(word: str | None) -> float:
        return math.log((1 + n) / (1 + frequency.get(word, 0))) + 1

    weights = {name: {w: ws.count(w) * idf(w) for w in ws} for name, ws in words.items()}
    keys = _key_words(weights, alike)
    whole_file = F.col("path").rlike(NAMES)
    lines = F.filter(F.split("text", "\n"), lambda x: F.size(_terms(x)) > 0)
    cue = F.col("text").rlike("(?i)(" + "|".join(map(re.escape, keys)) + ")")
    units = (
        files.where(cue).select(
            "path",
            F.posexplode(F.when(whole_file, F.array("text")).otherwise(lines)).alias("line", "unit_text"),
            whole_file.alias("whole"),
        )
        .where(F.col("unit_text").rlike("(?i)(" + "|".join(map(re.escape, keys)) + ")"))
        .select(
            "path", F.when(F.col("whole"), 0).otherwise(F.col("line") + 1).alias("unit"),
            F.xxhash64("unit_text").alias("of_text"), _terms(F.col("unit_text")).alias("terms"),
        )
        .where(F.arrays_overlap("terms", F.array(*map(F.lit, keys))))
        .dropDuplicates(["path", "unit", "of_text"])
    )
    return _alike(units, weights, idf, alike)


def _alike(units: DataFrame, weights: dict[str, dict[str, float]], idf, alike: float) -> DataFrame:
    """The best template of each unit (path, unit, of_text, terms), if its cosine suffices."""
    spark = units.sparkSession
    counted = (
        units.select("path", "unit", "of_text", F.explode("terms").alias("word"))
        .groupBy("path", "unit", "of_text", "word").agg(F.count("*").alias("n"))
    )
    rows = [
        (name, w, idf(w), value / math.sqrt(sum(v * v for v in weight.values())))
        for name, weight in weights.items() for w, value in weight.items()
    ]
    # Bounded by the templates' words.
    table = spark.createDataFrame(rows, "license string, word string, idf double, part double")
    idfs = table.select("word", "idf").distinct()
    weighed = counted.join(F.broadcast(idfs), "word", "left").withColumn(
        "w", F.col("n") * F.coalesce("idf", F.lit(idf(None)))
    )
    unit = ["path", "unit", "of_text"]
    norms = weighed.groupBy(*unit).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = (
        weighed.drop("idf").join(F.broadcast(table), "word")
        .groupBy(*unit, "license").agg(F.sum(F.col("w") * F.col("part")).alias("dot"))
    )
    best = (
        dots.join(norms, unit)
        .select(*unit, "license", F.round(F.col("dot") / F.col("norm"), 6).alias("score"))
        .where(F.col("score") >= alike)
        .groupBy(*unit).agg(F.min(F.struct((-F.col("score")).alias("rank"), "license")).alias("top"))
    )
    return best.select(
        "path", "unit", F.col("top.license").alias("license"), (-F.col("top.rank")).alias("score")
    )


def text_licenses(files: DataFrame, alike: float = ALIKE) -> DataFrame:
    """As `own_licenses`, for files whose name says that they hold a licence, by the full texts.

    A word weighs by the number of these texts that have it, one that none has as the rarest.
    """
    words = {name: _plain_terms(text) for name, text in full_texts().items()}
    found = {}
    for ws in words.values():
        for w in set(ws):
            found[w] = found.get(w, 0) + 1

    def idf(word: str | None) -> float:
        return math.log((1 + len(words)) / (1 + found.get(word, 0))) + 1

    weights = {name: {w: ws.count(w) * idf(w) for w in set(ws)} for name, ws in words.items()}
    units = (
        files.where(F.col("path").rlike(NAMES))
        .select("path", F.lit(0).alias("unit"), F.xxhash64("text").alias("of_text"), _terms(F.col("text")).alias("terms"))
        .dropDuplicates(["path", "of_text"])
    )
    return _alike(units, weights, idf, alike)


def header_licenses(files: DataFrame) -> DataFrame:
    """As `own_licenses`, by SPDX identifiers, titles and phrases: exact, so with a score of 1."""
    # All of them hold one of these.
    cued = files.where(F.col("text").rlike("(?i)licen|attribution|permission is hereby|redistribution and use"))
    line = F.transform(F.split("text", "\n"), lambda x: F.array_join(_terms(x), " "))
    whole = F.concat(F.lit(" "), F.array_join(_terms(F.col("text")), " "), F.lit(" "))

    def holds(phrases: tuple[str, ...]) -> Column:
        has = F.lit(True)
        for phrase in phrases:
            has = has & F.contains(F.col("whole"), F.lit(f" {' '.join(_plain_terms(phrase))} "))
        return has

    titles = F.create_map(*[F.lit(x) for pair in TITLES.items() for x in pair])
    named = F.transform(F.array_intersect(line, F.array(*map(F.lit, TITLES))), lambda x: titles[x])
    phrased = F.array(*[F.when(holds(phrases), name) for name, phrases in PHRASES])
    # "Apache-2.0 OR MIT" gives both; an exception after WITH isn't a licence.
    known = {x.lower(): x for x in (*TEMPLATES, *TITLES.values(), *(p[0] for p in PHRASES))}
    names = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    ids = F.flatten(F.transform(
        F.regexp_extract_all("text", F.lit(SPDX), 1),
        lambda x: F.regexp_extract_all(
            F.regexp_replace(x, r"(?i)\bWITH\s+\S+", ""), F.lit(r"([A-Za-z][A-Za-z0-9.+-]*[A-Za-z0-9+]|[A-Za-z])"), 1
        ),
    ))
    ids = F.filter(ids, lambda x: ~F.lower(x).isin("or", "and", "none", "noassertion"))
    ids = F.transform(ids, lambda x: F.regexp_replace(x, r"(?i)(-only|-or-later|\+)$", ""))
    identified = F.transform(ids, lambda x: F.coalesce(names[F.lower(x)], x))
    found = F.array_compact(F.array_distinct(F.concat(identified, named, phrased)))
    return cued.withColumn("whole", whole).select(
        "path", F.lit(0).alias("unit"), F.explode(found).alias("license"), F.lit(1.0).alias("score")
    )


def parent(path: Column) -> Column:
    """The directory of a path, "" at the top."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise("")


def ancestors(directory: Column) -> Column:
    """A directory and all above it, the top ("") included."""
    parts = F.split(directory, "/")
    ups = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/")
    )
    return F.array_distinct(F.concat(F.array(F.lit("")), ups))


def scan(
    files: DataFrame, path: str = "path", text: str = "text",
    templates: dict[str, str] = TEMPLATES, alike: float = ALIKE,
) -> DataFrame:
    """A row per file: path, own (licence), score, n_licenses, inherited, from_directory, license.

    A file's own licence is that of its best unit, ties to the first name. A directory's licence is
    the one most of its licence files carry (files whose name says so), or most of its files if it
    has none; ties go to the first name. Rows of one path count as one file. Null paths are left out, since they have no place; null and empty texts have no licence;
    other columns are ignored. An empty table gives no rows.
    """
    plain = files.where(F.col(path).isNotNull()).select(
        F.col(path).cast("string").alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    units = own_licenses(plain, templates, alike)
    for others in (text_licenses(plain, alike), header_licenses(plain)):
        units = units.unionByName(others)
    units = written(units, "license-units")
    ranked = F.struct((-F.col("score")).alias("rank"), "license")
    own = written(
        units.groupBy("path")
        .agg(F.min(ranked).alias("best"), F.count_distinct("license").alias("n_licenses"))
        .select("path", F.col("best.license").alias("own"), (-F.col("best.rank")).alias("score"), "n_licenses"),
        "license-own",
    )
    named = F.count(F.when(F.col("path").rlike(NAMES), 1))
    votes = own.groupBy(parent(F.col("path")).alias("up"), F.col("own").alias("license")).agg(
        (-named).alias("named"), (-F.count("*")).alias("n")
    )
    by_directory = votes.groupBy("up").agg(
        F.min(F.struct("named", "n", "license")).alias("first")
    ).select("up", F.col("first.license").alias("license"))
    placed = plain.select("path").distinct().withColumn("directory", parent(F.col("path")))
    # A directory is resolved once, however many files it has. Written, so that adaptive execution
    # can split the files of a large one in the join.
    nearest = written(
        placed.select("directory").distinct()
        .select("directory", F.explode(ancestors(F.col("directory"))).alias("up"))
        .join(by_directory, "up")
        .groupBy("directory")
        .agg(F.max(F.struct(F.length("up").alias("depth"), "up", "license")).alias("n"))
        .select("directory", F.col("n.license").alias("inherited"), F.col("n.up").alias("from_directory")),
        "license-nearest",
    )
    alone = F.col("own").isNull()
    return (
        placed.join(own, "path", "left").join(nearest, "directory", "left")
        .select(
            "path", "own", "score", F.coalesce("n_licenses", F.lit(0)).alias("n_licenses"),
            F.when(alone, F.col("inherited")).alias("inherited"),
            F.when(alone, F.col("from_directory")).alias("from_directory"),
            F.coalesce("own", "inherited").alias("license"),
        )
    )
