"""Licences of files: sparse TF-IDF cosine of word windows, lines and whole texts to notices, then inheritance down the path.

A file's own licence is the notice that a window of as many words, a line or the whole text is nearest to, from a
similarity on. Windows run on over line breaks, so other words beside a notice don't hide it.
A file without one inherits from the nearest directory above that holds a licence file.

At scale: files are compared where they are read, against a fixed list of notices; only directories, not files,
are spelled out into their ancestors, and a directory with very many files meets its licence in a join whose
size is checked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.llm.arrays import combine, pieces, prefix_hash, run_lengths, span_hash, word_spans
from lexloom.llm.decontaminate import normalised
from lexloom.llm.sizes import join_checked
from lexloom.session import cut_lineage

# Licence notices as their stewards word them, by SPDX identifier.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "This project is licensed under the terms of the MIT license"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("LGPL-3.0", "GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("LGPL-2.1", "GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3"),
    ("AGPL-3.0", "GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("GPL-3.0", "GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("LGPL-3.0", "GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("AGPL-3.0", "GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    # how the full texts begin
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-ND-4.0", "Creative Commons Attribution-NoDerivatives 4.0 International Public License"),
]
# SPDX tags, which have to agree in every word.
TAG = "SPDX-License-Identifier: "
NOTICES += [(name, TAG + name) for name in dict.fromkeys(name for name, _ in NOTICES)]
NOTICES += [(f"{name}-{v}", f"{TAG}{name}-{v}-{end}") for name, v in (("GPL", "2.0"), ("GPL", "3.0"), ("LGPL", "2.1"), ("LGPL", "3.0"), ("AGPL", "3.0")) for end in ("only", "or-later")]
# Names of licence files.
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice|unlicense)([.-][a-z0-9.-]*)?$"


@dataclass(frozen=True)
class Scan:
    """Cosine from which a notice counts, and the share of a text's words in notices from which it is a licence file."""

    least: float = 0.7
    share: float = 0.2


@dataclass
class Index:
    """Term keys (ascending), inverse document frequencies, the one of unseen terms, and unit weights by notice."""

    terms: np.ndarray
    idf: np.ndarray
    unseen: float
    weights: np.ndarray  # terms by notices
    sizes: np.ndarray  # words of each notice
    exact: np.ndarray  # notices that have to agree in every word


def _lined(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word keys of all texts, with the line and the row of each, and the row of every line."""
    texts = column.to_pylist()
    lines = [(k, line) for k, text in enumerate(texts) for line in (text or "").split("\n")]
    data, at = normalised(pa.array([line for _, line in lines], pa.string()))
    starts, ends, line = word_spans(data, at)
    row = np.array([k for k, _ in lines], np.int64)
    return span_hash(prefix_hash(data), starts, ends), line, row[line], row


def notice_index(notices: list[tuple[str, str]] = NOTICES) -> Index:
    words, line, _, _ = _lined(pa.array([text for _, text in notices], pa.string()))
    terms, place = np.unique(words, return_inverse=True)
    counts = np.zeros((len(terms), len(notices)))
    np.add.at(counts, (place, line), 1)
    known = (counts > 0).sum(axis=1)
    idf = np.log((1 + len(notices)) / (1 + known)) + 1
    weights = counts * idf[:, None]
    exact = np.array([text.startswith(TAG) for _, text in notices])
    return Index(terms, idf, float(np.log(1 + len(notices)) + 1), weights / np.linalg.norm(weights, axis=0), np.bincount(line, minlength=len(notices)), exact)


def similarities(index: Index, words: np.ndarray, unit: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``n`` units (lines or texts) its nearest notice and the cosine."""
    order = np.lexsort((words, unit))
    words, unit = words[order], unit[order]
    first, count = run_lengths(combine(words, unit.astype(np.uint64)))
    words, unit = words[first], unit[first]
    place = np.minimum(np.searchsorted(index.terms, words), len(index.terms) - 1)
    known = index.terms[place] == words
    weight = count * np.where(known, index.idf[place], index.unseen)
    norm = np.sqrt(np.bincount(unit, weight**2, minlength=n))
    best, cosine = np.zeros(n, np.int64), np.zeros(n)
    unit, place, weight = unit[known], place[known], weight[known]
    for k in range(index.weights.shape[1]):
        dot = np.bincount(unit, weight * index.weights[place, k], minlength=n) / np.maximum(norm, 1e-12)
        if index.exact[k]:
            dot[dot < 1 - 1e-9] = 0
        better = dot > cosine + 1e-12
        best[better], cosine[better] = k, dot[better]
    return best, cosine


def windows(index: Index, words: np.ndarray, row: np.ndarray, n: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each of ``n`` texts its nearest notice among windows of as many words, the cosine, and the words in such windows.

    Windows below ``least`` are left out; texts without any have cosine 0.
    """
    best, cosine, covered = np.zeros(n, np.int64), np.zeros(n), np.zeros(len(words) + 1, np.int64)
    if not len(words):
        return best, cosine, covered[:-1] > 0
    place = np.minimum(np.searchsorted(index.terms, words), len(index.terms) - 1)
    known = index.terms[place] == words
    weight = np.where(known, index.idf[place], index.unseen)
    # counts are at least one: the norm is no smaller than that of different words
    squares = np.concatenate([[0], np.cumsum(weight**2)])
    for k, size in enumerate(index.sizes.tolist()):
        if size > len(words):
            continue
        dots = np.concatenate([[0], np.cumsum(np.where(known, weight * index.weights[place, k], 0))])
        dot = dots[size:] - dots[:-size]
        at = np.flatnonzero((dot >= (least - 1e-9) * np.sqrt(squares[size:] - squares[:-size])) & (row[size - 1 :] == row[: len(row) - size + 1]))
        for lo in range(0, len(at), 1 << 14):
            start = at[lo : lo + (1 << 14)]
            inside = start[:, None] + np.arange(size)
            order = np.argsort(words[inside], axis=1, kind="stable")
            inside = np.take_along_axis(inside, order, axis=1)
            # a word that stands c times gives c ** 2 squares: one, and two for each earlier copy
            again = np.zeros(inside.shape, np.int64)
            for j in range(1, size):
                again[:, j] = np.where(words[inside[:, j]] == words[inside[:, j - 1]], again[:, j - 1] + 1, 0)
            value = np.minimum(dot[start] / np.sqrt((weight[inside] ** 2 * (1 + 2 * again)).sum(axis=1)), 1.0)
            good = value >= (1 - 1e-9 if index.exact[k] else least)
            start, value = start[good], value[good]
            np.add.at(covered, start, 1)
            np.add.at(covered, start + size, -1)
            top = np.zeros(n)
            np.maximum.at(top, row[start], value)
            better = top > cosine + 1e-9
            best[better], cosine[better] = k, top[better]
    return best, cosine, np.cumsum(covered[:-1]) > 0


def _scanner(scan: Scan, columns: list[str]):
    index = notice_index()
    names = np.array([name for name, _ in NOTICES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            n = piece.num_rows
            words, line, row, row_of_line = _lined(piece.column("text"))
            best, cosine = similarities(index, words, line, len(row_of_line))
            whole, whole_cosine = similarities(index, words, row, n)
            notice = cosine >= scan.least
            near, near_cosine, covered = windows(index, words, row, n, scan.least)
            inside = np.bincount(row, notice[line] | covered, minlength=n) / np.maximum(np.bincount(row, minlength=n), 1)
            # a text's nearest line, the first one of equals
            order = np.lexsort((np.arange(len(cosine)), -cosine, row_of_line))
            lead, _ = run_lengths(row_of_line[order])
            top = order[lead]
            use_whole = whole_cosine > cosine[top]
            which = np.where(use_whole, whole, best[top])
            value = np.where(use_whole, whole_cosine, cosine[top])
            closer = near_cosine > value + 1e-9
            which, value = np.where(closer, near, which), np.where(closer, near_cosine, value)
            found = value >= scan.least
            yield pa.record_batch(
                [*piece.select(columns).columns, pa.array(names[which], pa.string(), mask=~found), pa.array(np.round(value, 6)), pa.array(inside)],
                names=[*columns, "own_licence", "similarity", "notice_share"],
            )

    return run


def directory_of(path: Column) -> Column:
    """The part before the last slash; empty for a file at the root."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def ancestors(directory: Column) -> Column:
    """The directory and all above it, the root as an empty string, nearest first."""
    parts = F.split(directory, "/")
    own = F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    return F.array_distinct(F.concat(own, F.array(F.lit(""))))


def licences(files: DataFrame, scan: Scan = Scan()) -> DataFrame:
    """Each row of ``files`` without its ``text`` and with ``own_licence, similarity, licence, licence_dir``.

    ``files`` has ``path`` and ``text``; its other columns are returned unless they carry one of those names. A licence
    file is named like one, or is made of notices by ``share`` of its words; several in a directory yield to the most
    similar, then the smallest path. ``licence`` is the file's own or else that of the nearest directory above
    (``licence_dir``). A null or empty text has no licence of its own; a null path inherits nothing. Repeated rows
    stay. An empty table gives no rows.
    """
    made = ("own_licence", "similarity", "notice_share", "licence", "licence_dir", "directory", "text")
    columns = [c for c in files.columns if c not in made]
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in files.select(*columns).dtypes)
    scanned = files.select(*columns, "text").mapInArrow(_scanner(scan, columns), f"{kinds}, own_licence string, similarity double, notice_share double")
    scanned = cut_lineage(scanned.withColumn("directory", directory_of(F.col("path"))))
    named = F.regexp_extract("path", r"([^/]*)$", 1).rlike(LICENCE_FILE)
    holders = scanned.where(F.col("own_licence").isNotNull() & F.col("path").isNotNull() & (named | (F.col("notice_share") >= scan.share)))
    best = F.min(F.struct((-F.col("similarity")).alias("s"), "path", "own_licence"))
    stated = cut_lineage(holders.groupBy(F.col("directory").alias("above")).agg(best.getField("own_licence").alias("licence")))
    lines = scanned.where("path is not null").select("directory").distinct().select("directory", F.posexplode(ancestors(F.col("directory"))).alias("up", "above"))
    nearest = F.min(F.struct("up", "above", "licence"))
    met = join_checked(lines, stated, ["above"]).groupBy("directory").agg(nearest.alias("near"))
    resolved = cut_lineage(met.select("directory", F.col("near.above").alias("near_dir"), F.col("near.licence").alias("near_licence")))
    joined = join_checked(scanned, resolved, ["directory"], "left")
    inherits = F.col("own_licence").isNull()
    return joined.select(
        *columns, "own_licence", "similarity", F.coalesce("own_licence", "near_licence").alias("licence"), F.when(inherits, F.col("near_dir")).alias("licence_dir")
    )
