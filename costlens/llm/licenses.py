"""Licence scan: sparse TF-IDF cosine to templates, then directory inheritance.

Every line of a whole text, every pair of lines in a row, and the text itself are
vectors of term counts times inverse document frequencies, compared with the
vectors of all templates. Frequencies of the template terms are counted over the
whole corpus; any other term has the frequency zero, the highest weight. A line
can only reach the threshold if the terms it shares with templates carry that share
of its length, which clears most lines before any cosine. The text itself is also
compared with the full licence texts. The best full text of at least MIN_COSINE, or
else the best template, is the document's own licence. A document with a licence is
a licence file, whatever its length, if it is near a full text, if its name says so,
or if most of its terms lie in the matched lines. Licence files speak for their
directory, the best cosine first, then the smallest doc_id, then the licence's name.
A document without a licence takes that of its nearest ancestor directory, by a join of
the distinct directories' ancestors with the licensed ones; the last ancestor is the
root, "" of relative paths and "/" of absolute ones. Of licences with equal cosines (to
nine places) the first by name is a document's own.

Null text has no licence; a null path lies in no directory. Empty table: no rows.
Repeated rows give repeated rows. Extra columns are ignored."""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import cut, text_of
from costlens.llm.licence_texts import TEXTS

MIN_COSINE = 0.8
FILE_NAME = r"^((un)?licen[cs]e|copying)(-[a-z0-9]+([.][0-9]+)*)?([.](txt|md|rst|html?|lesser|lib))?$"

#: Identifiers and the wording of public licence notices.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("ISC", "Licensed under the ISC License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
)
_TERM = re.compile(r"[a-z0-9][a-z0-9.+-]*[a-z0-9]|[a-z0-9]|[^\x00-\x7f]+")


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


VOCABULARY = frozenset(t for _, text in TEMPLATES for t in terms(text))
#: The terms of the full texts, for whole documents only: lines share too many of them.
FULL_VOCABULARY = VOCABULARY.union(t for _, text in TEXTS for t in terms(text))


class Matcher:
    """Cosines to the templates under given document frequencies."""

    def __init__(self, frequency: dict[str, int], n_docs: int):
        weight = lambda f: math.log((1 + n_docs) / (1 + f)) + 1
        self.weight = {t: weight(frequency.get(t, 0)) for t in FULL_VOCABULARY}
        self.other = weight(0)
        self.templates, self.full = self._vectors(TEMPLATES), self._vectors(TEXTS)

    def _vectors(self, texts) -> list[tuple[str, dict[str, float]]]:
        out = []
        for name, text in texts:
            vector = {t: c * self.weight[t] for t, c in Counter(terms(text)).items()}
            size = math.sqrt(sum(x * x for x in vector.values()))
            out.append((name, {t: x / size for t, x in vector.items()}))
        return out

    def whole(self, words: list[str]) -> tuple[float, str | None]:
        """The same against the full texts, of all words of a document."""
        counts = Counter(words)
        vector = {t: c * self.weight[t] for t, c in counts.items() if t in FULL_VOCABULARY}
        own = sum(x * x for x in vector.values())
        rest = sum(c * c for t, c in counts.items() if t not in FULL_VOCABULARY) * self.other**2
        if not own or own < MIN_COSINE**2 * (own + rest):
            return 0.0, None
        size = math.sqrt(own + rest)
        near = [(round(sum(x * v.get(t, 0.0) for t, x in vector.items()) / size, 9), name) for name, v in self.full]
        score, name = min(near, key=lambda n: (-n[0], n[1]))
        return (score, name) if score >= MIN_COSINE else (0.0, None)

    def best(self, words: list[str]) -> tuple[float, str | None]:
        """The highest cosine of at least MIN_COSINE, and its template's name."""
        shared = Counter(w for w in words if w in VOCABULARY)
        if not shared:
            return 0.0, None
        vector = {t: c * self.weight[t] for t, c in shared.items()}
        own = sum(x * x for x in vector.values())
        rest = (len(words) - shared.total()) * self.other**2  # at least, should words repeat
        if own < MIN_COSINE**2 * (own + rest):
            return 0.0, None
        size = math.sqrt(own + sum((c * self.other) ** 2 for t, c in Counter(w for w in words if w not in VOCABULARY).items()))
        near = [(round(sum(x * v.get(t, 0.0) for t, x in vector.items()) / size, 9), name) for name, v in self.templates]
        score, name = min(near, key=lambda n: (-n[0], n[1]))
        return (score, name) if score >= MIN_COSINE else (0.0, None)

    def scan(self, text: str) -> tuple[float, str | None, int, bool]:
        """Best cosine and licence over the text, its lines and pairs of lines, the
        number of terms, and whether most of them belong to the licence."""
        lines = [w for w in map(terms, text.split("\n")) if w]
        words = [w for line in lines for w in line]
        score, name = self.whole(words)
        if name:
            return score, name, len(words), True
        found = [(*self.best(words), len(words))] if len(lines) > 2 else []
        found += [(*self.best(span), len(span)) for span in (*lines, *(a + b for a, b in zip(lines, lines[1:])))]
        found = [f for f in found if f[0] >= MIN_COSINE]
        score, name, size = min(found, key=lambda f: (-f[0], f[1], -f[2])) if found else (0.0, None, 0)
        return score, name, len(words), 2 * size > len(words)


def frequencies(docs: DataFrame) -> DataFrame:
    """term, n: documents with each template term; the empty term counts them all."""
    def run(batches):
        for b in batches:
            n = Counter({"": b.num_rows})
            for text in b["text"].to_pylist():
                n.update(FULL_VOCABULARY.intersection(terms(text)))
            yield pa.record_batch([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["term", "n"])

    return docs.select(text_of(docs).alias("text")).mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def own_licences(docs: DataFrame) -> DataFrame:
    """doc_id, path, own (licence or null), score, n_terms, most of every row."""
    counted = {r["term"]: r["n"] for r in frequencies(docs).collect()}  # one row per template term
    matcher = Matcher(counted, counted.get("", 0))

    def run(batches):
        for b in batches:
            got = [matcher.scan(t) for t in b["text"].to_pylist()]
            yield pa.record_batch([b["doc_id"], b["path"], pa.array([g[1] for g in got], pa.string()), pa.array([g[0] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.int64()), pa.array([g[3] for g in got], pa.bool_())], names=["doc_id", "path", "own", "score", "n_terms", "most"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["path"].cast("string").alias("path"), text_of(docs).alias("text"))
    return rows.mapInArrow(run, "doc_id long, path string, own string, score double, n_terms long, most boolean")


def ancestors(folder: Column) -> Column:
    """depth and directory of a directory, of all above it, and of the root."""
    absolute = folder.startswith("/")
    parts = F.filter(F.split(folder, "/"), lambda p: p != "")
    root = F.when(absolute, "/").otherwise("")
    lead = F.when(absolute, "/").otherwise("")
    inner = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(i.alias("depth"), F.concat(lead, F.array_join(F.slice(parts, 1, i), "/")).alias("above")))
    top = F.array(F.struct(F.lit(0).alias("depth"), root.alias("above")))
    return F.when(F.size(parts) > 0, F.concat(top, inner)).otherwise(top)


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, path, text): doc_id, path, own, score,
    inherited_from (directory or null), licence."""
    folder = F.when(F.col("path").rlike("^/[^/]*$"), "/").otherwise(F.regexp_extract("path", r"^(.*)/[^/]*$", 1))
    rows = cut(own_licences(docs).withColumn("folder", folder), "licences")
    named = F.lower(F.regexp_extract("path", r"([^/]*)$", 1)).rlike(FILE_NAME)
    files = rows.filter(F.col("own").isNotNull() & (named | F.col("most")) & F.col("folder").isNotNull())
    first = F.min(F.struct((-F.col("score")).alias("s"), F.col("doc_id"), F.col("own").alias("licence")))
    ruled = files.groupBy("folder").agg(first.alias("f")).select(F.col("folder").alias("above"), F.col("f.licence").alias("licence"))
    folders = rows.filter("own IS NULL AND folder IS NOT NULL").select("folder").distinct().select("folder", F.inline(ancestors(F.col("folder"))))
    near = folders.join(ruled, "above").groupBy("folder").agg(F.max(F.struct("depth", "above", "licence")).alias("n"))
    near = near.select(F.col("folder").alias("at"), F.col("n.above").alias("inherited_from"), F.col("n.licence").alias("passed_on"))
    out = rows.join(near, (rows["folder"] == near["at"]) & rows["own"].isNull(), "left")
    return out.select("doc_id", "path", "own", F.round("score", 6).alias("score"), "inherited_from", F.coalesce("own", "passed_on").alias("licence"))
