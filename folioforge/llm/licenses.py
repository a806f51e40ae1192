"""License scans: MinHash bands over overlapping windows of a text retrieve templates, exact containment verifies them.

Templates are looked for by classes of size: a class of S shingles (STEP times the one before, every size up to 8) holds those of S or
fewer. Its windows are S + stride - 1 shingles long and start at every stride-th, stride = max(1, S // 4), so that each stretch of S
shingles lies whole in one of them. If that holds 80 % of a template's s shingles, s >= S / 1.25, the Jaccard similarity of window and
template is at least 0.64 / (1.25 + 0.16) = 0.45 (at up to 4 shingles it holds all of them), so 48 bands of 2 rows retrieve it with
probability 1 - (1 - 0.45 ** 2) ** 48 > 0.99998. Bands are an index: (class, band, value) names templates, and the cost of a window does
not depend on how many there are. A band can only agree where the window holds the template's least shingle, so windows without any
shingle of a template of their class are passed over unhashed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import Rolling, WordHashes

SHINGLE, CONTAINED, BANDS, ROWS, STEP = 5, 0.8, 48, 2, 1.25
WINDOWS = 2048  # hashed at once

# Notices by which licences are commonly stated.
TEMPLATES = {
    "AGPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause-endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-2.1-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
}

EDGE = b".,;:!?()[]{}<>\"'`*#-_/|"


class Bare(WordHashes):
    """Hashes of words without punctuation at their ends; a word that is all punctuation has none (0)."""

    def __missing__(self, word: bytes) -> int:
        bare = word.strip(EDGE)
        h = super().__missing__(bare) if bare and bare != word else 0 if not bare else None
        if h is None:
            return super().__missing__(word)
        self[word] = h
        return h


def size_class(n: int) -> int:
    """The least class that holds n shingles: 1 to 8, then each STEP times the one before, rounded down."""
    size = 8
    while size < n:
        size = int(size * STEP)
    return n if n <= 8 else size


def among(values: np.ndarray, rising: np.ndarray) -> np.ndarray:
    """Which values are in a rising array that is not empty."""
    return rising[np.minimum(np.searchsorted(rising, values), len(rising) - 1)] == values


class Class:
    """Templates of one size class: their shingles, and the index from band values to them."""

    def __init__(self, size: int):
        self.size, self.stride = size, max(1, size // 4)
        self.width = size + self.stride - 1
        self.names: list[str] = []
        self.shingles: list[np.ndarray] = []

    def close(self, bands: list[np.ndarray]) -> None:
        keys = np.concatenate(bands)
        order = np.argsort(keys, kind="stable")
        self.keys, self.of = keys[order], np.repeat(np.arange(len(bands)), BANDS)[order]
        self.any = np.unique(np.concatenate(self.shingles))

    def probe(self, bands: np.ndarray) -> list[tuple[int, int]]:
        """(window, template) pairs that agree in a band, each once."""
        flat = bands.ravel()
        low, high = np.searchsorted(self.keys, flat), np.searchsorted(self.keys, flat, "right")
        return sorted({(int(i) // BANDS, int(self.of[j])) for i in np.flatnonzero(high > low) for j in range(low[i], high[i])})


class Scanner:
    def __init__(self, templates: dict[str, str], contained: float):
        self.hashes, self.roll, self.contained, self.texts = Bare(7), Rolling(), contained, {}
        rng = np.random.Generator(np.random.PCG64(2024))
        self.a = rng.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
        self.band = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        classes: dict[int, tuple[Class, list[np.ndarray]]] = {}
        for name in sorted(templates):
            words, _, h = self.words(templates[name])
            s = self.shingles(h)
            if len(s):
                c, bands = classes.setdefault(size_class(len(s)), (Class(size_class(len(s))), []))
                c.names.append(name)
                c.shingles.append(np.unique(s))
                bands.append(self.bands(self.rows(s).min(axis=0)[None])[0])
                self.texts[name] = self.tuples(words)
        for c, bands in classes.values():
            c.close(bands)
        self.classes = [c for _, (c, _) in sorted(classes.items())]
        self.every = np.unique(np.concatenate([np.zeros(0, np.uint64), *[c.any for c in self.classes]]))
        self.seen = np.zeros(1 << 22, bool)  # a first look: by the low bits of a shingle
        self.seen[(self.every & np.uint64(0x3FFFFF)).astype(np.int64)] = True

    def words(self, text: str) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Words that are more than punctuation, A-Z lower-cased, their places among all words, and their hashes."""
        all_words = text.encode("utf-8", "surrogatepass").lower().split()
        h = self.hashes.of(all_words)
        at = np.flatnonzero(h)
        return ([all_words[i] for i in at] if len(at) < len(all_words) else all_words), at, h[at]

    def shingles(self, h: np.ndarray) -> np.ndarray:
        """Hashes of the 5-word shingles (fewer words: of the whole sequence)."""
        if not len(h):
            return h
        k = min(SHINGLE, len(h))
        start = np.arange(len(h) - k + 1)
        return self.roll.stretch(self.roll.sums(h), start, start + k)

    @staticmethod
    def tuples(words: list[bytes]) -> set[tuple[bytes, ...]]:
        bare = [w.strip(EDGE) for w in words]
        k = min(SHINGLE, len(bare))
        return {tuple(bare[i : i + k]) for i in range(len(bare) - k + 1)}

    def rows(self, s: np.ndarray) -> np.ndarray:
        return (s[:, None] * self.a >> np.uint64(32)).astype(np.uint32)

    def bands(self, least: np.ndarray) -> np.ndarray:
        x = least.astype(np.uint64).reshape(len(least), BANDS, ROWS)
        return (x[:, :, 0] << np.uint64(32) | x[:, :, 1]) ^ self.band

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """(template, best containment, first word of the first best window, windows that hold it)."""
        words, at, h = self.words(text)
        s = self.shingles(h)
        hit = np.flatnonzero(self.seen[(s & np.uint64(0x3FFFFF)).astype(np.int64)])
        hit = hit[among(s[hit], self.every)] if len(hit) else hit
        found: dict[str, tuple[float, int, int]] = {}
        for c in self.classes if len(hit) else ():
            near = hit[among(s[hit], c.any)]
            if not len(near):
                continue
            last = max(0, -(-(len(s) - c.width) // c.stride))  # the first window that reaches the end is the last one
            low, high = np.maximum(0, -(-(near - c.width + 1) // c.stride)), np.minimum(near // c.stride, last)
            some = np.zeros(last + 2, np.int64)
            np.add.at(some, np.minimum(low, last), 1)
            np.add.at(some, high + 1, -1)
            windows = np.flatnonzero(np.cumsum(some[:-1]) > 0)
            for k in range(0, len(windows), max(1, WINDOWS // c.width)):
                part = windows[k : k + max(1, WINDOWS // c.width)]
                least = np.stack([self.rows(s[w * c.stride : w * c.stride + c.width]).min(axis=0) for w in part])
                for w, t in c.probe(self.bands(least)):
                    i = int(part[w]) * c.stride
                    if np.isin(c.shingles[t], s[i : i + c.width]).mean() < self.contained:
                        continue
                    own = self.texts[c.names[t]]
                    share = len(own & self.tuples(words[i : i + c.width + SHINGLE - 1])) / len(own)  # on the words themselves
                    if share >= self.contained:
                        best, first, n = found.get(c.names[t], (0.0, 0, 0))
                        found[c.names[t]] = (share, int(at[i]), n + 1) if share > best else (best, first, n + 1)
        return [(name, float(b), f, n) for name, (b, f, n) in sorted(found.items())]


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, contained: float = CONTAINED) -> DataFrame:
    """documents -> (doc_id, matches array<struct<license, containment, first_word, windows>>), one row per row.

    Words are compared in lower case (A-Z) and without punctuation at their ends. A template matches if one window holds `contained`
    of its distinct shingles. Null, empty or blank texts and templates match nothing: matches is empty. Repeated rows give repeated rows, an
    empty table an empty result; other columns are ignored, whatever their names. Templates are held by each task.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_scan(templates, contained), "doc_id long, matches array<struct<license:string,containment:double,first_word:long,windows:long>>")


def _scan(templates: dict[str, str], contained: float):
    kind = pa.list_(pa.struct([("license", pa.string()), ("containment", pa.float64()), ("first_word", pa.int64()), ("windows", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, contained)
        for b in batches:
            got = [[dict(zip(("license", "containment", "first_word", "windows"), m, strict=True)) for m in scanner.scan(t.as_py() or "")] for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, kind)], ["doc_id", "matches"])

    return run


def licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """documents -> (doc_id, licenses string (names joined by commas, '' for none), n_licenses, best_containment, first_word), a row per row."""
    m = F.col("matches")
    return scan(docs, templates).select(
        "doc_id",
        F.array_join(m["license"], ",").alias("licenses"),
        F.size(m).cast("long").alias("n_licenses"),
        F.coalesce(F.array_max(m["containment"]), F.lit(0.0)).alias("best_containment"),
        F.array_min(m["first_word"]).alias("first_word"),
    )
