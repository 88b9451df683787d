"""License scans: MinHash bands over overlapping windows find templates, shingle containment confirms them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.llm.common import byte_hash, chunks, mix, row_of, utf8

# License notices as they are commonly written.
TEMPLATES = {
    "MIT notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions:"
    ),
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met:"
    ),
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
}

# Words of a scan are runs of ASCII letters, digits and non-ASCII bytes, letters lower-cased.
_FOLDED = np.zeros(256, np.uint8)
_FOLDED[0x80:] = np.arange(0x80, 0x100)
for _low, _high in (("0", "9"), ("a", "z"), ("A", "Z")):
    for _c in range(ord(_low), ord(_high) + 1):
        _FOLDED[_c] = ord(chr(_c).lower())
NEVER = ~np.uint64(0)
# Window lengths in shingles, each with the distance between windows: a quarter, at least one.
WINDOWS = [(2 << k, max(1, (2 << k) // 4)) for k in range(16)]


def folded_words(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each row and the rows they are in."""
    text = _FOLDED[data]
    inside = np.zeros(len(text) + 2, bool)
    inside[1:-1] = text != 0
    row = row_of(rows)
    change = np.zeros(len(text) + 1, bool)
    change[1:-1] = row[1:] != row[:-1]
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | change[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | change[1:])) + 1
    return byte_hash(text, start, end), row[start]


def _shingles(word: np.ndarray, k: int) -> np.ndarray:
    h = np.full(max(0, len(word) - k + 1), k, np.uint64)
    for j in range(k):
        h = mix(h * np.uint64(3) + word[j : j + len(h)])
    return h


@dataclass(frozen=True)
class LicenseScan:
    """Templates and the settings of their retrieval.

    A template of m shingles is looked for in windows of at most 8/3 (m + 1) of them that overlap by three
    quarters, so some window holds the whole passage, at a similarity of 0.3 or more even if a
    fifth of the template is changed. Each band is one of `bands` MinHash values: they miss such a
    window with a probability of 0.7 ** bands, 4e-8 for 48.
    """

    templates: tuple[tuple[str, str], ...] = tuple(TEMPLATES.items())
    words: int = 5
    containment: float = 0.8
    bands: int = 48

    @cached_property
    def multipliers(self) -> np.ndarray:
        return mix(np.arange(501, 501 + self.bands, dtype=np.uint64)) | np.uint64(1)

    @cached_property
    def sets(self) -> list[np.ndarray]:
        """The shingles of each template; one of fewer words is too short to look for."""
        out = []
        for _, text in self.templates:
            data = np.frombuffer(text.encode(), np.uint8)
            out.append(np.unique(_shingles(folded_words(data, np.array([0, len(data)]))[0], self.words)))
        return out

    @cached_property
    def window_of(self) -> list[tuple[int, int] | None]:
        lengths = [len(s) for s in self.sets]
        return [next(w for w in WINDOWS if n <= w[0] - w[1] + 1) if n else None for n in lengths]

    def retrieve(self, h: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """For each template, starts of the windows that share a band with it; h has NEVER between rows."""
        found = [np.zeros(0, bool)] * len(self.sets)
        kinds = sorted({w for w in self.window_of if w})
        gap = h == NEVER
        for m in self.multipliers:
            v = m * h
            v[gap] = NEVER
            for length, step in kinds:
                low = v.reshape(-1, step).min(axis=1) if step > 1 else v
                low = np.append(low, np.full(length // step - 1, NEVER))
                for _ in range((length // step).bit_length() - 1):
                    shift = 1 << _
                    low = np.minimum(low[:-shift], low[shift:])
                for t, window in enumerate(self.window_of):
                    if window == (length, step):
                        hit = low == (m * self.sets[t]).min()
                        found[t] = hit | found[t] if len(found[t]) else hit
        return [(t, np.flatnonzero(f) * self.window_of[t][1]) for t, f in enumerate(found) if f.any()]

    def confirm(self, h: np.ndarray, t: int, starts: np.ndarray) -> list[tuple[int, int, float]]:
        """First shingle, last shingle and containment of the passages among the windows.

        Of windows that overlap, the one with the highest containment counts, the first of equal ones.
        """
        length, found = self.window_of[t][0], []
        for start in starts.tolist():
            inside = np.isin(h[start : start + length], self.sets[t])
            share = len(np.unique(h[start : start + length][inside])) / len(self.sets[t])
            if share >= self.containment:
                at = np.flatnonzero(inside)
                found.append((start + int(at[0]), start + int(at[-1]), share))
        out: list[tuple[int, int, float]] = []
        for first, last, share in sorted(found):
            if out and first <= out[-1][1]:
                if share > out[-1][2]:
                    out[-1] = (first, last, share)
            else:
                out.append((first, last, share))
        return out

    def scan(self, data: np.ndarray, rows: np.ndarray) -> list[tuple[int, int, int, int, float]]:
        """Row, template, first and last word, and containment of every passage of a chunk."""
        word, word_row = folded_words(data, rows)
        kinds = [w for w in self.window_of if w]
        if not kinds or len(word) < self.words:
            return []
        # Each row's shingles, then at least one longest window without any, so none spans two rows.
        step, longest = max(s for _, s in kinds), max(n for n, _ in kinds)
        n = np.bincount(word_row, minlength=len(rows) - 1)
        count = np.maximum(n - self.words + 1, 0)
        room = np.where(count > 0, -(-(count + longest) // step) * step, 0)
        begin = np.cumsum(room) - room
        h = np.full(int(room.sum()), NEVER)
        every = _shingles(word, self.words)
        row = word_row[: len(every)]
        first = (np.cumsum(n) - n)[row]
        place = np.arange(len(every)) - first
        whole = place < count[row]
        h[(begin[row] + place)[whole]] = every[whole]
        out = []
        for t, starts in self.retrieve(h):
            for a, b, share in self.confirm(h, t, starts):
                r = int(np.searchsorted(begin + room, a, "right"))
                out.append((r, t, a - int(begin[r]), b - int(begin[r]) + self.words - 1, share))
        return sorted(out)


def license_passages(
    docs: DataFrame, scan: LicenseScan | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per passage that holds a template: id, license, first_word, last_word, containment.

    Words are runs of letters and digits, lower-cased; places count the document's words from 0. Every
    window of every whole text is looked at. A passage counts when at least `scan.containment` of the
    template's word shingles stand in one window. Null and empty texts have no passages; repeated
    rows and null ids each give their own; an empty table gives none. Templates are a bounded
    parameter that goes to the tasks with the code. Only the two named columns are read.
    """
    scan = scan or LicenseScan()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, rows = utf8(batch.column(1))
            found = []
            for first, _, d, r in chunks(data, rows):
                found += [(first + row, *rest) for row, *rest in scan.scan(d, r)]
            row, template, a, b, share = map(list, zip(*found, strict=True)) if found else [[]] * 5
            yield pa.record_batch(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array([scan.templates[t][0] for t in template], pa.string()),
                    pa.array(a, pa.int64()),
                    pa.array(b, pa.int64()),
                    pa.array(share, pa.float64()),
                ],
                names=["id", "license", "first_word", "last_word", "containment"],
            )

    schema = T.StructType([T.StructField("id", docs.schema[id_column].dataType)]).add("license", "string")
    schema = schema.add("first_word", "long").add("last_word", "long").add("containment", "double")
    read = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return read.mapInArrow(find, schema).withColumnRenamed("id", id_column)
