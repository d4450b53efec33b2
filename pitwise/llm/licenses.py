"""Licence scans: units of normalised text against licence templates, by the Dice coefficient over word bigrams.

A unit is a line, a paragraph (lines up to an empty one) or the whole text. A unit with a bigrams and a template with b can reach a coefficient of t
only if t / (2 - t) <= a / b <= (2 - t) / t, and only if they share t / (2 - t) of the template's bigrams; both bounds prune templates before
any unit is compared, and neither loses a match.
"""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwise.llm.common import map_batches, words_of

#: Fixed texts of well-known licences and of the notices that name them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("proprietary", "All rights reserved"),
)


class Template(NamedTuple):
    license: str
    bigrams: frozenset


def bigrams(words: list[bytes]) -> set[tuple[bytes, bytes]]:
    return set(zip(words, words[1:]))


def prepared(templates: tuple[tuple[str, str], ...]) -> list[Template]:
    return [Template(name, frozenset(bigrams(words_of(text.encode())))) for name, text in templates]


def matches(raw: bytes, templates: list[Template], every: frozenset, threshold: float, best: bool = False) -> list[tuple[str, str, int, float]]:
    """(licence, unit, position, Dice) of every unit and licence that reach the threshold; units are counted from 0.

    With ``best`` a unit keeps the licences of its highest Dice only, all of them on a tie.
    """
    shared = bigrams(words_of(raw)) & every
    if not shared:
        return []
    least = threshold / (2 - threshold)
    wanted = [t for t in templates if t.bigrams and len(shared & t.bigrams) >= least * len(t.bigrams) - 1e-9]
    if not wanted:
        return []
    units = [("line", i, part) for i, part in enumerate(raw.split(b"\n"))] + [("paragraph", i, part) for i, part in enumerate(raw.split(b"\n\n"))] + [("text", 0, raw)]
    found: dict[tuple[str, str, int], float] = {}
    for unit, position, part in units:
        grams = bigrams(words_of(part))
        for t in wanted:
            a, b = len(grams), len(t.bigrams)
            if a and a >= least * b - 1e-9 and least * a <= b + 1e-9:
                dice = 2 * len(grams & t.bigrams) / (a + b)
                if dice >= threshold:
                    found[t.license, unit, position] = max(dice, found.get((t.license, unit, position), 0.0))
    if best:
        highest: dict[tuple[str, int], float] = {}
        for (_, *unit), dice in found.items():
            highest[tuple(unit)] = max(dice, highest.get(tuple(unit), 0.0))
        found = {k: v for k, v in found.items() if v >= highest[k[1:]] - 1e-12}
    return [(*k, v) for k, v in found.items()]


def find_licenses(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = 0.8, best: bool = False) -> DataFrame:
    """Documents with licenses: an array of (license, unit, position, dice); the name must be free.

    All licences that reach the threshold in a unit are given, with ``best`` those of the unit's highest Dice only: notices of two licences can
    differ in one word and then both reach it. Text is normalised to lower-case words. Null and empty texts, and units of fewer than two words, match nothing. Each row is judged by itself.
    """
    if "licenses" in {c.lower() for c in docs.columns}:
        raise ValueError("documents already have licenses")
    columns = docs.columns
    at = columns.index("text")
    known = prepared(templates)
    every = frozenset().union(*(t.bigrams for t in known))
    kind = pa.list_(pa.struct([("license", pa.string()), ("unit", pa.string()), ("position", pa.int32()), ("dice", pa.float64())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [[dict(zip(("license", "unit", "position", "dice"), m)) for m in matches(raw, known, every, threshold, best)] if raw else [] for raw in batch.column(at).cast(pa.binary()).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*columns, "licenses"])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return map_batches(docs, run, f"{fields}, licenses array<struct<license string, unit string, position int, dice double>>")


def license_report(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = 0.8, best: bool = False) -> DataFrame:
    """One row per document: doc_id, n_matches (licence and unit), licenses (distinct, sorted, comma-joined), best_dice (null without a match)."""
    found = find_licenses(docs.select("doc_id", "text"), templates, threshold, best)
    names = F.array_join(F.array_sort(F.array_distinct(F.transform("licenses", lambda m: m["license"]))), ",")
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_matches"), names.alias("licenses"), F.array_max(F.transform("licenses", lambda m: m["dice"])).alias("best_dice"))


def report_sql(templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = 0.8, best: bool = False) -> str:
    """DuckDB SQL for ``license_report`` over the table documents."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({i}, {quoted(name)}, {quoted(text)})" for i, (name, text) in enumerate(templates))
    words = "regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH template(t, license, body) AS (VALUES {values}),
tw AS (SELECT t, license, {words.format("body")} AS w FROM template),
tg AS (SELECT DISTINCT t, license, g FROM (SELECT t, license, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM tw)),
tn AS (SELECT t, count(*) AS b FROM tg GROUP BY t),
unit AS (SELECT doc_id, 'line' AS unit, unnest(range(0, len(a))) AS pos, unnest(a) AS part FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL)
  UNION ALL SELECT doc_id, 'paragraph', unnest(range(0, len(a))), unnest(a) FROM (SELECT doc_id, string_split(text, chr(10) || chr(10)) AS a FROM documents WHERE text IS NOT NULL)
  UNION ALL SELECT doc_id, 'text', 0, text FROM documents WHERE text IS NOT NULL),
uw AS (SELECT doc_id, unit, pos, {words.format("part")} AS w FROM unit),
ug AS (SELECT DISTINCT doc_id, unit, pos, g FROM (SELECT doc_id, unit, pos, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM uw)),
un AS (SELECT doc_id, unit, pos, count(*) AS a FROM ug GROUP BY ALL),
both_of AS (SELECT doc_id, unit, pos, t, license, count(*) AS c FROM ug JOIN tg USING (g) GROUP BY ALL),
dice AS (SELECT doc_id, unit, pos, license, max(2.0 * c / (a + b)::DOUBLE) AS d FROM both_of JOIN un USING (doc_id, unit, pos) JOIN tn USING (t) WHERE 2.0 * c / (a + b)::DOUBLE >= {threshold} GROUP BY doc_id, unit, pos, license{
        " QUALIFY d >= max(d) OVER (PARTITION BY doc_id, unit, pos) - 1e-12" if best else ""}),
found AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS names, max(d) AS best FROM dice GROUP BY doc_id)
SELECT documents.doc_id, coalesce(n, 0) AS n_matches, coalesce(names, '') AS licenses, best AS best_dice FROM documents LEFT JOIN found USING (doc_id)"""
