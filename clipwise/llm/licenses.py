"""License scans: MinHash bands over overlapping windows, then exact containment; DataFrame functions only."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .decontaminate import BETWEEN, words

#: Statements by which texts are put under a license.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "BSD-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "ISC-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "MIT": "Released under the MIT License",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "Unlicense": "This is free and unencumbered software released into the public domain",
}

SHINGLE, WINDOW, STRIDE, BANDS = 5, 8, 4, 24
PER_WINDOW = WINDOW - SHINGLE + 1


def _mask(band: int) -> int:
    """A fixed 64-bit mask for each band, by the splitmix64 sequence."""
    full = (1 << 64) - 1
    x = (band + 1) * 0x9E3779B97F4A7C15 & full
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & full
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & full
    x ^= x >> 31
    return x - (1 << 64) if x >> 63 else x


def _windows(ws: Column, stride: int) -> Column:
    """Struct of a window's start and its shingle hashes (null beyond the end), every ``stride`` words."""
    n = F.size(ws)

    def one(i: Column) -> Column:
        hashes = [
            F.when(i + k + SHINGLE <= n, F.xxhash64(*[F.get(ws, i + k + j) for j in range(SHINGLE)])).alias(f"h{k}")
            for k in range(PER_WINDOW)
        ]
        return F.struct(i.alias("i"), *hashes)

    starts = F.when(n >= SHINGLE, F.sequence(F.lit(0), n - SHINGLE, F.lit(stride))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, one)


def _minimum(window: Column, band: int) -> Column:
    """MinHash of a window: the least of its hashes, permuted by a mask."""
    return F.least(*[window[f"h{k}"].bitwiseXOR(F.lit(_mask(band))) for k in range(PER_WINDOW)])


def index(spark: SparkSession, templates: Mapping[str, str]) -> list[dict[int, list[str]]]:
    """For each band the templates by the MinHash of each of their windows; a few rows for each template."""
    rows = F.array(*[F.struct(F.lit(k).alias("id"), F.lit(v).alias("text")) for k, v in templates.items()])
    wins = spark.range(1).select(F.explode(rows).alias("t")).select("t.id", F.explode(_windows(words(F.col("t.text")), 1)).alias("w"))
    found = wins.select("id", "w.h3", *[_minimum(F.col("w"), b).alias(f"m{b}") for b in range(BANDS)], (F.col("w.i") == 0).alias("first")).collect()
    out: list[dict[int, list[str]]] = [{} for _ in range(BANDS)]
    for r in found:
        if r["h3"] is None and not r["first"]:
            continue  # the end of a longer template: its last whole window holds it
        for b in range(BANDS):
            ids = out[b].setdefault(r[f"m{b}"], [])
            if r["id"] not in ids:
                ids.append(r["id"])
    return out


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, *, containment: float = 0.8, text_col: str = "text") -> DataFrame:
    """Adds ``licenses``, an array of (license, start, containment), to every row.

    Words are as in ``decontaminate.words``, shingles have five. Windows of eight words, every four, hold each
    run of five words; 24 bands of one MinHash each retrieve templates. A window that holds the
    only shingle of a five-word template shares a quarter of their shingles and collides in some band with
    probability 0.999; windows inside a longer match are equal to one of the template's and always collide.
    For each template retrieved by a window, the share of its shingles found among those of the region around
    (the template's length to either side) is computed exactly, and kept from ``containment`` on. The best
    region counts, then the first; ``start`` is the word at which its first shingle of the template begins.

    Everything happens within the row: no shuffle, whatever a source or a line's share of the rows. The
    templates are a parameter, and become literals. A null text has no licenses; templates need
    five words. Texts are read whole, very long ones too; an empty table gives no rows. Repeated rows get equal results; a column
    named ``licenses`` is replaced.
    """
    bands = index(docs.sparkSession, templates)
    tokens = {k: _template_shingles(v) for k, v in templates.items()}
    q = lambda x: "'" + x.replace("'", "\\'") + "'"
    sql_map = lambda items: f"map({', '.join(f'{k}, {v}' for k, v in items)})"
    texts = lambda xs: f"array({', '.join(map(q, xs))})"
    least = [f"least({', '.join(f'w.h{k} ^ {_mask(b)}L' for k in range(PER_WINDOW))})" for b in range(BANDS)]
    collides = " OR ".join(f"{least[b]} IN ({', '.join(f'{v}L' for v in bands[b])})" for b in range(BANDS))
    retrieved = ", ".join(f"try_element_at({sql_map((f'{v}L', texts(ids)) for v, ids in bands[b].items())}, {least[b]})" for b in range(BANDS))
    goal = f"element_at({sql_map((q(k), texts(x)) for k, (_, x) in tokens.items())}, t)"
    size = f"element_at({sql_map((q(k), n) for k, (n, _) in tokens.items())}, t)"
    places = f"sequence(greatest(w.i - {size}, 0), least(size(_ws) - {SHINGLE}, w.i + {WINDOW - SHINGLE} + {size}))"
    at = f"array_join(slice(_ws, p + 1, {SHINGLE}), ' ')"
    share = f"size(array_intersect({goal}, transform({places}, p -> {at}))) / size({goal})"
    start = f"get(filter({places}, p -> array_contains({goal}, {at})), 0)"
    found = (
        f"flatten(transform(_hits, w -> transform(array_distinct(flatten(array_compact(array({retrieved})))), "
        f"t -> struct({share} AS containment, -{start} AS at, t AS license))))"
    )
    good = f"filter(_found, x -> x.containment >= {containment}D)"
    best = (
        "transform(array_sort(array_distinct(transform(_good, x -> x.license))), t -> "
        "array_max(filter(_good, x -> x.license = t)))"
    )
    out = "transform(_best, x -> struct(x.license AS license, -x.at AS start, x.containment AS containment))"
    keep = [c for c in docs.columns if c != "licenses"]
    steps = (
        ("_ws", words(F.col(text_col)), ()),
        ("_wins", _windows(F.col("_ws"), STRIDE), ("_ws",)),
        ("_hits", F.expr(f"filter(_wins, w -> {collides})"), ("_ws",)),
        ("_found", F.expr(found), ()),
        ("_good", F.expr(good), ()),
        ("_best", F.expr(best), ()),
        ("licenses", F.expr(out), ()),
    )
    for name, value, also in steps:
        # A generator of one row keeps the optimizer from repeating an expression for each of its uses.
        docs = docs.select(*keep, *also, F.explode(F.array(value)).alias(name))
    return docs


def _template_shingles(text: str) -> tuple[int, list[str]]:
    ws = [w for w in re.split(BETWEEN, "".join(c.lower() if c.isascii() else c for c in text)) if w]
    return len(ws), list(dict.fromkeys(" ".join(ws[i : i + SHINGLE]) for i in range(len(ws) - SHINGLE + 1)))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and license found in it."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.explode("licenses").alias("l")).select("doc_id", "l.license", "l.start", "l.containment")


def _values() -> str:
    rows = [(k, *_template_shingles(v)) for k, v in TEMPLATES.items()]
    return ", ".join(f"('{k}', {n}, {len(s)}, '{x}')" for k, n, s in rows for x in s)


_W = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"

OP2_SQL = f"""
WITH t(license, len, parts, shingle) AS (VALUES {_values()}),
d AS (SELECT row_number() OVER () AS rn, doc_id, {_W} AS ws FROM documents),
s AS (SELECT rn, doc_id, len(ws) AS n, p, array_to_string(ws[p + 1:p + 5], ' ') AS shingle
      FROM (SELECT rn, doc_id, ws, unnest(range(0, greatest(len(ws) - 4, 0))) AS p FROM d)),
h AS (SELECT s.rn, s.doc_id, s.n, s.p, t.* FROM s JOIN t USING (shingle)),
r AS (SELECT rn, doc_id, license, parts, shingle, n, p,
             unnest(range(CAST(ceil(greatest(p - 8 - len + 5, 0) / 4.0) * 4 AS BIGINT), p + len + 1, 4)) AS i FROM h),
c AS (SELECT rn, doc_id, license, i, min(p) AS p, count(DISTINCT shingle) / CAST(any_value(parts) AS DOUBLE) AS containment
      FROM r WHERE i <= n - 5 GROUP BY rn, doc_id, license, i)
SELECT doc_id, license, CAST(arg_max(p, containment * 1000000000 - p) AS INTEGER) AS "start", max(containment) AS containment
FROM c WHERE containment >= 0.8 GROUP BY rn, doc_id, license
"""
