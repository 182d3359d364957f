"""License scan: which license notices a text holds, with DataFrame functions only.

Texts and templates are read as lower-case ASCII words, and these as runs (shingles) of
five. Shingles that no template has can never match, so they are dropped at once, by a
broadcast join against the templates' own; their number bounds what is broadcast.

What is left goes through MinHash. A template is cut into pieces whose length is a power
of two, up to ``LONGEST``; a text into overlapping windows of twice each length, one
every length, so a piece copied whole lies whole in one window and has a similarity of a
half or more with it. Even with one shingle in five changed it stays above ``LEAST``; with ``BANDS`` bands of
one minimum the two share a band with probability ``1 - (1 - LEAST) ** BANDS``, over
0.9999. Shared bands retrieve templates; then the share of the template's distinct
shingles that the whole text holds is counted exactly, and ``CONTAINED`` of them is a match.

Defined results: NULL, empty and short texts have no matches; a text with no match gives
no row. Rows equal in id and text are reported once, rows that share an id but not the
text each for themselves. Templates under five words have no shingle and never match.
Templates equal in name are one with all their shingles. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from admere.session import stable

#: Words of a shingle, and the share of a template's shingles that makes a match.
SIZE, CONTAINED = 5, 0.8
#: Shingles of the longest piece; windows are twice as long.
LONGEST = 32
#: Similarity of a piece and its window that must be found, and bands of one minimum each.
LEAST, BANDS = 0.36, 24
#: Template rows that are broadcast at most; beyond that Spark chooses the join.
BROADCAST = 1_000_000

# Notices by which licenses are named or granted, in several wordings.
_WORDINGS = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 header": "You may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "MIT": "Released under the MIT License",
    "MIT grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "LGPL header": "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "AGPL header": "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "Unlicense": "This is free and unencumbered software released into the public domain",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "MIT licensed": "licensed under the MIT License",
    "MIT terms named": "under the terms of the MIT License",
    "Apache-2.0 licensed": "licensed under the Apache License 2.0",
    "Apache-2.0 terms named": "under the terms of the Apache License, Version 2.0",
    "GPL-2.0 licensed": "licensed under the GNU General Public License v2.0",
    "GPL-3.0 licensed": "licensed under the GNU General Public License v3.0",
    "LGPL licensed": "licensed under the GNU Lesser General Public License",
    "AGPL licensed": "licensed under the GNU Affero General Public License",
    "BSD-2-Clause licensed": "licensed under the BSD 2-Clause License",
    "BSD-3-Clause licensed": "licensed under the BSD 3-Clause License",
    "MPL-2.0 licensed": "licensed under the Mozilla Public License 2.0",
    "ISC licensed": "licensed under the ISC License",
    "CC-BY-4.0 short": "licensed under CC BY 4.0",
    "CC-BY-SA-4.0 short": "licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0 named": "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
}
_TEXTS = Path(__file__).parent / "license_texts"


def _body(text: str) -> str:
    """A license's terms alone, where they are marked as such."""
    parts = re.split(r"\n\s*(?:END OF )?TERMS AND CONDITIONS[^\n]*\n", text)
    return " ".join(max(parts, key=len).split())


#: Templates: the notices, and the terms of each license in the folder.
NOTICES = _WORDINGS | {f"{f.stem} terms": _body(f.read_text()) for f in sorted(_TEXTS.glob("*.txt"))}


def notices(spark: SparkSession, texts: dict[str, str] | None = None) -> DataFrame:
    """Templates as a table: ``license_id, text``."""
    texts = NOTICES if texts is None else texts
    if not texts:
        return spark.range(0).select(F.lit("").alias("license_id"), F.lit("").alias("text"))
    rows = F.array(*[F.struct(F.lit(k).alias("license_id"), F.lit(v).alias("text")) for k, v in texts.items()])
    return spark.range(1).select(F.inline(rows))


def scan(docs: DataFrame, templates: DataFrame, id: str = "doc_id", text: str = "text", contained: float = CONTAINED) -> DataFrame:
    """One row per text and template it holds: id, ``license_id, n_shingles, n_found, containment``."""
    own = templates.filter(F.col("text").isNotNull()).select("license_id", F.posexplode(_runs("text")).alias("at", "shingle"))
    own = stable(own)
    wanted = own.select("shingle").distinct()
    few = own.count() <= BROADCAST
    small = F.broadcast if few else (lambda df: df)
    rows = docs.filter(F.col(text).isNotNull()).select(F.col(id).alias("id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    spread = rows.select("id", "mark", F.posexplode(_runs("text")).alias("at", "shingle"))
    held = stable(spread.join(small(wanted), "shingle"))

    lengths = [1 << k for k in range(int(math.log2(LONGEST)) + 1)]
    # pieces: as long as the largest power of two that fits, at most LONGEST
    size = own.groupBy("license_id").agg(F.count(F.lit(1)).alias("n"))
    length = F.least(F.lit(LONGEST), F.pow(F.lit(2), F.floor(F.log2("n"))).cast("int"))
    piece = own.join(size, "license_id").withColumn("length", length).withColumn("part", F.floor(F.col("at") / F.col("length")))
    pieces = _bands(piece, ["license_id", "length", "part"])
    windows = held.withColumn("length", F.explode(F.array(*map(F.lit, lengths))))
    step = F.floor(F.col("at") / F.col("length"))
    windows = windows.withColumn("part", F.explode(F.filter(F.array(step, step - 1), lambda w: w >= 0)))
    found = _bands(windows, ["id", "mark", "length", "part"])
    candidates = found.join(small(pieces.select("license_id", "length", "band", "least")), ["length", "band", "least"]).select("id", "mark", "license_id").distinct()

    distinct = own.select("license_id", "shingle").distinct()
    counted = distinct.groupBy("license_id").agg(F.count(F.lit(1)).alias("n_shingles"))
    other = candidates.select(F.col("id").alias("i"), F.col("mark").alias("m"), "license_id")
    of_candidates = held.select("id", "mark", "shingle").distinct().join(other, F.col("id").eqNullSafe(F.col("i")) & (F.col("mark") == F.col("m")))
    kept = of_candidates.join(small(distinct), ["license_id", "shingle"]).groupBy("id", "mark", "license_id").agg(F.count(F.lit(1)).alias("n_found"))
    share = (F.col("n_found") / F.col("n_shingles")).alias("containment")
    return kept.join(small(counted), "license_id").filter(F.col("n_found") >= F.lit(contained) * F.col("n_shingles")).select(F.col("id").alias(id), "license_id", "n_shingles", "n_found", share)


def _runs(text: str, size: int = SIZE) -> Column:
    """Hashes of all runs of ``size`` words of a column, in order."""
    words = f"transform(regexp_extract_all({text}, '[A-Za-z0-9]+', 0), w -> xxhash64(lower(w)))"
    several = ", ".join(f"w[i + {k}]" for k in range(size))
    return F.expr(f"transform(array({words}), w -> IF(size(w) < {size}, array(), transform(sequence(0, size(w) - {size}), i -> xxhash64({several}))))[0]")


def _bands(shingles: DataFrame, keys: list[str]) -> DataFrame:
    """The least hash of each group's shingles, for each band's own hash function."""
    least = shingles.groupBy(*keys).agg(*[F.min(F.xxhash64("shingle", F.lit(b))).alias(f"b{b}") for b in range(BANDS)])
    return least.select(*keys, F.posexplode(F.array(*[F.col(f"b{b}") for b in range(BANDS)])).alias("band", "least"))


def scan_documents(docs: DataFrame) -> DataFrame:
    """Notices in every document."""
    return scan(docs, notices(docs.sparkSession))
