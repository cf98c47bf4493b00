"""License scan: MinHash bands over overlapping text windows retrieve templates, exact shingle containment verifies them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from waymark.llm import text as T
from waymark.llm.windows import PatternIndex

# License notices as their publishers word them.
TEMPLATES = [
    ("mit-line", "Released under the MIT License."),
    ("apache-2.0-line", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3.0-line", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-4.0-line", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0-notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0-notice", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
     "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
     "in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either "
     "express or implied."),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
     "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
     "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
     "following conditions:"),
    ("bsd-clauses", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
     "conditions are met:"),
    ("gpl-3.0-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
     "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
]


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, width: int = 5, containment: float = 0.8, rows: int = 2,
         miss: float = 1e-4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, template, n_shingles, n_found, containment) of every template with at least `containment` of its distinct shingles in a text.

    Windows overlap by all but a quarter of the smallest template of their size class, and the bands of `rows` hashes are
    as many as make the miss probability of a template that stands in a text at most `miss`. The templates are a parameter
    of fixed size; the documents are read once and not shuffled. Null and empty texts match nothing, repeated rows come
    back as often as they are given, a template shorter than `width` words is one shingle of all its words.
    """
    index = PatternIndex(TEMPLATES if templates is None else templates, width, containment, rows=rows, miss=miss, wide=False)
    shared = docs.sparkSession.sparkContext.broadcast(index)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batch):
        got = shared.value.verified(batch.column(1).to_pylist())
        if got:
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([g[0] for g in got], pa.int64())), pa.array([g[1] for g in got], pa.string()),
                                              pa.array([g[2] for g in got], pa.int64()), pa.array([g[3] for g in got], pa.int64())],
                                             names=[id_col, "template", "n_shingles", "n_found"])

    found = T.mapped(docs.select(id_col, text_col), run, f"{id_col} {kind}, template string, n_shingles long, n_found long", text_col)
    return found.withColumn("containment", F.col("n_found") / F.col("n_shingles"))
