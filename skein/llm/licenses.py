"""License scans by diagonal voting, in DataFrame operations only.

Every rolling ``K``-word hash of every document is joined with the positions at which it stands in
the templates (a broadcast table of ``BROADCAST_ROWS`` rows at most; a larger one is joined by shuffle,
with the same rows). A hit votes for the diagonal "document position minus template position" and is
verified word by word. Votes are added up by diagonal; neighbouring diagonals of one template, at
most ``GAP`` words apart, are merged, which bridges inserted and left-out words; a merged span is verified
when it covers ``COVERAGE`` of its template's words. Of verified spans that overlap, directly or through others, the
one with the most covered words gives its label (of equally many, the one that covers the larger share of its template), so notices
that differ in a few words are told apart.

An empty gram gives one row for each document, so that one pass yields the hits and the documents
without hits. Rows are dealt out once, by row, before any grouping.

Cases: null or empty text has no words, no labels and score 0; repeated rows stay apart; very long
texts are scanned whole, at a cost in proportion to their length; of templates that share words the best gets the
label, and an exact tie gives both; an empty table gives an empty result, and without
templates nothing is found; other columns, also of the result's names, are not read.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
K, GAP, COVERAGE, SHORTEST = 3, 6, 0.6, 6
GRAM = f"struct<at:int,hash:bigint,{','.join(f'w{j}:string' for j in range(K))}>"
GRAMS = f"array<{GRAM}>"
#: Template rows that may be broadcast (about 100 bytes each).
BROADCAST_ROWS = 50_000

#: The phrases, and their labels, whose exact places are reported.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
_BSD = (
    "redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    " 2. redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
#: Notices of public licences.
NOTICES = [
    ("licensed under the apache license, version 2.0", "apache-2"),
    ("licensed under the apache license version 2.0 (the license); you may not use this file except in compliance with the license. you may obtain a copy of the license at http://www.apache.org/licenses/license-2.0", "apache-2"),
    ("unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an as is basis, without warranties or conditions of any kind, either express or implied", "apache-2"),
    ("permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the software), to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software", "mit"),
    ("this project is released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("licensed under cc by-nc 4.0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution-noncommercial 4.0 international license", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution 4.0 international license", "cc-by"),
    ("this work is licensed under a creative commons attribution-sharealike 4.0 international license", "cc-by-sa"),
    ("this work is licensed under a creative commons attribution-noderivatives 4.0 international license", "cc-by-nd"),
    ("this work is licensed under a creative commons attribution-noncommercial-sharealike 4.0 international license", "cc-by-nc-sa"),
    ("this work is licensed under the gnu general public license, version 3", "gpl-3"),
    ("this program is free software: you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation, either version 3 of the license, or (at your option) any later version", "gpl-3"),
    ("this program is free software; you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation; either version 2 of the license, or (at your option) any later version", "gpl-2"),
    ("this program is free software: you can redistribute it and/or modify it under the terms of the gnu affero general public license as published by the free software foundation, either version 3 of the license, or (at your option) any later version", "agpl-3"),
    ("this library is free software; you can redistribute it and/or modify it under the terms of the gnu lesser general public license as published by the free software foundation; either version 2.1 of the license, or (at your option) any later version", "lgpl-2.1"),
    ("this library is free software: you can redistribute it and/or modify it under the terms of the gnu lesser general public license as published by the free software foundation, either version 3 of the license, or (at your option) any later version", "lgpl-3"),
    ("redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "bsd"),
    (_BSD, "bsd-2"),
    (_BSD + " neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "bsd-3"),
    ("permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies", "isc"),
    ("permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("this source code form is subject to the terms of the mozilla public license, v. 2.0", "mpl-2"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]


def word_array(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def grams(words: str, wanted: list[int] | None = None) -> Column:
    """All runs of K words of an array column (those whose hash is ``wanted``, where given) as structs of their place, hash and words; empty if it is shorter."""
    word = lambda i: [F.get(F.col(words), i + j) for j in range(K)]
    at = lambda i: F.struct(i.alias("at"), F.xxhash64(*word(i)).alias("hash"), *[w.alias(f"w{j}") for j, w in enumerate(word(i))])
    places = F.sequence(F.lit(0), F.size(words) - K)
    if wanted is not None:
        places = F.filter(places, lambda i: F.xxhash64(*word(i)).isin(wanted))
    return F.when(F.size(words) >= K, F.transform(places, at)).otherwise(F.array().cast(GRAMS))


def templates(spark: SparkSession, phrases: list[tuple[str, str]] = PHRASES, notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """(hash, w0, w1, w2, template, label, base, length, place): each position of each template."""
    listed = [(p, label, True) for p, label in phrases] + [(p, label, False) for p, label in notices]
    rows = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(t).alias("text"), F.lit(label).alias("label"), F.lit(base).alias("base")) for i, (t, label, base) in enumerate(listed)])
    t = spark.range(1).select(F.inline(rows)).withColumn("words", word_array(F.col("text")))
    t = t.select("template", "label", "base", F.size("words").alias("length"), F.explode(grams("words")).alias("gram"))
    return t.select(F.col("gram.hash").alias("hash"), *[F.col(f"gram.w{j}").alias(f"w{j}") for j in range(K)], "template", "label", "base", "length", F.col("gram.at").alias("place"))


def hits(docs: DataFrame, known: DataFrame, id_col: str, text_col: str, broadcast: bool) -> DataFrame:
    """A row for each verified vote, and at least one for each document (template null).

    Grams are cut down to those whose hash stands in a template before they are exploded, and
    carry their own words only, so that work and bytes grow with a text's length.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), word_array(F.col(text_col).cast("string")).alias("words"))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))  # below the explosion, so that no exploded row carries the words
    wanted = None
    if broadcast:
        wanted = [r["hash"] for r in known.select("hash").distinct().collect()]  # at most BROADCAST_ROWS
        known = F.broadcast(known)
    listed = grams("words", wanted)
    found = rows.select("row", "doc_id", "n_words", F.explode_outer(F.concat(F.array(F.lit(None).cast(GRAM)), listed)).alias("gram"))
    # a document's own row has no place; its key is spread, so that no task of a shuffled join gets all of them
    flat = found.select("row", "doc_id", "n_words", "gram.at", F.coalesce("gram.hash", "row").alias("hash"), *[F.col(f"gram.w{j}").alias(f"g{j}") for j in range(K)])
    same = reduce(Column.__and__, [flat[f"g{j}"] == known[f"w{j}"] for j in range(K)])
    voted = flat.join(known, (flat["hash"] == known["hash"]) & same, "left").filter(F.col("at").isNull() | F.col("template").isNotNull())
    return voted.select("row", "doc_id", "n_words", "template", "label", "base", "length", "place", (F.col("at") - F.col("place")).cast("long").alias("diagonal")).repartition("row")


def spans(voted: DataFrame) -> DataFrame:
    """(row, doc_id, n_words, template, label, base, diagonals, covered, start, end): votes merged over neighbouring diagonals.

    ``covered`` is the share of the template's words under a vote; base phrases keep each diagonal apart.
    """
    keys = ["row", "doc_id", "n_words", "template", "label", "base", "length"]
    lines = voted.groupBy(*keys, "diagonal").agg(F.collect_set("place").alias("places"))
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    new = F.coalesce("base", F.lit(True)) | F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > GAP, F.lit(True))
    merged = lines.withColumn("group", F.sum(new.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = merged.groupBy(*keys, "group").agg(F.flatten(F.collect_list("places")).alias("places"), F.min("diagonal").alias("first"), F.max("diagonal").alias("last"))
    under = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + K - 1)))))
    return merged.select(*keys, "first", "last", F.when(F.col("template").isNull(), 0.0).otherwise(under / F.col("length")).alias("covered"), (F.col("first") + F.array_min("places")).alias("start"), (F.col("last") + F.array_max("places") + K).alias("end"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: DataFrame | None = None, *, coverage: float = COVERAGE) -> DataFrame:
    """One row for each row of ``docs``: n_words, n_base, first_word, last_word, base_labels, labels and score (best coverage)."""
    known = templates(docs.sparkSession) if known is None else known
    found = spans(hits(docs, known, id_col, text_col, known.count() <= BROADCAST_ROWS))
    exact = F.col("base") & (F.col("covered") == 1.0)
    verified = ~F.col("base") & (F.col("covered") >= coverage) & (F.col("length") >= SHORTEST)
    # verified spans that overlap are one place, at which the best counts
    row = Window.partitionBy("row").orderBy("start", "end", "template")
    reach = F.max(F.when(verified, F.col("end"))).over(row.rowsBetween(Window.unboundedPreceding, -1))
    found = found.withColumn("new", (verified & F.coalesce(F.col("start") >= reach, F.lit(True))).cast("int"))
    found = found.withColumn("spot", F.sum("new").over(row.rowsBetween(Window.unboundedPreceding, 0))).withColumn("worth", F.when(verified, F.struct(F.round(F.col("covered") * F.col("length")), F.col("covered"))))
    counts = F.coalesce(verified & (F.col("worth") == F.max("worth").over(Window.partitionBy("row", "spot"))), F.lit(False))
    found = found.withColumn("counts", counts)
    counts = F.col("counts")
    listed = lambda cond: F.array_join(F.array_sort(F.collect_set(F.when(cond, F.col("label")))), ",")
    return found.groupBy("row", "doc_id", "n_words").agg(
        F.count(F.when(exact, 1)).alias("n_base"), F.min(F.when(exact, F.col("first"))).alias("first_word"), F.max(F.when(exact, F.col("first"))).alias("last_word"),
        listed(exact).alias("base_labels"), listed(exact | counts).alias("labels"), F.coalesce(F.max(F.when(exact | counts, F.col("covered"))), F.lit(0.0)).alias("score"),
    ).drop("row")
