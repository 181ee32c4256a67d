"""How the sources of a language differ in their terms: exact sums of absolute differences by inclusion-exclusion.

A group is a language and a source. Every group gives each kept term of its language a smoothed share of a
thousand million, whether the term occurs or not. The difference of two groups, summed over all kept terms, is put together without
a row for each group and absent term:

* terms of one group are priced against the other's share of absent terms. Each group's shares are a histogram (terms by
  share); sorted with the other groups' absent shares, running sums price all of them in one window;
* terms of both groups come by a join of the sparse postings, which takes both one-sided prices back and adds the true one;
* all others differ by the constant |absent share - absent share|, counted as kept - support - support, and given back
  for the terms of both.

All arithmetic is on longs: the share's division goes in three steps of a thousand, so totals up to 9e15 fit.

Cases: null text, language and source read as ''; a group without terms, or with none kept, still counts; a language
without kept terms has differences of 0 and no term rows; a language with one source has no pairs; texts
are read whole; repeated rows count each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import _table, bounded, materialize, spread_join, steps, words

#: Documents of its language that a kept term stands in, at least; added to each count; ranks of the term rows.
LEAST, SMOOTHED, RANKS = 30, 5, 50
LETTERS = _table(lambda b: b >= 0x80 or chr(b).isalpha())


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents) of every group; a row without a term for the group itself."""
    texts = bounded(docs).select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "text"):
            langs, sources = (part.column(c).dictionary_encode() for c in ("lang", "source"))
            both = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
            groups, group = np.unique(both, return_inverse=True)
            ends, found = words(part.column("text"), LETTERS)
            terms = found.dictionary_encode()
            code, many = terms.indices.to_numpy().astype(np.int64), max(len(terms.dictionary), 1)
            doc = np.repeat(np.arange(part.num_rows), np.diff(ends))
            pairs, n = np.unique(group[doc] * many + code, return_counts=True)
            once = np.unique(doc * many + code)
            _, in_docs = np.unique(group[once // many] * many + once % many, return_counts=True)
            of = np.concatenate([groups[pairs // many], groups])
            term = pa.concat_arrays([terms.dictionary.take(pa.array(pairs % many)).cast(pa.string()), pa.nulls(len(groups), pa.string())])
            zeros = np.zeros(len(groups), np.int64)
            columns = [langs.dictionary.take(pa.array(of // len(sources.dictionary))), sources.dictionary.take(pa.array(of % len(sources.dictionary))), term, pa.array(np.concatenate([n, zeros])), pa.array(np.concatenate([in_docs, zeros]))]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

    rows = texts.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(1000000000 (count + 5) / (total + 5 kept)), exactly, in longs; null without kept terms."""
    whole = F.nullif(total + kept * SMOOTHED, F.lit(0).cast("long"))
    left, out = count + SMOOTHED, F.lit(0).cast("long")
    for _ in range(3):
        left = left * 1000
        out = out * 1000 + F.call_function("div", left, whole)
        left = F.pmod(left, whole)
    return out + 1


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", *, least: int = LEAST, ranks: int = RANKS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank."""
    counts = materialize(term_counts(docs, text_col, lang_col, source_col), "terms")
    kept = counts.filter(F.col("term").isNotNull()).groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= least).drop("docs")
    postings = materialize(counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "postings")

    # a row for each language, and for each group
    langs = postings.groupBy("lang", "term").agg(F.first("all_n").alias("all_n")).groupBy("lang").agg(F.count("*").alias("kept"), F.sum("all_n").alias("lang_total"))
    own = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("support"))
    groups = counts.filter(F.col("term").isNull()).select("lang", "source").join(own, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
    groups = materialize(groups.withColumn("absent", share(F.lit(0).cast("long"), F.col("total"), F.col("kept"))), "groups")

    by_group = groups.select(F.struct("lang", "source").alias("grp"), "total", "kept", "lang_total", "absent")
    priced = spread_join(postings.withColumn("grp", F.struct("lang", "source")), by_group, "grp", F.col("term"))
    priced = materialize(priced.select("lang", "source", "term", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), share(F.col("all_n"), F.col("lang_total"), F.col("kept")).alias("q"), "absent"), "shares")

    top = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    term_rows = priced.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    term_rows = term_rows.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= ranks)

    other = groups.select("lang", F.col("source").alias("other"), F.col("support").alias("other_support"), F.col("absent").alias("other_absent"))
    asked = groups.join(other, "lang").filter(F.col("source") != F.col("other"))  # the pairs that the result lists
    neither = asked.select("lang", "source", "other", F.coalesce(F.abs(F.col("absent") - F.col("other_absent")) * (F.col("kept") - F.col("support") - F.col("other_support")), F.lit(0)).alias("value"))
    points = priced.groupBy("lang", "source", "p").agg(F.count("*").alias("h")).select("lang", "source", F.lit(None).cast("string").alias("other"), F.col("p").alias("at"), "h")
    points = points.unionByName(asked.filter("other_absent IS NOT NULL").select("lang", "source", "other", F.col("other_absent").alias("at"), F.lit(0).cast("long").alias("h")))
    group = Window.partitionBy("lang", "source")
    upto, over = group.orderBy("at").rangeBetween(Window.unboundedPreceding, 0), lambda x, w: F.sum(x).over(w)
    mass = F.col("h") * F.col("at")
    sums = points.select("lang", "source", "other", "at", over(F.col("h"), upto).alias("c"), over(mass, upto).alias("s"), over(F.col("h"), group).alias("all_c"), over(mass, group).alias("all_s")).filter("other IS NOT NULL")
    one = sums.select("lang", "source", "other", (F.col("at") * (2 * F.col("c") - F.col("all_c")) + F.col("all_s") - 2 * F.col("s")).alias("value"))
    left, right = priced.select("lang", "term", "source", "p", "absent"), priced.select("lang", "term", F.col("source").alias("other"), F.col("p").alias("r"), F.col("absent").alias("s"))
    gap = lambda a, b: F.abs(F.col(a) - F.col(b))
    shared = left.join(right, ["lang", "term"]).filter(F.col("source") < F.col("other")).groupBy("lang", "source", "other").agg(F.sum(gap("p", "r") - gap("p", "s") - gap("absent", "r") + gap("absent", "s")).alias("value"))
    turned = lambda d: d.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value")
    sides = neither.unionByName(one).unionByName(turned(one)).unionByName(shared).unionByName(turned(shared))
    pair_rows = sides.groupBy("lang", "source", F.col("other").alias("item")).agg(F.sum("value").alias("value")).select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(top))
    return pair_rows.unionByName(term_rows).select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))
