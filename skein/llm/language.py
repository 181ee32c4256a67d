"""Language identification by Bayesian evidence fusion.

Four kinds of evidence are fused in log space for each text:

* the text: a multinomial model over hashed byte trigrams for each language, tempered so that a
  text counts as at most ``EVIDENCE`` independent trigrams;
* the declared language (markup or a column): right with probability ``DECLARED``;
* the address suffix (a path part that names a language, else the host's country, whose languages
  share the claim): right with probability ``SUFFIX``;
* the host: its languages by the text evidence of its other texts, smoothed towards its domain's
  other texts, and those towards all others. A text never counts for itself. The counts come from
  grouped aggregations; hosts are rows of a table, never collected.

Labels and declarations are compared by their primary subtag (``en`` for ``en-US`` and ``EN_gb``); other labels
stand for themselves. The trigram model is fitted on a bounded sample of labelled rows: about
``n_docs`` documents a language, of ``max_chars`` characters at most, chosen by hash. Languages are taken in
blocks of ``MOST``, each with ``2**BITS`` cells a language, so that no broadcast grows with the data or
the number of labels (the driver holds 256 KB for each); with more than one block, texts are written
once and read for each block.

Cases: null or empty texts, and texts without letters, have language null and are not kept;
unknown or null declarations, suffixes and hosts say nothing; equally likely languages go by name;
repeated rows get equal results and each counts for the others of its host; very long texts are
read whole; an empty table gives an empty result; extra columns, also of the result's names, are
not read; without any labelled language nothing can be judged, so all rows are kept without a language.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import bounded, buffers, materialize, sampled, spread_join, steps

BITS, MOST, EVIDENCE = 16, 64, 20.0
#: Text bytes scored at once (some fifty bytes of numbers for each); a longer text is a step of its own.
SCORED = 1 << 20
DECLARED, SUFFIX, HOST_WEIGHT, DOMAIN_WEIGHT = 0.9, 0.8, 5.0, 20.0
#: Counts of hosts by language that may be broadcast (some 40 bytes each).
BROADCAST_COUNTS = 500_000
#: Languages of countries by their domain suffix.
COUNTRIES = {
    "ar": ["es"], "at": ["de"], "au": ["en"], "be": ["nl", "fr"], "bg": ["bg"], "br": ["pt"], "ca": ["en", "fr"], "ch": ["de", "fr", "it"], "cl": ["es"], "cn": ["zh"], "co": ["es"], "cz": ["cs"], "de": ["de"], "dk": ["da"],
    "ee": ["et"], "es": ["es"], "fi": ["fi"], "fr": ["fr"], "gr": ["el"], "hk": ["zh", "en"], "hr": ["hr"], "hu": ["hu"], "id": ["id"], "ie": ["en"], "il": ["he"], "in": ["en", "hi"], "ir": ["fa"], "is": ["is"], "it": ["it"],
    "jp": ["ja"], "kr": ["ko"], "li": ["de"], "lt": ["lt"], "lu": ["fr", "de"], "lv": ["lv"], "mx": ["es"], "my": ["ms", "en"], "nl": ["nl"], "no": ["no"], "nz": ["en"], "pe": ["es"], "pl": ["pl"], "pt": ["pt"], "ro": ["ro"], "rs": ["sr"],
    "ru": ["ru"], "se": ["sv"], "si": ["sl"], "sk": ["sk"], "th": ["th"], "tr": ["tr"], "tw": ["zh"], "ua": ["uk", "ru"], "uk": ["en"], "us": ["en", "es"], "uy": ["es"], "ve": ["es"], "vn": ["vi"], "za": ["en", "af"],
}
#: Codes that stand for other things in paths; they count with a region only.
UNSURE = ["am", "as", "be", "ca", "id", "in", "is", "me", "my", "no", "or", "so", "to", "uk", "us"]
#: Mean log-likelihood gain of a trigram over random bytes below which a text is in none of the languages.
LEAST_GAIN = 0.0
TAGS = re.compile(r"<(script|style)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[^>]*(?:>|\Z)", re.S | re.I)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: ASCII bytes that are not letters count as one space.
LOWER[[b for b in range(128) if not chr(b).isalpha()]] = 32


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all byte trigrams that are not blank, and how many come before each text's end (from 0)."""
    off, raw = buffers(texts)
    raw = LOWER[raw]
    if len(raw) < 3:
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    a, b, c = (raw[i : len(raw) - 2 + i].astype(np.uint32) for i in range(3))
    code = ((a << np.uint32(16)) | (b << np.uint32(8)) | c) * np.uint32(2654435769) >> np.uint32(32 - BITS)
    ok = ~((b == 32) & ((a == 32) | (c == 32)))
    ends = off[1:-1]
    for k in (2, 1):  # trigrams over the edge of two texts
        over = ends - k
        ok[over[(over >= 0) & (over < len(ok))]] = False
    place = np.zeros(len(ok) + 1, np.int64)
    np.cumsum(ok, out=place[1:])
    return code[ok].astype(np.int64), place[np.minimum(off, len(ok))]


class Model:
    """Languages and, for each cell, their log-likelihood gains over equally likely cells."""

    def __init__(self, languages: list[str], gain: np.ndarray):
        self.languages, self.gain = languages, gain

    def scores(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Mean gain of each text's trigrams for each language, and the number of trigrams."""
        code, at = grams(texts)
        n = np.diff(at)
        out = np.zeros((len(texts), len(self.languages)))
        for j in range(len(self.languages)):
            total = np.zeros(len(code) + 1)
            np.cumsum(self.gain[j][code], out=total[1:])
            out[:, j] = np.diff(total[at]) / np.maximum(n, 1)
        return out, n


def primary(label: Column) -> Column:
    """The language of a label: its primary subtag, else the label itself in lower case; null if blank."""
    c = F.lower(F.trim(label.cast("string")))
    return F.nullif(F.coalesce(F.nullif(F.regexp_extract(c, "^([a-z]{2,3})(?:[-_].*)?$", 1), F.lit("")), c), F.lit(""))


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id", *, n_docs: int = 2_000, max_chars: int = 20_000, smoothing: float = 0.2) -> Model:
    """Fits the trigram model on a sample, bounded by ``n_docs`` documents a language (in expectation)."""
    rows = bounded(labelled).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), primary(F.col(label_col)).alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row for each language
    languages = sorted(sizes)
    gain = [np.zeros((0, 1 << BITS), np.float32)]
    for start in range(0, len(languages), MOST):
        gain.append(_fitted(rows, {x: sizes[x] for x in languages[start : start + MOST]}, n_docs, max_chars, smoothing))
    return Model(languages, np.concatenate(gain))


def _fitted(rows: DataFrame, sizes: dict[str, int], n_docs: int, max_chars: int, smoothing: float) -> np.ndarray:
    """The gains of a block of languages."""
    place = {x: k for k, x in enumerate(sizes)}
    rate = F.element_at(F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, n_docs / n)))]), F.col("lang"))
    picked = rows.filter(F.col("lang").isin(list(sizes))).filter((F.length("text") <= max_chars) & sampled("id", rate))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(place), 1 << BITS), np.int32)
        for b in steps(batches, "text", SCORED):
            code, at = grams(b.column("text"))
            for i, lang in enumerate(b.column("lang").to_pylist()):
                total[place[lang]] += np.bincount(code[at[i] : at[i + 1]], minlength=1 << BITS).astype(np.int32)
        k, cell = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(cell), pa.array(total[k, cell].astype(np.int64))], ["k", "cell", "n"])

    found = picked.mapInArrow(count, "k long, cell long, n long").groupBy("k", "cell").agg(F.sum("n").alias("n")).toArrow()  # at most MOST * 2**BITS
    total = np.zeros((len(place), 1 << BITS))
    total[found.column("k").to_numpy(), found.column("cell").to_numpy()] = found.column("n").to_numpy()
    p = (total + smoothing) / (total + smoothing).sum(axis=1, keepdims=True)
    return (np.log(p) + np.log(1 << BITS)).astype(np.float32)


def address(url):
    """host and domain of an address column."""
    host = F.nullif(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit(""))
    return host, F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit(""))


def _gains(picked: DataFrame, model: Model, markup: bool) -> DataFrame:
    """``picked`` with each text's mean gain for each language and its number of trigrams in place of the text."""
    meta = ["id", "host", "domain", "declared", "suffix"]
    kinds = "id long, host string, domain string, declared string, suffix array<string>, gain array<double>, n long"
    starts = range(0, max(1, len(model.languages)), MOST)
    blocks = [Model(model.languages[k : k + MOST], model.gain[k : k + MOST]) for k in starts]

    def scored(rows: DataFrame, block: Model, more: list[str]) -> DataFrame:
        shared = rows.sparkSession.sparkContext.broadcast(block)  # MOST languages of 2**BITS cells

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in steps(batches, "text", SCORED):
                texts = b.column("text").fill_null("")
                if markup:
                    texts = pa.array([html.unescape(TAGS.sub(" ", t)) for t in texts.to_pylist()], pa.string())
                gain, n = shared.value.scores(texts)
                yield pa.RecordBatch.from_arrays([b.column(c) for c in more] + [pa.array(list(gain), pa.list_(pa.float64())), pa.array(n)], [*more, "gain", "n"])

        return rows.mapInArrow(read, kinds if more == meta else "row long, gain array<double>, n long")

    if len(blocks) == 1:
        return scored(picked, blocks[0], meta)
    numbered = materialize(picked.withColumn("row", F.monotonically_increasing_id()), "texts")
    parts = reduce(DataFrame.unionByName, [scored(numbered.select("row", "text"), b, ["row"]).withColumn("block", F.lit(k)) for k, b in enumerate(blocks)])
    gains = parts.groupBy("row").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("block", "gain"))), lambda x: x["gain"])).alias("gain"), F.max("n").alias("n"))
    return numbered.drop("text").join(gains, "row").select(*meta, "gain", "n")


def _tally(counts: DataFrame, *keys: str) -> DataFrame:
    """Counts by language (from 1) of each group as a map, and their total."""
    summed = counts.groupBy(*keys, "best").agg(F.sum("n").alias("n"))
    return summed.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("best", "n"))).alias("own"), F.sum("n").alias("total"))


def identify(
    rows: DataFrame, model: Model, id_col: str, text_col: str, *, declared_col: str | None = None, url_col: str | None = None, host_col: str | None = None,
    markup: bool = False, least_gain: float = LEAST_GAIN,
) -> DataFrame:
    """doc id, language, posterior probability, mean gain and kept, for every row of ``rows``.

    ``markup``: the text is html; its tags are dropped and its lang attribute is the declaration.
    ``host_col`` names the host where there is no address. Returns the id as ``id``.
    """
    languages, none = model.languages, F.lit(None).cast("string")
    url = F.col(url_col).cast("string") if url_col else none
    host, domain = address(url)
    if host_col:
        host, domain = F.col(host_col).cast("string"), none
    path = r"^[a-zA-Z]+://[^/]+/([a-z]{2})([-_][a-zA-Z]+)?(?:/|$)"
    code, region = F.nullif(F.regexp_extract(url, path, 1), F.lit("")), F.regexp_extract(url, path, 2)
    spoken = F.create_map(*[x for c, own in COUNTRIES.items() for x in (F.lit(c), F.array(*map(F.lit, own)))])
    suffix = F.coalesce(F.when(code.isNotNull() & (~code.isin(UNSURE) | (region != "")), F.array(code)), F.try_element_at(spoken, F.nullif(F.regexp_extract(host, r"\.([a-z]{2})$", 1), F.lit(""))))
    said = F.col(declared_col).cast("string") if declared_col else none
    if markup:
        said = F.coalesce(said, F.nullif(F.regexp_extract(F.col(text_col), r"""(?i)<html\b[^>]*\blang\s*=\s*["']?([a-zA-Z]{2,3}(?:[-_][a-zA-Z0-9]+)*)""", 1), F.lit("")))
    picked = bounded(rows).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), host.alias("host"), domain.alias("domain"), primary(said).alias("declared"), suffix.alias("suffix"))
    scored = materialize(_gains(picked, model, markup), "gains")
    k = len(languages)
    if not k:
        return scored.select("id", none.alias("language"), F.lit(0.0).alias("probability"), F.lit(0.0).alias("gain"), F.lit(True).alias("kept"))
    names = F.array(*[F.lit(x) for x in languages])
    # counts by language of hosts, domains and everything
    scored = scored.withColumn("best", F.when(F.col("n") > 0, F.array_position("gain", F.array_max("gain")).cast("int")))
    counts = materialize(scored.filter("best IS NOT NULL").groupBy("host", "domain", "best").agg(F.count("*").alias("n")), "counts")
    every = {r["best"]: r["n"] for r in counts.groupBy("best").agg(F.sum("n").alias("n")).collect()}  # a row for each language
    domains = _tally(counts.filter("domain IS NOT NULL"), "domain").withColumnsRenamed({"own": "of_domain", "total": "in_domain"})
    hosts = _tally(counts.filter("host IS NOT NULL"), "host", "domain").withColumnsRenamed({"own": "of_host", "total": "in_host"})
    most = BROADCAST_COUNTS if counts.count() <= BROADCAST_COUNTS else 0
    hosts = spread_join(hosts, domains, "domain", F.col("host"), most=most).drop("domain")  # a host has one domain
    fused = spread_join(scored, hosts, "host", F.col("id"), most=most)
    # each level without the row itself, smoothed towards the one above
    place = F.sequence(F.lit(1), F.lit(k))
    of = lambda m, i: F.coalesce(F.try_element_at(m, i), F.lit(0)) - (i == F.col("best")).cast("int")
    overall = F.array(*[F.lit(every.get(i + 1, 0)) for i in range(k)])
    p_all = F.transform(place, lambda i: (F.element_at(overall, i) - (i == F.col("best")).cast("int") + 1.0) / (sum(every.values()) - 1.0 + k))
    fused = fused.filter("best IS NOT NULL").withColumn("prior", p_all)
    for level, weight in (("domain", DOMAIN_WEIGHT), ("host", HOST_WEIGHT)):
        smooth = F.transform(place, lambda i: (of(F.col(f"of_{level}"), i) + weight * F.element_at("prior", i)) / (F.col(f"in_{level}") - 1.0 + weight))  # noqa: B023
        fused = fused.withColumn("prior", F.when(F.col(f"of_{level}").isNull(), F.col("prior")).otherwise(smooth))
    weight = F.least(F.col("n").cast("double"), F.lit(EVIDENCE))

    def claim(of: Column, right: float) -> Column:
        """Log evidence of a claim for the languages ``of``, which share it; null or unknown ones say nothing."""
        known = F.array_intersect(F.coalesce(of, F.array().cast("array<string>")), names)
        m = F.size(known)
        said = F.transform(names, lambda x: F.when(F.array_contains(known, x), F.log(F.lit(right) / F.greatest(m, F.lit(1)))).otherwise(F.log(F.lit(1 - right) / F.greatest(F.lit(k) - m, F.lit(1)))))
        return F.when(m == 0, F.array_repeat(F.lit(0.0), k)).otherwise(said)

    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    evidence = [F.transform("gain", lambda g: g * weight), F.transform("prior", lambda p: F.log(p)), claim(F.array("declared"), DECLARED), claim(F.col("suffix"), SUFFIX)]
    fused = fused.withColumn("post", reduce(add, evidence))
    top = F.array_max("post")
    place = F.array_position("post", top).cast("int")
    gain = F.element_at("gain", place)
    judged = fused.select(
        "id", F.element_at(names, place).alias("language"), (1.0 / F.aggregate("post", F.lit(0.0), lambda a, x: a + F.exp(x - top))).alias("probability"), gain.alias("gain"), (gain >= least_gain).alias("kept"),
    )
    blank = scored.filter("best IS NULL").select("id", none.alias("language"), F.lit(0.0).alias("probability"), F.lit(0.0).alias("gain"), F.lit(False).alias("kept"))
    return judged.unionByName(blank)
