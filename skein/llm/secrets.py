"""Secret scans: fixed patterns, and character Markov models for what the patterns miss.

Two second-order Markov models over characters, one of random strings and one of ordinary
identifiers, are trained from labelled samples. A run of ``SHORTEST`` characters and more that the
patterns leave is a secret when its log-likelihood ratio, summed over its characters, reaches
``EVIDENCE``: the longer the run, the less each character must say. No other rule gates it. The sum
is taken over the run's best stretch (of that length at least), so that a key within a path of
ordinary words is found; the stretch is drawn out to the separators ``/`` and ``=``.
UUIDs are identifiers by their form, which no model of neighbouring characters can tell.
The models are one table of ratios, whatever the corpus.

Cases: null text counts as empty; an empty text has no spans; repeated rows give equal rows; an
empty table gives an empty result; very long texts and runs are scanned whole; of stretches with
equal ratios the first counts; other columns, also of the result's names, are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import bounded, sampled, steps, tokenizer_file

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
#: Every match of ASSIGN holds one of these in lower case.
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "api")
SHORTEST, EVIDENCE = 16, 14.0
#: Rounds in which a public vocabulary's words are put together; what one character may say for a secret at most.
VARIED, LOUDEST = 4, 2.5
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
UUID = re.compile(r"(?<![0-9a-fA-F])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9a-fA-F])")
KINDS = ("assign", "access", "hex", "markov")
#: Identifiers that hold for any corpus, beside those sampled from the texts.
IDENTIFIERS = """getElementById addEventListener background_color content_length max_value is_enabled
user_preferences transaction_history file_descriptor configuration application/json text/html
created_at updated_at source_file customer_address international responsibility characteristic
understanding administration DataFrameReader StringBuilder HttpServletRequest NullPointerException
left-right top-to-bottom state-of-the-art well-known example.com index.html version_number
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 xxxxxxxxxxxxxxxx XXXXXXXXXXXXXXXX
================ ---------------- ________________ ++++++++++++++++ ////////////////
page_count previous_month_average snake_case_identifier CamelCaseIdentifier""".split()


def _random_forms(n: Column) -> Column:
    """Random strings of number ``n``: hex, base64 of both alphabets, letters and digits of all, upper and lower case, letters only."""
    digest = F.sha2(n.cast("string"), 256)
    code = F.base64(F.concat(F.unhex(digest), F.unhex(F.sha2(F.concat(n.cast("string"), F.lit("x")), 256))))
    plain, length = F.regexp_replace(code, "[+/=]", ""), (F.lit(20) + n % 21).cast("int")
    forms = [digest, F.substring(code, 1, 44), plain, F.upper(plain), F.lower(plain), F.translate(code, "+/=", "-_"), F.regexp_replace(plain, "[0-9]", ""), digest]
    return F.left(F.element_at(F.array(*forms), (n % len(forms) + 1).cast("int")), length)


def _number_forms(n: Column) -> Column:
    """Ordinary strings with digits of number ``n``: dates, times, versions, addresses, file names, groups, repeated and counted digits."""
    day = F.date_add(F.lit("1995-01-01").cast("date"), (n * 7 % 12_000).cast("int"))
    s, two = lambda x: x.cast("string"), lambda x: F.lpad((x % 60).cast("string"), 2, "0")
    of = lambda fmt: F.date_format(day, fmt)
    clock = F.concat(two(n % 24), two(n * 11), two(n * 13))
    forms = [
        of("yyyy-MM-dd"), F.concat(of("yyyyMMdd"), F.lit("_"), clock), of("yyyy/MM/dd"), F.concat(F.lit("IMG_"), of("yyyyMMdd"), F.lit("_"), clock, F.lit("_edited")),
        F.concat(F.lit("v"), s(n % 20), F.lit("."), s(n % 13), F.lit("."), s(n % 7)), F.concat_ws(".", s(n % 256), s(n * 3 % 256), s(n * 5 % 256), s(n * 7 % 256)),
        F.repeat(s(n % 10), (F.lit(8) + n % 24).cast("int")), F.concat_ws("-", *[F.repeat(s((n + i) % 10), 4) for i in range(4)]), F.concat_ws("-", s(n % 900 + 100), s(n * 7 % 9000 + 1000), s(n * 13 % 9000 + 1000)),
        s(n * 1_000_003), s(n * 999_999_937 * 911), F.concat(F.lit("/"), of("yyyy/MM/dd"), F.lit("/page-"), s(n % 400)), F.concat(F.lit("report_"), of("yyyy"), F.lit("-Q"), s(n % 4 + 1), F.lit("_final")), F.concat(s(n % 90), F.lit("."), s(n * 104_729 % 1_000_000)),
        F.concat(of("dd-MM-yyyy"), F.lit("-"), s(n % 1000)), F.concat(F.lit("1.0.0-beta"), s(n % 30), F.lit("-build"), s(n % 5000)),
    ]
    return F.element_at(F.array(*forms), (n % len(forms) + 1).cast("int"))


def _word_forms(words: Column) -> Column:
    """Ordinary identifiers of neighbouring words: words, snake, kebab and camel case, constants, paths, files and settings, numbered and not."""

    def form(i: Column) -> Column:
        a, b, c = (F.get(words, i + k) for k in range(3))
        n = F.pmod(F.hash(a, b, c), F.lit(2100)).cast("string")
        capital = lambda x: F.concat(F.upper(F.left(x, F.lit(1))), F.substring(x, 2, 1000))
        forms = [
            a, F.concat_ws("_", a, b, c), F.concat(F.lit("/"), a, F.lit("/"), b, F.lit("-"), c), F.concat(F.lower(a), capital(b), capital(c)), F.concat_ws("-", a, b, c, n), F.concat(a, F.lit("_"), n),
            F.concat(F.upper(a), F.lit("_"), F.upper(b)), F.concat(a, F.lit("="), b), F.concat(F.lit("/"), a, F.lit("/"), n, F.lit("/"), b, F.lit("-"), c, F.lit(".html")), F.concat(capital(a), capital(b), n),
        ]
        return F.element_at(F.array(*forms), F.pmod(F.hash(a, b), F.lit(len(forms))) + 1)

    return F.when(F.size(words) > 2, F.transform(F.sequence(F.lit(0), F.size(words) - 3), form)).otherwise(words)


def labelled_samples(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", *, vocabulary: list[str] = (), n_random: int = 20_000, n_docs: int = 2_000, max_chars: int = 20_000) -> DataFrame:
    """(text, label): 1 for random strings, 0 for ordinary identifiers, each once.

    Random strings are forms of the digests of 1..n_random. Identifiers are built of the letter
    words (4 characters and more) of about ``n_docs`` documents of at most ``max_chars`` characters, chosen
    by hash, and of a public vocabulary; of as many numbers; and of a fixed list. ``n_docs`` bounds
    the sample at any corpus size.
    """
    spark = docs.sparkSession
    random = spark.range(1, n_random + 1).select(_random_forms(F.col("id")).alias("text"), F.lit(1).alias("label"))
    rate = min(1.0, n_docs / max(1, docs.count()))
    picked = docs.filter((F.length(text_col) <= max_chars) & sampled(id_col, rate))
    words = picked.select(F.regexp_extract_all(F.col(text_col), F.lit(r"\b[A-Za-z]{4,}\b"), F.lit(0)).alias("w")).select(F.explode(_word_forms(F.col("w"))).alias("text"))
    public = [w for w in vocabulary if re.fullmatch("[A-Za-z]{4,}", w)]
    once = spark.createDataFrame([(public,)] if public else [], "w array<string>").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(VARIED - 1))))
    beside = F.transform("w", lambda _, i: F.get("w", (F.col("k") * 7919 + i * (2 * F.col("k") + 1)) % max(1, len(public))))  # each word beside others
    public_words = once.select(beside.alias("w")).select(F.explode(_word_forms(F.col("w"))).alias("text"))
    words = words.distinct().unionByName(public_words)
    numbers = spark.range(1, n_random + 1).select(_number_forms(F.col("id")).alias("text"))
    listed = spark.createDataFrame([(x,) for x in IDENTIFIERS], "text string")
    return random.unionByName(words.unionByName(numbers).unionByName(listed).select("text", F.lit(0).alias("label")))


def train_markov(samples: DataFrame, backoff: float = 30.0) -> np.ndarray:
    """Log-likelihood ratios of each character after each two (place 0: before the start), from labelled samples.

    Each order backs off to the one below it, and the lowest to equal chances, so that a small
    sample still tells letters from digits. Tasks count triples of characters in arrays; at most
    2 * 69 * 69 * 68 of them reach the driver.
    """
    n = len(ALPHABET)
    place = np.full(129, -1)  # 0 stands before a text, and for a space
    place[ord(" ")] = 0
    for i, c in enumerate(ALPHABET):
        place[ord(c)] = i + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(2 * (n + 1) * (n + 1) * n, np.int64)
        for b in batches:
            labels = b.column("label").to_numpy(zero_copy_only=False)
            for label in (0, 1):
                some = b.column("text").filter(pa.array(labels == label)).to_pylist()
                at = place[np.minimum(np.frombuffer("\n".join("  " + t for t in some if t).encode("utf-32-le"), np.uint32), 128)]
                x, y, z = at[:-2], at[1:-1], at[2:]
                ok = (x >= 0) & (y >= 0) & (z > 0)
                np.add.at(sums, ((label * (n + 1) + x[ok]) * (n + 1) + y[ok]) * n + z[ok] - 1, 1)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], ["at", "n"])

    found = samples.select("label", "text").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(2 * (n + 1) * (n + 1) * n)
    counts[found.column("at").to_numpy()] = found.column("n").to_numpy()
    counts = counts.reshape(2, n + 1, n + 1, n)
    p = np.full((2, 1, 1, n), 1 / n)
    for own in (counts.sum(axis=(1, 2), keepdims=True), counts.sum(axis=1, keepdims=True), counts):
        p = (own + backoff * p) / (own.sum(axis=3, keepdims=True) + backoff)
    return np.minimum(np.log(p[1]) - np.log(p[0]), LOUDEST).astype(np.float32)


class Scanner:
    """Finds spans in one text. ``evidence`` is the log-likelihood ratio that a secret reaches."""

    def __init__(self, ratios: np.ndarray, evidence: float = EVIDENCE, shortest: int = SHORTEST):
        self.ratios, self.evidence, self.shortest = ratios, evidence, shortest
        self.codes = np.zeros(128, np.int64)
        for i, c in enumerate(ALPHABET):
            self.codes[ord(c)] = i

    def steps(self, token: str) -> np.ndarray:
        """The ratio of each character of a token."""
        c = self.codes[np.frombuffer(token.encode("ascii"), np.uint8)]
        before = np.concatenate([[0, 0], c + 1])
        return self.ratios[before[:-2], before[1:-1], c]

    def ratio(self, token: str) -> float:
        return float(self.steps(token).sum())

    def secrets(self, token: str) -> list[tuple[int, int]]:
        """Ranges of a token that reach the evidence: its best stretch, and those of what is left on both sides."""
        out, todo = [], [(0, len(token))]
        while todo:
            a, b = todo.pop()
            if b - a < self.shortest:
                continue
            total = np.append(0.0, np.cumsum(self.steps(token[a:b]), dtype=np.float64))
            least = np.minimum.accumulate(total[: b - a - self.shortest + 1])  # of the starts that leave room
            gain = total[self.shortest :] - least
            k = int(gain.argmax())
            if gain[k] < self.evidence:
                continue
            s, e = a + int(np.flatnonzero(total[: k + 1] == least[k])[0]), a + k + self.shortest
            while s > a and token[s - 1] not in "/=":
                s -= 1
            while e < b and token[e] not in "/=":
                e += 1
            out.append((s, e))
            todo += [(a, s), (e, b)]
        return sorted(out)

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind's place in KINDS, end), sorted; patterns first, model spans only where no pattern stands."""
        found = []
        low = text.lower()
        if any(x in low for x in ASSIGN_HINTS):
            found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
        runs = list(RUN.finditer(text))
        for m in runs:  # AKIA... and hex runs consist of RUN's characters, so each lies in one run
            found += [(x.start(), 1, x.end()) for x in ACCESS.finditer(text, m.start(), m.end())]
            found += [(x.start(), 2, x.end()) for x in HEX.finditer(text, m.start(), m.end())]
        taken = sorted((s, e) for s, _, e in found)
        model, i = [], 0
        for m in runs:
            while i < len(taken) and taken[i][1] <= m.start():
                i += 1
            j = i
            while j < len(taken) and taken[j][0] < m.end():
                j += 1
            own, at = taken[i:j], m.start()
            for s, e in sorted([*own, *(x.span() for x in UUID.finditer(text, m.start(), m.end())), (m.end(), m.end())]):
                if s - at >= self.shortest:
                    model += [(at + a, 3, at + b) for a, b in self.secrets(text[at:s])]
                at = max(at, e)
        return sorted(found + model)


def scan(docs: DataFrame, ratios: np.ndarray, id_col: str = "doc_id", text_col: str = "text", *, evidence: float = EVIDENCE, shortest: int = SHORTEST) -> DataFrame:
    """doc_id and its spans (kind, start, end in code points, end exclusive), for every row of ``docs``."""
    scanner = Scanner(ratios, evidence, shortest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in steps(batches, "text"):
            out = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scanner.spans(t or "")] for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, kind)], ["doc_id", "spans"])

    rows = bounded(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def digests(scanned: DataFrame) -> DataFrame:
    """The contract's columns from scanned spans."""
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return scanned.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "markov")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"), count("markov"),
    )


def trained(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", *, tokenizer: str | None = None) -> np.ndarray:
    """The models' ratios, with the words of a tokenizer file's vocabulary where one is given."""
    return train_markov(labelled_samples(docs, text_col, id_col, vocabulary=public_words(tokenizer) if tokenizer else []))


def public_words(tokenizer: str) -> list[str]:
    """The words of a byte-level vocabulary's file, in order."""
    with open(tokenizer_file(tokenizer), encoding="utf-8") as f:
        pieces = json.load(f)["model"]["vocab"]
    return sorted({p.lstrip("Ġ") for p in pieces})


def redact(docs: DataFrame, ratios: np.ndarray, text_col: str = "text", mark: str = "[secret]", *, evidence: float = EVIDENCE, shortest: int = SHORTEST) -> DataFrame:
    """``docs`` with every span in ``text_col`` replaced; all columns, names and types stay; null text stays null."""
    scanner, at, schema = Scanner(ratios, evidence, shortest), docs.columns.index(text_col), docs.schema

    def clean(text: str | None) -> str | None:
        if text is None:
            return None
        out, pos = [], 0
        for s, _, e in scanner.spans(text):
            if s >= pos:
                out += [text[pos:s], mark]
            pos = max(pos, e)
        return "".join([*out, text[pos:]]) if out else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = pa.array([clean(t) for t in b.column(at).to_pylist()], b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([new if i == at else b.column(i) for i in range(b.num_columns)], schema=b.schema)

    return bounded(docs).mapInArrow(run, schema)
