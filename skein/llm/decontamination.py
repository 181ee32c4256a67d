"""Benchmark decontamination: a prefix-filtered set join with exact verification.

Every window of ``window`` consecutive item words (a shorter item is one window) is a set of word
shingles that must all occur for the window to occur. For containment of the whole set, one
prefix token is necessary and enough: the window's rarest shingle, by its count over all
documents. Documents' shingles are joined with these prefix tokens only; positional and length
bounds (the window must fit into the document where the shingle stands) drop further candidates;
what is left is compared word by word, each word by a 64-bit hash of its bytes.

Up to ``BLOCK`` windows are the broadcast side, and documents are never shuffled. A larger benchmark is
joined by shuffle, with as many passes over the documents: a bitmap of at most ``BITMAP`` bytes keeps
most of the documents' shingles from moving, the tokens are chosen by grouped aggregation, and a
candidate carries the hashes of the words around it. Tokens that many documents hold are broadcast.

Cases: null or empty texts have no words and no hits; repeated rows are documents of their own;
items without words have no window, and an item without an id is not looked for; an item that
repeats is one item; equally rare shingles go by hash; very long texts are read whole; an empty
benchmark marks nothing and an empty table gives an empty result; other columns, also of the
result's names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import ALNUM, bounded, hashes, materialize, mixed, rolled, steps, with_sums, words

BLOCK, BITMAP = 200_000, 16 << 20
SHINGLE = 3
WINDOW = 10


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(item_id, key, hashes): the distinct windows of each item as its words' hashes; ``key`` hashes them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, "text"):
            off, tokens = words(b.column("text"), ALNUM)
            h, ids = hashes(tokens), b.column("item_id").to_pylist()
            out: dict[tuple, tuple] = {}
            for i, item in enumerate(ids):
                own = h[off[i] : off[i + 1]]
                size = min(window, len(own))
                for k in range(len(own) - size + 1 if size else 0):
                    w = own[k : k + size]
                    key = int(rolled(w, size).view(np.int64)[0])
                    out[item, key] = (item, key, w.view(np.int64).tolist())
            rows = list(out.values())
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.list_(pa.int64()))], ["item_id", "key", "hashes"])

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).filter("item_id IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(run, "item_id long, key long, hashes array<long>")


class Windows:
    """A block of windows: their words' hashes, items, and the shingles that they consist of."""

    def __init__(self, rows: list):
        of: dict[tuple, set] = {}
        for r in rows:
            of.setdefault(tuple(r["hashes"]), set()).add(r["item_id"])
        self.windows = [np.array(w, np.int64).view(np.uint64) for w in of]
        self.items = [sorted(x) for x in of.values()]
        self.parts = [rolled(w, min(SHINGLE, len(w))) for w in self.windows]
        self.size = np.array([len(w) for w in self.windows], np.int64)
        self.kinds = sorted({min(SHINGLE, len(w)) for w in self.windows})
        self.shingles = np.unique(np.concatenate([salted(p, min(SHINGLE, len(w))) for p, w in zip(self.parts, self.windows, strict=True)])) if self.windows else np.zeros(0, np.uint64)

    def order(self, counts: np.ndarray) -> None:
        """Picks each window's prefix token by the shingles' document counts; ties by hash."""
        token, place = [], []
        for p, n in zip(self.parts, self.size.tolist(), strict=True):
            s = salted(p, min(SHINGLE, n))
            k = int(np.lexsort((s, counts[np.searchsorted(self.shingles, s)]))[0])
            token.append(s[k])
            place.append(k)
        by = np.argsort(np.array(token, np.uint64), kind="stable")
        self.token = np.array(token, np.uint64)[by]
        self.place, self.window = np.array(place, np.int64)[by], by
        width = int(self.size.max(initial=1))
        self.matrix = np.zeros((len(self.windows), width), np.uint64)
        for i, w in enumerate(self.windows):
            self.matrix[i, : len(w)] = w


def salted(h: np.ndarray, k: int) -> np.ndarray:
    """Keeps shingles of other lengths apart."""
    return mixed(h ^ np.uint64(k * 0x51ED27))


class Matcher:
    """Positions of known hashes among many: a bitmap first, then binary search."""

    def __init__(self, known: np.ndarray):
        self.known = known
        self.bits = max(16, int(np.ceil(np.log2(max(1, len(known)) * 16))))
        self.map = np.zeros(1 << self.bits, bool)
        self.map[known >> np.uint64(64 - self.bits)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in h, places in known) of the hashes that are known; the first place if known repeats."""
        at = np.flatnonzero(self.map[h >> np.uint64(64 - self.bits)])
        k = np.searchsorted(self.known, h[at])
        k[k == len(self.known)] = 0
        ok = self.known[k] == h[at] if len(self.known) else np.zeros(len(at), bool)
        return at[ok], k[ok]


def shingle_counts(docs: DataFrame, block: Windows) -> np.ndarray:
    """How many times each of the block's shingles occurs in all documents; counts are summed in the tasks first."""
    known, kinds = docs.sparkSession.sparkContext.broadcast(block.shingles), block.kinds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(known.value)
        total = np.zeros(len(known.value), np.int64)
        for b in steps(batches, "text"):
            h = hashes(words(b.column("text"), ALNUM)[1])
            for k in kinds:
                total += np.bincount(matcher.find(salted(rolled(h, k), k))[1], minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["shingle", "n"])

    out = np.zeros(len(block.shingles), np.int64)
    if len(out):
        found = docs.mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).toArrow()  # at most the block's shingles
        out[found.column("shingle").to_numpy()] = found.column("n").to_numpy()
    return out


def _match(block: Windows, h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, window) of each occurrence among the documents' word hashes."""
    found = [(np.zeros(0, np.int64),) * 3]
    first = np.flatnonzero(np.append(True, block.token[1:] != block.token[:-1])) if len(block.token) else np.zeros(0, np.int64)
    many = np.diff(np.append(first, len(block.token)))
    matcher = Matcher(block.token[first])
    for k in block.kinds:
        at, token = matcher.find(salted(rolled(h, k), k))
        doc = np.searchsorted(off, at, side="right") - 1
        n = many[token]
        entry = np.repeat(first[token] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)
        at, doc, w = np.repeat(at, n), np.repeat(doc, n), block.window[entry]
        start = at - block.place[entry]
        ok = (np.minimum(block.size[w], SHINGLE) == k) & (start >= off[doc]) & (start + block.size[w] <= off[doc + 1])
        doc, start, w = doc[ok], start[ok], w[ok]
        for j in range(block.matrix.shape[1] if len(w) else 0):
            inside = j < block.size[w]
            ok = ~inside | (h[np.minimum(start + j, len(h) - 1)] == block.matrix[w, j])
            doc, start, w = doc[ok], start[ok], w[ok]
        found.append((doc, start, w))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _occurrences(docs: DataFrame, block: Windows, sparse: bool) -> DataFrame:
    """doc_id, n_words, hits (merged word ranges) and items of each document; with ``sparse``, of those with hits."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for b in steps(batches, "text"):
            off, tokens = words(b.column("text"), ALNUM)
            h = hashes(tokens)
            doc, start, w = _match(block, h, off)
            hits, items = [[] for _ in range(b.num_rows)], [[] for _ in range(b.num_rows)]
            order = np.lexsort((start, doc))
            for d, s, k in zip(doc[order].tolist(), (start - off[doc])[order].tolist(), w[order].tolist(), strict=True):
                e = s + int(block.size[k])
                if hits[d] and s <= hits[d][-1][1]:
                    hits[d][-1][1] = max(e, hits[d][-1][1])
                else:
                    hits[d].append([s, e])
                items[d].append(k)
            of = [sorted({i for k in set(x) for i in block.items[k]}) for x in items]
            out = pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("mark"), pa.array(np.diff(off)), pa.array([[{"start": s, "end": e} for s, e in x] for x in hits], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(of, pa.list_(pa.int64()))],
                ["doc_id", "mark", "n_words", "hits", "items"],
            )
            yield out.filter(pa.array([bool(x) for x in of], pa.bool_())) if sparse else out

    return docs.mapInArrow(run, "doc_id long, mark long, n_words long, hits array<struct<start:long,end:long>>, items array<long>")


def _union_ranges(ranges):
    """Merged ranges of an array of arrays of ranges, in order."""
    step = lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["start"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"))))).otherwise(F.concat(acc, F.array(x)))
    return F.aggregate(F.array_sort(F.flatten(ranges)), F.array().cast("array<struct<start:bigint,end:bigint>>"), step)


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", *, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, hits (word ranges, merged, end exclusive) and items (sorted ids) for every row of ``docs``."""
    rows = bounded(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    windows = materialize(item_windows(benchmark, item_col, item_text_col, window), "windows")
    if windows.count() <= block:
        known = Windows(windows.collect())  # at most ``block`` windows of ``window`` numbers
        known.order(shingle_counts(rows.select("text"), known))
        return _occurrences(rows, known, False).drop("mark")
    merged = _joined(rows, windows, window).withColumnsRenamed({"doc_id": "hit_id", "mark": "hit_mark"})
    every = _word_counts(rows)
    out = every.join(merged, every["doc_id"].eqNullSafe(merged["hit_id"]) & (every["mark"] == merged["hit_mark"]), "left")
    return out.select("doc_id", "n_words", F.coalesce("hits", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("hits"), F.coalesce("items", F.array().cast("array<bigint>")).alias("items"))


class Bitmap:
    """A set of hashes by their first bits: what is not in it is surely unknown."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    @classmethod
    def of(cls, known: DataFrame, column: str) -> Bitmap:
        """Of a column of hashes; at most ``BITMAP`` / 8 of its words reach the driver."""
        bits = int(min(np.log2(BITMAP * 8), max(12, np.ceil(np.log2(max(1, known.count()) * 32)))))
        at = known.select(F.shiftrightunsigned(column, 64 - bits).alias("at"))
        found = at.selectExpr("at DIV 64 AS w", "shiftleft(1L, CAST(at % 64 AS INT)) AS b").groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
        words = np.zeros(max(1, (1 << bits) // 64), np.int64)
        words[found.column("w").to_numpy()] = found.column("b").to_numpy()
        return cls(words.view(np.uint64), bits)

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h >> np.uint64(64 - self.bits)
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _joined(rows: DataFrame, windows: DataFrame, window: int) -> DataFrame:
    """doc_id, mark, hits and items of the texts with hits, by a shuffle join of shingles and prefix tokens."""
    spark = rows.sparkSession

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = []
            for w in b.column("hashes").to_pylist():
                k = min(SHINGLE, len(w))
                parts.append(salted(rolled(np.array(w, np.int64).view(np.uint64), k), k).view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays([b.column("wid"), b.column("hashes"), b.column("items"), pa.array(parts, pa.list_(pa.int64()))], ["wid", "hashes", "items", "parts"])

    one = windows.groupBy("hashes").agg(F.array_sort(F.collect_set("item_id")).alias("items")).select(F.xxhash64("hashes").alias("wid"), "hashes", "items")
    one = materialize(one.mapInArrow(cut, "wid long, hashes array<long>, items array<long>, parts array<long>"), "windows")
    places = one.select("wid", F.posexplode("parts").alias("place", "token"))
    kinds = [k for k in range(1, SHINGLE + 1) if k == SHINGLE or not one.filter(F.size("hashes") == k).isEmpty()]
    known = spark.sparkContext.broadcast(Bitmap.of(places.select("token").distinct(), "token"))

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, "text"):
            h = hashes(words(b.column("text"), ALNUM)[1])
            every = [salted(rolled(h, k), k) for k in kinds]
            token, n = np.unique(np.concatenate([x[known.value.has(x)] for x in every]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n)], ["token", "n"])

    counts = rows.select("text").mapInArrow(seen, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    ranked = places.join(counts, "token", "left").groupBy("wid").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "place")).alias("x"))
    tokens = ranked.filter("x.n > 0").select("wid", F.col("x.n").alias("n"), F.col("x.token").alias("token"), F.col("x.place").alias("place"))  # a shingle that no text holds ends its window
    tokens = materialize(tokens.join(one.select("wid", "hashes", "items"), "wid"), "tokens")
    sought = spark.sparkContext.broadcast(Bitmap.of(tokens.select("token").distinct(), "token"))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, "text"):
            off, found = words(b.column("text"), ALNUM)
            h = hashes(found)
            out = [[] for _ in range(5)]
            for k in kinds:
                x = salted(rolled(h, k), k)
                at = np.flatnonzero(sought.value.has(x))
                doc = np.searchsorted(off, at, side="right") - 1
                ok = at + k <= off[doc + 1] if len(at) else np.zeros(0, bool)
                for i, d in zip(at[ok].tolist(), doc[ok].tolist(), strict=True):
                    first = max(int(off[d]), i - window + 1)
                    for column, value in zip(out, (d, int(i - off[d]), i - first, int(x[i].view(np.int64)), h[first : min(int(off[d + 1]), i + window)].view(np.int64).tolist()), strict=True):
                        column.append(value)
            d = pa.array(out[0], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(d), b.column("mark").take(d), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int64()), pa.array(out[4], pa.list_(pa.int64()))], ["doc_id", "mark", "at", "left", "token", "around"])

    found = rows.mapInArrow(candidates, "doc_id long, mark long, at long, left int, token long, around array<long>")
    met = with_sums(found, tokens.drop("wid"), "token", "n")
    fits = (F.col("place") <= F.col("left")) & (F.slice("around", F.greatest(F.col("left") - F.col("place") + 1, F.lit(1)), F.size("hashes")) == F.col("hashes"))
    start = F.col("at") - F.col("place")
    hits = met.filter(fits).select("doc_id", "mark", F.struct(start.cast("long").alias("start"), (start + F.size("hashes")).cast("long").alias("end")).alias("hit"), "items").distinct()
    return hits.groupBy("doc_id", "mark").agg(_union_ranges(F.array(F.collect_list("hit"))).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))


def _word_counts(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("mark"), pa.array(np.diff(words(b.column("text"), ALNUM)[0]))], ["doc_id", "mark", "n_words"])

    return rows.mapInArrow(run, "doc_id long, mark long, n_words long")


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns from ``find``'s."""
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))
