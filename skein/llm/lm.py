"""Language-model scores: the marginal likelihood of a text over all its segmentations.

The vocabulary and its scores are existing ones: the scores weigh the segmentations. As the scores
of merges are ranks, a piece's log weight falls with the logarithm of its rank; how steeply (the
temperature) and how often a text ends are fitted on the training words, and nothing else is. With
``rounds``, expectation-maximisation on the training words refits all weights instead (vocabularies
are never changed). A document's probability is the sum over all ways to cut it into pieces, found
by a forward recursion in log space. No piece goes on past the start of a word, so a document's
lattice is a chain of its words' lattices: each distinct word's lattice is run once, however often
the word occurs, and a document's score is the sum over its words and the end of the text.

With ``whole``, the lattice of a word has one edge more, over the whole word: its training count less a
discount (from the counts of words met once and twice), as a share of all training tokens. What the discounts
leave is the weight of the pieces' segmentations, which carry unseen words; the pieces are then fitted on the
distinct training words, each once. All words and the end still add up to a probability of 1 at most.

The corpus meets the words in packed form. One pass over the texts cuts them into steps; for each
step it writes its distinct words by hash bucket, with their training counts, and the documents'
word numbers. Buckets, whose number grows with the texts' bytes, add up counts over steps (the word
table grows with the corpus and is never collected or broadcast) and send the steps' words their
values back. A frequent word is one entry for each step, so no word is hot.

Cases: null counts as empty, whose only token is the end; a null id's text for the split is empty;
repeated rows are documents of their own; very long texts and words are scored whole; without
training words the temperature is 1, and a whole word and the end weigh a half each; an empty table gives an empty result; other columns, also of
the result's names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import SPACED, bounded, buckets, hashes, materialize, mixed, numbered, partitions, steps, tokenizer_file, words

MARK = "▁"
ROUNDS, SMOOTHING, FLOOR = 0, 0.1, -1e8
#: Least and greatest discount of a word's count.
DISCOUNTS = (0.1, 0.9)
#: Steepnesses of the weights between which the best one is sought, and the shift by which pieces are counted.
TEMPERATURES, SHIFT = (0.4, 0.7, 1.0, 1.3, 1.6, 1.9), 1e-3
#: Buckets for each shuffle partition at least.
FINER = 4
PACKED = "kind int, bucket int, step long, words binary, counts binary, docs binary"


class Vocabulary:
    """Pieces of a sentencepiece file as a hash table over code points; ``first`` are log weights from its scores."""

    _made: dict[str, Vocabulary] = {}

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(path))
        n = model.get_piece_size()
        names, scores = [model.id_to_piece(i) for i in range(n)], np.array([model.get_score(i) for i in range(n)])
        last = np.array([model.is_byte(i) or len(names[i]) == 1 and scores[i] <= FLOOR for i in range(n)])  # always usable, and the least likely
        plain = np.array([not (model.is_control(i) or model.is_unknown(i)) for i in range(n)]) & (last | (scores > FLOOR))
        # the scores of merges are ranks from -1 down: log weights fall with their logarithm
        self.first = np.where(plain, -np.log(10.0 + np.where(last, n, -scores)), -np.inf)
        self.bytes = {int(names[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.size = n
        own = [i for i in np.flatnonzero(plain).tolist() if not model.is_byte(i)]
        self.longest = max(map(len, (names[i] for i in own)), default=1)
        keys = np.zeros(len(own), np.uint64)
        for k in range(self.longest):
            at = np.array([j for j, i in enumerate(own) if len(names[i]) > k], np.int64)
            keys[at] = keys[at] * STEP + np.array([ord(names[own[j]][k]) + 1 for j in at], np.uint64)
        keys = mixed(keys)
        order = np.argsort(keys)
        self.keys, self.pieces = keys[order], np.array(own, np.int64)[order]
        slot = (self.keys >> np.uint64(64 - SLOTS)).astype(np.int64)
        self.start = np.searchsorted(slot, np.arange((1 << SLOTS) + 1))
        self.used = self.start[1:] > self.start[:-1]
        self.deepest = int(np.diff(self.start).max(initial=0))

    @classmethod
    def of(cls, path: str) -> Vocabulary:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The piece of each hash, or -1."""
        out = np.full(keys.shape, -1, np.int64)
        slot = (keys >> np.uint64(64 - SLOTS)).astype(np.int64)
        at = np.flatnonzero(self.used[slot.ravel()])
        key, first = keys.ravel()[at], self.start[slot.ravel()[at]]
        flat = out.ravel()
        for r in range(self.deepest):
            k = np.minimum(first + r, len(self.keys) - 1)
            hit = self.keys[k] == key
            flat[at[hit]] = self.pieces[k[hit]]
        return out


STEP, SLOTS = np.uint64(0x9E3779B97F4A7C15), 20
#: Words times their length that are taken at once.
CELLS = 1 << 16


class Lattice:
    """Forward and backward recursions in log space, under log weights, for many words of one length at a time."""

    def __init__(self, vocabulary: Vocabulary, weights: np.ndarray):
        self.vocabulary, self.w = vocabulary, np.append(weights, -np.inf)  # the last: no piece

    def _groups(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places in ``words``, code points with the mark in front) of words of one length."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(size, kind="stable")
        ends = np.flatnonzero(np.append(size[order][1:] != size[order][:-1], True)) + 1 if len(words) else []
        start = 0
        for end in ends:
            n = int(size[order[start]])
            each = max(1, CELLS // (n + 1))
            for k in range(start, end, each):
                at = order[k : min(k + each, end)]
                text = "".join([words[i] for i in at.tolist()])
                codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(len(at), n)
                yield at, np.concatenate([np.full((len(at), 1), ord(MARK), np.uint32), codes], axis=1)
            start = end

    def _edges(self, codes: np.ndarray) -> list[np.ndarray]:
        """For each piece length, the piece at each start (-1: none)."""
        n, h, found = codes.shape[1], np.zeros(codes.shape, np.uint64), []
        for k in range(min(self.vocabulary.longest, n)):
            h = h[:, : n - k] * STEP + (codes[:, k:].astype(np.uint64) + np.uint64(1))
            found.append(self.vocabulary.find(mixed(h)))
        return found

    def _singles(self, codes: np.ndarray, found: list[np.ndarray], w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The log weight of single characters; which of them go by bytes."""
        single, odd = w[found[0]], found[0] < 0
        if odd.any():
            kinds, which = np.unique(codes[odd], return_inverse=True)
            single = single.copy()
            single[odd] = np.array([sum(w[self.vocabulary.bytes[b]] for b in chr(c).encode()) for c in kinds.tolist()])[which]
        return single, odd

    def _forward(self, found: list[np.ndarray], single: np.ndarray, w: np.ndarray) -> np.ndarray:
        rows, n = single.shape
        alpha = np.full((rows, n + 1), -np.inf)
        alpha[:, 0] = 0.0
        for j in range(1, n + 1):
            into = [alpha[:, j - 1] + single[:, j - 1]] + [alpha[:, j - k - 1] + w[found[k][:, j - k - 1]] for k in range(1, min(len(found), j))]
            alpha[:, j] = _sum(into)
        return alpha

    def likelihoods(self, words: list[str]) -> np.ndarray:
        """For each word, the log of the sum over all its segmentations."""
        return self.under(words, [self.w])[0]

    def under(self, words: list[str], weights: list[np.ndarray]) -> np.ndarray:
        """The likelihoods of the words under each of several weights (the last of each: no piece)."""
        out = np.zeros((len(weights), len(words)))
        for at, codes in self._groups(words):
            found = self._edges(codes)
            for k, w in enumerate(weights):
                out[k, at] = self._forward(found, self._singles(codes, found, w)[0], w)[:, -1]
        return out

    def expect(self, words: list[str], counts: np.ndarray, into: np.ndarray) -> None:
        """Adds the expected piece counts of the words, each ``counts`` times."""
        for at, codes in self._groups(words):
            found = self._edges(codes)
            single, odd = self._singles(codes, found, self.w)
            alpha = self._forward(found, single, self.w)
            n = codes.shape[1]
            beta = np.full(alpha.shape, -np.inf)
            beta[:, n] = 0.0
            for i in range(n - 1, -1, -1):
                beta[:, i] = _sum([single[:, i] + beta[:, i + 1]] + [self.w[found[k][:, i]] + beta[:, i + k + 1] for k in range(1, min(len(found), n - i))])
            c = counts[at].astype(np.float64)[:, None]
            for k, piece in enumerate(found):
                cost = single if k == 0 else self.w[piece]
                p = c * np.exp(alpha[:, : n - k] + cost + beta[:, k + 1 :] - alpha[:, n :])
                ok = piece >= 0
                into += np.bincount(piece[ok], weights=p[ok], minlength=len(into))
                if k == 0 and odd.any():
                    kinds, which = np.unique(codes[odd], return_inverse=True)
                    for x, total in zip(kinds.tolist(), np.bincount(which, weights=p[odd]).tolist(), strict=True):
                        for b in chr(x).encode():
                            into[self.vocabulary.bytes[b]] += total


def _sum(terms: list[np.ndarray]) -> np.ndarray:
    """Log of the sum of exponentials; the first term is finite."""
    if len(terms) == 1:
        return terms[0]
    every = np.stack(terms)
    top = every.max(axis=0)
    return top + np.log(np.exp(every - top).sum(axis=0))


def _packed(docs: DataFrame, buckets: int) -> DataFrame:
    """Steps in packed form. kind 0: a step's words of one bucket and their training counts; kind 1: the step's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step, b in numbered(steps(batches, "text")):
            off, tokens = words(b.column("text"), SPACED)
            held = b.column("held").to_numpy(zero_copy_only=False).astype(bool)
            d = tokens.dictionary_encode()
            code, names = d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary
            doc = np.repeat(np.arange(b.num_rows), np.diff(off))
            trained = np.bincount(code[~held[doc]], minlength=len(names))
            bucket = (hashes(names) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")  # words are numbered by bucket, then by first use
            number = np.empty(len(names), np.int64)
            number[order] = np.arange(len(names))
            pair, times = np.unique(doc * len(names) + number[code] if len(code) else code, return_counts=True)
            of, starts = np.unique(bucket[order], return_index=True)  # buckets with a word of the step; there are no rows for others
            ends = np.append(starts, len(order))
            ids = b.column("doc_id")
            docs_blob = _pack(
                {
                    "id": ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), "null": np.asarray(ids.is_null()).astype(np.uint8), "held": held.astype(np.uint8),
                    "n": np.diff(off).astype(np.int64), "pairs": np.bincount(pair // max(1, len(names)), minlength=b.num_rows).astype(np.uint32),
                    "word": (pair % max(1, len(names))).astype(np.uint32), "times": times.astype(np.uint32),
                }
            )
            taken = names.take(pa.array(order)).to_pylist()
            rows = [(0, k, step, b"\n".join(taken[i:j]), trained[order[i:j]].astype(np.uint32).tobytes(), None) for k, i, j in zip(of.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            rows.append((1, -1, step, None, None, docs_blob))
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["kind", "bucket", "step", "words", "counts", "docs"])

    return docs.mapInArrow(run, PACKED)


def _pack(arrays: dict[str, np.ndarray]) -> bytes:
    """Arrays of small numbers as one compressed blob."""
    import zstandard

    parts = [len(arrays).to_bytes(2, "little")]
    for name, a in arrays.items():
        if a.dtype == np.uint32 and len(a) and a.max() < 65536:
            a = a.astype(np.uint16)
        if a.dtype == np.uint16 and len(a) and a.max() < 256:
            a = a.astype(np.uint8)
        head = f"{name} {a.dtype.str} {a.nbytes}".encode()
        parts += [len(head).to_bytes(2, "little"), head, a.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    out, pos = {}, 2
    for _ in range(int.from_bytes(raw[:2], "little")):
        n = int.from_bytes(raw[pos : pos + 2], "little")
        name, kind, size = raw[pos + 2 : pos + 2 + n].decode().split()
        pos += 2 + n
        out[name] = np.frombuffer(raw, np.dtype(kind), int(size) // np.dtype(kind).itemsize, pos)
        pos += int(size)
    return out


def _cut(blobs: list[bytes]) -> pa.Array:
    """All words of joined blobs, in order."""
    return words(pa.array([b"\n".join(blobs)], pa.large_binary()), SPLIT)[1].cast(pa.large_binary())


#: White space to 0x20, all else as it is.
SPLIT = np.arange(256, dtype=np.uint8)
SPLIT[9:14] = 32


def _word_table(packed: DataFrame) -> DataFrame:
    """(bucket, word, c): the training count of every distinct word of the corpus."""

    def add(t: pa.Table) -> pa.Table:
        found = _cut(t.column("words").to_pylist())
        n = np.frombuffer(b"".join(t.column("counts").to_pylist()), np.uint32).astype(np.int64)
        out = pa.table({"word": found, "n": pa.array(n)}).group_by("word").aggregate([("n", "sum")])
        return pa.table({"bucket": pa.array(np.full(len(out), t.column("bucket")[0].as_py(), np.int32)), "word": out.column("word").cast(pa.binary()), "c": out.column("n_sum")})

    return packed.filter("kind = 0").select("bucket", "words", "counts").groupBy("bucket").applyInArrow(add, "bucket int, word binary, c long")


def _expected(table: DataFrame, path: str, weights: np.ndarray) -> np.ndarray:
    """Expected counts of the pieces in all training words; one row for each piece and task meets at the sum."""
    shared = table.sparkSession.sparkContext.broadcast(weights)  # as long as the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(Vocabulary.of(path), shared.value)
        into = np.zeros(lattice.vocabulary.size)
        for b in batches:
            lattice.expect(b.column("word").cast(pa.string()).to_pylist(), b.column("c").to_numpy(zero_copy_only=False), into)
        piece = np.flatnonzero(into)
        yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(into[piece])], ["piece", "n"])

    out = np.zeros(len(weights))
    for r in table.filter("c > 0").select("word", "c").mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect():
        out[r["piece"]] = r["n"]
    return out


def _totals(table: DataFrame, path: str, weights: list[np.ndarray]) -> np.ndarray:
    """The log likelihood of all training words under each of the weights; one row for each task meets at the sum."""
    shared = table.sparkSession.sparkContext.broadcast([np.append(w, -np.inf) for w in weights])  # a few vectors as long as the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(Vocabulary.of(path), shared.value[0][:-1])
        total = np.zeros(len(shared.value))
        for b in batches:
            total += lattice.under(b.column("word").cast(pa.string()).to_pylist(), shared.value) @ b.column("c").to_numpy(zero_copy_only=False).astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["k", "n"])

    out = np.zeros(len(weights))
    for r in table.filter("c > 0").select("word", "c").mapInArrow(run, "k long, n double").groupBy("k").agg(F.sum("n").alias("n")).collect():
        out[r["k"]] = r["n"]
    return out


def tempered(first: np.ndarray, steepness: float) -> np.ndarray:
    """Log weights in proportion to the existing ones, which add up to 1."""
    w = first * steepness
    return w - np.log(np.exp(w[np.isfinite(w)]).sum())


def train(table: DataFrame, path: str, ends: int, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Log weights of the pieces and of the end of a text, from the word table."""
    first = Vocabulary.of(path).first
    free = np.isfinite(first)
    if rounds == 0:
        total = _totals(table, path, [tempered(first, a) for a in TEMPERATURES])
        k = int(total.argmax())
        steepness = TEMPERATURES[k] if total.any() else 1.0
        if 0 < k < len(total) - 1:  # the top of the parabola through the best one and its neighbours
            before, best, after = total[k - 1 : k + 2]
            steepness += (TEMPERATURES[k + 1] - TEMPERATURES[k]) * (before - after) / (2 * (before - 2 * best + after))
        weights = tempered(first, round(float(steepness), 4))
        low, high = _totals(table, path, [weights, weights + SHIFT])
        pieces = round((high - low) / SHIFT)  # expected pieces of all training words
        return weights + log((pieces + SMOOTHING) / (pieces + ends + 2 * SMOOTHING)), log((ends + SMOOTHING) / (pieces + ends + 2 * SMOOTHING))
    weights, end = first - np.log(np.exp(first[free]).sum() + 1e-3), log(1e-3)
    for _ in range(rounds):
        n = _expected(table, path, weights) + SMOOTHING
        total = n[free].sum() + ends + SMOOTHING
        weights, end = np.where(free, np.log(n / total), -np.inf), log((ends + SMOOTHING) / total)
    return weights, end


def score(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", *, folds: int = 7, held: int = 2, rounds: int = ROUNDS, whole: bool = False) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every row of ``docs``.

    Training documents are those whose crc32(id as text) modulo ``folds`` is not ``held``.
    """
    spark: SparkSession = docs.sparkSession
    crc = F.crc32(F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")).cast("binary"))
    rows = bounded(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), (crc % folds == held).alias("held"))
    packed = materialize(_packed(rows, buckets(rows, "text", FINER * partitions(spark))), "packed")
    table = materialize(_word_table(packed), "words")
    ends = rows.agg(F.count(F.when(~F.col("held"), 1)).alias("n")).first()["n"]
    n_all, known_words, once, twice = table.agg(F.coalesce(F.sum("c"), F.lit(0)), *[F.count(F.when(x, 1)) for x in (F.col("c") > 0, F.col("c") == 1, F.col("c") == 2)]).first()
    n_all, distinct = n_all + ends, known_words + (ends > 0)
    if whole:
        weights, _ = train(table.filter("c > 0").select("word", F.lit(1).cast("long").alias("c")), path, 0, rounds)
        discount = float(np.clip(once / max(1, once + 2 * twice), *DISCOUNTS))
        every = n_all + 2 * SMOOTHING
        end, rest = log((ends + SMOOTHING) / every), log((discount * known_words + SMOOTHING) / every)
    else:
        weights, end = train(table, path, ends, rounds)
    shared = spark.sparkContext.broadcast(weights)

    def answer(key, known: pa.Table, asked: pa.Table) -> pa.Table:
        """Each step's words of this bucket get their count and log likelihood, in the order asked."""
        lattice = Lattice(Vocabulary.of(path), shared.value)
        names = known.column("word").combine_chunks().cast(pa.large_binary())
        c = known.column("c").to_numpy().astype(np.int64)
        value = lattice.likelihoods(names.cast(pa.large_string()).to_pylist())
        if whole:
            own = np.log(np.maximum(c - discount, 0) / every, out=np.full(len(c), -np.inf), where=c > 0)
            value = np.logaddexp(own, rest + value)
        blobs = asked.column("words").to_pylist()
        at = pc.index_in(_cut(blobs), value_set=names).to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = np.cumsum([x.count(b"\n") + 1 for x in blobs])[:-1]
        parts = np.split(at, sizes)
        return pa.table(
            {
                "step": asked.column("step"), "bucket": asked.column("bucket"), "c": pa.array([c[x].tobytes() for x in parts], pa.binary()),
                "value": pa.array([value[x].tobytes() for x in parts], pa.binary()), "docs": pa.array([None] * len(parts), pa.binary()),
            }
        )

    asked = packed.filter("kind = 0").select("bucket", "step", "words")
    answers = table.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(answer, "step long, bucket int, c binary, value binary, docs binary")
    own = packed.filter("kind = 1").select("step", F.lit(-1).alias("bucket"), F.lit(None).cast("binary").alias("c"), F.lit(None).cast("binary").alias("value"), "docs")
    scale = float(np.log10(n_all + distinct + 1))

    def finish(t: pa.Table) -> pa.Table:
        of = sorted(zip(t.column("bucket").to_pylist(), range(len(t)), strict=True))
        d = _unpack(t.column("docs")[of[0][1]].as_py())
        c = np.frombuffer(b"".join(t.column("c")[i].as_py() for _, i in of[1:]), np.int64)
        value = np.frombuffer(b"".join(t.column("value")[i].as_py() for _, i in of[1:]), np.float64)
        n = len(d["id"])
        doc = np.repeat(np.arange(n), d["pairs"])
        word, times = d["word"].astype(np.int64), d["times"].astype(np.float64)
        add = lambda x: np.bincount(doc, weights=times * x[word], minlength=n) if len(word) else np.zeros(n)
        tokens = d["n"] + 1
        return pa.table(
            {
                "doc_id": pa.array(d["id"], mask=d["null"].astype(bool)), "held_out": pa.array(d["held"].astype(bool)), "n_tokens": pa.array(tokens),
                "n_known": pa.array(add((c > 0).astype(float)).round().astype(np.int64) + int(ends > 0)), "train_tokens": pa.array(np.full(n, n_all, np.int64)),
                "base_score": pa.array(add(np.log10(c + 1.0)) + np.log10(ends + 1.0) - tokens * scale), "score": pa.array((add(value) + end) / log(10)),
            }
        )

    return answers.unionByName(own).groupBy("step").applyInArrow(finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
