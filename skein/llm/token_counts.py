"""Token counts by a two-tier lookup on the map side, without moving any pre-token.

Texts are cut at ASCII white space, where no pre-token goes on: a run of white space gives at most
two pre-tokens of its own and at most one leading space to the piece after it. Pieces are
dictionary-encoded step by step, so that each distinct piece of a step is counted once. A piece is
cut by the tokenizer's own pattern into pre-tokens. Tier one is a broadcast table of the lengths
of frequent pre-tokens, at most ``FREQUENT`` of them and ``WIDEST`` bytes each; tier two is a cache in each
worker, filled by the tokenizer's merges, of at most ``CACHED`` pieces of ``KEPT`` bytes each.

The table is counted over all documents: each task keeps bounded counts of its own pre-tokens and
sends its most frequent ones, which one aggregation adds up. What the table lacks only costs time.

Texts with a special string, or with white space outside ASCII's, go whole through the library,
and so do all texts where the file's settings are not those of this cutting (another normaliser,
pre-tokenizer or model, or a sentencepiece file).
Cases: null counts as empty (0 bytes, 0 tokens); nothing is truncated, very long texts and words are
counted whole; repeated rows give equal rows; an empty table gives an empty result; ties of the table's
last place go by the pre-token; other columns, also of the result's names, are not read.
"""

from __future__ import annotations

import heapq
import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import bounded, buffers, steps, tokenizer_file

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space beyond ASCII's six, to the pattern or to Python.
ODD_SPACE = "[\x1c-\x1f\x85\u00a0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]"
FREQUENT, WIDEST, CACHED, KEPT = 1 << 16, 32, 1 << 19, 64
#: Pre-tokens that a task holds counts of, and sends.
HELD, SENT = 1 << 18, 1 << 14


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies: the printable Latin-1 bytes stand for themselves, the rest, in order, for the characters from 256."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def cuts_alike(path: str) -> bool:
    """Whether a tokenizer file cuts texts as this module does: byte-level BPE with the library's own pattern and nothing before it."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        of = json.load(f)
    model, pre, plain = of["model"], of.get("pre_tokenizer") or {}, (None, "", False)
    return (
        model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space", True) and pre.get("use_regex", True)
        and of.get("normalizer") is None and all(model.get(x) in plain for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    )


def pieces(texts: pa.Array) -> tuple[list[tuple[int, str]], np.ndarray, pa.DictionaryArray]:
    """White space's own pieces with their texts' places, and the places and words of all other pieces (with the space before each)."""
    off, raw = buffers(texts)
    if not len(raw):
        return [], np.zeros(0, np.int64), pa.array([], pa.large_string()).dictionary_encode()
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.zeros(len(raw) + 1, bool)  # where a run of white space or of other bytes begins, or a text
    edge[off] = True
    edge[1:-1] |= space[1:] != space[:-1]
    begin = np.flatnonzero(edge[:-1])
    size = np.diff(np.append(begin, len(raw)))
    doc = np.searchsorted(off, begin, side="right") - 1
    blank = space[begin]
    last = begin + size - 1
    ends = np.zeros(len(raw) + 1, bool)
    ends[off] = True
    at_end = ends[last + 1]
    gives = blank & ~at_end & (raw[last] == 32)  # its last space goes to the piece after it
    # a run's own pre-tokens are all of it at the end of a text, else all but the last character, then that one
    own = [(int(doc[i]), raw[begin[i] : last[i]].tobytes().decode()) for i in np.flatnonzero(blank & (size > 1) & ~at_end).tolist()]
    own += [(int(doc[i]), raw[begin[i] : last[i] + 1].tobytes().decode()) for i in np.flatnonzero(blank & at_end).tolist()]
    own += [(int(doc[i]), chr(raw[last[i]])) for i in np.flatnonzero(blank & ~at_end & ~gives).tolist()]
    words = np.flatnonzero(~blank)
    spaced = np.zeros(len(words), bool)
    spaced[words > 0] = gives[words[words > 0] - 1]
    first = begin[words] - spaced
    keep = ~space
    keep[first] = True
    place = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(keep, out=place[1:])
    offs = np.append(place[first], place[begin[words[-1]] + size[words[-1]]] if len(words) else 0)
    listed = pa.Array.from_buffers(pa.large_string(), len(words), [None, pa.py_buffer(offs.astype(np.int64)), pa.py_buffer(raw[keep])])
    return own, doc[words], listed.dictionary_encode()


class PieceCounter:
    """Counts tokens of texts with one tokenizer file; made once in each worker, so its cache serves all the worker's tasks."""

    _made: dict[str, PieceCounter] = {}

    def __init__(self, path: str):
        self.frequent: dict[str, int] = {}
        self.cache: dict[str, int] = {}  # pieces longer than a pre-token, and pre-tokens, with their lengths
        self.alike = cuts_alike(path)
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(path)
            library.no_truncation()
            library.no_padding()
            self.special = [t.content for t in library.get_added_tokens_decoder().values()]
            self.length = lambda text: len(library.encode(text, add_special_tokens=False))
            self.merged = library.model.tokenize
        else:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.length = lambda text: len(model.encode(text))
        self.cut = regex.compile(PATTERN).findall
        alphabet = byte_alphabet()
        self.shown = [alphabet[b] for b in range(256)]

    @classmethod
    def of(cls, name: str, frequent: dict[str, int]) -> PieceCounter:
        path = tokenizer_file(name)
        if path not in cls._made:
            cls._made[path] = cls(path)
        made = cls._made[path]
        made.frequent = frequent
        return made

    def pretoken(self, token: str) -> int:
        n = self.frequent.get(token)
        if n is None:
            n = len(self.merged("".join([self.shown[b] for b in token.encode()])))
        return n

    def piece(self, text: str) -> int:
        n = self.cache.get(text)
        if n is None:
            n = sum(map(self.pretoken, self.cut(text)))
            if len(text) <= KEPT // 4 or len(text.encode()) <= KEPT:
                if len(self.cache) >= CACHED:
                    self.cache.clear()
                self.cache[text] = n
        return n

    def whole(self, texts: pa.Array) -> np.ndarray:
        """Which texts the library must cut itself."""
        if not self.alike:
            return np.ones(len(texts), bool)
        out = pc.match_substring_regex(texts, ODD_SPACE)
        for s in self.special:
            out = pc.or_(out, pc.match_substring(texts, s))
        return out.to_numpy(zero_copy_only=False).astype(bool)

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        whole, total = self.whole(texts), np.zeros(len(texts), np.int64)
        if not whole.all():
            own, doc, tokens = pieces(texts)
            for i, text in own:
                if not whole[i]:
                    total[i] += self.piece(text)
            size = np.fromiter(map(self.piece, tokens.dictionary.to_pylist()), np.int64, len(tokens.dictionary))
            if len(doc):
                total += np.bincount(doc, weights=size[tokens.indices.to_numpy(zero_copy_only=False)], minlength=len(texts)).astype(np.int64)
        for i in np.flatnonzero(whole).tolist():
            total[i] = self.length(texts[i].as_py())
        return total


def frequent_lengths(docs: DataFrame, name: str, text_col: str = "text") -> dict[str, int]:
    """Token lengths of the pre-tokens that are the most frequent in all documents.

    Each task drops its rarest counts when it holds more than ``HELD`` and sends its ``SENT`` most
    frequent ones; at most ``FREQUENT`` sums reach the driver.
    """

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, counts = regex.compile(PATTERN).findall, Counter()
        for b in steps(batches, "text"):
            _, _, tokens = pieces(b.column("text").fill_null(""))
            n = np.bincount(tokens.indices.to_numpy(zero_copy_only=False), minlength=len(tokens.dictionary))
            for i in np.flatnonzero(n > 1).tolist():
                text = tokens.dictionary[i].as_py()
                for t in (text,) if text.isalpha() else cut(text):
                    counts[t] += int(n[i])
            if len(counts) > HELD:
                counts = Counter(dict(counts.most_common(HELD // 2)))
        rows = [(t, n) for t, n in heapq.nsmallest(SENT, counts.items(), key=lambda x: (-x[1], x[0])) if len(t.encode()) <= WIDEST]
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], ["token", "n"])

    counter = PieceCounter.of(name, {})
    if not counter.alike:
        return {}
    sums = bounded(docs).select(F.col(text_col).cast("string").alias("text")).mapInArrow(seen, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return {r["token"]: counter.pretoken(r["token"]) for r in sums.orderBy(F.desc("n"), "token").limit(FREQUENT).collect()}


def count_tokens(docs: DataFrame, name: str, id_col: str = "doc_id", text_col: str = "text", *, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit for every row, by a tokenizer's file (a path, or the name of a public one); texts are not shuffled."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(frequent_lengths(docs, name, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter.of(name, table.value)
        for b in steps(batches, "text"):
            texts = b.column("text").fill_null("")
            n = counter.count(texts)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(buffers(texts)[0])), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = bounded(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
