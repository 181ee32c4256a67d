"""What the training-data operators share: tables, materialised steps, byte-level words.

Word rules. Both rules lower-case ``A-Z`` only and work on UTF-8 bytes, so that they are the
same for every language and need no Python object per word:

* ``SPACED``: words are ``[^\\x20\\x09-\\x0D]+``;
* ``ALNUM``: words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing (letters, digits, all non-ASCII).
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..steps import discard, materialize, shared_dir, written  # noqa: F401  (the operators take them from here)

#: Text bytes that one vectorised step works on; a longer text is a step of its own.
STEP_BYTES = 4 << 20
#: Bytes of rows that go to Python at once, where the session has Spark's default; a longer row goes by itself.
BATCH_BYTES, BATCH_CONF = 3 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"
#: Text bytes whose words or n-grams one bucket holds: bounds what one task takes at a time, at any input size.
BUCKET_BYTES = 32 << 20
#: Ids that may be broadcast as a filter (8 bytes each); beyond it the join shuffles.
BROADCAST_IDS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """The place of a tokenizer's file where this runs (driver or worker): a path as it is, else one of the public ones by name."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def bounded(df: DataFrame) -> DataFrame:
    """``df``, in whose session Arrow batches are bounded by bytes, as texts differ in length; a setting of the user's own stays."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_CONF, None) is None:
        conf.set(BATCH_CONF, str(BATCH_BYTES))
    return df


def sampled(id_col: str, rate: float | Column) -> Column:
    """Whether a row is in a sample of about ``rate`` of all rows, by the hash of its id; rows without an id are not.

    Copies of a text fall apart, and the hash is fine enough for any table.
    """
    fine = 1 << 40
    most = (rate * fine).cast("long") if isinstance(rate, Column) else F.lit(int(rate * fine))
    return F.col(id_col).isNotNull() & (F.pmod(F.xxhash64(id_col), F.lit(fine)) < most)


def buckets(docs: DataFrame, text_col: str, least: int) -> int:
    """Buckets of about ``BUCKET_BYTES`` of text each, and ``least`` of them at least."""
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    return max(least, -(-size // BUCKET_BYTES))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _table(keep) -> np.ndarray:
    """Byte map: A-Z to a-z; bytes that end words to 0x20."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    t[[b for b in range(256) if not keep(b)]] = 32
    return t


SPACED = _table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
ALNUM = _table(lambda b: b >= 0x80 or chr(b).isalnum())


def steps(batches: Iterator[pa.RecordBatch], column: str, most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose ``column`` has about ``most`` bytes at most."""
    for batch in batches:
        sizes = np.diff(buffers(batch.column(column))[0])
        start = used = 0
        for i, n in enumerate(sizes.tolist()):
            if used and used + n > most:
                yield batch.slice(start, i - start)
                start, used = i, 0
            used += n
        if batch.num_rows > start:
            yield batch.slice(start)
    pa.default_memory_pool().release_unused()  # a worker that waits for its next task holds little


def numbered(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The parts of a task with numbers of their own among all tasks; a task that runs again gives the same."""
    first = TaskContext.get().partitionId() << 32
    for i, part in enumerate(parts):
        yield first + i, part


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and bytes of a string array; null counts as empty."""
    if pa.types.is_null(texts.type):
        texts = texts.cast(pa.string())
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, off, data = texts.buffers()
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    off = np.frombuffer(off, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return off - off[0], raw


def words(texts: pa.Array, rule: np.ndarray) -> tuple[np.ndarray, pa.BinaryArray]:
    """Word counts up to each text (one more than texts, from 0) and all words, in order."""
    off, raw = buffers(texts)
    raw = rule[raw]
    # below 0x20 only the bytes the rule keeps can stand; white space is 0x20 after the map
    inside = raw != 32
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = off[1:-1]
    cut = cut[cut < len(raw)]
    first[cut] = inside[cut]
    starts = np.flatnonzero(first)
    data = raw[inside]
    place = np.zeros(len(raw) + 1, np.int32 if len(raw) < 2**31 else np.int64)
    np.cumsum(inside, out=place[1:])
    offs = np.append(place[starts], place.dtype.type(len(data)))
    kind = pa.binary() if offs.dtype == np.int32 else pa.large_binary()
    out = pa.Array.from_buffers(kind, len(starts), [None, pa.py_buffer(offs), pa.py_buffer(data)])
    return np.searchsorted(starts, off), out


def coded(tokens: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """Codes of the tokens and what they stand for."""
    d = tokens.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False), d.dictionary.to_pylist()


#: Fixed random odd factor and byte values of the words' hash; longer words than LONG bytes are hashed one by one.
FACTOR = np.uint64(0x9FB21C651E98DF25 | 1)
BYTES = np.random.RandomState(20240101).randint(1, 2**63 - 1, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
LONG = 48


def hashes(tokens: pa.Array) -> np.ndarray:
    """A 64-bit hash of each token's bytes, byte by byte over all tokens at once."""
    off, raw = buffers(tokens)
    size = np.diff(off)
    h = np.zeros(len(size), np.uint64)
    at, left = off[:-1], None
    for k in range(min(LONG, int(size.max(initial=0)))):
        left = np.arange(len(size)) if left is None else left[size[left] > k]
        h[left] = h[left] * FACTOR + BYTES[raw[at[left] + k]]
    for i in np.flatnonzero(size > LONG).tolist():
        h[i] = xxhash.xxh64_intdigest(raw[off[i] : off[i + 1]].tobytes())
    return mixed(h)


MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: all bits depend on all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def rolled(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k tokens, from the tokens' hashes; len(h) - k + 1 of them."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for i in range(1, k):
        out = out * MIX + h[i : n + i]
    return mixed(out)


#: Column of the pipeline's row keys.
KEY = "__row"


def row_key(*columns: Column) -> Column:
    """A hash of the values, where null is a value of its own: equal rows share it, and no row is without."""
    return F.xxhash64(*[x for c in columns for x in (c, c.isNull())])


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the ``KEY`` of each row's own values (maps cannot be hashed and are left out)."""
    return docs.withColumn(KEY, row_key(*[docs[f.name] for f in docs.schema if "map<" not in f.dataType.simpleString()]))


#: Rows of one key that one task of a spread join takes.
SPREAD = 500_000


def spread_join(rows: DataFrame, few: DataFrame, key: str, by: Column, *, most: int = BROADCAST_IDS, each: int = SPREAD) -> DataFrame:
    """``rows`` left joined with ``few`` (one row for each ``key``, null for none) where a key may hold any share of the rows.

    A table of at most ``most`` rows is broadcast. Beyond that, keys with more than ``each`` rows are
    dealt to as many tasks as they need by a hash of ``by``, and rows without a key are not dealt at all.
    The hot keys' table has one row for each ``each`` rows at most.
    """
    few = materialize(few, "few")
    if few.count() <= most:
        return rows.join(F.broadcast(few), key, "left")
    named = rows.filter(F.col(key).isNotNull())
    hot = materialize(named.groupBy(key).count().filter(F.col("count") > each).select(key, F.ceil(F.col("count") / each).alias("__parts")), "hot")
    parts = F.coalesce("__parts", F.lit(1))
    dealt = named.join(F.broadcast(hot), key, "left").withColumn("__part", F.pmod(F.xxhash64(by), parts)).drop("__parts")
    answers = few.join(F.broadcast(hot), key, "left").withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("__parts")
    return dealt.join(answers, [key, "__part"], "left").drop("__part").unionByName(rows.filter(F.col(key).isNull()), allowMissingColumns=True)


def with_sums(rows: DataFrame, sums: DataFrame, key: str, count: str, *, each: int = SPREAD) -> DataFrame:
    """``rows`` inner joined with ``sums`` of these rows by ``key``, whose column ``count`` says how many rows a key has.

    Sums of keys with more than ``each`` rows (one for each ``each`` rows at most) are broadcast, so no task gets such a key's rows.
    """
    hot = sums.filter(F.col(count) > each).withColumn("__hot", F.lit(True))
    marked = rows.join(F.broadcast(hot), key, "left")
    cold = marked.filter("__hot IS NULL").select(*rows.columns).join(sums.filter(F.col(count) <= each), key)
    return cold.unionByName(marked.filter("__hot").drop("__hot"))


def _by_id(docs: DataFrame, named: DataFrame, id_col: str, how: str) -> DataFrame:
    ids = materialize(named.select(F.col(named.columns[0]).cast("long").alias("__dropped")).filter("__dropped IS NOT NULL").distinct(), "dropped")
    few = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, docs[id_col].cast("long") == ids["__dropped"], how)


def without(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id is in ``dropped`` (one long column); all columns stay.

    The ids are broadcast only if there are few; else both sides are shuffled by id. A row
    without an id cannot be named and stays; rows that share an id go together. Stages that
    decide on rows name them by their ``KEY``, which neither is without nor shared by unequal rows.
    """
    return _by_id(docs, dropped, id_col, "left_anti")


def once(docs: DataFrame, repeated: DataFrame, id_col: str) -> DataFrame:
    """``docs`` with one row only of each id in ``repeated``; rows that share an id must be equal. Other rows are not shuffled."""
    repeated = materialize(repeated, "repeated")
    if repeated.isEmpty():
        return docs
    return without(docs, repeated, id_col).unionByName(_by_id(docs, repeated, id_col, "left_semi").dropDuplicates([id_col]))
