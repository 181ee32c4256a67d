"""N-gram Jaccard join: a blocked sparse matrix product of the document by n-gram incidence.

Two documents link when ``100 * intersection >= percent * union`` of their n-gram sets. The product
``A * A'`` is taken in three parts, each exact:

1. *Column sums in blocks.* One pass over the texts writes each step's n-gram hashes by bucket, in
   packed form (4 bytes each, and at most 4 for its document's number and count in that bucket). Buckets count in how many documents each column of A occurs and
   return, for each document, how many of its columns occur elsewhere. An overlap cannot exceed
   that number, so a document linked with any other has at least ``percent`` per cent of its set
   shared: all others leave here (hash collisions can only keep a document). Equal sets are told
   by a 128-bit digest and stand as one row of A from here on, so copies are never paired.
2. *Blocks.* Among the rows left, columns are ordered by rarity. Linked rows share one of the
   first ``n - ceil(percent * n / 100) + 1`` columns of each; rows that share such a column, directly
   or through others, are one block (connected components of rows and columns).
3. *Products.* Within a block, the rows' overlaps with one row are accumulated over an inverted
   index; pairs below the bounds of their sizes are discarded. Each row's product is taken with all
   rows after it, so that every link between unequal sets is found and counted for both its rows,
   weighted by their copies. No pair is written down, only the counts and the links that span the
   components. A block is cut into bands of set sizes, of which only neighbours can link, and bands
   of more rows than a chunk's into chunks that are taken by pairs, each pair of rows in one of them;
   components over all chunks join the spanning links.

Cases: null or empty texts have an empty set and no links; fewer than ``k`` words are one n-gram;
repeated ids and rows are rows of their own with the id's texts; very long texts are read whole, as a
step of their own; equally rare columns go by their hash; an empty table gives an empty result; other
columns, also of the result's names, are not read; a null id never names a component, but texts that
stand under null ids only link as others do.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import BROADCAST_IDS, MIX, SPACED, bounded, buckets, hashes, materialize, mixed, numbered, partitions, rolled, row_key, spread_join, steps, with_sums, words
from .graph import components

K, PERCENT = 5, 75
FINER = 2
#: Rows of a chunk at most; chunks that a band is cut into before they grow beyond SMALL rows.
CHUNK, SMALL, CHUNKS = 1024, 128, 64


def ngram_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each text, one text after the other, and where each begins."""
    off, tokens = words(texts, SPACED)
    h, n = hashes(tokens), len(texts)
    count = np.diff(off)
    grams = rolled(h, k)
    at = np.arange(len(grams))
    doc = np.searchsorted(off, at, side="right") - 1
    ok = at + k <= off[doc + 1] if len(at) else np.zeros(0, bool)
    doc, grams = doc[ok], grams[ok]
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):  # the whole sequence, told apart from n-grams by its length
        whole = np.concatenate([mixed(rolled(h[off[i] : off[i + 1]], int(count[i])) ^ np.uint64(int(count[i]) * int(MIX) % 2**64)) for i in short.tolist()])
        doc, grams = np.append(doc, short), np.append(grams, whole)
    order = np.lexsort((grams, doc))
    doc, grams = doc[order], grams[order]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (grams[1:] != grams[:-1])
    doc, grams = doc[first], grams[first]
    return grams, np.searchsorted(doc, np.arange(n + 1))


def _digests(grams: np.ndarray, at: np.ndarray) -> list[bytes]:
    return [xxhash.xxh3_128_digest(grams[a:b].tobytes()) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def pairs(docs: np.ndarray, counts: np.ndarray) -> bytes:
    """Documents of a step and a number for each, packed."""
    kind = "u2" if max(int(docs.max(initial=0)), int(counts.max(initial=0))) < 65536 else "u4"
    return kind.encode() + docs.astype(kind).tobytes() + counts.astype(kind).tobytes()


def unpaired(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(blob, blob[:2].decode(), offset=2).astype(np.int64)
    return both[: len(both) // 2], both[len(both) // 2 :]


def dealt(grams: np.ndarray, doc: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes, bytes]]:
    """A step's n-grams by bucket: the hashes by document (4 bytes each), and how many each document with one has there.

    There are no more rows, and no more documents in them, than n-grams, however many buckets there are.
    """
    bucket = (grams % np.uint64(buckets)).astype(np.int64)
    small = (grams // np.uint64(buckets)).astype(np.uint32)  # with the bucket, 32 bits and more
    order = np.argsort(bucket, kind="stable")
    bucket, small, doc = bucket[order], small[order], doc[order]
    run = np.ones(len(doc), bool)  # runs of a document in a bucket
    run[1:] = (bucket[1:] != bucket[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(run)
    count, of, whose = np.diff(np.append(at, len(doc))), bucket[at], doc[at]
    first = np.append(np.flatnonzero(np.append(True, of[1:] != of[:-1])), len(at)) if len(at) else np.zeros(1, np.int64)
    begins = np.append(at, len(doc))
    for i, j in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        yield int(of[i]), small[begins[i] : begins[j]].tobytes(), pairs(whose[i:j], count[i:j])


def _forward(docs: DataFrame, k: int, buckets: int) -> DataFrame:
    """Packed incidence: a row for each step and bucket that it has n-grams in, and one for the step's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "step", "hashes", "counts", "ids", "keys", "sizes", "digests"]
        for step, b in numbered(steps(batches, "text")):
            grams, at = ngram_sets(b.column("text"), k)
            rows = list(dealt(grams, np.repeat(np.arange(b.num_rows), np.diff(at)), buckets))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([step] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary()), *[pa.nulls(len(rows), t) for t in (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary()))]], names
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array([step % buckets], pa.int32()), pa.array([step]), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), *[pa.array([b.column(c).to_pylist()], pa.list_(pa.int64())) for c in ("doc_id", "key")], pa.array([np.diff(at)], pa.list_(pa.int64())), pa.array([_digests(grams, at)], pa.list_(pa.binary()))], names
            )

    return docs.mapInArrow(run, "bucket int, step long, hashes binary, counts binary, ids array<long>, keys array<long>, sizes array<long>, digests array<binary>")


def _count(t: pa.Table) -> pa.Table:
    """Within a bucket: for each step, how many n-grams of its documents occur in another document; documents and steps without any are left out."""
    own, head = t.column("hashes").to_pylist(), np.asarray(t.column("hashes").is_null())
    parts = [np.frombuffer(x, np.uint32) for x in own if x is not None]
    shared: list[bytes | None] = [None] * len(t)
    if parts:
        every = np.concatenate(parts)
        every.sort()
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        del every
        counts = t.column("counts").to_pylist()
        for i, part in zip(np.flatnonzero(~head).tolist(), parts, strict=True) if len(twice) else ():  # part by part, as a bucket is large
            place = np.minimum(np.searchsorted(twice, part), len(twice) - 1)
            common = np.zeros(len(part) + 1, np.int64)
            np.cumsum(twice[place] == part, out=common[1:])
            if common[-1]:
                docs, n = unpaired(counts[i])
                found = np.diff(common[np.append(0, np.cumsum(n))])
                some = found > 0
                shared[i] = pairs(docs[some], found[some])
    out = pa.table({"step": t.column("step"), "shared": pa.array(shared, pa.binary()), "ids": t.column("ids"), "keys": t.column("keys"), "sizes": t.column("sizes"), "digests": t.column("digests")})
    return out.filter(pa.array(head | np.array([x is not None for x in shared], bool)))


def _gather(t: pa.Table) -> pa.Table:
    """Within a step: each document's set size, digest and number of shared n-grams."""
    shared = t.column("shared").to_pylist()
    head = shared.index(None)
    ids, keys, sizes, digests = (t.column(c)[head] for c in ("ids", "keys", "sizes", "digests"))
    total = np.zeros(len(sizes), np.int64)
    for x in shared:
        if x is not None:
            docs, n = unpaired(x)
            total[docs] += n
    return pa.table({"doc_id": ids.values, "key": keys.values, "n": sizes.values, "digest": digests.values, "shared": pa.array(total)})


def incidence(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, key, n (set size), digest (of the set) and shared (an upper bound of its n-grams in other documents) for every row."""
    counted = _forward(docs, k, buckets(docs, "text", FINER * partitions(docs.sparkSession))).groupBy("bucket").applyInArrow(_count, "step long, shared binary, ids array<long>, keys array<long>, sizes array<long>, digests array<binary>")
    return counted.groupBy("step").applyInArrow(_gather, "doc_id long, key long, n long, digest binary, shared long")


def _sets(docs: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, "text"):
            grams, at = ngram_sets(b.column("text"), k)
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(_digests(grams, at), pa.binary()), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(grams.view(np.int64)))], ["key", "digest", "grams"])

    return docs.mapInArrow(run, "key long, digest binary, grams array<long>")


class Rows:
    """Sparse rows of a chunk and their products."""

    def __init__(self, ids: list[int], sets: list[np.ndarray], sides: np.ndarray | None, percent: int):
        self.ids, self.percent = np.array(ids), percent
        self.size = np.array([len(s) for s in sets])
        self.sides = sides
        columns, code = np.unique(np.concatenate(sets), return_inverse=True)
        self.of = np.split(code, np.cumsum(self.size)[:-1])
        by = np.argsort(code, kind="stable")
        self.index = np.split(np.repeat(np.arange(len(sets)), self.size)[by], np.searchsorted(code[by], np.arange(1, len(columns))))

    def near(self, i: int, left: np.ndarray) -> np.ndarray:
        """The rows in ``left`` (a mask) that link with row i."""
        n, size = int(self.size[i]), self.size
        ok = left & (100 * np.minimum(size, n) >= self.percent * np.maximum(size, n))
        if self.sides is not None:
            ok &= self.sides != self.sides[i]
        if not ok.any():
            return np.zeros(0, np.int64)
        met = np.concatenate([self.index[c] for c in self.of[i].tolist()])
        overlap = np.bincount(met, minlength=len(size))
        return np.flatnonzero(ok & (100 * overlap >= self.percent * (n + size - overlap)))

    def links(self, many: np.ndarray) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
        """Each row's links, counted by the ``many`` copies of the other row, and links that span the components."""
        n = len(self.ids)
        total, label, after, spanning = np.zeros(n, np.int64), np.arange(n), np.ones(n, bool), []
        for i in range(n):
            after[i] = False
            found = self.near(i, after)
            if not len(found):
                continue
            total[i] += many[found].sum()
            total[found] += many[i]
            names, at = np.unique(label[found], return_index=True)
            other = names != label[i]
            if other.any():
                spanning += [(int(self.ids[i]), int(self.ids[j])) for j in found[at[other]].tolist()]
                label[np.isin(label, names)] = label[i]
        return [(int(self.ids[k]), int(total[k])) for k in np.flatnonzero(total).tolist()], spanning


def _products(rows: DataFrame, percent: int) -> DataFrame:
    """(a, n, b) of the blocks: n links of a row a, or a spanning link (a, b); ``rows`` has block, left, right, side, row, many, grams and comes sorted by block."""

    def solve(block: list[tuple[int, int, int, np.ndarray]], pair: bool) -> pa.RecordBatch:
        counts, spanning = [], []
        if len(block) > 1:
            side, name, many, grams = zip(*block, strict=True)
            counts, spanning = Rows(list(name), list(grams), np.array(side) if pair else None, percent).links(np.array(many))
        a, n = [x for x, _ in counts + spanning], [x for _, x in counts] + [None] * len(spanning)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, n, [None] * len(counts) + [x for _, x in spanning])], ["a", "n", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block = None, []
        for b in batches:
            grams = b.column("grams")
            flat, ends = grams.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(grams.value_lengths().to_numpy(zero_copy_only=False)))
            names = [b.column(c).to_pylist() for c in ("block", "left", "right", "side", "row", "many")]
            done = []
            for i, (block_id, left, right, side, row, many) in enumerate(zip(*names, strict=True)):
                if (block_id, left, right) != key:
                    if key:
                        done.append(solve(block, key[1] != key[2]))
                    key, block = (block_id, left, right), []
                block.append((side, row, many, flat[ends[i] : ends[i + 1]]))
            if done:
                yield from pa.Table.from_batches(done).combine_chunks().to_batches()
        if key:
            yield solve(block, key[1] != key[2])

    return rows.mapInArrow(run, "a long, n long, b long")


def link_rows(sets: DataFrame, percent: int = PERCENT, chunk: int = CHUNK) -> DataFrame:
    """(a, n, b): links of each row of ``sets`` (row long, many long copies, grams array<long> distinct, not empty), by chunk and without its own copies, and links (a, b) that span the components."""
    sets = materialize(sets, "sets")
    flat = sets.select("row", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    often = flat.groupBy("gram").agg(F.count("*").alias("df")).filter("df > 1")
    met = with_sums(flat, often, "gram", "df").groupBy("row", "n").agg(F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("met"))
    # n - met columns occur in no other row and come first in the order
    need = F.ceil(F.col("n") * percent / 100)
    first = (F.col("n") - need + 1 - (F.col("n") - F.size("met"))).cast("int")
    prefix = met.filter(first > 0).select("row", F.explode(F.slice("met", 1, F.greatest(first, F.lit(1)))).alias("x")).select("row", F.col("x")["gram"].alias("gram"))
    prefix = materialize(prefix, "prefix")
    heads = prefix.groupBy("gram").agg(F.min("row").alias("head"), F.count("*").alias("many")).filter("many > 1")
    blocks = components(with_sums(prefix, heads, "gram", "many").select(F.col("head").alias("a"), F.col("row").alias("b")))
    dealt = _dealt(blocks, sets, percent, chunk).repartition("block", "left", "right").sortWithinPartitions("block", "left", "right", "row")
    return _products(dealt, percent)


def _dealt(blocks: DataFrame, sets: DataFrame, percent: int, chunk: int) -> DataFrame:
    """The rows of each product: block, left, right (chunks), side, row, many and grams.

    Sizes are cut into bands so wide that only rows of one band or of neighbouring ones can link. A
    band's rows (in chunks of even numbers) meet each other and the next band's rows (odd numbers).
    """
    width = math.log(100 / percent) * (1 + 1e-9) if percent < 100 else 1e-9
    sized = blocks.join(sets.select("row", F.size("grams").alias("n")), F.col("node") == F.col("row"))
    sized = materialize(sized.select("component", "row", F.floor(F.log("n") / width).alias("band")), "sized")
    rows = F.least(F.lit(chunk), F.greatest(F.lit(SMALL), F.ceil(F.count("*") / CHUNKS)))  # a chunk's rows
    counts = sized.groupBy("component", "band").agg(F.ceil(F.count("*") / rows).alias("chunks"))
    above = counts.select("component", (F.col("band") - 1).alias("band"), F.col("chunks").alias("above"))
    groups = materialize(counts.join(above, ["component", "band"], "left").select("component", "band", "chunks", F.coalesce("above", F.lit(0)).alias("above")), "bands")
    # a row goes to its own band's group, and to the group of the band below where that has rows
    placed = sized.select("component", "row", F.explode(F.array(F.struct(F.col("band").alias("group"), F.lit(0).alias("odd")), F.struct((F.col("band") - 1).alias("group"), F.lit(1).alias("odd")))).alias("x"))
    placed = placed.select("component", "row", F.col("x.group").alias("band"), F.col("x.odd").alias("odd"))
    few = groups.count() <= BROADCAST_IDS
    placed = placed.join(F.broadcast(groups) if few else groups, ["component", "band"])
    mine = F.pmod(F.xxhash64("row"), F.when(F.col("odd") == 0, F.col("chunks")).otherwise(F.col("above")))
    placed = placed.withColumn("mine", 2 * mine + F.col("odd"))
    evens = F.transform(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), lambda i: 2 * i)
    odds = F.when(F.col("above") > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.greatest("above", F.lit(1)) - 1), lambda i: 2 * i + 1)).otherwise(F.array().cast("array<long>"))
    others = F.when(F.col("odd") == 0, F.concat(evens, odds)).otherwise(evens)
    placed = placed.select("component", "row", "band", "mine", F.explode(others).alias("other"))
    # numbers of a group's chunks stand apart from those of the component's other groups
    low = F.col("mine") % 2 < F.col("other") % 2
    straight = low | ((F.col("mine") % 2 == F.col("other") % 2) & (F.col("mine") <= F.col("other")))
    number = lambda x: F.col("band") * (1 << 32) + x
    placed = placed.select(
        F.col("component").alias("block"), number(F.when(straight, F.col("mine")).otherwise(F.col("other"))).alias("left"), number(F.when(straight, F.col("other")).otherwise(F.col("mine"))).alias("right"),
        F.when(straight, 0).otherwise(1).alias("side"), "row",
    )
    return placed.join(sets, "row").select("block", "left", "right", "side", "row", "many", "grams")


def _linked(rows: DataFrame, k: int, percent: int, chunk: int) -> DataFrame:
    """doc_id, n (set size), key, n_links, and component_id and first_key (the component's first row: least id, nulls last, then least key) for every row.

    ``rows`` has doc_id, text and key, which unequal rows do not share. All three are null for an empty set.
    """
    every = materialize(incidence(rows, k), "incidence")
    own = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    classes = every.filter("n > 0").groupBy("digest").agg(F.min(own).alias("first"), F.count("*").alias("many"), F.max("n").alias("n"), F.max("shared").alias("shared"))
    # equal sets count each other; only what is shared with unequal sets can make further links, so this bound keeps more than it must
    likely = materialize(classes.filter(F.col("shared") * 100 >= F.col("n") * percent).select("digest", "first", "many"), "likely")
    few = likely.count() <= BROADCAST_IDS
    wanted = likely.select(F.col("first.key").alias("of_key"), F.col("digest").alias("wanted"), "many")
    wanted = F.broadcast(wanted) if few else wanted
    texts = rows.join(wanted, F.col("key") == F.col("of_key")).select("key", "text")
    sets = _sets(texts, k)
    sets = sets.join(wanted, (F.col("key") == F.col("of_key")) & (F.col("digest") == F.col("wanted"))).select("digest", "many", "grams")
    sets = sets.dropDuplicates(["digest"]).select(F.xxhash64("digest").alias("row"), "many", "grams")
    met = materialize(link_rows(sets, percent, chunk), "met")
    found = components(met.filter("b IS NOT NULL").select("a", "b")).withColumnsRenamed({"node": "of"})
    counts = met.filter("n IS NOT NULL").groupBy(F.col("a").alias("linked")).agg(F.sum("n").alias("links"))
    # a component's rows are classes; its name is the least id of all their documents. Classes of one row without links name themselves
    named = likely.select("digest", "first", "many", F.xxhash64("digest").alias("row")).join(found, F.col("row") == F.col("of"), "left").join(counts, F.col("row") == F.col("linked"), "left")
    named = materialize(named.filter("many > 1 OR links > 0").select("digest", "first", "row", (F.col("many") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component"), "named")
    least = named.filter("component IS NOT NULL").groupBy("component").agg(F.min("first").alias("least"))
    named = spread_join(named, least, "component", F.col("row")).select("digest", "n_links", F.coalesce("least", "first").alias("least"))
    every = every.withColumn("own", F.when(F.col("n") > 0, own)).withColumn("digest", F.when(F.col("n") > 0, F.col("digest")))
    out = spread_join(every, named, "digest", F.col("key")).withColumn("least", F.coalesce("least", "own"))
    return out.select("doc_id", "n", "key", F.when(F.col("n") > 0, F.coalesce("n_links", F.lit(0))).alias("n_links"), F.col("least.doc_id").alias("component_id"), F.col("least.key").alias("first_key"))


def _columns(id_col: str, text_col: str) -> tuple[Column, Column]:
    return F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, k: int = K, percent: int = PERCENT, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (the component's first id) and n_links (other rows that link with it) for every row of ``docs``."""
    rows = bounded(docs).select(*_columns(id_col, text_col))
    out = _linked(rows.withColumn("key", row_key(F.col("doc_id"), F.col("text"))), k, percent, chunk)
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def groups(docs: DataFrame, key_col: str, id_col: str = "doc_id", text_col: str = "text", *, k: int = K, percent: int = PERCENT, chunk: int = CHUNK) -> DataFrame:
    """key and first_key (that of its component's first row, null for an empty set) for every row of ``docs``; rows that share a key must be equal."""
    return _linked(bounded(docs).select(*_columns(id_col, text_col), F.col(key_col).alias("key")), k, percent, chunk).select("key", "first_key")
