"""Embedding near-duplicates by E8 lattice hashing with exact cosines.

Each unit vector is projected at random to ``blocks`` times 8 dimensions in each of several tables,
shifted, and decoded to its nearest point of the lattice E8; the points, with the label, are its
cell. It also probes the next nearest lattice points (from both cosets, and by flipping the
coordinates that lie worst). Vectors meet in a cell if one lives there and the other lives there
or probes it; their cosine, in double precision, decides. A pair counts at the first cell at which
it meets only, so each vector's links are counted without writing pairs down, and a spanning set of
links goes on to the components.

Equal vectors of a label stand as one with a multiplicity. Cells with one visitor are left before
any vector moves. Vectors move as they came (4 bytes a component where that is exact) without their
cells, which are computed again for the few that link. A cell of more than ``CHUNK`` visitors is cut
into chunks that are taken by pairs, whole. ``blocks`` and the number of tables follow from the
largest label's rows, so that cells do not fill up as the data grows; all rows are in the index. Recall
at the threshold itself, measured against brute force, is over 0.99 with one and two blocks and over
0.98 with three (``tests/llm/test_joins.py``); closer pairs are missed less.

Cases: vectors that are null, zero, or hold null or non-finite components, and rows with a null
label, link with nothing; vectors of other lengths than the most frequent one meet only their
likes (they are hashed by length); repeated ids are rows of their own that share a name; vectors of any
length are taken whole; an empty table gives an empty result; other columns, also of the result's
names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import bounded, materialize, spread_join, with_sums
from .graph import components

WIDTH, PROBES, CHUNK, LEAST = 1.5, 3, 1024, 0.93
#: Chance that two unlike vectors meet in a table of one block, and tables needed for a recall over 0.99 by blocks (simulated).
MEETING, TABLES = 0.00175, (6, 18, 54)
#: Chance meetings for each vector and table at most, by choice of ``blocks``.
CROWD = 64


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum."""
    r = np.rint(x)
    e = x - r
    i, k = np.arange(len(x)), np.abs(e).argmax(axis=1)
    other = r.copy()
    other[i, k] += np.where(e[i, k] >= 0, 1, -1)
    return np.where((r.sum(axis=1) % 2 != 0)[:, None], other, r)


def lattice_points(x: np.ndarray, probes: int) -> np.ndarray:
    """For each row, its nearest E8 point and the next ``probes`` candidates, doubled to integers; shape (rows, 1 + probes, 8)."""
    found = []
    for coset in (0.0, 0.5):
        base = nearest_d8(x - coset) + coset
        found.append(base)
        e = x - base
        worst, i = np.argsort(-np.abs(e), axis=1)[:, :3], np.arange(len(x))
        for pair in ((0, 1), (0, 2), (1, 2)):
            z = base.copy()
            for m in pair:
                z[i, worst[:, m]] += np.where(e[i, worst[:, m]] >= 0, 1, -1)
            found.append(z)
    every = np.stack(found, axis=1)
    order = np.argsort(((every - x[:, None]) ** 2).sum(axis=2), axis=1, kind="stable")[:, : probes + 1]
    return np.rint(np.take_along_axis(every, order[:, :, None], axis=1) * 2).astype(np.int64)


def cells(units: np.ndarray, labels: np.ndarray, tables: int, blocks: int, seed: int = 11) -> np.ndarray:
    """Cell keys, shape (rows, tables, 1 + probes): where a vector lives, then where it looks."""
    n, dim = units.shape
    rng = np.random.RandomState(seed + dim)
    factor = np.frombuffer(rng.bytes(8 * (8 * blocks + 1)), np.uint64) | np.uint64(1)
    out = []
    for t in range(tables):
        own = []
        for _ in range(blocks):
            x = units @ rng.randn(dim, 8) / WIDTH + rng.rand(8) * 2
            own.append(lattice_points(x, PROBES))
        points = []
        for b in range(blocks):
            for p in range(PROBES + 1) if b == 0 else range(1, PROBES + 1):
                points.append(np.concatenate([own[k][:, p if k == b else 0] for k in range(blocks)], axis=1))
        points = np.stack(points, axis=1).view(np.uint64)
        h = (points * factor[:-1]).sum(axis=2) + (labels.astype(np.int64).view(np.uint64) * factor[-1])[:, None]
        h = (h ^ (h >> np.uint64(29)) ^ np.uint64(t * 0x1F3D5B79)) * np.uint64(0xBF58476D1CE4E5B9)
        out.append(h ^ (h >> np.uint64(32)))
    return np.stack(out, axis=1).view(np.int64)


def _classes(rows: DataFrame) -> DataFrame:
    """vec_id, class (a hash of label and components; null if the row cannot link), label and packed vector of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, packed = [], []
            for v, label in zip(b.column("v").to_pylist(), b.column("label").to_pylist(), strict=True):
                key = blob = None
                if v and label is not None and all(x is not None and math.isfinite(x) for x in v):
                    a = np.array(v, np.float64) + 0.0  # one zero
                    if np.any(a):
                        key = int.from_bytes(xxhash.xxh64_digest(np.int64(label).tobytes() + a.tobytes()), "little", signed=True)
                        blob = pack(a)
                keys.append(key)
                packed.append(blob)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(keys, pa.int64()), b.column("label"), pa.array(packed, pa.binary())], ["vec_id", "class", "label", "packed"])

    return rows.mapInArrow(run, "vec_id long, class long, label long, packed binary")


def pack(a: np.ndarray) -> bytes:
    """A vector's bytes: 4 a component if that is exact, else 8; the first byte tells."""
    with np.errstate(over="ignore"):
        short = a.astype(np.float32)
    return b"f" + short.tobytes() if (short == a).all() else b"d" + a.tobytes()


def units(blobs: list[bytes]) -> dict[int, tuple[list[int], np.ndarray]]:
    """Unit vectors of packed ones, by length: their places and rows."""
    rows: dict[int, tuple[list, list]] = {}
    for i, blob in enumerate(blobs):
        a = np.frombuffer(blob, np.float32 if blob[:1] == b"f" else np.float64, offset=1).astype(np.float64)
        at, found = rows.setdefault(len(a), ([], []))
        at.append(i)
        found.append(a)
    out = {}
    for dim, (at, found) in rows.items():
        a = np.array(found)
        a /= np.abs(a).max(axis=1)[:, None]
        out[dim] = at, a / np.sqrt((a * a).sum(axis=1))[:, None]
    return out


def _hashed(classes: DataFrame, tables: int, blocks: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            labels, keys = b.column("label").to_numpy(zero_copy_only=False), [None] * b.num_rows
            for at, unit in units(b.column("packed").to_pylist()).values():
                for i, k in zip(at, cells(unit, labels[at], tables, blocks).reshape(len(at), -1).tolist(), strict=True):
                    keys[i] = k
            yield pa.RecordBatch.from_arrays([b.column("class"), pa.array(keys, pa.list_(pa.int64()))], ["class", "cells"])

    return classes.mapInArrow(run, "class long, cells array<long>")


def _meet(key: tuple, block: list, tables: int, blocks: int, least: float) -> tuple[list, list]:
    """Link counts and spanning links of the pairs that meet in this cell first. block: (side, lives, class, many, label, packed)."""
    table, cell, pair = key[0], key[1], key[2] != key[3]
    counts, links = [], []
    for at, unit in units([x[5] for x in block]).values():
        if len(at) < 2:
            continue
        side, lives, name, many, label = (np.array([block[k][i] for k in at]) for i in range(5))
        lives = lives.astype(bool)
        i, j = np.nonzero((unit @ unit.T >= least) & (lives[:, None] | lives[None, :]) & (label[:, None] == label[None, :]))
        ok = i < j
        if pair:
            ok &= side[i] != side[j]
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        own = np.unique(np.concatenate([i, j]))
        keys = cells(unit[own], label[own], tables, blocks)
        a_of, b_of = np.searchsorted(own, i), np.searchsorted(own, j)
        met = np.zeros(len(i), bool)  # at an earlier table, or at a lesser cell of this one
        for t in range(table + 1):
            a, b = keys[a_of, t, 0], keys[b_of, t, 0]
            at_a, at_b = (keys[b_of, t] == a[:, None]).any(axis=1), (keys[a_of, t] == b[:, None]).any(axis=1)
            met |= (at_a | at_b) if t < table else ((at_a & (a < cell)) | (at_b & (b < cell)))
        i, j = i[~met], j[~met]
        total = np.bincount(i, weights=many[j], minlength=len(at)) + np.bincount(j, weights=many[i], minlength=len(at))
        counts += [(int(name[k]), int(total[k])) for k in np.flatnonzero(total).tolist()]
        mark = np.arange(len(at))  # least place reachable
        while True:
            new = mark.copy()
            np.minimum.at(new, i, mark[j])
            np.minimum.at(new, j, mark[i])
            new = new[new]
            if (new == mark).all():
                break
            mark = new
        links += [(int(name[k]), int(name[mark[k]])) for k in np.flatnonzero(mark != np.arange(len(at))).tolist()]
    return counts, links


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", *, least: float = LEAST, chunk: int = CHUNK, blocks: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors``; ``blocks`` is chosen by the rows where it is not given."""
    rows = bounded(vectors).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).cast("long").alias("label"))
    every = materialize(_classes(rows), "vectors")
    valid = every.filter(F.col("class").isNotNull())
    classes = materialize(valid.groupBy("class").agg(F.count("*").alias("many"), F.min("vec_id").alias("first"), F.first("label").alias("label"), F.first("packed").alias("packed")), "classes")
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    blocks = blocks or next((b for b in range(1, len(TABLES)) if most * MEETING**b <= CROWD), len(TABLES))
    tables, per = TABLES[blocks - 1], 1 + PROBES * blocks
    spots = materialize(_hashed(classes.select("class", "label", "packed"), tables, blocks), "cells")
    spots = spots.select("class", F.posexplode("cells").alias("at", "cell")).select("class", F.floor(F.col("at") / per).cast("int").alias("table"), (F.col("at") % per == 0).cast("int").alias("lives"), "cell")
    busy = spots.groupBy("table", "cell").agg(F.count("*").alias("n"), F.sum("lives").alias("residents")).filter("n > 1 AND residents > 0").select("table", "cell", "n", F.ceil(F.col("n") / chunk).alias("chunks"))
    placed = with_sums(spots.withColumn("spot", F.struct("table", "cell")), busy.select(F.struct("table", "cell").alias("spot"), "n", "chunks"), "spot", "n").withColumn("mine", F.pmod(F.xxhash64("class"), F.col("chunks")))
    placed = placed.select("class", "table", "cell", "lives", "mine", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("other"))
    placed = placed.select("class", "table", "cell", "lives", F.least("mine", "other").alias("left"), F.greatest("mine", "other").alias("right"), (F.col("mine") > F.col("other")).cast("int").alias("side"))
    dealt = placed.join(classes.select("class", "many", "label", "packed"), "class").repartition("table", "cell", "left", "right").sortWithinPartitions("table", "cell", "left", "right", "class")
    columns = ("table", "cell", "left", "right", "side", "lives", "class", "many", "label", "packed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block = None, []

        def out(found: tuple[list, list]) -> pa.RecordBatch:
            counts, links = found
            n, m = [None] * len(counts), [None] * len(links)
            return pa.RecordBatch.from_arrays([pa.array([c for c, _ in counts] + [a for a, _ in links], pa.int64()), pa.array([x for _, x in counts] + m, pa.int64()), pa.array(n + [b for _, b in links], pa.int64())], ["class", "n", "other"])

        for b in batches:
            for x in zip(*[b.column(c).to_pylist() for c in columns], strict=True):
                if x[:4] != key:
                    if len(block) > 1:
                        yield out(_meet(key, block, tables, blocks, least))
                    key, block = x[:4], []
                block.append(x[4:])
        if len(block) > 1:
            yield out(_meet(key, block, tables, blocks, least))

    met = materialize(dealt.select(*columns).mapInArrow(run, "class long, n long, other long"), "met")
    counts = met.filter("n IS NOT NULL").groupBy(F.col("class").alias("of")).agg(F.sum("n").alias("n"))
    found = components(met.filter("other IS NOT NULL").select(F.col("class").alias("a"), F.col("other").alias("b")))
    named = classes.select("class", "many", "first").join(found, F.col("class") == F.col("node"), "left").join(counts, F.col("class") == F.col("of"), "left")
    named = materialize(named.select("class", "first", "component", (F.col("many") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")), "named")
    least_id = named.filter("component IS NOT NULL").groupBy("component").agg(F.min("first").alias("least_id"))
    named = spread_join(named, least_id, "component", F.col("class")).select("class", "n_links", F.coalesce("least_id", "first").alias("component_id"))
    out = spread_join(every.select("vec_id", "class"), named, "class", F.col("vec_id"))
    component = F.coalesce(F.col("component_id"), F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))
