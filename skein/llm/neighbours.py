"""Approximate nearest neighbours by largest inner product: an NN-descent graph and greedy search in it.

**Graph.** Inner products become distances: with the greatest norm M, each vector gets one more coordinate
sqrt(M^2 - |x|^2), so that all have norm M. A first graph comes from ``tables`` of blocks (signs of random
projections against medians of a bounded sample; full blocks are cut into chunks), within which each vector keeps
its ``degree`` nearest. NN-descent then improves it: each vector's neighbours, and some that have it as a neighbour, meet
at it by a Spark join, and each of them is offered the others that are nearer than its farthest neighbour; pairs in which
neither edge is new are not looked at again. Rounds end when less than ``settled`` of all edges change.

**Search.** A query opens the best ``step`` of its best ``beam`` vectors that are not opened yet; their neighbours, both ways,
that it has not seen are fetched and scored, and so on until all of its beam are opened. It starts
from its own vector, where that is in the index, and from ``ENTRIES`` vectors: half those with the greatest
norm, half by hash. Every hop is joins of small rows; finished queries leave the loop.

Equal vectors stand as one node (named by a 64-bit hash of the components), however many rows have them. Graph and search use
half-precision components with a scale for each vector; the beam's final scores are sums of the original components' products,
rounded once. The index holds every row; the sample for medians has ``SAMPLE`` vectors. Recall against brute force is in
``tests/llm/test_vectors.py`` and README: at least 0.9.

Cases: vectors that are null, zero, or hold null or non-finite components take no part, as query or candidate; a query
meets vectors of its own length only; with fewer candidates it gets all it reaches, which is all in a table of
up to ``BLOCK`` vectors; repeated rows are candidates each, under their own ids, and a query leaves out one row with its id and vector;
rows without an id are no queries, and as candidates come last at ties; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import bounded, discard, materialize, spread_join, with_sums, written
from .lattice import _classes

DEGREE, REVERSE, TABLES, BLOCK, SETTLED = 32, 24, 12, 2048, 0.05
BEAM, STEP, ENTRIES, SAMPLE = 80, 27, 64, 4096
#: Rows of a table with a list of results each that may be broadcast.
BROADCAST_LISTS = 20_000
#: Vectors that one product takes at a time.
SLAB = 512


class Index(NamedTuple):
    """rows: vec_id and class; vectors: class and packed; nodes: class and code (half precision); graph: class and near (neighbours both ways); entries: where searches start."""

    rows: DataFrame
    vectors: DataFrame
    nodes: DataFrame
    graph: DataFrame
    entries: list[tuple[int, bytes]]


def exact(packed: bytes) -> np.ndarray:
    """The components of a packed vector, in double precision."""
    return np.frombuffer(packed, np.float32 if packed[:1] == b"f" else np.float64, offset=1).astype(np.float64)


def encode(x: np.ndarray, further: float) -> bytes:
    """Scale, further coordinate (both 4 bytes), and components by the scale in half precision."""
    scale = float(np.abs(x).max()) or 1.0
    return np.array([scale, further], np.float32).tobytes() + (x / scale).astype(np.float16).tobytes()


def decode(codes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Components (rows) and further coordinates of codes of one length."""
    raw = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)
    head = raw[:, :8].copy().view(np.float32)
    return raw[:, 8:].copy().view(np.float16).astype(np.float32) * head[:, :1], head[:, 1]


def closeness(x: np.ndarray, f: np.ndarray, y: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Minus the squared distances of the extended vectors."""
    return 2 * (x @ np.swapaxes(y, -1, -2)) - (x * x).sum(-1)[..., :, None] - (y * y).sum(-1)[..., None, :] - (f[..., :, None] - g[..., None, :]) ** 2


def best(owner: np.ndarray, other: np.ndarray, score: np.ndarray, most: int, known: np.ndarray | None = None) -> np.ndarray:
    """Places of the ``most`` best different others of each owner, by owner, best first; of equal pairs a known one counts, else the best."""
    o = np.lexsort((-score, *([~known] if known is not None else []), other, owner))
    a, b = owner[o], other[o]
    first = np.ones(len(o), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    o = o[first]
    o = o[np.lexsort((-score[o], owner[o]))]
    a = owner[o]
    return o[np.arange(len(a)) - np.searchsorted(a, a) < most]


def _lists(owner: np.ndarray, count: int, *values: pa.Array) -> list[pa.Array]:
    """List arrays of values that are sorted by owner (0 to count - 1)."""
    ends = pa.array(np.searchsorted(owner, np.arange(count + 1)), pa.int32())
    return [pa.ListArray.from_arrays(ends, v) for v in values]


def _flat(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The row of each value of a list column, and the values; a null list has none."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(sizes)), sizes), column.flatten()


def _numpy(a: pa.Array) -> np.ndarray:
    return a.to_numpy(zero_copy_only=False)


def _by_length(codes: list[bytes]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, c in enumerate(codes):
        out.setdefault(len(c), []).append(i)
    return out


# the first graph


def _nodes(vectors: DataFrame) -> DataFrame:
    """class and code of every vector, with its further coordinate by the greatest norm."""

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([float(np.dot(a := exact(p), a)) for p in b.column("packed").to_pylist()], pa.float64())], ["n"])

    most = vectors.select("packed").mapInArrow(norms, "n double").agg(F.max("n")).first()[0] or 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = [encode(a, math.sqrt(max(most - float(np.dot(a, a)), 0.0))) for a in map(exact, b.column("packed").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("class"), pa.array(codes, pa.binary())], ["class", "code"])

    return materialize(vectors.mapInArrow(run, "class long, code binary"), "nodes")


def _projections(length: int, tables: int, bits: int) -> np.ndarray:
    return np.random.RandomState(17 + length).randn(tables * bits, length).astype(np.float32)


def _spots(nodes: DataFrame, tables: int, bits: int) -> DataFrame:
    """class, table and block of every vector in every table."""
    cuts = {}
    sample = [bytes(r[0]) for r in nodes.orderBy(F.xxhash64("class", F.lit(5))).limit(SAMPLE).select("code").collect()]
    for size, at in _by_length(sample).items():
        x = decode([sample[i] for i in at])[0]
        cuts[size] = np.median(x @ _projections(x.shape[1], tables, bits).T, axis=0) if bits else np.zeros(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = b.column("code").to_pylist()
            out = np.zeros((len(codes), tables), np.int64)
            for size, at in _by_length(codes).items():
                x = decode([codes[i] for i in at])[0]
                signs = (x @ _projections(x.shape[1], tables, bits).T > cuts.get(size, 0.0)).reshape(len(at), tables, bits)
                out[at] = (signs << np.arange(bits)).sum(axis=2) * 1_000_003 + size
            yield pa.RecordBatch.from_arrays([b.column("class"), *_lists(np.repeat(np.arange(len(codes)), tables), len(codes), pa.array(out.reshape(-1)))], ["class", "blocks"])

    found = materialize(nodes.mapInArrow(run, "class long, blocks array<long>"), "blocks")
    return found.select("class", F.posexplode("blocks").alias("table", "block"))


def _first_graph(nodes: DataFrame, count: int, degree: int, tables: int, block: int) -> DataFrame:
    bits = max(0, min(40, math.ceil(math.log2(max(count / block, 1)))))
    spots = _spots(nodes, tables if bits else 1, bits).withColumn("spot", F.struct("table", "block"))
    full = spots.groupBy("spot").agg(F.count("*").alias("n")).withColumn("chunks", F.ceil(F.col("n") / (2 * block)))
    dealt = with_sums(spots, full, "spot", "n").select("class", "spot", F.pmod(F.xxhash64("class", "table"), F.col("chunks")).alias("chunk"))
    blocks = dealt.join(nodes, "class").groupBy("spot", "chunk").agg(F.collect_list(F.struct("class", "code")).alias("found")).select("found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                found = b.column("found").slice(row, 1).flatten()
                names, (x, f) = _numpy(found.field("class")), decode(found.field("code").to_pylist())
                most = min(degree, len(names) - 1)
                for at in range(0, len(names) if most else 0, SLAB):
                    near = closeness(x[at : at + SLAB], f[at : at + SLAB], x, f)
                    near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
                    top = np.argpartition(-near, most - 1, axis=1)[:, :most]
                    owner = np.repeat(np.arange(len(near)), most)
                    lists = _lists(owner, len(near), pa.array(names[top].reshape(-1)), pa.array(np.take_along_axis(near, top, 1).reshape(-1)))
                    yield pa.RecordBatch.from_arrays([pa.array(names[at : at + SLAB]), *lists], ["class", "others", "scores"])

    found = bounded(blocks).mapInArrow(run, "class long, others array<long>, scores array<float>")
    offers = found.groupBy("class").agg(F.flatten(F.collect_list("others")).alias("others"), F.flatten(F.collect_list("scores")).alias("scores"))  # a list from each table
    start = nodes.select("class", "code", F.array().cast("array<long>").alias("near"), F.array().cast("array<float>").alias("nearness"))
    return _merged(start, offers, degree)


def _merged(graph: DataFrame, offers: DataFrame, degree: int) -> DataFrame:
    """class, code, near, nearness and fresh: each vector's best of its neighbours and of what it is offered; fresh tells the new ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            old, near = _flat(b.column("near"))
            new, others = _flat(b.column("others"))
            owner, other = np.concatenate([old, new]), np.concatenate([_numpy(near), _numpy(others)]).astype(np.int64)
            score = np.concatenate([_numpy(b.column(c).flatten()) for c in ("nearness", "scores")]).astype(np.float32)
            known = np.arange(len(owner)) < len(old)
            at = best(owner, other, score, degree, known)
            lists = _lists(owner[at], b.num_rows, pa.array(other[at]), pa.array(score[at]), pa.array(~known[at]))
            yield pa.RecordBatch.from_arrays([b.column("class"), b.column("code"), *lists], ["class", "code", "near", "nearness", "fresh"])

    return bounded(graph.join(offers, "class", "left")).select("class", "code", "near", "nearness", "others", "scores").mapInArrow(run, "class long, code binary, near array<long>, nearness array<float>, fresh array<boolean>")


# NN-descent


def _both_ways(graph: DataFrame, reverse: int, seed: int) -> DataFrame:
    """at, other and fresh: each vector's neighbours, and ``reverse`` at most, by hash, of those whose neighbour it is."""
    edges = graph.select("class", F.explode(F.arrays_zip("near", "fresh")).alias("e")).select(F.col("class").alias("at"), F.col("e.near").alias("other"), F.col("e.fresh").alias("fresh"))
    dealt = Window.partitionBy("at").orderBy("order", "other")
    back = edges.select(F.col("other").alias("at"), F.col("at").alias("other"), "fresh", F.xxhash64("at", "other", F.lit(seed)).alias("order"))
    some = back.withColumn("rank", F.row_number().over(dealt)).filter(F.col("rank") <= reverse).select("at", "other", "fresh")
    return edges.unionByName(some).groupBy("at", "other").agg(F.max("fresh").alias("fresh"))


def _offers(graph: DataFrame, degree: int, reverse: int, seed: int) -> DataFrame:
    """class, others and scores: what vectors that meet at a common neighbour have to offer each other."""
    last = F.when(F.size("near") >= degree, F.element_at("nearness", -1)).otherwise(F.lit(float("-inf")).cast("float"))
    known = graph.select(F.col("class").alias("other"), "code", last.alias("least"))
    met = _both_ways(graph, reverse, seed).join(known, "other").groupBy("at").agg(F.collect_list(F.struct("other", "fresh", "least", "code")).alias("met"))  # degree + reverse at most
    met = met.filter(F.exists("met", lambda x: x["fresh"]) & (F.size("met") > 1)).select("met")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, found = _flat(b.column("met"))
            names, fresh, least, codes = _numpy(found.field("other")), _numpy(found.field("fresh")).astype(bool), _numpy(found.field("least")), found.field("code").to_pylist()
            place = np.arange(len(row)) - np.searchsorted(row, row)
            parts = []
            for at in _by_length(codes).values():  # those that meet have one length
                at = np.array(at)
                x, f = decode([codes[i] for i in at])
                rows, mine = np.unique(row[at], return_inverse=True)
                slabs = max(1, SLAB * 16 // (int(place[at].max()) + 1))
                for low in range(0, len(rows), slabs):
                    here = np.flatnonzero((mine >= low) & (mine < low + slabs))
                    i, j, width = mine[here] - low, place[at[here]], int(place[at[here]].max()) + 1
                    grid = np.full((int(i.max()) + 1, width), -1)
                    grid[i, j] = here
                    own = at[grid]
                    near = closeness(x[grid], f[grid], x[grid], f[grid])
                    ok = (near > least[own][:, :, None]) & (fresh[own][:, :, None] | fresh[own][:, None, :]) & (grid >= 0)[:, :, None] & (grid >= 0)[:, None, :]
                    ok[:, np.arange(width), np.arange(width)] = False
                    g, a, c = np.nonzero(ok)
                    parts.append((names[own[g, a]], names[own[g, c]], near[g, a, c]))
            if parts:
                a, c, s = (np.concatenate(x) for x in zip(*parts, strict=True))
                at = best(a, c, s, degree)
                yield pa.RecordBatch.from_arrays([pa.array(a[at]), pa.array(c[at]), pa.array(s[at].astype(np.float32))], ["class", "other", "score"])

    rows = bounded(met).mapInArrow(run, "class long, other long, score float").groupBy("class", "other").agg(F.max("score").alias("score"))
    top = Window.partitionBy("class").orderBy(F.desc("score"), "other")
    rows = rows.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= degree)
    return rows.groupBy("class").agg(F.collect_list(F.struct("other", "score")).alias("x")).select("class", F.col("x.other").alias("others"), F.col("x.score").alias("scores"))


def build(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, degree: int = DEGREE, reverse: int = REVERSE, tables: int = TABLES, block: int = BLOCK, settled: float = SETTLED) -> Index:
    """The index of all rows of ``vectors``."""
    rows = bounded(vectors).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), F.lit(0).cast("long").alias("label"))
    every = materialize(_classes(rows).filter(F.col("class").isNotNull()).drop("label"), "vectors")
    distinct = materialize(every.groupBy("class").agg(F.first("packed").alias("packed")), "classes")
    nodes = _nodes(distinct)
    count = nodes.count()
    graph, place = written(_first_graph(nodes, count, degree, tables, block), "graph")
    seed = 0
    while count > block:  # within one block the graph is complete
        seed += 1
        after, path = written(_merged(graph.drop("fresh"), _offers(graph, degree, reverse, seed), degree), "graph")
        discard(vectors.sparkSession, place)
        graph, place = after, path
        if graph.agg(F.sum(F.size(F.filter("fresh", lambda x: x)))).first()[0] <= settled * count * degree:
            break
    near = materialize(_both_ways(graph, reverse, 0).groupBy("at").agg(F.collect_list("other").alias("near")).withColumnRenamed("at", "class"), "near")  # degree + reverse at most
    discard(vectors.sparkSession, place)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("class"), b.column("packed"), pa.array([float(np.dot(a := exact(p), a)) for p in b.column("packed").to_pylist()], pa.float64())], ["class", "packed", "norm"])

    normed = distinct.mapInArrow(sizes, "class long, packed binary, norm double")
    some = [*normed.orderBy(F.desc("norm"), "class").limit(ENTRIES // 2).collect(), *normed.orderBy(F.xxhash64("class", F.lit(3))).limit(ENTRIES // 2).collect()]
    return Index(every.select("vec_id", "class"), distinct, nodes, near, sorted({r["class"]: bytes(r["packed"]) for r in some}.items()))


# greedy search

STATE = "q long, packed binary, pool array<long>, scores array<float>, opened array<boolean>, frontier array<long>, seen array<long>"


def _state(parts: list[tuple], names: pa.Array, packed: pa.Array, seen: pa.Array | None, step: int) -> pa.RecordBatch:
    """A state row for each query from its pool (ids, scores, opened): the best ``step`` that are not opened are the next frontier, and opened then."""
    pool, scores, opened, frontier = [], [], [], []
    for ids, score, done in parts:
        next_ = np.flatnonzero(~done)[:step]
        frontier.append(ids[next_])
        done = done.copy()
        done[next_] = True
        pool.append(ids)
        scores.append(score)
        opened.append(done)
    pool = pa.array(pool, pa.list_(pa.int64()))
    columns = [names, packed, pool, pa.array(scores, pa.list_(pa.float32())), pa.array(opened, pa.list_(pa.bool_())), pa.array(frontier, pa.list_(pa.int64())), pool if seen is None else seen]
    return pa.RecordBatch.from_arrays(columns, ["q", "packed", "pool", "scores", "opened", "frontier", "seen"])


def search(index: Index, wanted: DataFrame, k: int, *, beam: int = BEAM, step: int = STEP) -> DataFrame:
    """q, class and score of the ``k`` best vectors found for each query of ``wanted`` (q, packed, and start: a class or null).

    Fewer than ``beam`` can be asked for. Scores are in double precision on the original components.
    """
    beam, entries = max(beam, k), index.entries

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = []
            for p, own in zip(b.column("packed").to_pylist(), b.column("start").to_pylist(), strict=True):
                x = exact(p)
                found = {c: float(np.dot(x, y)) for c, e in entries if len(y := exact(e)) == len(x)}
                if own is not None:
                    found[own] = float(np.dot(x, x))
                ids, score = np.array(list(found), np.int64), np.array(list(found.values()), np.float32)
                o = np.argsort(-score, kind="stable")[:beam]
                parts.append((ids[o], score[o], np.zeros(len(o), bool)))
            yield _state(parts, b.column("q"), b.column("packed"), None, step)

    def further(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, found = _flat(b.column("found"))
            ends = np.searchsorted(row, np.arange(b.num_rows + 1))
            names, codes = _numpy(found.field("class")), found.field("code").to_pylist()
            parts = []
            for i, (p, ids, score, opened) in enumerate(zip(*(b.column(c).to_pylist() for c in ("packed", "pool", "scores", "opened")), strict=True)):
                ids, score, opened = np.array(ids, np.int64), np.array(score, np.float32), np.array(opened, bool)
                if ends[i + 1] > ends[i]:
                    new = decode(codes[ends[i] : ends[i + 1]])[0] @ exact(p).astype(np.float32)
                    ids, score, opened = np.concatenate([ids, names[ends[i] : ends[i + 1]]]), np.concatenate([score, new]), np.concatenate([opened, np.zeros(len(new), bool)])
                    o = np.argsort(-score, kind="stable")[:beam]
                    ids, score, opened = ids[o], score[o], opened[o]
                parts.append((ids, score, opened))
            yield _state(parts, b.column("q"), b.column("packed"), b.column("seen"), step)

    spark, done = wanted.sparkSession, []
    state, place = written(bounded(wanted).select("q", "packed", "start").mapInArrow(start, STATE), "search")
    while True:
        done.append(materialize(state.filter(F.size("frontier") == 0).select("q", "packed", "pool"), "found"))
        active = state.filter(F.size("frontier") > 0)
        if active.isEmpty():
            break
        opened = active.select("q", F.explode("frontier").alias("class")).join(index.graph, "class")
        reached = opened.groupBy("q").agg(F.flatten(F.collect_list("near")).alias("reached"))  # step lists at most
        fresh = F.coalesce(F.array_except("reached", "seen"), F.array().cast("array<long>"))
        unseen, held = written(active.drop("frontier").join(reached, "q", "left").withColumn("fresh", fresh).drop("reached").withColumn("seen", F.concat("seen", "fresh")), "unseen")
        found = unseen.select("q", F.explode("fresh").alias("class")).join(index.nodes, "class").groupBy("q").agg(F.collect_list(F.struct("class", "code")).alias("found"))
        after, path = written(unseen.drop("fresh").join(found, "q", "left").select("q", "packed", "pool", "scores", "opened", "seen", "found").mapInArrow(further, STATE), "search")
        discard(spark, held)
        discard(spark, place)
        state, place = after, path
    every = done[0]
    for d in done[1:]:
        every = every.unionByName(d)
    scored = every.select("q", F.explode("pool").alias("class")).join(index.vectors.withColumnRenamed("packed", "other"), "class").groupBy("q").agg(F.collect_list(F.struct("class", "other")).alias("found"))

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for q, p, found in zip(b.column("q").to_pylist(), b.column("packed").to_pylist(), b.column("found").to_pylist(), strict=True):
                x, ys = exact(p), np.array([exact(r["other"]) for r in found])
                near = ys @ x
                some = np.argsort(-near, kind="stable")[: k + 12]
                exactly = sorted(((math.fsum((ys[i] * x).tolist()), found[i]["class"]) for i in some.tolist()), key=lambda t: (-t[0], t[1]))[:k]
                out += [(q, c, s) for s, c in exactly]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in ((0, pa.int64()), (1, pa.int64()), (2, pa.float64()))], ["q", "class", "score"])

    return bounded(every.select("q", "packed").join(scored, "q")).select("q", "packed", "found").mapInArrow(last, "q long, class long, score double")


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, every: int = 20, k: int = 20, **parameters) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` nearest found of each row whose id is divisible by ``every``; ``parameters`` go to ``build``."""
    index = build(vectors, id_col, vector_col, **parameters)
    queries = index.rows.filter(F.col("vec_id") % every == 0)
    asked = queries.select("class").distinct()
    found = materialize(search(index, asked.join(index.vectors, "class").select(F.col("class").alias("q"), "packed", F.col("class").alias("start")), k + 1), "hits")
    members = index.rows.withColumn("rank", F.row_number().over(Window.partitionBy("class").orderBy(F.asc_nulls_last("vec_id")))).filter(F.col("rank") <= k + 1).drop("rank")
    hits = found.join(members, "class").select("q", F.struct((-F.col("score")).alias("down"), F.col("vec_id").isNull().alias("unnamed"), "vec_id", (F.col("class") == F.col("q")).alias("own")).alias("x"))
    hits = hits.groupBy(F.col("q").alias("class")).agg(F.slice(F.array_sort(F.collect_list("x")), 1, k + 1).alias("hits"))  # (k + 1)^2 at most
    return _answers(spread_join(queries, hits, "class", F.col("vec_id"), most=BROADCAST_LISTS), k)


def _answers(rows: DataFrame, k: int) -> DataFrame:
    """The hits of each query row without one that is the row itself."""
    own = F.array_position(F.transform("hits", lambda x: F.coalesce(x["own"] & (x["vec_id"] == F.col("query_id")), F.lit(False))), True)
    rest = F.slice(F.filter("hits", lambda x, i: i + 1 != own), 1, k)
    out = rows.withColumnRenamed("vec_id", "query_id").select("query_id", F.posexplode(rest).alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.down")).alias("score"))
