"""Gradient boosting of trees grown leaf by leaf, on histograms that tasks sum.

Rows become byte codes once: a numeric column by its quantiles, a text column by its most frequent values; code 0 stands for unknown
values. Rows equal in all codes and the label are held once with their number, in blocks; a tree's draw of them is binomial. Each pass over the blocks sums count, gradient and curvature by
(leaf, column, code) in tasks, adds the tasks' histograms up by leaf and column, finds the best split of each there,
and only those splits reach the driver. Unknown values go to the side where they gain more; a text column splits by
sets of values, in the order of their mean gradient.

A tree takes the best leaf first until it has ``leaves``. As one pass a split would be slow, a pass looks at the children of
every leaf that could still be taken (best gain first, as many as splits are left); leaves that turn out too bad are cut
off again, so the tree is the one that single splits would give, in about as many passes as it is deep.

Up to ``HELD`` different rows (some 30 MB), a pass is far shorter than starting its tasks: there one task holds the blocks and makes the
passes of all trees, counting the lesser child of each split and subtracting it from its parent. The trees are the same.

Gradients are summed as whole numbers of a fixed unit, so a fit gives the same trees however rows are partitioned. Margins are
written with the blocks every ``WRITTEN`` trees, in the shared folder; lost executors cost a pass.

Cases: rows without a label are left out; null and NaN are unknown, and a column that is unknown throughout is never split; text values beyond the
``CATEGORIES`` most frequent count as unknown; one class only gives no trees; no rows give a
margin of 0; other columns, whatever their names, go through scoring.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..steps import discard, written

#: Codes of a byte; rows of a block; trees between two writings of the margins; most and least bits of a gradient's unit.
CODES, BLOCK, WRITTEN, UNIT_BITS, LEAST_BITS = 256, 1 << 16, 1, 36, 24
#: Different rows up to which one task holds them all.
HELD = 1 << 20
#: Rows that are sent down a tree at once.
STRIDE = 1 << 13
CATEGORIES = 254
#: Histograms that one task takes at least before there is a further one.
TASK_SPLITS = 64
#: Smoothing of a text value's mean gradient, further penalty of its splits, and most values on the lesser side.
TEXT_SMOOTHING, TEXT_PENALTY, TEXT_MOST = 10.0, 10.0, 32
LEAST_CURVATURE = 1e-3


@dataclass(frozen=True)
class Settings:
    """500 trees of 63 leaves; draws of rows and columns anew for each tree."""

    trees: int = 500
    rate: float = 0.05
    leaves: int = 63
    least_rows: int = 200
    row_share: float = 0.8
    column_share: float = 0.8
    penalty: float = 1.0
    bins: int = 255
    seed: int = 42


@dataclass
class Tree:
    """Nodes by place: the root is 0. ``left`` is -1 at leaves; ``goes_left`` tells for each code; ``cover`` is rows."""

    column: np.ndarray
    left: np.ndarray
    right: np.ndarray
    goes_left: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    def places(self, codes: np.ndarray) -> np.ndarray:
        """The leaf of each row; codes by column, then row."""
        inner = self.left >= 0
        to = np.where(self.goes_left, self.left[:, None], self.right[:, None])
        to[~inner] = np.flatnonzero(~inner)[:, None]  # rows stay at a leaf
        to, out = to.astype(np.int32).reshape(-1), np.empty(codes.shape[1], np.int32)
        for low in range(0, codes.shape[1], STRIDE):
            part, found = np.ascontiguousarray(codes[:, low : low + STRIDE]), out[low : low + STRIDE]
            width = part.shape[1]
            flat, start, rows, at = part.reshape(-1), self.column.astype(np.int64) * width, np.arange(width), np.zeros(width, np.int32)
            while len(rows):
                for _ in range(2):
                    at = to.take(at * CODES + flat.take(start.take(at) + rows))
                found[rows] = at
                on = inner.take(at)
                rows, at = rows[on], at[on]
        return out


@dataclass
class Model:
    numeric: list[str]
    text: list[str]
    edges: list[np.ndarray]
    values: list[list[str]]
    start: float
    trees: list[Tree] = field(default_factory=list)

    @property
    def columns(self) -> list[str]:
        return self.numeric + self.text

    def encode(self, columns: list[pa.Array]) -> np.ndarray:
        """Codes by column, then row, of doubles and strings in the model's order."""
        out = np.zeros((len(columns), len(columns[0]) if columns else 0), np.uint8)
        for i, c in enumerate(columns):
            if i < len(self.edges):
                v = c.to_numpy(zero_copy_only=False).astype(np.float64)
                out[i] = np.where(np.isnan(v), 0, np.searchsorted(self.edges[i], v, side="left") + 1)
            else:
                found = pc.index_in(c, pa.array(self.values[i - len(self.edges)], pa.string())).fill_null(-1)
                out[i] = np.where(c.is_null().to_numpy(zero_copy_only=False), 0, found.to_numpy(zero_copy_only=False) + 1)
        return out

    def margins(self, codes: np.ndarray) -> np.ndarray:
        out = np.full(codes.shape[1], self.start)
        for t in self.trees:
            out += t.value[t.places(codes)]
        return out


def features(df: DataFrame, numeric: list[str], text: list[str]) -> list:
    """The columns that a model reads, under names of their own."""
    return [F.col(c).cast("double" if i < len(numeric) else "string").alias(f"__x{i}") for i, c in enumerate(numeric + text)]


def _bins(rows: DataFrame, numeric: list[str], text: list[str], bins: int) -> tuple[list[np.ndarray], list[list[str]]]:
    """Upper edges of the numeric columns' codes (each below the greatest value), and the text columns' most frequent values."""
    shares = [k / bins for k in range(1, bins)]
    cut = [F.percentile_approx(F.when(~F.isnan(f"__x{i}"), F.col(f"__x{i}")), shares, 100 * bins).alias(f"q{i}") for i in range(len(numeric))]
    top = [F.max(F.when(~F.isnan(f"__x{i}"), F.col(f"__x{i}"))).alias(f"m{i}") for i in range(len(numeric))]
    found = rows.agg(*cut, *top).first() if numeric else None
    edges = []
    for i in range(len(numeric)):
        q = np.unique(np.array(found[f"q{i}"] or [], np.float64))
        edges.append(q[q < found[f"m{i}"]] if len(q) else q)
    values = [[r[0] for r in rows.filter(F.col(f"__x{i}").isNotNull()).groupBy(f"__x{i}").count().orderBy(F.desc("count"), f"__x{i}").limit(CATEGORIES).collect()] for i in range(len(numeric), len(numeric) + len(text))]
    return edges, values


BLOCKS = "codes binary, label binary, draw binary, times binary, margin binary"


def _blocks(rows: DataFrame, model: Model) -> DataFrame:
    names, width = [f"__x{i}" for i in range(len(model.columns))], len(model.columns)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = np.ascontiguousarray(model.encode([b.column(n) for n in names]).T).tobytes()
            ends = pa.py_buffer(np.arange(b.num_rows + 1, dtype=np.int32) * width)
            yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), b.num_rows, [None, ends, pa.py_buffer(codes)]), b.column("__y")], ["codes", "label"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            codes, label, draw, times = (np.concatenate([h[i] for h in held], axis=-1) for i in range(4))
            held.clear()
            made = [np.ascontiguousarray(codes), label, draw, times, np.full(len(label), model.start)]
            return pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in made], ["codes", "label", "draw", "times", "margin"])

        for b in batches:
            for low in range(0, b.num_rows, BLOCK):
                part = b.slice(low, BLOCK)
                if held and sum(len(h[1]) for h in held) + part.num_rows > BLOCK:
                    yield block()
                codes = np.frombuffer(b"".join(part.column("codes").to_pylist()), np.uint8).reshape(-1, width).T
                held.append((codes, part.column("label").to_numpy().astype(np.uint8), part.column("draw").to_numpy().view(np.uint64), part.column("times").to_numpy()))
        if held:
            yield block()

    coded = rows.select(*names, "__y").mapInArrow(encode, "codes binary, label int")
    return coded.groupBy("codes", "label").agg(F.count("*").alias("times")).withColumn("draw", F.xxhash64("codes", "label")).mapInArrow(run, BLOCKS)


def _unpacked(b: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    for codes, label, draw, times, margin in zip(*(b.column(c).to_pylist() for c in ("codes", "label", "draw", "times", "margin")), strict=True):
        yield np.frombuffer(codes, np.uint8).reshape(width, -1), np.frombuffer(label, np.uint8), np.frombuffer(draw, np.uint64), np.frombuffer(times, np.int64), np.frombuffer(margin, np.float64)


def _summed(at: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
    """Sums of whole numbers below 2^62 by place, exact for a block: halves whose sums stay below 2^53 are added up as doubles."""
    low, high = w & ((1 << 26) - 1), w >> 26
    out = np.bincount(at, low, n).astype(np.int64)
    return out + (np.bincount(at, high, n).astype(np.int64) << 26) if high.any() else out


def _scrambled(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _sums(at: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
    """Sums of whole numbers by place: doubles where all sums are exact in them."""
    return _summed(at, w, n) if w.dtype == np.int64 else np.bincount(at, w, n)


@lru_cache(maxsize=256)
def _chances(n: int, share: float) -> tuple[int, np.ndarray]:
    """Chances of at most k of n rows in a draw, from the least k that can occur."""
    mean, reach = n * share, 12 * math.sqrt(n * share * (1 - share)) + 12
    low, high = max(0, math.floor(mean - reach)), min(n, math.ceil(mean + reach))
    k = np.arange(low, high, dtype=np.float64)
    p = np.concatenate([[0.0], np.cumsum(np.log((n - k) / (k + 1) * (share / (1 - share))))])
    p = np.cumsum(np.exp(p - p.max()))
    return low, p / p[-1]


def _drawn(draw: np.ndarray, times: np.ndarray, seed: int, share: float) -> np.ndarray:
    """How often each of the different rows is in a tree's draw: binomial, drawn for each binary digit of its number alone."""
    if share >= 1:
        return times
    h = _scrambled(draw + np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64)))
    out = np.where(times & 1, h < np.uint64(int(share * (1 << 64))), 0).astype(np.int64)
    for bit in range(1, int(times.max(initial=0)).bit_length()):
        some = np.flatnonzero(times >> bit & 1)
        low, chances = _chances(1 << bit, share)
        u = (_scrambled(h[some] + np.uint64(bit)) >> np.uint64(11)) * 2.0**-53
        out[some] += low + np.searchsorted(chances, u, side="right")
    return out


def _best_text(hist: np.ndarray, s: Settings) -> tuple | None:
    """The best split of a text column's histogram (rows, gradient, curvature; codes)."""
    n, g, h = hist
    total = hist.sum(axis=1)
    base = total[1] * total[1] / (total[2] + s.penalty)
    some = np.flatnonzero(n)
    order, best = some[np.argsort(g[some] / (h[some] + TEXT_SMOOTHING), kind="stable")], None
    for way in (order, order[::-1]):
        way = way[: min(TEXT_MOST, len(order) - 1)]
        gain, left = _gains(np.cumsum(hist[:, way], axis=1), total, base, s.penalty + TEXT_PENALTY, s)
        if len(way) and gain.max() > 1e-10 and (best is None or gain.max() > best[0]):
            k = int(gain.argmax())
            best = (float(gain[k]), np.isin(np.arange(CODES), way[: k + 1]), left[:, k])
    return best and (*best, total)


def _gains(left: np.ndarray, total: np.ndarray, base: np.ndarray, penalty: float, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Gains of splits by the sums of their left sides (rows, gradient, curvature; splits), and those sums."""
    right = total[..., None] - left
    ok = (np.minimum(left[..., 0, :], right[..., 0, :]) >= s.least_rows) & (np.minimum(left[..., 2, :], right[..., 2, :]) >= LEAST_CURVATURE)
    worth = lambda x: x[..., 1, :] * x[..., 1, :] / (x[..., 2, :] + penalty)
    return np.where(ok, worth(left) + worth(right) - base[..., None], -np.inf), left


def _best_numbers(hist: np.ndarray, s: Settings) -> list[tuple | None]:
    """The best split of each histogram (nodes; rows, gradient, curvature; codes) of a numeric column."""
    total = hist.sum(axis=2)
    base = total[:, 1] * total[:, 1] / (total[:, 2] + s.penalty)
    known = np.cumsum(hist[:, :, 1:], axis=2)
    gain, left = _gains(np.concatenate([known + hist[:, :, :1], known], axis=2), total, base, s.penalty, s)
    places, out, code = gain.argmax(axis=1), [], np.arange(CODES)
    for i, at in enumerate(places.tolist()):
        if not gain[i, at] > 1e-10:
            out.append(None)
            continue
        with_unknown, k = at < known.shape[2], at % known.shape[2]
        if not hist[i, 0, 0]:  # nothing unknown here: such rows go with the greater side
            with_unknown = 2 * known[i, 0, k] >= total[i, 0]
        out.append((float(gain[i, at]), (code <= k + 1) & ((code >= 1) | with_unknown), left[i, :, at], total[i]))
    return out


def _best(hist: np.ndarray, column: int, model: Model, s: Settings) -> list[tuple | None]:
    """The best split of each histogram of a column: gain, table of codes that go left, sums of the left side, sums."""
    if column >= len(model.edges):
        return [_best_text(h, s) for h in hist]
    return _best_numbers(hist[:, :, : len(model.edges[column]) + 2], s)


SPLITS = "node int, column int, gain double, goes_left binary, left_n double, left_g double, left_h double, n double, g double, h double"


def _weights(margin: np.ndarray, label: np.ndarray, times: np.ndarray, bits: int, exact: bool) -> list[np.ndarray]:
    """Number, gradient and curvature of rows, the last two as whole numbers of the unit; ``exact``: sums of all rows are exact in doubles."""
    p, unit, kind = 1 / (1 + np.exp(-margin)), float(1 << bits), np.float64 if exact else np.int64
    t = times.astype(kind)
    return [t, np.rint((p - label) * unit).astype(kind) * t, np.rint(p * (1 - p) * unit).astype(kind) * t]


def _splits(blocks: DataFrame, model: Model, since: list[Tree], tree: Tree, open_: list[int], columns: list[int], seed: int, bits: int, exact: bool, s: Settings) -> list:
    """The best split of each open node and drawn column: one pass over the blocks."""
    width, unit = len(model.columns), float(1 << bits)
    place = np.full(len(tree.left), -1)
    place[open_] = np.arange(len(open_))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(open_), len(columns), 3, CODES), np.int64)
        seen = False
        for b in batches:
            for codes, label, draw, times, margin in _unpacked(b, width):
                t = _drawn(draw, times, seed, s.row_share)
                rows = np.flatnonzero(t)
                codes = codes[:, rows]
                mine = place[tree.places(codes)]
                some = np.flatnonzero(mine >= 0)
                if not len(some):
                    continue
                seen = True
                codes, mine, rows = codes[:, some], mine[some] * CODES, rows[some]
                m = margin[rows].copy()
                for k in since:
                    m += k.value[k.places(codes)]
                w = _weights(m, label[rows], t[rows], bits, exact)
                for k, c in enumerate(columns):
                    at = mine + codes[c]
                    for j in range(3):
                        sums[:, k, j] += _sums(at, w[j], len(open_) * CODES).astype(np.int64).reshape(-1, CODES)
        if seen:
            i, k = (x.reshape(-1) for x in np.indices(sums.shape[:2]))
            yield pa.RecordBatch.from_arrays([pa.array(np.array(open_, np.int32)[i]), pa.array(np.array(columns, np.int32)[k]), pa.array([x.tobytes() for x in sums.reshape(-1, 3, CODES)], pa.binary())], ["node", "column", "sums"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total, out = None, None, []

        def close() -> None:
            hist = np.stack([total[0].astype(np.float64), total[1] / unit, total[2] / unit])
            best = _best(hist[None], key[1], model, s)[0]
            if best or key[1] == columns[0]:
                gain, table, left, whole = best or (0.0, np.zeros(CODES, bool), np.zeros(3), hist.sum(axis=1))
                out.append((*key, gain, table.tobytes(), *left.tolist(), *whole.tolist()))

        for b in batches:
            for node, column, sums in zip(*(b.column(c).to_pylist() for c in ("node", "column", "sums")), strict=True):
                if (node, column) != key:
                    if key:
                        close()
                    key, total = (node, column), np.zeros((3, CODES), np.int64)
                total += np.frombuffer(sums, np.int64).reshape(3, CODES)
        if key:
            close()
        names = [x.split()[0] for x in SPLITS.split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.binary()] + [pa.float64()] * 6
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kinds[i]) for i in range(len(names))], names)

    # few histograms are not worth a task each
    tasks = max(1, min(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), len(open_) * len(columns) // TASK_SPLITS))
    dealt = blocks.mapInArrow(count, "node int, column int, sums binary").repartition(tasks, "node", "column").sortWithinPartitions("node", "column")
    return dealt.mapInArrow(choose, SPLITS).collect()


class _Grown:
    """A tree while it grows: nodes with their sums, best splits as far as known, and children where looked at."""

    def __init__(self) -> None:
        self.sums: list[tuple | None] = [None]
        self.split: list[tuple | None] = [None]  # gain, column, table
        self.known, self.left = [False], [-1]

    def learn(self, found: list, open_: list[int]) -> None:
        for node in open_:
            self.known[node] = True
        best: dict[int, tuple] = {}
        for r in found:
            if self.sums[r["node"]] is None:
                self.sums[r["node"]] = (r["n"], r["g"], r["h"])
            if r["gain"] > 0 and (r["node"] not in best or (r["gain"], -r["column"]) > best[r["node"]][:2]):
                best[r["node"]] = (r["gain"], -r["column"], bytes(r["goes_left"]), (r["left_n"], r["left_g"], r["left_h"]), (r["n"], r["g"], r["h"]))
        for node, (gain, column, table, left, whole) in best.items():
            self.split[node] = (gain, -column, table, left, tuple(w - x for w, x in zip(whole, left, strict=True)))

    def taken(self, leaves: int) -> tuple[list[int], list[int]]:
        """Splits best first, as far as known; and those of them whose children nobody has looked at."""
        heap, order, wanted = [(-self.split[0][0], 0)] if self.split[0] else [], [], []
        while heap and len(order) < leaves - 1:
            _, node = heapq.heappop(heap)
            order.append(node)
            if self.left[node] < 0:
                wanted.append(node)
                continue
            for child in (self.left[node], self.left[node] + 1):
                if self.split[child]:
                    heapq.heappush(heap, (-self.split[child][0], child))
        return order, wanted

    def extend(self, nodes: list[int], least_rows: int) -> list[int]:
        """Adds the children of ``nodes``; returns those that may be split."""
        new = []
        for node in nodes:
            self.left[node] = len(self.left)
            for side in (3, 4):
                sums = self.split[node][side]
                if sums[0] >= 2 * least_rows:
                    new.append(len(self.left))
                self.sums.append(sums)
                self.split.append(None)
                self.known.append(sums[0] < 2 * least_rows)
                self.left.append(-1)
        return new

    def tree(self, inner: set[int], s: Settings) -> Tree:
        """The nodes that are reached when ``inner`` are split, with their values."""
        order, at = [0], 0
        while at < len(order):
            if order[at] in inner:
                order += [self.left[order[at]], self.left[order[at]] + 1]
            at += 1
        name = {node: i for i, node in enumerate(order)}
        child = lambda node, k: name[self.left[node] + k] if node in inner else -1
        table = [np.frombuffer(self.split[n][2], bool) if n in inner else np.zeros(CODES, bool) for n in order]
        value = [0.0 if n in inner or self.sums[n] is None else -self.sums[n][1] / (self.sums[n][2] + s.penalty) * s.rate for n in order]
        return Tree(np.array([self.split[n][1] if n in inner else 0 for n in order], np.int32), np.array([child(n, 0) for n in order], np.int32), np.array([child(n, 1) for n in order], np.int32), np.stack(table), np.array(value), np.array([self.sums[n][0] if self.sums[n] else 0.0 for n in order]))


def _columns(model: Model, seed: int, s: Settings) -> list[int]:
    """The columns of a tree's draw."""
    return sorted(np.random.RandomState(seed).choice(len(model.columns), max(1, round(s.column_share * len(model.columns))), replace=False).tolist())


def _tree(look: Callable[[_Grown, list[int]], list], s: Settings) -> Tree:
    """A tree; ``look`` finds the best split of each open node and drawn column."""
    grown, open_ = _Grown(), [0]
    while open_:
        grown.learn(look(grown, open_), open_)
        open_ = []
        order, wanted = grown.taken(s.leaves)
        while wanted and not open_:  # children too small to split need no pass
            open_ = grown.extend(wanted, s.least_rows)
            order, wanted = grown.taken(s.leaves)
    return grown.tree(set(order), s)


class _Held:
    """The drawn rows of a tree in one task, with their places and histograms at the nodes that may be split further."""

    def __init__(self, codes: np.ndarray, weights: list[np.ndarray], model: Model, columns: list[int], bits: int, s: Settings) -> None:
        self.codes, self.weights, self.model, self.columns, self.bits, self.s = codes, weights, model, columns, bits, s
        self.once = bool((weights[0] == 1).all())
        self.rows = {0: np.arange(codes.shape[1])}
        self.sums = {0: self.count(self.rows[0])}

    def count(self, rows: np.ndarray) -> np.ndarray:
        w = [x.take(rows) for x in self.weights]
        out = np.empty((len(self.columns), 3, CODES), w[0].dtype)
        for k, c in enumerate(self.columns):
            at = self.codes[c].take(rows)
            for j in range(3):
                out[k, j] = np.bincount(at, minlength=CODES) if self.once and not j else _sums(at, w[j], CODES)
        return out

    def look(self, grown: _Grown, open_: list[int]) -> list[dict]:
        for node, left in enumerate(grown.left):
            if left < 0 or node not in self.rows:
                continue
            rows, sums = self.rows.pop(node), self.sums.pop(node)
            if left not in open_ and left + 1 not in open_:
                continue
            _, column, table, *_ = grown.split[node]
            goes = np.frombuffer(table, bool).take(self.codes[column].take(rows))
            parts = [rows[goes], rows[~goes]]
            less = int(len(parts[0]) > len(parts[1]))
            found = self.count(parts[less])
            for side, x in ((less, found), (1 - less, sums - found)):
                if left + side in open_:
                    self.rows[left + side], self.sums[left + side] = parts[side], x
        out, unit = [], np.array([1.0, 1 << self.bits, 1 << self.bits])[:, None]
        for k, c in enumerate(self.columns):
            hist = np.stack([self.sums[node][k] for node in open_]) / unit
            for node, h, best in zip(open_, hist, _best(hist, c, self.model, self.s), strict=True):
                if best or not k:
                    gain, table, left, whole = best or (0.0, np.zeros(CODES, bool), np.zeros(3), h.sum(axis=1))
                    out.append(dict(zip(("node", "column", "gain", "goes_left", "left_n", "left_g", "left_h", "n", "g", "h"), (node, c, gain, table.tobytes(), *left.tolist(), *whole.tolist()), strict=True)))
        return out


#: A tree's arrays, in the order of ``Tree``.
KINDS = (np.int32, np.int32, np.int32, bool, np.float64, np.float64)
TREES = "tree int, " + ", ".join(f"`{c}` binary" for c in Tree.__dataclass_fields__)


def _held_trees(blocks: DataFrame, model: Model, bits: int, exact: bool, s: Settings) -> list[Tree]:
    """All trees, from blocks that one task holds."""
    width = len(model.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, label, draw, times, margin = (np.concatenate(x, axis=-1) for x in zip(*(u for b in batches for u in _unpacked(b, width)), strict=True))
        for k in range(s.trees):
            t = _drawn(draw, times, s.seed + k, s.row_share)
            rows = np.flatnonzero(t)
            held = _Held(codes[:, rows], _weights(margin[rows], label[rows], t[rows], bits, exact), model, _columns(model, s.seed + k, s), bits, s)
            tree = _tree(held.look, s)
            margin = margin + tree.value[tree.places(codes)]
            made = [np.asarray(getattr(tree, c), kind).tobytes() for c, kind in zip(Tree.__dataclass_fields__, KINDS, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *[pa.array([x], pa.binary()) for x in made]], ["tree", *Tree.__dataclass_fields__])

    found = sorted(blocks.coalesce(1).mapInArrow(run, TREES).collect(), key=lambda r: r["tree"])
    return [Tree(*[np.frombuffer(bytes(r[c]), kind).reshape(*((-1, CODES) if kind is bool else (-1,))) for c, kind in zip(Tree.__dataclass_fields__, KINDS, strict=True)]) for r in found]


def fit(train: DataFrame, numeric: list[str], text: list[str], label: str, settings: Settings = Settings()) -> Model:
    """Boosted trees for the probability of ``label`` (0 or 1)."""
    s = settings
    x = features(train, numeric, text)
    rows = train.filter(F.col(label).isNotNull()).select(*x, F.col(label).cast("int").alias("__y"))
    rows, path = written(rows, "rows")
    n, positives = rows.agg(F.count("*"), F.coalesce(F.sum("__y"), F.lit(0))).first()
    edges, values = _bins(rows, numeric, text, s.bins)
    model = Model(numeric, text, edges, values, math.log(positives / (n - positives)) if 0 < positives < n else 0.0)
    if not 0 < positives < n:
        if n:
            model.start = math.copysign(math.log(2.0 * n + 1), positives - 0.5)  # as if half a row were of the other class
        discard(train.sparkSession, path)
        return model
    spark = train.sparkSession
    blocks, place = written(_blocks(rows, model), "blocks")
    discard(spark, path)
    of_n = math.ceil(math.log2(n + 1))  # sums of all rows stay below 2^53 where the unit allows it, else below 2^62
    bits = min(UNIT_BITS, max(52 - of_n, min(LEAST_BITS, 62 - of_n)))
    exact = bits + of_n <= 52
    if blocks.agg(F.sum(F.octet_length("label"))).first()[0] <= HELD:
        model.trees = _held_trees(blocks, model, bits, exact, s)
        discard(spark, place)
        return model
    since: list[Tree] = []
    for k in range(s.trees):
        columns = _columns(model, s.seed + k, s)

        def look(grown: _Grown, open_: list[int], columns=columns, seed=s.seed + k) -> list:
            every = {i for i, left in enumerate(grown.left) if left >= 0}
            return _splits(blocks, model, since, _routes(grown, every), open_, columns, seed, bits, exact, s)

        tree = _tree(look, s)
        model.trees.append(tree)
        since.append(tree)
        if len(since) == WRITTEN and k + 1 < s.trees:
            blocks, path = written(_moved(blocks, since, len(model.columns)), "blocks")
            discard(spark, place)
            place, since = path, []
    discard(spark, place)
    return model


def _routes(grown: _Grown, inner: set[int]) -> Tree:
    """All nodes under their own places, to send rows down."""
    m = len(grown.left)
    left = np.array(grown.left, np.int32)
    table = np.stack([np.frombuffer(grown.split[i][2], bool) if i in inner else np.zeros(CODES, bool) for i in range(m)])
    return Tree(np.array([grown.split[i][1] if i in inner else 0 for i in range(m)], np.int32), left, np.where(left >= 0, left + 1, -1).astype(np.int32), table, np.zeros(m), np.zeros(m))


def _moved(blocks: DataFrame, trees: list[Tree], width: int) -> DataFrame:
    """The blocks with the trees' values added to their margins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for codes, _, _, _, margin in _unpacked(b, width):
                m = margin.copy()
                for t in trees:
                    m += t.value[t.places(codes)]
                out.append(m.tobytes())
            yield pa.RecordBatch.from_arrays([b.column("codes"), b.column("label"), b.column("draw"), b.column("times"), pa.array(out, pa.binary())], ["codes", "label", "draw", "times", "margin"])

    return blocks.mapInArrow(run, BLOCKS)


def score(model: Model, df: DataFrame, name: str = "score", margin: str | None = None) -> DataFrame:
    """``df`` with the probability of the label, and with its margin (log odds) where that has a name."""
    names = [f"__x{i}" for i in range(len(model.columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [i for i, n in enumerate(b.schema.names) if n not in names]
            m = model.margins(model.encode([b.column(n) for n in names])) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(i) for i in own] + [pa.array(m)], [b.schema.names[i] for i in own] + ["__margin"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + ["__margin double"])
    out = df.select("*", *features(df, model.numeric, model.text)).mapInArrow(run, schema)
    out = out.withColumn(name, 1 / (1 + F.exp(-F.col("__margin"))))
    return out.withColumn(margin, F.col("__margin")).drop("__margin") if margin else out.drop("__margin")


def save(model: Model, spark: SparkSession, path: str) -> None:
    """Nodes as a table, and the columns' edges and values beside it; an existing model there is replaced."""
    nodes = [(k, i, int(t.column[i]), int(t.left[i]), int(t.right[i]), bytearray(t.goes_left[i].tobytes()), float(t.value[i]), float(t.cover[i])) for k, t in enumerate(model.trees) for i in range(len(t.left))]
    spark.createDataFrame(nodes, "tree int, node int, column int, `left` int, `right` int, goes_left binary, value double, cover double").write.mode("overwrite").parquet(f"{path}/nodes")
    columns = [(i, c, [float(e) for e in model.edges[i]] if i < len(model.edges) else None, None if i < len(model.edges) else model.values[i - len(model.edges)], model.start) for i, c in enumerate(model.columns)]
    spark.createDataFrame(columns, "at int, name string, edges array<double>, entries array<string>, start double").write.mode("overwrite").parquet(f"{path}/columns")


def load(spark: SparkSession, path: str) -> Model:
    columns = spark.read.parquet(f"{path}/columns").orderBy("at").collect()
    nodes: dict[int, list] = {}
    for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():
        nodes.setdefault(r["tree"], []).append(r)
    numeric, text = [r for r in columns if r["edges"] is not None], [r for r in columns if r["edges"] is None]
    model = Model([r["name"] for r in numeric], [r["name"] for r in text], [np.array(r["edges"], np.float64) for r in numeric], [list(r["entries"]) for r in text], columns[0]["start"] if columns else 0.0)
    as_array = lambda rows, c, kind: np.array([r[c] for r in rows], kind)
    for _, rows in sorted(nodes.items()):
        model.trees.append(Tree(as_array(rows, "column", np.int32), as_array(rows, "left", np.int32), as_array(rows, "right", np.int32), np.stack([np.frombuffer(bytes(r["goes_left"]), bool) for r in rows]), as_array(rows, "value", float), as_array(rows, "cover", float)))
    return model
