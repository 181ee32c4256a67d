"""Exact Shapley parts of a boosted model's margins: how much each column moves a row away from the mean.

A leaf matters to a row through the different columns on its path: for each, whether the row itself passes all
the path's splits on that column (one or zero), and the share of the training rows that do (cover of children over cover
of nodes). The path-weight recursion adds the columns one after the other to the weights of all sets of each size, and
takes each out again for its own part. Rows that pass the same splits of a leaf's path have the same parts there, so
the recursion runs once in a task for each pattern of passes, all leaves of a tree together; rows look their parts up, by patterns that
grow on the way down the tree. Rows equal in all codes have equal parts: ``once`` and ``counted`` find them once.

Cases: parts of a column that no tree splits are 0; unknown values go where the trees send them; the mean is that of
the trees' own covers; parts and mean add up to the margin of each row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..steps import materialize
from .boosting import Model, Tree, features


class Paths:
    """A tree's leaves, each with the columns on its path: their nodes, sides, and shares of cover."""

    def __init__(self, tree: Tree) -> None:
        self.tree, self.leaves = tree, []
        self.ends: list[int] = []  # the leaves' nodes
        self.steps: list[tuple] = []  # from node to child: the place of the column on the path, whether it is there already, side
        self.tables: list[np.ndarray | None] | None = None
        stack: list[tuple[int, dict]] = [(0, {})]
        while stack:
            node, path = stack.pop()
            if tree.left[node] < 0:
                self.leaves.append((float(tree.value[node]), [(c, share, tuple(at)) for c, (share, at) in path.items()]))
                self.ends.append(node)
                continue
            column = int(tree.column[node])
            share, at = path.get(column, (1.0, ()))
            for child, left in ((int(tree.left[node]), True), (int(tree.right[node]), False)):
                part = float(tree.cover[child] / tree.cover[node]) if tree.cover[node] else 0.0
                self.steps.append((node, child, list(path).index(column) if column in path else len(path), column in path, left))
                stack.append((child, path | {column: (share * part, (*at, (node, left)))}))

    def prepare(self) -> list[np.ndarray | None]:
        """Each leaf's parts for all patterns (columns of the path; patterns), where its path is short enough."""
        tables: list[np.ndarray | None] = [None] * len(self.leaves)
        for m in range(1, WIDE + 1):
            some = [i for i, (value, path) in enumerate(self.leaves) if value and len(path) == m]
            if some:
                ones = (np.arange(1 << m)[:, None] >> np.arange(m) & 1).astype(float)
                found = path_weights(ones, np.array([[share for _, share, _ in self.leaves[i][1]] for i in some]))
                for i, weights in zip(some, found, strict=True):
                    tables[i] = np.ascontiguousarray(weights.T) * self.leaves[i][0]
        return tables

    def add(self, codes: np.ndarray, out: np.ndarray) -> None:
        """Adds the rows' parts to ``out``. A row's pattern at a node: for each column of the path, whether the row passes its splits."""
        if self.tables is None:
            self.tables = self.prepare()
        longest = max(len(path) for _, path in self.leaves)
        kind = np.dtype(np.uint8 if longest <= 8 else np.uint16 if longest <= 16 else np.int64)
        patterns = {0: np.zeros(codes.shape[1], kind)}
        for node, child, place, there, left in self.steps:
            passes = self.tree.goes_left[node] == left
            if there:
                patterns[child] = patterns[node] & np.where(passes, -1, ~(1 << place)).astype(kind).take(codes[self.tree.column[node]])
            else:
                patterns[child] = patterns[node] | np.where(passes, 1 << place, 0).astype(kind).take(codes[self.tree.column[node]])
        for node, (value, path), table in zip(self.ends, self.leaves, self.tables, strict=True):
            if not path or not value:
                continue
            of = patterns[node]
            if table is None:
                shown, of = np.unique(of, return_inverse=True)
                ones = (shown[:, None] >> np.arange(len(path)) & 1).astype(float)
                table = path_weights(ones, np.array([[share for _, share, _ in path]]))[0].T * value
            of = of.astype(np.intp)
            for (c, _, _), weights in zip(path, table, strict=True):
                out[c] += weights.take(of)

    def mean(self) -> float:
        """The value that a row has on average over the training rows."""
        return sum(value * float(np.prod([share for _, share, _ in path])) for value, path in self.leaves)


def path_weights(ones: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Weights (one - share) times the Shapley sum over the sets of the other columns: paths, patterns, columns.

    ``ones`` is patterns by columns, ``shares`` paths by columns. ``sizes[:, :, k]`` is the sum over all sets of k of the columns so far, of the
    product of the ones of its members and the shares of the others, weighted by k! (m - k - 1)! / m! as the recursion goes.
    """
    (rows, m), paths = ones.shape, len(shares)
    sizes = np.zeros((paths, rows, m + 1))
    sizes[:, :, 0] = 1.0
    for j in range(m):
        share, one = shares[:, j, None, None], ones[None, :, j : j + 1]
        k = np.arange(j + 1)
        grown = np.zeros((paths, rows, j + 2))
        grown[:, :, :-1] = sizes[:, :, : j + 1] * share * ((j + 1 - k) / (j + 2))
        grown[:, :, 1:] += sizes[:, :, : j + 1] * one * ((k + 1) / (j + 2))
        sizes[:, :, : j + 2] = grown
    out = np.zeros((paths, rows, m))
    for j in range(m):
        share, one = shares[:, j, None], ones[None, :, j]
        over = np.divide(1.0, share, out=np.zeros_like(share), where=share > 0)
        # taking a column out: from the greatest size down where the row passes, from the weights themselves where not
        total, carried = np.zeros((paths, rows)), sizes[:, :, m]
        for k in range(m - 1, -1, -1):
            taken = carried * (m + 1) / (k + 1)
            total += np.where(one > 0, taken, sizes[:, :, k] * (m + 1) * over / (m - k))
            carried = sizes[:, :, k] - taken * share * (m - k) / (m + 1)
        out[:, :, j] = total * (one - share)
    return out


#: Path columns up to which a leaf has a table of all patterns; longer paths sort their patterns. Rows that are looked up at once.
WIDE, STRIDE = 7, 1 << 13


def parts(paths: list[Paths], codes: np.ndarray, columns: int) -> np.ndarray:
    """Parts by column, then row."""
    out = np.zeros((columns, codes.shape[1]))
    for low in range(0, codes.shape[1], STRIDE):
        some = np.ascontiguousarray(codes[:, low : low + STRIDE])
        for p in paths:
            p.add(some, out[:, low : low + STRIDE])
    return out


CODED = "__codes"


def coded(model: Model, df: DataFrame) -> DataFrame:
    """``df`` with each row's codes as bytes."""
    names, width = [f"__x{i}" for i in range(len(model.columns))], len(model.columns)
    encode = Model(model.numeric, model.text, model.edges, model.values, model.start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [i for i, n in enumerate(b.schema.names) if n not in names]
            bytes_ = np.ascontiguousarray(encode.encode([b.column(n) for n in names]).T).tobytes()
            ends = np.arange(b.num_rows + 1, dtype=np.int32) * width
            made = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(bytes_)])
            yield pa.RecordBatch.from_arrays([b.column(i) for i in own] + [made], [b.schema.names[i] for i in own] + [CODED])

    return df.select("*", *features(df, model.numeric, model.text)).mapInArrow(run, _schema(df, f"{CODED} binary"))


def _schema(df: DataFrame, further: str) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + [further])


def _with_parts(model: Model, df: DataFrame) -> DataFrame:
    """``df`` with the columns' parts of its codes."""
    trees, width = model.trees, len(model.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = [Paths(t) for t in trees]
        for b in batches:
            codes = np.frombuffer(b"".join(b.column(CODED).to_pylist()), np.uint8).reshape(b.num_rows, width).T
            found = parts(ready, codes, width)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * width, pa.int32()), pa.array(np.ascontiguousarray(found.T).reshape(-1)))
            yield pa.RecordBatch.from_arrays([*b.columns, lists], [*b.schema.names, "__parts"])

    return df.mapInArrow(run, _schema(df, "__parts array<double>"))


def _dealt(df: DataFrame) -> DataFrame:
    """``df`` written and dealt out by its rows' number: parts take a millisecond each, and a task has to make its tables first."""
    x = materialize(df, "codes")
    n = x.count()
    return x.repartition(max(1, min(-(-n // 2048), max(df.sparkSession.sparkContext.defaultParallelism, n >> 16))))


def counted(model: Model, df: DataFrame, rows: str = "rows") -> DataFrame:
    """For each combination of codes its array of (feature, part), and how many rows of ``df`` have it."""
    out = _with_parts(model, _dealt(coded(model, df.select(*model.columns)).groupBy(CODED).agg(F.count("*").alias(rows))))
    made = F.array(*[F.struct(F.lit(c).alias("feature"), F.col("__parts")[i].alias("part")) for i, c in enumerate(model.columns)])
    return out.select(made.alias("contributions"), rows)


def contributions(model: Model, df: DataFrame, name: str = "contributions", mean: str | None = None, *, once: bool = False) -> DataFrame:
    """``df`` with an array of (feature, value, text, part) for each row, in log odds, and the mean margin where that has a name.

    ``value`` is a number column's value, ``text`` a text column's. With ``once``, rows are written with their codes, and parts of
    each combination of codes are found once and joined to its rows.
    """
    base = model.start + sum(p.mean() for p in map(Paths, model.trees))
    out = coded(model, df)
    if once:
        out = materialize(out, "coded-rows")
        out = out.join(_with_parts(model, _dealt(out.select(CODED).distinct())), CODED)
    else:
        out = _with_parts(model, out)
    number = lambda i, c: F.col(c).cast("double") if i < len(model.numeric) else F.lit(None).cast("double")
    text = lambda i, c: F.lit(None).cast("string") if i < len(model.numeric) else F.col(c).cast("string")
    made = F.array(*[F.struct(F.lit(c).alias("feature"), number(i, c).alias("value"), text(i, c).alias("text"), F.col("__parts")[i].alias("part")) for i, c in enumerate(model.columns)])
    out = out.withColumn(name, made).drop("__parts", CODED)
    return out.withColumn(mean, F.lit(base)) if mean else out
