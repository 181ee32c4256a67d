"""Declarative data checks: row checks in one pass, then uniqueness, relationships and counts.

Every check gives one row: name, severity, unexpected_count, passed.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HARD, WARN = "error", "warn"
#: Clock text with end-of-day midnight; airport codes.
HHMM = "([01][0-9]|2[0-3])[0-5][0-9]|2400"
IATA = "[A-Z0-9]{3}"


@dataclass(frozen=True)
class Check:
    """``bad`` marks unexpected rows; at most ``share`` of the rows in ``scope`` may be."""

    name: str
    bad: Column
    scope: Column | None = None
    severity: str = HARD
    share: float = 0.0


def not_null(c: str) -> Check:
    return Check(f"{c}_not_null", F.col(c).isNull())


def matches(c: str, pattern: str, name: str) -> Check:
    """Null is not judged."""
    return Check(name, ~F.col(c).rlike(f"^(?:{pattern})$"))


def one_of(c: str, values: list, name: str) -> Check:
    return Check(name, ~F.col(c).isin(values))


def between(c: str, low: float, high: float, name: str, severity: str = HARD, share: float = 0.0, scope: Column | None = None) -> Check:
    return Check(name, ~F.col(c).between(low, high), scope, severity, share)


def completed_checks(delay: str, flag: str, done: Column, late: int = 15) -> list[Check]:
    """Completed rows have a delay and a flag, and the flag says whether the delay reaches ``late``."""
    wrong = F.col(flag).isNull() | ((F.col(flag) == 1) != F.coalesce(F.col(delay) >= late, F.lit(False)))
    return [Check("completed_have_delay", F.col(delay).isNull(), done), Check("completed_have_flag", F.col(flag).isNull(), done), Check("flag_agrees_with_delay", wrong, done)]


def _rows(df: DataFrame, names: list[tuple[str, str, str, str]]) -> DataFrame:
    """One row to many: (name, severity, count column, passed column)."""
    made = F.array(*[F.struct(F.lit(n).alias("check_name"), F.lit(s).alias("severity"), F.col(c).alias("unexpected_count"), F.col(p).alias("passed")) for n, s, c, p in names])
    return df.select(F.inline(made))


def row_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All row checks by one aggregate over one scan."""
    aggs, names = [], []
    for i, c in enumerate(checks):
        scope = F.lit(True) if c.scope is None else F.coalesce(c.scope, F.lit(False))
        aggs += [F.count(F.when(scope & F.coalesce(c.bad, F.lit(False)), 1)).alias(f"n{i}"), F.count(F.when(scope, 1)).alias(f"t{i}")]
        names.append((c.name, c.severity, f"n{i}", f"p{i}"))
    one = df.agg(*aggs).withColumns({f"p{i}": F.col(f"n{i}") <= F.col(f"t{i}") * c.share for i, c in enumerate(checks)})
    return _rows(one, names)


def unique(df: DataFrame, keys: list[str], name: str, severity: str = HARD) -> DataFrame:
    """Every row of a repeated key is unexpected; keys with a null are not judged."""
    cond = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    one = df.filter(cond).groupBy(*keys).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long").alias("n"))
    return _rows(one.withColumn("p", F.col("n") == 0), [(name, severity, "n", "p")])


def related(df: DataFrame, key: str, known: DataFrame, known_key: str, name: str, severity: str = HARD) -> DataFrame:
    """Rows whose non-null key has no match."""
    lost = df.filter(F.col(key).isNotNull()).join(known.select(F.col(known_key).alias("__k")), F.col(key) == F.col("__k"), "left_anti")
    return _rows(lost.agg(F.count("*").alias("n")).withColumn("p", F.col("n") == 0), [(name, severity, "n", "p")])


def group_counts(df: DataFrame, group: str, low: int, high: int, name: str) -> DataFrame:
    """Groups whose row count is out of bounds."""
    one = df.groupBy(group).agg(F.count("*").alias("c")).agg(F.count(F.when(~F.col("c").between(low, high), 1)).alias("n"))
    return _rows(one.withColumn("p", F.col("n") == 0), [(name, HARD, "n", "p")])


def mean_between(df: DataFrame, c: Column, low: float, high: float, name: str, severity: str = WARN) -> DataFrame:
    one = df.agg(F.avg(c).alias("m")).select(F.when(F.col("m").between(low, high), 0).otherwise(1).cast("long").alias("n"), F.coalesce(F.col("m").between(low, high), F.lit(False)).alias("p"))
    return _rows(one, [(name, severity, "n", "p")])


def empty(df: DataFrame, name: str, severity: str = HARD) -> DataFrame:
    """A query that must give no rows."""
    return _rows(df.agg(F.count("*").alias("n")).withColumn("p", F.col("n") == 0), [(name, severity, "n", "p")])


def suite(tables: dict[str, DataFrame], declared: dict[str, dict[str, list]]) -> DataFrame:
    """Runs declared column tests: ``{table: {column: [test, ...]}}`` where a test is "unique", ("unique_with", further columns), "not_null", ("in", values) or ("in_table", table, column); a ("warn", test) only warns.

    Every table is read once, and all tests together are one exchange: a row tags itself with each test that it fails at
    sight, and with its key for each test of uniqueness or reference; tags are counted by (test, key), in tasks first. Keys are
    compared as text of the same type, so equal tags are equal keys. Nulls are judged by "not_null" only.
    """
    spark = next(iter(tables.values())).sparkSession
    listed: list[tuple[int, str, str, str]] = []
    tags: dict[str, list[Column]] = {}
    long = lambda n: F.lit(n).cast("long")

    def tag(table: str, i: int, when: Column, key: Column, own: int = 0, known: int = 0, bad: int = 0) -> None:
        tags.setdefault(table, []).append(F.when(when, F.struct(F.lit(i).alias("i"), key.alias("key"), long(own).alias("own"), long(known).alias("known"), long(bad).alias("bad"))))

    none = F.lit(None).cast("string")
    for name, columns in declared.items():
        for c, tests in columns.items():
            for test in tests:
                severity, test = (WARN, test[1]) if isinstance(test, tuple) and test[0] == "warn" else (HARD, test)
                kind, i = test if isinstance(test, str) else test[0], len(listed)
                label = f"{name}.{c} {kind}" if kind != "unique_with" else f"{name}.{'+'.join([c, *test[1]])} unique"
                listed.append((i, label, severity, "unique" if kind == "unique_with" else kind))
                if kind == "not_null":
                    tag(name, i, F.col(c).isNull(), none, bad=1)
                elif kind == "in":
                    tag(name, i, ~F.col(c).isin(list(test[1])), none, bad=1)
                elif kind == "unique":
                    tag(name, i, F.col(c).isNotNull(), F.col(c).cast("string"), own=1)
                elif kind == "unique_with":
                    every = [c, *test[1]]
                    tag(name, i, reduce(lambda a, b: a & b, [F.col(x).isNotNull() for x in every]), F.to_json(F.struct(*[F.col(x).cast("string").alias(f"_{k}") for k, x in enumerate(every)])), own=1)
                elif kind == "in_table":
                    kinds = tables[test[1]].schema[test[2]].dataType
                    tag(name, i, F.col(c).isNotNull(), F.col(c).cast(kinds).cast("string"), own=1)
                    tag(test[1], i, F.col(test[2]).isNotNull(), F.col(test[2]).cast("string"), known=1)
                else:
                    raise ValueError(f"no such test: {kind}")
    tagged = [tables[t].select(F.explode(F.filter(F.array(*own), lambda x: x.isNotNull())).alias("x")).select("x.*") for t, own in tags.items()]
    if not tagged:
        return spark.createDataFrame([], "check_name string, severity string, unexpected_count long, passed boolean")
    by_key = reduce(DataFrame.unionByName, tagged).groupBy("i", "key").agg(F.sum("own").alias("own"), F.sum("known").alias("known"), F.sum("bad").alias("bad"))
    of = F.col("i").isin([i for i, _, _, k in listed if k == "unique"])
    lost = F.when(of & (F.col("own") > 1), F.col("own")).when(~of & (F.col("known") == 0), F.col("own")).otherwise(0)
    found = by_key.groupBy("i").agg(F.sum(lost + F.col("bad")).alias("n"))
    names = spark.createDataFrame([x[:3] for x in listed], "i int, check_name string, severity string")
    n = F.coalesce("n", F.lit(0)).cast("long")
    return names.join(F.broadcast(found), "i", "left").select("check_name", "severity", n.alias("unexpected_count"), (n == 0).alias("passed"))


def report(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def gate(found: DataFrame) -> list[str]:
    """Names of the checks that warn; raises if a hard one failed. The report has a row for each check."""
    rows = found.filter("NOT passed").select("check_name", "severity").collect()
    if bad := sorted(r["check_name"] for r in rows if r["severity"] == HARD):
        raise ValueError("failed checks: " + ", ".join(bad))
    return sorted(r["check_name"] for r in rows)
