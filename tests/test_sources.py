"""Readers and writers on small files."""

from __future__ import annotations

import json
import re
import zipfile

import pytest

from pyspark.sql import functions as F

from skein import steps
from skein.operators import quality
from skein.sources import files, published, sinks


def zipped(path, **members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(name.replace("__", "."), text)
    return str(path)


def test_zip_checks(spark, tmp_path):
    (tmp_path / "x.zip").write_text("no zip")
    for path, says in ((str(tmp_path / "x.zip"), "not a zip"), (zipped(tmp_path / "two.zip", a__csv="x\n1\n", b__csv="x\n1\n"), "2 CSV files"), (zipped(tmp_path / "none.zip", a__txt="x"), "0 CSV files"), (zipped(tmp_path / "lost.zip", a__csv="y\n1\n"), "not in")):
        with pytest.raises(Exception, match=says):
            files.read_zipped_csv(spark, path, {"x": "x"}).collect()


@pytest.mark.parametrize("rows_at_a_time", [7, 20_000])
def test_zips_are_read_in_tasks(spark, tmp_path, rows_at_a_time):
    """Quoted line ends, quotes and commas; blanks stay blanks; other columns are left out; several zips, unlike in column order."""
    rows = [(f"{i:04d}", "" if i % 3 else "N\n1", f'a,"b"\r\n{i}', "x") for i in range(300)]
    quoted = lambda v: '"' + v.replace('"', '""') + '"'
    one = "Time,Tail,Said,Other\n" + "".join(f"{t},{quoted(n) if n else ''},{quoted(s)},{o}\n" for t, n, s, o in rows[:200])
    two = "Other,Said,Tail,Time\n" + "".join(f"{o},{quoted(s)},{quoted(n) if n else ''},{t}\n" for t, n, s, o in rows[200:])
    paths = [zipped(tmp_path / "one.zip", m1__csv=one, read__me="x"), zipped(tmp_path / "two.zip", m2__csv=two), zipped(tmp_path / "empty.zip", m3__csv="Time,Tail,Said\n")]
    got = files.read_zipped_csv(spark, paths, {"Time": "t", "Tail": "tail", "Said": "said"}, rows=rows_at_a_time, loaded_at="2024-01-01 00:00:00")
    assert got.columns == ["t", "tail", "said", "source_file", "loaded_at"]
    assert sorted((r["t"], r["tail"], r["said"], r["source_file"]) for r in got.collect()) == [(t, n, s, "m1.csv" if i < 200 else "m2.csv") for i, (t, n, s, _) in enumerate(rows)]


def test_text_csv_keeps_zeros_and_blanks(spark, tmp_path):
    (tmp_path / "m.csv").write_text("Time,Tail,Other\n0005,,x\n2400,N1,y\n")
    df = files.read_text_csv(spark, str(tmp_path / "m.csv"), {"Time": "t", "Tail": "tail"}, loaded_at="2024-01-01 00:00:00")
    assert sorted((r["t"], r["tail"], r["source_file"]) for r in df.collect()) == [("0005", "", "m.csv"), ("2400", "N1", "m.csv")]
    with pytest.raises(ValueError):
        files.read_text_csv(spark, str(tmp_path / "m.csv"), {"Lost": "x"})


def test_hourly_json(spark, tmp_path):
    names = list(files.schemas.HOURLY)
    (tmp_path / "w.json").write_text(json.dumps([{"airport_code": "JFK", "hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"]} | {n: [1.0, None] for n in names}}]))
    got = sorted((r["ts_utc"].hour, r["temperature_c"]) for r in files.read_hourly(spark, str(tmp_path / "w.json"), loaded_at="2024-01-01 00:00:00").collect())
    assert got == [(0, 1.0), (1, None)]


def test_month_range():
    assert files.month_range("2024-02-17") == ("2024-01-31", "2024-03-01")
    assert files.month_range("2024-12-01") == ("2024-11-30", "2025-01-01")


def test_refresh_and_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.checked_refresh(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), path, ["k"])
    assert sinks.upsert_table(spark, path, spark.createDataFrame([(1, "a"), (2, "c"), (3, "d")], "k int, v string"), ["k"]) == 2
    assert sinks.upsert_table(spark, path, spark.createDataFrame([(1, "a")], "k int, v string"), ["k"]) == 0
    (tmp_path / "t").rename(tmp_path / "t.old")  # as a failure between the renames leaves it
    assert sinks.upsert_table(spark, path, spark.createDataFrame([(2, "c")], "k int, v string"), ["k"]) == 0
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "c"), (3, "d")]
    with pytest.raises(ValueError):
        sinks.checked_refresh(spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string"), path, ["k"])
    assert sinks.has_rows(spark.range(5), 5) and not sinks.has_rows(spark.range(5), 6)


def test_cache_misses(spark):
    want, have = spark.createDataFrame([("a",), ("b",), ("b",)], "k string"), spark.createDataFrame([("a",)], "k string")
    assert [r["k"] for r in files.missing_from_cache(want, have, "k").collect()] == ["b"]


# published tables


def contents(p, version=None):
    return {n: sorted(tuple(r) for r in p.read(n, version).collect()) for n in p.manifest(version)["tables"]}


@pytest.fixture
def two(spark, tmp_path):
    """A published version of a keyed and a plain table."""
    p = published.Publication(spark, f"file://{tmp_path}/pub")
    assert p.manifest() == {"version": 0, "tables": {}}
    a, b = spark.createDataFrame([(i, f"v{i}", None if i % 2 else 1.5) for i in range(60)], "k long, v string, w double"), spark.createDataFrame([(1, None)], "x int, y string")
    assert p.publish({"a": a, "b": b}, {"a": ["k"]}, buckets=8) == 1
    return p


def test_versions_are_whole(spark, two):
    before = contents(two)
    assert len(before["a"]) == 60 and before["b"] == [(1, None)]
    assert two.publish({"b": spark.createDataFrame([(2, "z")], "x int, y string")}) == 2
    assert contents(two)["b"] == [(2, "z")] and contents(two)["a"] == before["a"] and contents(two, 1) == before
    assert two.publish({"a": spark.createDataFrame([], "k long, v string, w double")}, {"a": ["k"]}) == 3
    assert contents(two)["a"] == [] and two.read("a").columns == ["k", "v", "w"]
    assert two.upsert("a", spark.createDataFrame([(5, "n", None)], "k long, v string, w double")) == (1, 0)
    assert contents(two)["a"] == [(5, "n", None)]


@pytest.mark.parametrize("fault", ["second table", "check", "key", "null key", "manifest", "rename", "other writer"])
def test_a_failure_leaves_the_old_version(spark, two, monkeypatch, fault):
    before, names = contents(two), two.versions()
    a, b = spark.createDataFrame([(1, "new", 0.0)], "k long, v string, w double"), spark.createDataFrame([(9, "q")], "x int, y string")
    checks = None
    if fault == "second table":
        real = two._write
        monkeypatch.setattr(two, "_write", lambda name, *rest: real(name, *rest) if name == "a" else (_ for _ in ()).throw(OSError("disk")))
    elif fault == "check":
        checks = lambda t: quality.row_checks(t["b"], [quality.Check("none", F.col("x") == 9)])
    elif fault == "key":
        a = a.union(a)
    elif fault == "null key":
        a = spark.createDataFrame([(None, "new", 0.0)], "k long, v string, w double")
    elif fault in ("manifest", "rename"):
        real_fs = two._fs

        class Fs:
            def __getattr__(self, n):
                if fault == "manifest" and n == "create":
                    raise OSError("disk")
                return (lambda *_: False) if fault == n == "rename" else getattr(real_fs(), n)

        monkeypatch.setattr(two, "_fs", Fs)
    else:
        stale = two.manifest()
        two.publish({"c": b})
        before, names = contents(two), two.versions()
        monkeypatch.setattr(two, "manifest", lambda version=None: stale)
    with pytest.raises((OSError, ValueError, RuntimeError)):
        two.publish({"a": a, "b": b}, {"a": ["k"]}, checks)
    monkeypatch.undo()
    assert two.versions() == names and contents(two) == before
    two.clean()
    assert contents(two) == before


def test_upsert_rewrites_only_what_changes(spark, two):
    before = two.manifest()["tables"]["a"]["folders"]
    schema = "k long, v string, w double"
    assert two.upsert("a", spark.createDataFrame([(3, "v3", None), (4, "v4", 1.5)], schema)) == (0, 0) and two.versions() == [1]
    assert two.upsert("a", spark.createDataFrame([(3, "v3", 2.0), (4, "v4", 1.5), (7, None, None)], schema)) == (0, 2)
    after = two.manifest()["tables"]["a"]["folders"]
    moved = {b for b in after if after[b] != before[b]}
    assert 1 <= len(moved) <= 2 and set(after) == set(before)
    assert dict((k, (v, w)) for k, v, w in contents(two)["a"])[3] == ("v3", 2.0) and len(contents(two)["a"]) == 60
    assert two.upsert("a", spark.createDataFrame([(1000, "i", 1.0), (3, "v3", 2.0)], schema)) == (1, 0) and len(contents(two)["a"]) == 61
    with pytest.raises(ValueError):
        two.upsert("a", spark.createDataFrame([(1, "x", 1.0), (1, "y", 1.0)], schema))
    with pytest.raises(ValueError):
        two.upsert("b", spark.createDataFrame([(1, "x")], "x int, y string"))
    last = contents(two)
    assert two.clean(keep=1) > 0 and contents(two) == last and two.versions() == [3] and two.clean(keep=1) == 0


def test_checks_in_one_exchange(spark):
    """Every kind of declared test against counts by hand, with nulls, repeats and unlike types; one exchange by key."""
    a = spark.createDataFrame([(1, "x", 1, None), (1, "x", 2, "k"), (2, None, 9, "k"), (None, "z", None, "l")], "id int, s string, ref int, c string")
    b = spark.createDataFrame([(1,), (2,), (2,)], "rid long")
    found = quality.suite({"a": a, "b": b}, {"a": {"id": ["unique", "not_null", ("unique_with", ["s"]), ("unique_with", ["s", "ref"])], "s": [("in", ["x", "y"]), ("warn", "unique")], "ref": [("in_table", "b", "rid"), "not_null"]}, "b": {"rid": ["unique"]}})
    got = {r["check_name"]: (r["severity"], r["unexpected_count"], r["passed"]) for r in found.collect()}
    assert got == {
        "a.id unique": ("error", 2, False), "a.id not_null": ("error", 1, False), "a.id+s unique": ("error", 2, False), "a.id+s+ref unique": ("error", 0, True),
        "a.s in": ("error", 1, False), "a.s unique": ("warn", 2, False), "a.ref in_table": ("error", 1, False), "a.ref not_null": ("error", 1, False), "b.rid unique": ("error", 2, False),
    }
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert len(re.findall(r"Exchange hashpartitioning\(i#\d+, key#\d+", plan)) == 1 and "SortMergeJoin" not in plan
    with pytest.raises(ValueError):
        quality.suite({"a": a}, {"a": {"id": ["no such test"]}})


def test_steps_need_a_shared_folder(spark, tmp_path):
    for path in (f"file://{tmp_path}", str(tmp_path)):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            steps.distributed(spark, path)
    assert steps.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
