import os
import tempfile

import pytest
from pyspark.sql import functions as F

from lateline import schemas
from lateline.sinks import writers as W


def test_enforce_schema_and_codes(spark):
    df = spark.createDataFrame([("s1", 12345, "c", "SP", "extra")],
                               "seller_id string, seller_zip_code_prefix int, seller_city string, "
                               "seller_state string, junk string")
    out = W.enforce_schema(W.stringify_codes(df), schemas.DIM_SELLERS)
    assert out.columns == [f.name for f in schemas.DIM_SELLERS.fields]
    assert out.first().seller_zip_code_prefix == "12345"
    with pytest.raises(ValueError):
        W.enforce_schema(df.drop("seller_city"), schemas.DIM_SELLERS)


def test_publish_swaps_and_counts(spark):
    d = tempfile.mkdtemp(prefix="pub-", dir="/tmp")
    t = {"dim_sellers": spark.createDataFrame([("s1", 1, "c", "SP")], schemas.SELLERS)}
    c1 = W.publish(t, d, "r1")
    assert c1 == {"dim_sellers": 1}
    t2 = {"dim_sellers": spark.createDataFrame([("s1", 1, "c", "SP"), ("s2", 2, "c", "RJ")], schemas.SELLERS)}
    W.publish(t2, d, "r2")
    assert spark.read.parquet(f"{d}/dim_sellers").count() == 2
    assert spark.read.parquet(f"{d}/_previous/dim_sellers").count() == 1


def test_report_retention(spark):
    d = tempfile.mkdtemp(prefix="rep-", dir="/tmp")
    res = spark.createDataFrame([("c", "PASS")], "check string, status string")
    for w in ["2026-W20", "2026-W21", "2026-W22", "2026-W23", "2026-W24"]:
        W.append_report(res, f"{d}/r", w, "run")
    dropped = W.report_retention(spark, f"{d}/r", keep=4)
    assert dropped == ["2026-W20"]
    assert sorted(os.listdir(f"{d}/r"))[0].startswith("_") or "week=2026-W20" not in os.listdir(f"{d}/r")


def test_snapshot_replay(spark):
    from lateline.sources import read_snapshot
    d = tempfile.mkdtemp(prefix="snap-", dir="/tmp")
    W.write_snapshot(spark.createDataFrame([(1,)], "x int"), f"{d}/orders", "20260101_000000")
    W.write_snapshot(spark.createDataFrame([(2,), (3,)], "x int"), f"{d}/orders", "20260108_000000")
    assert read_snapshot(spark, f"{d}/orders").count() == 2
    assert read_snapshot(spark, f"{d}/orders", "20260101_000000").first().x == 1


def test_extract_then_replay(spark):
    import datetime as dt
    from lateline.plans.extract import extract, replay
    from lateline.sources import synthetic_tables
    d = tempfile.mkdtemp(prefix="ext-", dir="/tmp")
    t = synthetic_tables(spark, "/root/testdata/sf0.001")
    paths = {}
    for name, df in t.as_dict().items():
        paths[name] = f"{d}/src/{name}"
        df.write.parquet(paths[name])
    l1 = extract(spark, paths, f"{d}/lake", f"{d}/raw", dt.datetime(2026, 1, 1), fmt="parquet")
    l2 = extract(spark, paths, f"{d}/lake", f"{d}/raw", dt.datetime(2026, 1, 8), fmt="parquet")
    assert (l1, l2) == ("20260101_000000", "20260108_000000")
    r = replay(spark, f"{d}/lake", l1)
    assert r.orders.count() == t.orders.count()
    assert spark.read.parquet(f"{d}/lake/orders").select("snapshot_ts").distinct().count() == 2
    assert spark.read.parquet(f"{d}/raw/orders").count() == t.orders.count()


def test_retried_snapshot_and_report_do_not_double(spark):
    from lateline.sources import read_snapshot
    d = tempfile.mkdtemp(prefix="retry-", dir="/tmp")
    for _ in range(2):
        W.write_snapshot(spark.range(10).toDF("x"), f"{d}/orders", "20260101_000000")
        W.append_report(spark.createDataFrame([("c", "PASS")], "check string, status string"), f"{d}/r", "2026-W20", "run1")
    W.append_report(spark.createDataFrame([("c", "FAIL")], "check string, status string"), f"{d}/r", "2026-W20", "run2")
    assert read_snapshot(spark, f"{d}/orders").count() == 10
    s = W.report_summary(spark.read.parquet(f"{d}/r")).collect()
    assert [(r.run_ts, r.total, r.failed) for r in s] == [("run1", 1, 0), ("run2", 1, 1)]


def test_failed_swap_puts_all_tables_back(spark, monkeypatch):
    d = tempfile.mkdtemp(prefix="swap-", dir="/tmp")
    old = {n: spark.range(1).toDF("x") for n in ("a", "b", "c")}
    W.publish(old, d, "r1")
    real_fs = W._fs

    class Flaky:
        """A file system whose move of the second staged table fails."""
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, k):
            return getattr(self.fs, k)

        def rename(self, a, b):
            if str(a.toString()).endswith("_staging/r2/b"):
                return False
            return self.fs.rename(a, b)

    monkeypatch.setattr(W, "_fs", lambda s, p: (Flaky(real_fs(s, p)[0]), *real_fs(s, p)[1:]))
    with pytest.raises(RuntimeError):
        W.publish({n: spark.range(5).toDF("x") for n in ("a", "b", "c")}, d, "r2")
    assert [spark.read.parquet(f"{d}/{n}").count() for n in ("a", "b", "c")] == [1, 1, 1]


@pytest.mark.parametrize("broken", ["table", "manifest", "move", "retention"])
def test_reader_has_one_whole_version_whatever_fails(spark, monkeypatch, broken):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    names = ("a", "b", "c")
    version = lambda n: {x: spark.range(n).toDF("x") for x in names}
    for n in (1, 2):
        W.publish_run(version(n), d, f"r{n}")
    real_fs = W._fs

    class Flaky:
        """A file system that fails at one step."""
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, k):
            return getattr(self.fs, k)

        def create(self, p, over):
            if broken == "manifest":
                raise OSError("no space")
            return self.fs.create(p, over)

        def rename(self, a, b):
            return False if broken == "move" else self.fs.rename(a, b)

        def delete(self, p, deep):
            if broken == "retention":
                raise OSError("gone")
            return self.fs.delete(p, deep)

    tables = version(3)
    if broken == "table":
        tables["c"] = tables["c"].select(F.assert_true(F.lit(False)).alias("x"))
    monkeypatch.setattr(W, "_fs", lambda s, p: (Flaky(real_fs(s, p)[0]), *real_fs(s, p)[1:]))
    with pytest.raises(Exception):  # noqa: B017
        W.publish_run(tables, d, "r3")
    monkeypatch.undo()
    want = 3 if broken == "retention" else 2  # the move of the manifest decides
    assert [W.read_published(spark, d, n).count() for n in names] == [want] * 3
    W.publish_run(version(4), d, "r4")
    assert [W.read_published(spark, d, n).count() for n in names] == [4] * 3
    assert [W.read_published(spark, d, n, back=1).count() for n in names] == [want] * 3


def test_old_versions_go(spark):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for n in range(4):
        W.publish_run({"a": spark.range(n).toDF("x")}, d, f"r{n}")
    assert len(os.listdir(f"{d}/runs")) == 2 and W.published(spark, d)["tables"]["a"]["rows"] == 3
    with pytest.raises(ValueError):
        W.read_published(spark, d, "b")


def test_failed_write_keeps_the_latest_copy(spark):
    d = tempfile.mkdtemp(prefix="latest-", dir="/tmp")
    W.write_latest(spark.range(3).toDF("x"), f"{d}/t")
    with pytest.raises(Exception):  # noqa: B017
        W.write_latest(spark.range(5).select(F.assert_true(F.col("id") < 3).alias("x")), f"{d}/t")
    assert spark.read.parquet(f"{d}/t").count() == 3
    W.write_latest(spark.range(4).toDF("x"), f"{d}/t")
    assert spark.read.parquet(f"{d}/t").count() == 4
