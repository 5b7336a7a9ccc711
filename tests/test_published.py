"""Snapshot commits, the stored baseline, and late rows of a stream."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from barsmith.sources import snapshots as SN
from barsmith.streaming.late import late_rows
from barsmith.streaming.streams import BATCH


@pytest.fixture
def root():
    return os.path.join(tempfile.mkdtemp(prefix="barsmith-test-"), "store")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_commits_are_seen_whole_once_and_in_order(spark, root):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(3, "z")], "k int, v string")
    assert SN.manifest(spark, root).isEmpty()
    with pytest.raises(LookupError):
        SN.read_commit(spark, root)
    with pytest.raises(LookupError):
        SN.read_all(spark, root)
    assert SN.publish(a, root, "20240102") and SN.publish(b, root, "20240101")
    assert not SN.publish(b, root, "20240102")          # a replay adds nothing
    assert _rows(SN.read_commit(spark, root)) == _rows(a)
    assert _rows(SN.read_commit(spark, root, "20240101")) == _rows(b)
    assert _rows(SN.read_all(spark, root).drop("commit")) == _rows(a.union(b))
    assert {r.commit: r.n_rows for r in SN.manifest(spark, root).collect()} == {"20240102": 3, "20240101": 1}
    assert SN.publish(b, root, "correction", position="20240103")
    assert _rows(SN.read_commit(spark, root)) == _rows(b)
    assert SN.publish(a.limit(0), root, "none", position="20240104") and SN.read_commit(spark, root).isEmpty()


def test_an_unpublished_attempt_is_invisible(spark, root):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    SN.publish(a, root, "one")
    # a job that died between its rows and its manifest row, of this and of another commit
    a.write.parquet(SN._folder(root, "data", "one", "dead"))
    a.write.parquet(SN._folder(root, "data", "two", "dead"))
    assert _rows(SN.read_all(spark, root)) == [(1, "x", "one")]
    assert SN.publish(a, root, "two")
    assert _rows(SN.read_all(spark, root)) == [(1, "x", "one"), (1, "x", "two")]


def test_two_writers_of_one_commit_count_once(spark, root):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    SN.publish(a, root, "one")
    row = SN.manifest(spark, root).first()
    a.write.parquet(SN._folder(root, "data", "one", "zz"))
    spark.createDataFrame([("one", 1, row.schema)], "position string, n_rows long, schema string") \
        .write.parquet(SN._folder(root, "manifest", "one", "zz"))
    assert _rows(SN.read_all(spark, root)) == [(1, "x", "one")]


def test_publish_refuses_other_columns_and_names(spark, root):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    SN.publish(a, root, "one")
    with pytest.raises(ValueError, match="differ"):
        SN.publish(a.select("v", "k"), root, "two")
    with pytest.raises(ValueError, match="commit"):
        SN.publish(a, root, "a/b")
    with pytest.raises(ValueError, match="layout"):
        SN.publish(a.withColumn("Attempt", F.lit(1)), root, "three")
    assert _rows(SN.read_all(spark, root)) == [(1, "x", "one")]


def test_documents_keep_values_and_nulls(spark, root):
    d = spark.createDataFrame([("a", 0.1 + 0.2, [1.5e-300, -0.0], [3, None]), ("b", None, None, [])],
                              "f string, x double, e array<double>, c array<long>")
    SN.write_documents(d, root)
    assert _rows(SN.read_documents(spark, root, d.schema)) == _rows(d)
    spark.createDataFrame([("no json",)], "value string").write.mode("append").text(root)
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        SN.read_documents(spark, root, d.schema).collect()


def test_fingerprint_follows_rows_not_order(spark):
    a = spark.createDataFrame([(1, 2.0), (2, None), (2, None)], "k int, v double")
    assert SN.fingerprint(a) == SN.fingerprint(a.orderBy(F.desc("k")).repartition(3))
    others = [a.distinct(), a.limit(0), a.withColumn("v", F.lit(1.0)), a.union(a)]
    assert len({SN.fingerprint(x) for x in [a, *others]}) == 5


def test_baseline_is_fitted_once_for_the_same_rows(spark, monkeypatch):
    from barsmith.plans import q_drift as QD

    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(QD, "checkpoint_dir", lambda s, d=tempfile.mkdtemp(prefix="barsmith-test-"): d)
    calls, fit = [], QD.baseline_stats
    monkeypatch.setattr(QD, "baseline_stats", lambda *a, **k: calls.append(1) or fit(*a, **k))
    first = _rows(QD.stored_baseline(spark, sf))
    assert _rows(QD.stored_baseline(spark, sf)) == first and len(calls) == 1
    window = QD._event_base(spark, sf)
    monkeypatch.setattr(QD, "_event_base", lambda *a: window.filter("event_id > 3"))
    assert _rows(QD.stored_baseline(spark, sf)) != first and len(calls) == 2


@pytest.mark.parametrize("window_s", [0, 60])
def test_late_rows_against_a_loop(spark, root, window_s):
    t0 = dt.datetime(2024, 1, 1, 12)
    at = lambda *m: [None if x is None else t0 + dt.timedelta(seconds=x) for x in m]
    landings = [at(0, 30, 600, None), at(5, 539, 540, 541, 700, 700), at(), at(601, 640, 2000), at(None, 1880, 1941, 50)]
    src = os.path.join(root, "in")
    schema = "id int, ts timestamp"
    want, stats, high, n = [], [], None, 0
    for b, times in enumerate(landings):
        rows = [(n + i, t) for i, t in enumerate(times)]
        n += len(rows)
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        late, batches = late_rows(spark.readStream.schema(schema).parquet(src), "ts", 60, window_s, root=os.path.join(root, "out"))
        end = lambda t: t if not window_s else t.replace(second=0) + dt.timedelta(minutes=1)
        mine = [(i, t, b) for i, t in rows if t and high and end(t) <= high - dt.timedelta(seconds=60)]
        want += mine
        stats.append((len(rows), len(mine), sum(t is None for _, t in rows), b))
        high = max([t for t in [high, *times] if t], default=None)
    assert _rows(late.select("id", "ts", BATCH)) == sorted(want, key=repr) and want
    assert sorted(map(tuple, batches.select("n_rows", "n_late", "n_undated", BATCH).collect()), key=lambda r: r[-1]) == stats


def test_late_rows_of_an_empty_source(spark, root):
    src = os.path.join(root, "in")
    os.makedirs(src)
    late, batches = late_rows(spark.readStream.schema("id int, ts timestamp").parquet(src), "ts", 60, root=os.path.join(root, "out"))
    assert late.columns == ["id", "ts", BATCH] and late.isEmpty() and batches.isEmpty()


def test_late_rows_hold_all_that_a_stateful_operator_drops(spark, root):
    t0 = dt.datetime(2024, 1, 1)
    src, kept, total = os.path.join(root, "in"), 0, 0
    for k, minutes in enumerate([(0, 5, 100), (1, 50, 200), (2, 101, 300), (3, 150, 299)]):
        rows = [(t0 + dt.timedelta(minutes=m),) for m in minutes]
        total += len(rows)
        spark.createDataFrame(rows, "ts timestamp").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("ts timestamp").parquet(src)
        late, _ = late_rows(stream, "ts", 600, 60, root=os.path.join(root, "out"))
        counts = stream.withWatermark("ts", "600 seconds").groupBy(F.window("ts", "60 seconds")).count()
        q = (counts.writeStream.outputMode("update").foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(os.path.join(root, f"agg-{i}")))
             .option("checkpointLocation", os.path.join(root, "ckpt")).trigger(availableNow=True).start())
        q.awaitTermination()
    kept = spark.read.parquet(os.path.join(root, "agg-*")).agg(F.sum("count")).first()[0]
    assert 0 < total - kept <= late.count()
