"""Rules observed by the write, and capture files pruned by their day."""

import datetime as dt
import os
import tempfile

import pytest

from barsmith.operators import quality as QL
from barsmith.sources import captures as C
from barsmith.sources import snapshots as SN

BAR = "ticker string, date date, open double, high double, low double, close double, volume double"
DAY = dt.date(2024, 1, 2)


@pytest.fixture
def root():
    return os.path.join(tempfile.mkdtemp(prefix="barsmith-test-"), "store")


def _bars(spark, *rows):
    return spark.createDataFrame([("A", DAY, *r) for r in rows], BAR)


def test_clean_rows_are_published_with_their_counts(spark, root):
    df = _bars(spark, *[(1.0, 2.0, 0.5, 1.5, 10.0)] * 40, (1.0, 2.0, 0.5, None, 10.0)).repartition(5)
    counts, errors = QL.publish_checked(df, root, "c1")
    assert errors == [] and counts["n_rows"] == 41 and counts["null_close"] == 1 and counts["n_high_lt_low"] == 0
    assert SN.read_commit(spark, root, "c1").count() == 41
    assert QL.publish_checked(df, root, "c1") == (None, [])          # a replay writes and counts nothing
    assert SN.read_commit(spark, root).count() == 41


@pytest.mark.parametrize(("row", "name"), [
    ((1.0, 2.0, 0.5, 0.0, 10.0), "n_nonpositive_price"), ((1.0, 0.4, 0.5, 1.0, 10.0), "n_high_lt_low"),
    ((1.0, 2.0, 0.5, 1.0, -1.0), "n_negative_volume"), ((None, 2.0, 0.5, 1.0, 1.0), "null_open")])
def test_rows_that_break_a_rule_stay_unpublished(spark, root, row, name):
    counts, errors = QL.publish_checked(_bars(spark, row, (1.0, 2.0, 0.5, 1.5, 10.0)), root, "c1")
    assert counts[name] == 1 and len(errors) == 1
    with pytest.raises(LookupError):
        SN.read_commit(spark, root)
    # a mended load under the same name gets through
    assert QL.publish_checked(_bars(spark, (1.0, 2.0, 0.5, 1.5, 10.0)), root, "c1")[1] == []
    assert SN.read_commit(spark, root, "c1").count() == 1


def test_schema_rules_need_no_job(spark, root):
    df = _bars(spark, (1.0, 2.0, 0.5, 1.5, 10.0))
    assert QL.publish_checked(df.selectExpr("*", "string(date) AS day").drop("date").withColumnRenamed("day", "date"), root, "c")[1] == [
        "date is string, not a date or time"]
    assert QL.publish_checked(df.drop("volume"), root, "c") == (None, ["missing column volume"])
    assert not os.path.exists(root)


def test_an_empty_table_is_published(spark, root):
    counts, errors = QL.publish_checked(spark.createDataFrame([], BAR), root, "c1")
    assert errors == [] and set(counts.values()) == {0}
    assert SN.read_commit(spark, root, "c1").count() == 0


def _files_read(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def test_only_the_days_asked_for_are_read(spark, root):
    rows = [(i, f"captures/2024/01/{d:02d}/05/part.jsonl", "{}") for i, d in enumerate(range(1, 31))]
    rows += [(100, "captures/part.jsonl", "x"), (101, None, None), (102, "a/2024/13/40/b", "y")]
    lines = spark.createDataFrame(rows, "id long, path string, value string").coalesce(1)
    C.write_dated(lines, root)
    assert len([f for _, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")]) == 31
    got = C.read_recent(spark, root, lines.schema, "2024-01-30", 3)
    assert sorted(r.id for r in got.collect()) == [26, 27, 28, 29, 100, 101, 102]
    assert got.columns == lines.columns
    assert _files_read(C.read_recent(spark, root, lines.schema, "2024-01-30", 3)) == 5


def test_dated_folders_of_no_lines_and_clashing_columns(spark, root):
    none = spark.createDataFrame([], "id long, path string")
    C.write_dated(none, root)
    assert C.read_recent(spark, root, none.schema, "2024-01-30", 3).count() == 0
    with pytest.raises(ValueError):
        C.write_dated(spark.createDataFrame([(1, "p")], f"{C.DAY} long, path string"), root)
