"""Checks of a whole table in one scan, and checks counted while a table is written."""

import random

import pytest

from millwright.operators import quality
from millwright.sources import tables


@pytest.fixture(scope="module")
def rows():
    r = random.Random(2)
    # One key holds half of all rows.
    return [(r.choice([1, 1, 1, None, r.randrange(40)]), r.choice("abc"), r.choice([None, 1.0, 7.5])) for _ in range(2000)]


SCHEMA = "k int, s string, v double"


def test_one_scan_gives_what_separate_checks_give(spark, rows):
    parent = spark.createDataFrame([(k,) for k in (1, 1, 2, 3, None)], "id long")
    for data in (rows, rows[:1], []):
        df = spark.createDataFrame(data, SCHEMA).repartition(3)
        want = quality.report(
            quality.row_checks(df, ["k", "v"], {"s": ["a", "b"]}, {"v": 2}, severity="warn"),
            quality.unique(df, ["k"]),
            quality.unique(df, ["k", "s"]),
            quality.relationship(df, "k", parent, "id"),
        )
        got = quality.table_checks(
            df, [["k"], ["k", "s"]], ["k", "v"], {"s": ["a", "b"]}, {"v": 2}, {"k": (parent, "id")}, {"rows": "warn"}
        )
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_reference_counts_by_hand(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (9, "a", 1.0), (9, "b", 1.0), (None, "a", None)], SCHEMA)
    parent = spark.createDataFrame([(1,), (1,), (5,)], "id int")
    got = {r["teste"]: (r["falhas"], r["situacao"]) for r in quality.table_checks(df, [["s"]], parents={"k": (parent, "id")}).collect()}
    assert got == {"unique:s": (1, "error"), "relationships:k": (2, "warn")}
    assert quality.table_checks(df, not_null=["v"]).collect()[0]["falhas"] == 1


def test_each_table_is_scanned_once(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    checks = quality.table_checks(df, [["k"], ["k", "s"]], ["v"], {"s": ["a"]}, {"v": 2})
    plan = checks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_write_counts_and_gates(spark, tmp_path, rows):
    path = f"{tmp_path}/gated"
    good = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], SCHEMA)
    checks = quality.WriteChecks(good, ["k"], {"s": ["a", "b"]}, {"v": 0})
    assert tables.full_refresh(checks.rows, path, "2024-01-01 00:00:00", accept=checks.passed)
    bad = spark.createDataFrame(rows, SCHEMA).repartition(5)
    checks = quality.WriteChecks(bad, ["k"], {"s": ["a", "b"]}, {"v": 2})
    assert not tables.full_refresh(checks.rows, path, "2024-01-02 00:00:00", accept=checks.passed)
    assert checks.failures() == {
        "not_null:k": sum(k is None for k, _, _ in rows),
        "accepted_values:s": sum(s == "c" for _, s, _ in rows),
        "accepted_range:v": sum(v == 1.0 for _, _, v in rows),
    }
    assert {r["situacao"] for r in checks.report().collect()} == {"error"}
    assert sorted(r["k"] for r in tables.read_refreshed(spark, path).collect()) == [1, 2]
    warned = quality.WriteChecks(bad, ["k"], severity="warn")
    assert tables.full_refresh(warned.rows, path, "2024-01-03 00:00:00", accept=warned.passed)
    assert tables.read_refreshed(spark, path).count() == len(rows)
    none = quality.WriteChecks(bad.limit(0), ["k"])
    assert not tables.full_refresh(none.rows, path, "2024-01-04 00:00:00", accept=none.passed)
    assert none.failures() == {"not_null:k": 0}
