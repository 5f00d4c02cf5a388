"""Merges, table writes and incremental gates."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millwright.operators.merge import ACTION, merge_into, replace_window, soft_delete_merge
from millwright.plans import silver
from millwright.sources import plants, tables
from millwright.streaming import incremental

NOW = "2024-01-31 00:00:00"
T = "k int, v string, t timestamp_ntz, data_atualizacao_db timestamp_ntz"


def state(df):
    return {r.k: (r.v, str(r.data_atualizacao_db)[:10]) for r in df.collect()}


def test_merge_actions(spark, ts):
    old = "2024-01-01 00:00:00"
    target = ts(
        [(1, "same", old, old), (2, "before", old, old), (3, None, old, old), (4, "gone", "2024-01-30 00:00:00", old), (5, "kept", old, old)], T
    )
    source = ts([(1, "same", old), (2, "after", old), (3, "set", old), (6, "new", old)], "k int, v string, t timestamp_ntz")
    limit = F.lit("2024-01-20").cast("timestamp_ntz")
    merged = merge_into(target, source, ["k"], NOW, missing="delete", missing_where=lambda c: c("t") >= limit)
    assert state(merged) == {
        1: ("same", "2024-01-01"), 2: ("after", "2024-01-31"), 3: ("set", "2024-01-31"), 5: ("kept", "2024-01-01"), 6: ("new", "2024-01-31"),
    }
    actions = merge_into(target, source, ["k"], NOW, missing="delete", missing_where=lambda c: c("t") >= limit, with_action=True)
    assert {r.k: r[ACTION] for r in actions.collect()} == {1: None, 2: "update", 3: "update", 4: "delete", 5: None, 6: "insert"}


def test_merge_rejects_duplicate_source_keys(spark, ts):
    target = ts([(1, "a", NOW, NOW)], T)
    source = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(Exception, match="duplicate merge key"):
        merge_into(target, source, ["k"], NOW).collect()


def test_soft_delete_and_return(spark, ts):
    schema = "k int, v string, ativo boolean, off timestamp_ntz, data_atualizacao_db timestamp_ntz"
    target = ts([(1, "a", True, None, NOW), (2, "b", False, "2024-01-05 00:00:00", NOW), (3, "c", False, "2024-01-05 00:00:00", NOW)], schema)
    source = spark.createDataFrame([(2, "b2")], "k int, v string")
    out = {r.k: (r.v, r.ativo, str(r.off)[:10]) for r in soft_delete_merge(target, source, ["k"], "2024-02-01", deactivated_at="off").collect()}
    assert out == {1: ("a", False, "2024-02-01"), 2: ("b2", True, "None"), 3: ("c", False, "2024-01-05")}


def test_replace_window_ignores_conflicts(spark):
    target = spark.createDataFrame([(1, "old", 1), (2, "old", 9)], "k int, v string, t int")
    source = spark.createDataFrame([(1, "new", 9), (2, "new", 9), (3, "b", 9), (3, "a", 9)], "k int, v string, t int")
    out = replace_window(target, source, F.col("t") > 5, ["k"])
    assert sorted(map(tuple, out.collect())) == [(1, "old", 1), (2, "new", 9), (3, "a", 9)]


def test_cycle_deletes_stay_inside_staged_machines(spark, ts):
    schema = "id_estabelecimento int, id_equipamento int, data_hora timestamp_ntz, ciclo_atual double"
    rows = [(20, 1, "2024-01-30 01:00:00", 1.0), (20, 1, "2024-01-30 02:00:00", 1.0), (20, 2, "2024-01-30 03:00:00", 1.0)]
    target = ts(rows, schema).withColumn("data_atualizacao_db", F.lit(NOW).cast("timestamp_ntz"))
    stage = ts([(20, 1, "2024-01-30 01:00:00", 2.0)], schema)
    out = silver.refreshed_cycles(target, stage, NOW)
    assert sorted((r.id_equipamento, r.ciclo_atual) for r in out.collect()) == [(1, 2.0), (2, 1.0)]


def month_files(path, month):
    return {f for f in path.glob(f"load=*/ano_mes={month}/*.parquet")}


def test_merge_months_rewrites_only_changed_months(spark, ts, tmp_path):
    path = str(tmp_path / "fact")
    old = "2024-01-01 00:00:00"
    rows = [(1, "a", "2023-11-05 00:00:00", old), (2, "b", "2023-12-05 00:00:00", old), (3, "c", "2024-01-05 00:00:00", old), (4, "d", "2024-01-06 00:00:00", old)]
    tables.write_months(ts(rows, T), path, "t")
    source = ts([(3, "c", "2024-01-05 00:00:00"), (4, "D", "2024-01-06 00:00:00")], "k int, v string, t timestamp_ntz")
    limit = F.lit("2023-12-01").cast("timestamp_ntz")
    before = month_files(tmp_path / "fact", "2023-11")
    counts = tables.merge_months(spark, path, source, ["k"], NOW, "t", window=lambda c: c("t") >= limit, missing="delete")
    assert counts == {"delete": 1, "unchanged": 1, "update": 1}
    assert {r.k: (r.v, r.ano_mes) for r in tables.read_months(spark, path).collect()} == {1: ("a", "2023-11"), 3: ("c", "2024-01"), 4: ("D", "2024-01")}
    assert month_files(tmp_path / "fact", "2023-11") == before
    tables.drop_old_versions(spark, path)
    assert {r.k for r in tables.read_months(spark, path).collect()} == {1, 3, 4}
    assert len(list((tmp_path / "fact").glob("load=*"))) == 2


S = "k int, v string, t timestamp_ntz"


@pytest.fixture
def fact(spark, ts, tmp_path):
    path = str(tmp_path / "fact")
    old = "2024-01-01 00:00:00"
    tables.write_months(ts([(1, "a", "2023-11-05 00:00:00", old), (2, "b", "2023-12-05 00:00:00", old), (3, "c", None, old)], T), path, "t")
    return path


def months(spark, path):
    return sorted(((r.k, r.v, r.ano_mes) for r in tables.read_months(spark, path).collect()), key=repr)


def test_merge_months_follows_a_key_into_a_month_that_is_read(spark, ts, fact):
    counts = tables.merge_months(spark, fact, ts([(1, "a", "2023-12-06 00:00:00"), (2, "b", "2023-12-05 00:00:00")], S), ["k"], NOW, "t")
    assert counts == {"update": 1, "unchanged": 1}
    assert months(spark, fact) == [(1, "a", "2023-12"), (2, "b", "2023-12"), (3, "c", "none")]


def test_merge_months_follows_a_key_out_of_a_month_without_source_rows(spark, ts, fact):
    assert tables.merge_months(spark, fact, ts([(1, "z", "2024-02-01 00:00:00")], S), ["k"], NOW, "t") == {"update": 1}
    assert months(spark, fact) == [(1, "z", "2024-02"), (2, "b", "2023-12"), (3, "c", "none")]


def test_merge_months_takes_rows_without_time_and_without_key(spark, ts, fact):
    source = ts([(4, "d", None), (5, "e", "2024-01-05 00:00:00"), (None, "x", None), (None, "x", None), (3, "c", "2023-11-07 00:00:00")], S)
    assert tables.merge_months(spark, fact, source, ["k"], NOW, "t") == {"insert": 4, "update": 1, "unchanged": 1}
    want = [(1, "a", "2023-11"), (2, "b", "2023-12"), (3, "c", "2023-11"), (4, "d", "none"), (5, "e", "2024-01"), (None, "x", "none"), (None, "x", "none")]
    assert months(spark, fact) == sorted(want, key=repr)


def test_merge_months_writes_a_source_without_any_time(spark, ts, fact):
    assert tables.merge_months(spark, fact, ts([(9, "n", None)], S), ["k"], NOW, "t") == {"insert": 1, "unchanged": 1}
    assert (9, "n", "none") in months(spark, fact)


def test_merge_months_failing_half_way_leaves_the_table(spark, ts, fact, monkeypatch):
    before = months(spark, fact)
    publish = tables._publish

    def killed(*args):
        raise RuntimeError("killed")

    monkeypatch.setattr(tables, "_publish", killed)
    source = ts([(1, "z", "2024-02-01 00:00:00")], S)
    with pytest.raises(RuntimeError):
        tables.merge_months(spark, fact, source, ["k"], NOW, "t")
    assert months(spark, fact) == before
    monkeypatch.setattr(tables, "_publish", publish)
    assert tables.merge_months(spark, fact, source, ["k"], NOW, "t") == {"update": 1}
    assert (1, "z", "2024-02") in months(spark, fact)


def test_months_deleted_to_the_last_row(spark, ts, fact):
    assert tables.merge_months(spark, fact, ts([], S), ["k"], NOW, "t", missing="delete") == {"delete": 3}
    assert months(spark, fact) == []
    assert tables.merge_months(spark, fact, ts([(7, "n", "2024-01-01 00:00:00")], S), ["k"], NOW, "t") == {"insert": 1}
    assert months(spark, fact) == [(7, "n", "2024-01")]


def test_full_refresh_keeps_data_when_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1,)], "k int")
    assert tables.stored(spark, path) is None
    assert tables.full_refresh(df, path, NOW)
    assert not tables.full_refresh(df.limit(0), path, NOW)
    assert tables.read_refreshed(spark, path).columns == ["k", "loaded_at"]
    # A table may be refreshed from itself.
    again = tables.read_refreshed(spark, path).select("k")
    assert tables.full_refresh(again.union(again), path, NOW) and tables.read_refreshed(spark, path).count() == 2
    assert tables.full_refresh(df.limit(0), path, NOW, keep_when_empty=False) and tables.read_refreshed(spark, path).count() == 0


def test_a_refresh_killed_half_way_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    computed = spark.sparkContext.accumulator(0)
    with pytest.raises(FileNotFoundError):
        tables.read_refreshed(spark, path)
    tables.full_refresh(spark.createDataFrame([(1,)], "k int"), path, NOW)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(tables, "_publish", killed)
        with pytest.raises(KeyboardInterrupt):
            tables.full_refresh(spark.createDataFrame([(2,)], "k int"), path, NOW)
    (tmp_path / "t" / "versions" / "9").mkdir()  # a version whose write did not end
    assert [r.k for r in tables.read_refreshed(spark, path).collect()] == [1]

    def counted(k):
        computed.add(1)
        return k

    rows = spark.createDataFrame([(k,) for k in range(10)], "k int").select(F.udf(counted, "int")("k").alias("k"))
    assert tables.full_refresh(rows, path, NOW) and computed.value == 10
    assert tables.read_refreshed(spark, path).count() == 10


def test_write_once_leaves_a_finished_table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1,)], "k int")
    assert tables.stored(spark, path) is None
    tables.write_once(df, path)
    tables.write_once(df.union(df), path)
    assert tables.stored(spark, path).count() == 1


def test_empty_then_append(spark, tmp_path):
    path = str(tmp_path / "e")
    df = spark.createDataFrame([(1,)], "k int")
    tables.empty_like(df, path)
    tables.append(df, path)
    assert [r.k for r in tables.read_union(spark, path).collect()] == [1]
    tables.load_stage(df.union(df), path)
    assert tables.read_union(spark, path).count() == 2


def test_gate_and_lookback(spark, ts):
    schema = "m int, t timestamp_ntz"
    source = ts([(1, "2024-01-30 00:00:00"), (2, "2024-01-30 00:00:00"), (3, "2023-01-01 00:00:00")], schema)
    target = ts([(1, "2024-01-30 00:00:00"), (2, "2024-01-29 00:00:00")], schema)
    fresh = incremental.newer_than_target(source, target, ["m"], "t")
    assert sorted(r.m for r in fresh.collect()) == [2, 3]
    assert [r.m for r in incremental.lookback(fresh, "t", NOW, "7").collect()] == [2]
    with pytest.raises(ValueError):
        incremental.lookback(fresh, "t", NOW, "-1")


def test_names_and_ranges():
    assert plants.keyed_names(["Ciclo 12", "Ciclo 0", "Ciclo_Plastisol", "Paradas"]) == {"Ciclo 12": 12}
    chunks = plants.range_predicates("ts", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 9))
    assert chunks[0].startswith("ts >= '2023-12-31 12:00:00'") and chunks[-1].endswith("ts < '2024-01-09 12:00:00'")
    assert len(chunks) == 3
