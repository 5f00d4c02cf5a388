"""Cases that registered queries do not feed: NULL keys, 64-bit integers, unfinished folders, folded status."""

import os

from millwright.functions import codes
from millwright.functions.typing import typed
from millwright.operators.merge import merge_into
from millwright.plans.context import Period
from millwright.plans.silver import gains_with_master_date, with_master_date
from millwright.sources import tables


def test_source_rows_with_null_keys_are_all_inserted(spark):
    target = spark.createDataFrame([(1, "a"), (None, "old")], "k int, v string")
    source = spark.createDataFrame([(1, "b"), (None, "x"), (None, "x"), (2, "c")], "k int, v string")
    out = merge_into(target, source, ["k"], "2024-01-01")
    assert sorted(((r["k"] or 0), r["v"]) for r in out.collect()) == [(0, "old"), (0, "x"), (0, "x"), (1, "b"), (2, "c")]


def test_whole_numbers_keep_all_digits(spark):
    rows = [("9007199254740993",), ("9223372036854775807",), ("12.0",), ("3.7",), ("1e3",), ("9223372036854775808",), ("x",)]
    out = typed(spark.createDataFrame(rows, "a string"), {"a": "bigint"})
    assert [r["a"] for r in out.collect()] == [9007199254740993, 9223372036854775807, 12, 3, 1000, None, None]


def test_unfinished_folder_is_written_again(spark, tmp_path):
    path = str(tmp_path / "t")
    os.makedirs(f"{path}/_temporary/0")
    tables.write_once(spark.range(3), path)
    tables.write_once(spark.range(5), path)
    assert spark.read.parquet(path).count() == 3


def test_details_have_their_own_sector_list():
    period = Period("2024-01-01", "2024-01-31", as_of="2024-01-31")
    assert 62 in period.excluded_sectors and 62 not in period.excluded_sectors_detail
    assert tuple(period.excluded_sectors_detail) == codes.EXCLUDED_SECTORS_DETAIL


def test_status_is_compared_folded(spark, ts):
    rows = [(1, "APROVADO ", "2024-01-02 00:00:00", None), (2, "Reprovado", "2024-01-02 00:00:00", None)]
    approvals = ts(rows, "id int, status string, dt_aprovacao_eng timestamp_ntz, dt_fap date")
    assert [r["dt_fap"] is not None for r in with_master_date(approvals).orderBy("id").collect()] == [True, False]
    gains = ts([(5, 1, None), (6, None, None)], "id int, id_solicitacao_assinatura int, dt_fap date")
    assert [r["dt_fap"] is not None for r in gains_with_master_date(gains, approvals).orderBy("id").collect()] == [True, False]
