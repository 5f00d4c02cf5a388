"""The continuous merge against one merge of all rows."""

import pytest

from millwright.operators.dedup import latest_per_key
from millwright.operators.merge import merge_into
from millwright.sources import tables
from millwright.streaming import continuous

SCHEMA = "id long, dia timestamp_ntz, versao int, valor string"
TABLE = SCHEMA + ", data_atualizacao_db timestamp_ntz"
AS_OF, BEFORE = "2024-05-01 00:00:00", "2024-01-01 00:00:00"


def row(i, version, value=None, month=1):
    return (i, f"2024-0{month}-1{version} 00:00:00", version, value or f"v{version}")


@pytest.fixture
def stored(ts):
    return ts([(*row(1, 1), BEFORE), (*row(2, 5), BEFORE), (*row(8, 0), BEFORE)], TABLE)


def test_batches_in_any_order_end_like_one_merge(spark, ts, tmp_path, stored):
    landed, table, checkpoint = (str(tmp_path / n) for n in ("landed", "table", "checkpoint"))
    tables.write_months(stored, table, "dia")
    arrivals = [
        [row(1, 3, month=2), row(2, 4), row(3, 1), row(3, 1), row(None, 1)],  # 2 is older than what is stored
        [row(1, 2), row(3, 1), row(4, 2, "b"), row(4, 2, "a"), row(5, 1)],  # 1 is late, 3 is repeated, 4 has a tie
        [row(5, 0), row(6, 1), row(4, 2, "c")],
    ]
    for k, rows in enumerate(arrivals):
        ts(rows, SCHEMA).coalesce(1).write.mode("append").parquet(landed)
        if k == 0:
            ts([row(7, 1)], SCHEMA).coalesce(1).write.mode("append").parquet(landed)
        # A new query from the same checkpoint each time: a restart.
        stream = continuous.landed_stream(spark, landed, SCHEMA, max_files=1)
        n = continuous.merge_available(stream, table, checkpoint, ["id"], AS_OF, "versao", "dia")
        assert n == (2 if k == 0 else 1)
    every = ts([r for rows in arrivals for r in rows] + [row(7, 1), row(1, 1), row(2, 5), row(8, 0)], SCHEMA).where("id IS NOT NULL")
    want = merge_into(stored, latest_per_key(every, ["id"], "versao"), ["id"], AS_OF).collect() + ts([(*row(None, 1), AS_OF)], TABLE).collect()
    got = tables.read_months(spark, table).drop("ano_mes").collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
    # Nothing new: no micro-batch, the same table.
    assert continuous.merge_available(stream, table, checkpoint, ["id"], AS_OF, "versao", "dia") == 0


def test_a_micro_batch_merged_twice_changes_nothing(spark, ts, tmp_path, stored):
    table = str(tmp_path / "table")
    tables.write_months(stored, table, "dia")
    step = continuous.merging(table, ["id"], AS_OF, "versao", "dia")
    rows = ts([row(1, 2), row(9, 1), row(9, 2), row(None, 1)], SCHEMA)
    step(rows, 0)
    once = sorted(map(str, tables.read_months(spark, table).collect()))
    versions = tables._current(spark, table)[0]
    step(rows, 0)
    step(ts([row(1, 0)], SCHEMA), 1)
    assert sorted(map(str, tables.read_months(spark, table).collect())) == once and tables._current(spark, table)[0] == versions
    step(rows.limit(0), 2)
    assert len(once) == 5
