"""Steps whose sums, partitions or buffers grow with the tables."""

import re

import pytest
from pyspark.sql import functions as F

from millwright.operators.joins import join_sparse
from millwright.plans import improvements as mart
from millwright.plans.oee import COMPONENTS, with_oee
from workload.queries_oee import rounded
from workload.registry import ALL


@pytest.fixture
def dealt(spark):
    """Joins are dealt by their keys alone, over eight partitions."""
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_rows_without_the_sparse_key_are_spread(dealt):
    fact = dealt.range(8000).select("id", F.lit(20).alias("p"), F.when(F.col("id") % 2 == 1, F.col("id")).alias("g"))
    other = dealt.range(100).select(F.lit(20).alias("p"), F.col("id").cast("int").alias("g"), F.lit("x").alias("v"))
    out = join_sparse(fact, other, ["p", "g"], "g", "id")
    sizes = out.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 2000
    assert out.count() == 8000
    assert out.where("v = 'x'").count() == 50


def test_good_seconds_beyond_an_int(spark):
    zeros = ", ".join(f"0D AS {c}" for c in COMPONENTS)
    row = with_oee(spark.sql(f"SELECT 6725878570L AS tempo_util, {zeros}")).first()
    assert row["hrs_boas"] == 6725878570
    assert row["hrs_boas_hms"] == row["tempo_util_hms"] == "19:36:10"


def test_months_are_summed_side_by_side(dealt, ts):
    rows = [(str(i), d, n) for i, d in enumerate(("2024-01-15", "2024-01-28", "2024-01-31", "2024-01-31")) for n in (1, 2, 3, 4)]
    rows += [("2", "2024-01-29", n) for n in (1, 2, 3, 4)] + [("0", "2024-01-15", n) for n in (1, 2)]
    long = ts(rows, "numero_fap string, dt_fap date, mes_offset int").select(
        "numero_fap", "mes_offset", F.add_months("dt_fap", F.col("mes_offset") - 1).alias("dt_competencia"),
        F.lit(1.0).alias("hrs_ganhas"), F.when(F.col("numero_fap") != "1", F.col("mes_offset") * 1.0).alias("ganho_reais"),
    )
    keys = ["numero_fap", "mes_offset", "dt_competencia"]
    plain = long.groupBy(*keys).agg(F.sum("hrs_ganhas").alias("hrs_ganhas"), F.sum("ganho_reais").alias("ganho_reais"))
    out = mart.gains_fact(long)
    assert out.columns == long.columns
    assert sorted(out.collect()) == sorted(plain.collect())
    once = long.where("numero_fap = '0'").coalesce(1)
    assert _largest_table(mart.gains_fact(once)) == 1


def _largest_table(df):
    """Rows of the largest aggregation of ``df``, run without adaptive planning."""
    run = df._jdf.queryExecution()
    run.executedPlan().executeCollect()

    def rows(node):
        own = node.metrics().get("numOutputRows").get().value() if node.nodeName() == "HashAggregate" else 0
        return max([own, *[rows(node.children().apply(i)) for i in range(node.children().size())]])

    return rows(run.executedPlan())


def test_gain_measures_is_compiled(dealt, capsys):
    """The JVM leaves methods above 8000 bytes to its interpreter."""
    ALL["gain_measures"][0](dealt, "/root/testdata/sf0.001").explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_rounded_as_before(spark):
    df = spark.createDataFrame([(1.0000005, -0.0, None), (-2.5e-7, float("nan"), 1e300), (0.1234565, -3.0000015, 0.0)], "a double, b double, c double")
    plain = df.select(*[F.round(c, 6).cast("string").alias(c) for c in df.columns])
    assert rounded(df, "a", "b", "c").select(*[F.col(c).cast("string") for c in df.columns]).collect() == plain.collect()
