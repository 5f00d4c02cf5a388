"""The salted path gives the same results as the broadcast one, also with one hot key."""

import pytest
from pyspark.sql import functions as F

from millwright.operators.joins import LIMIT_KEY, join_dimension, join_sparse
from workload.compare import connect, difference
from workload.registry import ALL

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    keys = {LIMIT_KEY: "0", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_key_is_spread(spark, no_broadcast):
    fact = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("k"))
    dim = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = join_dimension(fact, dim, ["k"], "left")
        tasks = out.where("k = 1").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tasks > 4
    assert out.count() == 30_000
    assert out.where("v IS NULL").count() == fact.where("k >= 40").count()
    assert out.where("v <> k * 2").count() == 0


def test_sparse_key(spark):
    fact = spark.range(100).select("id", F.when(F.col("id") % 4 == 0, F.col("id")).alias("g"))
    other = spark.createDataFrame([(8, "x")], "g bigint, v string")
    out = join_sparse(fact, other, ["g"], "g", "id")
    assert out.count() == 100
    assert [r.id for r in out.where("v = 'x'").collect()] == [8]


@pytest.mark.parametrize("name", ["oee_product_day", "stop_detail", "gold_stops", "gold_quality", "gains_long"])
def test_large_dimension_path(spark, no_broadcast, name):
    query, sql = ALL[name]
    assert difference(query(spark, SF), connect(SF), sql) is None
