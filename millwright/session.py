"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the plans were tuned with; a cluster session may override any of them.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
    # The JVM never compiles methods above 8000 bytes; wider plans are then generated as many small methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def recommended(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder


def local_session(cpus: int | str | None = None, name: str = "millwright") -> SparkSession:
    """Session for tests and the benchmark; on a cluster use :func:`recommended`."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
    )
    spark = recommended(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the session names in ``spark.checkpoint.dir``.

    Only where it is unset (tests on one machine) a local folder is chosen.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        path = tempfile.mkdtemp(prefix="millwright-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path
