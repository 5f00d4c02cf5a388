"""Files and partitioned tables on a shared file system."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millwright.functions import clock
from millwright.functions.clock import AsOf
from millwright.operators.merge import ACTION, Rule, merge_into
from millwright.session import checkpoint_dir


# Partition value of rows without a timestamp.
NO_MONTH = "none"
# What a version calls the only part of a table that is replaced as a whole.
WHOLE = "all"


def month_of(ts: Column) -> Column:
    """Partition value of a fact row."""
    return F.coalesce(F.date_format(ts, "yyyy-MM"), F.lit(NO_MONTH))


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None when nothing was written there yet."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _located(spark: SparkSession, path: str):
    """File system and path object of ``path``."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` ended: its success marker is there, whatever else is."""
    fs, marker = _located(spark, f"{path}/_SUCCESS")
    return fs.exists(marker)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in ``path``; none when it does not exist."""
    fs, where = _located(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(where)) if fs.exists(where) else []


def removed(spark: SparkSession, path: str) -> None:
    fs, where = _located(spark, path)
    fs.delete(where, True)


def write_once(df: DataFrame, path: str) -> None:
    """ZSTD Parquet, all or nothing; finished output is left alone, what a killed job left is replaced."""
    if not finished(df.sparkSession, path):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_union(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files unioned by column name."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def load_stage(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def empty_like(df: DataFrame, path: str) -> None:
    """An empty table with the columns of ``df``, ready to append to."""
    df.limit(0).write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("compression", "zstd").parquet(path)


def full_refresh(
    df: DataFrame, path: str, as_of: AsOf, keep_when_empty: bool = True, accept: Callable[[], bool] | None = None
) -> bool:
    """Replace a table and stamp ``loaded_at``; an empty source leaves the old data.

    The source is computed once, into a folder of its own. Readers (:func:`read_refreshed`) see the old rows until the version
    that names the new folder has ended, so ``df`` may read the table itself and a job killed half way changes
    nothing. ``accept`` is asked after the rows are written (``quality.WriteChecks.passed`` tells what the write
    counted); where it refuses, the old rows stay. Returns whether the table was replaced. One writer at a time.
    """
    spark, load = df.sparkSession, f"r{uuid.uuid4().hex}"
    rows = df.withColumn("loaded_at", clock.ntz(as_of))
    rows.write.option("compression", "zstd").parquet(f"{path}/load={load}")
    if keep_when_empty and spark.read.schema(rows.schema).parquet(f"{path}/load={load}").isEmpty():
        removed(spark, f"{path}/load={load}")
        return False
    if accept is not None and not accept():
        removed(spark, f"{path}/load={load}")
        return False
    _publish(spark, path, _current(spark, path)[0] + 1, {WHOLE: load}, rows.schema)
    return True


def read_refreshed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the last finished :func:`full_refresh`."""
    _, loads, schema = _current(spark, path)
    if schema is None:
        raise FileNotFoundError(f"no finished version of a table at {path}")
    return spark.read.schema(schema).parquet(f"{path}/load={loads[WHOLE]}")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").option("nullValue", "\\N").csv(path)


def read_csv(spark: SparkSession, path: str, schema: str, null: str = "\\N") -> DataFrame:
    """CSV with a header and declared types (bulk loads and seeds)."""
    return spark.read.option("header", "true").option("nullValue", null).schema(schema).csv(path)


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back.

    Cuts lineage and shares a node several tables read; the copy survives the loss of executors.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# --- facts by month ----------------------------------------------------------------------
#
# <table>/load=<id>/ano_mes=<month>: data; a load is never touched after its job.
# <table>/versions/<number>: one small file that names the load of each month, and the schema.
#
# A version counts once its write has ended, so a reader sees all of a change or nothing, and
# a job killed half way leaves the table as it was. One writer at a time.


def _current(spark: SparkSession, path: str) -> tuple[int, dict[str, str], StructType | None]:
    """Number, load per month and schema of the newest finished version."""
    numbers = [int(n) for n in names_in(spark, f"{path}/versions") if n.isdigit()]
    done = [n for n in numbers if finished(spark, f"{path}/versions/{n}")]
    if not done:
        return 0, {}, None
    # One row per month of the table.
    rows = spark.read.schema("month string, load string, fields string").json(f"{path}/versions/{max(done)}").collect()
    return max(done), {r.month: r.load for r in rows if r.month is not None}, StructType.fromJson(json.loads(rows[0].fields))


def _publish(spark: SparkSession, path: str, number: int, loads: Mapping[str, str], schema: StructType) -> None:
    fields = json.dumps(schema.jsonValue())
    rows = [(month, load, fields) for month, load in sorted(loads.items())] or [(None, None, fields)]
    version = spark.createDataFrame(rows, "month string, load string, fields string").coalesce(1)
    version.write.mode("overwrite").json(f"{path}/versions/{number}")


def _load(df: DataFrame, path: str, ts: str, partition: str) -> dict[str, str]:
    """Writes ``df`` as a new load; returns the load of each month in it.

    Rows are rebalanced by month: a large month is split over several tasks by size, a small
    one is written by one.
    """
    load = f"r{uuid.uuid4().hex}"
    (
        df.hint("rebalance", partition)
        .sortWithinPartitions(partition, ts)
        .write.option("compression", "zstd")
        .partitionBy(partition)
        .parquet(f"{path}/load={load}")
    )
    prefix = f"{partition}="
    names = names_in(df.sparkSession, f"{path}/load={load}")
    return {n.removeprefix(prefix): load for n in names if n.startswith(prefix)}


def read_months(spark: SparkSession, path: str, months: Sequence[str] | None = None, partition: str = "ano_mes") -> DataFrame:
    """The current version of a table by month, or only the named months of it."""
    _, loads, schema = _current(spark, path)
    if schema is None:
        raise FileNotFoundError(f"no finished version of a table at {path}")
    folders = [f"{path}/load={load}/{partition}={m}" for m, load in sorted(loads.items()) if months is None or m in months]
    full = StructType(schema.fields).add(partition, "string")
    if not folders:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(*folders).drop("load")


def write_months(df: DataFrame, path: str, ts: str, partition: str = "ano_mes") -> None:
    """Fact partitioned by month of ``ts``; only months present in ``df`` are replaced."""
    spark = df.sparkSession
    number, loads, schema = _current(spark, path)
    written = _load(df.withColumn(partition, month_of(F.col(ts))), path, ts, partition)
    _publish(spark, path, number + 1, loads | written, schema or df.schema)


def merge_months(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    as_of: AsOf,
    ts: str,
    *,
    window: Rule | None = None,
    partition: str = "ano_mes",
    **merge,
) -> Mapping[str, int]:
    """Merge ``source`` into the table by month at ``path``; returns action counts.

    ``merge`` is handed to :func:`merge_into`; ``window`` is its ``missing_where``. Read are only
    the months that hold a source row, a row with a source key, or a row of the window; the
    last two are found in a scan of the keys and of the window's columns alone. A row whose
    ``ts`` moved leaves its old month and enters the new one; rows without ``ts`` have a month
    of their own. Only months in which a row changed are written, as a new version.
    """
    number, loads, schema = _current(spark, path)
    table = read_months(spark, path, partition=partition)
    types = dict(table.dtypes)
    stage = f"{checkpoint_dir(spark)}/merge-{uuid.uuid4().hex}"
    source.write.option("compression", "zstd").parquet(f"{stage}/source")
    source = spark.read.schema(source.schema).parquet(f"{stage}/source")

    own_keys = source.select(*[F.col(k).cast(types[k]).alias(k) for k in keys])
    read = source.select(month_of(F.col(ts).cast(types[ts])).alias(partition))
    read = read.unionAll(table.join(own_keys, list(keys), "left_semi").select(partition))
    if merge.get("missing", "keep") != "keep":
        read = read.unionAll((table if window is None else table.where(window(F.col))).select(partition))
    # Names of months, not data.
    months = [r[0] for r in read.distinct().collect()]

    current = read_months(spark, path, months, partition).withColumnRenamed(partition, "_month")
    state = merge_into(current, source, keys, as_of, missing_where=window, with_action=True, **merge)
    state = state.withColumn(partition, month_of(F.col(ts)))
    state.write.option("compression", "zstd").parquet(f"{stage}/state")
    state = spark.read.schema(state.schema).parquet(f"{stage}/state")

    counts = state.groupBy("_month", partition, ACTION).agg(F.count(F.lit(1)).alias("n")).collect()
    changed = {m for r in counts if r[ACTION] is not None for m in (r["_month"], r[partition]) if m is not None}
    if changed:
        rows = state.where(F.col(partition).isin(sorted(changed)) & F.coalesce(F.col(ACTION) != "delete", F.lit(True)))
        written = _load(rows.drop("_month", ACTION), path, ts, partition)
        _publish(spark, path, number + 1, {m: x for m, x in loads.items() if m not in changed} | written, schema)
    removed(spark, stage)
    totals: dict[str, int] = {}
    for r in counts:
        totals[r[ACTION] or "unchanged"] = totals.get(r[ACTION] or "unchanged", 0) + r["n"]
    return totals


def drop_old_versions(spark: SparkSession, path: str) -> None:
    """Removes versions before the current one and loads that it does not name."""
    number, loads, _ = _current(spark, path)
    for n in names_in(spark, f"{path}/versions"):
        if n.isdigit() and int(n) < number:
            removed(spark, f"{path}/versions/{n}")
    used = {f"load={x}" for x in loads.values()}
    for n in names_in(spark, path):
        if n.startswith("load=") and n not in used:
            removed(spark, f"{path}/{n}")
