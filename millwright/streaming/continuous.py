"""Continuous form of the incremental loads: a stream of landed files merged into a table by month.

Files that land in a folder are read once each. Repeated deliveries of a row are dropped within a delay of
arrival, which bounds the state; a repetition that comes later still is harmless, since merging it changes nothing. Each micro-batch is
merged through :func:`millwright.sources.tables.merge_months`, whose versions are switched at once. A row older than the stored
one of its key loses, in whatever order the files come, so the table ends as one merge of all rows would leave it.

The stream position lies in the checkpoint folder. A micro-batch that was merged but not yet recorded there is merged
again after a restart; it meets its own rows and writes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millwright.functions.clock import AsOf
from millwright.operators.dedup import latest_per_key
from millwright.sources.tables import materialised, merge_months, read_months

ARRIVED, ROW = "_arrived", "_row"


def landed_stream(spark: SparkSession, folder: str, schema: StructType | str, max_files: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def without_repeats(stream: DataFrame, delay: str = "2 days") -> DataFrame:
    """Rows of a stream, each once per ``delay`` of arrival.

    The watermark follows the time of the micro-batch, not a column of the row: a row that is old by its
    own clock is late data, not a repetition, and passes. Rows are told apart by a digest of all their columns.
    """
    digest = F.sha2(F.to_json(F.struct(*stream.columns)), 256)
    marked = stream.withColumn(ARRIVED, F.current_timestamp()).withColumn(ROW, digest)
    return marked.withWatermark(ARRIVED, delay).dropDuplicatesWithinWatermark([ROW]).drop(ARRIVED, ROW)


def newest_rows(rows: DataFrame, stored: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """One row per key: the newest of ``rows`` and of what is ``stored`` for these keys.

    Rows without a key stay, but for those that equal a stored one: they have been merged before.
    """
    types = dict(stored.dtypes)
    rows = rows.select(*[F.col(c).cast(types[c]).alias(c) for c in rows.columns])
    keyless = reduce(or_, [F.col(k).isNull() for k in keys])
    keyed = rows.where(~keyless)
    known = stored.join(keyed.select(*keys), list(keys), "left_semi").select(*rows.columns)
    there = stored.where(keyless).select(*[F.col(c).alias(f"_{c}") for c in rows.columns])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in rows.columns])
    return latest_per_key(keyed.unionByName(known), keys, version).unionByName(rows.where(keyless).join(there, same, "left_anti"))


def merging(path: str, keys: Sequence[str], as_of: AsOf, version: str, ts: str, **merge) -> Callable[[DataFrame, int], None]:
    """What a micro-batch does: its newest rows are merged into the table by month at ``path``.

    ``version`` orders the rows of a key; ``ts`` gives the month; ``merge`` is handed on.
    """

    def run(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        rows = materialised(batch, "arrived")
        if rows.isEmpty():
            return
        merge_months(spark, path, newest_rows(rows, read_months(spark, path), keys, version), keys, as_of, ts, **merge)

    return run


def merge_available(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    as_of: AsOf,
    version: str,
    ts: str,
    delay: str = "2 days",
    **merge,
) -> int:
    """Merges all files that have landed since the last call with the same checkpoint; returns the number of micro-batches.

    Without ``availableNow`` the same query runs on, see :func:`without_repeats` and :func:`merging`.
    """
    writer = without_repeats(stream, delay).writeStream.foreachBatch(merging(path, keys, as_of, version, ts, **merge))
    query = writer.option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(p["numInputRows"] > 0 for p in query.recentProgress)
