"""Multi-plant and per-machine sources."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.functions import codes


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns missing on one side are NULL."""
    if not parts:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def extract_plants(read: Callable[[object], DataFrame], sources: Mapping[int, object]) -> DataFrame:
    """The same table of every plant, tagged with the plant code."""
    return union_all([read(src).withColumn("id_estabelecimento", F.lit(code)) for code, src in sources.items()])


def jdbc_reader(
    spark: SparkSession, query: str, predicates: Sequence[str] | None = None, **options: str
) -> Callable[[str], DataFrame]:
    """Reader of one plant database: ``read(url)``. Each predicate becomes one partition of
    the parallel read; they must not overlap."""

    def read(url: str) -> DataFrame:
        if predicates:
            return spark.read.jdbc(url, f"({query}) q", predicates=list(predicates), properties=options)
        return spark.read.format("jdbc").option("url", url).option("query", query).options(**options).load()

    return read


def range_predicates(column: str, start: datetime, end: datetime, days: int = 4, buffer_hours: int = 12) -> list[str]:
    """Disjoint half-open time ranges covering ``[start - buffer, end + buffer)``.

    The buffer is read once, at the outer ends only: production days are computed over the
    whole range, so inner chunks need no overlap.
    """
    low, high = start - timedelta(hours=buffer_hours), end + timedelta(hours=buffer_hours)
    out = []
    while low < high:
        stop = min(low + timedelta(days=days), high)
        out.append(f"{column} >= '{low:%Y-%m-%d %H:%M:%S}' AND {column} < '{stop:%Y-%m-%d %H:%M:%S}'")
        low = stop
    return out


def keyed_names(names: Iterable[str], pattern: str = codes.CYCLE_TABLE_PATTERN, exclude: Iterable[str] = codes.CYCLE_TABLE_EXCLUDED) -> dict[str, int]:
    """Table name -> key in the name, for names that match and are not excluded."""
    skip = set(exclude)
    found = ((n, re.match(pattern, n)) for n in names if n not in skip)
    return {n: int(m.group(1)) for n, m in found if m}


def union_keyed_tables(
    read: Callable[[str], DataFrame], names: Iterable[str], key: str = "id_equipamento", **selection
) -> DataFrame:
    """Union of the tables whose name carries a key, with the key as a column."""
    return union_all([read(n).withColumn(key, F.lit(k)) for n, k in keyed_names(names, **selection).items()])


def read_keyed_folders(spark: SparkSession, root: str, key: str = "id_equipamento", exclude: Iterable[str] = codes.CYCLE_TABLE_EXCLUDED) -> DataFrame:
    """Folders ``<root>/Ciclo <id>`` as one table in a single scan; the key comes from the path."""
    folder = F.regexp_extract(F.url_decode(F.col("_metadata.file_path")), r"/(Ciclo[ _][^/]+)/[^/]*$", 1)
    rows = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(root)
    rows = rows.select("*", folder.alias("_pasta"))
    named = rows.where(F.col("_pasta").rlike(codes.CYCLE_TABLE_PATTERN) & ~F.col("_pasta").isin(list(exclude)))
    return named.withColumn(key, F.regexp_extract("_pasta", codes.CYCLE_TABLE_PATTERN, 1).cast("int")).drop("_pasta")
