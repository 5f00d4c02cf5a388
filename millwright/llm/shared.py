"""What several operators use: staged tables and connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.session import checkpoint_dir
from millwright.sources.tables import removed

_noted: list[list[str]] = []


def unused(df: DataFrame, *names: str) -> list[str]:
    """A name like each of ``names`` that no column of ``df`` has, in whatever case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read back."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    for folders in _noted:
        folders.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that runs meanwhile are removed when it ends, not when the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@contextmanager
def noted_folders() -> Iterator[list[str]]:
    """The folders that :func:`staged` writes meanwhile."""
    folders: list[str] = []
    _noted.append(folders)
    try:
        yield folders
    finally:
        # Lists may be equal, so not `remove`.
        _noted[:] = [kept for kept in _noted if kept is not folders]


def release(df: DataFrame, folders: list[str]) -> None:
    """Removes staged folders, but for those that ``df`` still reads; the list keeps these."""
    names = [path.rsplit("/", 1)[1] for path in folders]
    read = {part for file in df.inputFiles() for part in file.split("/")} if folders else set()
    for path, name in zip(list(folders), names, strict=True):
        if name not in read:
            removed(df.sparkSession, path)
            folders.remove(path)


MAX_MARKS = 1 << 27


def marks(keys: DataFrame, name: str) -> np.ndarray:
    """A bit for each value of a column of 64-bit hashes; :func:`marked` tells which rows may be among them.

    Saves shuffling rows that a join would drop. Sixteen bits for each key, at most :data:`MAX_MARKS` (16 MB),
    whatever the number of keys: where more keys share the bits, more rows pass and the join decides.
    """
    n = keys.count()
    size = min(MAX_MARKS, max(1 << 16, 1 << (16 * n).bit_length()))
    at = F.pmod(F.col(name), F.lit(size))
    parts = keys.groupBy(F.floor(at / 32768).cast("int").alias("part")).agg(F.bitmap_construct_agg(F.pmod(at, F.lit(32768))).alias("bits"))
    out = np.zeros(size // 8, np.uint8)
    for r in parts.toLocalIterator():  # parts of 4 KB, at most size / 32768 of them
        out[r["part"] * 4096 : r["part"] * 4096 + len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    return np.unpackbits(out, bitorder="little").astype(bool) if size <= 1 << 22 else out


def marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each 64-bit hash may be among the marked keys."""
    if bits.dtype == bool:
        return bits[hashes.astype(np.int64) & (len(bits) - 1)]
    at = hashes.astype(np.int64) & (len(bits) * 8 - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges(a, b)``: ``(node, component)``.

    The component is the smallest node id reachable. Large-star and small-star rounds: each is
    two aggregations over the edges, path lengths shrink geometrically, and a node with very
    many neighbours is only ever aggregated, never expanded into pairs. The edge list
    is staged after each round; two sums tell on the driver whether it changed.
    """
    current = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    before = None
    while True:
        # Large star: every neighbour that is larger than a node is linked to the node's smallest neighbour.
        both = current.unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Small star: a node and its smaller neighbours are linked to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        current = staged(small.where("a <> b").distinct(), "edges")
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    stars = current.groupBy("a").agg(F.min("b").alias("b"))
    roots = stars.select("b").distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        roots.select(F.col("b").alias("node"), F.col("b").alias("component"))
    )
