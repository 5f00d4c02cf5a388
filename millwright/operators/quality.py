"""Declarative data-quality checks: each returns one row per check with its failures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millwright.functions import clock
from millwright.functions.clock import AsOf


def _result(df: DataFrame, name: str, severity: str) -> DataFrame:
    failed = F.col("falhas") > 0
    return df.select(
        F.lit(name).alias("teste"),
        F.coalesce("falhas", F.lit(0)).cast("bigint").alias("falhas"),
        F.when(F.coalesce(failed, F.lit(False)), severity).otherwise("pass").alias("situacao"),
    )


def _conditions(
    not_null: Sequence[str], accepted: Mapping[str, Sequence[object]] | None, at_least: Mapping[str, float] | None
) -> dict[str, Column]:
    """Name of each row check and the condition of a row that fails it."""
    conditions = {f"not_null:{c}": F.col(c).isNull() for c in not_null}
    conditions |= {f"accepted_values:{c}": ~F.col(c).isin(list(v)) for c, v in (accepted or {}).items()}
    return conditions | {f"accepted_range:{c}": F.col(c) < v for c, v in (at_least or {}).items()}


def row_checks(
    df: DataFrame,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence[object]] | None = None,
    at_least: Mapping[str, float] | None = None,
    severity: str = "error",
) -> DataFrame:
    """Not-null, accepted-values and inclusive-minimum checks, all in one pass."""
    conditions = _conditions(not_null, accepted, at_least)
    counts = [F.count(F.when(cond, 1)).alias(f"c{i}") for i, cond in enumerate(conditions.values())]
    rows = [F.struct(F.lit(n).alias("nome"), F.col(f"c{i}").alias("falhas")) for i, n in enumerate(conditions)]
    flat = df.agg(*counts).select(F.inline(F.array(*rows)))
    return flat.select(
        F.col("nome").alias("teste"),
        "falhas",
        F.when(F.col("falhas") > 0, severity).otherwise("pass").alias("situacao"),
    )


def unique(df: DataFrame, columns: Sequence[str], severity: str = "error", ignore_null: bool = True) -> DataFrame:
    """Number of key values that occur more than once."""
    rows = df
    if ignore_null and len(columns) == 1:
        rows = df.where(F.col(columns[0]).isNotNull())
    repeated = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _result(repeated.agg(F.count("n").alias("falhas")), f"unique:{','.join(columns)}", severity)


def relationship(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, severity: str = "warn"
) -> DataFrame:
    """Child rows whose key the parent lacks.

    Keys are counted before the join, so a key that owns many rows travels once.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_column).alias("k")).distinct()
    orphans = keys.join(known, "k", "left_anti")
    return _result(orphans.agg(F.sum("n").alias("falhas")), f"relationships:{column}", severity)


class WriteChecks:
    """Row checks that are counted while ``rows`` are written, without a pass of their own.

    Write ``rows`` (a DataFrame like ``df``) once, then ask for :meth:`failures` or :meth:`report`. The counts are
    taken in the tasks that write. A stage that runs again after a lost executor may count rows twice, which
    never turns a failed check into a passed one or the reverse.
    """

    def __init__(
        self,
        df: DataFrame,
        not_null: Sequence[str] = (),
        accepted: Mapping[str, Sequence[object]] | None = None,
        at_least: Mapping[str, float] | None = None,
        severity: str = "error",
    ) -> None:
        conditions = _conditions(not_null, accepted, at_least)
        self.names, self.severity, self.spark = list(conditions), severity, df.sparkSession
        self._seen = Observation()
        counts = [F.count(F.when(c, 1)).alias(f"c{i}") for i, c in enumerate(conditions.values())]
        self.rows = df.observe(self._seen, F.count(F.lit(1)).alias("n"), *counts)

    def failures(self) -> dict[str, int]:
        """Failed rows of each check; waits for the first action on ``rows``."""
        seen = self._seen.get
        return {n: int(seen.get(f"c{i}") or 0) for i, n in enumerate(self.names)}

    def passed(self) -> bool:
        return self.severity != "error" or not any(self.failures().values())

    def report(self) -> DataFrame:
        rows = [(n, k, self.severity if k else "pass") for n, k in self.failures().items()]
        return self.spark.createDataFrame(rows, "teste string, falhas bigint, situacao string")


def table_checks(
    df: DataFrame,
    unique_keys: Sequence[Sequence[str]] = (),
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence[object]] | None = None,
    at_least: Mapping[str, float] | None = None,
    parents: Mapping[str, tuple[DataFrame, str]] | None = None,
    severity: Mapping[str, str] | None = None,
) -> DataFrame:
    """All checks of a table in one scan: the rows of :func:`row_checks`, :func:`unique` and :func:`relationship`.

    Every key that is checked is a grouping set, and the whole table one more; the tasks count by key before
    anything is shuffled. The keys of ``parents`` (column: parent table and its column) are stacked below the
    counts with a mark, so a reference is checked by the same grouping and no join. ``severity`` gives the
    level by kind (``unique``, ``rows``, ``relationship``). NULL keys of one column are not checked; an empty table
    passes everything.
    """
    level = {"unique": "error", "rows": "error", "relationship": "warn"} | dict(severity or {})
    conditions, parents = _conditions(not_null, accepted, at_least), dict(parents or {})
    sets = list(dict.fromkeys([(), *[tuple(k) for k in unique_keys], *[(c,) for c in parents]]))
    keys = list(dict.fromkeys(c for s in sets for c in s))
    counts = [F.count(F.when(c, 1)).alias(f"_c{i}") for i, c in enumerate(conditions.values())]
    if not keys:
        return row_checks(df, not_null, accepted, at_least, level["rows"])

    def number(s: Sequence[str]) -> int:
        # A bit for each key column that is not in the set, the first one highest.
        return sum(1 << (len(keys) - 1 - i) for i, c in enumerate(keys) if c not in s)

    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in keys])
    grouped = grouped.agg(F.grouping_id().cast("bigint").alias("_set"), F.count(F.lit(1)).alias("_n"), *counts)
    if parents:
        stacked = grouped.withColumn("_known", F.lit(0))
        for c, (parent, column) in parents.items():
            known = parent.select(F.col(column).cast(df.schema[c].dataType).alias(c)).distinct()
            known = known.select(c, F.lit(number((c,))).cast("bigint").alias("_set"), F.lit(0).cast("bigint").alias("_n"), F.lit(1).alias("_known"))
            stacked = stacked.unionByName(known, allowMissingColumns=True)
        sums = [F.sum(f"_c{i}").alias(f"_c{i}") for i in range(len(counts))]
        grouped = stacked.groupBy("_set", *keys).agg(F.sum("_n").alias("_n"), F.max("_known").alias("_known"), *sums)

    found = []
    for i, name in enumerate(conditions):
        found.append((name, level["rows"], F.sum(F.when(F.col("_set") == number(()), F.col(f"_c{i}")))))
    for key in unique_keys:
        repeated = (F.col("_set") == number(key)) & (F.col("_n") > 1)
        if len(key) == 1:
            repeated &= F.col(key[0]).isNotNull()
        found.append((f"unique:{','.join(key)}", level["unique"], F.count(F.when(repeated, 1))))
    for c in parents:
        orphan = (F.col("_set") == number((c,))) & F.col(c).isNotNull() & (F.col("_known") == 0)
        found.append((f"relationships:{c}", level["relationship"], F.sum(F.when(orphan, F.col("_n")))))
    totals = grouped.agg(*[F.coalesce(total, F.lit(0)).cast("bigint").alias(f"f{i}") for i, (_, _, total) in enumerate(found)])
    rows = [
        F.struct(F.lit(name).alias("teste"), F.col(f"f{i}").alias("falhas"), F.when(F.col(f"f{i}") > 0, lvl).otherwise("pass").alias("situacao"))
        for i, (name, lvl, _) in enumerate(found)
    ]
    return totals.select(F.inline(F.array(*rows)))


def freshness(df: DataFrame, ts: str, as_of: AsOf, warn_days: int = 2, error_days: int = 7) -> DataFrame:
    """Age of the newest row against the warning and error limits; an empty table is an error."""
    age = F.col("atraso_segundos")
    return df.agg(F.max(ts).alias("ultima_carga")).select(
        F.lit(f"freshness:{ts}").alias("teste"),
        "ultima_carga",
        clock.seconds_between(F.col("ultima_carga").cast("timestamp_ntz"), clock.ntz(as_of)).alias("atraso_segundos"),
    ).withColumn(
        "situacao",
        F.when(age.isNull() | (age > error_days * clock.DAY), "error").when(age > warn_days * clock.DAY, "warn").otherwise("pass"),
    )


def completeness(
    expected: DataFrame, runs: DataFrame, key: str, start: str, end: str, as_of: AsOf, minutes: int
) -> DataFrame:
    """Per expected key: ``ok`` with a finished run in the look-back, ``pending`` with only
    unfinished ones, ``missing`` without any."""
    now = clock.ntz(as_of)
    recent = runs.where(F.col(start).between(F.timestamp_add("MINUTE", F.lit(-minutes), now), now))
    counts = recent.groupBy(key).agg(F.count(start).alias("iniciadas"), F.count(end).alias("terminadas"))
    status = F.when(F.col("iniciadas") == 0, "missing").when(F.col("terminadas") == 0, "pending").otherwise("ok")
    return (
        expected.select(key)
        .distinct()
        .join(counts, key, "left")
        .na.fill(0, ["iniciadas", "terminadas"])
        .withColumn("situacao", status)
    )


def report(*checks: DataFrame) -> DataFrame:
    """Checks stacked into one table."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), checks)

