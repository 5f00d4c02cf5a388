"""Shift schedules, the shift grid and cutting intervals at shift boundaries.

A shift is stored as second offsets from midnight of its production day, so a schedule is
one small array per sector. Cutting an interval is then row-local: it explodes into the
days it touches and the three shifts of each day. No grid is joined, nothing is shuffled
and a sector that owns most events costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.functions import clock
from millwright.functions.clock import DAY, AsOf
from millwright.functions.codes import NEXT_DAY_SHIFT3_START

ROLL_RULES = ("oee", "useful_time", "stop_detail")
BOUNDARIES = ("ini_1_t1", "fim_1_t1", "ini_1_t2", "fim_1_t2", "ini_1_t3", "fim_1_t3")


def sector_schedules(sectors: DataFrame, parameters: DataFrame, schedules: DataFrame) -> DataFrame:
    """Sector -> shift boundaries in seconds, resolved by sector name, then schedule name.

    ``sectors(id_estabelecimento, id, descricao)``,
    ``parameters(id_estabelecimento, setor, horario)``,
    ``schedules(id_estabelecimento, nome, ini_1_t1 .. fim_1_t3)`` with boundaries as
    seconds of the day or ``HH:mm:ss`` text. Sectors without a schedule keep NULLs.
    """
    types = dict(schedules.dtypes)
    bounds = [
        (clock.clock_seconds(F.col(b)) if types[b] == "string" else F.col(b).cast("int")).alias(b)
        for b in BOUNDARIES
    ]
    named = schedules.select("id_estabelecimento", F.col("nome").alias("horario"), *bounds)
    return (
        sectors.select("id_estabelecimento", F.col("id").alias("id_setor"), F.col("descricao").alias("setor"))
        .join(parameters.select("id_estabelecimento", "setor", "horario"), ["id_estabelecimento", "setor"], "left")
        .join(named, ["id_estabelecimento", "horario"], "left")
        .select("id_estabelecimento", "id_setor", *BOUNDARIES)
    )


def shift_offsets(rule: str = "oee") -> Column:
    """Three ``(num_turno, ini, fim)`` structs of second offsets from the production day.

    The rules differ in which boundary makes another one roll to the next day:

    - ``oee``: second shift against the first start; third start against the first start,
      third end against its own start; the special third start always rolls.
    - ``useful_time``: each end against its own start; third start only when special.
    - ``stop_detail``: everything against the first start, and midnight itself never rolls.
    """
    i1, f1, i2, f2, i3, f3 = (F.col(b) for b in BOUNDARIES)
    special = i3 == NEXT_DAY_SHIFT3_START

    def roll(boundary: Column, when: Column) -> Column:
        return boundary + F.when(when, DAY).otherwise(0)

    if rule == "oee":
        second = roll(i2, i2 < i1), roll(f2, f2 < i1)
        third = roll(i3, special | (i3 < i1)), roll(f3, special | (f3 < i3))
    elif rule == "useful_time":
        second = i2, roll(f2, f2 < i2)
        third = roll(i3, special), roll(f3, special | (f3 < i3))
    elif rule == "stop_detail":

        def early(boundary: Column) -> Column:
            return (boundary > 0) & (boundary < i1)

        second = roll(i2, early(i2)), roll(f2, early(f2))
        third = roll(i3, early(i3)), roll(f3, early(f3))
    else:
        raise ValueError(f"unknown roll rule {rule!r}, expected one of {ROLL_RULES}")
    return F.array(
        *[
            F.struct(F.lit(n).alias("num_turno"), ini.cast("int").alias("ini"), fim.cast("int").alias("fim"))
            for n, (ini, fim) in enumerate(((i1, f1), second, third), start=1)
        ]
    )


def with_shifts(schedules: DataFrame, rule: str = "oee") -> DataFrame:
    """Per sector: ``inicio_dia`` (first shift start) and the ``turnos`` offset array."""
    return schedules.select(
        "id_estabelecimento",
        "id_setor",
        F.col("ini_1_t1").alias("inicio_dia"),
        shift_offsets(rule).alias("turnos"),
    )


def day_spine(start: AsOf, end: AsOf, spark, name: str = "data") -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(
        F.explode(F.sequence(clock.day(start), clock.day(end))).alias(name)
    )


def shift_grid(sector_shifts: DataFrame, start: AsOf, end: AsOf) -> DataFrame:
    """Rows (sector, day, shift, start, end) from the day before ``start`` to ``end``."""
    days = F.sequence(F.date_sub(clock.day(start), 1), clock.day(end))
    return (
        sector_shifts.withColumn("data_turno", F.explode(days))
        .withColumn("turno", F.explode("turnos"))
        .select(
            "id_estabelecimento",
            "id_setor",
            "data_turno",
            F.col("turno.num_turno").alias("num_turno"),
            _at("turno.ini").alias("inicio_turno"),
            _at("turno.fim").alias("fim_turno"),
        )
    )


def _at(offset: str) -> Column:
    return F.timestamp_add("SECOND", F.col(offset), F.col("data_turno").cast("timestamp_ntz"))


def cut_at_shifts(
    df: DataFrame,
    start: str,
    end: str,
    period_start: AsOf,
    period_end: AsOf,
    with_bounds: bool = False,
) -> DataFrame:
    """One row per (interval, shift) that overlap, with the clipped part in whole seconds.

    ``df`` carries the sector's ``turnos``. Days run from the day before ``period_start``
    to ``period_end``, as in :func:`shift_grid`. Added columns: ``data_turno``,
    ``num_turno``, ``ini_corte``/``fim_corte`` (seconds from the shift start) and
    ``segundos``; with ``with_bounds`` also ``inicio_turno``, ``fim_turno``,
    ``inicio_dia_turno`` and ``fim_dia_turno`` timestamps (the last two are the first
    start and third end of that day). A shift without bounds overlaps nothing.
    """
    first = F.greatest(F.date_sub(F.col(start).cast("date"), 1), F.date_sub(clock.day(period_start), 1))
    last = F.least(F.col(end).cast("date"), clock.day(period_end))
    base = F.unix_date("data_turno").cast("bigint") * DAY
    cut = (
        df.where(first <= last)
        .withColumn("_a", clock.epoch_seconds(F.col(start)))
        .withColumn("_b", clock.epoch_seconds(F.col(end)))
        .withColumn("_b_up", clock.epoch_seconds_up(F.col(end)))
        .withColumn("data_turno", F.explode(F.sequence(first, last)))
        .withColumn("_turno", F.explode("turnos"))
        .withColumn("_ini", base + F.col("_turno.ini"))
        .withColumn("_fim", base + F.col("_turno.fim"))
        .where((F.col("_a") < F.col("_fim")) & (F.col("_b_up") > F.col("_ini")) & (F.col("_ini") < F.col("_fim")))
        .withColumn("num_turno", F.col("_turno.num_turno"))
        .withColumn("ini_corte", F.greatest("_a", "_ini") - F.col("_ini"))
        .withColumn("fim_corte", F.least("_b", "_fim") - F.col("_ini"))
        .withColumn("segundos", F.col("fim_corte") - F.col("ini_corte"))
    )
    if with_bounds:
        cut = (
            cut.withColumn("inicio_turno", _at("_turno.ini"))
            .withColumn("fim_turno", _at("_turno.fim"))
            .withColumn("inicio_dia_turno", F.timestamp_add("SECOND", F.col("turnos")[0]["ini"], F.col("data_turno").cast("timestamp_ntz")))
            .withColumn("fim_dia_turno", F.timestamp_add("SECOND", F.col("turnos")[2]["fim"], F.col("data_turno").cast("timestamp_ntz")))
        )
    return cut.drop("_a", "_b", "_b_up", "_turno", "_ini", "_fim", "turnos")
