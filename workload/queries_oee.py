"""Registered OEE queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.functions import codes
from millwright.operators.intervals import intersect
from millwright.operators.shifts import sector_schedules, shift_grid, with_shifts
from millwright.plans import oee
from millwright.plans.context import machine_context, on_machine
from workload import oracle_oee as sql
from workload import roles
from workload.roles import PERIOD, shop_floor


def as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """The named columns to six decimals.

    One expression rounds them all: code written out per column makes a generated method larger than the JVM
    compiles. Zeros, often most of a column, need no decimal arithmetic; a negative zero rounds to zero.
    """

    def six(c: Column) -> Column:
        return F.when(c == 0, F.lit(0.0)).otherwise(F.round(c, 6))

    out = df.withColumn("_rounded", F.transform(F.array(*[F.col(n).cast("double") for n in names]), six))
    return out.withColumns({n: F.get(F.col("_rounded"), F.lit(i)) for i, n in enumerate(names)}).drop("_rounded")


def _oee(grain: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = oee.oee(shop_floor(spark, sf_dir), PERIOD, grain=[grain])
        return as_double(out, "pct_oee", "pct_disp", "pct_perf", "pct_qual").withColumn(
            "hrs_boas", F.col("hrs_boas").cast("bigint")
        )

    return run


def _plain(plan, period=PERIOD):
    return lambda spark, sf_dir: plan(shop_floor(spark, sf_dir), period)


# The details leave out fewer sectors than the OEE.
OWN_SECTORS = replace(PERIOD, excluded_sectors_detail=(3,))


def _own(detail: str) -> str:
    return detail.replace("m.id_setor NOT IN (3, 7)", "m.id_setor NOT IN (3)")


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    floor = shop_floor(spark, sf_dir)
    hours = sector_schedules(floor.sectors, floor.sector_parameters, floor.schedules)
    return shift_grid(with_shifts(hours), PERIOD.start, PERIOD.end)


def _run_stop(spark: SparkSession, sf_dir: str, how: str = "inner") -> DataFrame:
    floor = shop_floor(spark, sf_dir)
    runs = on_machine(floor, oee.valid_runs(floor, PERIOD), machine_context(floor, PERIOD))
    stops = oee.period_stops(floor, PERIOD, codes.UNWEIGHTED).select(
        "id_estabelecimento", "maquina_id", "data_hora_inicio", "data_hora_fim"
    )
    return intersect(
        runs,
        stops,
        ["id_estabelecimento", "maquina_id"],
        ("data_inicio", "data_fim"),
        ("data_hora_inicio", "data_hora_fim"),
        how=how,
    )


def _run_stop_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_stop(spark, sf_dir, "left")


def _balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(oee.cycle_balance(shop_floor(spark, sf_dir), PERIOD), "soma_ganho", "soma_perda", "saldo_tc")


def _measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dashboard measures per plant and machine, from the detail reports."""
    floor = shop_floor(spark, sf_dir)
    out = oee.oee_measures(
        oee.stop_detail(floor, PERIOD),
        oee.cycle_detail(floor, PERIOD),
        oee.performance_loss_detail(floor, PERIOD),
        oee.quality_loss_detail(floor, PERIOD),
        oee.useful_time_detail(floor, PERIOD),
        ["cod_estabelecimento", "cod_maquina"],
    )
    return rounded(out, *[c for c in out.columns if c.startswith("pct_")])


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = oee.oee(shop_floor(spark, sf_dir), PERIOD, grain=["id_fabrica"], every="month")
    return as_double(out, "pct_oee", "pct_disp", "pct_perf", "pct_qual").withColumn(
        "hrs_boas", F.col("hrs_boas").cast("bigint")
    )


QUERIES = {
    "oee_factory_month": (_monthly, sql.OEE_FACTORY_MONTH),
    "oee_measures_machine": (_measures, sql.OEE_MEASURES),
    "oee_product_day": (_oee("cod_produto"), sql.OEE),
    "oee_machine_day": (_oee("maquina_id"), sql.OEE_MACHINE),
    "oee_sector_day": (_oee("id_setor"), sql.OEE_SECTOR),
    "stop_seconds_product_day": (_plain(oee.stop_seconds), sql.STOP_SECONDS),
    "cycle_balance_product_day": (_balance, sql.CYCLE_BALANCE),
    "shift_grid": (_grid, sql.SHIFT_GRID),
    "run_stop_intersections": (_run_stop, sql.RUN_STOP),
    "run_stop_intersections_left": (_run_stop_left, sql.RUN_STOP_LEFT),
    "useful_time_detail": (_plain(oee.useful_time_detail), sql.USEFUL_DETAIL),
    "stop_detail": (_plain(oee.stop_detail), sql.STOP_DETAIL),
    "cycle_detail": (_plain(oee.cycle_detail), sql.CYCLE_DETAIL),
    "performance_loss_detail": (_plain(oee.performance_loss_detail), sql.PERFORMANCE_DETAIL),
    "quality_loss_detail": (_plain(oee.quality_loss_detail), sql.QUALITY_DETAIL),
    "stop_detail_own_sectors": (_plain(oee.stop_detail, OWN_SECTORS), _own(sql.STOP_DETAIL)),
    "cycle_detail_own_sectors": (_plain(oee.cycle_detail, OWN_SECTORS), _own(sql.CYCLE_DETAIL)),
    "performance_loss_detail_own_sectors": (_plain(oee.performance_loss_detail, OWN_SECTORS), _own(sql.PERFORMANCE_DETAIL)),
    "quality_loss_detail_own_sectors": (_plain(oee.quality_loss_detail, OWN_SECTORS), _own(sql.QUALITY_DETAIL)),
}
