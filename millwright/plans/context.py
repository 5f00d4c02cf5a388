"""Inputs of the shop-floor plans and the machine context they share."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.functions import codes
from millwright.functions.clock import AsOf
from millwright.functions.values import not_in, same_text
from millwright.operators.joins import join_dimension
from millwright.operators.shifts import sector_schedules, with_shifts


@dataclass(frozen=True)
class ShopFloor:
    """Silver tables. Facts carry ``id_estabelecimento``; so does every dimension."""

    machines: DataFrame
    sectors: DataFrame
    factories: DataFrame
    reasons: DataFrame
    sector_parameters: DataFrame
    schedules: DataFrame
    stops: DataFrame | None = None
    runs: DataFrame | None = None
    cycles: DataFrame | None = None
    quality: DataFrame | None = None
    performance: DataFrame | None = None


@dataclass(frozen=True)
class Period:
    """Analysis period, the "now" of open rows, and the exclusion lists."""

    start: AsOf
    end: AsOf
    as_of: AsOf
    excluded_sectors: Iterable[int] = field(default=codes.EXCLUDED_SECTORS)
    excluded_factories: Iterable[int] = field(default=codes.EXCLUDED_FACTORIES)
    excluded_sectors_detail: Iterable[int] = field(default=codes.EXCLUDED_SECTORS_DETAIL)


def included(sector: Column, factory: Column, period: Period, detail: bool = False) -> Column:
    """Whether a machine counts; the stop, cycle, performance and quality details have their own sector list."""
    sectors = period.excluded_sectors_detail if detail else period.excluded_sectors
    return not_in(sector, sectors) & not_in(factory, period.excluded_factories)


def machine_context(floor: ShopFloor, period: Period, rule: str = "oee", detail: bool = False) -> DataFrame:
    """Machine -> name, sector, factory, first shift start and shift offsets.

    The chain machine/sector/factory/schedule is resolved once on the dimensions, so every
    fact needs a single join. Excluded sectors and factories are already gone, which makes
    the join with a fact an inner one.
    """
    shifts = with_shifts(
        sector_schedules(floor.sectors, floor.sector_parameters, floor.schedules), rule
    )
    sectors = floor.sectors.select(
        "id_estabelecimento",
        F.col("id").alias("id_setor"),
        F.col("descricao").alias("setor"),
        "id_fabrica",
    )
    return (
        floor.machines.select(
            "id_estabelecimento",
            F.col("id").alias("maquina_id"),
            F.col("nome").alias("nome_maquina"),
            "id_setor",
        )
        .join(sectors, ["id_estabelecimento", "id_setor"])
        .where(included(F.col("id_setor"), F.col("id_fabrica"), period, detail))
        .join(shifts, ["id_estabelecimento", "id_setor"], "left")
    )


def on_machine(floor: ShopFloor, fact: DataFrame, context: DataFrame, *columns: str) -> DataFrame:
    """Fact rows whose machine is in the context, with the wanted context columns."""
    keys = ["id_estabelecimento", "maquina_id"]
    return join_dimension(fact, context.select(*keys, *columns), keys, bounded_by=floor.machines)


def reasons_of(floor: ShopFloor, weight: str | None = None) -> DataFrame:
    """Stop reasons as (plant, code) with description, weight and family."""
    reasons = floor.reasons.select(
        "id_estabelecimento", "codigo", F.col("descricao").alias("motivo"), "peso_oee", "id_familia"
    )
    return reasons if weight is None else reasons.where(same_text(F.col("peso_oee"), weight))
