"""Gold facts and the machine dimension: silver rows with names and classifications."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.functions import clock, codes
from millwright.functions.clock import AsOf
from millwright.functions.values import label, ratio, short_md5
from millwright.operators.intervals import in_window, point_in_window, touches_range
from millwright.operators.joins import join_dimension, join_sparse
from millwright.operators.merge import merge_into, replace_window
from millwright.plans.oee import stop_class

PLANT = "id_estabelecimento"


def dimension(df: DataFrame, key: str, as_key: str, names: dict[str, str]) -> DataFrame:
    """A dimension reduced to (plant, key) and the wanted columns under their new names."""
    return df.select(PLANT, F.col(key).alias(as_key), *[F.col(c).alias(n) for c, n in names.items()])


def enrich(
    fact: DataFrame, dim: DataFrame, key: str, how: str = "left", bounded_by: DataFrame | None = None
) -> DataFrame:
    """Star join on (plant, key): broadcast below the size limit, salted above it."""
    return join_dimension(fact, dim, [PLANT, key], how, bounded_by)


def _place(machines: DataFrame, sectors: DataFrame, factories: DataFrame, how: str) -> DataFrame:
    """Machine -> name, sector and factory; resolved on the dimensions, once."""
    m = dimension(machines, "id", "maquina_id", {"nome": "nome_equipamento", "id_setor": "id_setor"})
    s = dimension(sectors, "id", "id_setor", {"descricao": "setor", "id_fabrica": "id_fabrica"})
    f = dimension(factories, "id", "id_fabrica", {"descricao": "fabrica"})
    return enrich(enrich(m, s, "id_setor", how), f, "id_fabrica", how)


def _reasons(reasons: DataFrame) -> DataFrame:
    return dimension(
        reasons, "codigo", "codigo", {"descricao": "descricao", "peso_oee": "peso_oee", "id_familia": "id_familia"}
    )


def group_setup_types(
    stops: DataFrame, setup_reasons: DataFrame, window: Column | None = None, plant_scoped: bool = True
) -> DataFrame:
    """Setup type of each stop group: the largest type among its reasons."""
    keys = [PLANT, "id_grupo"] if plant_scoped else ["id_grupo"]
    rows = stops.where(F.col("id_grupo") > 0)
    if window is not None:
        rows = rows.where(window)
    types = setup_reasons.select(PLANT, "codigo", "tipo_setup")
    typed = join_dimension(
        rows.select(PLANT, "id_grupo", "codigo"), types, [PLANT, "codigo"], "left", bounded_by=setup_reasons
    )
    return typed.groupBy(*keys).agg(F.max("tipo_setup").alias("tipo_setup_grupo"))


def setup_type(plant: Column, code: Column) -> Column:
    """Setup type of an ungrouped stop by plant and reason code."""
    out = F.lit(None).cast("string")
    for p, types in codes.SETUP_TYPE.items():
        out = F.when(plant == p, label(code, types)).otherwise(out)
    return out


def gold_stops(
    stops: DataFrame,
    machines: DataFrame,
    sectors: DataFrame,
    factories: DataFrame,
    reasons: DataFrame,
    families: DataFrame,
    family_groups: DataFrame,
    setup_reasons: DataFrame,
    as_of: AsOf,
    days: int = 90,
    low: AsOf | None = None,
    high: AsOf | None = None,
    plant_scoped: bool = True,
) -> DataFrame:
    """Stops of the window (or of ``[low, high]`` in a backfill), classified and grouped.

    Stops whose machine, sector, factory, reason or family is unknown are dropped; family
    group and setup type are optional. An open stop ends at ``as_of``.
    """
    start, end = F.col("data_hora_inicio"), F.col("data_hora_fim")
    window = in_window(start, end, as_of, days) if low is None else touches_range(start, end, low, high)
    types = group_setup_types(stops, setup_reasons, window if low is None else None, plant_scoped)
    family = dimension(families, "id", "id_familia", {"descricao": "familia", "id_familia_agrupada": "grupo"})
    groups = family_groups.select(F.col("id").alias("grupo"), F.col("descricao").alias("grupo_descricao"))
    reason = enrich(_reasons(reasons), family, "id_familia", "inner").join(groups, "grupo", "left")

    rows = enrich(stops.where(window), _place(machines, sectors, factories, "inner"), "maquina_id", "inner", machines)
    rows = enrich(rows, reason, "codigo", "inner", reasons)
    rows = join_sparse(rows, types, [PLANT, "id_grupo"] if plant_scoped else ["id_grupo"], "id_grupo", "id")
    tipo_setup = F.coalesce("tipo_setup_grupo", setup_type(F.col(PLANT), F.col("codigo")))
    rows = rows.withColumn("tipo_setup", tipo_setup)
    is_setup = F.col("tipo_setup").isNotNull()
    group = F.when(
        F.col("id_grupo").isNull() & is_setup, short_md5(F.col(PLANT), F.col("id"), F.col("maquina_id"))
    ).otherwise(F.col("id_grupo").cast("string"))
    return rows.select(
        PLANT,
        F.col("id").alias("id_parada"),
        "data_hora_inicio",
        F.coalesce(end, clock.ntz(as_of)).alias("data_hora_fim"),
        "tempo",
        "codigo",
        "descricao",
        "numero_produto",
        "familia",
        F.when(is_setup, codes.SETUP).otherwise(F.col("grupo_descricao")).alias("familia_agrupada"),
        stop_class(F.col("descricao"), F.col("grupo_descricao")).alias("tipo"),
        "status",
        "turno",
        "peso_oee",
        group.alias("id_grupo"),
        "tipo_setup",
        F.col("maquina_id").alias("id_equipamento"),
        "nome_equipamento",
        "documento",
        "programa",
        "fabrica",
        "setor",
        "ferramental",
        "ref_matriz",
        "cracha_apoio",
        "cracha_preparador",
        "cracha_lider",
    )


def gold_quality(
    quality: DataFrame, machines: DataFrame, sectors: DataFrame, factories: DataFrame, reasons: DataFrame,
    as_of: AsOf, days: int = 90,
) -> DataFrame:
    """Quality losses with names, the origin machine and the lost time."""
    origin = dimension(machines, "id", "maquina_id_origem", {"nome": "nome_equipamento_origem"})
    rows = quality.where(point_in_window(F.col("data_hora"), as_of, days))
    rows = enrich(rows, _place(machines, sectors, factories, "left"), "maquina_id", bounded_by=machines)
    rows = enrich(enrich(rows, _reasons(reasons), "codigo"), origin, "maquina_id_origem")
    lost = ratio(F.col("ciclo") * F.col("valor"), F.col("pares_batida"))
    return _point_fact(
        rows.withColumn("tempo_perda_qualidade", lost), quality,
        ["pares_batida", "tempo_perda_qualidade", "maquina_id_origem", "nome_equipamento_origem"],
    )


def gold_performance(
    performance: DataFrame, machines: DataFrame, sectors: DataFrame, factories: DataFrame, reasons: DataFrame,
    as_of: AsOf, days: int = 90,
) -> DataFrame:
    """Performance losses with names and the lost time."""
    rows = performance.where(point_in_window(F.col("data_hora"), as_of, days))
    rows = enrich(rows, _place(machines, sectors, factories, "left"), "maquina_id", bounded_by=machines)
    rows = enrich(rows, _reasons(reasons), "codigo")
    return _point_fact(
        rows.withColumn("tempo_perda_performance", F.col("ciclo") * F.col("valor")), performance,
        ["tempo_perda_performance", "cracha_preparador", "cracha_lider"],
    )


def _point_fact(rows: DataFrame, fact: DataFrame, own: Sequence[str]) -> DataFrame:
    carried = [c for c in ("efetivo", "turno", "numero_produto", "programa", "documento") if c in fact.columns]
    return rows.select(
        PLANT, "data_hora", "codigo", "descricao", "peso_oee", F.col("maquina_id").alias("id_equipamento"),
        "nome_equipamento", "setor", "fabrica", "ciclo", "valor", *carried, *own,
    )


def gold_support_calls(
    calls: DataFrame, machines: DataFrame, sectors: DataFrame, factories: DataFrame, reasons: DataFrame,
    families: DataFrame, as_of: AsOf, days: int = 90,
) -> DataFrame:
    """Support calls of the window with reason, family, machine, sector and factory."""
    family = dimension(families, "id", "id_familia", {"descricao": "familia"})
    reason = enrich(_reasons(reasons), family, "id_familia")
    rows = calls.where(in_window(F.col("data_hora_inicio"), F.col("data_hora_fim"), as_of, days))
    rows = enrich(rows, reason, "codigo", bounded_by=reasons)
    rows = enrich(rows, _place(machines, sectors, factories, "left"), "maquina_id", bounded_by=machines)
    return rows.select(
        PLANT, "id", "data_hora_inicio", "data_hora_fim", "tempo", "status", "codigo",
        F.col("descricao").alias("descricao_motivo"), "familia", "peso_oee", "maquina_id", "nome_equipamento",
        "id_setor", "setor", "id_fabrica", "fabrica", "cracha_preparador", "cracha_lider",
    )


def gold_machines(machines: DataFrame, sectors: DataFrame, factories: DataFrame) -> DataFrame:
    """Machine dimension with sector and factory names; rebuilt as a whole."""
    s = dimension(sectors, "id", "id_setor", {"descricao": "setor", "id_fabrica": "id_fabrica"})
    f = dimension(factories, "id", "id_fabrica", {"descricao": "fabrica"})
    own = [c for c in machines.columns if c != "id_setor"]
    return enrich(enrich(machines, s, "id_setor"), f, "id_fabrica").select(
        *own, "id_fabrica", "fabrica", "id_setor", "setor"
    )


# --- table state -------------------------------------------------------------------------


def refreshed_stops(target: DataFrame, rows: DataFrame, as_of: AsOf, days: int = 90, **kwargs) -> DataFrame:
    """Gold stops: changed rows only, rows of the window that disappeared are deleted."""
    return merge_into(
        target, rows, [PLANT, "id_parada"], as_of, missing="delete",
        missing_where=lambda col: in_window(col("data_hora_inicio"), col("data_hora_fim"), as_of, days), **kwargs,
    )


def backfilled_stops(target: DataFrame, rows: DataFrame, low: AsOf, high: AsOf, as_of: AsOf, **kwargs) -> DataFrame:
    return merge_into(
        target, rows, [PLANT, "id_parada"], as_of, missing="delete",
        missing_where=lambda col: touches_range(col("data_hora_inicio"), col("data_hora_fim"), low, high), **kwargs,
    )


POINT_KEY = (PLANT, "id_equipamento", "data_hora", "codigo")


def refreshed_points(target: DataFrame, rows: DataFrame, as_of: AsOf, days: int = 90, **kwargs) -> DataFrame:
    """Gold quality or performance: matched rows are always rewritten."""
    return merge_into(
        target, rows, POINT_KEY, as_of, update="always", missing="delete",
        missing_where=lambda col: point_in_window(col("data_hora"), as_of, days), **kwargs,
    )


def backfilled_points(target: DataFrame, rows: DataFrame, low: AsOf, high: AsOf, as_of: AsOf, **kwargs) -> DataFrame:
    return merge_into(
        target, rows, POINT_KEY, as_of, update="always", missing="delete",
        missing_where=lambda col: col("data_hora").between(clock.ntz(low), clock.ntz(high)), **kwargs,
    )


def refreshed_support_calls(target: DataFrame, rows: DataFrame, as_of: AsOf, days: int = 90) -> DataFrame:
    """Gold support calls: window deleted and reloaded, key conflicts ignored."""
    window = in_window(F.col("data_hora_inicio"), F.col("data_hora_fim"), as_of, days)
    return replace_window(target, rows, window, [PLANT, "id"])
