"""Silver tables: canonical columns, one row per key, merged with the rolling window."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.functions import clock
from millwright.functions.clock import AsOf
from millwright.functions.values import same_text
from millwright.operators.dedup import latest_per_key
from millwright.operators.intervals import in_window, point_in_window, touches_range
from millwright.operators.joins import join_sparse
from millwright.operators.merge import merge_into, replace_window, soft_delete_merge

PLANT = "id_estabelecimento"
AUDIT = "data_atualizacao_db"


@dataclass(frozen=True)
class SilverTable:
    """How a source table becomes a silver one.

    ``columns`` maps source to canonical names; ``span`` holds the time columns: one for
    point events, two for intervals, none for dimensions.
    """

    keys: tuple[str, ...]
    columns: Mapping[str, str]
    span: tuple[str, ...] = ()
    types: Mapping[str, str] = field(default_factory=dict)
    dedup_by: str | None = None
    refresh_when: Callable | None = None
    deactivated_at: str | None = None


# Source column -> canonical column, and narrowed types.
TABLES = {
    "stops": SilverTable(
        keys=(PLANT, "id"),
        columns={
            "Id": "id", "Maquina_ID": "maquina_id", "Codigo": "codigo", "Hora_Inicio": "data_hora_inicio",
            "E3TimeStamp": "data_hora_fim", "tempo": "tempo", "Turno": "turno", "Status": "status",
            "Programa": "programa", "Documento": "documento", "NumeroProduto": "numero_produto",
            "Efetivo": "efetivo", "ID_Grupo": "id_grupo", "Ref_Matriz": "ref_matriz",
            "Ferramental": "ferramental", "Cracha_Apoio": "cracha_apoio",
            "Cracha_Operador": "cracha_operador", "Cracha_Preparador": "cracha_preparador",
            "Cracha_Lider": "cracha_lider",
        },
        span=("data_hora_inicio", "data_hora_fim"),
        dedup_by="data_hora_fim",
        # A stop still open in the target is always rewritten.
        refresh_when=lambda col: col("data_hora_fim").isNull(),
    ),
    "quality": SilverTable(
        keys=(PLANT, "data_hora", "maquina_id", "codigo"),
        columns={
            "E3TimeStamp": "data_hora", "Codigo": "codigo", "Valor": "valor", "Maquina_ID": "maquina_id",
            "Ciclo": "ciclo", "Pares_Batida": "pares_batida", "Turno": "turno", "Programa": "programa",
            "Documento": "documento", "NumeroProduto": "numero_produto", "Efetivo": "efetivo",
            "Maquina_ID_Origem": "maquina_id_origem",
        },
        span=("data_hora",),
        dedup_by="data_hora",
    ),
    "performance": SilverTable(
        keys=(PLANT, "data_hora", "maquina_id", "codigo"),
        columns={
            "E3TimeStamp": "data_hora", "Maquina_ID": "maquina_id", "Codigo": "codigo", "Valor": "valor",
            "Ciclo": "ciclo", "Turno": "turno", "Programa": "programa", "Documento": "documento",
            "NumeroProduto": "numero_produto", "Efetivo": "efetivo",
            "Cracha_Preparador": "cracha_preparador", "Cracha_Lider": "cracha_lider",
        },
        span=("data_hora",),
        dedup_by="data_hora",
    ),
    "runs": SilverTable(
        keys=(PLANT, "id"),
        columns={
            "ID": "id", "ID_Maq": "id_equipamento", "NumeroProduto": "numero_produto", "Programa": "programa",
            "Documento": "documento", "DataInicio": "data_inicio", "DataFim": "data_fim", "Ciclo": "ciclo",
            "ParesBatidas": "pares_batidas", "Efetivo": "efetivo",
        },
        span=("data_inicio", "data_fim"),
    ),
    "cycles": SilverTable(
        keys=(PLANT, "id_equipamento", "data_hora"),
        columns={
            "id_equipamento": "id_equipamento", "E3TimeStamp": "data_hora", "Ciclo Atual": "ciclo_atual",
            "Ciclo TI": "ciclo_ti", "Diferenca": "diferenca", "Turno": "turno", "Programa": "programa",
            "Documento": "documento", "NumeroProduto": "numero_produto", "Efetivo": "efetivo",
            "ferramental": "ferramental", "cod_refer_matriz": "cod_refer_matriz", "ParBat": "par_bat",
        },
        span=("data_hora",),
        types={
            PLANT: "smallint", "id_equipamento": "int", "ciclo_atual": "float", "ciclo_ti": "float",
            "diferenca": "float", "programa": "int", "documento": "smallint", "par_bat": "smallint",
        },
    ),
    "support_calls": SilverTable(
        keys=(PLANT, "id"),
        columns={
            "Id": "id", "DataHoraInicio": "data_hora_inicio", "DataHoraFim": "data_hora_fim",
            "CodigoMotivo": "codigo", "Maquina_ID": "maquina_id", "Status": "status", "Tempo": "tempo",
            "Cracha_Preparador": "cracha_preparador", "Cracha_Lider": "cracha_lider",
        },
        span=("data_hora_inicio", "data_hora_fim"),
    ),
    "factories": SilverTable(keys=(PLANT, "id"), columns={"ID": "id", "Fabrica": "descricao"}),
    "sectors": SilverTable(
        keys=(PLANT, "id"), columns={"ID": "id", "ID_Fabrica": "id_fabrica", "Pavilhao": "descricao"}
    ),
    "machines": SilverTable(
        keys=(PLANT, "id"),
        columns={
            "ID": "id", "ID_Pavilhao": "id_setor", "Nome": "nome", "Descricao": "descricao",
            "Hora_Criacao": "hora_criacao", "IP": "ip",
        },
        deactivated_at="data_desativacao",
    ),
    "reasons": SilverTable(
        keys=(PLANT, "codigo"),
        columns={
            "Codigo": "codigo", "Descricao": "descricao", "PesoOEE": "peso_oee", "ID_Familia": "id_familia",
            "E3TimeStamp": "data_criacao",
        },
    ),
    "families": SilverTable(
        keys=(PLANT, "id"),
        columns={"ID": "id", "Indice": "indice", "Familia": "descricao", "E3TimeStamp": "data_criacao"},
    ),
}


def canonical(raw: DataFrame, spec: SilverTable) -> DataFrame:
    """Declared source columns that are present, renamed and narrowed; the plant comes first."""
    types = spec.types

    def cast(source: str, name: str) -> Column:
        c = F.col(f"`{source}`")
        return (c.cast(types[name]) if name in types else c).alias(name)

    present = {s: n for s, n in spec.columns.items() if s in raw.columns}
    return raw.select(cast(PLANT, PLANT), *[cast(s, n) for s, n in present.items()])


def window_of(spec: SilverTable, as_of: AsOf, days: int) -> Column:
    """Rolling-window predicate of a fact, for extracts and for deletes alike."""
    cols = [F.col(c) for c in spec.span]
    return in_window(*cols, as_of, days) if len(cols) == 2 else point_in_window(*cols, as_of, days)


def range_of(spec: SilverTable, low: AsOf, high: AsOf) -> Column:
    """Backfill predicate of a fact for an explicit range."""
    if len(spec.span) == 2:
        return touches_range(F.col(spec.span[0]), F.col(spec.span[1]), low, high)
    return F.col(spec.span[0]).between(clock.ntz(low), clock.ntz(high))


def staged(raw: DataFrame, spec: SilverTable) -> DataFrame:
    out = canonical(raw, spec)
    return latest_per_key(out, spec.keys, spec.dedup_by) if spec.dedup_by else out


def refreshed(
    target: DataFrame, stage: DataFrame, spec: SilverTable, as_of: AsOf, days: int = 90, **kwargs
) -> DataFrame:
    """Fact after an incremental run: changed rows updated, new ones added, and rows of the
    window that left the source deleted."""
    return merge_into(
        target, stage, spec.keys, as_of, refresh_when=spec.refresh_when, missing="delete",
        missing_where=lambda col: window_of(spec, as_of, days), **kwargs,
    )


def backfilled(
    target: DataFrame, stage: DataFrame, spec: SilverTable, low: AsOf, high: AsOf, as_of: AsOf, **kwargs
) -> DataFrame:
    """Fact after re-extracting an explicit range."""
    return merge_into(
        target, stage, spec.keys, as_of, refresh_when=spec.refresh_when, missing="delete",
        missing_where=lambda col: range_of(spec, low, high), **kwargs,
    )


def refreshed_cycles(target: DataFrame, stage: DataFrame, as_of: AsOf, **kwargs) -> DataFrame:
    """Cycles after an incremental run.

    Rows newer than the oldest staged cycle are deleted when they left the source, but
    only for machines that were staged: machines without news are not extracted.
    """
    spec = TABLES["cycles"]
    scope_keys = [PLANT, "id_equipamento"]
    scope = stage.select(*scope_keys).distinct().withColumn("_staged", F.lit(True))
    oldest = stage.agg(F.min("data_hora")).scalar()
    scoped = target.join(scope, scope_keys, "left").withColumn(
        "_staged", F.col("_staged") & (F.col("data_hora") >= oldest)
    )
    return merge_into(
        scoped, stage, spec.keys, as_of, missing="delete", missing_where=lambda col: col("_staged"), **kwargs
    ).drop("_staged")


def refreshed_support_calls(
    target: DataFrame, stage: DataFrame, as_of: AsOf, days: int = 90
) -> DataFrame:
    """Support calls: the window is deleted and loaded again."""
    window = window_of(TABLES["support_calls"], as_of, days)
    return replace_window(target, stage.withColumn(AUDIT, clock.ntz(as_of)), window)


def refreshed_dimension(target: DataFrame, stage: DataFrame, spec: SilverTable, as_of: AsOf) -> DataFrame:
    return soft_delete_merge(target, stage, spec.keys, as_of, deactivated_at=spec.deactivated_at)


def snapshot(target: DataFrame, current: DataFrame, logical_date: AsOf, as_of: AsOf) -> DataFrame:
    """Daily segmentation snapshot: today's rows are added or overwritten, history stays."""
    rows = current.select("equipamento", "segmentacao").withColumn("data", clock.day(logical_date))
    return merge_into(target, rows, ["equipamento", "data"], as_of, update="always", audit="updated_at")


def listed_sync(
    target: DataFrame, source: DataFrame, as_of: AsOf, days: int = 90, key: str = "id",
    modified: str = "modified", created: str = "created",
) -> DataFrame:
    """Three-step list sync: update when the modification time differs, insert new ids,
    delete recently created ids that left the source."""
    limit = F.timestamp_add("DAY", F.lit(-days), clock.ntz(as_of))
    return merge_into(
        target, source, [key], as_of, compare=[modified], missing="delete",
        missing_where=lambda col: col(created) >= limit, audit=None,
    )


def with_master_date(approvals: DataFrame) -> DataFrame:
    """Approved items without a master date take the engineering approval date."""
    approved = F.when(same_text(F.col("status"), "Aprovado"), F.col("dt_aprovacao_eng").cast("date"))
    return approvals.withColumn("dt_fap", F.coalesce(F.col("dt_fap").cast("date"), approved))


def gains_with_master_date(gains: DataFrame, approvals: DataFrame) -> DataFrame:
    """Gains without a master date take the approval date of their request, when approved.

    Many gains have no request; they are spread over all tasks.
    """
    parent = approvals.where(same_text(F.col("status"), "Aprovado")).select(
        F.col("id").alias("id_solicitacao_assinatura"), F.col("dt_aprovacao_eng").cast("date").alias("_dt")
    )
    return (
        join_sparse(gains, parent, ["id_solicitacao_assinatura"], "id_solicitacao_assinatura")
        .withColumn("dt_fap", F.coalesce(F.col("dt_fap").cast("date"), F.col("_dt")))
        .select(*gains.columns)
    )


def staged_runs(raw: DataFrame, as_of: AsOf) -> DataFrame:
    """Staged product runs; a run that is still open ends at ``as_of``."""
    return canonical(raw, TABLES["runs"]).withColumn(
        "data_fim", F.coalesce(F.col("data_fim"), clock.ntz(as_of))
    )
