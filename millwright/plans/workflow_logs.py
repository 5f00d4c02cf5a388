"""Tooling tables out of JSON workflow logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.functions import codes
from millwright.operators.nested import matched

# JSON keys of the webhook body, and of the two arrays in it.
BODY = (
    "estab", "mercado", "produto", "codEstab", "deposito", "codDeposito", "codProduto", "descProduto", "qtdeEliminar",
    "statusProduto", "valorResidual", "descFerramenta", "numeroProcesso", "tipoFerramenta",
    "qtdeEstoqueAtual", "dataLimiteAnalise", "segmentoDeNegocio", "codGrupoFerramental", "descSegmentoNegocio",
    "descGrupoFerramental",
)
SKU = ("sku", "descricao", "status", "qtdCif", "codFabrica", "ferramenta", "qtdEstoque")
RELATED = (
    "estab", "produto", "codProduto", "descProduto", "ultimoLancamento", "descricaoComponente",
)
# Body key -> column of the events table, and the typed ones.
EVENT_COLUMNS = {
    "estab": "estabelecimento", "mercado": "mercado", "produto": "produto", "codEstab": "cod_estabelecimento",
    "deposito": "deposito", "codDeposito": "cod_deposito", "codProduto": "cod_produto", "descProduto": "desc_produto",
    "qtdeEliminar": "qtde_eliminar", "statusProduto": "status_produto",
    "valorResidual": "valor_residual", "descFerramenta": "desc_ferramenta", "numeroProcesso": "numero_processo",
    "tipoFerramenta": "tipo_ferramenta", "qtdeEstoqueAtual": "qtde_estoque_atual",
    "dataLimiteAnalise": "data_limite_analise", "segmentoDeNegocio": "segmento_de_negocio",
    "codGrupoFerramental": "cod_grupo_ferramental", "descSegmentoNegocio": "desc_segmento_negocio",
    "descGrupoFerramental": "desc_grupo_ferramental",
}
EVENT_TYPES = {
    "codEstab": "smallint", "qtdeEliminar": "int", "valorResidual": "float", "qtdeEstoqueAtual": "float",
    "segmentoDeNegocio": "int",
}


def _texts(names: Sequence[str]) -> str:
    return "struct<" + ",".join(f"{n}:string" for n in names) + ">"


def body_schema(brand_key: str, related_brand_key: str) -> str:
    """Webhook body; the keys that hold the brand differ between installations."""
    return (
        "corpo " + _texts((*BODY, brand_key))[:-1]
        + f",skuFerramentas:array<{_texts(SKU)}>,produtosRelacionados:array<{_texts((*RELATED, related_brand_key))}>>"
    )


# Brand keys of a body without an installation prefix; callers name their own.
BRAND_KEY, RELATED_BRAND_KEY = "marca", "desMarca"
RESERVE_SCHEMA = (
    "result struct<corpoParaAPIReservar:struct<param:array<struct<id_flake:string,cod_usuario:string>>,"
    "Ferramentais:array<struct<desArea:string,datReserva:string,desJustificativa:string,skuFerramentas:array<struct<codSku:string>>>>>>"
)


def _logs(logs: DataFrame, kind: str, workflows: Sequence[str]) -> DataFrame:
    return logs.where((F.col("tipo") == kind) & F.col("workflow_id").isin(list(workflows)))


def _date(text: Column) -> Column:
    return F.to_date(text, "dd/MM/yyyy")


def events(
    logs: DataFrame, workflows: Sequence[str] = codes.TOOLING_WORKFLOWS, brand_key: str = BRAND_KEY
) -> DataFrame:
    """One row per webhook log with a plant in its body."""
    schema = body_schema(brand_key, RELATED_BRAND_KEY)
    rows = _logs(logs, "WEB_HOOK", workflows).withColumn("_d", F.from_json("data", schema))

    def column(key: str, name: str) -> Column:
        c = F.col(f"_d.corpo.{key}")
        if key == "dataLimiteAnalise":
            return _date(c).alias(name)
        return (c.cast(EVENT_TYPES[key]) if key in EVENT_TYPES else c).alias(name)

    return rows.where(F.col("_d.corpo.estab").isNotNull()).select(
        F.col("id").alias("id_log"),
        F.col("criado_em").alias("data_criacao"),
        F.col("atualizado_em"),
        *[column(k, n) for k, n in EVENT_COLUMNS.items()],
        column(brand_key, "marca"),
    )


def _elements(
    logs: DataFrame, workflows: Sequence[str], array: str, related_brand_key: str = RELATED_BRAND_KEY
) -> DataFrame:
    """One row per array element; logs without the array vanish."""
    rows = _logs(logs, "WEB_HOOK", workflows)
    return rows.select(
        F.col("id").alias("log_id"), F.explode(F.from_json("data", body_schema(BRAND_KEY, related_brand_key))["corpo"][array]).alias("e")
    )


def skus(logs: DataFrame, workflows: Sequence[str] = codes.TOOLING_WORKFLOWS) -> DataFrame:
    return _elements(logs, workflows, "skuFerramentas").select(
        "log_id",
        "e.sku",
        "e.descricao",
        "e.status",
        F.col("e.qtdCif").cast("float").alias("qtdcif"),
        F.col("e.codFabrica").alias("fabrica"),
        "e.ferramenta",
        F.col("e.qtdEstoque").cast("float").alias("qtd_estoque"),
    )


def related_products(
    logs: DataFrame, workflows: Sequence[str] = codes.TOOLING_WORKFLOWS, brand_key: str = RELATED_BRAND_KEY
) -> DataFrame:
    return _elements(logs, workflows, "produtosRelacionados", brand_key).select(
        "log_id",
        F.col("e.estab").alias("estabelecimento"),
        "e.produto",
        F.col("e.codProduto").alias("cod_produto"),
        F.col("e.descProduto").alias("desc_produto"),
        F.col(f"e.{brand_key}").alias("des_marca"),
        F.col("e.ultimoLancamento").alias("ultimo_lancamento"),
        F.col("e.descricaoComponente").alias("descricao_componente"),
    )


def areas(logs: DataFrame, workflows: Sequence[str] = codes.TOOLING_WORKFLOWS) -> DataFrame:
    """Reservations: parameters x tools x SKUs of each log; empty arrays keep the row.

    Logs whose code names no webhook node vanish.
    """
    rows = matched(_logs(logs, "CODE", workflows), "code", codes.WEBHOOK_NODE_PATTERN, "webhook_node_id")
    body = F.from_json("data", RESERVE_SCHEMA)["result"]["corpoParaAPIReservar"]
    rows = rows.withColumn("_b", body).where(F.col("_b").isNotNull())
    rows = rows.withColumn("_p", F.explode_outer("_b.param")).withColumn("_f", F.explode_outer("_b.Ferramentais"))
    rows = rows.withColumn("_s", F.explode_outer("_f.skuFerramentas"))
    return rows.select(
        "id",
        F.col("criado_em").alias("data_criacao"),
        "atualizado_em",
        "status",
        F.col("_p.id_flake").alias("id_flake"),
        F.col("_p.cod_usuario").alias("cod_usuario"),
        F.col("_f.desArea").alias("des_area"),
        _date(F.col("_f.datReserva")).alias("data_reserva"),
        F.col("_f.desJustificativa").alias("justificativa"),
        F.col("_s.codSku").alias("cod_sku"),
        "webhook_node_id",
    )
