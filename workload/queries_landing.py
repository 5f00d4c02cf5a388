"""Registered landing queries: JSON logs, date repair, typing, quality checks and file round trips."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.functions import clock, codes
from millwright.functions.dates import DateFields, resolve_dates
from millwright.functions.typing import typed
from millwright.operators import quality
from millwright.plans import silver, workflow_logs
from millwright.session import checkpoint_dir
from millwright.sources import plants, tables
from millwright.streaming import continuous, incremental
from workload import oracle_landing as sql
from workload import roles
from workload.roles import table


def _text(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a workflow log: even ids are webhooks, odd ids are code steps."""
    e = F.col("event_id")
    w = codes.TOOLING_WORKFLOWS
    n = (e / 2).cast("bigint")

    def listed(count: Column, fields) -> Column:
        items = F.transform(F.sequence(F.lit(1), F.greatest(count.cast("int"), F.lit(1))), lambda i: F.struct(*fields(i)))
        return F.when(count > 0, items)

    body = F.struct(
        F.when(n % 10 != 0, _text("E", n % 7)).alias("estab"),
        F.col("event_type").alias("mercado"),
        _text("P", n).alias("produto"),
        (n % 100).cast("string").alias("codEstab"),
        (n % 50).cast("string").alias("qtdeEliminar"),
        (n % 40 / 4).cast("string").alias("valorResidual"),
        F.date_format("ts", "dd/MM/yyyy").alias("dataLimiteAnalise"),
        _text("N", n % 13).alias("numeroProcesso"),
        listed(n % 4, lambda i: [_text("S", i).alias("sku"), F.col("event_type").alias("status"), (i * 0.5).cast("string").alias("qtdCif"), _text("F", n % 3).alias("codFabrica")]).alias("skuFerramentas"),
        listed(n % 3, lambda i: [_text("E", n % 7).alias("estab"), _text("R", i).alias("codProduto")]).alias("produtosRelacionados"),
    )
    reserve = F.struct(
        listed(n % 2 + 1, lambda i: [_text("K", i).alias("id_flake"), _text("U", n % 5).alias("cod_usuario")]).alias("param"),
        listed(
            n % 3,
            lambda i: [
                _text("A", i).alias("desArea"),
                F.date_format("ts", "dd/MM/yyyy").alias("datReserva"),
                listed(n % 4, lambda j: [_text("S", j).alias("codSku")]).alias("skuFerramentas"),
            ],
        ).alias("Ferramentais"),
    )
    web = e % 2 == 0
    code = F.when(n % 5 != 0, F.concat(F.lit('x = getWorkflowVariable("ab-'), (n % 9).cast("string"), F.lit('f.numeroProcesso")'))).otherwise("none")
    return table(spark, sf_dir, "events").select(
        e.cast("string").alias("id"),
        F.col("ts").alias("criado_em"),
        F.col("ts").alias("atualizado_em"),
        F.col("event_type").alias("status"),
        F.when(n % 3 == 0, w[0]).when(n % 3 == 1, w[1]).otherwise("other").alias("workflow_id"),
        F.when(web, "WEB_HOOK").otherwise("CODE").alias("tipo"),
        F.when(web, F.to_json(F.struct(body.alias("corpo")))).otherwise(
            F.to_json(F.struct(F.struct(F.when(n % 11 != 0, reserve).alias("corpoParaAPIReservar")).alias("result")))
        ).alias("data"),
        code.alias("code"),
    )


EVENT_FIELDS = (
    "id_log data_criacao atualizado_em estabelecimento mercado produto cod_estabelecimento qtde_eliminar valor_residual "
    "data_limite_analise numero_processo"
).split()


def log_events(s: SparkSession, d: str) -> DataFrame:
    out = workflow_logs.events(logs(s, d)).select(*EVENT_FIELDS)
    return out.withColumn("valor_residual", F.col("valor_residual").cast("double")).withColumn("cod_estabelecimento", F.col("cod_estabelecimento").cast("int"))


def log_skus(s: SparkSession, d: str) -> DataFrame:
    return workflow_logs.skus(logs(s, d)).select("log_id", "sku", "status", F.col("qtdcif").cast("double").alias("qtdcif"), "fabrica")


def log_related(s: SparkSession, d: str) -> DataFrame:
    return workflow_logs.related_products(logs(s, d)).select("log_id", "estabelecimento", "cod_produto")


def log_areas(s: SparkSession, d: str) -> DataFrame:
    return workflow_logs.areas(logs(s, d)).drop("justificativa")


def list_items(s: SparkSession, d: str) -> DataFrame:
    """Approval items with text dates; half of them were written month first."""
    key = F.col("o_orderkey")
    created = F.timestamp_add("HOUR", key % 24, F.timestamp_add("MONTH", F.lit(300), F.col("o_orderdate")))

    def at(hours: int) -> Column:
        return F.timestamp_add("HOUR", F.lit(hours), created)

    def written(ts: Column) -> Column:
        return F.when(key % 2 == 0, F.date_format(ts, "dd/MM/yyyy HH:mm:ss")).otherwise(F.date_format(ts, "MM/dd/yyyy HH:mm:ss"))

    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    return table(s, d, "orders").select(
        key.cast("string").alias("id"),
        F.when(key % 17 != 0, written(at(1))).otherwise("nan").alias("dt_aprovacao_eng"),
        written(at(5)).alias("dt_aprovacao_analista"),
        F.date_format(at(3), iso).alias("Created"),
        F.date_format(at(5), iso).alias("Modified"),
        F.date_format(created, "dd/MM/yyyy").alias("dt_fap"),
        F.when(key % 5 != 0, F.col("o_totalprice").cast("string")).otherwise("None").alias("valor"),
        F.when(key % 3 == 0, "True").when(key % 3 == 1, "0").otherwise("").alias("ativo"),
        F.when(key % 7 == 0, "abc").otherwise((key % 100).cast("string")).alias("cracha"),
    )


DATE_FIELDS = DateFields(
    local=("dt_aprovacao_eng",), utc=("dt_aprovacao_analista",), system=("Created", "Modified"), manual=("dt_fap",)
)


def repaired_dates(s: SparkSession, d: str) -> DataFrame:
    out = resolve_dates(list_items(s, d), DATE_FIELDS)
    return out.select("id", "dt_aprovacao_eng", "dt_aprovacao_analista", "Created", "Modified", "dt_fap")


# Written shapes of one moment; the last two are no dates.
SHAPES = (
    "dd/MM/yyyy HH:mm:ss", "yyyy/MM/dd", "dd-MM-yyyy", "dd.MM.yyyy HH:mm", "d MMM yyyy", "yyyy-M-d", "dd/MM/yy", "yyyy-MM-dd'T'HH:mm:ss'Z'",
    "yyyy-MM-dd HH:mm:ss.SSS", "MMM d, yyyy HH:mm:ss", "dd/MM/yyyy hh:mm:ss a", "yyyy-MM-dd'T'HH:mm:ss'-03:00'", "yyyyMMdd", "dd-MMM-yyyy",
    "'31/02/'yyyy", "'week 23'",
)


def date_shapes(s: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey")
    moment = F.timestamp_add("SECOND", key % 86_399, F.timestamp_add("MONTH", F.lit(300), F.col("o_orderdate")))
    rows = table(s, d, "orders").select(key.alias("id"), moment.alias("moment"))
    texts = [F.when(F.col("id") % len(SHAPES) == k, F.date_format("moment", shape)) for k, shape in enumerate(SHAPES[:-1])]
    rows = rows.select("id", F.coalesce(*texts, F.lit("week 23")).alias("lido"), F.lit(None).cast("string").alias("vazio"))
    out = resolve_dates(rows, DateFields(manual=("lido", "vazio")))
    return out.select("id", "lido", "vazio")


def typed_items(s: SparkSession, d: str) -> DataFrame:
    schema = {"id": "bigint", "valor": "decimal(18,2)", "ativo": "boolean", "cracha": "int", "absent": "string"}
    return typed(list_items(s, d), schema).withColumn("valor", F.col("valor").cast("double"))


def recent_items(s: SparkSession, d: str) -> DataFrame:
    items = resolve_dates(list_items(s, d), DATE_FIELDS)
    return incremental.modified_since(items, "2026-08-01 00:00:00", 90).select("id", "Modified")


def last_orders(s: SparkSession, d: str) -> DataFrame:
    return incremental.last_ids(table(s, d, "orders"), 1000, "o_orderkey")


def backfill_extract(s: SparkSession, d: str) -> DataFrame:
    spec = silver.TABLES["stops"]
    rows = roles.stops(s, d).where(silver.range_of(spec, "2024-01-10 05:24:00", "2024-01-12 05:24:00"))
    return rows.select("id", "data_hora_inicio", "data_hora_fim")


def quality_report(s: SparkSession, d: str) -> DataFrame:
    lines, events = table(s, d, "lineitem"), table(s, d, "events")
    return quality.report(
        quality.table_checks(
            lines,
            unique_keys=[["l_orderkey", "l_linenumber"]],
            not_null=["l_partkey"],
            accepted={"l_returnflag": ["A", "N"]},
            at_least={"l_quantity": 5},
            severity={"rows": "warn"},
        ),
        quality.table_checks(table(s, d, "orders"), unique_keys=[["o_orderkey"]]),
        quality.table_checks(events, parents={"user_id": (table(s, d, "supplier"), "s_suppkey")}),
    )


def refreshes_checked(s: SparkSession, d: str) -> DataFrame:
    """Two full refreshes whose checks are counted by the write; the second fails one and the first load stays."""
    path, orders = _folder(s, "checked"), table(s, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    reports = []
    for batch, rows in ((1, orders.where("o_orderstatus <> 'P'")), (2, orders)):
        checks = quality.WriteChecks(rows, not_null=["o_orderkey"], accepted={"o_orderstatus": ["F", "O"]}, at_least={"o_totalprice": 0})
        tables.full_refresh(checks.rows, path, f"2024-01-0{batch} 00:00:00", accept=checks.passed)
        reports.append(checks.report().withColumn("lote", F.lit(batch)))
    day = F.date_format(F.max("loaded_at"), "yyyy-MM-dd")
    state = tables.read_refreshed(s, path).agg(F.count(F.lit(1)).alias("falhas"), day.alias("situacao"))
    return quality.report(*reports, state.select(F.lit("linhas").alias("teste"), "falhas", "situacao", F.lit(0).alias("lote")))


def event_freshness(s: SparkSession, d: str) -> DataFrame:
    return quality.freshness(table(s, d, "events"), "ts", "2024-02-03 00:00:00")


def machine_completeness(s: SparkSession, d: str) -> DataFrame:
    runs = table(s, d, "events").withColumn("fim", F.when(F.col("event_id") % 4 != 0, F.col("ts")))
    expected = table(s, d, "customer").select(F.col("c_custkey").alias("user_id"))
    return quality.completeness(expected, runs, "user_id", "ts", "fim", "2024-01-31 00:00:00", 1440)


def _folder(s: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(s)}/{name}-{uuid.uuid4().hex}"


def plants_round_trip(s: SparkSession, d: str) -> DataFrame:
    """Each plant lands in its own file; the files are unioned by name and tagged."""
    stops, root = roles.stops(s, d), _folder(s, "plants")
    paths = {code: f"{root}/{name}" for name, code in codes.PLANTS.items()}
    for code, path in paths.items():
        part = stops.where(F.col("id_estabelecimento") == code).drop("id_estabelecimento")
        tables.write_once(part if code != 40 else part.drop("ferramental"), path)
    out = plants.extract_plants(s.read.parquet, paths)
    return out.select("id_estabelecimento", "id", "maquina_id", "codigo", "data_hora_inicio", "ferramental")


def keyed_round_trip(s: SparkSession, d: str) -> DataFrame:
    """Cycles stored one folder per machine group, read back with the key from the folder name."""
    root = _folder(s, "keyed")
    grouped = roles.cycles(s, d).withColumn("grupo", F.col("id_equipamento") % 10)
    for g in range(10):
        tables.write_once(grouped.where(F.col("grupo") == g).select("data_hora", "ciclo_atual"), f"{root}/Ciclo {g}")
    return plants.read_keyed_folders(s, root).select("id_equipamento", "data_hora", "ciclo_atual")


def csv_round_trip(s: SparkSession, d: str) -> DataFrame:
    path = _folder(s, "csv")
    rows = table(s, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    tables.write_csv(rows, path)
    return tables.read_csv(s, path, "o_orderkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date")


MONTHS_AS_OF = "2001-09-01 00:00:00"
MONTHS_WINDOW = "2000-01-01 00:00:00"


def months_merged(s: SparkSession, d: str) -> DataFrame:
    """Orders by month, merged with rows that moved to other months, lost their time or have no key."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp_ntz")
    orders, path = table(s, d, "orders"), _folder(s, "months")
    stored = orders.select(
        key.alias("id"), F.when(key % 13 != 0, day).alias("dia"), F.col("o_totalprice").alias("valor"), clock.ntz("1995-01-01 00:00:00").alias("data_atualizacao_db")
    )
    tables.write_months(stored, path, "dia")
    source = orders.select(
        F.when(key % 10 < 2, key + 1000000000).when(key % 17 != 0, key).alias("id"),
        F.when(key % 7 == 0, F.timestamp_add("DAY", F.lit(40), day)).when(key % 13 != 1, day).alias("dia"),
        (F.col("o_totalprice") + F.when(key % 11 == 0, 1).otherwise(0)).alias("valor"),
    )
    window = clock.ntz(MONTHS_WINDOW)
    tables.merge_months(s, path, source, ["id"], MONTHS_AS_OF, "dia", window=lambda c: c("dia") >= window, missing="delete")
    return tables.read_months(s, path)



def orders_refreshed(s: SparkSession, d: str) -> DataFrame:
    """Replaced as a whole twice, the second time from itself; an empty source in between changes nothing."""
    path, orders = _folder(s, "refreshed"), table(s, d, "orders").select("o_orderkey", "o_totalprice")
    tables.full_refresh(orders.where("o_orderkey % 2 = 0"), path, "2024-01-01 00:00:00")
    tables.full_refresh(orders.limit(0), path, "2024-01-02 00:00:00")
    rest = orders.where("o_orderkey % 2 = 1 AND o_orderkey % 3 = 0")
    tables.full_refresh(tables.read_refreshed(s, path).drop("loaded_at").unionAll(rest), path, "2024-01-03 00:00:00")
    return tables.read_refreshed(s, path)


def rows_appended(s: SparkSession, d: str) -> DataFrame:
    """An empty table like its source, then two appends."""
    path, orders = _folder(s, "appended"), table(s, d, "orders").select("o_orderkey", "o_orderstatus")
    tables.empty_like(orders, path)
    for k in (0, 1):
        tables.append(orders.where(F.col("o_orderkey") % 4 == k), path)
    return tables.read_union(s, path)


STREAM_AS_OF = "2001-09-01 00:00:00"


def orders_streamed(s: SparkSession, d: str) -> DataFrame:
    """Order versions that land out of order and repeatedly, in three arrivals with a restart before each, merged as a stream."""
    key, orders = F.col("o_orderkey"), table(s, d, "orders")

    def version(v: int, where: Column) -> DataFrame:
        day = F.timestamp_add("DAY", F.lit(20 * v), F.col("o_orderdate").cast("timestamp_ntz"))
        return orders.where(where).select(key.alias("id"), day.alias("dia"), F.lit(v).alias("versao"), (F.col("o_totalprice") + v).alias("valor"))

    root = _folder(s, "stream")
    stored = version(0, key % 4 == 0).withColumn("data_atualizacao_db", clock.ntz("1995-01-01 00:00:00"))
    tables.write_months(stored, f"{root}/table", "dia")
    arrivals = (
        version(0, key % 10 != 9).unionAll(version(2, key % 3 == 0)),
        version(1, key % 4 == 2).unionAll(version(0, key % 5 == 0)),  # late where version 2 has come; partly repeated
        version(2, key % 3 == 0).unionAll(version(1, key % 10 == 9)),
    )
    for rows in arrivals:
        rows.repartition(2).write.mode("append").parquet(f"{root}/landed")
        stream = continuous.landed_stream(s, f"{root}/landed", rows.schema, max_files=2)
        continuous.merge_available(stream, f"{root}/table", f"{root}/checkpoint", ["id"], STREAM_AS_OF, "versao", "dia")
    return tables.read_months(s, f"{root}/table")


QUERIES = {
    "log_events": (log_events, sql.EVENTS),
    "log_skus": (log_skus, sql.SKUS),
    "log_related_products": (log_related, sql.RELATED),
    "log_areas": (log_areas, sql.AREAS),
    "repaired_dates": (repaired_dates, sql.DATES),
    "date_shapes": (date_shapes, sql.SHAPES),
    "typed_items": (typed_items, sql.TYPED),
    "recently_modified_items": (recent_items, sql.RECENT),
    "last_order_ids": (last_orders, sql.LAST_IDS),
    "backfill_extract": (backfill_extract, sql.BACKFILL),
    "quality_report": (quality_report, sql.QUALITY),
    "refreshes_checked": (refreshes_checked, sql.CHECKED),
    "event_freshness": (event_freshness, sql.FRESHNESS),
    "machine_completeness": (machine_completeness, sql.COMPLETENESS),
    "plant_files_round_trip": (plants_round_trip, sql.PLANT_FILES),
    "keyed_folders_round_trip": (keyed_round_trip, sql.KEYED),
    "csv_round_trip": (csv_round_trip, sql.CSV),
    "months_merged": (months_merged, sql.MONTHS),
    "orders_streamed": (orders_streamed, sql.STREAMED),
    "orders_refreshed": (orders_refreshed, sql.REFRESHED),
    "rows_appended": (rows_appended, sql.APPENDED),
}
