"""Registered improvement-mart queries and the roles they read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.functions.values import label
from millwright.operators.merge import append_history
from millwright.plans import calendar, silver
from millwright.plans import improvements as mart
from workload import oracle_improvements as sql
from workload.queries_oee import rounded
from workload.roles import table

SECTORS = ("Tingimento", "Injeção", "Montagem", "corte ")
TYPES = {
    "1-URGENT": "tempo ciclo ",
    "2-HIGH": "Aglutinação",
    "3-MEDIUM": "Consumo",
    "4-NOT SPECIFIED": "Troca de Matéria Prima",
    "5-LOW": "Qualidade",
}


def gains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One component per order line."""
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    rows = table(spark, sf_dir, "lineitem").join(orders, "l_orderkey")
    key, part, line, q = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber"), F.col("l_quantity")
    code = part.cast("string")
    return rows.select(
        (key * 10 + line).alias("id"),
        key.alias("id_solicitacao_assinatura"),
        key.cast("string").alias("numero_fap"),
        label(F.col("o_orderpriority"), TYPES).alias("tipo_melhoria"),
        F.concat(F.lit("F"), label(F.col("l_suppkey") % 3, {0: "20", 1: "21", 2: "40"})).alias("filial"),
        label(part % 4, dict(enumerate(SECTORS))).alias("setor"),
        F.concat(F.lit("M"), (part % 4).cast("string")).alias("macro_setor"),
        F.when(part % 3 == 0, F.lpad(code, 5, "0")).when(part % 3 == 1, F.lpad(code, 7, "0")).otherwise(F.lpad(code, 6, "0")).alias("cod_prod"),
        F.col("o_custkey").alias("cracha_idealizador"),
        F.concat(F.lit("Nome "), (F.col("o_custkey") % 1000).cast("string")).alias("nome_idealizador"),
        F.concat(F.lit("G"), (F.col("o_custkey") % 7).cast("string")).alias("gerente_idealizador"),
        (F.floor(F.col("l_extendedprice") / 10) / 100).alias("preco_mp"),
        F.col("l_discount").alias("consumo_anterior"),
        F.col("l_tax").alias("consumo_atual"),
        q.alias("tc_anterior"),
        (q * (1 - F.col("l_tax"))).alias("tc_atual"),
        (F.col("l_discount") * 10).alias("custo_par_anterior"),
        (F.col("l_tax") * 10).alias("custo_par_atual"),
        (line * 5 + 50).cast("double").alias("mix"),
        *[(q * 100 * n).alias(f"volume_mes_{n}") for n in (1, 2, 3)],
        F.when(line != 7, q * 400).alias("volume_mes_4"),
        F.when(line != 3, F.col("l_extendedprice") / 10).alias("ganho_previsto"),
        F.when(key % 4 == 0, "Sim").when(key % 4 == 1, "NÃO").otherwise("Não").alias("replicacao"),
        F.when(part % 37 != 0, F.col("l_shipdate")).alias("dt_fap"),
        F.when(line == 1, "Sim").otherwise("Não").alias("mes_anterior"),
        F.col("o_orderdate").alias("created"),
        F.col("l_shipdate").alias("modified"),
    )


def _months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.trunc("o_orderdate", "month").alias("mes")).distinct()


def _listed(values):
    return F.posexplode(F.array(*[F.lit(v) for v in values]))


def hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _months(spark, sf_dir).select("mes", _listed(("TINGIMENTO", "INJEÇÃO ", "Montagem", "Corte")).alias("i", "setor"))
    month = F.month("mes")
    ch = F.when((month == 7) & (F.col("i") == 2), 0).otherwise(month * 10 + F.col("i") * 5 + 1000)
    return rows.where(~((month == 8) & (F.col("i") == 3))).select("mes", "setor", ch.cast("decimal(18,6)").alias("ch_mensal"))


def costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _months(spark, sf_dir).select("mes", _listed(("f20", "F21", "F40 ")).alias("i", "estabelecimento"))
    cost = F.year("mes") % 100 * 10 + F.col("i") * 7 + 3000
    return rows.where(~((F.month("mes") == 9) & (F.col("i") == 2))).select(
        F.date_format("mes", "MM/yyyy").alias("mes_ano"),
        F.col("mes").alias("data"),
        cost.cast("decimal(18,2)").alias("custo"),
        "estabelecimento",
    )


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer in every bimester of 1995 to 2001."""
    key = F.col("c_custkey")
    people = table(spark, sf_dir, "customer").withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(41))))
    start = F.make_date(F.floor(F.col("i") / 6).cast("int") + 1995, F.col("i") % 6 * 2 + 1, F.lit(1))
    managers = {0: "Beatriz", 1: "liberio", 2: "Sul", 3: "Rossi", 4: "Odair"}
    return people.select(
        F.format_string("%d_Bimestre_%d", F.year(start), F.col("i") % 6 + 1).alias("bimestre"),
        start.alias("inicio_bimestre"),
        F.date_sub(F.add_months(start, 2), 1).alias("fim_bimestre"),
        F.when(key % 11 != 0, F.when(key % 5 == 0, "Não Elegível").otherwise("Operador")).alias("grupo_cargo"),
        F.coalesce(label(key % 6, managers), F.col("c_mktsegment")).alias("gerente_meta"),
        F.when(key % 7 == 0, "Afastado").otherwise("Considera").alias("categoria_situacao"),
        key.alias("codigo"),
        F.col("c_name").alias("nome"),
        F.col("c_mktsegment").alias("setor"),
        F.when(key % 9 == 0, 2048001).otherwise(3000000 + key % 10).cast("bigint").alias("c_custo"),
        F.concat(F.lit("C"), (key % 3).cast("string")).alias("cargo"),
    )


def approvals(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        key.alias("id"),
        key.cast("string").alias("numero_fap"),
        label(F.col("o_orderpriority"), TYPES).alias("tipo_melhoria"),
        label(F.col("o_orderstatus"), {"F": "Aprovado", "O": "Em andamento", "P": "Reprovado"}).alias("status"),
        label(key % 4, dict(enumerate(SECTORS))).alias("setor"),
        F.col("o_custkey").alias("cracha_idealizador"),
        F.concat(F.lit("Nome "), (F.col("o_custkey") % 1000).cast("string")).alias("nome_idealizador"),
        F.concat(F.lit("G"), (F.col("o_custkey") % 7).cast("string")).alias("gerente_idealizador"),
        F.timestamp_add("HOUR", F.lit(34), day).alias("dt_aprovacao_eng"),
        F.timestamp_add("HOUR", F.lit(1), day).alias("dt_inicio_fluxo"),
        F.when(key % 3 == 0, F.timestamp_add("DAY", F.lit(2), day)).alias("dt_fap"),
        day.alias("created"),
        F.timestamp_add("DAY", F.lit(3), day).alias("modified"),
    )


def _staged(s: SparkSession, d: str) -> DataFrame:
    return mart.staged_gains(gains(s, d))


def _hours_costs(s: SparkSession, d: str):
    return mart.staged_hours(hours(s, d)), mart.staged_costs(costs(s, d))


def _long(s: SparkSession, d: str) -> DataFrame:
    return mart.gains_long(mart.gains_wide(_staged(s, d)), *_hours_costs(s, d))


def _roster(s: SparkSession, d: str) -> DataFrame:
    return mart.staged_roster(roster(s, d))


def staged_approvals(s: SparkSession, d: str) -> DataFrame:
    return mart.staged_approvals(approvals(s, d)).withColumn("ganho_previsto", F.col("ganho_previsto").cast("double"))


def staged_gains(s: SparkSession, d: str) -> DataFrame:
    return rounded(_staged(s, d), "preco_mp", "tc_atual", "custo_par_anterior", "custo_par_atual", "ganho_previsto")


def gains_wide(s: SparkSession, d: str) -> DataFrame:
    out = mart.gains_wide(_staged(s, d))
    return rounded(out, "ganho_previsto", *[f"{m}_{n}" for n in mart.MONTHS for m in ("hrs_ganhas", "g_consumo", "troca_mp")])


def gains_long(s: SparkSession, d: str) -> DataFrame:
    return rounded(_long(s, d), "hrs_ganhas", "ganho_reais")


def gains_fact(s: SparkSession, d: str) -> DataFrame:
    return rounded(mart.gains_fact(_long(s, d)), "hrs_ganhas", "ganho_reais")


def realised(s: SparkSession, d: str) -> DataFrame:
    return rounded(mart.realised(_long(s, d)), "ganho_total")


def adherence(s: SparkSession, d: str) -> DataFrame:
    return rounded(mart.adherence(_roster(s, d), mart.realised(_long(s, d))), "ganho_total")


RULES = (("BEATRIZ", "Valsenir F6", "1998-05-01"), ("Liberio", "Andre - F3", None), ("Odair", "Ademir - F5", "1996-01-01"))
AREAS = (("Andre - F3", "Fábrica 3"), ("beatriz", "Fábrica 6"))


def _rules(s: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(o).alias("origem"), F.lit(t).alias("destino"), F.lit(v).cast("date").alias("valido_ate")) for o, t, v in RULES]
    return s.range(1).select(F.inline(F.array(*rows)))


def _areas(s: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(g).alias("gerente"), F.lit(a).alias("area")) for g, a in AREAS]
    return s.range(1).select(F.inline(F.array(*rows)))


def manager_remap(s: SparkSession, d: str) -> DataFrame:
    return mart.manager_remap(_roster(s, d), _rules(s), _areas(s))


def _measures(s: SparkSession, d: str) -> DataFrame:
    rows = gains(s, d).withColumn("dt_fap", F.col("dt_fap").cast("date"))
    return mart.gain_measures(mart.measure_base(rows, *_hours_costs(s, d)))


MEASURES = (
    [f"ganho_{m}_{n}" for n in mart.MONTHS for m in ("pessoa", "em_reais", "consumo")]
    + ["ganho_pessoas_quadrimestre", "ganho_em_reais_quadrimestre", "volume_quadrimestre"]
)


def gain_measures(s: SparkSession, d: str) -> DataFrame:
    out = _measures(s, d).select("id", "numero_fap", "dt_fap", "codigo_produto", "codigo_componente", "dt_fim_melhoria", *MEASURES)
    return rounded(out, *MEASURES)


def previous_month_gains(s: SparkSession, d: str) -> DataFrame:
    return rounded(mart.previous_month_gains(_measures(s, d)), "ganho_mes_anterior", "ganho_pessoas_mes_anterior")


def total_gain(s: SparkSession, d: str) -> DataFrame:
    rows = _measures(s, d).withColumn("ganho_mes_outras", F.when(F.col("tipo_melhoria") == "Qualidade", F.col("ganho_previsto")))
    money = F.coalesce("ganho_em_reais_1", F.lit(0.0)) + F.coalesce("ganho_consumo_1", F.lit(0.0)) - F.lit(20.0)
    rows = rows.withColumn("ganho_mes_anterior", F.when(F.col("mes_anterior") == "Sim", money))
    result = rows.groupBy("numero_fap").agg(
        mart.result_flag(F.sum(money)).alias("resultado"),
        F.when(F.count("ganho_mes_anterior") > 0, mart.result_flag(F.sum("ganho_mes_anterior"))).alias("resultado_mes_anterior"),
    )
    status = approvals(s, d).select("numero_fap", "status")
    out = mart.total_gain(rows.join(result, "numero_fap").join(status, "numero_fap", "left"), ["filial", "tipo_melhoria"])
    return out.withColumn("ganho_total", F.round("ganho_total", 4))


def _items(s: SparkSession, d: str) -> DataFrame:
    done = F.when(F.col("status") == "Aprovado", 1).otherwise(0)
    return mart.staged_approvals(approvals(s, d)).select(
        "id", F.col("id").alias("id_solicitacao_assinatura"), "bimestre", "cracha_idealizador",
        done.alias("qtde_melhorias"), done.alias("qtde_pessoas"),
    )


def request_rollup(s: SparkSession, d: str) -> DataFrame:
    lines = gains(s, d).select("id", "id_solicitacao_assinatura", F.when(F.col("replicacao") == "Sim", 0).otherwise(1).alias("qtde_melhorias"))
    return mart.request_rollup(lines)


def eligible_realised(s: SparkSession, d: str) -> DataFrame:
    joined = mart.roster_with_realised(_roster(s, d), _items(s, d))
    return mart.eligible_realised(joined, ["bimestre"])


def roster_realised(s: SparkSession, d: str) -> DataFrame:
    joined = mart.roster_with_realised(_roster(s, d), _items(s, d))
    return joined.select("bimestre", "codigo", "gerente_meta", "realizado_meta", "qtde_melhorias_meta")


def item_status(s: SparkSession, d: str) -> DataFrame:
    rows = approvals(s, d)
    needs = F.when(F.col("id") % 2 == 0, "Sim").otherwise("Não")
    raw = F.when(F.col("status") == "Reprovado", "0").otherwise(F.col("status"))
    return rows.select("id", mart.effective_status(raw, F.col("dt_fap"), needs).alias("status"))


def roster_cost_centres(s: SparkSession, d: str) -> DataFrame:
    return roster(s, d).groupBy(mart.engineering_cost_centre(F.col("c_custo")).alias("cc_eng")).agg(F.count("codigo").alias("pessoas"))


def calendar_dimension(s: SparkSession, d: str) -> DataFrame:
    """The calendar reaches one year past the newest event."""
    newest = table(s, d, "events").agg(F.max("ts").alias("ts"))
    days = newest.select(F.explode(F.sequence(F.lit("2020-01-01").cast("date"), F.add_months(F.col("ts").cast("date"), 12))).alias("date_day"))
    return calendar.calendar_dimension(days)


def calendar_labels(s: SparkSession, d: str) -> DataFrame:
    return calendar.calendar_labels(calendar.spanned_days(table(s, d, "orders"), "o_orderdate", "1996-01-01"))


def bimester_table(s: SparkSession, d: str) -> DataFrame:
    return calendar.bimester_table(table(s, d, "orders").select(F.year("o_orderdate").alias("ano")).distinct())


def type_dimension(s: SparkSession, d: str) -> DataFrame:
    """Types in use with their category and number of items."""
    used = approvals(s, d).groupBy(F.trim(F.lower("tipo_melhoria")).alias("k")).agg(F.count("id").alias("itens"))
    dim = mart.type_dimension(s)
    return dim.join(used, F.lower("tipo_melhoria") == F.col("k"), "left").select("tipo_melhoria", "categoria", "itens")


def synced_approvals(s: SparkSession, d: str) -> DataFrame:
    rows, key = approvals(s, d), F.col("id")
    target = rows.withColumns(
        {"status": F.when(key % 7 == 0, "antigo").otherwise(F.col("status")), "modified": F.when(key % 14 != 0, F.when(key % 7 == 0, F.col("created")).otherwise(F.col("modified")))}
    )
    source = rows.withColumn("id", F.when(key % 10 < 2, key + 1000000000).otherwise(key))
    return silver.listed_sync(target, source, "2001-08-01 12:00:00", days=900)


def dated_gains(s: SparkSession, d: str) -> DataFrame:
    out = silver.gains_with_master_date(gains(s, d), approvals(s, d))
    return out.select("id", "id_solicitacao_assinatura", "cod_prod", "dt_fap")


def dated_approvals(s: SparkSession, d: str) -> DataFrame:
    return silver.with_master_date(approvals(s, d)).select("id", "status", "dt_fap")


def approvals_with_history(s: SparkSession, d: str) -> DataFrame:
    rows = mart.staged_approvals(approvals(s, d)).select("id", "bimestre", "status")
    current = rows.withColumn("status", F.upper("status"))
    is_current = F.col("bimestre") == "jan-fev/1998"
    return append_history(current.where(is_current), rows, is_current)


QUERIES = {
    "staged_approvals": (staged_approvals, sql.STAGED_APPROVALS),
    "staged_gains": (staged_gains, sql.STAGED_GAINS),
    "staged_roster": (_roster, sql.STAGED_ROSTER),
    "staged_hours": (lambda s, d: mart.staged_hours(hours(s, d)).withColumn("ch_mensal", F.col("ch_mensal").cast("double")), sql.STAGED_HOURS),
    "staged_costs": (lambda s, d: mart.staged_costs(costs(s, d)).withColumn("custo", F.col("custo").cast("double")), sql.STAGED_COSTS),
    "gains_wide": (gains_wide, sql.GAINS_WIDE),
    "gains_long": (gains_long, sql.GAINS_LONG),
    "gains_fact": (gains_fact, sql.GAINS_FACT),
    "improvements_realised": (realised, sql.REALISED),
    "adherence_fact": (adherence, sql.ADHERENCE),
    "target_fact": (lambda s, d: mart.target_fact(_roster(s, d)), sql.TARGET_FACT),
    "proposer_dimension": (lambda s, d: mart.proposer_dimension(_roster(s, d)), sql.PROPOSERS),
    "improvements_in_progress": (lambda s, d: mart.in_progress(mart.staged_approvals(approvals(s, d))), sql.IN_PROGRESS),
    "manager_remap": (manager_remap, sql.MANAGER_REMAP),
    "manager_dimension": (lambda s, d: mart.manager_dimension(manager_remap(s, d)), sql.MANAGERS),
    "type_dimension": (type_dimension, sql.TYPES_IN_USE),
    "calendar_dimension": (calendar_dimension, sql.CALENDAR),
    "calendar_labels": (calendar_labels, sql.CALENDAR_LABELS),
    "bimester_table": (bimester_table, sql.BIMESTERS),
    "gain_measures": (gain_measures, sql.GAIN_MEASURES),
    "previous_month_gains": (previous_month_gains, sql.PREVIOUS_MONTH),
    "total_gain": (total_gain, sql.TOTAL_GAIN),
    "request_rollup": (request_rollup, sql.REQUEST_ROLLUP),
    "roster_realised": (roster_realised, sql.ROSTER_REALISED),
    "eligible_realised": (eligible_realised, sql.ELIGIBLE_REALISED),
    "item_status": (item_status, sql.ITEM_STATUS),
    "roster_cost_centres": (roster_cost_centres, sql.COST_CENTRES),
    "approvals_synced": (synced_approvals, sql.SYNCED_APPROVALS),
    "approvals_with_master_date": (dated_approvals, sql.DATED_APPROVALS),
    "gains_with_master_date": (dated_gains, sql.DATED_GAINS),
    "approvals_with_history": (approvals_with_history, sql.WITH_HISTORY),
}
