"""Registered table-maintenance queries: deduplication, merges and gold tables.

Where a merge needs a previous table state, the target holds the whole table with some
values altered and the source holds the whole table with a part of its keys shifted, so
every run has updates, inserts and rows that left the source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.functions import clock, codes
from millwright.operators.dedup import latest_per_key
from millwright.plans import gold, silver
from millwright.streaming.incremental import lookback, newer_than_target
from workload import oracle_tables as sql
from workload import roles
from workload.queries_oee import rounded

AS_OF = roles.PERIOD.as_of
OLD = "2024-01-01 00:00:00"


def _audited(df: DataFrame, name: str = "data_atualizacao_db") -> DataFrame:
    return df.withColumn(name, clock.ntz(OLD))


def _shifted(key: Column) -> Column:
    return F.when(key % 10 < 2, key + 1000000000).otherwise(key)


def _stop_state(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    stops = roles.stops(spark, sf_dir)
    target = _audited(stops).withColumns(
        {
            "tempo": F.when(F.col("id") % 7 == 0, F.col("tempo") + 1).otherwise(F.col("tempo")),
            "numero_produto": F.when(F.col("id") % 11 != 0, F.col("numero_produto")),
        }
    )
    return target, stops.withColumn("id", _shifted(F.col("id")))


def merged_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.refreshed(*_stop_state(spark, sf_dir), silver.TABLES["stops"], AS_OF, days=15)


def backfilled_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _stop_state(spark, sf_dir)
    return silver.backfilled(
        target, source, silver.TABLES["stops"], "2024-01-10 05:24:00", "2024-01-12 05:24:00", AS_OF
    )


def _merged_points(kind: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = silver.TABLES[kind]
        rows = latest_per_key(getattr(roles, kind)(spark, sf_dir), spec.keys, spec.dedup_by)
        moved = (F.col("documento") == 1) & (F.col("programa") == 1002)
        source = rows.withColumn("maquina_id", F.col("maquina_id") + F.when(moved, 3000000).otherwise(0))
        target = _audited(rows).withColumn(
            "valor", F.when(F.col("programa") == 1001, F.col("valor") + 1).otherwise(F.col("valor"))
        )
        return silver.refreshed(target, source, spec, AS_OF, days=15)

    return run


def merged_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs, key = roles.runs(spark, sf_dir), F.col("id")
    target = _audited(runs).withColumn("data_fim", F.coalesce("data_fim", clock.ntz(OLD)))
    source = runs.withColumns(
        {
            "id": F.when(F.abs(key) % 10 < 2, key + 1000000000).otherwise(key),
            "data_fim": F.coalesce("data_fim", clock.ntz(AS_OF)),
        }
    )
    return silver.refreshed(target, source, silver.TABLES["runs"], AS_OF, days=15)


def _cycle_state(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    spec = silver.TABLES["cycles"]
    rows = latest_per_key(roles.cycles(spark, sf_dir), spec.keys, "data_hora")
    loaded = (F.col("id_equipamento") % 2 == 0) | (F.col("data_hora") < clock.ntz("2024-01-25 00:00:00"))
    target = _audited(rows.where(loaded)).withColumn(
        "ciclo_atual", F.when(F.col("programa") == 1001, F.col("ciclo_atual") + 1).otherwise(F.col("ciclo_atual"))
    )
    fresh = newer_than_target(rows, target, ["id_estabelecimento", "id_equipamento"], "data_hora")
    left_source = F.col("documento") * 3 + F.col("programa") == 1003
    return target, lookback(fresh, "data_hora", AS_OF, 10).where(~left_source)


def new_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cycle_state(spark, sf_dir)[1]


def merged_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.refreshed_cycles(*_cycle_state(spark, sf_dir), AS_OF)


def merged_machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, key = roles.machines(spark, sf_dir), F.col("id")
    target = _audited(rows.withColumns({"ativo": key % 20 != 0, "data_desativacao": F.when((key % 20).isin(0, 2), clock.ntz(OLD))}))
    return silver.refreshed_dimension(target, rows.withColumn("id", _shifted(key)), silver.TABLES["machines"], AS_OF)


def merged_sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, key = roles.sectors(spark, sf_dir), F.col("id")
    target = _audited(rows.withColumn("ativo", key % 5 != 0))
    return silver.refreshed_dimension(target, rows.withColumn("id", _shifted(key)), silver.TABLES["sectors"], AS_OF)


def _calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.stops(spark, sf_dir).select(
        "id_estabelecimento", "id", "data_hora_inicio", "data_hora_fim", "codigo", "maquina_id", "status", "tempo",
        "cracha_preparador", "cracha_lider",
    )


def reloaded_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = _calls(spark, sf_dir)
    target = _audited(calls.withColumn("tempo", F.col("tempo") + 1))
    stage = calls.where(silver.window_of(silver.TABLES["support_calls"], AS_OF, 10))
    return silver.refreshed_support_calls(target, stage, AS_OF, days=10)


def segmentation_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, key = roles.table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    segment = (F.col("s_nationkey") % 3).cast("string")
    history = supplier.select(
        F.concat(F.lit("E"), key.cast("string")).alias("equipamento"),
        F.explode(F.array(clock.day("2024-01-29"), clock.day("2024-01-30"))).alias("data"),
        F.concat(F.lit("B"), segment).alias("segmentacao"),
        clock.ntz(OLD).alias("updated_at"),
    )
    moved = key + F.when(key % 10 == 0, 1000000000).otherwise(0)
    current = supplier.select(
        F.concat(F.lit("E"), moved.cast("string")).alias("equipamento"), F.concat(F.lit("A"), segment).alias("segmentacao")
    )
    return silver.snapshot(history, current, "2024-01-30", AS_OF)


def latest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(roles.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


def staged_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw stops under their source names, each landed twice, as staged silver rows."""
    spec = silver.TABLES["stops"]
    names = {n: source for source, n in spec.columns.items()}
    twice = roles.stops(spark, sf_dir).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    ends = F.timestamp_add("SECOND", F.col("copy") * 60, F.col("data_hora_fim"))
    raw = twice.withColumns({"data_hora_fim": ends, "status": F.col("status") + F.col("copy")}).drop("copy")
    return silver.staged(raw.withColumnsRenamed(names), spec)


# --- gold --------------------------------------------------------------------------------


def family_groups(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(i).alias("id"), F.lit(n).alias("descricao")) for i, n in codes.FAMILY_GROUP_NAME.items()]
    return spark.range(1).select(F.inline(F.array(*rows)))


def setup_reasons(spark: SparkSession) -> DataFrame:
    kind = F.when(F.col("codigo") == 504, "Troca de Material").when(F.col("codigo") == 302, "Reparo")
    return roles.reasons(spark).select("id_estabelecimento", "codigo", kind.alias("tipo_setup"))


def _place(spark: SparkSession, sf_dir: str):
    return roles.machines(spark, sf_dir), roles.sectors(spark, sf_dir), roles.factories(spark, sf_dir)


def gold_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.gold_stops(
        roles.stops(spark, sf_dir), *_place(spark, sf_dir), roles.reasons(spark), roles.families(spark),
        family_groups(spark), setup_reasons(spark), AS_OF,
    )


def _gold_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.gold_quality(roles.quality(spark, sf_dir), *_place(spark, sf_dir), roles.reasons(spark), AS_OF)


def gold_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gold.gold_performance(roles.performance(spark, sf_dir), *_place(spark, sf_dir), roles.reasons(spark), AS_OF)
    return rounded(rows, "ciclo", "tempo_perda_performance")


def gold_support_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.gold_support_calls(
        _calls(spark, sf_dir), *_place(spark, sf_dir), roles.reasons(spark), roles.families(spark), AS_OF
    )


def merged_gold_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gold_stops(spark, sf_dir)
    target = _audited(rows).withColumn("descricao", F.when(F.col("id_parada") % 7 != 0, F.col("descricao")))
    source = rows.withColumn("id_parada", _shifted(F.col("id_parada")))
    return gold.refreshed_stops(target, source, AS_OF, days=15)


def merged_gold_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _gold_quality(spark, sf_dir)
    moved = (F.col("documento") == 1) & (F.col("programa") == 1002)
    source = rows.withColumn("id_equipamento", F.col("id_equipamento") + F.when(moved, 3000000).otherwise(0))
    target = _audited(rows).withColumn("valor", F.lit(0).cast("bigint"))
    return rounded(gold.refreshed_points(target, source, AS_OF, days=15), "tempo_perda_qualidade")


QUERIES = {
    "latest_line_per_key": (latest_lines, sql.LATEST_LINES),
    "silver_stops_staged": (staged_stops, sql.STAGED_STOPS),
    "silver_stops_merged": (merged_stops, sql.MERGED_STOPS),
    "silver_stops_backfilled": (backfilled_stops, sql.BACKFILLED_STOPS),
    "silver_quality_merged": (_merged_points("quality"), sql.merged_points("quality")),
    "silver_performance_merged": (_merged_points("performance"), sql.merged_points("performance")),
    "silver_runs_merged": (merged_runs, sql.MERGED_RUNS),
    "cycles_with_news": (new_cycles, sql.NEW_CYCLES),
    "silver_cycles_merged": (merged_cycles, sql.MERGED_CYCLES),
    "silver_machines_merged": (merged_machines, sql.MERGED_MACHINES),
    "silver_sectors_merged": (merged_sectors, sql.MERGED_SECTORS),
    "silver_support_calls_reloaded": (reloaded_calls, sql.RELOADED_CALLS),
    "segmentation_snapshot": (segmentation_snapshot, sql.SNAPSHOT),
    "gold_stops": (gold_stops, sql.GOLD_STOPS),
    "gold_quality": (lambda s, d: rounded(_gold_quality(s, d), "tempo_perda_qualidade"), sql.GOLD_QUALITY),
    "gold_performance": (gold_performance, sql.GOLD_PERFORMANCE),
    "gold_support_calls": (gold_support_calls, sql.GOLD_CALLS),
    "gold_machines": (lambda s, d: gold.gold_machines(*_place(s, d)), sql.GOLD_MACHINES),
    "gold_stops_merged": (merged_gold_stops, sql.MERGED_GOLD_STOPS),
    "gold_quality_merged": (merged_gold_quality, sql.MERGED_GOLD_QUALITY),
}
