"""Shop-floor roles over the driver tables (same expressions as in ``oracle_roles``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.plans.context import Period, ShopFloor

PLANT_CODES = (20, 21, 40)
PERIOD = Period(
    start="2024-01-01 00:00:00",
    end="2024-01-31 00:00:00",
    as_of="2024-01-31 00:00:00",
    excluded_sectors=(3, 7),
    excluded_factories=(4,),
    excluded_sectors_detail=(3, 7),
)

# event_type, code, description, weight, family id
REASONS = (
    ("error", 100, "Setup de Cor", "Com Peso", 86),
    ("click", 107, "Aguardando Manutenção", "Com Peso", 65),
    ("purchase", 302, "Reparo matriz", "Com Peso", 66),
    ("view", 403, "Parada programada", "Sem Peso", 67),
    ("signup", 504, "Falta de material", "Com Peso", 67),
)
# family id, description, group id
FAMILIES = (
    (65, "Manutenção mecânica", 2),
    (66, "Matrizaria geral", 3),
    (67, "Produção geral", 1),
    (86, "Setup geral", 5),
)
# name, shift boundaries
SCHEDULES = (
    ("H0", "05:24:00", "14:00:00", "14:00:00", "22:10:00", "22:10:00", "05:24:00"),
    ("H1", "06:00:00", "14:20:00", "14:20:00", "22:35:00", "22:35:00", "06:00:00"),
    ("H2", "05:24:00", "15:40:00", "15:40:00", "00:57:01", "00:57:01", "05:24:00"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plant_of(key: Column) -> Column:
    return F.when(key % 3 == 0, 20).when(key % 3 == 1, 21).otherwise(40)


def _per_plant(df: DataFrame) -> DataFrame:
    return df.withColumn("id_estabelecimento", F.explode(F.array(*[F.lit(p) for p in PLANT_CODES])))


def _literal_rows(spark: SparkSession, rows, names) -> DataFrame:
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def later(ts: Column, minutes: Column) -> Column:
    return F.timestamp_add("MILLISECOND", F.round(minutes * 60000).cast("bigint"), ts)


def machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        plant_of(F.col("c_custkey")).alias("id_estabelecimento"),
        F.col("c_custkey").alias("id"),
        F.col("c_nationkey").alias("id_setor"),
        F.col("c_name").alias("nome"),
        F.col("c_mktsegment").alias("descricao"),
    )


def sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_plant(
        table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("id"),
            F.col("n_name").alias("descricao"),
            F.col("n_regionkey").alias("id_fabrica"),
        )
    )


def factories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_plant(
        table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("descricao"))
    )


def sector_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    name = F.when(n == 24, "nenhum").otherwise(F.concat(F.lit("H"), (n % 3).cast("string")))
    return _per_plant(table(spark, sf_dir, "nation").select(F.col("n_name").alias("setor"), name.alias("horario")))


def schedules(spark: SparkSession) -> DataFrame:
    names = ("nome", "ini_1_t1", "fim_1_t1", "ini_1_t2", "fim_1_t2", "ini_1_t3", "fim_1_t3")
    return _per_plant(_literal_rows(spark, SCHEDULES, names))


def reasons(spark: SparkSession) -> DataFrame:
    names = ("event_type", "codigo", "descricao", "peso_oee", "id_familia")
    return _per_plant(_literal_rows(spark, REASONS, names)).drop("event_type")


def families(spark: SparkSession) -> DataFrame:
    return _per_plant(_literal_rows(spark, FAMILIES, ("id", "descricao", "id_familia_agrupada")))


def code_of(event_type: Column) -> Column:
    out = F.lit(None).cast("int")
    for kind, code, *_ in REASONS:
        out = F.when(event_type == kind, code).otherwise(out)
    return out


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    return table(spark, sf_dir, "events").select(
        plant_of(u).alias("id_estabelecimento"),
        e.alias("id"),
        u.alias("maquina_id"),
        code_of(F.col("event_type")).alias("codigo"),
        F.col("ts").alias("data_hora"),
        "value",
        F.get_json_object("props", "$.k").alias("numero_produto"),
        F.concat(F.lit("Turno "), (e % 3 + 1).cast("string")).alias("turno"),
        (e % 3 + 1000).alias("programa"),
        (e % 2).alias("documento"),
    )


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("id")
    return _events(spark, sf_dir).select(
        "id_estabelecimento",
        "id",
        "maquina_id",
        "codigo",
        F.col("data_hora").alias("data_hora_inicio"),
        F.when(e % 97 != 0, later(F.col("data_hora"), F.col("value"))).alias("data_hora_fim"),
        F.when(e % 5 == 1, 1).otherwise(F.round("value").cast("int")).alias("tempo"),
        "turno",
        (e % 5).cast("int").alias("status"),
        "programa",
        "documento",
        "numero_produto",
        F.when(e % 2 == 1, F.floor(e / 10)).alias("id_grupo"),
        F.concat(F.lit("F"), (e % 7).cast("string")).alias("ferramental"),
        F.concat(F.lit("R"), (e % 4).cast("string")).alias("ref_matriz"),
        F.when(e % 3 == 0, e % 11).alias("cracha_apoio"),
        (e % 13).alias("cracha_preparador"),
        (e % 17).alias("cracha_lider"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fiftieth run is repeated 100 ms later and left open."""
    e = F.col("id")
    copies = _events(spark, sf_dir).withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.when(e % 50 == 0, 1).otherwise(0)))
    )
    is_copy = F.col("copy") == 1
    closed = ~is_copy & (e % 89 != 0)
    return copies.select(
        "id_estabelecimento",
        F.when(is_copy, -e - 1).otherwise(e).alias("id"),
        F.col("maquina_id").alias("id_equipamento"),
        "numero_produto",
        "programa",
        "documento",
        F.timestamp_add("MILLISECOND", F.col("copy") * 100, F.col("data_hora")).alias("data_inicio"),
        F.when(closed, later(F.col("data_hora"), F.col("value") * 2.5)).alias("data_fim"),
        (F.col("value") / 10).alias("ciclo"),
        (e % 4 + 1).alias("pares_batidas"),
    )


def cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("id")
    return _events(spark, sf_dir).select(
        "id_estabelecimento",
        F.col("maquina_id").alias("id_equipamento"),
        "data_hora",
        F.col("value").alias("ciclo_atual"),
        F.lit(245.0).alias("ciclo_ti"),
        F.when(e % 53 != 0, F.round(F.col("value") - 245, 2)).alias("diferenca"),
        "turno",
        "programa",
        "documento",
        "numero_produto",
    )


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("id")
    return _events(spark, sf_dir).select(
        "id_estabelecimento",
        "data_hora",
        "codigo",
        (e % 3 + 1).alias("valor"),
        "maquina_id",
        F.col("value").alias("ciclo"),
        (e % 4 + 1).alias("pares_batida"),
        "turno",
        "programa",
        "documento",
        "numero_produto",
        (F.col("maquina_id") + F.when(e % 2 == 0, 3).otherwise(3000000)).alias("maquina_id_origem"),
    )


def performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("id")
    return _events(spark, sf_dir).select(
        "id_estabelecimento",
        "data_hora",
        "codigo",
        (e % 5).alias("valor"),
        "maquina_id",
        (F.col("value") / 10).alias("ciclo"),
        "turno",
        "programa",
        "documento",
        "numero_produto",
        (e % 13).alias("cracha_preparador"),
        (e % 17).alias("cracha_lider"),
    )


def shop_floor(spark: SparkSession, sf_dir: str) -> ShopFloor:
    return ShopFloor(
        machines=machines(spark, sf_dir),
        sectors=sectors(spark, sf_dir),
        factories=factories(spark, sf_dir),
        reasons=reasons(spark),
        sector_parameters=sector_parameters(spark, sf_dir),
        schedules=schedules(spark),
        stops=stops(spark, sf_dir),
        runs=runs(spark, sf_dir),
        cycles=cycles(spark, sf_dir),
        quality=quality(spark, sf_dir),
        performance=performance(spark, sf_dir),
    )
