"""Date repair, typing, JSON and improvement-mart rules."""

import pytest
from pyspark.sql import functions as F

from millwright.functions.dates import DateFields, parsed_timestamp, resolve_dates
from millwright.functions.typing import typed
from millwright.operators import quality
from millwright.operators.nested import flatten
from millwright.plans import improvements as mart
from millwright.sources.lists import landed_items, read_list

CREATED, MODIFIED = "2026-06-03 16:59:40", "2026-06-03 17:05:33"


def one(ts, raw, fields, created=CREATED, modified=MODIFIED):
    df = ts([(raw, created, modified)], "dt string, Created timestamp_ntz, Modified timestamp_ntz")
    got = resolve_dates(df, fields).first().dt
    return None if got is None else str(got)


LOCAL, UTC = DateFields(local=("dt",)), DateFields(utc=("dt",))


@pytest.mark.parametrize(
    ("raw", "fields", "want"),
    [
        ("03/06/2026 17:05:32", LOCAL, "2026-06-03 17:05:32"),
        ("06/03/2026 20:00:34", UTC, "2026-06-03 17:00:34"),
        ("15/06/2026 10:00:00", LOCAL, "2026-06-15 10:00:00"),
        ("06/15/2026 10:00:00", LOCAL, "2026-06-15 10:00:00"),
        ("31/02/2026 10:00:00", LOCAL, None),
        ("2026-06-03 10:00:00", LOCAL, "2026-06-03 10:00:00"),
        (None, LOCAL, None),
        ("", LOCAL, None),
        ("nan", LOCAL, None),
        ("None", LOCAL, None),
    ],
)
def test_event_dates(ts, raw, fields, want):
    assert one(ts, raw, fields) == want


def test_no_anchor_means_day_first(ts):
    assert one(ts, "03/06/2026 16:59:48", LOCAL, None, None) == "2026-06-03 16:59:48"


def test_item_end_to_end(spark):
    row = {"dt_eng": "03/06/2026 17:05:32", "dt_analista": "06/03/2026 20:00:34", "Created": "2026-06-03T19:59:40Z", "Modified": "2026-06-03T20:05:33Z"}
    fields = DateFields(local=("dt_eng",), utc=("dt_analista",), system=("Created", "Modified"))
    got = resolve_dates(spark.createDataFrame([row]), fields).first()
    assert [str(got[c]) for c in ("dt_eng", "dt_analista", "Created", "Modified")] == [
        "2026-06-03 17:05:32", "2026-06-03 17:00:34", CREATED, MODIFIED,
    ]


@pytest.mark.parametrize(("raw", "want"), [("31/12/2025 23:59:59", "2025-12-31 23:59:59"), ("01/01/2026", "2026-01-01 00:00:00")])
def test_manual_dates(ts, raw, want):
    assert one(ts, raw, DateFields(manual=("dt",))) == want


SHAPES = [
    ("2026/06/03", "2026-06-03 00:00:00"),
    ("31-12-2025", "2025-12-31 00:00:00"),
    ("12-31-2025", "2025-12-31 00:00:00"),
    ("31.12.2025 10:00", "2025-12-31 10:00:00"),
    ("3 Jun 2026", "2026-06-03 00:00:00"),
    ("3 junho 2026 7:05", "2026-06-03 07:05:00"),
    ("3-fev-2024", "2024-02-03 00:00:00"),
    ("Jun 3, 2026 1:02:03", "2026-06-03 01:02:03"),
    ("2026-6-3", "2026-06-03 00:00:00"),
    ("03/06/26", "2026-06-03 00:00:00"),
    ("12/13/99", "1999-12-13 00:00:00"),
    ("20260603", "2026-06-03 00:00:00"),
    (" 2026-06-03T10:11:12.345Z ", "2026-06-03 10:11:12.345000"),
    ("2026-06-03 10:00:00.123456789", "2026-06-03 10:00:00.123456"),
    ("2026-06-03T10:11:12-03:00", "2026-06-03 13:11:12"),
    ("2026-06-03 10:00:00 +0530", "2026-06-03 04:30:00"),
    ("2026-06-03 10:00:00 UTC", "2026-06-03 10:00:00"),
    ("06/15/2026 10:00:00 PM", "2026-06-15 22:00:00"),
    ("03/06/2026 12:00 am", "2026-06-03 00:00:00"),
    ("29/02/2024", "2024-02-29 00:00:00"),
    *((bad, None) for bad in (
        "29/02/2023", "31/02/2026", "00/00/2020", "2026-06-03 25:00", "03/06/2026 13:00 pm", "03/06/2026 10:00 xx", "3 de junho", "dezembro", "x", "/", "//",
        "99999999999/1/2026", "1/2", "2026-06-03 10", "2026-06-03abcz", "03/06/026", "03/06/2026/1", "3 foo 2026", "12345678901", "٣/٦/2026",
    )),
]


def test_shapes(spark):
    df = spark.createDataFrame([(raw, raw) for raw, _ in SHAPES], "raw string, dt string")
    got = resolve_dates(df.withColumn("typed", parsed_timestamp(F.col("dt"))), DateFields(manual=("dt",))).collect()
    shown = [(r.raw, *(None if x is None else str(x) for x in (r.dt, r.typed))) for r in got]
    assert shown == [(raw, want, want) for raw, want in SHAPES]


def test_shapes_of_events(ts):
    assert one(ts, "06-03-2026 20:00:34", UTC) == "2026-06-03 17:00:34"
    assert one(ts, "06.03.2026 17:00", LOCAL) == "2026-06-03 17:00:00"
    assert one(ts, "2026/06/03 20:00", UTC) == "2026-06-03 20:00:00"


def test_system_fields_in_any_shape(ts):
    fields = DateFields(system=("dt",))
    assert one(ts, "2026-06-03T19:59:40.5Z", fields) == "2026-06-03 16:59:40.500000"
    assert one(ts, "2026-06-03T16:59:40-03:00", fields) == "2026-06-03 16:59:40"
    assert one(ts, "03 Jun 2026 19:59:40", fields) == "2026-06-03 16:59:40"


def test_typing(spark):
    rows = [("7", "1.5", "TRUE", "03/06/2026"), ("x", "nan", "0", "nope"), ("None", "2,5", "", None)]
    out = typed(spark.createDataFrame(rows, "a string, b string, c string, d string"), {"a": "int", "b": "double", "c": "boolean", "d": "date", "e": "int"})
    assert [tuple(map(str, r)) for r in out.collect()] == [
        ("7", "1.5", "True", "2026-06-03"), ("None", "None", "False", "None"), ("None", "None", "None", "None"),
    ]
    with pytest.raises(ValueError):
        typed(out, {"zzz": "int"})
    with pytest.raises(ValueError):
        typed(out.withColumnRenamed("a", "a b"), {"a b": "int"})


def test_landed_list(spark, tmp_path):
    path = tmp_path / "items.json"
    path.write_text('{"id": "1", "person": {"name": "Zé"}, "__etag": "x"}\n{"id": "2", "person": null}\n')
    items = landed_items(spark.read.json(str(path)), ["id", "absent"])
    assert items.columns == ["id", "person", "absent"]
    assert {r.person for r in items.collect()} == {'{"name":"Zé"}', None}
    assert [r.id for r in read_list(spark, str(path), {"id": "int"}).orderBy("id").collect()] == [1, 2]


def test_flatten(spark):
    df = spark.range(1).select(F.struct(F.lit(1).alias("x"), F.struct(F.lit(2).alias("z")).alias("y")).alias("a"), F.lit(3).alias("b"))
    assert flatten(df).columns == ["a_x", "a_y_z", "b"]


def component(spark, **over):
    base = dict(
        numero_fap="1", id_solicitacao_assinatura=1, tipo_melhoria="Tempo Ciclo", filial="F", setor="S", macro_setor="M", cracha_idealizador=1,
        nome_idealizador="n", gerente_idealizador="g", tc_anterior=10.0, tc_atual=8.0, consumo_anterior=0.0, consumo_atual=0.0,
        custo_par_anterior=0.0, custo_par_atual=0.0, preco_mp=0.0, mix=50.0, volume_mes_1=600.0, volume_mes_2=0.0, volume_mes_3=0.0,
        volume_mes_4=0.0, ganho_previsto=300.0, replicacao="Não", dt_fap="2024-01-31",
    ) | over
    df = spark.createDataFrame([base])
    return df.withColumns({"dt_fap": F.col("dt_fap").cast("date"), "created": F.lit(None), "modified": F.lit(None)})


def long(spark, hours=200.0, cost=4000.0, **over):
    h = spark.createDataFrame([("2024-01-01", "s ", hours)], "mes string, setor string, ch_mensal double").where("ch_mensal IS NOT NULL")
    c = spark.createDataFrame([("2024-01-15", "f", cost)], "dt_competencia string, estabelecimento string, custo double").where("custo IS NOT NULL")
    h, c = h.withColumn("mes", F.col("mes").cast("date")), c.withColumn("dt_competencia", F.col("dt_competencia").cast("date"))
    rows = mart.gains_long(mart.gains_wide(mart.staged_gains(component(spark, **over))), h, c)
    return rows.orderBy("mes_offset").collect()


def test_cycle_time_money(spark):
    first = long(spark)[0]
    assert (first.hrs_ganhas, first.ganho_reais) == (10.0, 200.0)
    assert long(spark, hours=None)[0].ganho_reais == 0.0
    assert long(spark, cost=None)[0].ganho_reais is None


def test_consumption_and_swap(spark):
    values = dict(tipo_melhoria="consumo", consumo_anterior=0.5, consumo_atual=0.4, mix=100.0, preco_mp=10.0, volume_mes_1=100.0)
    assert long(spark, **values)[0].ganho_reais == pytest.approx(100.0)
    swap = values | dict(setor="Tingimento", custo_par_anterior=5.0, custo_par_atual=4.0)
    assert long(spark, **swap)[0].ganho_reais == pytest.approx(100.0)


def test_forecast_only_in_month_one_and_month_ends(spark):
    rows = long(spark, tipo_melhoria="Qualidade")
    assert [r.ganho_reais for r in rows] == [300.0, 0.0, 0.0, 0.0]
    assert [str(r.dt_competencia) for r in rows] == ["2024-01-31", "2024-02-29", "2024-03-31", "2024-04-30"]


def test_remap_is_effective_dated(spark):
    roster = spark.createDataFrame([("Beatriz", "2025-03-01"), ("Beatriz", "2025-05-01")], "gerente_meta string, inicio_bimestre string")
    roster = roster.withColumn("inicio_bimestre", F.col("inicio_bimestre").cast("date"))
    areas = spark.createDataFrame([], "gerente string, area string")
    got = {str(r.inicio_bimestre): r.gerente_ajustado for r in mart.manager_remap(roster, mart.manager_rules(spark), areas).collect()}
    assert got == {"2025-03-01": "Valsenir F6", "2025-05-01": "Beatriz"}


def test_quality_levels(spark, ts):
    df = ts([("2024-01-01 00:00:00",)], "t timestamp_ntz")
    got = [quality.freshness(df, "t", d).first().situacao for d in ("2024-01-02", "2024-01-05", "2024-01-20")]
    assert got == ["pass", "warn", "error"]
