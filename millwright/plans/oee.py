"""OEE per product and day, and its detail reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.functions import clock, codes
from millwright.functions.values import (
    gain,
    in_list,
    label,
    loss,
    not_in,
    ratio,
    round2,
    short_md5,
    text_key,
    zero,
    zero_safe_ratio,
)
from millwright.operators.dedup import first_per_key, without_repeated_open_runs
from millwright.operators.intervals import covered_seconds, overlaps_period
from millwright.operators.joins import join_dimension, join_sparse
from millwright.operators.shifts import cut_at_shifts
from millwright.plans.context import Period, ShopFloor, machine_context, on_machine, reasons_of

PLANT = "id_estabelecimento"
SHIFT = [PLANT, "maquina_id", "data_turno", "num_turno"]
COMPONENTS = ("tempo_disp", "tempo_setup", "tempo_qual", "tempo_perf_perdas", "saldo_tc")


def _in_period(day: Column, period: Period) -> Column:
    return day.between(clock.day(period.start), clock.day(period.end))


def _near_period(ts: Column, period: Period) -> Column:
    """Pushed-down bound: a production day ends before noon of the following one at the latest."""
    start = clock.day(period.start).cast("timestamp_ntz")
    end = F.date_add(clock.day(period.end), 2).cast("timestamp_ntz")
    return (ts >= start) & (ts < end)


def _event_day(
    floor: ShopFloor, fact: DataFrame, context: DataFrame, period: Period, *columns: str
) -> DataFrame:
    """Point events on included machines with their production day, inside the period."""
    near = fact.where(_near_period(F.col("data_hora"), period))
    return (
        on_machine(floor, near, context, "inicio_dia", *columns)
        .withColumn("data", clock.production_day(F.col("data_hora"), F.col("inicio_dia")))
        .where(_in_period(F.col("data"), period))
    )


# --- useful time -------------------------------------------------------------------------


def valid_runs(floor: ShopFloor, period: Period) -> DataFrame:
    """Product runs that touch the period; open ones last until ``as_of``."""
    runs = floor.runs.select(
        PLANT,
        F.col("id_equipamento").alias("maquina_id"),
        F.col("numero_produto").alias("cod_produto"),
        "data_inicio",
        "data_fim",
    )
    runs = without_repeated_open_runs(
        runs, [PLANT, "maquina_id", "cod_produto"], "data_inicio", "data_fim"
    )
    end = F.coalesce("data_fim", clock.ntz(period.as_of))
    return runs.withColumn("data_fim", end).where(
        overlaps_period(F.col("data_inicio"), F.col("data_fim"), period.start, period.end)
    )


def period_stops(floor: ShopFloor, period: Period, weight: str, *columns: str) -> DataFrame:
    """Closed stops with the given reason weight that touch the period."""
    return floor.stops.where(
        overlaps_period(F.col("data_hora_inicio"), F.col("data_hora_fim"), period.start, period.end)
    ).transform(_with_reason, floor, weight, "inner", *columns)


def _with_reason(fact: DataFrame, floor: ShopFloor, weight: str | None, how: str, *columns: str) -> DataFrame:
    reasons = reasons_of(floor, weight).select(PLANT, "codigo", *columns)
    return join_dimension(fact, reasons, [PLANT, "codigo"], how, bounded_by=floor.reasons)


def useful_time_by_shift(floor: ShopFloor, period: Period, rule: str) -> DataFrame:
    """Calendar and unweighted-stop seconds per machine, product, day and shift."""
    context = machine_context(floor, period, rule)

    def cut(df: DataFrame, start: str, end: str) -> DataFrame:
        return cut_at_shifts(df, start, end, period.start, period.end).where(
            F.col("data_turno") >= clock.day(period.start)
        )

    runs = cut(
        on_machine(floor, valid_runs(floor, period), context, "nome_maquina", *PLACE, "turnos"),
        "data_inicio",
        "data_fim",
    )
    stops = cut(
        on_machine(
            floor,
            period_stops(floor, period, codes.UNWEIGHTED).select(
                PLANT, "maquina_id", "data_hora_inicio", "data_hora_fim"
            ),
            context,
            "turnos",
        ),
        "data_hora_inicio",
        "data_hora_fim",
    )
    return covered_seconds(
        runs, stops, SHIFT, [*SHIFT, "nome_maquina", *PLACE, "cod_produto"]
    ).withColumnsRenamed({"total": "tempo_calendario", "covered": "tempo_sem_peso"})


def _clamped() -> Column:
    return F.greatest(F.col("tempo_calendario") - F.col("tempo_sem_peso"), F.lit(0))


def useful_time_detail(floor: ShopFloor, period: Period) -> DataFrame:
    """Useful time per machine, product, day and shift, clamped and un-clamped."""
    return useful_time_by_shift(floor, period, "useful_time").select(
        F.col(PLANT).alias("cod_estabelecimento"),
        F.col("data_turno").alias("data_produto"),
        F.col("maquina_id").alias("cod_maquina"),
        F.col("nome_maquina").alias("des_nome_maquina"),
        "cod_produto",
        "num_turno",
        "tempo_calendario",
        "tempo_sem_peso",
        _clamped().alias("tempo_util"),
        (F.col("tempo_calendario") - F.col("tempo_sem_peso")).alias("tempo_util_neg"),
        text_key(F.col(PLANT), F.col("maquina_id")).alias("chave_maquina"),
    )


# --- OEE ---------------------------------------------------------------------------------

# The report can be grouped by any of these, and by calendar steps of the production day.
GRAIN_COLUMNS = ("cod_produto", "maquina_id", "id_setor", "id_fabrica")
PLACE = ("id_setor", "id_fabrica")


def _useful(floor: ShopFloor, period: Period, keys: Sequence[str]) -> DataFrame:
    per_shift = (
        useful_time_by_shift(floor, period, "oee")
        .groupBy(PLANT, *[k for k in keys if k != "id_setor"], "data_turno", "num_turno", "id_setor")
        .agg(F.sum("tempo_calendario").alias("tempo_calendario"), F.sum("tempo_sem_peso").alias("tempo_sem_peso"))
    )
    return per_shift.select(
        PLANT, *keys, F.col("data_turno").alias("data"), _clamped().alias("tempo_util")
    )


def _stop_losses(floor: ShopFloor, period: Period, context: DataFrame, keys: Sequence[str]) -> DataFrame:
    stops = period_stops(floor, period, codes.WEIGHTED, "id_familia").withColumnRenamed(
        "numero_produto", "cod_produto"
    )
    is_setup = F.coalesce(
        label(F.col("id_familia"), codes.FAMILY_GROUP).cast("int") == 5, F.lit(False)
    )
    cut = cut_at_shifts(
        on_machine(
            floor,
            stops.select(PLANT, "maquina_id", "cod_produto", "data_hora_inicio", "data_hora_fim", is_setup.alias("setup")),
            context,
            *PLACE,
            "turnos",
        ),
        "data_hora_inicio",
        "data_hora_fim",
        period.start,
        period.end,
    ).where(_in_period(F.col("data_turno"), period))
    return cut.select(
        PLANT,
        *keys,
        F.col("data_turno").alias("data"),
        F.when(~F.col("setup"), F.col("segundos")).alias("tempo_disp"),
        F.when(F.col("setup"), F.col("segundos")).alias("tempo_setup"),
    )


def stop_seconds(floor: ShopFloor, period: Period) -> DataFrame:
    """Weighted stop seconds per product and day, split into availability and setup."""
    keys = [PLANT, "cod_produto", "data"]
    parts = _stop_losses(floor, period, machine_context(floor, period), ["cod_produto"])
    return parts.groupBy(*keys).agg(
        *[zero(F.sum(c)).alias(c) for c in ("tempo_disp", "tempo_setup")]
    )


def _quality_losses(floor: ShopFloor, period: Period, context: DataFrame, keys: Sequence[str]) -> DataFrame:
    events = _event_day(floor, floor.quality, context, period, *PLACE)
    return _with_reason(events, floor, codes.WEIGHTED, "inner").withColumnRenamed("numero_produto", "cod_produto").select(
        PLANT, *keys, "data", quality_seconds().alias("tempo_qual")
    )


def quality_seconds() -> Column:
    return ratio(F.col("ciclo") * F.col("valor"), F.col("pares_batida"))


def _performance_losses(floor: ShopFloor, period: Period, context: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (
        _event_day(floor, floor.performance, context, period, *PLACE)
        .withColumnRenamed("numero_produto", "cod_produto")
        .select(PLANT, *keys, "data", (F.col("valor") * F.col("ciclo")).alias("tempo_perf_perdas"))
    )


def _cycle_events(floor: ShopFloor) -> DataFrame:
    return floor.cycles.withColumnRenamed("id_equipamento", "maquina_id")


def _cycle_balance(floor: ShopFloor, period: Period, context: DataFrame, keys: Sequence[str]) -> DataFrame:
    deviation = F.col("diferenca")
    return (
        _event_day(floor, _cycle_events(floor), context, period, *PLACE)
        .withColumnRenamed("numero_produto", "cod_produto")
        .select(PLANT, *keys, "data", (gain(deviation) + loss(deviation)).alias("saldo_tc"))
    )


def cycle_balance(floor: ShopFloor, period: Period) -> DataFrame:
    """Cycle gain, loss and balance per product and production day."""
    deviation = F.col("diferenca")
    events = _event_day(floor, _cycle_events(floor), machine_context(floor, period), period)
    return (
        events.groupBy(PLANT, F.col("numero_produto").alias("cod_produto"), "data")
        .agg(F.sum(gain(deviation)).alias("soma_ganho"), F.sum(loss(deviation)).alias("soma_perda"))
        .withColumn("saldo_tc", F.col("soma_ganho") + F.col("soma_perda"))
    )


def oee_components(
    floor: ShopFloor,
    period: Period,
    products: str | None = None,
    grain: Sequence[str] = ("cod_produto",),
    every: str = "day",
) -> DataFrame:
    """Useful time and the five losses per grain and day, for keys with useful time.

    The sources are stacked and summed once instead of being aggregated one by one and
    joined on the key: one shuffle of partial sums, and a key that owns many rows is
    already combined on the map side.
    """
    keys = list(grain)
    wrong = sorted(set(keys) - set(GRAIN_COLUMNS))
    if wrong:
        raise ValueError(f"unsupported grain columns: {wrong}")
    context = machine_context(floor, period)
    losses = [
        part(floor, period, context, keys)
        for part in (_stop_losses, _quality_losses, _performance_losses, _cycle_balance)
    ]
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    stacked = _useful(floor, period, keys)
    for part in losses:
        stacked = stacked.unionByName(part.where(known), allowMissingColumns=True)
    if products is not None and "cod_produto" in keys:
        stacked = stacked.where(in_list(F.col("cod_produto"), products))
    step = F.col("data") if every == "day" else F.trunc("data", every)
    return (
        stacked.groupBy(PLANT, *keys, step.alias("data"))
        .agg(
            F.sum("tempo_util").alias("tempo_util"),
            *[zero(F.sum(c)).alias(c) for c in COMPONENTS],
        )
        .where("tempo_util > 0")
    )


def oee_ratio() -> Column:
    """``1 - (stops + setup)/u - (balance + loss)/u - quality/u`` in double, in this order."""
    u = F.col("tempo_util")
    return (
        F.lit(1.0)
        - ratio(F.col("tempo_disp") + F.col("tempo_setup"), u)
        - ratio(F.col("saldo_tc") + F.col("tempo_perf_perdas"), u)
        - ratio(F.col("tempo_qual"), u)
    )


def _pct(c: Column) -> Column:
    return round2(c * 100).cast("decimal(18,2)")


def with_oee(components: DataFrame) -> DataFrame:
    """OEE, loss pillars and useful/good time (text and seconds) next to the components."""
    u = F.col("tempo_util")
    # A month of a large plant has more seconds than an int holds.
    good = (u * oee_ratio()).cast("bigint")
    return components.withColumns(
        {
            "pct_oee": _pct(oee_ratio()),
            "tempo_util_hms": clock.hms(u),
            "hrs_boas_hms": clock.hms(good),
            "hrs_boas": good,
            "pct_disp": _pct(ratio(F.col("tempo_disp") + F.col("tempo_setup"), u)),
            "pct_perf": _pct(ratio(F.col("saldo_tc") + F.col("tempo_perf_perdas"), u)),
            "pct_qual": _pct(ratio(F.col("tempo_qual"), u)),
        }
    )


def oee(
    floor: ShopFloor,
    period: Period,
    products: str | None = None,
    grain: Sequence[str] = ("cod_produto",),
    every: str = "day",
) -> DataFrame:
    """OEE report; the default grain is product and day (``every`` also takes week, month)."""
    return with_oee(oee_components(floor, period, products, grain, every)).select(
        *grain,
        F.col(PLANT).alias("estab"),
        "pct_oee",
        "tempo_util",
        "tempo_util_hms",
        "hrs_boas",
        "hrs_boas_hms",
        "pct_disp",
        "pct_perf",
        "pct_qual",
        "data",
    )


def oee_measures(
    stops: DataFrame, cycles: DataFrame, losses: DataFrame, quality: DataFrame, useful: DataFrame, by: Sequence[str]
) -> DataFrame:
    """Dashboard measures from the detail reports: one row per ``by`` key, zero-safe ratios.

    The details are renamed by the caller so that all of them carry the ``by`` columns.
    """
    keys = [F.col(k) for k in by]
    is_setup = F.col("des_familia") == codes.SETUP
    parts = [
        useful.select(*keys, F.col("tempo_util").alias("util")),
        stops.select(
            *keys,
            F.when(F.coalesce(~is_setup, F.lit(True)), F.col("tempo_parada")).alias("disp"),
            F.when(is_setup, F.col("tempo_parada")).alias("setup"),
        ),
        cycles.select(*keys, (F.col("soma_ganho_ciclo") + F.col("soma_perda_ciclo")).alias("perf")),
        losses.select(*keys, F.col("tempo_perda").alias("perf")),
        quality.select(*keys, F.col("tempo_apontamento").alias("qual")),
    ]
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p, allowMissingColumns=True)
    pillars = {"disp": "pct_disponibilidade", "setup": "pct_setup", "perf": "pct_performance", "qual": "pct_qualidade"}
    sums = stacked.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("util", *pillars)])
    out = sums.select(
        *by,
        zero(F.col("util")).alias("segundos_uteis"),
        *[zero_safe_ratio(F.col(c), F.col("util")).alias(n) for c, n in pillars.items()],
    )
    total = F.lit(1.0)
    for n in pillars.values():
        total = total - F.col(n)
    return out.withColumn("pct_oee", total)


# --- detail reports ----------------------------------------------------------------------


def group_setup_labels(floor: ShopFloor, period: Period) -> DataFrame:
    """Setup label of a stop group: reason of its first one-unit stop."""
    stops = floor.stops.where(
        F.col("id_grupo").isNotNull()
        & (F.col("tempo") == 1)
        & (F.col("data_hora_inicio") <= clock.ntz(period.end))
        & not_in(F.col("codigo"), codes.NOT_A_GROUP_SETUP)
    ).select(PLANT, "id_grupo", "codigo", "data_hora_inicio", "id")
    named = _with_reason(stops, floor, None, "inner", "motivo")
    first = first_per_key(
        named, [PLANT, "id_grupo"], [F.col("data_hora_inicio").asc(), F.col("id").asc()]
    )
    return first.select(PLANT, "id_grupo", F.col("motivo").alias("setup_grupo"))


def ungrouped_setup_label(code: Column, group: Column, factory: Column) -> Column:
    outside = not_in(factory, codes.FACTORIES_WITHOUT_BOUND_SETUP)
    applies = group.isNull() & (~code.isin(list(codes.FACTORY_BOUND_SETUP_CODES)) | outside)
    return F.when(applies, label(code, codes.UNGROUPED_SETUP_LABEL))


def stop_class(description: Column, group: Column) -> Column:
    """Waiting or repair, for the tooling and maintenance groups only."""
    tooling, maintenance = codes.FAMILY_GROUP_NAME[3], codes.FAMILY_GROUP_NAME[2]
    verb = F.when(description.contains("Aguardando"), "Aguardando ").when(
        description.isNotNull(), "Reparo "
    )
    return F.when(group.isin(tooling, maintenance), F.concat(verb, group))


def flat_reason(code: Column, setup: Column) -> Column:
    flat = code.isin(list(codes.ALWAYS_FLAT_REASONS))
    for text, listed in codes.FLAT_REASONS.items():
        flat = flat | ((setup == text) & code.isin(list(listed)))
    return F.when(flat, codes.YES).otherwise("")


def counts_for_day(start: Column, end: Column, shift: Column) -> Column:
    """Whether a stop that spans shifts is counted in this one (once per production day).

    It starts in the shift, or it came from before the day and ends in the shift, or it
    covers the whole day (then the first shift counts it).
    """
    s0, s1 = F.col("inicio_turno"), F.col("fim_turno")
    d0, d1 = F.col("inicio_dia_turno"), F.col("fim_dia_turno")
    counted = (
        start.between(s0, s1)
        | (end.between(s0, s1) & (start < d0))
        | ((shift == 1) & (start < s0) & (end > s1) & (start < d0) & (end > d1))
    )
    return F.when(counted, codes.YES).otherwise(codes.NO)


def stop_detail(floor: ShopFloor, period: Period) -> DataFrame:
    """Weighted stops cut at shifts: seconds and number of reasons over 20 keys."""
    context = machine_context(floor, period, "stop_detail", detail=True)
    stops = period_stops(floor, period, codes.WEIGHTED, "motivo", "peso_oee", "id_familia")
    stops = on_machine(
        floor,
        stops.select(
            PLANT, "id", "maquina_id", "codigo", "data_hora_inicio", "data_hora_fim", "status", "programa",
            "documento", "numero_produto", "id_grupo", "motivo", "peso_oee", "id_familia",
        ),
        context, "nome_maquina", "id_fabrica", "turnos",
    )
    stops = join_sparse(stops, group_setup_labels(floor, period), [PLANT, "id_grupo"], "id_grupo", "id")

    family = label(label(F.col("id_familia"), codes.FAMILY_GROUP).cast("int"), codes.FAMILY_GROUP_NAME)
    setup = F.coalesce(
        ungrouped_setup_label(F.col("codigo"), F.col("id_grupo"), F.col("id_fabrica")),
        F.col("setup_grupo"),
        F.lit(""),
    )
    named = stops.withColumn("agg_familia", family).withColumn("tp_setup", setup)
    is_setup = F.col("tp_setup") != ""
    described = named.withColumns(
        {
            "tp_parada": stop_class(F.col("motivo"), F.col("agg_familia")),
            "des_familia": F.when(is_setup, codes.SETUP).otherwise(F.col("agg_familia")),
            "cod_grupo_parada": F.when(
                F.col("id_grupo").isNull() & is_setup,
                short_md5(F.col(PLANT), F.col("id"), F.col("maquina_id")),
            ).otherwise(F.col("id_grupo").cast("string")),
            "bln_motivo_flat": flat_reason(F.col("codigo"), F.col("tp_setup")),
            "bln_parada_fechada": F.when(F.col("status").isin(list(codes.OPEN_STATUSES)), codes.NO).otherwise(codes.YES),
        }
    )
    cut = cut_at_shifts(
        described, "data_hora_inicio", "data_hora_fim", period.start, period.end, with_bounds=True
    ).where(_in_period(F.col("data_turno"), period))
    start, end = F.col("data_hora_inicio"), F.col("data_hora_fim")
    ends_here = end.between(F.col("inicio_turno"), F.col("fim_turno"))
    keyed = cut.select(
        F.col(PLANT).alias("cod_estabelecimento"),
        F.col("data_turno").alias("data_parada"),
        F.col("maquina_id").alias("cod_maquina"),
        F.col("nome_maquina").alias("des_nome_maquina"),
        F.col("numero_produto").alias("cod_produto"),
        F.col("programa").alias("num_programa"),
        F.col("documento").alias("num_documento"),
        "num_turno",
        F.col("codigo").alias("cod_motivo_parada"),
        F.col("motivo").alias("des_motivo_parada"),
        "tp_parada",
        "des_familia",
        "tp_setup",
        "bln_motivo_flat",
        F.col("peso_oee").alias("des_peso_oee"),
        "cod_grupo_parada",
        text_key(F.col(PLANT), F.col("maquina_id")).alias("chave_maquina"),
        "bln_parada_fechada",
        counts_for_day(start, end, F.col("num_turno")).alias("bln_contabiliza_dia"),
        F.when(ends_here, codes.YES).otherwise(codes.NO).alias("bln_contabiliza_mes"),
        "segundos",
    )
    keys = [c for c in keyed.columns if c != "segundos"]
    return keyed.groupBy(*keys).agg(
        F.count("cod_motivo_parada").alias("qtd_motivo"), F.sum("segundos").alias("tempo_parada")
    )


def shift_number(text: Column) -> Column:
    """Shift number inside a text like ``Turno 2``."""
    return F.substring(text, 7, 1)


def _detail_keys(day: str) -> dict[str, Column]:
    return {
        "cod_estabelecimento": F.col(PLANT),
        day: F.col("data"),
        "cod_maquina": F.col("maquina_id"),
        "des_nome_maquina": F.col("nome_maquina"),
        "cod_produto": F.col("numero_produto"),
        "num_programa": F.col("programa"),
        "num_documento": F.col("documento"),
        "num_turno": shift_number(F.col("turno")),
        "chave_maquina": text_key(F.col(PLANT), F.col("maquina_id")),
    }


def _grouped(events: DataFrame, keys: dict[str, Column]):
    return events.groupBy(*[c.alias(n) for n, c in keys.items()])


def cycle_detail(floor: ShopFloor, period: Period) -> DataFrame:
    """Average and total cycle figures per machine, product, day and shift."""
    context = machine_context(floor, period, detail=True)
    events = _event_day(floor, _cycle_events(floor), context, period, "nome_maquina")
    measures = {
        "ciclo_padrao": F.col("ciclo_ti"),
        "ciclo_real": F.col("ciclo_atual"),
        "diferenca_ciclo": F.col("diferenca"),
        "ganho_ciclo": gain(F.col("diferenca")),
        "perda_ciclo": loss(F.col("diferenca")),
    }
    return _grouped(events, _detail_keys("data_ciclo")).agg(
        *[round2(F.avg(c)).alias(f"media_{n}") for n, c in measures.items()],
        *[round2(F.sum(c)).alias(f"soma_{n}") for n, c in measures.items()],
        F.count("data_hora").alias("qtd_ciclos"),
    )


def performance_loss_detail(floor: ShopFloor, period: Period) -> DataFrame:
    """Performance losses per machine, product, day, shift and reason."""
    context = machine_context(floor, period, detail=True)
    losses = floor.performance.where(
        F.col("data_hora").between(clock.ntz(period.start), clock.ntz(period.end))
    )
    events = _event_day(floor, losses, context, period, "nome_maquina")
    events = _with_reason(events, floor, None, "left", "motivo")
    keys = _detail_keys("data_perda") | {"des_perda": F.col("motivo")}
    return _grouped(events, keys).agg(
        F.sum("valor").alias("qtd_perda"),
        round2(F.sum(F.col("valor") * F.col("ciclo"))).alias("tempo_perda"),
    )


def quality_loss_detail(floor: ShopFloor, period: Period) -> DataFrame:
    """Weighted quality losses per machine, product, day, shift and reason."""
    context = machine_context(floor, period, detail=True)
    events = _event_day(floor, floor.quality, context, period, "nome_maquina")
    events = _with_reason(events, floor, codes.WEIGHTED, "inner", "motivo")
    keys = _detail_keys("data_apontamento") | {
        "cod_motivo_apontamento": F.col("codigo"),
        "des_motivo_apontamento": F.col("motivo"),
    }
    return _grouped(events, keys).agg(
        round2(F.sum(quality_seconds())).alias("tempo_apontamento"),
        F.sum("valor").alias("qtd_pares_perda"),
    )
