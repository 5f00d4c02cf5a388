"""SQL twins of the OEE queries, written as plain pair joins over an explicit shift grid."""

from __future__ import annotations

from workload.oracle_roles import with_roles

START, END = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-01-31 00:00:00'"
DAY0, DAY1 = "DATE '2024-01-01'", "DATE '2024-01-31'"
DAYS = "SELECT CAST(d AS DATE) AS dia FROM range(TIMESTAMP '2023-12-31', TIMESTAMP '2024-02-01', INTERVAL 1 DAY) AS r(d)"

MACH = """
    SELECT m.id_estabelecimento, m.id AS maquina_id, m.nome, m.id_setor, s.id_fabrica, h.i1
    FROM machines m
    JOIN sectors s ON s.id_estabelecimento = m.id_estabelecimento AND s.id = m.id_setor
    JOIN hours h ON h.id_estabelecimento = m.id_estabelecimento AND h.id_setor = m.id_setor
    WHERE m.id_setor NOT IN (3, 7) AND s.id_fabrica NOT IN (4)"""


def grid(rule: str) -> str:
    nxt = {
        "oee": ("i2 < i1", "f2 < i1", "i3 = TIME '00:57:01' OR i3 < i1", "i3 = TIME '00:57:01' OR f3 < i3"),
        "useful_time": ("false", "f2 < i2", "i3 = TIME '00:57:01'", "i3 = TIME '00:57:01' OR f3 < i3"),
        "stop_detail": tuple(f"{b} > TIME '00:00:00' AND {b} < i1" for b in ("i2", "f2", "i3", "f3")),
    }[rule]

    def at(bound: str, cond: str) -> str:
        return f"(dia + CASE WHEN {cond} THEN 1 ELSE 0 END) + {bound}"

    i2, f2, i3, f3 = (at(b, c) for b, c in zip(("i2", "f2", "i3", "f3"), nxt))
    day = f"dia + i1 AS dia_ini, {f3} AS dia_fim"
    return f"""
    SELECT id_estabelecimento, id_setor, dia AS data_turno, 1 AS num_turno, dia + i1 AS ini, dia + f1 AS fim, {day} FROM hours, days
    UNION ALL SELECT id_estabelecimento, id_setor, dia, 2, {i2}, {f2}, {day} FROM hours, days
    UNION ALL SELECT id_estabelecimento, id_setor, dia, 3, {i3}, {f3}, {day} FROM hours, days"""


VALID_RUNS = f"""
    SELECT r.id_estabelecimento, r.id_equipamento AS maquina_id, r.numero_produto AS cod_produto, r.data_inicio,
           coalesce(r.data_fim, {END}) AS data_fim
    FROM runs r
    LEFT JOIN (SELECT id_estabelecimento, id_equipamento, numero_produto,
                      date_trunc('second', data_inicio + INTERVAL 500 MILLISECOND) AS sec
               FROM runs GROUP BY ALL HAVING count(*) > 1) d
      ON d.id_estabelecimento = r.id_estabelecimento AND d.id_equipamento = r.id_equipamento
     AND d.numero_produto = r.numero_produto AND d.sec = date_trunc('second', r.data_inicio + INTERVAL 500 MILLISECOND)
     AND r.data_fim IS NULL
    WHERE d.sec IS NULL AND r.data_inicio <= {END} AND coalesce(r.data_fim, {END}) >= {START}"""

SECONDS = "date_diff('second', greatest({a}, g.ini), least({b}, g.fim))"


def useful(rule: str) -> dict[str, str]:
    on = "g.id_estabelecimento = r.id_estabelecimento AND g.id_setor = r.id_setor"
    keys = "r.id_estabelecimento, r.maquina_id, r.nome, r.id_setor, r.id_fabrica, r.cod_produto, g.data_turno, g.num_turno"
    return {
        "days": DAYS,
        "mach": MACH,
        "grid": grid(rule),
        "valid_runs": VALID_RUNS,
        "mrun": "SELECT r.*, m.nome, m.id_setor, m.id_fabrica FROM valid_runs r JOIN mach m USING (id_estabelecimento, maquina_id)",
        "planned": f"""
            SELECT s.id_estabelecimento, s.maquina_id, s.data_hora_inicio AS a, s.data_hora_fim AS b
            FROM stops s JOIN reasons m USING (id_estabelecimento, codigo)
            WHERE m.peso_oee = 'Sem Peso' AND s.data_hora_inicio <= {END} AND s.data_hora_fim >= {START}""",
        "run_stop": """
            SELECT r.*, greatest(p.a, r.data_inicio) AS pa, least(p.b, r.data_fim) AS pb
            FROM mrun r JOIN planned p ON p.id_estabelecimento = r.id_estabelecimento AND p.maquina_id = r.maquina_id
             AND p.a <= r.data_fim AND p.b >= r.data_inicio""",
        "cal": f"""
            SELECT {keys}, sum({SECONDS.format(a="r.data_inicio", b="r.data_fim")}) AS cal
            FROM mrun r JOIN grid g ON {on} AND r.data_inicio < g.fim AND r.data_fim > g.ini GROUP BY ALL""",
        "off": f"""
            SELECT {keys}, sum({SECONDS.format(a="r.pa", b="r.pb")}) AS off
            FROM run_stop r JOIN grid g ON {on} AND r.pa < g.fim AND r.pb > g.ini GROUP BY ALL""",
    }


USEFUL_DETAIL = with_roles(
    f"""
SELECT c.id_estabelecimento AS cod_estabelecimento, c.data_turno AS data_produto, c.maquina_id AS cod_maquina,
       c.nome AS des_nome_maquina, c.cod_produto, c.num_turno, CAST(c.cal AS BIGINT) AS tempo_calendario,
       CAST(coalesce(o.off, 0) AS BIGINT) AS tempo_sem_peso,
       CAST(greatest(c.cal - coalesce(o.off, 0), 0) AS BIGINT) AS tempo_util,
       CAST(c.cal - coalesce(o.off, 0) AS BIGINT) AS tempo_util_neg,
       CAST(c.id_estabelecimento AS VARCHAR) || CAST(c.maquina_id AS VARCHAR) AS chave_maquina
FROM cal c LEFT JOIN off o USING (id_estabelecimento, maquina_id, cod_produto, data_turno, num_turno)
WHERE c.data_turno >= {DAY0}""",
    **useful("useful_time"),
)

FAMILY_SETUP = "m.id_familia = 86"


def prod_day(ts: str, i1: str = "m.i1") -> str:
    return f"CAST(CASE WHEN CAST({ts} AS TIME) < {i1} THEN {ts} - INTERVAL 1 DAY ELSE {ts} END AS DATE)"


def losses(key: str, stop_key: str) -> dict[str, str]:
    """Loss components per plant, key and day; ``key`` names the columns of point facts."""
    in_range = f"BETWEEN {DAY0} AND {DAY1}"
    return {
        "wstops": f"""
            SELECT s.*, r.id_familia, m.nome, m.id_setor, m.id_fabrica
            FROM stops s JOIN reasons r USING (id_estabelecimento, codigo) JOIN mach m USING (id_estabelecimento, maquina_id)
            WHERE r.peso_oee = 'Com Peso' AND s.data_hora_inicio <= {END} AND s.data_hora_fim >= {START}""",
        "disp": f"""
            SELECT s.id_estabelecimento, {stop_key} AS k, g.data_turno AS data,
                   sum(CASE WHEN s.id_familia <> 86 THEN {SECONDS.format(a="s.data_hora_inicio", b="s.data_hora_fim")} ELSE 0 END) AS tempo_disp,
                   sum(CASE WHEN s.id_familia = 86 THEN {SECONDS.format(a="s.data_hora_inicio", b="s.data_hora_fim")} ELSE 0 END) AS tempo_setup
            FROM wstops s JOIN grid g ON g.id_estabelecimento = s.id_estabelecimento AND g.id_setor = s.id_setor
             AND s.data_hora_inicio < g.fim AND s.data_hora_fim > g.ini
            WHERE g.data_turno >= {DAY0} GROUP BY ALL""",
        "qual": f"""
            SELECT q.id_estabelecimento, {key} AS k, {prod_day("q.data_hora")} AS data, sum(q.ciclo * q.valor / q.pares_batida) AS v
            FROM quality q JOIN mach m USING (id_estabelecimento, maquina_id) JOIN reasons r USING (id_estabelecimento, codigo)
            WHERE r.peso_oee = 'Com Peso' AND {prod_day("q.data_hora")} {in_range} GROUP BY ALL""",
        "perf": f"""
            SELECT q.id_estabelecimento, {key} AS k, {prod_day("q.data_hora")} AS data, sum(q.valor * q.ciclo) AS v
            FROM performance q JOIN mach m USING (id_estabelecimento, maquina_id)
            WHERE {prod_day("q.data_hora")} {in_range} GROUP BY ALL""",
        "bal": f"""
            SELECT q.id_estabelecimento, {key} AS k, {prod_day("q.data_hora")} AS data,
                   sum(CASE WHEN diferenca <= 0 THEN diferenca ELSE 0 END) AS ganho,
                   sum(CASE WHEN diferenca >= 0 THEN diferenca ELSE 0 END) AS perda
            FROM (SELECT *, id_equipamento AS maquina_id FROM cycles) q JOIN mach m USING (id_estabelecimento, maquina_id)
            WHERE {prod_day("q.data_hora")} {in_range} GROUP BY ALL""",
    }


def r2(x: str) -> str:
    return f"CAST(round(CAST(round({x}, 6) AS DECIMAL(28, 6)), 2) AS DOUBLE)"


def hms(s: str) -> str:
    m = f"((({s}) % 86400 + 86400) % 86400)"
    return f"printf('%02d:%02d:%02d', {m} // 3600, {m} % 3600 // 60, {m} % 60)"


def oee_sql(name: str, run_key: str, fact_key: str, stop_key: str, key_type: str = "VARCHAR", month: bool = False) -> str:
    shift_key = "data_turno, num_turno, id_setor"
    extra = useful("oee") | losses(fact_key, stop_key) | {
        "per_shift": f"""
            SELECT c.id_estabelecimento, c.{run_key} AS k, c.data_turno, c.num_turno, c.id_setor, sum(c.cal) AS cal, sum(coalesce(o.off, 0)) AS off
            FROM cal c LEFT JOIN off o USING (id_estabelecimento, maquina_id, cod_produto, {shift_key})
            WHERE c.data_turno >= {DAY0} GROUP BY ALL""",
        "tu": "SELECT id_estabelecimento, k, data_turno AS data, CAST(sum(greatest(cal - off, 0)) AS BIGINT) AS u FROM per_shift GROUP BY ALL",
        "parts": """
            SELECT t.id_estabelecimento, t.k, t.data, t.u, coalesce(d.tempo_disp, 0) + coalesce(d.tempo_setup, 0) AS stopped,
                   coalesce(b.ganho + b.perda, 0) + coalesce(p.v, 0) AS perf, coalesce(q.v, 0) AS qual
            FROM tu t LEFT JOIN disp d USING (id_estabelecimento, k, data) LEFT JOIN qual q USING (id_estabelecimento, k, data)
              LEFT JOIN perf p USING (id_estabelecimento, k, data) LEFT JOIN bal b USING (id_estabelecimento, k, data)
            WHERE t.u > 0""",
        "calc": """
            SELECT *, 1.0::DOUBLE - CAST(stopped AS DOUBLE) / u - CAST(perf AS DOUBLE) / u - CAST(qual AS DOUBLE) / u AS oee FROM parts""",
    }
    if month:
        extra["parts"] = """
            SELECT id_estabelecimento, k, CAST(date_trunc('month', data) AS DATE) AS data, CAST(sum(u) AS BIGINT) AS u, sum(stopped) AS stopped,
                   sum(perf) AS perf, sum(qual) AS qual
            FROM (SELECT id_estabelecimento, k, data, u, 0 AS stopped, 0 AS perf, 0 AS qual FROM tu
                  UNION ALL SELECT id_estabelecimento, k, data, 0, tempo_disp + tempo_setup, 0, 0 FROM disp
                  UNION ALL SELECT id_estabelecimento, k, data, 0, 0, v, 0 FROM perf
                  UNION ALL SELECT id_estabelecimento, k, data, 0, 0, ganho + perda, 0 FROM bal
                  UNION ALL SELECT id_estabelecimento, k, data, 0, 0, 0, v FROM qual)
            GROUP BY ALL HAVING sum(u) > 0"""
    good = "CAST(trunc(u * oee) AS BIGINT)"
    return with_roles(
        f"""
SELECT CAST(k AS {key_type}) AS {name}, id_estabelecimento AS estab, {r2("oee * 100")} AS pct_oee, u AS tempo_util,
       {hms("u")} AS tempo_util_hms, {good} AS hrs_boas, {hms(good)} AS hrs_boas_hms,
       {r2("CAST(stopped AS DOUBLE) / u * 100")} AS pct_disp, {r2("CAST(perf AS DOUBLE) / u * 100")} AS pct_perf,
       {r2("CAST(qual AS DOUBLE) / u * 100")} AS pct_qual, data
FROM calc""",
        **extra,
    )


OEE = oee_sql("cod_produto", "cod_produto", "q.numero_produto", "s.numero_produto")
OEE_MACHINE = oee_sql("maquina_id", "maquina_id", "q.maquina_id", "s.maquina_id", "BIGINT")
OEE_SECTOR = oee_sql("id_setor", "id_setor", "m.id_setor", "s.id_setor", "INTEGER")

OEE_FACTORY_MONTH = oee_sql("id_fabrica", "id_fabrica", "m.id_fabrica", "s.id_fabrica", "INTEGER", month=True)

STOP_SECONDS = with_roles(
    """
SELECT id_estabelecimento, k AS cod_produto, data, CAST(tempo_disp AS BIGINT) AS tempo_disp, CAST(tempo_setup AS BIGINT) AS tempo_setup
FROM disp""",
    **(useful("oee") | losses("q.numero_produto", "s.numero_produto")),
)

CYCLE_BALANCE = with_roles(
    """
SELECT id_estabelecimento, k AS cod_produto, data, round(ganho, 6) AS soma_ganho, round(perda, 6) AS soma_perda,
       round(ganho + perda, 6) AS saldo_tc
FROM bal""",
    **(useful("oee") | losses("q.numero_produto", "s.numero_produto")),
)

SHIFT_GRID = with_roles(
    "SELECT id_estabelecimento, id_setor, data_turno, num_turno, ini AS inicio_turno, fim AS fim_turno FROM grid",
    days=DAYS,
    grid=grid("oee"),
)

RUN_STOP = with_roles(
    """
SELECT id_estabelecimento, maquina_id, cod_produto, data_inicio, data_fim, pa AS ini_parada, pb AS fim_parada FROM run_stop""",
    **useful("oee"),
)

RUN_STOP_LEFT = with_roles(
    """
SELECT r.id_estabelecimento, r.maquina_id, r.cod_produto, r.data_inicio, r.data_fim,
       CASE WHEN p.a IS NOT NULL THEN greatest(p.a, r.data_inicio) END AS ini_parada,
       CASE WHEN p.b IS NOT NULL THEN least(p.b, r.data_fim) END AS fim_parada
FROM mrun r LEFT JOIN planned p ON p.id_estabelecimento = r.id_estabelecimento AND p.maquina_id = r.maquina_id
 AND p.a <= r.data_fim AND p.b >= r.data_inicio""",
    **useful("oee"),
)

STOP_DETAIL = with_roles(
    f"""
SELECT id_estabelecimento AS cod_estabelecimento, data_turno AS data_parada, maquina_id AS cod_maquina, nome AS des_nome_maquina,
       numero_produto AS cod_produto, programa AS num_programa, documento AS num_documento, num_turno,
       codigo AS cod_motivo_parada, descricao AS des_motivo_parada, tp_parada,
       CASE WHEN tp_setup <> '' THEN 'Setup' ELSE agg END AS des_familia, tp_setup,
       CASE WHEN (codigo IN (107, 454, 1704, 400, 1041, 129) AND tp_setup = 'Setup Matriz')
              OR (codigo IN (100, 1707, 1708, 129) AND tp_setup = 'Troca de Cor') OR codigo IN (892, 1701)
            THEN 'Sim' ELSE '' END AS bln_motivo_flat,
       peso_oee AS des_peso_oee,
       CASE WHEN id_grupo IS NULL AND tp_setup <> ''
            THEN left(md5(CAST(id_estabelecimento AS VARCHAR) || CAST(id AS VARCHAR) || CAST(maquina_id AS VARCHAR)), 8)
            ELSE CAST(id_grupo AS VARCHAR) END AS cod_grupo_parada,
       CAST(id_estabelecimento AS VARCHAR) || CAST(maquina_id AS VARCHAR) AS chave_maquina,
       CASE WHEN status IN (1, 4) THEN 'Não' ELSE 'Sim' END AS bln_parada_fechada,
       CASE WHEN a >= ini AND a <= fim OR b >= ini AND b <= fim AND a < dia_ini
              OR num_turno = 1 AND a < ini AND b > fim AND a < dia_ini AND b > dia_fim
            THEN 'Sim' ELSE 'Não' END AS bln_contabiliza_dia,
       CASE WHEN b >= ini AND b <= fim THEN 'Sim' ELSE 'Não' END AS bln_contabiliza_mes,
       count(codigo) AS qtd_motivo, CAST(sum(date_diff('second', greatest(a, ini), least(b, fim))) AS BIGINT) AS tempo_parada
FROM cut GROUP BY ALL""",
    days=DAYS,
    mach=MACH,
    grid=grid("stop_detail"),
    lookup=f"""
        SELECT id_estabelecimento, id_grupo, arg_min(descricao, (data_hora_inicio, id)) AS setup_grupo
        FROM stops JOIN reasons USING (id_estabelecimento, codigo)
        WHERE id_grupo IS NOT NULL AND tempo = 1 AND data_hora_inicio <= {END} AND codigo NOT IN (0, 106, 1614)
        GROUP BY ALL""",
    cut=f"""
        SELECT s.id_estabelecimento, s.id, s.maquina_id, m.nome, s.numero_produto, s.programa, s.documento, s.codigo, r.descricao,
               r.peso_oee, s.id_grupo, s.status, s.data_hora_inicio AS a, s.data_hora_fim AS b, g.data_turno, g.num_turno, g.ini, g.fim,
               g.dia_ini, g.dia_fim,
               CASE r.id_familia WHEN 65 THEN 'Manutenção' WHEN 66 THEN 'Matrizaria' WHEN 67 THEN 'Produção' WHEN 86 THEN 'Setup' END AS agg,
               CASE WHEN r.id_familia = 66 AND r.descricao LIKE '%Aguardando%' THEN 'Aguardando Matrizaria'
                    WHEN r.id_familia = 66 THEN 'Reparo Matrizaria'
                    WHEN r.id_familia = 65 AND r.descricao LIKE '%Aguardando%' THEN 'Aguardando Manutenção'
                    WHEN r.id_familia = 65 THEN 'Reparo Manutenção' END AS tp_parada,
               CASE WHEN s.codigo = 100 AND s.id_grupo IS NULL THEN 'Troca de Cor'
                    WHEN s.codigo = 107 AND s.id_grupo IS NULL THEN 'Setup Matriz'
                    ELSE coalesce(l.setup_grupo, '') END AS tp_setup
        FROM stops s JOIN reasons r USING (id_estabelecimento, codigo) JOIN mach m USING (id_estabelecimento, maquina_id)
          LEFT JOIN lookup l ON l.id_estabelecimento = s.id_estabelecimento AND l.id_grupo = s.id_grupo
          JOIN grid g ON g.id_estabelecimento = s.id_estabelecimento AND g.id_setor = m.id_setor
            AND s.data_hora_inicio < g.fim AND s.data_hora_fim > g.ini
        WHERE r.peso_oee = 'Com Peso' AND s.data_hora_inicio <= {END} AND s.data_hora_fim >= {START}
          AND g.data_turno BETWEEN {DAY0} AND {DAY1}""",
)

_DETAIL = f"""
    q.id_estabelecimento AS cod_estabelecimento, q.maquina_id AS cod_maquina, m.nome AS des_nome_maquina, q.numero_produto AS cod_produto,
    q.programa AS num_programa, q.documento AS num_documento, substring(q.turno, 7, 1) AS num_turno,
    CAST(q.id_estabelecimento AS VARCHAR) || CAST(q.maquina_id AS VARCHAR) AS chave_maquina"""

_CYCLE = {
    "ciclo_padrao": "ciclo_ti",
    "ciclo_real": "ciclo_atual",
    "diferenca_ciclo": "diferenca",
    "ganho_ciclo": "CASE WHEN diferenca <= 0 THEN diferenca ELSE 0 END",
    "perda_ciclo": "CASE WHEN diferenca >= 0 THEN diferenca ELSE 0 END",
}

CYCLE_DETAIL = with_roles(
    f"""
SELECT {_DETAIL}, {prod_day("q.data_hora")} AS data_ciclo,
       {", ".join(f"{r2(f'avg({e})')} AS media_{n}, {r2(f'sum({e})')} AS soma_{n}" for n, e in _CYCLE.items())},
       count(q.data_hora) AS qtd_ciclos
FROM (SELECT *, id_equipamento AS maquina_id FROM cycles) q JOIN mach m USING (id_estabelecimento, maquina_id)
WHERE {prod_day("q.data_hora")} BETWEEN {DAY0} AND {DAY1} GROUP BY ALL""",
    mach=MACH,
)

PERFORMANCE_DETAIL = with_roles(
    f"""
SELECT {_DETAIL}, {prod_day("q.data_hora")} AS data_perda, r.descricao AS des_perda, CAST(sum(q.valor) AS BIGINT) AS qtd_perda,
       {r2("sum(q.valor * q.ciclo)")} AS tempo_perda
FROM performance q JOIN mach m USING (id_estabelecimento, maquina_id) LEFT JOIN reasons r USING (id_estabelecimento, codigo)
WHERE q.data_hora BETWEEN {START} AND {END} AND {prod_day("q.data_hora")} BETWEEN {DAY0} AND {DAY1} GROUP BY ALL""",
    mach=MACH,
)

QUALITY_DETAIL = with_roles(
    f"""
SELECT {_DETAIL}, {prod_day("q.data_hora")} AS data_apontamento, q.codigo AS cod_motivo_apontamento, r.descricao AS des_motivo_apontamento,
       {r2("sum(q.ciclo * q.valor / q.pares_batida)")} AS tempo_apontamento, CAST(sum(q.valor) AS BIGINT) AS qtd_pares_perda
FROM quality q JOIN mach m USING (id_estabelecimento, maquina_id) JOIN reasons r USING (id_estabelecimento, codigo)
WHERE r.peso_oee = 'Com Peso' AND {prod_day("q.data_hora")} BETWEEN {DAY0} AND {DAY1} GROUP BY ALL""",
    mach=MACH,
)

def _inner(sql: str) -> str:
    """The detail query as a subquery; its own CTEs stay local."""
    return f"({sql})"


OEE_MEASURES = f"""
WITH s AS {_inner(STOP_DETAIL)}, c AS {_inner(CYCLE_DETAIL)}, p AS {_inner(PERFORMANCE_DETAIL)}, q AS {_inner(QUALITY_DETAIL)}, u AS {_inner(USEFUL_DETAIL)},
k AS (SELECT cod_estabelecimento, cod_maquina FROM s UNION SELECT cod_estabelecimento, cod_maquina FROM c UNION SELECT cod_estabelecimento, cod_maquina FROM p
      UNION SELECT cod_estabelecimento, cod_maquina FROM q UNION SELECT cod_estabelecimento, cod_maquina FROM u),
m AS (
  SELECT k.*, coalesce((SELECT sum(tempo_util) FROM u WHERE u.cod_estabelecimento = k.cod_estabelecimento AND u.cod_maquina = k.cod_maquina), 0) AS util,
    (SELECT sum(tempo_parada) FROM s WHERE s.cod_estabelecimento = k.cod_estabelecimento AND s.cod_maquina = k.cod_maquina AND des_familia IS DISTINCT FROM 'Setup') AS disp,
    (SELECT sum(tempo_parada) FROM s WHERE s.cod_estabelecimento = k.cod_estabelecimento AND s.cod_maquina = k.cod_maquina AND des_familia = 'Setup') AS setup,
    coalesce((SELECT sum(soma_ganho_ciclo + soma_perda_ciclo) FROM c WHERE c.cod_estabelecimento = k.cod_estabelecimento AND c.cod_maquina = k.cod_maquina), 0)
      + coalesce((SELECT sum(tempo_perda) FROM p WHERE p.cod_estabelecimento = k.cod_estabelecimento AND p.cod_maquina = k.cod_maquina), 0) AS perf,
    (SELECT sum(tempo_apontamento) FROM q WHERE q.cod_estabelecimento = k.cod_estabelecimento AND q.cod_maquina = k.cod_maquina) AS qual
  FROM k)
SELECT cod_estabelecimento, cod_maquina, CAST(util AS BIGINT) AS segundos_uteis, round(coalesce(CAST(disp AS DOUBLE) / nullif(util, 0), 0), 6) AS pct_disponibilidade,
       round(coalesce(CAST(setup AS DOUBLE) / nullif(util, 0), 0), 6) AS pct_setup, round(coalesce(CAST(perf AS DOUBLE) / nullif(util, 0), 0), 6) AS pct_performance,
       round(coalesce(CAST(qual AS DOUBLE) / nullif(util, 0), 0), 6) AS pct_qualidade,
       round(1 - coalesce(CAST(disp AS DOUBLE) / nullif(util, 0), 0) - coalesce(CAST(setup AS DOUBLE) / nullif(util, 0), 0)
             - coalesce(CAST(perf AS DOUBLE) / nullif(util, 0), 0) - coalesce(CAST(qual AS DOUBLE) / nullif(util, 0), 0), 6) AS pct_oee
FROM m"""
