"""SQL twins of the table-maintenance queries: merges as three unioned sets."""

from __future__ import annotations

from workload.oracle_roles import CTES, with_roles

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
OLD = "TIMESTAMP '2024-01-01 00:00:00'"
NEW_ID = "CASE WHEN {k} % 10 < 2 THEN {k} + 1000000000 ELSE {k} END"


def merged(
    t: str, s: str, keys: list[str], shared: list[str], own: dict[str, tuple[str, str, str]] | None = None, *,
    changed: str | None = None, missing: str = "keep", where: str = "true", audit: str | None = "data_atualizacao_db",
) -> str:
    """``own``: target-only column -> (value when matched, when inserted, when missing)."""
    on = " AND ".join(f"s.{k} = t.{k}" for k in keys)
    own = own or {}
    if changed is None:
        changed = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in shared)
    key_list = ", ".join(f"t.{k}" for k in keys)
    hit = ", ".join([f"CASE WHEN chg THEN s.{c} ELSE t.{c} END AS {c}" for c in shared] + [f"CASE WHEN chg THEN {v[0]} ELSE t.{c} END AS {c}" for c, v in own.items()])
    new = ", ".join([f"s.{c}" for c in shared] + [f"{v[1]} AS {c}" for c, v in own.items()])
    old = ", ".join([f"t.{c}" for c in shared] + [f"t.{c}" for c in own])
    gone = ", ".join([f"t.{c}" for c in shared] + [f"{v[2]} AS {c}" for c, v in own.items()])
    aud = [f", CASE WHEN chg THEN {AS_OF} ELSE t.{audit} END AS {audit}", f", {AS_OF}", f", t.{audit}"] if audit else ["", "", ""]
    sets = [
        f"SELECT {key_list}, {hit}{aud[0]} FROM (SELECT t.*, ({changed}) AS chg FROM {t} t JOIN {s} s ON {on}) t JOIN {s} s ON {on}",
        f"SELECT {', '.join('s.' + k for k in keys)}, {new}{aud[1]} FROM {s} s WHERE NOT EXISTS (SELECT 1 FROM {t} t WHERE {on})",
    ]
    absent = f"NOT EXISTS (SELECT 1 FROM {s} s WHERE {on})"
    scope = f"coalesce({where}, false)"
    if missing == "keep":
        sets.append(f"SELECT {key_list}, {old}{aud[2]} FROM {t} t WHERE {absent}")
    else:
        sets.append(f"SELECT {key_list}, {old}{aud[2]} FROM {t} t WHERE {absent} AND NOT {scope}")
    if missing == "update":
        sets.append(f"SELECT {key_list}, {gone}{aud[1]} FROM {t} t WHERE {absent} AND {scope}")
    return "\nUNION ALL\n".join(sets)


STOP_COLUMNS = (
    "maquina_id codigo data_hora_inicio data_hora_fim tempo turno status programa documento numero_produto id_grupo "
    "ref_matriz ferramental cracha_apoio cracha_preparador cracha_lider"
).split()
POINT_COLUMNS = {
    "quality": "valor ciclo pares_batida turno programa documento numero_produto maquina_id_origem".split(),
    "performance": "valor ciclo turno programa documento numero_produto cracha_preparador cracha_lider".split(),
}
RUN_COLUMNS = "id_equipamento numero_produto programa documento data_inicio data_fim ciclo pares_batidas".split()


def window(a: str, b: str | None, days: int, t: str = "t.") -> str:
    limit = f"{AS_OF} - INTERVAL {days} DAY"
    one = f"{t}{a} >= {limit}"
    return f"({one} OR {t}{b} >= {limit})" if b else one


STOP_STATE = {
    "tgt": f"SELECT * REPLACE (CASE WHEN id % 7 = 0 THEN tempo + 1 ELSE tempo END AS tempo, CASE WHEN id % 11 = 0 THEN NULL ELSE numero_produto END AS numero_produto), {OLD} AS data_atualizacao_db FROM stops",
    "src": f"SELECT * REPLACE ({NEW_ID.format(k='id')} AS id) FROM stops",
}
STOP_CHANGED = " OR ".join([f"t.{c} IS DISTINCT FROM s.{c}" for c in STOP_COLUMNS] + ["t.data_hora_fim IS NULL"])

# Of two copies the later end wins; without an end the smaller status does.
STAGED_STOPS = with_roles(
    "SELECT * REPLACE (data_hora_fim + INTERVAL 60 SECOND AS data_hora_fim, CASE WHEN data_hora_fim IS NULL THEN status ELSE status + 1 END AS status) FROM stops"
)

MERGED_STOPS = with_roles(
    merged("tgt", "src", ["id_estabelecimento", "id"], STOP_COLUMNS, changed=STOP_CHANGED, missing="delete",
           where=window("data_hora_inicio", "data_hora_fim", 15)),
    **STOP_STATE,
)

BACKFILLED_STOPS = with_roles(
    merged("tgt", "src", ["id_estabelecimento", "id"], STOP_COLUMNS, changed=STOP_CHANGED, missing="delete",
           where="""(t.data_hora_inicio BETWEEN TIMESTAMP '2024-01-10 05:24:00' AND TIMESTAMP '2024-01-12 05:24:00'
                  OR t.data_hora_fim BETWEEN TIMESTAMP '2024-01-10 05:24:00' AND TIMESTAMP '2024-01-12 05:24:00'
                  OR (t.data_hora_inicio < TIMESTAMP '2024-01-10 05:24:00' AND t.data_hora_fim > TIMESTAMP '2024-01-12 05:24:00'))"""),
    **STOP_STATE,
)


def merged_points(kind: str) -> str:
    return with_roles(
        merged("tgt", "src", ["id_estabelecimento", "data_hora", "maquina_id", "codigo"], POINT_COLUMNS[kind],
               missing="delete", where=window("data_hora", None, 15)),
        src=f"SELECT * EXCLUDE (rn) REPLACE (maquina_id + CASE WHEN documento = 1 AND programa = 1002 THEN 3000000 ELSE 0 END AS maquina_id) FROM (SELECT *, row_number() OVER (PARTITION BY id_estabelecimento, data_hora, maquina_id, codigo ORDER BY {', '.join(POINT_COLUMNS[kind])}) AS rn FROM {kind}) WHERE rn = 1",
        tgt=f"SELECT * EXCLUDE (rn) REPLACE (CASE WHEN programa = 1001 THEN valor + 1 ELSE valor END AS valor), {OLD} AS data_atualizacao_db FROM (SELECT *, row_number() OVER (PARTITION BY id_estabelecimento, data_hora, maquina_id, codigo ORDER BY {', '.join(POINT_COLUMNS[kind])}) AS rn FROM {kind}) WHERE rn = 1",
    )


MERGED_RUNS = with_roles(
    merged("tgt", "src", ["id_estabelecimento", "id"], RUN_COLUMNS, missing="delete", where=window("data_inicio", "data_fim", 15)),
    tgt=f"SELECT * REPLACE (coalesce(data_fim, {OLD}) AS data_fim), {OLD} AS data_atualizacao_db FROM runs",
    src=f"SELECT * REPLACE (CASE WHEN abs(id) % 10 < 2 THEN id + 1000000000 ELSE id END AS id, coalesce(data_fim, {AS_OF}) AS data_fim) FROM runs",
)

CYCLE_COLUMNS = "ciclo_atual ciclo_ti diferenca turno programa documento numero_produto".split()
# Even machines are up to date in the target, odd ones miss the last days.
CYCLE_STATE = {
    "uniq": "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id_estabelecimento, id_equipamento, data_hora ORDER BY ciclo_atual, turno, programa, documento, numero_produto) AS rn FROM cycles) WHERE rn = 1",
    "tgt": f"SELECT * REPLACE (CASE WHEN programa = 1001 THEN ciclo_atual + 1 ELSE ciclo_atual END AS ciclo_atual), {OLD} AS data_atualizacao_db FROM uniq WHERE id_equipamento % 2 = 0 OR data_hora < TIMESTAMP '2024-01-25 00:00:00'",
    "fresh": """SELECT s.id_estabelecimento, s.id_equipamento FROM (SELECT id_estabelecimento, id_equipamento, max(data_hora) AS m FROM uniq GROUP BY ALL) s
                LEFT JOIN (SELECT id_estabelecimento, id_equipamento, max(data_hora) AS m FROM tgt GROUP BY ALL) t USING (id_estabelecimento, id_equipamento)
                WHERE t.m IS NULL OR s.m > t.m""",
    "src": f"SELECT * FROM uniq JOIN fresh USING (id_estabelecimento, id_equipamento) WHERE data_hora >= {AS_OF} - INTERVAL 10 DAY AND data_hora < {AS_OF} AND documento * 3 + programa <> 1003",
}
NEW_CYCLES = with_roles("SELECT * FROM src", **CYCLE_STATE)
MERGED_CYCLES = with_roles(
    merged("tgt", "src", ["id_estabelecimento", "id_equipamento", "data_hora"], CYCLE_COLUMNS, missing="delete",
           where="t.data_hora >= (SELECT min(data_hora) FROM src) AND (t.id_estabelecimento, t.id_equipamento) IN (SELECT (id_estabelecimento, id_equipamento) FROM src)"),
    **CYCLE_STATE,
)

MERGED_MACHINES = with_roles(
    merged("tgt", "src", ["id_estabelecimento", "id"], ["id_setor", "nome", "descricao"],
           {"ativo": ("true", "true", "false"), "data_desativacao": ("NULL", "NULL", f"coalesce(t.data_desativacao, {AS_OF})")},
           changed="true", missing="update", where="t.data_desativacao IS NULL"),
    tgt=f"SELECT *, id % 20 <> 0 AS ativo, CASE WHEN id % 20 IN (0, 2) THEN {OLD} END AS data_desativacao, {OLD} AS data_atualizacao_db FROM machines",
    src=f"SELECT * REPLACE ({NEW_ID.format(k='id')} AS id) FROM machines",
)

MERGED_SECTORS = with_roles(
    merged("tgt", "src", ["id_estabelecimento", "id"], ["descricao", "id_fabrica"], {"ativo": ("true", "true", "false")},
           changed="true", missing="update"),
    tgt=f"SELECT *, id % 5 <> 0 AS ativo, {OLD} AS data_atualizacao_db FROM sectors",
    src=f"SELECT * REPLACE ({NEW_ID.format(k='id')} AS id) FROM sectors",
)

CALLS = """
    SELECT id_estabelecimento, id, data_hora_inicio, data_hora_fim, codigo, maquina_id, status, tempo, cracha_preparador, cracha_lider FROM stops"""
CALL_STATE = {
    "calls": CALLS,
    "ctgt": f"SELECT * REPLACE (tempo + 1 AS tempo), {OLD} AS data_atualizacao_db FROM calls",
}
RELOADED_CALLS = with_roles(
    f"""
SELECT * FROM ctgt WHERE NOT coalesce({window("data_hora_inicio", "data_hora_fim", 10, "")}, false)
UNION ALL BY NAME
SELECT *, {AS_OF} AS data_atualizacao_db FROM calls WHERE {window("data_hora_inicio", "data_hora_fim", 10, "")}""",
    **CALL_STATE,
)

SNAPSHOT = """
WITH tgt AS (SELECT 'E' || CAST(s_suppkey AS VARCHAR) AS equipamento, CAST(d AS DATE) AS data, 'B' || CAST(s_nationkey % 3 AS VARCHAR) AS segmentacao,
                    TIMESTAMP '2024-01-01 00:00:00' AS updated_at
             FROM supplier, (VALUES (DATE '2024-01-29'), (DATE '2024-01-30')) AS v(d)),
cur AS (SELECT 'E' || CAST(s_suppkey + CASE WHEN s_suppkey % 10 = 0 THEN 1000000000 ELSE 0 END AS VARCHAR) AS equipamento, 'A' || CAST(s_nationkey % 3 AS VARCHAR) AS segmentacao FROM supplier)
SELECT * FROM tgt WHERE NOT (data = DATE '2024-01-30' AND equipamento IN (SELECT equipamento FROM cur))
UNION ALL SELECT equipamento, DATE '2024-01-30', segmentacao, TIMESTAMP '2024-01-31 00:00:00' FROM cur"""

LATEST_LINES = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, l_partkey, l_suppkey,
        l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem) WHERE rn = 1"""

# --- gold --------------------------------------------------------------------------------

PLACE = {
    "place": """
        SELECT m.id_estabelecimento, m.id AS maquina_id, m.nome AS nome_equipamento, m.id_setor, s.descricao AS setor, s.id_fabrica, f.descricao AS fabrica
        FROM machines m LEFT JOIN sectors s ON s.id_estabelecimento = m.id_estabelecimento AND s.id = m.id_setor
        LEFT JOIN factories f ON f.id_estabelecimento = s.id_estabelecimento AND f.id = s.id_fabrica""",
    "groups": "SELECT * FROM (VALUES (1, 'Produção'), (2, 'Manutenção'), (3, 'Matrizaria'), (4, 'Tingimento'), (5, 'Setup')) AS g(id, descricao)",
    "setup_reasons": "SELECT id_estabelecimento, codigo, CASE codigo WHEN 504 THEN 'Troca de Material' WHEN 302 THEN 'Reparo' END AS tipo_setup FROM reasons",
}
GOLD_STOP_ROWS = f"""
    SELECT s.id_estabelecimento, s.id AS id_parada, s.data_hora_inicio, coalesce(s.data_hora_fim, {AS_OF}) AS data_hora_fim, s.tempo, s.codigo,
           r.descricao, s.numero_produto, f.descricao AS familia,
           CASE WHEN t.tipo IS NOT NULL OR s.codigo IN (100, 107) THEN 'Setup' ELSE g.descricao END AS familia_agrupada,
           CASE WHEN r.descricao LIKE '%Aguardando%' AND g.descricao = 'Matrizaria' THEN 'Aguardando Matrizaria'
                WHEN r.descricao NOT LIKE '%Aguardando%' AND g.descricao = 'Matrizaria' THEN 'Reparo Matrizaria'
                WHEN r.descricao LIKE '%Aguardando%' AND g.descricao = 'Manutenção' THEN 'Aguardando Manutenção'
                WHEN r.descricao NOT LIKE '%Aguardando%' AND g.descricao = 'Manutenção' THEN 'Reparo Manutenção' END AS tipo,
           s.status, s.turno, r.peso_oee,
           CASE WHEN s.id_grupo IS NULL AND s.codigo IN (100, 107)
                THEN left(md5(CAST(s.id_estabelecimento AS VARCHAR) || CAST(s.id AS VARCHAR) || CAST(s.maquina_id AS VARCHAR)), 8)
                ELSE CAST(s.id_grupo AS VARCHAR) END AS id_grupo,
           coalesce(t.tipo, CASE s.codigo WHEN 100 THEN 'Setup de Cor' WHEN 107 THEN 'Setup de Matriz' END) AS tipo_setup,
           s.maquina_id AS id_equipamento, p.nome_equipamento, s.documento, s.programa, p.fabrica, p.setor, s.ferramental, s.ref_matriz,
           s.cracha_apoio, s.cracha_preparador, s.cracha_lider
    FROM stops s JOIN place p USING (id_estabelecimento, maquina_id) JOIN reasons r USING (id_estabelecimento, codigo)
    JOIN families f ON f.id_estabelecimento = r.id_estabelecimento AND f.id = r.id_familia
    LEFT JOIN groups g ON g.id = f.id_familia_agrupada
    LEFT JOIN (SELECT s.id_estabelecimento, s.id_grupo, max(x.tipo_setup) AS tipo FROM stops s JOIN setup_reasons x USING (id_estabelecimento, codigo)
               WHERE s.id_grupo > 0 AND {window("data_hora_inicio", "data_hora_fim", 90, "s.")} GROUP BY ALL) t
      ON t.id_estabelecimento = s.id_estabelecimento AND t.id_grupo = s.id_grupo
    WHERE {window("data_hora_inicio", "data_hora_fim", 90, "s.")}"""
GOLD_STOPS = with_roles(GOLD_STOP_ROWS, **PLACE)

GOLD_QUALITY_ROWS = f"""
    SELECT q.id_estabelecimento, q.data_hora, q.codigo, r.descricao, r.peso_oee, q.maquina_id AS id_equipamento, p.nome_equipamento, p.setor, p.fabrica,
           q.ciclo, q.valor, q.pares_batida, (q.ciclo * q.valor) / q.pares_batida AS tempo_perda_qualidade, q.turno, q.numero_produto, q.programa,
           q.documento, q.maquina_id_origem, o.nome AS nome_equipamento_origem
    FROM quality q LEFT JOIN reasons r USING (id_estabelecimento, codigo) LEFT JOIN place p USING (id_estabelecimento, maquina_id)
    LEFT JOIN machines o ON o.id_estabelecimento = q.id_estabelecimento AND o.id = q.maquina_id_origem
    WHERE {window("data_hora", None, 90, "q.")}"""
GOLD_QUALITY = with_roles(f"SELECT * REPLACE (round(tempo_perda_qualidade, 6) AS tempo_perda_qualidade) FROM ({GOLD_QUALITY_ROWS})", **PLACE)

GOLD_PERFORMANCE_ROWS = f"""
    SELECT q.id_estabelecimento, q.data_hora, q.codigo, r.descricao, r.peso_oee, q.maquina_id AS id_equipamento, p.nome_equipamento, p.setor, p.fabrica,
           round(q.ciclo, 6) AS ciclo, q.valor, round(q.ciclo * q.valor, 6) AS tempo_perda_performance, q.turno, q.numero_produto, q.programa, q.documento,
           q.cracha_preparador, q.cracha_lider
    FROM performance q LEFT JOIN reasons r USING (id_estabelecimento, codigo) LEFT JOIN place p USING (id_estabelecimento, maquina_id)
    WHERE {window("data_hora", None, 90, "q.")}"""
GOLD_PERFORMANCE = with_roles(GOLD_PERFORMANCE_ROWS, **PLACE)

GOLD_CALLS = with_roles(
    f"""
SELECT a.id_estabelecimento, a.id, a.data_hora_inicio, a.data_hora_fim, a.tempo, a.status, a.codigo, r.descricao AS descricao_motivo,
       f.descricao AS familia, r.peso_oee, a.maquina_id, p.nome_equipamento, p.id_setor, p.setor, p.id_fabrica, p.fabrica, a.cracha_preparador, a.cracha_lider
FROM calls a LEFT JOIN reasons r USING (id_estabelecimento, codigo) LEFT JOIN place p USING (id_estabelecimento, maquina_id)
LEFT JOIN families f ON f.id_estabelecimento = r.id_estabelecimento AND f.id = r.id_familia
WHERE {window("data_hora_inicio", "data_hora_fim", 90, "a.")}""",
    **PLACE, calls=CALLS,
)
GOLD_MACHINES = with_roles(
    """SELECT m.id_estabelecimento, m.id, m.nome, m.descricao, p.id_fabrica, p.fabrica, p.id_setor, p.setor
       FROM machines m JOIN place p ON p.id_estabelecimento = m.id_estabelecimento AND p.maquina_id = m.id""",
    **PLACE,
)

GOLD_STOP_SHARED = (
    "data_hora_inicio data_hora_fim tempo codigo descricao numero_produto familia familia_agrupada tipo status turno peso_oee id_grupo tipo_setup "
    "id_equipamento nome_equipamento documento programa fabrica setor ferramental ref_matriz cracha_apoio cracha_preparador cracha_lider"
).split()
MERGED_GOLD_STOPS = with_roles(
    merged("gtgt", "gsrc", ["id_estabelecimento", "id_parada"], GOLD_STOP_SHARED, missing="delete", where=window("data_hora_inicio", "data_hora_fim", 15)),
    **PLACE,
    grows=GOLD_STOP_ROWS,
    gtgt=f"SELECT * REPLACE (CASE WHEN id_parada % 7 = 0 THEN NULL ELSE descricao END AS descricao), {OLD} AS data_atualizacao_db FROM grows",
    gsrc=f"SELECT * REPLACE ({NEW_ID.format(k='id_parada')} AS id_parada) FROM grows",
)

GOLD_QUALITY_SHARED = (
    "descricao peso_oee nome_equipamento setor fabrica ciclo valor pares_batida tempo_perda_qualidade turno numero_produto programa documento "
    "maquina_id_origem nome_equipamento_origem"
).split()
MERGED_GOLD_QUALITY = with_roles(
    "SELECT * REPLACE (round(tempo_perda_qualidade, 6) AS tempo_perda_qualidade) FROM ("
    + merged("gtgt", "gsrc", ["id_estabelecimento", "id_equipamento", "data_hora", "codigo"], GOLD_QUALITY_SHARED, changed="true", missing="delete",
             where=window("data_hora", None, 15))
    + ")",
    **PLACE,
    grows=GOLD_QUALITY_ROWS,
    gtgt=f"SELECT * REPLACE (0 AS valor), {OLD} AS data_atualizacao_db FROM grows",
    gsrc="SELECT * REPLACE (id_equipamento + CASE WHEN documento = 1 AND programa = 1002 THEN 3000000 ELSE 0 END AS id_equipamento) FROM grows",
)
