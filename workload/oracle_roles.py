"""The roles as DuckDB common table expressions (same expressions as in ``roles``)."""

from __future__ import annotations

from workload.roles import FAMILIES, REASONS, SCHEDULES


def _values(rows) -> str:
    def lit(v):
        return str(v) if isinstance(v, int) else f"'{v}'"

    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


def plant(key: str) -> str:
    return f"CASE {key} % 3 WHEN 0 THEN 20 WHEN 1 THEN 21 ELSE 40 END"


def later(ts: str, minutes: str) -> str:
    return f"{ts} + to_milliseconds(CAST(round(({minutes}) * 60000) AS BIGINT))"


PLANTS = "(VALUES (20), (21), (40)) AS p(id_estabelecimento)"

CTES = {
    "machines": f"""
        SELECT {plant("c_custkey")} AS id_estabelecimento, c_custkey AS id, c_nationkey AS id_setor,
               c_name AS nome, c_mktsegment AS descricao
        FROM customer""",
    "sectors": f"SELECT p.id_estabelecimento, n_nationkey AS id, n_name AS descricao, n_regionkey AS id_fabrica FROM nation, {PLANTS}",
    "factories": f"SELECT p.id_estabelecimento, r_regionkey AS id, r_name AS descricao FROM region, {PLANTS}",
    "schedules": f"""
        SELECT p.id_estabelecimento, s.nome, CAST(i1 AS TIME) AS i1, CAST(f1 AS TIME) AS f1, CAST(i2 AS TIME) AS i2,
               CAST(f2 AS TIME) AS f2, CAST(i3 AS TIME) AS i3, CAST(f3 AS TIME) AS f3
        FROM (VALUES {_values(SCHEDULES)}) AS s(nome, i1, f1, i2, f2, i3, f3), {PLANTS}""",
    "hours": """
        SELECT s.id_estabelecimento, s.id AS id_setor, h.i1, h.f1, h.i2, h.f2, h.i3, h.f3
        FROM sectors s LEFT JOIN schedules h
          ON h.id_estabelecimento = s.id_estabelecimento
         AND h.nome = CASE WHEN s.id = 24 THEN 'nenhum' ELSE 'H' || CAST(s.id % 3 AS VARCHAR) END""",
    "reasons": f"""
        SELECT p.id_estabelecimento, r.codigo, r.descricao, r.peso_oee, r.id_familia
        FROM (VALUES {_values(REASONS)}) AS r(event_type, codigo, descricao, peso_oee, id_familia), {PLANTS}""",
    "families": f"""
        SELECT p.id_estabelecimento, f.id, f.descricao, f.id_familia_agrupada
        FROM (VALUES {_values(FAMILIES)}) AS f(id, descricao, id_familia_agrupada), {PLANTS}""",
    "ev": f"""
        SELECT {plant("user_id")} AS id_estabelecimento, event_id AS id, user_id AS maquina_id, r.codigo,
               ts AS data_hora, value, json_extract_string(props, '$.k') AS numero_produto,
               'Turno ' || CAST(event_id % 3 + 1 AS VARCHAR) AS turno, event_id % 3 + 1000 AS programa,
               event_id % 2 AS documento
        FROM events LEFT JOIN (VALUES {_values(REASONS)}) AS r(kind, codigo, descricao, peso, familia) ON r.kind = event_type""",
    "stops": f"""
        SELECT id_estabelecimento, id, maquina_id, codigo, data_hora AS data_hora_inicio,
               CASE WHEN id % 97 <> 0 THEN {later("data_hora", "value")} END AS data_hora_fim,
               CASE WHEN id % 5 = 1 THEN 1 ELSE CAST(round(value) AS INT) END AS tempo, turno,
               CAST(id % 5 AS INT) AS status, programa, documento, numero_produto,
               CASE WHEN id % 2 = 1 THEN id // 10 END AS id_grupo,
               'F' || CAST(id % 7 AS VARCHAR) AS ferramental, 'R' || CAST(id % 4 AS VARCHAR) AS ref_matriz,
               CASE WHEN id % 3 = 0 THEN id % 11 END AS cracha_apoio, id % 13 AS cracha_preparador, id % 17 AS cracha_lider
        FROM ev""",
    "runs": f"""
        SELECT id_estabelecimento, id, maquina_id AS id_equipamento, numero_produto, programa, documento,
               data_hora AS data_inicio,
               CASE WHEN id % 89 <> 0 THEN {later("data_hora", "value * 2.5")} END AS data_fim,
               value / 10 AS ciclo, id % 4 + 1 AS pares_batidas
        FROM ev
        UNION ALL
        SELECT id_estabelecimento, -id - 1, maquina_id, numero_produto, programa, documento,
               data_hora + to_milliseconds(100), NULL, value / 10, id % 4 + 1
        FROM ev WHERE id % 50 = 0""",
    "cycles": """
        SELECT id_estabelecimento, maquina_id AS id_equipamento, data_hora, value AS ciclo_atual, 245.0 AS ciclo_ti,
               CASE WHEN id % 53 <> 0 THEN round(value - 245, 2) END AS diferenca, turno, programa, documento, numero_produto
        FROM ev""",
    "quality": """
        SELECT id_estabelecimento, data_hora, codigo, id % 3 + 1 AS valor, maquina_id, value AS ciclo,
               id % 4 + 1 AS pares_batida, turno, programa, documento, numero_produto,
               maquina_id + CASE WHEN id % 2 = 0 THEN 3 ELSE 3000000 END AS maquina_id_origem
        FROM ev""",
    "performance": """
        SELECT id_estabelecimento, data_hora, codigo, id % 5 AS valor, maquina_id, value / 10 AS ciclo, turno, programa,
               documento, numero_produto, id % 13 AS cracha_preparador, id % 17 AS cracha_lider
        FROM ev""",
}


def with_roles(sql: str, **extra: str) -> str:
    """Prefix a query with all role CTEs and the given extra ones."""
    parts = CTES | extra
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in parts.items()) + "\n" + sql
