"""SQL twins of the landing queries; they state the expected values without any JSON or date parsing."""

from __future__ import annotations

from workload.oracle_roles import with_roles

_EV = "(SELECT *, event_id // 2 AS n FROM events)"
_WEB = f"FROM {_EV} WHERE event_id % 2 = 0 AND n % 3 <> 2"

EVENTS = f"""
SELECT CAST(event_id AS VARCHAR) AS id_log, ts AS data_criacao, ts AS atualizado_em, 'E' || CAST(n % 7 AS VARCHAR) AS estabelecimento, event_type AS mercado,
       'P' || CAST(n AS VARCHAR) AS produto, CAST(n % 100 AS INTEGER) AS cod_estabelecimento, CAST(n % 50 AS INTEGER) AS qtde_eliminar,
       CAST(n % 40 AS DOUBLE) / 4 AS valor_residual, CAST(ts AS DATE) AS data_limite_analise, 'N' || CAST(n % 13 AS VARCHAR) AS numero_processo
{_WEB} AND n % 10 <> 0"""
SKUS = f"""
SELECT CAST(event_id AS VARCHAR) AS log_id, 'S' || CAST(i AS VARCHAR) AS sku, event_type AS status, i * 0.5::DOUBLE AS qtdcif, 'F' || CAST(n % 3 AS VARCHAR) AS fabrica
FROM (SELECT *, unnest(range(1, n % 4 + 1)) AS i {_WEB})"""
RELATED = f"""
SELECT CAST(event_id AS VARCHAR) AS log_id, 'E' || CAST(n % 7 AS VARCHAR) AS estabelecimento, 'R' || CAST(i AS VARCHAR) AS cod_produto
FROM (SELECT *, unnest(range(1, n % 3 + 1)) AS i {_WEB})"""
AREAS = f"""
SELECT CAST(event_id AS VARCHAR) AS id, ts AS data_criacao, ts AS atualizado_em, event_type AS status, 'K' || CAST(p AS VARCHAR) AS id_flake,
       'U' || CAST(n % 5 AS VARCHAR) AS cod_usuario, 'A' || CAST(f AS VARCHAR) AS des_area, CASE WHEN f IS NOT NULL THEN CAST(ts AS DATE) END AS data_reserva,
       'S' || CAST(k AS VARCHAR) AS cod_sku, 'ab-' || CAST(n % 9 AS VARCHAR) || 'f' AS webhook_node_id
FROM (SELECT *, unnest(CASE WHEN n % 4 = 0 OR f IS NULL THEN [NULL] ELSE range(1, n % 4 + 1) END) AS k
      FROM (SELECT *, unnest(CASE WHEN n % 3 = 0 THEN [NULL] ELSE range(1, n % 3 + 1) END) AS f
            FROM (SELECT *, unnest(range(1, n % 2 + 2)) AS p FROM {_EV} WHERE event_id % 2 = 1 AND n % 3 <> 2 AND n % 5 <> 0 AND n % 11 <> 0)))"""

_CREATED = "(o_orderdate + INTERVAL 300 MONTH + to_hours(CAST(o_orderkey % 24 AS INTEGER)))"
DATES = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 17 <> 0 THEN {_CREATED} + INTERVAL 1 HOUR END AS dt_aprovacao_eng,
       {_CREATED} + INTERVAL 2 HOUR AS dt_aprovacao_analista, {_CREATED} AS Created, {_CREATED} + INTERVAL 2 HOUR AS Modified,
       CAST(CAST({_CREATED} AS DATE) AS TIMESTAMP) AS dt_fap
FROM orders"""
SHAPES = """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 16 IN (0, 7, 8, 9, 10) THEN m WHEN o_orderkey % 16 = 11 THEN m + INTERVAL 3 HOUR
       WHEN o_orderkey % 16 = 3 THEN date_trunc('minute', m) WHEN o_orderkey % 16 < 14 THEN date_trunc('day', m) END AS lido,
       CAST(NULL AS TIMESTAMP) AS vazio
FROM (SELECT *, o_orderdate + INTERVAL 300 MONTH + to_seconds(o_orderkey % 86399) AS m FROM orders)"""
TYPED = """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 <> 0 THEN round(o_totalprice, 2) END AS valor,
       CASE o_orderkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS ativo, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 100 AS INTEGER) END AS cracha
FROM orders"""
RECENT = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS id, {_CREATED} + INTERVAL 2 HOUR AS Modified FROM orders
WHERE {_CREATED} + INTERVAL 2 HOUR >= TIMESTAMP '2026-08-01' - INTERVAL 90 DAY"""
LAST_IDS = "SELECT * FROM orders WHERE o_orderkey >= (SELECT max(o_orderkey) FROM orders) - 1000"
_LO, _HI = "TIMESTAMP '2024-01-10 05:24:00'", "TIMESTAMP '2024-01-12 05:24:00'"
BACKFILL = with_roles(
    f"""SELECT id, data_hora_inicio, data_hora_fim FROM stops WHERE data_hora_inicio BETWEEN {_LO} AND {_HI} OR data_hora_fim BETWEEN {_LO} AND {_HI}
        OR (data_hora_inicio < {_LO} AND data_hora_fim > {_HI})"""
)
QUALITY = """
WITH f AS (
  SELECT 'unique:l_orderkey,l_linenumber' AS teste, 'error' AS sev, (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS falhas
  UNION ALL SELECT 'unique:o_orderkey', 'error', (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1))
  UNION ALL SELECT 'not_null:l_partkey', 'warn', (SELECT count(*) FROM lineitem WHERE l_partkey IS NULL)
  UNION ALL SELECT 'accepted_values:l_returnflag', 'warn', (SELECT count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N'))
  UNION ALL SELECT 'accepted_range:l_quantity', 'warn', (SELECT count(*) FROM lineitem WHERE l_quantity < 5)
  UNION ALL SELECT 'relationships:user_id', 'warn', (SELECT count(*) FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)))
SELECT teste, falhas, CASE WHEN falhas > 0 THEN sev ELSE 'pass' END AS situacao FROM f"""
CHECKED = """
WITH b AS (SELECT 1 AS lote, * FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT 2, * FROM orders), f AS (
  SELECT lote, 'not_null:o_orderkey' AS teste, count(*) FILTER (o_orderkey IS NULL) AS falhas FROM b GROUP BY lote
  UNION ALL SELECT lote, 'accepted_values:o_orderstatus', count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) FROM b GROUP BY lote
  UNION ALL SELECT lote, 'accepted_range:o_totalprice', count(*) FILTER (o_totalprice < 0) FROM b GROUP BY lote)
SELECT teste, falhas, CASE WHEN falhas > 0 THEN 'error' ELSE 'pass' END AS situacao, lote FROM f
UNION ALL SELECT 'linhas', count(*), '2024-01-01', 0 FROM orders WHERE o_orderstatus <> 'P'"""
FRESHNESS = """
SELECT 'freshness:ts' AS teste, m AS ultima_carga, date_diff('second', m, TIMESTAMP '2024-02-03') AS atraso_segundos,
       CASE WHEN date_diff('second', m, TIMESTAMP '2024-02-03') > 7 * 86400 THEN 'error' WHEN date_diff('second', m, TIMESTAMP '2024-02-03') > 2 * 86400 THEN 'warn' ELSE 'pass' END AS situacao
FROM (SELECT max(ts) AS m FROM events)"""
COMPLETENESS = """
SELECT c_custkey AS user_id, coalesce(a, 0) AS iniciadas, coalesce(b, 0) AS terminadas,
       CASE WHEN coalesce(a, 0) = 0 THEN 'missing' WHEN b = 0 THEN 'pending' ELSE 'ok' END AS situacao
FROM customer LEFT JOIN (SELECT user_id, count(*) AS a, count(CASE WHEN event_id % 4 <> 0 THEN 1 END) AS b FROM events
                         WHERE ts BETWEEN TIMESTAMP '2024-01-30' AND TIMESTAMP '2024-01-31' GROUP BY ALL) e ON e.user_id = c_custkey"""
PLANT_FILES = with_roles(
    "SELECT id_estabelecimento, id, maquina_id, codigo, data_hora_inicio, CASE WHEN id_estabelecimento <> 40 THEN ferramental END AS ferramental FROM stops"
)
KEYED = "SELECT CAST(user_id % 10 AS INTEGER) AS id_equipamento, ts AS data_hora, value AS ciclo_atual FROM events WHERE user_id % 10 <> 0"
CSV = "SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders"

# The newest state of a key, whatever its month; rows without a key are inserted.
MONTHS = """
WITH tgt AS (
  SELECT o_orderkey AS id, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate END AS dia, o_totalprice AS valor FROM orders
), src AS (
  SELECT CASE WHEN o_orderkey % 10 < 2 THEN o_orderkey + 1000000000 WHEN o_orderkey % 17 <> 0 THEN o_orderkey END AS id,
         CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate + INTERVAL 40 DAY WHEN o_orderkey % 13 <> 1 THEN o_orderdate END AS dia,
         o_totalprice + CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS valor
  FROM orders
), merged AS (
  SELECT s.id, s.dia, s.valor,
         CASE WHEN t.id IS NOT NULL AND t.dia IS NOT DISTINCT FROM s.dia AND t.valor IS NOT DISTINCT FROM s.valor
              THEN TIMESTAMP '1995-01-01 00:00:00' ELSE TIMESTAMP '2001-09-01 00:00:00' END AS data_atualizacao_db
  FROM src s LEFT JOIN tgt t ON t.id = s.id
  UNION ALL
  SELECT t.id, t.dia, t.valor, TIMESTAMP '1995-01-01 00:00:00' FROM tgt t
  WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.id = t.id) AND NOT coalesce(t.dia >= TIMESTAMP '2000-01-01 00:00:00', false)
)
SELECT *, coalesce(strftime(dia, '%Y-%m'), 'none') AS ano_mes FROM merged"""

# The newest delivered version of each order; the stored ones that no newer version met keep their stamp.
STREAMED = """
WITH delivered AS (
  SELECT o_orderkey AS id, o_orderdate, o_totalprice,
         CASE WHEN o_orderkey % 3 = 0 THEN 2 WHEN o_orderkey % 4 = 2 OR o_orderkey % 10 = 9 THEN 1 ELSE 0 END AS versao
  FROM orders
)
SELECT id, o_orderdate + to_days(20 * versao) AS dia, versao, o_totalprice + versao AS valor,
       CASE WHEN id % 4 = 0 AND versao = 0 THEN TIMESTAMP '1995-01-01 00:00:00' ELSE TIMESTAMP '2001-09-01 00:00:00' END AS data_atualizacao_db,
       strftime(o_orderdate + to_days(20 * versao), '%Y-%m') AS ano_mes
FROM delivered"""
REFRESHED = """
SELECT o_orderkey, o_totalprice, TIMESTAMP '2024-01-03 00:00:00' AS loaded_at FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0"""
APPENDED = "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 4 < 2"
