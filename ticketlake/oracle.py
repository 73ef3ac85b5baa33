"""SQL counterparts of the registered queries, for checking results with DuckDB.

Written from the table bindings and the rules, not from the DataFrame plans.
"""

from __future__ import annotations

import datetime as dt

PROBLEMS = """
SELECT CAST(o.o_orderkey AS BIGINT) AS numero,
       'P' || substr(o.o_orderpriority, 1, 1) AS prioridade,
       'Order ' || CAST(o.o_orderkey AS VARCHAR) AS titulo,
       CAST(o.o_orderdate AS DATE) AS dt_abertura,
       CASE WHEN o.o_orderkey % 97 = 0 THEN NULL
            WHEN o.o_orderkey % 7 = 0 THEN 'Cancelado'
            WHEN o.o_orderstatus = 'F' THEN 'Resolvido'
            WHEN o.o_orderstatus = 'P' THEN 'Em andamento'
            ELSE 'Aberto' END AS status,
       CASE WHEN o.o_custkey % 13 = 0 THEN NULL ELSE n.n_name END AS gerente_responsavel,
       c.c_mktsegment AS departamento_relator,
       CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE r.r_name END AS jornada_impactada,
       'SYS' || CAST(o.o_custkey % 20 AS VARCHAR) AS sistema,
       CASE o.o_orderkey % 3 WHEN 0 THEN 'Sim' WHEN 1 THEN 'Não' ELSE NULL END AS paliativo,
       'Impact ' || CAST(o.o_orderkey % 5 AS VARCHAR) AS impacto
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""

RUNS = """
SELECT event_id AS id_log,
       'gproblemas_' || CAST(user_id AS VARCHAR) || '.xlsx' AS nm_arquivo,
       'tb_problemas_gov_ti' AS nm_tabela_destino,
       CAST(ts AS TIMESTAMP) AS dt_processamento,
       CAST(user_id + event_id % 50 AS INT) AS qt_linhas_recebidas,
       CASE WHEN event_type = 'error' THEN 0 ELSE CAST(user_id AS INT) END AS qt_linhas_inseridas,
       CASE WHEN event_type = 'error' THEN CAST(user_id + event_id % 50 AS INT)
            ELSE CAST(event_id % 50 AS INT) END AS qt_linhas_rejeitadas,
       CASE event_type WHEN 'error' THEN 'falha' WHEN 'signup' THEN 'parcial' ELSE 'sucesso' END AS ds_status,
       CAST(value AS DECIMAL(10,2)) AS tm_duracao_seg
FROM events
"""

LINES = """
SELECT CAST(ts AS DATE) AS log_file,
       row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) AS line_no,
       CASE event_type
         WHEN 'error'  THEN substr(CAST(ts AS VARCHAR), 1, 19) || ',123 ERROR mod.user' || CAST(user_id AS VARCHAR) || ' :: failure ' || props
         WHEN 'signup' THEN substr(CAST(ts AS VARCHAR), 1, 19) || ',123 WARN mod.query :: slow SQL ' || props
         WHEN 'purchase' THEN substr(CAST(ts AS VARCHAR), 1, 19) || ',123 WARN mod.cache :: evicted ' || props
         WHEN 'click'  THEN '    at com.example.Call' || CAST(event_id AS VARCHAR)
         ELSE 'Caused by: reason ' || CAST(event_id AS VARCHAR) END AS line
FROM events
"""

# Landing files as text, before any cleaning.
LANDING = f"""
SELECT numero AS n,
       CASE WHEN numero % 17 = 0 THEN 'abc'
            WHEN numero % 19 = 0 THEN CAST(numero AS VARCHAR) || '.7'
            ELSE CAST(numero AS VARCHAR) END AS chave,
       CASE WHEN numero % 23 = 0 THEN 'foo'
            WHEN numero % 3 = 0 THEN strftime(dt_abertura, '%m/%d/%Y')
            WHEN numero % 3 = 1 THEN CAST(dt_abertura AS VARCHAR) || ' 00:00:00'
            ELSE CAST(dt_abertura AS VARCHAR) END AS abertura,
       CASE numero % 5 WHEN 0 THEN chr(9) || '10/05 ' WHEN 1 THEN 'nan' WHEN 2 THEN ' NaT '
            WHEN 3 THEN 'sem data' END AS conclusao,
       prioridade, titulo, status, gerente_responsavel, departamento_relator, jornada_impactada,
       sistema, paliativo,
       CASE WHEN numero % 29 = 0 THEN 'N/A' ELSE impacto END AS impacto,
       CASE WHEN numero % 31 = 0 THEN 'nota ' || CAST(numero AS VARCHAR) END AS status_30_04,
       numero % 37 = 0 AS vazia,
       'gproblemas_' || CAST(numero % 4 AS VARCHAR) || '.csv' AS nm_arquivo_origem
FROM ({PROBLEMS})
"""

FAULTY = f"""
SELECT l.* REPLACE (CASE WHEN numero_arquivo = 3 AND inteiro AND n % 29 = 0 AND NOT vazia THEN 'URGENTE'
                         ELSE prioridade END AS prioridade)
FROM (SELECT *, n % 4 AS numero_arquivo,
             n % 17 <> 0 AND n % 19 <> 0 AND NOT vazia AS inteiro FROM ({LANDING})) l,
     (VALUES (1), (2)) AS copias(i)
WHERE i = 1 OR (numero_arquivo = 2 AND inteiro AND n % 31 = 0)
"""

_NULLS = (
    "'#N/A','#N/A N/A','#NA','-1.#IND','-1.#QNAN','-NaN','-nan','1.#IND','1.#QNAN','<NA>',"
    "'N/A','NA','NULL','NaN','None','n/a','nan','null',''"
)


def _cleaned(landing: str) -> str:
    """Kept rows of landing text, typed."""
    return f"""
SELECT CAST(trunc(TRY_CAST(chave AS DOUBLE)) AS BIGINT) AS numero, prioridade, titulo,
       COALESCE(CAST(try_strptime(abertura, '%Y-%m-%d %H:%M:%S') AS DATE),
                CAST(try_strptime(abertura, '%Y-%m-%d') AS DATE),
                CAST(try_strptime(abertura, '%m/%d/%Y') AS DATE)) AS dt_abertura,
       CASE WHEN conclusao IN ({_NULLS}) OR trim(conclusao, ' ' || chr(9)) IN ('nan', 'NaT', '') THEN NULL
            ELSE trim(conclusao, ' ' || chr(9)) END AS dt_conclusao,
       status, gerente_responsavel, departamento_relator, jornada_impactada, sistema, paliativo,
       CASE WHEN impacto IN ({_NULLS}) THEN NULL ELSE impacto END AS impacto,
       status_30_04, nm_arquivo_origem
FROM ({landing})
WHERE NOT vazia AND TRY_CAST(chave AS DOUBLE) IS NOT NULL
"""


CLEAN = _cleaned(LANDING)
TARGET = f"SELECT * FROM ({PROBLEMS}) WHERE numero % 2 = 0"
_VALUES = (
    "prioridade", "titulo", "dt_abertura", "dt_conclusao", "status", "gerente_responsavel",
    "jornada_impactada", "paliativo", "impacto", "nm_arquivo_origem",
)


def _merge(stamp: str, source: str, extra: str = "", repeated: str = "FALSE") -> str:
    """Upsert written as three disjoint parts: untouched, updated, inserted rows."""
    new = ", ".join(f"s.{c}" for c in _VALUES)
    old = ", ".join(
        f"CAST(NULL AS VARCHAR) AS {c}" if c in ("dt_conclusao", "nm_arquivo_origem") else f"t.{c}"
        for c in _VALUES
    )
    return f"""
WITH s AS ({source}), t AS ({TARGET})
SELECT t.numero, {old}, TIMESTAMP '2024-01-01 00:00:00' AS dt_insert,
       CAST(NULL AS TIMESTAMP) AS dt_atualizacao, CAST(NULL AS VARCHAR) AS acao
       {", CAST(NULL AS VARCHAR) AS primeiro_arquivo" if extra else ""}
FROM t WHERE t.numero NOT IN (SELECT numero FROM s)
UNION ALL
SELECT s.numero, {new}, TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '{stamp}', 'UPDATE' {extra}
FROM s WHERE s.numero IN (SELECT numero FROM t)
UNION ALL
SELECT s.numero, {new}, TIMESTAMP '{stamp}',
       CASE WHEN {repeated} THEN TIMESTAMP '{stamp}' END, 'INSERT' {extra}
FROM s WHERE s.numero NOT IN (SELECT numero FROM t)
"""


ARRIVALS = f"""
SELECT *, CAST(substr(nm_arquivo_origem, 12, 1) AS INT) AS ordem FROM ({CLEAN})
UNION ALL
SELECT * REPLACE ('Revisto ' || titulo AS titulo, 'gproblemas_9.csv' AS nm_arquivo_origem),
       CAST(substr(nm_arquivo_origem, 12, 1) AS INT)
FROM ({CLEAN}) WHERE numero % 5 = 0
"""
LATEST = f"""
SELECT * EXCLUDE (r)
FROM (SELECT *, row_number() OVER (PARTITION BY numero ORDER BY ordem DESC, nm_arquivo_origem DESC) AS r,
             first_value(nm_arquivo_origem) OVER (PARTITION BY numero ORDER BY ordem, nm_arquivo_origem) AS primeiro,
             count(*) OVER (PARTITION BY numero) AS vezes
      FROM ({ARRIVALS}))
WHERE r = 1
"""


def _batch(stamp: str) -> str:
    """Audit rows of the faulty files: file 2 repeats keys, file 3 has too long texts."""
    return f"""
WITH bruto AS ({FAULTY}), limpo AS ({_cleaned(FAULTY)}), t AS ({TARGET}),
longas AS (SELECT nm_arquivo_origem, max(length(prioridade)) AS tamanho FROM limpo
           GROUP BY 1 HAVING max(length(prioridade)) > 5),
repetidas AS (SELECT nm_arquivo_origem, count(*) AS chaves, min(numero) AS exemplo
              FROM (SELECT nm_arquivo_origem, numero FROM limpo GROUP BY 1, 2 HAVING count(*) > 1)
              GROUP BY 1),
contas AS (
  SELECT b.nm_arquivo_origem, b.recebidas, l.validas,
         COALESCE('coluna prioridade: ' || CAST(g.tamanho AS VARCHAR) || ' caracteres, limite 5',
                  'chave repetida no arquivo: ' || CAST(r.chaves AS VARCHAR) ||
                  ' chave(s), por exemplo ' || CAST(r.exemplo AS VARCHAR)) AS erro
  FROM (SELECT nm_arquivo_origem, count(*) AS recebidas FROM bruto GROUP BY 1) b
  LEFT JOIN (SELECT nm_arquivo_origem, count(*) AS validas FROM limpo GROUP BY 1) l USING (nm_arquivo_origem)
  LEFT JOIN longas g USING (nm_arquivo_origem)
  LEFT JOIN repetidas r USING (nm_arquivo_origem))
SELECT nm_arquivo_origem AS nm_arquivo, 'tb_problemas_gov_ti' AS nm_tabela_destino,
       TIMESTAMP '{stamp}' AS dt_processamento, recebidas AS qt_linhas_recebidas,
       CASE WHEN erro IS NULL THEN validas ELSE 0 END AS qt_linhas_inseridas,
       CASE WHEN erro IS NULL THEN recebidas - validas ELSE recebidas END AS qt_linhas_rejeitadas,
       CASE WHEN erro IS NULL THEN 'sucesso' ELSE 'falha' END AS ds_status,
       COALESCE(erro, '-') AS ds_erro, CAST(1.26 AS DOUBLE) AS tm_duracao_seg
FROM contas
"""


_HEADER = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d+\s+(ERROR|WARN)\s+\S+\s+::\s+.+$"
_RELEVANT = (
    "sql|query|exception|jdbc|sqlserver|invalid|parameter|template.tag|order by|"
    "should be a string|non-blank"
)


def _events(lines: str = LINES) -> str:
    """Events by islands: every line that is no stack line starts one."""
    return f"""
SELECT log_file, CAST(line_no AS BIGINT) AS line_no, 'docker' AS fonte, nivel, modulo,
       substr(mensagem || COALESCE(chr(10) || pilha, ''), 1, 4000) AS mensagem, dt_evento
FROM (
  SELECT log_file, ilha, min(line_no) AS line_no,
         regexp_extract(arg_min(line, line_no), ',\\d+\\s+(ERROR|WARN)', 1) AS nivel,
         regexp_extract(arg_min(line, line_no), '(ERROR|WARN)\\s+(\\S+)\\s+::', 2) AS modulo,
         regexp_extract(arg_min(line, line_no), '\\s+::\\s+(.+)$', 1) AS mensagem,
         TRY_CAST(substr(arg_min(line, line_no), 1, 19) AS TIMESTAMP) AS dt_evento,
         string_agg(CASE WHEN r BETWEEN 2 AND 6 THEN trim(line) END, chr(10) ORDER BY line_no) AS pilha,
         arg_min(line, line_no) AS cabeca
  FROM (SELECT *, row_number() OVER (PARTITION BY log_file, ilha ORDER BY line_no) AS r
        FROM (SELECT *, sum(CASE WHEN regexp_matches(line, '^\\s*(at |Caused by:|com\\.microsoft\\.|java\\.)')
                                 THEN 0 ELSE 1 END) OVER (PARTITION BY log_file ORDER BY line_no) AS ilha
              FROM ({lines})))
  GROUP BY log_file, ilha)
WHERE regexp_matches(cabeca, '{_HEADER}')
  AND (nivel = 'ERROR' OR regexp_matches(mensagem, '{_RELEVANT}', 'i'))
"""


def _tail(lines: int) -> str:
    return f"""
SELECT log_file, line_no, line
FROM (SELECT *, row_number() OVER (PARTITION BY log_file ORDER BY line_no DESC) AS r FROM ({LINES}))
WHERE r <= {lines}
"""


def _count(column: str, label: str | None = None, rows: str = PROBLEMS, opened: bool = False) -> str:
    shown = f"COALESCE({column}, '{label}') AS {column}" if label else column
    extra = (
        ", CAST(SUM(CASE WHEN status NOT IN ('Resolvido','Cancelado') THEN 1 ELSE 0 END) AS BIGINT)"
        " AS qt_abertos" if opened else ""
    )
    return f"SELECT {shown}, COUNT(*) AS qt_problemas{extra} FROM ({rows}) p GROUP BY p.{column}"


def _where(params: dict[str, str]) -> str:
    clauses = "".join(f" AND {c} = '{v}'" for c, v in params.items())
    return f"SELECT * FROM ({PROBLEMS}) WHERE 1=1{clauses}"


_OPEN = "status NOT IN ('Resolvido', 'Cancelado')"
_TABLE = """numero, prioridade, titulo, status, strftime(dt_abertura, '%d/%m/%Y') AS dt_abertura,
 COALESCE(jornada_impactada, '—') AS jornada_impactada,
 COALESCE(gerente_responsavel, '—') AS gerente_responsavel,
 COALESCE(departamento_relator, '—') AS departamento_relator,
 COALESCE(paliativo, '—') AS paliativo"""
_LABEL = "Não informado"

_HEALTH = f"""
SELECT CAST(dt_processamento AS DATE) AS dt_execucao, COUNT(*) AS qt_execucoes,
       CAST(SUM(CASE WHEN ds_status = 'sucesso' THEN 1 ELSE 0 END) AS BIGINT) AS qt_sucesso,
       CAST(SUM(CASE WHEN ds_status = 'falha' THEN 1 ELSE 0 END) AS BIGINT) AS qt_falha,
       CAST(SUM(CASE WHEN ds_status = 'parcial' THEN 1 ELSE 0 END) AS BIGINT) AS qt_parcial,
       CAST(SUM(qt_linhas_recebidas) AS BIGINT) AS total_linhas_recebidas,
       CAST(SUM(qt_linhas_inseridas) AS BIGINT) AS total_linhas_inseridas,
       CAST(SUM(qt_linhas_rejeitadas) AS BIGINT) AS total_linhas_rejeitadas,
       CAST((2 * SUM(CAST(tm_duracao_seg * 100 AS BIGINT)) * 10000 + COUNT(tm_duracao_seg))
            // (2 * COUNT(tm_duracao_seg)) AS BIGINT) AS micros
FROM ({RUNS}) GROUP BY 1
"""


def statements(
    day: dt.date, stamp: str, tail: int, filters: dict[str, dict[str, str]]
) -> dict[str, str]:
    batch = _batch(stamp)
    events = _events()
    names = """
SELECT id_log, CASE id_log % 5 WHEN 0 THEN 'GProblemas_' WHEN 1 THEN 'gproblemas' WHEN 2 THEN 'outros_'
         WHEN 3 THEN 'x_gproblemas_' ELSE 'gmudancas_' END || CAST(id_log AS VARCHAR) ||
       CASE id_log % 4 WHEN 0 THEN '.XLSX' WHEN 1 THEN '.xls' WHEN 2 THEN '.csv' ELSE '.xlsx' END
       AS nm_arquivo_origem
FROM (SELECT event_id AS id_log FROM events)
"""
    month = stamp[:7]
    result = {
        "landing_read": """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
 o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate,
 o_orderpriority, 'orders.parquet' AS nm_arquivo_origem FROM orders""",
        "route_by_prefix": f"""SELECT id_log, nm_arquivo_origem,
 CASE WHEN lower(nm_arquivo_origem) LIKE 'gproblemas%' THEN 'gproblemas'
      WHEN lower(nm_arquivo_origem) LIKE 'gmudancas%' THEN 'gmudancas' ELSE '-' END AS prefixo,
 CASE WHEN lower(nm_arquivo_origem) LIKE 'gproblemas%' THEN 'tb_problemas_gov_ti'
      WHEN lower(nm_arquivo_origem) LIKE 'gmudancas%' THEN 'tb_mudancas' ELSE '-' END AS tabela,
 CASE WHEN lower(nm_arquivo_origem) LIKE 'gproblemas%' THEN 'roteado'
      WHEN lower(nm_arquivo_origem) LIKE 'gmudancas%' THEN 'tabela_desconhecida' ELSE 'sem_prefixo' END AS rota
FROM ({names}) WHERE lower(nm_arquivo_origem) LIKE '%.xls' OR lower(nm_arquivo_origem) LIKE '%.xlsx'""",
        "sanitize_names": """SELECT CAST(o_orderkey AS VARCHAR) AS numero, CAST(o_custkey AS VARCHAR) AS n_do_cliente,
 o_orderstatus AS status_30_04, o_orderpriority AS prioridade_nova FROM orders""",
        "clean_rows": CLEAN,
        "row_accounting": f"""SELECT nm_arquivo_origem, count(*) AS qt_recebidas,
 count(*) FILTER (WHERE NOT vazia AND TRY_CAST(chave AS DOUBLE) IS NOT NULL) AS qt_validas,
 count(*) FILTER (WHERE vazia OR TRY_CAST(chave AS DOUBLE) IS NULL) AS qt_rejeitadas,
 'sucesso' AS ds_status FROM ({LANDING}) GROUP BY 1""",
        "staging_align": f"""SELECT numero, prioridade, titulo, CAST(NULL AS VARCHAR) AS descricao, dt_abertura,
 dt_conclusao, status, gerente_responsavel, departamento_relator, jornada_impactada,
 CAST(NULL AS VARCHAR) AS sistema, paliativo, impacto, CAST(NULL AS VARCHAR) AS status_14_04,
 CAST(NULL AS VARCHAR) AS status_17_04, CAST(NULL AS VARCHAR) AS status_22_04,
 CAST(NULL AS VARCHAR) AS status_27_04, nm_arquivo_origem FROM ({CLEAN})""",
        "length_violations": f"""SELECT nm_arquivo_origem, 'prioridade' AS coluna,
 CAST(max(length(prioridade)) AS INT) AS tamanho, 5 AS limite
FROM ({_cleaned(FAULTY)}) GROUP BY 1 HAVING max(length(prioridade)) > 5""",
        "duplicate_keys": f"""SELECT nm_arquivo_origem, numero, count(*) AS qt
FROM ({_cleaned(FAULTY)}) GROUP BY 1, 2 HAVING count(*) > 1""",
        "merge_upsert": _merge(stamp, CLEAN),
        "merge_actions": f"""SELECT nm_arquivo_origem,
 count(*) FILTER (WHERE numero % 2 <> 0) AS qt_inseridas,
 count(*) FILTER (WHERE numero % 2 = 0) AS qt_atualizadas FROM ({CLEAN}) GROUP BY 1""",
        "merge_sequence": _merge(stamp, LATEST, ", s.primeiro", "s.vezes > 1"),
        "sequence_actions": f"""SELECT nm_arquivo_origem,
 count(*) FILTER (WHERE numero % 2 <> 0 AND r = 1) AS qt_inseridas,
 count(*) FILTER (WHERE NOT (numero % 2 <> 0 AND r = 1)) AS qt_atualizadas
FROM (SELECT *, row_number() OVER (PARTITION BY numero ORDER BY ordem, nm_arquivo_origem) AS r FROM ({ARRIVALS}))
GROUP BY 1""",
        "schema_evolve": f"""WITH s AS ({CLEAN}), t AS ({TARGET})
SELECT COALESCE(s.numero, t.numero) AS numero,
 CASE WHEN s.numero IS NOT NULL THEN s.status ELSE t.status END AS status,
 CAST(NULL AS VARCHAR) AS status_27_04, s.status_30_04,
 CASE WHEN t.numero IS NOT NULL THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '{stamp}' END AS dt_insert,
 CASE WHEN t.numero IS NOT NULL AND s.numero IS NOT NULL THEN TIMESTAMP '{stamp}' END AS dt_atualizacao
FROM t FULL OUTER JOIN s ON t.numero = s.numero""",
        "audit_rows": batch,
        "file_disposition": f"""SELECT nm_arquivo, ds_status,
 CASE WHEN ds_status = 'sucesso' THEN 'processados/{month}' ELSE 'erros' END AS nm_destino FROM ({batch})""",
        "replay_tally": f"""SELECT count(*) FILTER (WHERE ds_status = 'sucesso') AS qt_sucesso,
 count(*) FILTER (WHERE ds_status <> 'sucesso') AS qt_falha FROM ({batch})""",
        "alert_rows": f"""SELECT nm_arquivo, ds_status, CASE WHEN ds_status = 'sucesso'
 THEN nm_arquivo || ' carregado em {stamp}, linhas novas: ' || CAST(qt_linhas_inseridas AS VARCHAR)
 ELSE nm_arquivo || ' recusado em {stamp}: ' || ds_erro END AS ds_mensagem FROM ({batch})""",
        "kpi_by_status": _count("status"),
        "kpi_by_priority": _count("prioridade"),
        "kpi_by_manager": _count("gerente_responsavel"),
        "kpi_by_department": _count("departamento_relator"),
        "kpi_by_system": _count("sistema"),
        "kpi_by_journey": _count("jornada_impactada", _LABEL, opened=True),
        "kpi_by_workaround": _count("paliativo", _LABEL, opened=True),
        "kpi_open": f"""SELECT numero, prioridade, titulo, status, dt_abertura, gerente_responsavel,
 departamento_relator, jornada_impactada, sistema, paliativo, impacto FROM ({PROBLEMS}) WHERE {_OPEN}""",
        "kpi_pipeline_health": f"""SELECT * EXCLUDE (micros), micros / 1000000.0::DOUBLE AS media_duracao_seg
FROM ({_HEALTH})""",
        "card_total": f"SELECT COUNT(*) AS total FROM ({PROBLEMS})",
        "card_open_total": f"SELECT COUNT(*) AS abertos FROM ({PROBLEMS}) WHERE {_OPEN}",
        "card_p1_open": f"SELECT COUNT(*) AS p1_abertos FROM ({PROBLEMS}) WHERE prioridade = 'P1' AND {_OPEN}",
        "card_by_status": _count("status"),
        "card_by_priority": _count("prioridade"),
        "card_by_manager": _count("gerente_responsavel"),
        "card_by_department": _count("departamento_relator"),
        "card_by_system": _count("sistema"),
        "exec_by_status": _count("status"),
        "exec_by_priority": _count("prioridade"),
        "exec_by_journey": _count("jornada_impactada", _LABEL),
        "exec_by_workaround": _count("paliativo", _LABEL),
        "exec_by_manager": _count("gerente_responsavel", _LABEL),
        "exec_by_department": _count("departamento_relator", _LABEL),
        "card_open_basic": f"""SELECT numero, prioridade, titulo, status,
 strftime(dt_abertura, '%d/%m/%Y') AS dt_abertura, gerente_responsavel, departamento_relator, sistema
FROM ({PROBLEMS}) p WHERE {_OPEN} ORDER BY prioridade, p.dt_abertura""",
        "card_open_exec": f"""SELECT {_TABLE} FROM ({PROBLEMS}) p WHERE {_OPEN}
ORDER BY CASE prioridade WHEN 'P1' THEN 1 WHEN 'P2' THEN 2 WHEN 'P3' THEN 3 ELSE 4 END, p.dt_abertura""",
        "card_pipeline_health": f"""SELECT strftime(dt_execucao, '%d/%m/%Y') AS data, qt_execucoes, qt_sucesso,
 qt_falha, total_linhas_inseridas, CAST((micros + 5000) // 10000 AS BIGINT) / 100.0::DOUBLE AS media_seg
FROM ({_HEALTH})""",
        "daily_summary": f"""SELECT nm_arquivo, nm_tabela_destino, qt_linhas_recebidas, qt_linhas_inseridas,
 qt_linhas_rejeitadas, ds_status, '-' AS ds_erro, CAST(tm_duracao_seg AS DOUBLE) AS tm_duracao_seg
FROM ({RUNS}) WHERE CAST(dt_processamento AS DATE) = DATE '{day}' ORDER BY dt_processamento""",
        "daily_totals": f"""SELECT CAST(COALESCE(SUM(qt_linhas_recebidas), 0) AS BIGINT) AS total_recebidas,
 CAST(COALESCE(SUM(qt_linhas_inseridas), 0) AS BIGINT) AS total_inseridas,
 count(*) FILTER (WHERE ds_status <> 'sucesso') AS total_falhas
FROM ({RUNS}) WHERE CAST(dt_processamento AS DATE) = DATE '{day}'""",
        "cross_filter": _count(
            "status",
            rows=f"SELECT * FROM ({PROBLEMS}) WHERE jornada_impactada IS NULL AND prioridade = 'P1'",
        ),
        "log_tail": _tail(tail),
        "log_events": events,
        "log_high_water": f"SELECT max(dt_evento) AS dt_evento FROM ({events}) WHERE fonte = 'docker'",
        "log_incremental": f"""SELECT * FROM ({_events()})
WHERE dt_evento IS NULL OR dt_evento >
 (SELECT max(dt_evento) FROM ({_events(f"SELECT * FROM ({LINES}) WHERE log_file <= DATE '{day}'")}))""",
        "log_alert": f"""SELECT count(*) AS qt_erros, substr(arg_min(mensagem, (log_file, line_no)), 1, 400) AS ds_amostra
FROM ({events}) WHERE nivel = 'ERROR' HAVING count(*) > 0""",
    }
    rows = {card: _where(params) for card, params in filters.items()}
    result |= {
        "filtered_total": f"SELECT COUNT(*) AS total FROM ({rows['total']})",
        "filtered_open_total": f"SELECT COUNT(*) AS abertos FROM ({rows['open_total']}) WHERE {_OPEN}",
        "filtered_p1_open": f"""SELECT COUNT(*) AS p1_abertos FROM ({rows['p1_open']})
WHERE prioridade = 'P1' AND {_OPEN}""",
        "filtered_status": _count("status", rows=rows["by_status"]),
        "filtered_priority": _count("prioridade", rows=rows["by_priority"]),
        "filtered_journey": _count("jornada_impactada", _LABEL, rows["by_journey"]),
        "filtered_workaround": _count("paliativo", _LABEL, rows["by_workaround"]),
        "filtered_manager": _count("gerente_responsavel", _LABEL, rows["by_manager"]),
        "filtered_department": _count("departamento_relator", _LABEL, rows["by_department"]),
        "filtered_open_table": f"SELECT {_TABLE} FROM ({rows['open_table']})",
    }
    return result


def _dashboard(params: dict[str, str]) -> str:
    """The ten cards, one statement each."""
    rows = _where(params)
    scalars = {
        "total": "TRUE", "open_total": _OPEN, "p1_open": f"prioridade = 'P1' AND {_OPEN}", "open_table": "TRUE",
    }
    charts = {
        "by_status": ("status", None), "by_priority": ("prioridade", None),
        "by_journey": ("jornada_impactada", _LABEL), "by_workaround": ("paliativo", _LABEL),
        "by_manager": ("gerente_responsavel", _LABEL), "by_department": ("departamento_relator", _LABEL),
    }
    parts = [
        f"SELECT '{card}' AS card, CAST(NULL AS VARCHAR) AS label, count(*) FILTER (WHERE {test}) AS qt FROM ({rows})"
        for card, test in scalars.items()
    ]
    for card, (column, label) in charts.items():
        shown = f"COALESCE({column}, '{label}')" if label else column
        parts.append(f"SELECT '{card}', {shown}, count(*) FROM ({rows}) p GROUP BY p.{column}")
    return " UNION ALL ".join(parts)


def _snapshot(stamp: str, later: str) -> str:
    """Two upserts: the landing rows, then the reopened problems."""
    columns = "numero, prioridade, titulo, dt_abertura, status, gerente_responsavel, nm_arquivo_origem"
    return f"""
WITH m AS (SELECT {columns}, dt_insert, dt_atualizacao FROM ({_merge(stamp, CLEAN)})),
r AS (SELECT * REPLACE ('Reaberto' AS status), 'gproblemas_reabertos.csv' AS nm_arquivo_origem FROM ({PROBLEMS})
      WHERE dt_abertura = (SELECT max(dt_abertura) FROM ({PROBLEMS})))
SELECT * FROM m WHERE numero NOT IN (SELECT numero FROM r)
UNION ALL
SELECT {", ".join(f"r.{c.strip()}" for c in columns.split(","))},
       COALESCE(m.dt_insert, TIMESTAMP '{later}'), CASE WHEN m.numero IS NOT NULL THEN TIMESTAMP '{later}' END
FROM r LEFT JOIN m ON m.numero = r.numero
"""


def more_statements(
    day: dt.date, stamp: str, later: str, settled_at: str, dashboard: dict[str, str], book_rows: int
) -> dict[str, str]:
    early = _events(f"SELECT * FROM ({LINES}) WHERE log_file <= DATE '{day}'")
    return {
        "dedupe_headers": """SELECT o_custkey, CAST(i - 1 AS INT) AS posicao,
 CASE WHEN h IS NULL THEN 'Unnamed: ' || CAST(i - 1 AS VARCHAR) WHEN n = 1 THEN h
      ELSE h || '.' || CAST(n - 1 AS VARCHAR) END AS nome
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, h ORDER BY i) AS n
      FROM (SELECT o_custkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderpriority END AS h,
                   row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i FROM orders))""",
        "landing_layouts": f"""SELECT CAST(numero AS VARCHAR) AS numero, prioridade, titulo,
 CASE WHEN numero % 7 <> 5 THEN status END AS status, sistema,
 'gproblemas_' || CAST(numero % 7 AS VARCHAR) || '.csv' AS nm_arquivo_origem FROM ({PROBLEMS})""",
        "workbook_read": f"""SELECT CAST(numero AS VARCHAR) AS "Número", titulo AS "Título", status AS "Status",
 paliativo AS "Paliativo", 'gproblemas_' || CAST(numero // {book_rows} AS VARCHAR) || '.xlsx' AS nm_arquivo_origem
FROM ({PROBLEMS})""",
        "settled_files": f"""SELECT event_id, event_id % 5 AS length FROM events
WHERE event_id % 5 > 0 AND CAST(ts AS TIMESTAMP) <= TIMESTAMP '{settled_at}' - INTERVAL 3 SECOND""",
        "snapshot_merge": _snapshot(stamp, later),
        "batch_retry": f"""SELECT numero, status, dt_abertura, status_30_04, nm_arquivo_origem,
 TIMESTAMP '{stamp}' AS dt_insert, CAST(NULL AS TIMESTAMP) AS dt_atualizacao FROM ({CLEAN})""",
        "event_append": f"""WITH a AS ({early}), b AS (
 SELECT * FROM ({_events()}) WHERE dt_evento IS NULL OR dt_evento > (SELECT max(dt_evento) FROM a)),
ab AS (SELECT 1 AS lote, * FROM a UNION ALL SELECT 2, * FROM b)
SELECT row_number() OVER (ORDER BY lote, log_file, line_no) AS id_log, fonte, nivel, modulo, mensagem, dt_evento,
 CASE lote WHEN 1 THEN TIMESTAMP '{stamp}' ELSE TIMESTAMP '{later}' END AS dt_insert FROM ab""",
        "dashboard_filtered": _dashboard(dashboard),
    }
