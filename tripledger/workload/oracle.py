"""DuckDB SQL that computes each registered query directly from the typed columns."""

from __future__ import annotations


def _half_up(total: str, count: str, digits: int) -> str:
    """``total / count`` rounded half away from zero, in whole numbers. ``total`` is the SQL
    of a sum of cents or units; ``count`` carries the factor 100 when it is cents."""
    up, down = f"(({total}) * {10 ** digits})", f"({count})"
    return (f"(CAST(sign({total}) AS DOUBLE) * CAST((2 * abs({up}) + {down}) // (2 * {down}) "
            f"AS DOUBLE) / {10 ** digits})")


def _cents(x: str) -> str:
    return f"CAST(round(({x}) * 100) AS HUGEINT)"


def _money(x: str) -> str:
    return f"(CAST({x} AS DOUBLE) / 100)"


def _amount(x: str) -> str:
    return f"'R$ ' || format('{{:,.2f}}', CAST({x} AS DOUBLE))"


_TRIPS = """
    trips AS (
      SELECT CAST(o_orderkey AS VARCHAR) AS id_viagem,
             CAST(n_nationkey AS VARCHAR) AS cod_orgao_superior, n_name AS orgao,
             'Customer-No' || substr(c_name, 10) AS nome,
             ' ' || n_name || ', ' || o_orderpriority AS destinos,
             CASE WHEN o_orderstatus = 'O' THEN 0
                  ELSE CAST(round(o_totalprice * 100) AS HUGEINT) END AS cents,
             CAST(last AS DATE) - CAST(o_orderdate AS DATE) + 1 AS days
      FROM orders JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey
      LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last FROM lineitem GROUP BY 1)
        ON o_orderkey = l_orderkey)"""
_PAYMENTS = """
    payments AS (
      SELECT CAST(l_orderkey AS VARCHAR) AS id_viagem,
             CASE l_linenumber WHEN 7 THEN ' ' WHEN 6 THEN NULL
               ELSE l_returnflag || '/' || l_linestatus END AS tipo,
             CASE WHEN l_linenumber <> 3
               THEN CAST(round(l_extendedprice * 100) AS HUGEINT) END AS cents
      FROM lineitem)"""
_SEGMENTS = """
    segments AS (
      SELECT row_number() OVER () AS id_trecho, CAST(l_orderkey AS VARCHAR) AS id_viagem,
             CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN '  '
               WHEN 4 THEN ' A ' ELSE l_returnflag END AS meio,
             'Cidade ' || CAST(l_suppkey AS VARCHAR) AS cidade,
             CASE l_linenumber WHEN 5 THEN ' ' WHEN 6 THEN NULL
               ELSE ' nação ' || CAST(l_quantity AS VARCHAR) END AS uf
      FROM lineitem)"""

_Q01 = f"""SELECT n_name AS orgao, sum({_cents('o_totalprice')}) AS cents
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1 ORDER BY 2 DESC, 1"""
# The same over the trips above, in which open orders cost nothing.
_T01 = "SELECT orgao, sum(cents) AS cents FROM trips GROUP BY 1 ORDER BY 2 DESC, 1"
_T02 = f"""SELECT trim(split_part(destinos, ',', 1)) AS destino,
    {_half_up('sum(cents)', '100 * count(*)', 2)} AS medio
  FROM trips WHERE destinos <> '' GROUP BY 1 HAVING count(id_viagem) > 5
  ORDER BY 2 DESC, 1 LIMIT 3"""
_T03 = """SELECT * FROM trips WHERE cents > 0 AND days IS NOT NULL
  ORDER BY days DESC, id_viagem LIMIT 1"""
_T04 = f"""SELECT tipo, count(*) AS n, sum(cents) AS cents,
    {_half_up('sum(cents)', '100 * count(cents)', 6)} AS medio,
    {_half_up('sum(cents)', '100 * count(cents)', 2)} AS medio2
  FROM payments WHERE trim(tipo) <> '' GROUP BY 1"""
_T05 = """SELECT coalesce(nullif(trim(meio), ''), 'Não Informado') AS rotulo, meio, count(*) AS n
  FROM segments GROUP BY meio"""
_T06 = """SELECT upper(trim(uf)) AS uf_destino, count(*) AS n FROM segments
  WHERE trim(uf) <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""


def _gold(weights: str) -> str:
    joined = {
        "as_written": """SELECT t.*, p.cents AS paid, s.id_trecho
            FROM trips t LEFT JOIN payments p ON t.id_viagem = p.id_viagem
            LEFT JOIN segments s ON t.id_viagem = s.id_viagem""",
        "corrected": """SELECT t.*, NULL AS id_trecho, p.paid, s.n_seg FROM trips t
            LEFT JOIN (SELECT id_viagem, sum(cents) AS paid FROM payments GROUP BY 1) p
              ON t.id_viagem = p.id_viagem
            LEFT JOIN (SELECT id_viagem, count(*) AS n_seg FROM segments GROUP BY 1) s
              ON t.id_viagem = s.id_viagem""",
    }[weights]
    segs = "count(DISTINCT id_trecho)" if weights == "as_written" else "coalesce(sum(n_seg), 0)"
    return f"""WITH {_TRIPS}, {_PAYMENTS}, {_SEGMENTS}
      SELECT cod_orgao_superior, orgao, count(DISTINCT id_viagem) AS total_viagens,
        {_half_up('CAST(sum(days) AS HUGEINT)', 'count(days)', 1)} AS media_duracao_dias,
        {_money('sum(cents)')} AS custo_total_geral,
        {_half_up('sum(cents)', '100 * count(*)', 2)} AS custo_medio_viagem,
        {_money('coalesce(sum(paid), 0)')} AS total_efetivamente_pago,
        CAST({segs} AS BIGINT) AS total_trechos_realizados
      FROM ({joined}) GROUP BY 1, 2"""


_FIRST = """row_number() OVER (PARTITION BY {keys} ORDER BY l_linenumber, l_partkey, l_suppkey,
    l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)"""

_RAW_TRIPS = f"""
    broken AS (
      SELECT *, concat_ws(',',
          CASE WHEN l_linenumber = 7 THEN 'nao_nulo:nome_orgao_superior' END,
          CASE WHEN l_linenumber = 6 THEN 'nao_negativo:valor_diarias' END,
          CASE WHEN l_quantity = 50 THEN 'tamanho:viagem_urgente' END,
          CASE WHEN l_tax = 0.08 THEN 'texto_valido:valor_outros_gastos' END) AS rules
      FROM lineitem),
    first AS (SELECT *, {_FIRST.format(keys='l_orderkey')} AS rn FROM broken WHERE rules = '')"""

# The files written from the test tables, after the loads.
_LOADED = f"""
    trip AS (
      SELECT o_orderkey, n_name, n_nationkey, {_cents('o_totalprice')} - 50 AS cents,
             CASE WHEN o_orderstatus <> 'P' THEN c_nationkey + 1 END AS days
      FROM orders JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey WHERE o_orderpriority <> '1-URGENT'),
    numbered AS (
      SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                   l_extendedprice, l_quantity) AS raw_id FROM lineitem),
    child AS (SELECT * FROM numbered WHERE l_orderkey IN (SELECT o_orderkey FROM trip)),
    paid AS (
      SELECT *, row_number() OVER (ORDER BY raw_id) AS silver_id, {_cents('l_extendedprice')} AS c
      FROM child WHERE l_linenumber <> 2),
    seg AS (SELECT * FROM child QUALIFY l_linenumber = 7 OR row_number() OVER (
              PARTITION BY l_orderkey, l_linenumber ORDER BY raw_id) = 1)"""


def _charts() -> str:
    def chart(name, source, category, value, factor, label, axis="NULL"):
        limit = f"max({value}) OVER () * {factor}"
        return f"""SELECT '{name}' AS grafico, {category} AS categoria,
            CAST(round({value}, 2) AS DOUBLE) AS valor, {label} AS rotulo,
            CAST(round({limit}, 2) AS DOUBLE) AS limite_eixo,
            {axis.format(limit=limit)} AS rotulo_eixo FROM ({source})"""

    million = "'R$ ' || format('{{:,.0f}}', CAST({limit} AS DOUBLE) / 1000000) || 'M'"
    kilo = "'R$ ' || format('{{:,.0f}}', CAST({limit} AS DOUBLE) / 1000) || 'k'"
    dec = "CAST(cents AS DECIMAL(28,2)) / 100"
    parts = [
        chart("q01", f"{_T01} LIMIT 5", "orgao", dec, "1.28", _amount(dec), million),
        chart("q02", _T02, "destino", "medio", "1.25", _amount("medio"), kilo),
        chart("q03_dias", _T03, "'Duração da Viagem'", "days", "1.25",
              "CAST(days AS VARCHAR) || ' dias'"),
        chart("q03_custo", _T03, "'Custo Total'", dec, "1.25", _amount(dec)),
        chart("q04", _T04, "tipo", "medio", "1.20", _amount("medio2")),
        chart("q05", _T05, "rotulo", "n", "1.25", "format('{:,}', n) || ' trechos'"),
        chart("q06", _T06, "uf_destino", "n", "1.20", "format('{:,}', n)"),
        chart("q07", f"{_T01} LIMIT 3", "orgao", dec, "1.28", _amount(dec), million),
    ]
    return f"WITH {_TRIPS}, {_PAYMENTS}, {_SEGMENTS} " + " UNION ALL ".join(
        f"SELECT * FROM ({p})" for p in parts)


def oracle_sql() -> dict[str, str]:
    sql = _oracle_sql()
    return sql | {"reloaded_counts": sql["loaded_counts"]}


def _oracle_sql() -> dict[str, str]:
    first_line = _FIRST.format(keys="l_orderkey, l_linenumber")
    return {
        "parse_money": "SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS DOUBLE) "
                       "AS valor FROM orders",
        "parse_money_bad": f"""
            SELECT l_linenumber,
                   count(*) FILTER (l_linenumber > 3) AS lidos,
                   {_money(f'''sum(CASE l_linenumber WHEN 4 THEN -1
                       ELSE {_cents('l_extendedprice')} END) FILTER (l_linenumber > 3)''')} AS total,
                   count(*) FILTER (l_linenumber < 3) AS invalidos
            FROM lineitem GROUP BY 1""",
        "parse_date": """
            SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'P')
                THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS data FROM orders""",
        "parse_int": "SELECT l_orderkey, CASE WHEN l_returnflag <> 'A' THEN l_linenumber END AS n "
                     "FROM lineitem",
        "trip_days": """
            SELECT o_orderkey, CAST(CAST(max(l_shipdate) AS DATE) - CAST(o_orderdate AS DATE) + 1
                AS INTEGER) AS dias
            FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderdate""",
        "total_value": f"""
            SELECT l_orderkey, {_money(f'''
                CASE WHEN l_returnflag <> 'A' THEN {_cents('l_extendedprice')} ELSE 0 END
                + CASE WHEN l_returnflag <> 'N' THEN {_cents('l_quantity')} ELSE 0 END
                + {_cents('l_tax')}
                - CASE WHEN l_returnflag <> 'R' THEN {_cents('l_discount')} ELSE 0 END''')}
                AS valor_total FROM lineitem""",
        "text_cleanup": """
            SELECT p_partkey, trim(p_name) AS primeira,
                   CASE WHEN p_size > 25 OR p_size <= 5 THEN 'Não Informado' ELSE p_type END AS tipo,
                   'SÃO ' || upper(p_name) AS maiuscula,
                   (SELECT string_agg(upper(left(w, 1)) || lower(substr(w, 2)), '-' ORDER BY i)
                    FROM (SELECT unnest(string_split(p_name, ' ')) AS w,
                                 generate_subscripts(string_split(p_name, ' '), 1) AS i))
                     || '''S 3Rd' AS titulo,
                   left(p_brand || '    ', 8) AS curta
            FROM part""",
        "display_text": """
            SELECT o_orderkey, 'R$ ' || format('{:,.2f}', o_totalprice) AS moeda,
                   format('{:,}', o_orderkey) AS milhar,
                   'R$ ' || format('{:,.0f}', o_totalprice / 1000) || 'k' AS mil
            FROM orders""",
        "keep_first": f"""
            SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
            QUALIFY {first_line} = 1""",
        "keep_first_null_key": f"""
            SELECT l_orderkey, nullif(l_linenumber, 7) AS n, l_partkey, l_extendedprice
            FROM lineitem QUALIFY l_linenumber = 7 OR {first_line} = 1""",
        "repeated_keys": """
            SELECT l_orderkey, l_linenumber, count(*) AS linhas FROM lineitem
            GROUP BY 1, 2 HAVING count(*) > 1""",
        "semi_parent": """
            SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
            WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey
                          AND o_orderstatus = 'F')""",
        "semi_repeated_parent": """
            SELECT p_partkey, p_name FROM part WHERE EXISTS (
                SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 49)""",
        "anti_orphans": """
            SELECT CASE WHEN l_linenumber <> 7 THEN l_orderkey END AS k, l_linenumber, l_partkey,
                   l_quantity
            FROM lineitem WHERE l_linenumber = 7 OR NOT EXISTS (
                SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')""",
        "rule_violations": """
            SELECT 'customer' AS tabela, 'nao_negativo:c_acctbal' AS regra,
                   count(*) FILTER (c_acctbal < 0) AS violacoes FROM customer
            UNION ALL SELECT 'customer', 'tamanho:c_mktsegment',
                   count(*) FILTER (length(c_mktsegment) > 9) FROM customer
            UNION ALL SELECT 'customer', 'nao_nulo:segment',
                   count(*) FILTER (c_mktsegment = 'BUILDING') FROM customer
            UNION ALL SELECT 'lineitem', 'faixa:v',
                   count(*) FILTER (l_extendedprice >= 10000) FROM lineitem
            UNION ALL SELECT 'lineitem', 'texto_valido:n',
                   count(*) FILTER (l_linenumber = 2) FROM lineitem""",
        "quarantined_rows": """
            SELECT * FROM (SELECT c_custkey, concat_ws(',',
                CASE WHEN c_acctbal < 0 THEN 'nao_negativo:c_acctbal' END,
                CASE WHEN length(c_mktsegment) > 9 THEN 'tamanho:c_mktsegment' END,
                CASE WHEN c_mktsegment = 'BUILDING' THEN 'nao_nulo:segment' END)
                AS regras_quebradas FROM customer) WHERE regras_quebradas <> ''""",
        "checked_rows": """
            SELECT c_custkey, c_acctbal FROM customer
            WHERE c_acctbal >= 0 AND length(c_mktsegment) <= 9 AND c_mktsegment <> 'BUILDING'""",
        "dense_id": """
            SELECT row_number() OVER (ORDER BY o_orderkey) AS id, o_orderkey, o_custkey
            FROM orders""",
        "delimited_rows": """
            SELECT CASE WHEN c_custkey % 13 <> 5 AND c_custkey % 17 = 7
                        THEN c_name || chr(10) || money ELSE c_name || ';"ção"' END AS nome,
                   CAST(c_custkey AS VARCHAR) AS codigo, CAST(NULL AS VARCHAR) AS cidade,
                   CASE WHEN c_custkey % 13 <> 5 AND c_custkey % 17 <> 7 THEN money END AS saldo
            FROM (SELECT *, translate(format('{:,.2f}', c_acctbal), ',.', '.,') AS money
                  FROM customer) WHERE c_custkey % 11 <> 3""",
        "file_order_id": """
            SELECT row_number() OVER (ORDER BY c_custkey) AS id,
                   CAST(c_custkey AS VARCHAR) AS codigo FROM customer WHERE c_custkey % 11 <> 3""",
        "loaded_payments": f"""
            WITH {_LOADED} SELECT r.*, silver, silver_id, prova FROM (
                SELECT l_returnflag AS tipo_pagamento, count(*) FILTER (l_linenumber <> 2) AS raw,
                       max(raw_id) AS raw_id FROM numbered GROUP BY 1) r
            JOIN (SELECT l_returnflag AS tipo_pagamento, count(*) AS silver,
                         max(silver_id) AS silver_id, {_money('sum(silver_id * c)')} AS prova
                  FROM paid GROUP BY 1) s USING (tipo_pagamento)""",
        "delimited_skipped": """
            SELECT 'lida' AS motivo, count(*) AS registros FROM customer WHERE c_custkey % 11 <> 3
            UNION ALL SELECT 'longa', count(*) FROM customer WHERE c_custkey % 11 = 3""",
        "loaded_counts": f"""
            WITH {_LOADED}, lost AS (
                SELECT * FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM trip))
            SELECT 'raw_viagem' AS tabela, count(*) AS linhas FROM orders
            UNION ALL SELECT 'raw_pagamento', count(*) FROM lineitem
            UNION ALL SELECT 'raw_passagem', count(*) FROM lineitem
            UNION ALL SELECT 'raw_trecho', count(*) FROM lineitem
            UNION ALL SELECT 'silver_viagem', count(*) FROM trip
            UNION ALL SELECT 'silver_pagamento', count(*) FROM paid
            UNION ALL SELECT 'silver_passagem', count(*) FILTER (l_linenumber <> 1) FROM child
            UNION ALL SELECT 'silver_trecho', count(*) FROM seg
            UNION ALL SELECT 'quarentena_silver_viagem', count(*) FROM orders
                WHERE o_orderpriority = '1-URGENT'
            UNION ALL SELECT 'quarentena_silver_pagamento', 0
            UNION ALL SELECT 'quarentena_silver_passagem', count(*) FILTER (l_linenumber = 1)
                FROM child
            UNION ALL SELECT 'quarentena_silver_trecho', 0
            UNION ALL SELECT 'orfaos_silver_pagamento', (SELECT count(*) FROM lineitem)
                - (SELECT count(*) FROM paid)
            UNION ALL SELECT 'orfaos_silver_passagem', count(*) FROM lost
            UNION ALL SELECT 'orfaos_silver_trecho', count(*) FROM lost""",
        "loaded_gold": f"""
            WITH {_LOADED} SELECT CAST(n_nationkey AS VARCHAR) AS cod_orgao_superior,
                n_name AS orgao, count(DISTINCT o_orderkey) AS total_viagens,
                {_half_up('CAST(sum(days) AS HUGEINT)', 'count(days)', 1)} AS media_duracao_dias,
                {_money('sum(cents)')} AS custo_total_geral,
                {_half_up('sum(cents)', '100 * count(*)', 2)} AS custo_medio_viagem,
                {_money('coalesce(sum(c), 0)')} AS total_efetivamente_pago,
                count(DISTINCT seg.raw_id) AS total_trechos_realizados
            FROM trip LEFT JOIN paid ON o_orderkey = paid.l_orderkey
            LEFT JOIN seg ON o_orderkey = seg.l_orderkey GROUP BY 1, 2""",
        "loaded_questions": f"""
            WITH {_LOADED}, body AS (SELECT n_name, sum(cents) AS cents FROM trip GROUP BY 1)
            SELECT 'q01' AS pergunta, n_name AS nome, {_money('cents')} AS valor
                FROM (SELECT * FROM body ORDER BY cents DESC, n_name LIMIT 5)
            UNION ALL SELECT 'q03', id, CAST(days AS DOUBLE) FROM (
                SELECT CAST(o_orderkey AS VARCHAR) AS id, days FROM trip
                WHERE cents > 0 AND days IS NOT NULL ORDER BY days DESC, id LIMIT 1)
            UNION ALL SELECT 'q04', l_returnflag, {_money('sum(c)')} FROM paid GROUP BY 2
            UNION ALL SELECT 'q05', l_returnflag, CAST(count(*) AS DOUBLE) FROM seg GROUP BY 2
            UNION ALL SELECT 'q07', n_name, {_money('cents')}
                FROM (SELECT * FROM body ORDER BY cents DESC, n_name LIMIT 3)""",
        "loaded_violations": f"""
            WITH {_LOADED}, lost AS (
                SELECT * FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM trip))
            SELECT * FROM (
                SELECT 'silver_viagem' AS tabela, 'tamanho:viagem_urgente' AS regra, count(*) AS violacoes
                    FROM orders WHERE o_orderpriority = '1-URGENT'
                UNION ALL SELECT 'silver_passagem', 'nao_negativo:taxa_servico', count(*) FROM child
                    WHERE l_linenumber = 1
                UNION ALL SELECT 'silver_pagamento', 'existe:id_viagem',
                    (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM paid)
                UNION ALL SELECT 'silver_passagem', 'existe:id_viagem', count(*) FROM lost
                UNION ALL SELECT 'silver_trecho', 'existe:id_viagem', count(*) FROM lost
                UNION ALL SELECT 'silver_trecho', 'unico:id_viagem+sequencia_trecho',
                    (SELECT count(*) FROM child) - (SELECT count(*) FROM seg)) WHERE violacoes > 0""",
        "loaded_repeats": f"""
            WITH {_LOADED} SELECT CAST(l_orderkey AS VARCHAR) AS id_viagem, l_linenumber AS sequencia_trecho,
                raw_id AS ordem, kept AS ordem_mantida
            FROM (SELECT *, min(raw_id) OVER (PARTITION BY l_orderkey, l_linenumber) AS kept
                  FROM child WHERE l_linenumber <> 7) WHERE raw_id > kept""",
        "appended_payments": f"""
            WITH {_LOADED} SELECT raw_id AS ordem, raw_id AS id_pagamento,
                CASE WHEN l_linenumber <> 2 THEN CAST(l_orderkey AS VARCHAR) END AS id_viagem,
                l_returnflag AS tipo_pagamento, l_extendedprice AS valor FROM numbered""",
        "load_report": """
            SELECT 'raw_pagamento' AS tabela, n AS linhas, long AS descartadas, 'carregada' AS situacao,
                   n AS listadas, lost AS sem_viagem
            FROM (SELECT count(*) FILTER (l_linenumber <> 3) AS n, count(*) FILTER (l_linenumber = 3) AS long,
                         count(*) FILTER (l_linenumber IN (2, 4)) AS lost FROM lineitem)
            UNION ALL SELECT 'raw_passagem', 0, 0, 'ausente', 0, 0
            UNION ALL SELECT 'raw_trecho', count(*), 0, 'carregada', count(*), 0 FROM nation""",
        "inserted_rows": """
            SELECT l_orderkey, l_returnflag, l_linenumber, l_partkey, l_suppkey, l_quantity,
                   CAST(CASE WHEN l_suppkey % 2 = 0 THEN 1 ELSE 2 END AS INTEGER) AS lote FROM lineitem
            QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY lote,
                l_linenumber, l_partkey, l_suppkey, l_quantity) = 1""",
        "silver_trip": f"""
            WITH {_RAW_TRIPS} SELECT CAST(l_orderkey AS VARCHAR) AS id_viagem,
                CAST(l_partkey AS VARCHAR) AS num_proposta, 'Realizada' AS situacao,
                'SIM  ' AS viagem_urgente, CAST(NULL AS VARCHAR) AS cod_orgao_superior,
                l_returnflag AS nome_orgao_superior, CAST(NULL AS VARCHAR) AS nome_viajante,
                CAST(NULL AS VARCHAR) AS cargo, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS data_inicio,
                CASE WHEN l_tax > 0 THEN CAST(CAST(l_shipdate AS DATE) + l_linenumber AS VARCHAR) END
                  AS data_fim,
                CAST(NULL AS VARCHAR) AS destinos, CAST(NULL AS VARCHAR) AS motivo,
                l_extendedprice AS valor_diarias,
                CASE WHEN l_returnflag <> 'A' THEN l_quantity END AS valor_passagens,
                l_discount AS valor_devolucao, CAST(NULL AS DOUBLE) AS valor_outros_gastos,
                {_money(f'''{_cents('l_extendedprice')} - {_cents('l_discount')}
                  + CASE WHEN l_returnflag <> 'A' THEN {_cents('l_quantity')} ELSE 0 END''')}
                  AS valor_total,
                CASE WHEN l_tax > 0 THEN l_linenumber + 1 END AS duracao_dias
            FROM first WHERE rn = 1""",
        "silver_trip_quarantine": f"""
            WITH {_RAW_TRIPS} SELECT CAST(l_orderkey AS VARCHAR) AS id_viagem,
                CAST(l_partkey AS VARCHAR) AS num_proposta, rules AS regras_quebradas FROM broken WHERE rules <> ''""",
        "silver_payment": """
            SELECT CAST(l_orderkey AS VARCHAR) AS id_viagem,
                   CAST(l_partkey AS VARCHAR) AS num_proposta,
                   CAST(l_suppkey AS VARCHAR) AS nome_orgao_pagador,
                   CAST(NULL AS VARCHAR) AS nome_ug_pagadora, l_returnflag AS tipo_pagamento,
                   CASE WHEN l_linenumber <> 5 THEN l_extendedprice END AS valor
            FROM lineitem WHERE l_linenumber NOT IN (6, 7)
              AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
        "silver_ticket": """
            SELECT CAST(l_orderkey AS VARCHAR) AS id_viagem, l_returnflag AS meio_transporte,
                   CAST(NULL AS VARCHAR) AS pais_origem_ida, CAST(NULL AS VARCHAR) AS uf_origem_ida,
                   CAST(NULL AS VARCHAR) AS cidade_origem_ida,
                   CAST(NULL AS VARCHAR) AS pais_destino_ida,
                   CAST(NULL AS VARCHAR) AS uf_destino_ida, p_name AS cidade_destino_ida,
                   l_extendedprice AS valor_passagem, l_tax AS taxa_servico,
                   CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS data_emissao
            FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber NOT IN (3, 4)
              AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
        "silver_segment": f"""
            SELECT CAST(l_orderkey AS VARCHAR) AS id_viagem,
                   nullif(l_linenumber, 7) AS sequencia_trecho,
                   CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS origem_data,
                   CAST(NULL AS VARCHAR) AS origem_uf, CAST(NULL AS VARCHAR) AS origem_cidade,
                   CAST(NULL AS VARCHAR) AS destino_data, CAST(NULL AS VARCHAR) AS destino_uf,
                   CAST(l_suppkey AS VARCHAR) AS destino_cidade, l_returnflag AS meio_transporte,
                   l_quantity AS numero_diarias
            FROM lineitem WHERE l_linenumber <> 6
              AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
            QUALIFY l_linenumber = 7 OR {first_line} = 1""",
        "silver_payment_violations": """
            WITH x AS (SELECT l_linenumber AS n FROM lineitem WHERE l_orderkey IN (
                SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'))
            SELECT 'silver_pagamento' AS tabela, regra, CAST(v AS BIGINT) AS violacoes FROM (
                SELECT 'nao_nulo:id_viagem' AS regra, 0 AS v
                UNION ALL SELECT 'nao_nulo:tipo_pagamento', count(*) FILTER (n = 7) FROM x
                UNION ALL SELECT 'nao_negativo:valor', count(*) FILTER (n = 6) FROM x
                UNION ALL SELECT 'tamanho:id_viagem', 0
                UNION ALL SELECT 'tamanho:num_proposta', 0
                UNION ALL SELECT 'tamanho:nome_orgao_pagador', 0
                UNION ALL SELECT 'tamanho:nome_ug_pagadora', 0
                UNION ALL SELECT 'tamanho:tipo_pagamento', 0
                UNION ALL SELECT 'texto_valido:valor', 0)""",
        "silver_relations": """
            WITH lost AS (SELECT count(*) AS v FROM lineitem WHERE l_orderkey NOT IN (
                SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')),
            s AS (SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS v FROM lineitem
                  WHERE l_linenumber NOT IN (6, 7))
            SELECT 'silver_viagem' AS tabela, 'unico:id_viagem' AS regra,
                   count(*) - count(DISTINCT l_orderkey) AS violacoes FROM lineitem
            UNION ALL SELECT 'silver_pagamento', 'existe:id_viagem', v FROM lost
            UNION ALL SELECT 'silver_passagem', 'existe:id_viagem', v FROM lost
            UNION ALL SELECT 'silver_trecho', 'existe:id_viagem', v FROM lost
            UNION ALL SELECT 'silver_trecho', 'unico:id_viagem+sequencia_trecho', v FROM s""",
        "gold_as_written": _gold("as_written"),
        "gold_corrected": _gold("corrected"),
        "q01": f"SELECT orgao, {_money('cents')} AS custo_total FROM ({_Q01} LIMIT 5)",
        "q02": f"""
            SELECT trim(split_part(destinos, ',', 1)) AS destino_principal,
                   {_half_up(f"sum({_cents('p_retailprice')})", '100 * count(*)', 2)} AS custo_medio
            FROM (SELECT *, CASE WHEN p_size <> 1 THEN p_name || ' , ' || p_type
                                 WHEN p_brand > 'Brand#2' THEN '' END AS destinos FROM part)
            WHERE destinos IS NOT NULL AND destinos <> '' GROUP BY 1 HAVING count(*) > 5
            ORDER BY 2 DESC, 1 LIMIT 3""",
        "q02_city": f"""
            WITH {_SEGMENTS} SELECT cidade AS destino_cidade,
                {_half_up(f"sum({_cents('o_totalprice')})", '100 * count(*)', 2)} AS custo_medio
            FROM segments JOIN orders ON id_viagem = CAST(o_orderkey AS VARCHAR)
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""",
        "q03": f"""
            WITH {_TRIPS} SELECT id_viagem, lower(nome) AS nome_viajante, destinos,
                CAST(days AS INTEGER) AS duracao_dias, {_money('cents')} AS valor_total
            FROM ({_T03})""",
        "q04": f"""
            WITH {_PAYMENTS} SELECT tipo AS tipo_pagamento, n AS quantidade_pagamentos,
                {_money('cents')} AS volume_total_pago, medio AS valor_medio_pagamento
            FROM ({_T04})""",
        "q05": f"WITH {_SEGMENTS} SELECT rotulo AS meio_transporte, n AS total_trechos FROM ({_T05})",
        "q05_merged": f"""
            WITH {_SEGMENTS} SELECT rotulo AS meio_transporte, CAST(sum(n) AS BIGINT)
                AS total_trechos FROM ({_T05}) GROUP BY 1""",
        "q05_share": f"""
            WITH {_SEGMENTS}, merged AS (
                SELECT rotulo, CAST(sum(n) AS HUGEINT) AS n FROM ({_T05}) GROUP BY 1)
            SELECT rotulo AS meio_transporte, CAST(n AS BIGINT) AS total_trechos,
                {_half_up('n * 100', '(SELECT CAST(sum(n) AS HUGEINT) FROM merged)', 2)} AS percentual
            FROM merged""",
        "q06": f"WITH {_SEGMENTS} SELECT uf_destino, n AS total_ocorrencias FROM ({_T06})",
        "q07": f"SELECT orgao, {_money('cents')} AS valor_consolidado FROM ({_Q01} LIMIT 3)",
        "q07_payer": f"""
            SELECT s_name AS orgao_pagador, {_money(f"sum({_cents('l_extendedprice')})")} AS total_pago
            FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1""",
        "answers": f"""
            WITH {_TRIPS}, {_PAYMENTS}, {_SEGMENTS}
            SELECT 'q01' AS pergunta, 'Maior custo total: '
                || coalesce(nullif(trim(orgao), ''), 'Não Informado') || ', '
                || {_amount(_money('cents'))} || '.' AS resposta FROM ({_T01} LIMIT 1)
            UNION ALL SELECT 'q02', 'Maior custo médio entre destinos com mais de 5 viagens: '
                || destino || ', ' || {_amount('medio')} || '.' FROM (SELECT * FROM ({_T02})
                ORDER BY medio DESC, destino LIMIT 1)
            UNION ALL SELECT 'q03', 'Viagem mais longa: ' || CAST(days AS VARCHAR)
                || ' dias, viajante ' || coalesce(nome, 'Não Informado') || ', destino '
                || coalesce(nullif(trim(destinos), ''), 'Não Informado') || ', custo '
                || {_amount(_money('cents'))} || '.' FROM ({_T03})
            UNION ALL SELECT 'q04', 'Maior valor médio: ' || tipo || ', ' || {_amount('medio2')}
                || ' em ' || format('{{:,}}', n) || ' pagamentos, total '
                || {_amount(_money('cents'))} || '.'
                FROM (SELECT * FROM ({_T04}) WHERE medio IS NOT NULL ORDER BY medio DESC, tipo LIMIT 1)
            UNION ALL SELECT 'q05', 'Transporte mais usado: ' || rotulo || ', '
                || format('{{:,}}', n) || ' trechos.'
                FROM (SELECT * FROM ({_T05}) ORDER BY n DESC, meio NULLS FIRST LIMIT 1)
            UNION ALL SELECT 'q06', 'UF de destino mais frequente: ' || uf_destino || ', '
                || format('{{:,}}', n) || ' trechos.'
                FROM (SELECT * FROM ({_T06}) ORDER BY n DESC, uf_destino LIMIT 1)
            UNION ALL SELECT 'q07', 'Maior valor consolidado: '
                || coalesce(nullif(trim(orgao), ''), 'Não Informado') || ', '
                || {_amount(_money('cents'))} || '.' FROM ({_T01} LIMIT 1)""",
        "chart_table": _charts(),
    }
