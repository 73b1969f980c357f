"""Quote-like views over the star-schema test tables.

Each view is one SQL text that any engine can run, so a query and its check share the
definition. ``{orders}`` and the like stand for the base tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    # status history: several snapshots per quote, event_id breaks equal times
    "v_snapshots": """
        SELECT user_id * 20 + event_id % 20 AS quote_id, event_id, ts AS ts_arq, value AS premium,
               CASE event_type WHEN 'purchase' THEN 'EMITIDA' WHEN 'error' THEN ' perdida '
                    WHEN 'view' THEN 'EM ANALISE' WHEN 'click' THEN 'Em Negociacao'
                    ELSE '' END AS status,
               CAST(ts AS DATE) AS day
        FROM {events}""",
    # one row per quote, with NULL, blank and zero-padded values on purpose
    "v_quotes": """
        SELECT o_orderkey AS quote_id,
               CASE WHEN o_orderkey % 17 = 0 THEN NULL
                    WHEN o_orderkey % 19 = 0 THEN '0' || CAST(o_custkey AS VARCHAR(20))
                    ELSE CAST(o_custkey AS VARCHAR(20)) END AS broker_id,
               CAST(o_orderdate AS DATE) AS quote_date, o_totalprice AS premium,
               CASE o_orderstatus WHEN 'F' THEN 'EMITIDA' WHEN 'O' THEN 'Perdida'
                    ELSE 'Em Analise' END AS status,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'MANUAL'
                    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ' '
                    ELSE 'DIGITAL' END AS channel,
               CASE WHEN o_orderkey % 3 = 0 THEN 'Renovacao'
                    WHEN o_orderkey % 3 = 1 THEN 'Seguro Novo' ELSE NULL END AS quote_type
        FROM {orders}""",
    # broker dimension with gaps; dup_key repeats
    "v_broker": """
        SELECT c_custkey AS row_id, c_custkey AS broker_id, c_nationkey AS dup_key,
               c_acctbal AS gwp,
               CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS market,
               CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END AS name
        FROM {customer}""",
    # three-part key with counts
    "v_broker_detail": """
        SELECT o_custkey AS broker_id, l_returnflag AS product, l_linestatus AS req_type,
               count(*) AS n_quotes, avg(l_discount) AS hit_rate
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
        GROUP BY o_custkey, l_returnflag, l_linestatus""",
    # fixed scores: score_a has many ties, score_b few
    "v_scored": """
        SELECT o_orderkey AS quote_id, CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END AS label,
               CAST((o_orderkey * 7919) % 1000 AS DOUBLE) / 1000 AS score_a,
               CAST((o_orderkey * 104729) % 9973 AS DOUBLE) / 9973 AS score_b,
               CAST(o_custkey % 3 AS VARCHAR(20)) AS cluster
        FROM {orders} WHERE o_orderstatus IN ('F', 'O')""",
    # raw text values of many shapes, one row per order
    "v_text": """
        SELECT o_orderkey AS quote_id,
               CASE o_orderkey % 10
                    WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '   '
                    WHEN 3 THEN '00' || CAST(o_custkey AS VARCHAR(20))
                    WHEN 4 THEN ' ' || CAST(o_custkey AS VARCHAR(20)) || ' '
                    WHEN 5 THEN CAST(o_custkey AS VARCHAR(20)) || '.0'
                    WHEN 6 THEN CAST(o_custkey AS VARCHAR(20)) || '.75'
                    WHEN 7 THEN CAST(o_custkey AS VARCHAR(20)) || 'D'
                    WHEN 8 THEN '9.2890001E9'
                    ELSE 'K-' || CAST(o_custkey AS VARCHAR(20)) END AS key_text,
               CASE o_orderkey % 8
                    WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN 'x' || CAST(o_custkey AS VARCHAR(20))
                    WHEN 3 THEN '.' || CAST(o_custkey % 90 + 10 AS VARCHAR(20))
                    WHEN 4 THEN '-.' || CAST(o_custkey % 90 + 10 AS VARCHAR(20))
                    WHEN 5 THEN '1,' || CAST(o_custkey % 900 + 100 AS VARCHAR(20)) || '.5'
                    WHEN 6 THEN '1,000,' || CAST(o_custkey % 900 + 100 AS VARCHAR(20)) || '.25'
                    ELSE CAST(o_custkey AS VARCHAR(20)) END AS us_text,
               CASE o_orderkey % 6
                    WHEN 0 THEN NULL WHEN 1 THEN 'abc'
                    WHEN 2 THEN '1.' || CAST(o_custkey % 900 + 100 AS VARCHAR(20)) || ',5'
                    WHEN 3 THEN ' "' || CAST(o_custkey AS VARCHAR(20)) || ',25" '
                    WHEN 4 THEN '-1.000.' || CAST(o_custkey % 900 + 100 AS VARCHAR(20)) || ',75'
                    ELSE CAST(o_custkey AS VARCHAR(20)) END AS ptbr_text,
               CASE o_orderkey % 7
                    WHEN 0 THEN '2024-02-' || CAST(o_custkey % 20 + 11 AS VARCHAR(20))
                    WHEN 1 THEN CAST(o_custkey % 20 + 10 AS VARCHAR(20)) || '/12/2023'
                    WHEN 2 THEN CAST(o_custkey % 20 + 10 AS VARCHAR(20)) || '/11/2023 10:20:30'
                    WHEN 3 THEN '2023-10-' || CAST(o_custkey % 20 + 10 AS VARCHAR(20)) || ' 01:02:03'
                    WHEN 4 THEN '2023-09-' || CAST(o_custkey % 20 + 10 AS VARCHAR(20)) || 'T01:02:03Z'
                    WHEN 5 THEN 'soon' ELSE NULL END AS date_text,
               CAST(o_custkey AS VARCHAR(20)) AS whole_text,
               CAST(o_custkey AS VARCHAR(20)) || '.5' AS real_text,
               CASE WHEN o_orderkey % 2 = 0 THEN ' ' ELSE NULL END AS empty_text,
               CAST(NULL AS DOUBLE) AS empty_number
        FROM {orders}""",
    # raw quote snapshots with the column names and dirt of the source files
    "v_bronze": """
        SELECT CASE WHEN q % 5 = 0 THEN 'C' ELSE '' END || CAST(q AS VARCHAR(20)) AS CD_NUMERO_COTACAO,
               CASE WHEN user_id % 15 = 0 THEN NULL
                    WHEN user_id % 7 = 0 THEN '00' || CAST(user_id AS VARCHAR(20))
                    ELSE CAST(user_id AS VARCHAR(20)) END AS CD_DOC_CORRETOR,
               '2023' AS ANO_COTACAO, CAST(q % 13 + 1 AS VARCHAR(20)) AS MES_COTACAO,
               CAST(q % 31 + 1 AS VARCHAR(20)) AS DIA_COTACAO,
               CASE WHEN event_id % 11 = 0 THEN 'Recusada pelo Corretor' ELSE 'Ativa' END AS DS_STATUS,
               CASE event_type WHEN 'purchase' THEN 'EMITIDA' WHEN 'error' THEN ' perdida '
                    WHEN 'view' THEN 'EM ANALISE' ELSE 'Em Negociacao' END AS DS_GRUPO_STATUS,
               CASE WHEN event_id % 4 = 0 THEN 'NAO' ELSE ' sim ' END AS FL_SALVO,
               CASE WHEN q % 6 = 0 THEN 'Sim' WHEN q % 6 = 1 THEN 'Nao' ELSE NULL END
                   AS FL_ANALISE_SUBSCRICAO,
               CASE WHEN q % 9 = 0 THEN '1900-01-01' WHEN q % 10 = 0 THEN '2031-05-05'
                    WHEN q % 3 = 1 THEN '2024-01-' || CAST(q % 20 + 10 AS VARCHAR(20))
                    ELSE CAST(q % 20 + 10 AS VARCHAR(20)) || '/02/2024' END AS DT_INICIO_VIGENCIA,
               CASE WHEN q % 8 = 0 THEN NULL
                    ELSE '2024-03-' || CAST(q % 20 + 10 AS VARCHAR(20)) || ' 10:00:00' END AS DT_VALIDADE,
               CASE WHEN q % 4 = 0 THEN 'Renovação Congênere' WHEN q % 4 = 1 THEN NULL
                    WHEN q % 4 = 2 THEN 'Renovacao' ELSE 'Seguro Novo' END AS DS_TIPO_COTACAO,
               CASE WHEN q % 3 = 0 THEN 'A' WHEN q % 3 = 1 THEN 'N' ELSE 'R' END AS DS_PRODUTO_NOME,
               '1,' || CAST(event_id % 900 + 100 AS VARCHAR(20)) || '.5' AS VL_PREMIO_ALVO,
               CAST(event_id AS VARCHAR(20)) AS CD_NUM_PROPOSTA,
               event_id AS SEQ, ts AS TS_ARQ
        FROM (SELECT *, user_id * 20 + event_id % 20 AS q FROM {events}) e""",
    # broker summary and broker detail with the column names of the source files
    "v_summary": """
        SELECT CAST(c_custkey AS VARCHAR(20)) AS CD_CORRETOR,
               CAST(CAST(c_acctbal AS DECIMAL(17, 2)) AS VARCHAR(30)) AS VL_GWP_CORRETOR,
               c_mktsegment AS DS_SEGMENTACAO, c_nationkey AS QTD_ACORDO_COMERCIAL
        FROM {customer}""",
    "v_detail": """
        SELECT CAST(o_custkey AS VARCHAR(20)) AS CD_DOC_CORRETOR, l_returnflag AS DS_PRODUTO_NOME,
               CASE WHEN l_linestatus = 'O' THEN ' ' ELSE 'Renovacao' END AS DS_TIPO_SOLICITACAO,
               count(*) AS QTD_COTACAO_2025, max(l_discount) AS HR_2025
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
        GROUP BY o_custkey, l_returnflag, l_linestatus""",
    # wide feature table: categories of different size, numbers with gaps
    "v_features": """
        SELECT o_orderkey AS quote_id, CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END AS label,
               o_orderpriority AS priority, CAST(o_custkey % 25 AS VARCHAR(20)) AS office,
               'BRL' AS currency,
               CASE WHEN o_orderkey % 100 < 95 THEN NULL ELSE o_totalprice END AS rare,
               o_totalprice AS premium, CAST(o_custkey % 97 AS DOUBLE) AS age,
               CASE WHEN o_orderkey % 4 = 0 THEN NULL
                    ELSE CAST(o_orderkey % 365 AS DOUBLE) END AS days
        FROM {orders} WHERE o_orderstatus IN ('F', 'O')""",
    # one row per broker with two rates and a product count
    "v_entities": """
        SELECT o_custkey AS broker_id, avg(l_discount) AS rate_mean,
               avg(l_quantity) AS volume_mean, count(DISTINCT l_partkey) AS n_products
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
        GROUP BY o_custkey""",
    # the same brokers in three groups far apart, for what a clustering must find
    "v_grouped_entities": """
        SELECT o_custkey AS broker_id, avg(l_discount) + 2 * (o_custkey % 3) AS rate_mean,
               avg(l_quantity) + 200 * (2 * o_custkey % 3) AS volume_mean,
               count(DISTINCT l_partkey) + 1000 * (o_custkey % 3) AS n_products
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
        GROUP BY o_custkey""",
    # features of v_features whose label follows the age but for one quote in ten
    "v_learnable": """
        SELECT o_orderkey AS quote_id,
               CASE WHEN (o_custkey % 97 >= 49) <> (o_orderkey % 10 = 3) THEN 1 ELSE 0 END AS label,
               o_orderpriority AS priority, CAST(o_custkey % 25 AS VARCHAR(20)) AS office,
               o_totalprice AS premium, CAST(o_custkey % 97 AS DOUBLE) AS age,
               CASE WHEN o_orderkey % 4 = 0 THEN NULL
                    ELSE CAST(o_orderkey % 365 AS DOUBLE) END AS days
        FROM {orders} WHERE o_orderstatus IN ('F', 'O')""",
}
_TABLE = re.compile(r"\{(\w+)\}")


def base_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The view as a lazy DataFrame over the tables of a folder."""
    text = VIEWS[name]
    tables = {t: base_table(spark, folder, t) for t in set(_TABLE.findall(text))}
    return spark.sql(text, **tables)


def as_sql(*names: str) -> str:
    """``WITH`` clause that defines the views over plain table names."""
    parts = [f"{n} AS ({_TABLE.sub(lambda m: m.group(1), VIEWS[n])})" for n in names]
    return "WITH " + ", ".join(parts)
