"""SQL that states the expected result of each registered query over the same tables."""

from __future__ import annotations

from quotelift.plans import fixed_values as fv
from quotelift.sources.standins import as_sql

ORACLES: dict[str, str] = {}


def oracle(name: str, views: str, body: str) -> None:
    """``views`` lists stand-in views; further ``WITH`` parts come first in the body."""
    text = body.strip()
    if views:
        head = as_sql(*views.split())
        text = f"{head}, {text}" if text.startswith("--with\n") else f"{head} {text}"
    elif text.startswith("--with\n"):
        text = f"WITH {text}"
    ORACLES[name] = text.replace("--with\n", "")


def listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


STATUS = "upper(trim(status))"
SEGMENT = """CASE WHEN lower(trim(quote_type)) = 'seguro novo' THEN 'SEGURO_NOVO'
                  WHEN lower(trim(quote_type)) IN ('renovação', 'renovacao') THEN 'RENOVACAO' END
             || '_' ||
             CASE WHEN lower(trim(channel)) = 'digital' THEN 'DIGITAL'
                  WHEN lower(trim(channel)) = 'manual' THEN 'MANUAL' END"""


def key_of(col: str) -> str:
    """Join key in comparable form."""
    t = f"trim(CAST({col} AS VARCHAR))"
    return f"""CASE WHEN {t} = '' THEN NULL
        WHEN regexp_full_match({t}, '[+-]?[0-9]+(\\.[0-9]*)?')
            THEN CAST(CAST(regexp_extract({t}, '^[+-]?[0-9]+') AS BIGINT) AS VARCHAR)
        WHEN regexp_full_match({t}, '-?[0-9]+\\.[0-9]+E-?[0-9]+')
            THEN CAST(CAST(trunc(CAST({t} AS DOUBLE)) AS BIGINT) AS VARCHAR)
        ELSE {t} END"""


def bucket(parts: str, buckets: int) -> str:
    return f"('0x' || substr(md5(concat_ws('|', {parts})), 1, 8))::BIGINT % {buckets}"


VALID = f"{bucket('CAST(quote_id AS VARCHAR)' + chr(44) + repr(fv.SPLIT_SALT), 1000000)} < 200000"

# --- sources and sinks ----------------------------------------------------------------

oracle(
    "scan_csv",
    "v_quotes",
    """SELECT quote_id, status, channel, CAST(quote_date AS VARCHAR) AS quote_date FROM v_quotes""",
)
oracle(
    "tag_source",
    "v_quotes",
    """SELECT 'COTACAO_GENERICO_' || strftime(last_day(quote_date), '%Y%m%d') || '.csv' AS "SOURCE_FILE",
              last_day(quote_date) AS file_date, count(*) AS n_rows, count(*) AS n_stamped
       FROM v_quotes GROUP BY ALL""",
)
oracle(
    "stream_ingest",
    "v_quotes",
    """SELECT 'COTACAO_GENERICO_' || strftime(last_day(quote_date), '%Y%m%d') || '.csv' AS "SOURCE_FILE",
              last_day(quote_date) AS file_date, count(*) AS n_rows,
              count(DISTINCT quote_id) AS n_quotes
       FROM v_quotes GROUP BY ALL""",
)
oracle("high_water_mark", "v_snapshots", "SELECT max(day) AS last_date FROM v_snapshots")
FILE_NAME = "'COTACAO_GENERICO_' || strftime(day, '%Y%m%d') || '.csv'"
oracle(
    "loaded_files", "v_snapshots", f"SELECT DISTINCT {FILE_NAME} AS source_file FROM v_snapshots"
)
LOADED = "day(day) <= 15 AND day(day) % 2 = 1"
oracle(
    "incremental_candidates",
    "v_snapshots",
    f"""SELECT DISTINCT {FILE_NAME} AS source_file, day AS file_date FROM v_snapshots
        WHERE NOT ({LOADED}) AND day >= (SELECT max(day) FROM v_snapshots WHERE {LOADED})""",
)
oracle(
    "incremental_limit",
    "v_snapshots",
    f"""SELECT DISTINCT {FILE_NAME} AS source_file, day AS file_date FROM v_snapshots
        WHERE NOT ({LOADED}) ORDER BY file_date, source_file LIMIT 5""",
)
oracle(
    "new_row_flag",
    "v_snapshots",
    """SELECT day(day) = (SELECT max(day(day)) FROM v_snapshots) AS "FL_NOVO",
              count(*) AS n_rows, min(day(day)) AS first_batch
       FROM v_snapshots GROUP BY ALL""",
)

oracle("replay_files", "v_snapshots", f"SELECT DISTINCT {FILE_NAME} AS source_file, day AS file_date FROM v_snapshots")
oracle(
    "late_files",
    "v_snapshots",
    """SELECT day AS file_date, count(*) AS n_rows FROM v_snapshots
       WHERE date_diff('day', DATE '1970-01-01', day) >=
             (SELECT CAST(floor(avg(date_diff('day', DATE '1970-01-01', day))) AS BIGINT) FROM v_snapshots)
       GROUP BY day""",
)
oracle(
    "rows_after_position",
    "v_snapshots",
    """SELECT day(day) AS batch_id, count(*) AS n_rows FROM v_snapshots WHERE day(day) > 10 GROUP BY day(day)""",
)
oracle(
    "table_sinks",
    "",
    """SELECT count(*) AS n_rows, count(DISTINCT s_nationkey) AS n_nations, true AS refused, true AS copied,
              false AS copied_again, true AS refreshed FROM supplier""",
)
oracle(
    "clean_summary",
    "v_summary",
    """SELECT CD_CORRETOR, CAST(VL_GWP_CORRETOR AS DOUBLE) AS VL_GWP_CORRETOR, QTD_ACORDO_COMERCIAL FROM v_summary""",
)
oracle(
    "clean_detail",
    "v_detail",
    f"""SELECT CD_DOC_CORRETOR, DS_PRODUTO_NOME, QTD_COTACAO_2025, CAST(HR_2025 AS DOUBLE) AS HR_2025,
               CASE WHEN trim(DS_TIPO_SOLICITACAO) = '' THEN '{fv.NEW_QUOTE}' ELSE DS_TIPO_SOLICITACAO END
                   AS DS_TIPO_SOLICITACAO
        FROM v_detail""",
)
oracle("segment_rows", "v_quotes", "SELECT quote_id FROM v_quotes WHERE quote_type = 'Renovacao'")
oracle(
    "empty_features",
    "v_features",
    """SELECT feature FROM (
         SELECT unnest(['rare', 'premium', 'age', 'days']) AS feature,
                unnest([count(rare), count(premium), count(age), count(days)]) AS n
         FROM v_features WHERE rare IS NULL) WHERE n = 0""",
)

# --- cleaning expressions ---------------------------------------------------------------

oracle(
    "blank_to_null_values",
    "v_text",
    "SELECT quote_id, CASE WHEN trim(us_text) <> '' THEN us_text END AS us_text FROM v_text",
)
oracle(
    "blanks_to_null",
    "v_text",
    """SELECT quote_id, CASE WHEN trim(key_text) <> '' THEN key_text END AS key_text,
              CASE WHEN trim(us_text) <> '' THEN us_text END AS us_text,
              CASE WHEN trim(empty_text) <> '' THEN empty_text END AS empty_text FROM v_text""",
)
oracle(
    "parse_number_us_values",
    "v_text",
    """SELECT quote_id,
              CAST(CAST(round(TRY_CAST(regexp_replace(regexp_replace(
                       replace(trim(us_text), ',', ''), '^\\.', '0.'), '^-\\.', '-0.') AS DOUBLE), 2)
                   AS DECIMAL(17, 2)) AS DOUBLE) AS amount
       FROM v_text""",
)
oracle(
    "parse_number_ptbr_values",
    "v_text",
    """SELECT quote_id,
              CAST(TRY_CAST(replace(regexp_replace(ptbr_text, '["\\s.]', '', 'g'), ',', '.')
                   AS DECIMAL(17, 2)) AS DOUBLE) AS amount
       FROM v_text""",
)
oracle(
    "parse_date_multi",
    "v_text",
    """SELECT quote_id,
              CAST(coalesce(try_strptime(date_text, '%Y-%m-%d'),
                       try_strptime(date_text, '%d/%m/%Y'),
                       try_strptime(date_text, '%d/%m/%Y %H:%M:%S'),
                       try_strptime(date_text, '%Y-%m-%d %H:%M:%S'),
                       try_strptime(date_text, '%Y-%m-%dT%H:%M:%SZ')) AS DATE) AS parsed
       FROM v_text""",
)
oracle(
    "normalize_key_values",
    "v_text",
    f"SELECT quote_id, {key_of('key_text')} AS join_key FROM v_text",
)
oracle(
    "infer_numeric",
    "v_text",
    """SELECT quote_id, CAST(whole_text AS BIGINT) AS whole_text,
              CAST(real_text AS DOUBLE) AS real_text, key_text FROM v_text""",
)
oracle(
    "cast_double_values",
    "v_text",
    """SELECT quote_id, TRY_CAST(real_text AS DOUBLE) AS real_text,
              TRY_CAST(us_text AS DOUBLE) AS us_text FROM v_text""",
)
oracle(
    "upper_values",
    "v_quotes",
    'SELECT quote_id AS "QUOTE_ID", upper(status) AS "STATUS" FROM v_quotes',
)
oracle("drop_empty_cols", "v_text", "SELECT quote_id, whole_text FROM v_text")
oracle(
    "pinned_schema_rejects",
    "v_text",
    """SELECT 'key_text' AS "column",
              count(*) FILTER (WHERE trim(key_text) <> ''
                  AND NOT regexp_full_match(trim(key_text), '-?[0-9]+')) AS rejected FROM v_text
       UNION ALL
       SELECT 'us_text', count(*) FILTER (WHERE trim(us_text) <> ''
                  AND TRY_CAST(us_text AS DOUBLE) IS NULL) FROM v_text
       UNION ALL SELECT 'whole_text', 0 FROM v_text HAVING count(*) > 0""",
)

# --- business rules ---------------------------------------------------------------------

MADE_DATE = """TRY_CAST(ANO_COTACAO || '-' || lpad(MES_COTACAO, 2, '0') || '-' ||
                        lpad(DIA_COTACAO, 2, '0') AS DATE)"""
CHANNEL = """CASE WHEN lower(trim(FL_ANALISE_SUBSCRICAO)) IN ('sim', 'true', '1')
                       OR upper(trim(CD_NUMERO_COTACAO)) LIKE 'C%' THEN 'MANUAL' ELSE 'DIGITAL' END"""
START = """coalesce(try_strptime(DT_INICIO_VIGENCIA, '%Y-%m-%d'),
                    try_strptime(DT_INICIO_VIGENCIA, '%d/%m/%Y'))::DATE"""
START_OK = f"""CASE WHEN year({START}) > 2027 OR {START} = DATE '1900-01-01' THEN NULL
                    ELSE {START} END"""
MONEY = "round(CAST(replace(VL_PREMIO_ALVO, ',', '') AS DOUBLE), 2)"
KIND = """CASE WHEN lower(trim(DS_TIPO_COTACAO)) = 'renovação congênere'
                    OR DS_TIPO_COTACAO IS NULL OR trim(DS_TIPO_COTACAO) = '' THEN 'Seguro Novo'
               ELSE DS_TIPO_COTACAO END"""
KEPT = """upper(trim(coalesce(DS_STATUS, ''))) NOT IN
              ('RECUSADA PELO SUBSCRITOR', 'RECUSADA PELO CORRETOR')
          AND (upper(trim(CD_NUMERO_COTACAO)) LIKE 'C%' OR upper(trim(FL_SALVO)) = 'SIM')"""


def canonical(col: str) -> str:
    return f"""CASE upper(trim({col})) WHEN 'EMITIDA' THEN 'Emitida'
                    WHEN 'PERDIDA' THEN 'Perdida' ELSE {col} END"""


oracle("rule_make_date", "v_bronze", f'SELECT SEQ AS "SEQ", {MADE_DATE} AS "DATA_COTACAO" FROM v_bronze')
oracle("rule_channel", "v_bronze", f'SELECT SEQ AS "SEQ", {CHANNEL} AS "CANAL" FROM v_bronze')
oracle(
    "rule_sentinel_date",
    "v_bronze",
    f'SELECT SEQ AS "SEQ", {START_OK} AS "DT_INICIO_VIGENCIA" FROM v_bronze',
)
oracle("rule_money", "v_bronze", f'SELECT SEQ AS "SEQ", {MONEY} AS "VL_PREMIO_ALVO" FROM v_bronze')
oracle(
    "rule_default_value", "v_bronze", f'SELECT SEQ AS "SEQ", {KIND} AS "DS_TIPO_COTACAO" FROM v_bronze'
)
oracle("rule_refused_filter", "v_bronze", f'SELECT SEQ AS "SEQ" FROM v_bronze WHERE {KEPT}')
oracle(
    "rule_canonical_status",
    "v_bronze",
    f'SELECT SEQ AS "SEQ", {canonical("DS_GRUPO_STATUS")} AS "DS_GRUPO_STATUS" FROM v_bronze',
)
oracle(
    "rule_final_status",
    "v_bronze",
    f"""SELECT SEQ AS "SEQ", {canonical("DS_GRUPO_STATUS")} AS "DS_GRUPO_STATUS" FROM v_bronze
        WHERE upper(trim(DS_GRUPO_STATUS)) IN ('EMITIDA', 'PERDIDA')""",
)
oracle(
    "rule_label",
    "v_bronze",
    """SELECT SEQ AS "SEQ", CASE upper(trim(DS_GRUPO_STATUS)) WHEN 'EMITIDA' THEN 1
              WHEN 'PERDIDA' THEN 0 END AS label FROM v_bronze""",
)
oracle(
    "rule_month",
    "v_bronze",
    f"""SELECT SEQ AS "SEQ", strftime({MADE_DATE}, '%Y-%m') AS "MES" FROM v_bronze
        WHERE {MADE_DATE} IS NOT NULL""",
)
oracle(
    "rule_exclude_months",
    "v_bronze",
    f"""SELECT SEQ AS "SEQ", {MADE_DATE} AS "DATA_COTACAO" FROM v_bronze
        WHERE strftime({MADE_DATE}, '%Y-%m') NOT IN ('2023-11', '2023-12')""",
)
oracle(
    "rule_commercial_channel",
    "v_quotes",
    """SELECT quote_id, CASE WHEN upper(trim(channel)) = 'DIGITAL' THEN 'DIGITAL' ELSE 'MANUAL' END
              AS "DS_CANAL_COMERCIAL" FROM v_quotes""",
)
oracle("rule_segment", "v_quotes", f"SELECT quote_id, {SEGMENT} AS segment FROM v_quotes")
oracle(
    "eval_label",
    "v_quotes",
    f"""SELECT quote_id, CASE WHEN {STATUS} = 'EMITIDA' THEN 1 ELSE 0 END AS label_real
        FROM v_quotes""",
)
oracle(
    "dedupe_most_filled",
    "v_broker",
    """SELECT * EXCLUDE (rn) FROM (
           SELECT *, row_number() OVER (PARTITION BY dup_key ORDER BY
                  (CASE WHEN trim(market) <> '' THEN 1 ELSE 0 END)
                  + (CASE WHEN trim(name) <> '' THEN 1 ELSE 0 END)
                  + (CASE WHEN gwp IS NOT NULL THEN 1 ELSE 0 END) DESC, row_id DESC) AS rn
           FROM v_broker) WHERE rn = 1""",
)

# --- temporal rule ------------------------------------------------------------------------

LATEST = """--with
    latest AS (SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY quote_id
               ORDER BY ts_arq DESC NULLS LAST, event_id DESC) AS rn FROM v_snapshots)
        WHERE rn = 1)"""
# entry times by the change of status, the long way
ENTERED = f"""moves AS (SELECT *, {STATUS} AS st,
        lag({STATUS}) OVER (PARTITION BY quote_id ORDER BY ts_arq, event_id) AS prev
        FROM v_snapshots),
    issued AS (SELECT quote_id, min(ts_arq) AS issued_at FROM moves
        WHERE st = 'EMITIDA' AND (prev IS NULL OR prev <> 'EMITIDA') GROUP BY quote_id),
    lost AS (SELECT quote_id, min(ts_arq) AS lost_at FROM moves
        WHERE st = 'PERDIDA' AND (prev IS NULL OR prev <> 'PERDIDA') GROUP BY quote_id)"""
AGED = f"""{LATEST}, {ENTERED},
    aged AS (SELECT *, datediff('day', day, (SELECT max(ts_arq) FROM latest)::DATE) AS days_idle
        FROM latest LEFT JOIN issued USING (quote_id) LEFT JOIN lost USING (quote_id)),
    closed AS (SELECT * REPLACE (CASE WHEN {STATUS} IN ({listed(fv.OPEN_STATUSES)})
                   AND days_idle > 7 THEN 'Perdida' ELSE status END AS status),
               status AS status_old,
               {STATUS} IN ({listed(fv.OPEN_STATUSES)}) AND days_idle > 7 AS was_stale FROM aged),
    dated AS (SELECT *, CASE WHEN {STATUS} = 'EMITIDA' THEN issued_at::DATE
                             WHEN {STATUS} = 'PERDIDA' AND was_stale THEN day
                             WHEN {STATUS} = 'PERDIDA' THEN lost_at::DATE
                             ELSE day END AS ref_date FROM closed)"""
oracle(
    "latest_snapshot",
    "v_snapshots",
    f"{LATEST} SELECT quote_id, event_id, premium, status FROM latest",
)
oracle(
    "days_since_update",
    "v_snapshots",
    f"{AGED} SELECT quote_id, CAST(days_idle AS INTEGER) AS days_idle FROM aged",
)
oracle(
    "stale_to_lost",
    "v_snapshots",
    f"{AGED} SELECT quote_id, status, status_old, was_stale FROM closed",
)
oracle(
    "first_status_entry",
    "v_snapshots",
    f"""--with
    {ENTERED} SELECT quote_id, strftime(issued_at, '%Y-%m-%d %H:%M:%S.%f') AS issued_at,
              strftime(lost_at, '%Y-%m-%d %H:%M:%S.%f') AS lost_at
    FROM (SELECT DISTINCT quote_id FROM v_snapshots)
         LEFT JOIN issued USING (quote_id) LEFT JOIN lost USING (quote_id)""",
)
oracle("reference_date", "v_snapshots", f"{AGED} SELECT quote_id, ref_date FROM dated")
oracle(
    "days_to_reference",
    "v_snapshots",
    f"""{AGED} SELECT quote_id, CAST(datediff('day', ref_date, day) AS INTEGER) AS days_snapshot,
               CAST(datediff('day', ref_date, day) AS INTEGER) AS days_age FROM dated""",
)
for _name in ("incremental_clean", "incremental_restart"):
    oracle(
        _name,
        "v_snapshots",
        f"""{AGED} SELECT quote_id, event_id, status, was_stale, CAST(days_idle AS INTEGER) AS days_idle,
            ref_date FROM dated""",
    )
oracle(
    "temporal_incremental",
    "v_snapshots",
    f"""{LATEST}, {ENTERED} SELECT quote_id, event_id, status, issued_at::DATE AS issued_at,
        lost_at::DATE AS lost_at
    FROM latest LEFT JOIN issued USING (quote_id) LEFT JOIN lost USING (quote_id)""",
)


def cleaned(purpose: str) -> str:
    """Raw snapshots through the quote rules, step by step."""
    final = "WHERE st IN ('EMITIDA', 'PERDIDA') AND" if purpose == "train" else "WHERE"
    return f"""--with
    kept AS (SELECT *, {MADE_DATE} AS DATA_COTACAO, {CHANNEL} AS CANAL, {START_OK} AS inicio,
                    {MONEY} AS money, {KIND} AS kind, upper(trim(DS_GRUPO_STATUS)) AS st
             FROM v_bronze WHERE {KEPT}),
    last_row AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
             PARTITION BY CD_NUMERO_COTACAO ORDER BY TS_ARQ DESC NULLS LAST, SEQ DESC) AS rn
             FROM kept) WHERE rn = 1),
    entries AS (SELECT CD_NUMERO_COTACAO, min(TS_ARQ) FILTER (WHERE st = 'EMITIDA') AS issued_at,
             min(TS_ARQ) FILTER (WHERE st = 'PERDIDA') AS lost_at FROM kept GROUP BY ALL),
    idle AS (SELECT *, CAST(datediff('day', TS_ARQ::DATE,
                 (SELECT max(TS_ARQ) FROM last_row)::DATE) AS INTEGER) AS days_idle
             FROM last_row JOIN entries USING (CD_NUMERO_COTACAO)),
    silver AS (SELECT *, CASE WHEN st = 'EMITIDA' THEN issued_at::DATE
                     WHEN st = 'PERDIDA' THEN lost_at::DATE ELSE TS_ARQ::DATE END AS ref
             FROM idle {final} DATA_COTACAO IS NOT NULL)"""


oracle(
    "clean_quotes",
    "v_bronze",
    f"""{cleaned("train")}
    SELECT CD_NUMERO_COTACAO AS "CD_NUMERO_COTACAO", SEQ AS "SEQ", CANAL AS "CANAL",
           kind AS "DS_TIPO_COTACAO", {canonical("DS_GRUPO_STATUS")} AS "DS_GRUPO_STATUS",
           CASE WHEN st = 'EMITIDA' THEN 1 ELSE 0 END AS label,
           strftime(DATA_COTACAO, '%Y-%m') AS "MES", days_idle AS "DIAS_ULTIMA_ATUALIZACAO",
           CAST(datediff('day', ref, try_strptime(DT_VALIDADE, '%Y-%m-%d %H:%M:%S')::DATE)
                AS INTEGER) AS "DIAS_VALIDADE",
           CAST(datediff('day', ref, DATA_COTACAO) AS INTEGER) AS "DIAS_COTACAO",
           CAST(datediff('day', DATA_COTACAO, inicio) AS INTEGER) AS "DIAS_INICIO_VIGENCIA",
           money AS "VL_PREMIO_ALVO"
    FROM silver""",
)

# --- joins ------------------------------------------------------------------------------

JOIN_ONE = f"""--with
    l AS (SELECT *, {key_of("broker_id")} AS k FROM v_quotes),
    r AS (SELECT k, gwp AS gwp_resumo, market AS market_resumo FROM (
        SELECT *, {key_of("broker_id")} AS k, row_number() OVER (
               PARTITION BY {key_of("broker_id")} ORDER BY gwp) AS rn FROM v_broker) WHERE rn = 1),
    joined AS (SELECT l.*, r.gwp_resumo, r.market_resumo FROM l LEFT JOIN r ON l.k = r.k
        WHERE l.k IS NULL OR r.k IS NOT NULL)"""
oracle(
    "join_retention_1key",
    "v_quotes v_broker",
    f"""{JOIN_ONE} SELECT quote_id, broker_id, premium, gwp_resumo, market_resumo FROM joined""",
)
oracle(
    "join_retention_3key",
    "v_quotes v_broker_detail",
    f"""--with
    l AS (SELECT quote_id, broker_id, CASE quote_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END
                 AS product, CASE WHEN quote_id % 7 = 0 THEN NULL WHEN quote_id % 2 = 0 THEN 'O'
                 ELSE 'F' END AS kind, {key_of("broker_id")} AS k FROM v_quotes)
    SELECT l.quote_id, l.broker_id, l.product, l.kind, d.n_quotes AS n_quotes_detalhe,
           round(d.hit_rate, 6) AS hit_rate_detalhe
    FROM l LEFT JOIN v_broker_detail d ON l.k = CAST(d.broker_id AS VARCHAR)
         AND l.product = d.product AND l.kind = d.req_type
    WHERE l.k IS NULL OR d.broker_id IS NOT NULL""",
)
oracle(
    "join_audit",
    "v_quotes v_broker",
    f"""{JOIN_ONE}
    SELECT 'quotes' AS step, count(*) AS n_rows FROM v_quotes
    UNION ALL SELECT 'joined', count(*) FROM joined
    UNION ALL SELECT 'with_segment', count(*) FROM joined WHERE ({SEGMENT}) IS NOT NULL""",
)
oracle(
    "segment_status_share",
    "v_bronze v_summary v_detail",
    f"""{cleaned("score")},
    k AS (SELECT *, {key_of("CD_DOC_CORRETOR")} AS broker FROM silver),
    one AS (SELECT k.* FROM k LEFT JOIN v_summary s ON k.broker = s.CD_CORRETOR
            WHERE k.broker IS NULL OR s.CD_CORRETOR IS NOT NULL),
    two AS (SELECT one.* FROM one LEFT JOIN v_detail d ON one.broker = d.CD_DOC_CORRETOR
                AND one.DS_PRODUTO_NOME = d.DS_PRODUTO_NOME
                AND one.kind = CASE WHEN trim(d.DS_TIPO_SOLICITACAO) = '' THEN 'Seguro Novo'
                                    ELSE d.DS_TIPO_SOLICITACAO END
            WHERE one.broker IS NULL OR d.CD_DOC_CORRETOR IS NOT NULL),
    seg AS (SELECT CASE lower(kind) WHEN 'seguro novo' THEN 'SEGURO_NOVO'
                        WHEN 'renovacao' THEN 'RENOVACAO' END || '_' || CANAL AS "SEG",
                   {canonical("DS_GRUPO_STATUS")} AS "DS_GRUPO_STATUS" FROM two),
    n AS (SELECT "SEG", "DS_GRUPO_STATUS", count(*) AS n_rows FROM seg GROUP BY ALL)
    SELECT *, CAST(sum(n_rows) OVER (PARTITION BY "SEG") AS BIGINT) AS segment_total,
           n_rows / sum(n_rows) OVER (PARTITION BY "SEG") AS share FROM n""",
)

# --- profiles -----------------------------------------------------------------------------

oracle(
    "status_share",
    "v_quotes",
    f"""--with
    n AS (SELECT {SEGMENT} AS segment, status, count(*) AS n_rows FROM v_quotes GROUP BY ALL)
    SELECT *, CAST(sum(n_rows) OVER (PARTITION BY segment) AS BIGINT) AS segment_total,
           n_rows / sum(n_rows) OVER (PARTITION BY segment) AS share FROM n""",
)
oracle(
    "load_profile",
    "v_snapshots",
    """SELECT min(day) AS first_date, max(day) AS last_date, count(*) AS n_rows,
              6 AS n_columns FROM v_snapshots""",
)
oracle("rows_by_day", "v_snapshots", "SELECT day, count(*) AS n_rows FROM v_snapshots GROUP BY day")
oracle(
    "rows_by_day_new",
    "v_snapshots",
    """SELECT day, count(*) AS n_rows FROM v_snapshots
       WHERE day(day) = (SELECT max(day(day)) FROM v_snapshots) GROUP BY day""",
)
oracle(
    "rows_by_quote_date",
    "v_quotes",
    "SELECT quote_date, count(*) AS n_rows FROM v_quotes GROUP BY quote_date",
)


def profile_row(c: str, key: bool) -> str:
    empty = f"{c} IS NULL OR trim(CAST({c} AS VARCHAR)) = ''"
    distinct = f"count(DISTINCT {c}) + CAST(bool_or({c} IS NULL) AS INTEGER)" if key else "NULL"
    return f"""SELECT '{c}' AS column_name, count(*) AS n_rows,
        count(*) FILTER (WHERE {empty}) AS n_empty, CAST({distinct} AS BIGINT) AS n_distinct
        FROM v_quotes"""


oracle(
    "profile_nulls",
    "v_quotes",
    " UNION ALL ".join(
        profile_row(c, c in ("quote_id", "broker_id"))
        for c in ("quote_id", "broker_id", "quote_date", "premium", "status", "channel", "quote_type")
    ),
)
oracle(
    "segment_counts",
    "v_quotes",
    f"SELECT {SEGMENT} AS segment, count(*) AS n_rows FROM v_quotes GROUP BY ALL",
)
oracle(
    "label_rate",
    "v_scored",
    """SELECT cluster, count(*) AS n_rows, round(avg(label), 6) AS label_rate
       FROM v_scored GROUP BY cluster""",
)
oracle(
    "status_month_pivot",
    "v_quotes",
    f"""SELECT strftime(quote_date, '%Y-%m') AS "month",
              count(*) FILTER (WHERE {STATUS} = 'EMITIDA') AS "EMITIDA",
              count(*) FILTER (WHERE {STATUS} = 'PERDIDA') AS "PERDIDA",
              count(*) FILTER (WHERE {STATUS} = 'EM ANALISE') AS "EM ANALISE"
       FROM v_quotes WHERE quote_date IS NOT NULL GROUP BY ALL""",
)
oracle(
    "score_profile",
    "v_scored",
    """SELECT count(*) AS n_rows, count(*) FILTER (WHERE score_b IS NULL) AS n_null,
              min(score_b) AS min_score, round(avg(score_b), 6) AS mean_score,
              max(score_b) AS max_score FROM v_scored""",
)
oracle(
    "null_share",
    "v_features",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null,
                   (count(*) - count({c})) / count(*) AS null_share FROM v_features"""
        for c in ("priority", "rare", "days")
    ),
)
oracle(
    "cardinality",
    "v_quotes",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM v_quotes"
        for c in ("broker_id", "status", "channel", "quote_type")
    ),
)
oracle(
    "entity_profile",
    "v_broker_detail",
    """SELECT broker_id, round(avg(hit_rate), 6) AS rate_mean, round(avg(n_quotes), 6) AS volume_mean,
              count(DISTINCT product) AS n_products FROM v_broker_detail GROUP BY broker_id""",
)
oracle(
    "distinct_topk",
    "v_broker_detail",
    """SELECT product, count(DISTINCT broker_id) AS n_distinct FROM v_broker_detail
       GROUP BY product ORDER BY n_distinct DESC, product LIMIT 20""",
)


def quantile(c: str, p: float) -> str:
    return f"round(quantile_cont(CAST({c} AS DOUBLE), {p}), 6)"


oracle(
    "feature_percentiles",
    "v_features",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, {quantile(c, 0.1)} AS p10, {quantile(c, 0.25)} AS p25,
                   {quantile(c, 0.5)} AS p50, {quantile(c, 0.75)} AS p75, {quantile(c, 0.9)} AS p90
            FROM v_features"""
        for c in ("premium", "age", "days")
    ),
)
oracle(
    "feature_histogram",
    "v_features",
    """--with
    long AS (SELECT 'age' AS feature, age AS v FROM v_features WHERE age IS NOT NULL
             UNION ALL SELECT 'days', days FROM v_features WHERE days IS NOT NULL),
    span AS (SELECT feature, min(v) AS lo, (max(v) - min(v)) / 50 AS w, avg(v) AS mean,
                    quantile_cont(v, 0.5) AS median FROM long GROUP BY feature),
    edges AS (SELECT feature, lo, w, mean, median, i AS bin, lo + i * w AS bin_start,
                     CASE WHEN i = 49 THEN 'infinity'::DOUBLE ELSE lo + (i + 1) * w END AS bin_end
              FROM span, range(50) t(i))
    SELECT feature, CAST(bin AS INTEGER) AS bin, round(bin_start, 6) AS bin_start,
           count(*) AS n_rows, round(mean, 6) AS mean, round(median, 6) AS median
    FROM edges JOIN long USING (feature) WHERE v >= bin_start AND v < bin_end GROUP BY ALL""",
)

# --- rule framework -------------------------------------------------------------------------

RULED = f"""--with
    ruled AS (SELECT quote_id, broker_id, quote_date, premium, {canonical("status")} AS status,
                     {SEGMENT} AS segment, {STATUS} AS st FROM v_quotes)"""
FINAL = "st IN ('EMITIDA', 'PERDIDA')"
oracle(
    "rules_apply",
    "v_quotes",
    f"""{RULED} SELECT quote_id, broker_id, quote_date, premium, status, segment,
        CASE WHEN st = 'EMITIDA' THEN 1 ELSE 0 END AS label
    FROM ruled WHERE {FINAL} AND segment IS NOT NULL""",
)
oracle(
    "rules_log",
    "v_quotes",
    f"""{RULED},
    n AS (SELECT count(*) AS every, count(*) FILTER (WHERE {FINAL}) AS final,
                 count(*) FILTER (WHERE {FINAL} AND segment IS NOT NULL) AS known FROM ruled)
    SELECT CAST(step AS INTEGER) AS step, 'quotes' AS table_name, rule_id, status, reason,
           columns_added, columns_dropped, rows_after
    FROM (SELECT 1 AS step, 'R01' AS rule_id, 'APPLIED' AS status, NULL AS reason,
                 'segment' AS columns_added, '' AS columns_dropped, every AS rows_after FROM n
          UNION ALL SELECT 2, 'R02', 'APPLIED', NULL, '', '', every FROM n
          UNION ALL SELECT 3, 'R03', 'APPLIED', NULL, '', '', final FROM n
          UNION ALL SELECT 4, 'R04', 'APPLIED', NULL, 'label', '', final FROM n
          UNION ALL SELECT 5, 'R05', 'SKIPPED_DISABLED', NULL, '', '', NULL FROM n
          UNION ALL SELECT 6, 'R06', 'SKIPPED_MISSING_COLS', 'missing columns: no_such_column',
                           '', '', NULL FROM n
          UNION ALL SELECT 7, 'R07', 'SKIPPED_DISABLED', NULL, '', '', NULL FROM n
          UNION ALL SELECT 8, 'R08', 'APPLIED', NULL, '', '', known FROM n
          UNION ALL SELECT 9, 'R09', 'APPLIED', NULL, '', 'channel,quote_type', known FROM n)""",
)
oracle(
    "rule_row_counts",
    "v_bronze",
    f"""{cleaned("train")},
    n AS (SELECT (SELECT count(*) FROM v_bronze) AS bronze, (SELECT count(*) FROM kept) AS kept,
                 (SELECT count(*) FROM last_row) AS latest,
                 (SELECT count(*) FROM last_row WHERE st IN ('EMITIDA', 'PERDIDA')) AS final,
                 (SELECT count(*) FROM silver) AS silver)
    SELECT r AS rule_id, CASE WHEN r <= 'GEN_R05' THEN bronze WHEN r = 'GEN_R06' THEN kept
                              WHEN r <= 'GEN_R09' THEN latest WHEN r <= 'GEN_R11' THEN final
                              ELSE silver END AS rows_after
    FROM n, (SELECT 'GEN_R' || lpad(CAST(i AS VARCHAR), 2, '0') AS r FROM range(1, 13) t(i))""",
)
oracle(
    "step_profile",
    "v_bronze",
    f"""{cleaned("train")}
    SELECT 'clean' AS step, 'in' AS side, count(*) AS n_rows, 17 AS n_columns FROM v_bronze
    UNION ALL SELECT 'clean', 'out', count(*), 17 FROM silver""",
)

# --- features -------------------------------------------------------------------------------

oracle(
    "hash_split",
    "v_quotes",
    f"""SELECT quote_id, {bucket(f"CAST(quote_id AS VARCHAR), status, '{fv.SPLIT_SALT}'", 1000000)}
               < 200000 AS is_valid FROM v_quotes""",
)
oracle(
    "kfold",
    "v_quotes",
    f"SELECT quote_id, CAST({bucket('CAST(quote_id AS VARCHAR), 42', 5)} AS INTEGER) AS fold FROM v_quotes",
)
oracle("sample_complement", "v_scored", f"SELECT quote_id, label FROM v_scored WHERE NOT ({VALID})")
oracle(
    "top_values",
    "v_quotes",
    """SELECT broker_id AS value, count(*) AS n_rows FROM v_quotes WHERE trim(broker_id) <> ''
       GROUP BY broker_id ORDER BY n_rows DESC, value LIMIT 10""",
)
oracle(
    "truncate_cardinality",
    "v_quotes",
    """--with
    top AS (SELECT broker_id FROM v_quotes WHERE trim(broker_id) <> '' GROUP BY broker_id
            ORDER BY count(*) DESC, broker_id LIMIT 10)
    SELECT quote_id, CASE WHEN broker_id IN (SELECT broker_id FROM top) THEN broker_id
                          ELSE 'OUTROS' END AS broker_id FROM v_quotes""",
)
OFFICES = f"""--with
    model AS (SELECT * FROM v_features WHERE NOT ({VALID})),
    valid AS (SELECT * FROM v_features WHERE {VALID}),
    top AS (SELECT office FROM model GROUP BY office ORDER BY count(*) DESC, office LIMIT 10)"""
OFFICE = "CASE WHEN office IN (SELECT office FROM top) THEN office ELSE 'OUTROS' END AS office"
oracle(
    "truncate_fit_apply",
    "v_features",
    f"{OFFICES} SELECT quote_id, {OFFICE}, priority FROM valid",
)
oracle("drop_null_features", "v_features", f"SELECT quote_id, days FROM v_features WHERE {VALID}")
oracle(
    "drop_constant_features", "v_features", f"SELECT quote_id, priority FROM v_features WHERE {VALID}"
)
oracle(
    "fit_features",
    "v_features",
    f"{OFFICES} SELECT quote_id, label, priority, {OFFICE}, premium, age, days FROM valid",
)
oracle(
    "class_weights",
    "v_quotes",
    f"""--with
    y AS (SELECT quote_id, CASE WHEN {STATUS} = 'EMITIDA' THEN 1 ELSE 0 END AS label FROM v_quotes)
    SELECT quote_id, label, round(CASE WHEN label = 1 THEN (1 - (SELECT avg(label) FROM y))
           / (SELECT avg(label) FROM y) ELSE 1.0 END, 6) AS weight FROM y""",
)

# --- clustering -----------------------------------------------------------------------------

oracle(
    "cluster_nulls",
    "v_features",
    """SELECT quote_id, round(coalesce(days, (SELECT quantile_cont(days, 0.5) FROM v_features)), 6)
              AS days, age FROM v_features""",
)
oracle(
    "cluster_nulls_drop",
    "v_features",
    "SELECT quote_id, days, age FROM v_features WHERE days IS NOT NULL",
)
ENTITY_COLS = ("rate_mean", "volume_mean", "n_products")


def scaled(center: str, width: str, value: str) -> str:
    cols = []
    for c in ENTITY_COLS:
        v = value.format(c)
        cols.append(
            f"""round(({v} - (SELECT {center.format(v)} FROM v_entities))
                / (SELECT {width.format(v, v)} FROM v_entities), 6) AS {c}"""
        )
    return f"SELECT broker_id, {', '.join(cols)} FROM v_entities"


oracle("scale_standard", "v_entities", scaled("avg({})", "stddev_pop({})", "{}"))
oracle("scale_log1p", "v_entities", scaled("avg({})", "stddev_pop({})", "ln(1 + {})"))
oracle(
    "scale_robust",
    "v_entities",
    scaled(
        "quantile_cont({}, 0.5)", "quantile_cont({}, 0.75) - quantile_cont({}, 0.25)", "CAST({} AS DOUBLE)"
    ),
)
# the scaled mean turned back is exp(mean of ln(1+x)) - 1
SUMMARY = f"""facts AS (SELECT CAST(broker_id % 3 AS VARCHAR) AS cluster, count(*) AS n_entities,
    {', '.join(f"round(exp(avg(ln(1 + {c}))) - 1, 6) AS {c}_centroid" for c in ENTITY_COLS)},
    {', '.join(f"round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS {c}_median" for c in ENTITY_COLS)}
    FROM v_entities GROUP BY ALL)"""
oracle("cluster_summary", "v_entities", f"--with\n{SUMMARY} SELECT * FROM facts")
oracle(
    "cluster_profile",
    "v_entities v_scored",
    f"""--with
    {SUMMARY}
    SELECT s.*, f.n_entities, f.rate_mean_centroid
    FROM (SELECT cluster, count(*) AS n_rows, count(*) FILTER (WHERE label = 1) AS n_pos,
                 round(avg(label), 6) AS base_rate FROM v_scored GROUP BY cluster) s
         LEFT JOIN facts f USING (cluster)""",
)
oracle(
    "cluster_coverage",
    "v_quotes v_entities",
    f"""--with
    j AS (SELECT e.broker_id AS found FROM v_quotes q
          LEFT JOIN v_entities e ON CAST({key_of("q.broker_id")} AS BIGINT) = e.broker_id)
    SELECT count(*) AS n_rows, count(found) AS n_clustered,
           round(count(found) / count(*), 4) AS coverage,
           round(count(found) / count(*), 4) < 0.8 AS low FROM j""",
)

# --- feature selection ------------------------------------------------------------------------

oracle(
    "label_audit",
    "v_quotes",
    f"""SELECT count(*) AS n_rows,
               count(*) FILTER (WHERE coalesce({STATUS}, '') NOT IN ('EMITIDA', 'PERDIDA'))
               AS n_invalid FROM v_quotes""",
)
SCORED_FEATURES = """--with
    raw AS (SELECT CASE WHEN p_partkey % 2 = 0 THEN 'm1' ELSE 'm2' END AS method,
                   CAST(p_partkey % 3 AS INTEGER) AS seed, p_brand AS feature,
                   CAST(p_size AS DOUBLE) AS importance FROM part),
    summed AS (SELECT method, seed, feature, sum(importance) AS importance FROM raw GROUP BY ALL),
    placed AS (SELECT *, row_number() OVER (PARTITION BY method, seed
                             ORDER BY importance DESC, feature) AS place,
                      count(*) OVER (PARTITION BY method, seed) AS n FROM summed),
    named AS (SELECT DISTINCT feature FROM raw UNION ALL SELECT 'unused'),
    scored AS (SELECT g.method, g.seed, f.feature, coalesce(p.importance, 0.0) AS importance,
                      coalesce(CASE WHEN n <= 1 THEN 1.0 ELSE 1 - (place - 1) / (n - 1) END, 0.0) AS score
               FROM (SELECT DISTINCT method, seed FROM raw) g, named f
                    LEFT JOIN placed p ON p.method = g.method AND p.seed = g.seed
                              AND p.feature = f.feature)"""
oracle(
    "rank_score",
    "",
    f"""{SCORED_FEATURES} SELECT method, seed, feature, round(importance, 6) AS importance,
        round(score, 6) AS score FROM scored""",
)
oracle(
    "ensemble_rank",
    "",
    f"""{SCORED_FEATURES},
    quality AS (SELECT method, avg(auc) AS auc FROM (
        SELECT method, seed, avg(importance) / 100 AS auc FROM raw GROUP BY ALL) GROUP BY method),
    weights AS (SELECT method, auc / sum(auc) OVER () AS weight FROM quality),
    final AS (SELECT feature, sum(s * weight) AS score_final FROM (
        SELECT method, feature, avg(score) AS s FROM scored GROUP BY ALL) JOIN weights USING (method)
        GROUP BY feature)
    SELECT feature, round(score_final, 6) AS score_final,
           CAST(row_number() OVER (ORDER BY round(score_final, 12) DESC, feature) AS INTEGER) AS rank_final
    FROM final""",
)


def binned(c: str) -> str:
    filled = f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM v_features))"
    edges = " UNION ".join(
        f"SELECT quantile_cont({c}, {i / 10}) AS e FROM v_features" for i in range(1, 10)
    )
    return f"""SELECT '{c}', CAST(count(e) FILTER (WHERE v > e) AS VARCHAR), label
        FROM (SELECT quote_id, label, {filled} AS v FROM v_features), ({edges})
        GROUP BY quote_id, label"""


oracle(
    "mutual_information",
    "v_features",
    f"""--with
    long AS (SELECT 'priority' AS feature, priority AS x, label AS y FROM v_features
             UNION ALL SELECT 'office', office, label FROM v_features
             UNION ALL {binned("premium")}
             UNION ALL {binned("days")}),
    n AS (SELECT count(*) AS n FROM v_features),
    xy AS (SELECT feature, x, y, count(*) / (SELECT n FROM n) AS p FROM long GROUP BY ALL),
    px AS (SELECT feature, x, sum(p) AS px FROM xy GROUP BY ALL),
    py AS (SELECT feature, y, sum(p) AS py FROM xy GROUP BY ALL)
    SELECT feature, round(greatest(sum(p * ln(p / (px * py))), 0.0), 6) AS mi
    FROM xy JOIN px USING (feature, x) JOIN py USING (feature, y) GROUP BY feature""",
)
oracle(
    "pearson_long",
    "v_features",
    " UNION ALL ".join(
        f"""SELECT '{a}' AS feature_a, '{b}' AS feature_b,
                   round(corr({a}, {b}), 6) AS correlation FROM v_features"""
        for a in ("premium", "age", "days")
        for b in ("premium", "age", "days")
    ),
)

# --- ranks and evaluation -----------------------------------------------------------------------

RANK = "row_number() OVER (ORDER BY {} DESC NULLS LAST, quote_id)"
oracle(
    "scores_wide",
    "v_scored",
    f"""SELECT quote_id, label, cluster, score_a AS p_emitida_a, score_b AS p_emitida_b,
               CAST({RANK.format('score_a')} AS INTEGER) AS rank_global_a,
               CAST({RANK.format('score_b')} AS INTEGER) AS rank_global_b,
               'D' AS mode_code, '1' AS inf_versao FROM v_scored""",
)
LONG = f"""--with
    long AS (SELECT quote_id, label, cluster, 'a' AS model_id, score_a AS score,
                    {RANK.format('score_a')} AS score_rank FROM v_scored
             UNION ALL SELECT quote_id, label, cluster, 'b', score_b,
                    {RANK.format('score_b')} FROM v_scored)"""
oracle(
    "scores_long",
    "v_scored",
    f"{LONG} SELECT quote_id, label, model_id, score, score_rank FROM long",
)
oracle(
    "global_rank",
    "v_scored",
    f"SELECT quote_id, score_a, {RANK.format('score_a')} AS score_rank FROM v_scored",
)
oracle(
    "local_rank",
    "v_scored",
    """SELECT quote_id, cluster, score_a, row_number() OVER (PARTITION BY cluster
              ORDER BY score_a DESC NULLS LAST, quote_id) AS score_rank FROM v_scored""",
)
oracle(
    "top_ranked",
    "v_scored",
    f"""SELECT quote_id, score_a, {RANK.format('score_a')} AS score_rank FROM v_scored
        ORDER BY score_rank LIMIT 10""",
)
oracle(
    "base_rate",
    "v_scored",
    """SELECT count(*) AS n_rows, count(*) FILTER (WHERE label = 1) AS n_pos,
              round(avg(label), 6) AS base_rate FROM v_scored""",
)
SWEEP = f"""{LONG},
    cells AS (SELECT model_id, i / 100 AS threshold,
                     count(*) FILTER (WHERE label = 1 AND score >= i / 100) AS tp,
                     count(*) FILTER (WHERE label = 0 AND score >= i / 100) AS fp,
                     count(*) FILTER (WHERE label = 1 AND score < i / 100) AS fn,
                     count(*) FILTER (WHERE label = 0 AND score < i / 100) AS tn
              FROM long, range(1, 100) t(i) GROUP BY ALL),
    pr AS (SELECT *, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall
           FROM cells),
    curve AS (SELECT *, CASE WHEN precision > 0 AND recall > 0
                  THEN 2 * precision * recall / (precision + recall) END AS f1,
              CASE WHEN precision > 0 AND recall > 0
                  THEN 5 * precision * recall / (4 * precision + recall) END AS f2 FROM pr)"""


def choose(metric: str, where: str, extra: str = "") -> str:
    return f"""{SWEEP} SELECT * EXCLUDE (rn){extra} FROM (SELECT *, row_number() OVER (
        PARTITION BY model_id ORDER BY {metric} DESC, threshold) AS rn FROM curve
        WHERE precision IS NOT NULL AND {metric} IS NOT NULL AND {where}) WHERE rn = 1"""


oracle("threshold_sweep", "v_scored", f"{SWEEP} SELECT * FROM curve")
oracle("select_threshold", "v_scored", choose("f2", "true"))
oracle("select_threshold_precision", "v_scored", choose("recall", "precision >= 0.4"))
oracle(
    "eval_summary",
    "v_scored",
    choose("f1", "true", ", tp + fp + fn + tn AS n_eval, (tp + fn) / (tp + fp + fn + tn) AS baseline"),
)


def walked(by: str, source: str = "long") -> str:
    """Counts per distinct score and running totals from the top."""
    return f"""per AS (SELECT {by}, score, count(*) AS n, count(*) FILTER (WHERE label = 1) AS p
            FROM {source} WHERE score IS NOT NULL GROUP BY ALL),
    walk AS (SELECT *, sum(n) OVER w AS seen, sum(p) OVER w AS hits,
                    sum(p) OVER (PARTITION BY {by}) AS all_p,
                    sum(n) OVER (PARTITION BY {by}) AS all_n
             FROM per WINDOW w AS (PARTITION BY {by} ORDER BY score DESC)),
    pts AS (SELECT *, hits / seen AS prec, hits / nullif(all_p, 0) AS rec FROM walk),
    steps AS (SELECT *, lag(prec, 1, 1.0) OVER w AS prec0, lag(rec, 1, 0.0) OVER w AS rec0
              FROM pts WINDOW w AS (PARTITION BY {by} ORDER BY score DESC)),
    area AS (SELECT {by}, any_value(all_n) AS n_scored, any_value(all_p) AS scored_pos,
                    coalesce(sum((rec - rec0) * prec), 0.0) AS ap,
                    coalesce(sum((rec - rec0) * (prec + prec0) / 2), 0.0) AS auc_pr
             FROM steps GROUP BY {by})"""


oracle(
    "average_precision",
    "v_scored",
    f"{LONG}, {walked('model_id')} SELECT model_id, round(ap, 6) AS ap FROM area",
)
oracle(
    "auc_pr",
    "v_scored",
    f"{LONG}, {walked('model_id')} SELECT model_id, round(auc_pr, 6) AS auc_pr FROM area",
)
oracle(
    "average_precision_rows",
    "v_scored",
    f"""{LONG}, r AS (SELECT model_id, label, sum(label) OVER (PARTITION BY model_id
            ORDER BY score DESC NULLS LAST, quote_id ROWS UNBOUNDED PRECEDING) / score_rank AS prec
        FROM long)
    SELECT model_id, round(avg(prec), 6) AS ap FROM r WHERE label = 1 GROUP BY model_id""",
)
F_SCORES = """2 * prec * rec / (prec + rec + 1e-10) AS f1,
    5 * prec * rec / (4 * prec + rec + 1e-10) AS f2"""
oracle(
    "pr_curve",
    "v_scored",
    f"""{LONG}, {walked('model_id')}
    SELECT model_id, score AS threshold, prec AS precision, rec AS recall, {F_SCORES} FROM pts""",
)
oracle(
    "pr_curve_at_threshold",
    "v_scored",
    f"""{LONG}, {walked('model_id')}
    SELECT score AS threshold, prec AS precision, rec AS recall, {F_SCORES} FROM pts
    WHERE model_id = 'b' ORDER BY abs(score - 0.42), score LIMIT 1""",
)


def at_k(total: str) -> str:
    return f"greatest(1, least(CAST(round_even(k / 100.0::DOUBLE * {total}, 0) AS BIGINT), {total}))"


TOPK = f"""pop AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = 1) AS n_pos FROM v_scored),
    grid AS (SELECT CAST(k AS INTEGER) AS k_pct, {at_k('n')} AS top_n, n, n_pos
             FROM pop, range(1, 101) t(k)),
    cells AS (SELECT model_id, k_pct, top_n, any_value(n) AS n, any_value(n_pos) AS n_pos,
                     count(*) FILTER (WHERE label = 1 AND score_rank <= top_n) AS tp,
                     count(*) FILTER (WHERE label = 0 AND score_rank <= top_n) AS fp,
                     count(*) FILTER (WHERE label = 1 AND score_rank > top_n) AS fn,
                     count(*) FILTER (WHERE label = 0 AND score_rank > top_n) AS tn
              FROM grid, long GROUP BY ALL),
    topk AS (SELECT model_id, k_pct, top_n, tp, fp, fn, tn, tp / top_n AS p_at_k,
                    tp / n_pos AS r_at_k, (tp / top_n) / (n_pos / n) AS lift_at_k FROM cells)"""
oracle("topk_curves", "v_scored", f"{LONG}, {TOPK} SELECT * FROM topk")
oracle(
    "topk_by_cluster",
    "v_scored",
    f"""{LONG},
    ranked AS (SELECT cluster, model_id, label, row_number() OVER (PARTITION BY cluster, model_id
                   ORDER BY score DESC NULLS LAST, quote_id) AS r FROM long),
    pop AS (SELECT cluster, model_id, count(*) AS n, sum(label) AS n_pos FROM ranked GROUP BY ALL),
    grid AS (SELECT cluster, model_id, CAST(k AS INTEGER) AS k_pct, {at_k('n')} AS top_n, n,
                    n_pos FROM pop, range(1, 101) t(k) WHERE n_pos > 0),
    cells AS (SELECT cluster, model_id, k_pct, top_n, n, n_pos,
                     count(*) FILTER (WHERE label = 1 AND r <= top_n) AS tp
              FROM grid JOIN ranked USING (cluster, model_id) GROUP BY ALL)
    SELECT cluster, model_id, k_pct, top_n, tp, tp / top_n AS p_at_k, tp / n_pos AS r_at_k,
           (tp / top_n) / (n_pos / n) AS lift_at_k FROM cells""",
)
oracle(
    "overlap_at_k",
    "v_scored",
    f"""--with
    worst AS (SELECT greatest({RANK.format('score_a')}, {RANK.format('score_b')}) AS r FROM v_scored),
    grid AS (SELECT CAST(k AS INTEGER) AS k_pct, {at_k('n')} AS top_n
             FROM (SELECT count(*) AS n FROM v_scored), range(1, 101) t(k))
    SELECT k_pct, top_n, count(*) FILTER (WHERE r <= top_n) AS n_overlap,
           count(*) FILTER (WHERE r <= top_n) / top_n AS overlap_share
    FROM grid, worst GROUP BY k_pct, top_n""",
)
oracle(
    "rank_correlation",
    "v_scored",
    f"""--with
    r AS (SELECT {RANK.format('score_a')} AS a, {RANK.format('score_b')} AS b FROM v_scored),
    c AS (SELECT round(corr(a, b), 6) AS rho FROM r)
    SELECT 'a' AS model_a, 'a' AS model_b, 1.0::DOUBLE AS rho FROM c
    UNION ALL SELECT 'a', 'b', rho FROM c UNION ALL SELECT 'b', 'a', rho FROM c
    UNION ALL SELECT 'b', 'b', 1.0::DOUBLE FROM c""",
)
oracle(
    "score_histogram",
    "v_scored",
    f"""{LONG},
    h AS (SELECT model_id, label, CAST(i AS INTEGER) AS bin, count(*) AS n_rows
          FROM long, range(50) t(i)
          WHERE score >= i * 0.02::DOUBLE
                AND (score < (i + 1) * 0.02::DOUBLE OR (i = 49 AND score <= 1)) GROUP BY ALL)
    SELECT *, n_rows / (sum(n_rows) OVER (PARTITION BY model_id, label) * 0.02::DOUBLE) AS density
    FROM h""",
)
oracle(
    "score_stats",
    "v_scored",
    f"""{LONG} SELECT model_id, label, count(*) AS n_rows, round(avg(score), 6) AS mean,
        round(stddev_samp(score), 6) AS std, min(score) AS min, max(score) AS max
    FROM long WHERE score IS NOT NULL GROUP BY ALL""",
)
oracle(
    "score_stats_by_cluster",
    "v_scored",
    f"""{LONG} SELECT model_id, cluster, count(*) AS n_rows, round(avg(score), 6) AS mean,
        round(stddev_pop(score), 6) AS std, {quantile('score', 0.25)} AS p25,
        {quantile('score', 0.5)} AS p50, {quantile('score', 0.75)} AS p75,
        {quantile('score', 0.9)} AS p90
    FROM long WHERE score IS NOT NULL GROUP BY ALL""",
)
oracle(
    "cluster_metrics",
    "v_scored",
    f"""{LONG}, {walked('cluster, model_id')},
    rates AS (SELECT cluster, model_id, count(*) AS n_rows,
                     count(*) FILTER (WHERE label = 1) AS n_pos, round(avg(label), 6) AS base_rate
              FROM long GROUP BY ALL)
    SELECT r.*, CASE WHEN n_scored >= 2 AND scored_pos BETWEEN 1 AND n_scored - 1
                     THEN round(ap, 6) END AS ap,
           CASE WHEN n_scored >= 2 AND scored_pos BETWEEN 1 AND n_scored - 1
                THEN round(auc_pr, 6) END AS auc_pr
    FROM rates r LEFT JOIN area USING (cluster, model_id)""",
)
oracle(
    "pr_curve_by_cluster",
    "v_scored",
    f"""{LONG}, {walked('cluster, model_id')}
    SELECT cluster, model_id, score AS threshold, prec AS precision, rec AS recall FROM pts
    WHERE all_p > 0 AND all_p < all_n""",
)
oracle(
    "overfit_gap",
    "v_scored",
    f"""{LONG}, parts AS (SELECT *, {VALID} AS is_valid FROM long),
    {walked('is_valid, model_id', 'parts')}
    SELECT v.model_id, round(v.ap, 6) AS ap_valid, round(v.auc_pr, 6) AS auc_pr_valid,
           round(t.ap, 6) AS ap_train, round(t.auc_pr, 6) AS auc_pr_train,
           round(t.ap - v.ap, 6) AS gap_ap, round(t.auc_pr - v.auc_pr, 6) AS gap_auc_pr
    FROM area v JOIN area t ON v.model_id = t.model_id AND v.is_valid AND NOT t.is_valid""",
)
oracle(
    "model_selection",
    "v_scored",
    f"""{LONG}, {walked('model_id')}, {TOPK}
    SELECT model_id, round(ap, 6) AS ap, round(auc_pr, 6) AS auc_pr, k_pct, p_at_k, r_at_k, lift_at_k
    FROM area JOIN topk USING (model_id) WHERE k_pct = 15""",
)

# --- fits: what must hold whatever was learned --------------------------------------------

oracle("hash_split_xx", "v_quotes", "SELECT count(*) AS n_rows, count(*) AS n_placed, true AS near_share FROM v_quotes")
oracle(
    "stratified_sample",
    "v_scored",
    """SELECT label, count(*) AS n_rows, count(DISTINCT quote_id) AS n_quotes, true AS near_share
       FROM v_scored GROUP BY label""",
)
oracle(
    "feature_vectors",
    "v_features",
    """SELECT count(*) AS n_rows, CAST(1 AS BIGINT) AS n_widths, 2 * count(*) AS n_hot,
              round(avg(coalesce(premium, (SELECT avg(premium) FROM v_features))), 6) AS premium_mean,
              round(avg(coalesce(age, (SELECT avg(age) FROM v_features))), 6) AS age_mean,
              round(avg(coalesce(days, (SELECT avg(days) FROM v_features))), 6) AS days_mean
       FROM v_features""",
)
# in each group all brokers have their group's mean as centre: the inertia is what is left in groups
_SCALED = {
    "standard": lambda c: f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()",
    "log1p_standard": lambda c: f"(ln(1 + {c}) - avg(ln(1 + {c})) OVER ()) / stddev_pop(ln(1 + {c})) OVER ()",
    "robust": lambda c: f"""({c} - quantile_cont({c}, 0.5) OVER ())
        / (quantile_cont({c}, 0.75) OVER () - quantile_cont({c}, 0.25) OVER ())""",
}


def _inertia(scaling: str) -> str:
    columns = ("rate_mean", "volume_mean", "n_products")
    scaled = ", ".join(f"{_SCALED[scaling](c)} AS x{i}" for i, c in enumerate(columns))
    spread = " + ".join(f"count(*) * var_pop(x{i})" for i in range(len(columns)))
    return f"""SELECT sum(s) AS inertia FROM (
        SELECT {spread} AS s FROM (SELECT broker_id, {scaled} FROM v_grouped_entities) GROUP BY broker_id % 3)"""


oracle(
    "kmeans_sweep",
    "v_grouped_entities",
    f"""SELECT scaling, CAST(k AS INTEGER) AS k, CASE WHEN k = 3 THEN round(inertia, 6) END AS inertia,
               k = 3 AS is_best, true AS splits
        FROM ({" UNION ALL ".join(f"SELECT '{s}' AS scaling, inertia FROM ({_inertia(s)})" for s in _SCALED)}),
             range({fv.CLUSTER_COUNTS[0]}, {fv.CLUSTER_COUNTS[-1] + 1}) r(k)""",
)
oracle(
    "kmeans_fit",
    "v_grouped_entities",
    f"""SELECT broker_id, min(broker_id) OVER (PARTITION BY broker_id % 3) AS first_broker,
               (SELECT round(inertia, 6) FROM ({_inertia("log1p_standard")})) AS inertia
        FROM v_grouped_entities""",
)
oracle(
    "fs_methods",
    "",
    f"""SELECT CAST(5 AS BIGINT) AS n_features, CAST(5 AS BIGINT) AS n_ranks, CAST(5 AS BIGINT) AS last_rank,
               CAST(5 AS BIGINT) AS n_scored, 'age' AS first_feature,
               CAST({3 * len(fv.SELECTION_SEEDS)} AS BIGINT) AS n_good_fits,
               CAST({2 * len(fv.SELECTION_SEEDS)} AS BIGINT) AS n_firsts""",
)
GRID = ", ".join(
    f"('d{d}_s{str(s).replace('.', '')}', {d}, {s}::DOUBLE)" for d in fv.GRID_DEPTHS for s in fv.GRID_STEPS
)
oracle(
    "cv_grid",
    "",
    f"SELECT *, true AS learned, true AS steady FROM (VALUES {GRID}) g(model_id, max_depth, step_size)",
)
oracle(
    "train_final",
    "v_learnable",
    f"""SELECT model_id, count(*) AS n_scored, CAST(sum(label) AS BIGINT) AS n_pos, true AS learned
        FROM v_learnable, (VALUES {GRID}) g(model_id, max_depth, step_size) GROUP BY model_id""",
)
oracle(
    "model_roundtrip",
    "v_learnable",
    "SELECT count(*) AS n_rows, CAST(0 AS DOUBLE) AS max_difference FROM v_learnable",
)
oracle(
    "score_wide",
    "v_learnable",
    f"""SELECT model_id, count(*) AS n_rows, count(*) AS n_scored, count(*) AS n_ranks, count(*) AS last_rank,
               true AS learned
        FROM v_learnable, (VALUES {GRID}) g(model_id, max_depth, step_size) GROUP BY model_id""",
)
