"""Fixed values of the quote-scoring domain: names, word lists and thresholds.

Everything here must stay as it is for results to match; logic lives elsewhere.
Identifiers that carry a company suffix are built from the ``house`` argument of the
rule catalogues, so no company name is part of the library.
"""

# Statuses.
ISSUED = "Emitida"
LOST = "Perdida"
FINAL_STATUSES = [ISSUED, LOST]
OPEN_STATUSES = ["EM ANALISE", "EM ANÁLISE", "EM NEGOCIACAO", "EM NEGOCIAÇÃO"]
REFUSED_STATUSES = ["RECUSADA PELO SUBSCRITOR", "RECUSADA PELO CORRETOR"]
STALE_DAYS = 90

# Channels, quote types and segments.
MANUAL = "MANUAL"
DIGITAL = "DIGITAL"
MANUAL_FLAGS = ["sim", "true", "1"]
MANUAL_ID_PREFIX = "C"
SAVED_FLAG = "SIM"
NEW_QUOTE = "Seguro Novo"
SIMILAR_RENEWAL = "renovação congênere"
SEGMENT_CHANNELS = {"digital": "DIGITAL", "manual": "MANUAL"}
SEGMENT_NEW_TYPE = {"seguro novo": "SEGURO_NOVO"}
SEGMENT_RENEWAL_WORDS = ["renovação", "renovacao"]
SEGMENT_RENEWAL = "RENOVACAO"

# Sentinel dates.
LAST_VALID_YEAR = 2027
EMPTY_DATE = "1900-01-01"

# Months left out of training.
EXCLUDED_MONTHS = ["2025-11", "2025-12"]

# Decimal columns.
QUOTE_MONEY = ["VL_ENDOSSO_PREMIO_TOTAL", "VL_PREMIO_ALVO", "VL_PREMIO_LIQUIDO", "VL_PRE_TOTAL"]
SUMMARY_MONEY = ["VL_GWP_CORRETOR"]
DETAIL_RATES = ["HR_2024", "HR_2025", "HR_M2", "HR_M3"]

# Dates turned into day counts against the reference date.
DAYS_TO_REFERENCE = {
    "DT_VALIDADE": "DIAS_VALIDADE",
    "DT_ANALISE_SUBSCRICAO": "DIAS_ANALISE_SUBSCRICAO",
    "DT_FIM_ANALISE_SUBSCRICAO": "DIAS_FIM_ANALISE_SUBSCRICAO",
}

# Columns dropped by the cleaning rules.
QUOTE_DROPS = [
    "TS_ATUALIZACAO",
    "SOURCE_FILE",
    "DS_MOTIVO_ENDOSSO",
    "DS_REPIQUE_ACAO",
    "DS_REPIQUE_MOTIVO",
    "DS_REPIQUE_ATENDIMENTO",
    "FL_PROPOSTA",
    "FL_REPIQUE",
    "FL_ENDOSSO",
    "DS_FAROL",
    "ANO_COTACAO",
    "MES_COTACAO",
    "DIA_COTACAO",
    "REF_TS",
    "DS_GRUPO_STATUS_OLD",
    "DS_TIPO_SEGURO",
    "CD_NUM_PROPOSTA",
    "FL_ENDOSSO_RESTITUICAO",
    "DS_NOME_VERSAO_CALCULO",
    "DS_STATUS",
    "DS_CORRETOR_SEGMENTO",
    "DS_SUBSCRITOR",
    "FL_ANALISE_SUBSCRICAO",
    "FL_SALVO",
    "FL_PERDIDA_90D",
    "REF_DATE",
    "TS_FECHAMENTO_EMITIDA",
    "TS_FECHAMENTO_PERDIDA_NAT",
]
QUOTE_DROPS_WITH_HOUSE = ["CD_NUMERO_APOLICE", "CD_NUMERO_ENDOSSO", "CD_FILIAL"]
SUMMARY_TECHNICAL_DROPS = [
    "TS_ARQ",
    "TS_ATUALIZACAO",
    "SOURCE_FILE",
    "DS_GRUPO_CORRETOR",
    "DT_APROVACAO_CADASTRO",
]
SUMMARY_EXTRA_DROPS = [
    "DS_CORRETOR",
    "DS_SEGMENTACAO",
    "DS_SUCURSAL_AUTORIZA_EMISSAO",
    "DS_SEGMENTACAO_GRUPO",
    "DS_CANAL_COMERCIAL",
]
SUMMARY_FLAG_DROPS = ["FL_PERMITE_ANTECIPAR", "FL_ACORDO_GENERALISTA", "FL_ACORDO_ESPECIFICO"]
DETAIL_DROPS = ["TS_ARQ", "TS_ATUALIZACAO", "SOURCE_FILE"]

# Feature preparation, split and training.
VALID_FRACTION = 0.20
SPLIT_SALT = "split_c1_seg_mes"
NULL_DROP_SHARE = 0.90
HIGH_CARDINALITY = 15
TOP_VALUES = 10
OTHERS = "OUTROS"
CLASS_WEIGHT_THRESHOLD = 0.30
SELECTION_SEEDS = [42, 123, 7]
SELECTION_TRAIN_FRACTION = 0.70
CV_FOLDS = 2
CV_SEED = 42
GRID_DEPTHS = [4, 6]
GRID_STEPS = [0.1, 0.05]
GRID_ITERATIONS = 100
FINAL_ITERATIONS = 150
SUBSAMPLING = 0.8
CLUSTER_COUNTS = list(range(2, 16))
CLUSTER_RESTARTS = 10
CLUSTER_SEED = 42
MIN_CLUSTER_COVERAGE = 0.80

# Score columns and ranking.
SCORE_PREFIX = "p_emitida_"
RANK_PREFIX = "rank_global_"
REFERENCE_K = 15
