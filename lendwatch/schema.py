"""Column lists of the raw file and of the staging table."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw file's columns in file order.
TEXT_COLUMNS = [
    "uf",
    "segmento",
    "cliente",
    "cnae_ocupacao",
    "porte",
    "modalidade",
    "submodalidade",
    "origem",
    "indexador",
]
AMOUNT_COLUMNS = [
    "a_vencer_ate_90_dias",
    "a_vencer_de_91_ate_360_dias",
    "a_vencer_de_361_ate_1080_dias",
    "a_vencer_de_1081_ate_1800_dias",
    "a_vencer_de_1801_ate_5400_dias",
    "a_vencer_acima_de_5400_dias",
    "carteira_a_vencer",
    "vencido_de_15_ate_90_dias",
    "vencido_acima_de_90_dias",
    "carteira_vencida",
    "carteira_ativa",
    "carteira_inadimplencia",
    "ativo_problematico",
]
DATE_COLUMN = "data_base"
COUNT_COLUMN = "numero_de_operacoes"
RAW_COLUMNS = [DATE_COLUMN, *TEXT_COLUMNS, COUNT_COLUMN, *AMOUNT_COLUMNS]

BRONZE_SCHEMA = T.StructType(
    [T.StructField(DATE_COLUMN, T.DateType())]
    + [T.StructField(c, T.StringType()) for c in TEXT_COLUMNS]
    + [T.StructField(COUNT_COLUMN, T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in AMOUNT_COLUMNS]
    + [T.StructField("source_file", T.StringType())]
)
# Good and rejected rows share one table; ``value`` is kept for rejected ones.
PARSED_SCHEMA = T.StructType(
    BRONZE_SCHEMA.fields
    + [
        T.StructField("value", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("rejected", T.BooleanType()),
    ]
)

# Staging name -> raw name.
STAGING_COLUMNS = {
    "reference_date": "data_base",
    "state": "uf",
    "institution_segment": "segmento",
    "client_type": "cliente",
    "economic_activity": "cnae_ocupacao",
    "client_size": "porte",
    "credit_modality": "modalidade",
    "credit_submodality": "submodalidade",
    "number_of_operations": "numero_de_operacoes",
    "outstanding_balance": "carteira_a_vencer",
    "overdue_balance": "carteira_vencida",
    "overdue_15_to_90_balance": "vencido_de_15_ate_90_dias",
    "overdue_over_90_balance": "vencido_acima_de_90_dias",
    "active_portfolio": "carteira_ativa",
    "default_portfolio": "carteira_inadimplencia",
    "problem_assets": "ativo_problematico",
}

MEASURES = [
    "number_of_operations",
    "outstanding_balance",
    "overdue_balance",
    "overdue_15_to_90_balance",
    "overdue_over_90_balance",
    "active_portfolio",
    "default_portfolio",
    "problem_assets",
]
