"""Column headers of the public policy files and the raw names used here."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

from fieldmark.functions.text import strip_accents_name

# Header in the public files, in file order, to raw column name.
SOURCE_HEADERS = {
    "NM_RAZAO_SOCIAL": "insurer_name",
    "CD_PROCESSO_SUSEP": "process_code",
    "NR_PROPOSTA": "proposal_no",
    "ID_PROPOSTA": "proposal_id",
    "DT_PROPOSTA": "proposed_on",
    "DT_INICIO_VIGENCIA": "start_text",
    "DT_FIM_VIGENCIA": "end_text",
    "NM_SEGURADO": "insured_name",
    "NR_DOCUMENTO_SEGURADO": "insured_document",
    "NM_MUNICIPIO_PROPRIEDADE": "place_text",
    "SG_UF_PROPRIEDADE": "state_code",
    "LATITUDE": "lat_half",
    "NR_GRAU_LAT": "lat_deg",
    "NR_MIN_LAT": "lat_min",
    "NR_SEG_LAT": "lat_sec",
    "LONGITUDE": "lon_half",
    "NR_GRAU_LONG": "lon_deg",
    "NR_MIN_LONG": "lon_min",
    "NR_SEG_LONG": "lon_sec",
    "NR_DECIMAL_LATITUDE": "lat_decimal",
    "NR_DECIMAL_LONGITUDE": "lon_decimal",
    "NM_CLASSIF_PRODUTO": "product_class",
    "NM_CULTURA_GLOBAL": "crop_name",
    "NR_AREA_TOTAL": "area_text",
    "NR_ANIMAL": "head_text",
    "NR_PRODUTIVIDADE_ESTIMADA": "expected_yield_text",
    "NR_PRODUTIVIDADE_SEGURADA": "insured_yield_text",
    "NivelDeCobertura": "coverage_text",
    "VL_LIMITE_GARANTIA": "sum_text",
    "VL_PREMIO_LIQUIDO": "premium_value",
    "PE_TAXA": "rate_value",
    "VL_SUBVENCAO_FEDERAL": "subsidy_value",
    "NR_APOLICE": "policy_no",
    "DT_APOLICE": "issued_on",
    "ANO_APOLICE": "issue_year",
    "CD_GEOCMU": "place_code",
    "VALOR_INDENIZACAO": "indemnity_value",
    "EVENTO_PREPONDERANTE": "peril_text",
}
DATE_HEADERS = ("DT_PROPOSTA", "DT_INICIO_VIGENCIA", "DT_FIM_VIGENCIA", "DT_APOLICE")

SOURCE_SCHEMA = T.StructType(
    [T.StructField(h, T.DateType() if h in DATE_HEADERS else T.StringType()) for h in SOURCE_HEADERS]
)


def with_raw_names(df: DataFrame) -> DataFrame:
    """Public headers, accented or not, to raw names; other columns keep theirs."""
    plain = df.toDF(*[strip_accents_name(c) for c in df.columns])
    return plain.withColumnsRenamed({h: n for h, n in SOURCE_HEADERS.items() if h in plain.columns})
