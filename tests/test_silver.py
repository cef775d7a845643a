"""Public headers to canonical policies, with the documented traps in the rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldmark.operators.dimensions import code_table
from fieldmark.plans import silver
from fieldmark.plans.schema import POLICY_COLUMNS
from fieldmark.sources import headers

BASE = {
    "ID_PROPOSTA": "1", "NR_APOLICE": "A1", "DT_PROPOSTA": dt.date(2020, 1, 1), "DT_APOLICE": dt.date(2020, 1, 2),
    "DT_INICIO_VIGENCIA": dt.date(2020, 1, 10), "DT_FIM_VIGENCIA": dt.date(2020, 6, 1), "NM_RAZAO_SOCIAL": " Aliança S/A ",
    "NM_SEGURADO": "someone", "NM_MUNICIPIO_PROPRIEDADE": "São Thomé", "SG_UF_PROPRIEDADE": "SP", "CD_GEOCMU": "35",
    "LATITUDE": "S", "NR_GRAU_LAT": "10", "NR_MIN_LAT": "30", "NR_SEG_LAT": "0", "LONGITUDE": "W", "NR_GRAU_LONG": "50",
    "NR_MIN_LONG": "0", "NR_SEG_LONG": "0", "NM_CLASSIF_PRODUTO": "CUSTEIO", "NM_CULTURA_GLOBAL": "Milho 1ª safra",
    "NR_AREA_TOTAL": "10", "NR_ANIMAL": "-", "VL_LIMITE_GARANTIA": "1000.5", "VL_PREMIO_LIQUIDO": "50", "PE_TAXA": None,
    "VALOR_INDENIZACAO": "25", "EVENTO_PREPONDERANTE": " CHUVA  EXCESSIVA ",
}


def build(spark, *changes, **options):
    rows = [{**BASE, "ID_PROPOSTA": str(i), **c} for i, c in enumerate(changes)]
    values = [tuple(r.get(h) for h in headers.SOURCE_HEADERS) for r in rows]
    source = spark.createDataFrame(values, headers.SOURCE_SCHEMA).withColumnRenamed("VALOR_INDENIZACAO", "VALOR_INDENIZAÇÃO")
    dims = silver.Dimensions(
        product_types=code_table(spark, {"CUSTEIO": "cost"}),
        perils=code_table(spark, {"CHUVA EXCESSIVA": "rain"}),
        crop_groups=code_table(spark, {"Milho 1ª safra": "grain", "Café": "perennial"}),
        insurers=code_table(spark, {"Aliança S/A": "alianca"}),
        regions=code_table(spark, {"SP": "South-east"}),
    )
    out = silver.build(silver.union_sources(headers.with_raw_names(source)), dims, silver.Options(**options))
    return {r.policy_id: r for r in out.collect()}, out


def test_one_record(spark):
    rows, out = build(spark, {})
    row = rows["A1"]
    assert out.columns == [c for c in POLICY_COLUMNS if c in out.columns] and len(out.columns) == 27
    assert (row.lat, row.lon) == (-10.5, -50.0)
    assert (row.area_id, row.place_name, row.state, row.region) == (35, "sao_tome", "SP", "South-east")
    # The accented dictionary key matches, because it is folded like the data.
    assert (row.insurer, row.product_type, row.peril, row.claim) == ("alianca", "cost", "rain", 1)
    assert (row.head_count, row.area_ha, row.sum_insured, row.rate) == (0, 10.0, 1000.5, 0.0)
    assert (row.loss_ratio, row.duration_days) == (0.5, 143)
    assert row.crop_group == "grain"


@pytest.mark.parametrize("folded, group", [(False, "other"), (True, "grain")])
def test_ordinal_marks(spark, folded, group):
    rows, _ = build(spark, {"NM_CULTURA_GLOBAL": "Milho 1a safra"}, fold_marks=folded)
    assert rows["A1"].crop_group == group


def test_dropped_rows(spark):
    rows, _ = build(
        spark,
        {"NR_APOLICE": "late", "DT_FIM_VIGENCIA": dt.date(5207, 5, 9)},
        {"NR_APOLICE": "open", "DT_FIM_VIGENCIA": None},
        {"NR_APOLICE": "nowhere", "SG_UF_PROPRIEDADE": "-"},
        {"NR_APOLICE": "blank", "SG_UF_PROPRIEDADE": None},
        {"NR_APOLICE": "kept"},
    )
    assert set(rows) == {"kept"}


def test_perils_and_ratios(spark):
    rows, _ = build(
        spark,
        {"NR_APOLICE": "none", "EVENTO_PREPONDERANTE": None, "VALOR_INDENIZACAO": None},
        {"NR_APOLICE": "dash", "EVENTO_PREPONDERANTE": "-"},
        {"NR_APOLICE": "odd", "EVENTO_PREPONDERANTE": "GEADA"},
        {"NR_APOLICE": "free", "VL_PREMIO_LIQUIDO": None},
    )
    assert {k: (r.peril, r.claim) for k, r in rows.items()} == {
        "none": ("none", 0), "dash": ("none", 0), "odd": ("GEADA", 1), "free": ("rain", 1),
    }
    assert rows["free"].loss_ratio == 0.0 and rows["none"].loss_ratio == 0.0
    kept, _ = build(spark, {"VL_PREMIO_LIQUIDO": None, "PE_TAXA": None}, fill_nulls=False, loss_ratio_without_premium=None)
    assert kept["A1"].loss_ratio is None and kept["A1"].rate is None


def test_personal_data_is_gone(spark):
    _, out = build(spark, {})
    assert not {"insured_name", "insured_document", "proposal_id"} & set(out.columns)
    assert out.filter(F.col("policy_id").isNull()).isEmpty()
