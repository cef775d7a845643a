"""Small fixtures for the documented traps of the cleaning steps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldmark.functions import dates, numbers, text
from fieldmark.operators import cleaning, dedup, dimensions, quality
from fieldmark.plans import silver


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v"))).first()[0]


def test_text(spark):
    assert one(spark, "INUNDAÇÃO", text.strip_accents) == "INUNDACAO"
    assert one(spark, "Milho 1ª safra", text.strip_accents) == "Milho 1ª safra"
    assert one(spark, "Milho 1ª D´ÁGUA", lambda c: text.strip_accents(c, fold_marks=True)) == "Milho 1a D'AGUA"
    assert one(spark, " a  b\t c ", text.collapse_spaces) == "a b c"
    assert one(spark, " São Thomé-d'Oeste  Güe", text.slug) == "sao_tome_doeste_gue"
    assert text.strip_accents_name("VALOR_INDENIZAÇÃO") == "VALOR_INDENIZACAO"


@pytest.mark.parametrize("value, want", [("1", 1), ("1.0", 1), ("abc", None), ("", None), (None, None), ("1,5", None)])
def test_guarded_int(spark, value, want):
    assert one(spark, value, numbers.to_int) == want


@pytest.mark.parametrize("value, want", [("1,5", 1.5), ("1.234,56", 1234.56), ("x", None), (None, None), ("7", 7.0)])
def test_decimal_comma(spark, value, want):
    assert one(spark, value, numbers.from_decimal_comma) == want


def test_dates(spark):
    assert one(spark, "n/d", dates.parse_date) is None
    assert one(spark, "5207-05-09", dates.parse_date) == dt.date(5207, 5, 9)
    df = spark.createDataFrame([("2035-12-31",), ("2036-01-01",), (None,), ("5207-05-09",)], "v string")
    kept = cleaning.plausible_end(df.select(F.col("v").cast("date").alias("v")), "v").collect()
    assert [r.v for r in kept] == [dt.date(2035, 12, 31)]


def test_signed_degrees(spark):
    rows = [("10", "30", "36", "S"), ("10", "30", "36", "s"), ("10", "30", "36", "N"), (None, "1", "1", "S"), ("a", "1", "1", "S")]
    df = spark.createDataFrame(rows, "d string, m string, s string, h string")
    got = [r[0] for r in df.select(numbers.signed_degrees(*[F.col(c) for c in "dmsh"], "S")).collect()]
    assert got[:3] == pytest.approx([-10.51, -10.51, 10.51]) and got[3:] == [None, None]


def test_ratio(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0), (None, 2.0), (1.0, None)], "a double, b double")
    pairs = df.select(numbers.ratio(F.col("a"), F.col("b")), numbers.ratio(F.col("a"), F.col("b"), 0.0)).collect()
    assert [tuple(p) for p in pairs] == [(None, 0.0), (0.25, 0.25), (None, None), (None, None)]


def test_sentinels_only_whole_values(spark):
    df = spark.createDataFrame([("-", "a-b", 1), ("...", "X", 2)], "a string, b string, n int")
    assert [tuple(r) for r in cleaning.replace_sentinels(df).collect()] == [("0", "a-b", 1), ("0", "0", 2)]


def test_dedup_order_and_nulls(spark):
    rows = [("a", "2020-02-01", "2020-02-09", 1), ("a", "2020-01-01", "2020-01-02", 2), ("a", "2020-01-01", "2020-01-05", 3),
            (None, "2020-01-01", "2020-01-01", 4), (None, "2020-01-02", "2020-01-01", 5), ("b", "2020-01-01", "2020-01-01", 7),
            ("b", "2020-01-01", "2020-01-01", 6)]
    df = spark.createDataFrame(rows, "id string, proposed string, issued string, n int")
    order = [F.col("proposed").asc(), F.col("issued").desc()]
    kept = {r.n for r in dedup.deduplicate(df, "id", order).collect()}
    assert kept == {3, 6, 4, 5}
    collapsed = {r.n for r in dedup.deduplicate(df, "id", order, keep_null_keys=False).collect()}
    assert collapsed == {3, 6, 4}


def test_dedup_prefers_values_to_nulls_among_equals(spark):
    rows = [("a", 1, None), ("a", 1, "2020-05-01"), ("a", 1, "2020-06-01"), ("b", 1, None)]
    df = spark.createDataFrame(rows, "id string, proposed int, ends string")
    kept = {(r.id, r.ends) for r in dedup.deduplicate(df, "id", [F.col("proposed").asc()]).collect()}
    assert kept == {("a", "2020-05-01"), ("b", None)}


def test_dedup_limits_keys_before_the_shuffle(spark):
    df = spark.range(10).withColumn("k", F.col("id") % 3)
    plan = dedup.first_per_key(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_mapping(spark):
    dim = dimensions.normalised(dimensions.code_table(spark, {"INUNDAÇÃO": "flood", "SECA": "drought"}))
    df = spark.createDataFrame([("INUNDACAO",), ("GEADA",), (None,)], "p string")
    kept = {r.p for r in dimensions.map_code(df, "p", dim).collect()}
    assert kept == {"flood", "GEADA", None}
    other = {r.g for r in dimensions.map_code(df, "p", dim, "g", default="other", keep_unmapped=False).collect()}
    assert other == {"flood", "other"}
    assert {(r.code, r.n_rows) for r in quality.unmapped_codes(df, "p", dim).collect()} == {("GEADA", 1), (None, 1)}


def test_name_correction_is_one_pass(spark):
    fixes = spark.createDataFrame([("a", "b", "S"), ("b", "c", "S")], "old_name string, new_name string, state string")
    df = spark.createDataFrame([("a", "S"), ("b", "T")], "n string, st string")
    assert [r.n for r in dimensions.correct_names(df, "n", fixes).orderBy("st").collect()] == ["b", "c"]
    assert [r.n for r in dimensions.correct_names(df, "n", fixes, "st").orderBy("st").collect()] == ["b", "b"]


def test_place_codes(spark):
    places = spark.createDataFrame([("x", "S", 10)], "name string, state string, code int")
    districts = spark.createDataFrame([("y", "S", 20, "seat"), ("x", "S", 99, "no")], "district string, state string, code int, place_name string")
    rows = [("x", "S", 0), ("y", "S", 0), ("y", "S", None), ("y", "S", 5), ("z", "S", 0), ("x", "T", 7)]
    df = spark.createDataFrame(rows, "place_name string, state string, place_code int")
    got = [(r.place_name, r.place_code) for r in dimensions.place_codes(df, places, districts).collect()]
    assert sorted(got, key=repr) == sorted(
        [("x", 10), ("seat", 20), ("seat", 20), ("y", 5), ("z", None), ("x", 7)], key=repr
    )


def test_fill_and_nulls(spark):
    df = spark.createDataFrame([(None, None, None), ("a", 1, 2.0)], "s string, n int, d double")
    assert [tuple(r) for r in cleaning.fill_by_type(df).collect()] == [("0", 0, 0.0), ("a", 1, 2.0)]
    assert [r.d for r in cleaning.fill_with_mean(df, "d").collect()] == [2.0, 2.0]
    assert cleaning.drop_all_null(df).count() == 1 and cleaning.rows_with_null(df).count() == 1
    assert {(r.column, r.n_null) for r in quality.null_counts(df).collect()} == {("s", 1), ("n", 1), ("d", 1)}


def test_claim_flag_counts_unmapped_perils(spark):
    df = spark.createDataFrame([("none",), ("",), ("odd",), (None,)], "p string")
    assert [r[0] for r in df.select(silver.claim_flag(F.col("p"))).collect()] == [0, 1, 1, 1]


def test_sources_are_aligned_as_text(spark):
    left = spark.createDataFrame([(1, dt.date(2020, 1, 1))], "a int, d date")
    right = spark.createDataFrame([("x", 2.5)], "a string, extra double")
    both = silver.union_sources(left, right)
    assert dict(both.dtypes) == {"a": "string", "d": "date", "extra": "string"}
    assert {tuple(r) for r in both.collect()} == {("1", dt.date(2020, 1, 1), None), ("x", None, "2.5")}


def test_date_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(dt.date(2020, 1, 1), 1)], "end_date date, n int").write.parquet(path)
    plan = cleaning.plausible_end(spark.read.parquet(path), "end_date")._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(end_date,2036-01-01)" in plan


def test_fold_created_duplicates_are_an_error(spark):
    rows = spark.createDataFrame([("GRANIZO",)], "peril string")
    same = dimensions.normalised(dimensions.code_table(spark, {"GRANÍZO": "hail", "GRANIZO": "hail"}))
    assert [r.peril for r in dimensions.map_code(rows, "peril", same).collect()] == ["hail"]
    differ = dimensions.normalised(dimensions.code_table(spark, {"GRANÍZO": "hail", "GRANIZO": "rain"}))
    with pytest.raises(ValueError, match="several values"):
        dimensions.map_code(rows, "peril", differ)


def test_dedup_reads_its_source_once(spark, tmp_path):
    rows = [("a", 2), ("a", 1), (None, 3), (None, 3), ("b", 1)]
    spark.createDataFrame(rows, "id string, n int").write.parquet(str(tmp_path / "t"))
    kept = dedup.deduplicate(spark.read.parquet(str(tmp_path / "t")), "id", [F.col("n").asc()])
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([("a", 1), ("b", 1), (None, 3), (None, 3)], key=repr)
    assert kept._jdf.queryExecution().sparkPlan().toString().count("FileScan parquet") == 1
