import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldmark.operators.quality import assert_key, key_violations
from fieldmark.sources import readers, writers

SCHEMA = "k int, d date, s string"
ROWS = [(1, dt.date(2020, 1, 1), "a"), (2, None, "é")]


@pytest.mark.parametrize("fmt", ["csv", "parquet", "json", "orc"])
def test_read_formats(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    writer = spark.createDataFrame(ROWS, SCHEMA).write.format(fmt)
    (writer.option("header", "true") if fmt == "csv" else writer).save(path)
    back = readers.read_table(spark, path, fmt, SCHEMA)
    assert sorted(map(tuple, back.collect())) == ROWS


def test_bad_reads(spark, tmp_path):
    with pytest.raises(ValueError):
        readers.read_table(spark, "x", "xlsx")
    with pytest.raises(ValueError):
        readers.read_table(spark, "x", "csv")
    assert readers.read_if_present(spark, str(tmp_path / "none")) is None
    broken = tmp_path / "broken.parquet"
    broken.write_text("not parquet")
    with pytest.raises(Exception):
        readers.read_if_present(spark, str(broken))


def test_schema_difference(spark):
    left = spark.createDataFrame([], "a int, b string")
    right = spark.createDataFrame([], "a bigint, c string")
    rows = {tuple(r) for r in readers.schema_difference(left, right).collect()}
    assert rows == {("a", "int", "bigint"), ("b", "string", None), ("c", None, "string")}
    assert readers.same_columns(left, left) and not readers.same_columns(left, right)
    assert readers.empty_like(left).columns == ["a", "b"]


def test_overwrite_replaces_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    assert writers.overwrite(spark.range(5), path) == 5
    assert writers.overwrite(spark.createDataFrame(ROWS, SCHEMA), path, ["s"]) == 2
    assert set(spark.read.parquet(path).columns) == {"k", "d", "s"}


def table(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


def test_upsert_and_versions(spark, tmp_path):
    path = str(tmp_path / "u")
    assert writers.upsert(table(spark, [(1, "a"), (2, "b")]), path, ["k"]) == 1
    assert writers.upsert(table(spark, [(2, "B"), (3, "c")]), path, ["k"]) == 2
    assert sorted(map(tuple, writers.read_latest(spark, path).collect())) == [(1, "a"), (2, "B"), (3, "c")]
    assert writers.latest_version(spark, path, "1") == 1
    for bad in ("7", "x"):
        with pytest.raises(ValueError):
            writers.latest_version(spark, path, bad)
    # A version that was not finished is not read.
    (tmp_path / "u" / "v000003").mkdir()
    assert writers.latest_version(spark, path) == 2
    with pytest.raises(ValueError):
        writers.upsert(table(spark, [(1, "x"), (1, "y")]), path, ["k"])


def test_replace_partitions(spark, tmp_path):
    path = str(tmp_path / "m")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, m string")
    writers.overwrite(df, path, ["m"])
    writers.replace_partitions(spark.createDataFrame([(9, "b")], "n int, m string"), path, ["m"])
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(1, "a"), (9, "b")}


def test_key_contract(spark):
    rows = [(1, "a"), (1, "b"), (None, "c"), (2, "d")]
    assert {(r.k, r.n_rows) for r in key_violations(table(spark, rows), ["k"]).collect()} == {(1, 2), (None, 1)}
    with pytest.raises(ValueError):
        assert_key(table(spark, rows), ["k"])
    assert_key(table(spark, rows[3:]), ["k"])


def test_geography(spark):
    source = spark.createDataFrame([(1, 35, "São Thomé"), (2, 99, "B")], "id int, uf int, nm string")
    out = readers.geography(source, {"id": "code", "uf": "state", "nm": "name"}, ["name"], "state", {35: "SP"})
    assert {tuple(r) for r in out.collect()} == {(1, "SP", "sao_tome"), (2, "99", "b")}
