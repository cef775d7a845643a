"""The policy and raw tables that the registered queries read.

Both are derived from the given star-schema tables, row for row from
``lineitem``.  The column expressions are valid in Spark and in DuckDB alike, so
each is stated once.  On the Spark side only the joins that the requested
columns need are made, and only their columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldmark.session import broadcast_if_small


START = "CAST(o_orderdate AS DATE)"
DURATION = "CAST(30 + (l_partkey * 7 + l_linenumber * 13) % 336 AS INT)"

# column: (expression, tables it needs besides lineitem)
POLICY = {
    "policy_id": ("l_orderkey - l_linenumber", ()),
    "start_date": (START, ("orders",)),
    "end_date": (f"{START} + {DURATION}", ("orders",)),
    "duration_days": (DURATION, ()),
    "area_id": ("CAST(o_custkey % 100 AS INT)", ("orders",)),
    "place_name": ("c_mktsegment", ("orders", "customer")),
    "state": ("n_name", ("orders", "customer", "nation")),
    "region": ("r_name", ("orders", "customer", "nation", "region")),
    "insurer": ("s_name", ("supplier",)),
    "product_type": ("o_orderpriority", ("orders",)),
    "crop_group": ("p_type", ("part",)),
    "crop": ("p_brand", ("part",)),
    "peril": (
        "CASE l_returnflag WHEN 'N' THEN 'none' WHEN 'R' THEN concat('peril_', l_linestatus) ELSE 'peril_x' END",
        (),
    ),
    "claim": ("CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END", ()),
    "area_ha": ("l_quantity", ()),
    "head_count": ("CASE WHEN l_linenumber % 3 = 0 THEN l_linenumber ELSE 0 END", ()),
    "expected_yield": ("CAST(p_size - 1 AS DOUBLE)", ("part",)),
    "insured_yield": ("p_size * (0.5e0 + 4e0 * l_discount)", ("part",)),
    "coverage_level": ("0.5e0 + 4e0 * l_discount", ()),
    "sum_insured": ("l_extendedprice", ()),
    "premium": ("l_extendedprice * (l_tax + 0.01e0)", ()),
    "rate": ("l_tax", ()),
    "subsidy": ("l_extendedprice * l_tax * l_discount", ()),
    "indemnity": ("CASE WHEN l_returnflag = 'N' THEN 0e0 ELSE l_extendedprice * l_discount END", ()),
    "loss_ratio": (
        "CASE WHEN l_extendedprice = 0 OR l_returnflag = 'N' THEN 0e0"
        " ELSE l_discount / (l_tax + 0.01e0) END",
        (),
    ),
}

CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"

# Dirty text as source files have it: accents, markers, decimal commas, bad dates.
RAW = {
    "proposal_id": (
        "CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_orderkey - l_linenumber AS STRING) END",
        (),
    ),
    "policy_no": ("CAST(l_orderkey - l_linenumber AS STRING)", ()),
    "proposed_on": (f"{START} - CAST(l_partkey % 45 AS INT)", ("orders",)),
    "issued_on": (f"{START} + CAST(l_suppkey % 10 AS INT)", ("orders",)),
    "start_text": (f"CAST({START} AS STRING)", ("orders",)),
    "end_text": (
        "CASE WHEN l_partkey % 101 = 0 THEN '5207-05-09' WHEN l_partkey % 103 = 0 THEN NULL"
        f" WHEN l_partkey % 107 = 0 THEN 'n/d' ELSE CAST({START} + {DURATION} AS STRING) END",
        ("orders",),
    ),
    "insured_name": ("c_name", ("orders", "customer")),
    "insured_document": ("CAST(c_custkey * 7919 AS STRING)", ("orders", "customer")),
    "insurer_name": ("concat(' Companhía ', CAST(s_suppkey % 20 AS STRING), ' de Seguros S/A ')", ("supplier",)),
    "place_text": (
        "concat('  São ', c_mktsegment, '-d''Oeste  Thomé ', CAST(c_custkey % 40 AS STRING))",
        ("orders", "customer"),
    ),
    "state_code": ("CASE WHEN n_nationkey = 24 THEN '-' ELSE n_name END", ("orders", "customer", "nation")),
    "place_code": (
        "CASE WHEN o_custkey % 10 < 2 THEN '...' WHEN o_custkey % 10 = 2 THEN NULL"
        " WHEN o_custkey % 10 = 3 THEN concat(CAST(o_custkey % 40 AS STRING), '.0')"
        " ELSE CAST(o_custkey % 40 AS STRING) END",
        ("orders",),
    ),
    "product_class": (
        "CASE l_linenumber % 5 WHEN 0 THEN 'CUSTEIO' WHEN 1 THEN 'PRODUTIVIDADE' WHEN 2 THEN 'PECUÁRIO'"
        " WHEN 3 THEN 'X' ELSE ' RECEITA ' END",
        (),
    ),
    "crop_name": ("concat(p_brand, CASE WHEN p_size % 2 = 0 THEN ' 1ª safra' ELSE ' Feijão' END)", ("part",)),
    "peril_text": (
        "CASE WHEN l_returnflag = 'N' THEN CASE WHEN l_partkey % 2 = 0 THEN NULL ELSE '-' END"
        " WHEN l_returnflag = 'R' THEN concat(' INUNDAÇÃO  TROMBA', chr(160), l_linestatus) ELSE 'GRANIZO ' END",
        (),
    ),
    "area_text": ("CAST(CAST(l_quantity AS INT) AS STRING)", ()),
    "head_text": (
        "CASE l_linenumber WHEN 1 THEN '-' WHEN 2 THEN '12' WHEN 3 THEN '7.0' WHEN 4 THEN 'abc'"
        " WHEN 5 THEN NULL ELSE '0' END",
        (),
    ),
    "sum_text": (
        f"concat(CAST(CAST(floor({CENTS} / 100000) AS BIGINT) AS STRING), '.',"
        f" lpad(CAST(CAST(floor({CENTS} / 100) AS BIGINT) % 1000 AS STRING), 3, '0'), ',',"
        f" lpad(CAST({CENTS} % 100 AS STRING), 2, '0'))",
        (),
    ),
    "premium_value": ("CASE WHEN l_linenumber = 6 THEN 0e0 ELSE l_extendedprice * (l_tax + 0.01e0) END", ()),
    "rate_value": ("CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE l_tax END", ()),
    "indemnity_value": (
        "CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_extendedprice * l_discount END",
        (),
    ),
    "lat_deg": ("CAST(l_partkey % 33 AS STRING)", ()),
    "lat_min": ("CAST(l_partkey % 60 AS STRING)", ()),
    "lat_sec": ("CASE WHEN l_linenumber = 4 THEN 'x' ELSE CAST(l_suppkey % 60 AS STRING) END", ()),
    "lat_half": ("CASE WHEN l_partkey % 5 = 0 THEN 'N' WHEN l_partkey % 5 = 1 THEN 's' ELSE 'S' END", ()),
}

JOINS = {
    "orders": ("l_orderkey", "o_orderkey"),
    "customer": ("o_custkey", "c_custkey"),
    "nation": ("c_nationkey", "n_nationkey"),
    "region": ("n_regionkey", "r_regionkey"),
    "supplier": ("l_suppkey", "s_suppkey"),
    "part": ("l_partkey", "p_partkey"),
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _build(spark: SparkSession, sf_dir: str, catalogue: dict, columns: Sequence[str] | None) -> DataFrame:
    wanted = list(columns or catalogue)
    needed = {t for c in wanted for t in catalogue[c][1]}

    def joined(df: DataFrame, tables: Sequence[str]) -> DataFrame:
        for table in tables:
            if table in needed:
                left, right = JOINS[table]
                side = read(spark, sf_dir, table)
                if table == "supplier":
                    # Met by every line, last and widest; its two columns are few values beside them.
                    side = broadcast_if_small(side.select("s_suppkey", "s_name"))
                df = df.join(side, F.col(left) == F.col(right))
        return df

    # The part, whose join shuffles every line, comes first, while the rows are narrow.
    df = joined(read(spark, sf_dir, "lineitem"), ["part"])
    if "orders" in needed:
        # An order's columns are put together before they meet its lines, which are not shuffled again by the customer.
        orders = joined(read(spark, sf_dir, "orders"), ["customer", "nation", "region"])
        df = df.join(orders, F.expr(" = ".join(JOINS["orders"])))
    df = joined(df, ["supplier"])
    return df.select(*[F.expr(catalogue[c][0]).alias(c) for c in wanted])


def policies(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    return _build(spark, sf_dir, POLICY, columns)


def raw(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    return _build(spark, sf_dir, RAW, columns)


def _view_sql(catalogue: dict) -> str:
    listed = ",\n  ".join(f"{expr} AS {name}" for name, (expr, _) in catalogue.items())
    joins = "\n".join(f"JOIN {t} ON {left} = {right}" for t, (left, right) in JOINS.items())
    return f"SELECT\n  {listed}\nFROM lineitem\n{joins}"


POLICY_SQL = f"policy AS (\n{_view_sql(POLICY)}\n)"
RAW_SQL = f"raw AS (\n{_view_sql(RAW)}\n)"


def on_policy(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([POLICY_SQL, *ctes]) + "\n" + body


def on_raw(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([RAW_SQL, *ctes]) + "\n" + body
