"""Sources, scalar expressions, cleaning, filters, dimension joins, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import feature_queries as fq
from checks.spec import Check, digits
from checks.tables import on_policy, on_raw, policies, raw, read
from fieldmark.functions import dates, numbers, text
from fieldmark.operators import cleaning, dedup, dimensions, quality
from fieldmark.plans import features, silver
from fieldmark.plans.schema import FEATURE_COLUMNS
from fieldmark.session import scratch_path
from fieldmark.sources import readers, writers

# Fixed values on both sides of the text checks.
FROM, TO = text.ACCENTED, text.PLAIN
SQL_ACCENTS = f"'{FROM}', '{TO}'"


def on_raw_columns(columns, transform):
    return lambda spark, sf: transform(raw(spark, sf, columns))


def on_policy_columns(columns, transform):
    return lambda spark, sf: transform(policies(spark, sf, columns))


def sql_text(expr: str) -> str:
    """White space collapsed and trimmed, in DuckDB."""
    return f"trim(regexp_replace({expr}, '[\\s\\x{{00A0}}]+', ' ', 'g'))"


def sql_slug(expr: str) -> str:
    joined = f"regexp_replace(lower(trim({expr})), '\\s+', '_', 'g')"
    plain = f"translate(replace(replace({joined}, '''', ''), '-', '_'), '{FROM}ü', '{TO}u')"
    return f"replace({plain}, 'th', 't')"


def digest(df, *columns):
    """Whole texts compared by length and digest."""
    changed = {}
    for c in columns:
        changed[f"{c}_length"] = F.length(c)
        changed[c] = F.md5(F.col(c))
    return df.withColumns(changed)


# --- sources and sinks -----------------------------------------------------------------------

ORDERS_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)


def _state_totals(spark, sf):
    held = policies(spark, sf, ["state", "policy_id", "area_ha"])
    return held.groupBy("state").agg(F.count("policy_id").alias("policies"), F.sum("area_ha").alias("area_ha"))


STATE_TOTALS_SQL = on_policy("SELECT state, count(policy_id) AS policies, sum(area_ha) AS area_ha FROM policy GROUP BY 1")


def _overwritten(spark, sf):
    path = scratch_path(spark, "overwrite")
    writers.overwrite(_state_totals(spark, sf).drop("area_ha"), path)
    writers.overwrite(_state_totals(spark, sf), path)
    return spark.read.parquet(path)


def _partitioned(spark, sf):
    path = scratch_path(spark, "partitioned")
    scored = policies(spark, sf, ["policy_id", "claim", "rate"]).withColumn(
        "model_name", F.when(F.col("claim") == 1, "claims").otherwise("quiet")
    )
    writers.overwrite(scored, path, ["model_name"])
    back = spark.read.parquet(path)
    return back.groupBy("model_name").agg(F.count("*").alias("n_rows"), F.sum("claim").alias("claims"))


def _step_counts(spark, sf):
    """Row counts of two written steps, from their file footers."""
    path = scratch_path(spark, "steps")
    steps = raw(spark, sf, ["policy_no", "end_text"])
    first = writers.overwrite(steps, f"{path}/raw")
    dated = spark.read.parquet(f"{path}/raw").withColumn("end_date", dates.parse_date(F.col("end_text")))
    second = writers.overwrite(cleaning.plausible_end(dated, "end_date"), f"{path}/plausible")
    return spark.createDataFrame([("raw", first), ("plausible", second)], "step string, n_rows bigint")


def _exported(spark, sf):
    path = scratch_path(spark, "export")
    writers.export_csv(_state_totals(spark, sf), path)
    return readers.read_table(spark, path, "csv", "state string, policies bigint, area_ha double")


def _latest_per_area(spark, sf):
    held = policies(spark, sf, ["area_id", "sum_insured", "claim"])
    return held.groupBy("area_id").agg(F.sum("claim").alias("claims"), F.max("sum_insured").alias("largest"))


def _upserted(spark, sf):
    path = scratch_path(spark, "upsert")
    totals = _latest_per_area(spark, sf)
    first = totals.filter(F.col("area_id") < 70)
    second = totals.filter(F.col("area_id") >= 40).withColumn("claims", -F.col("claims"))
    writers.upsert(first, path, ["area_id"])
    writers.upsert(second, path, ["area_id"])
    return writers.read_latest(spark, path)


def _month_replaced(spark, sf):
    path = scratch_path(spark, "months")
    dated = features.with_ref_month(policies(spark, sf, ["start_date", "claim"]))
    monthly = dated.groupBy("ref_month").agg(F.sum("claim").alias("claims"), F.count("*").alias("policies"))
    writers.overwrite(monthly, path, ["ref_month"])
    late = monthly.filter(F.col("ref_month") >= F.lit("1998-01-01").cast("date"))
    writers.replace_partitions(late.withColumn("claims", F.lit(0).cast("bigint")), path, ["ref_month"])
    return spark.read.schema("claims bigint, policies bigint, ref_month date").parquet(path)


STATES = {n: f"S{n:02d}" for n in range(25)}


def _shared(spark, sf):
    """Two sources with different columns, cut to what they share."""
    left = policies(spark, sf, ["policy_id", "state", "rate"]).filter("rate < 0.04")
    right = policies(spark, sf, ["policy_id", "insurer", "state", "rate"]).filter("rate >= 0.04").drop("rate")
    assert not readers.same_columns(left, right)
    shared = readers.shared_columns(left, right)
    return left.select(*shared).unionByName(right.select(*shared))


def _geography(spark, sf):
    joined = read(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    named = joined.withColumn("label", F.concat(F.lit(" São "), F.col("c_name"), F.lit("-d'Água ")))
    return readers.geography(
        named, {"c_custkey": "code", "label": "name", "c_nationkey": "state"}, ["name"], "state", STATES
    )


def _optional(spark, sf):
    districts = readers.read_if_present(spark, f"{sf}/no_such_districts.parquet")
    held = silver_places(spark, sf)
    return dimensions.place_codes(held, place_dim(spark, sf), districts)


# --- geography shared by the join checks ---------------------------------------------------------


def silver_places(spark, sf):
    """Slugged names, states and codes as the geography joins meet them."""
    base = raw(spark, sf, ["policy_no", "place_text", "state_code", "place_code"])
    return base.select(
        "policy_no",
        text.slug(F.col("place_text")).alias("place_name"),
        F.col("state_code").alias("state"),
        numbers.to_int(F.col("place_code")).alias("place_code"),
    )


SILVER_PLACES = f"""held AS (
SELECT policy_no, {sql_slug('place_text')} AS place_name, state_code AS state,
  TRY_CAST(TRY_CAST(place_code AS DOUBLE) AS INT) AS place_code FROM raw)"""


def _customers(spark, sf):
    joined = read(spark, sf, "customer").join(read(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        text.slug(F.concat(F.lit("São "), "c_mktsegment", F.lit("-d'Oeste  Thomé "), (F.col("c_custkey") % 40).cast("string"))).alias("name"),
        F.col("n_name").alias("state"),
        (F.col("c_custkey") % 40).cast("int").alias("code"),
        "c_mktsegment",
    ).distinct()


CUSTOMERS_SQL = f"""customers AS (
SELECT DISTINCT {sql_slug("concat('São ', c_mktsegment, '-d''Oeste  Thomé ', CAST(c_custkey % 40 AS VARCHAR))")} AS name,
  n_name AS state, CAST(c_custkey % 40 AS INT) AS code, c_mktsegment
FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def place_dim(spark, sf):
    known = _customers(spark, sf).filter(F.col("c_mktsegment").isin("HOUSEHOLD", "MACHINERY"))
    return known.select("name", "state", (F.col("code") + 1000).alias("code"))


def district_dim(spark, sf):
    known = _customers(spark, sf).filter(F.col("c_mktsegment") == "BUILDING")
    return known.select(
        F.col("name").alias("district"), "state", (F.col("code") + 5000).alias("code"),
        F.concat(F.lit("seat_"), F.col("code").cast("string")).alias("place_name"),
    )


PLACE_DIM = "places AS (SELECT name, state, code + 1000 AS code FROM customers WHERE c_mktsegment IN ('HOUSEHOLD', 'MACHINERY'))"
DISTRICT_DIM = """districts AS (
SELECT name AS district, state, code + 5000 AS code, concat('seat_', CAST(code AS VARCHAR)) AS seat
FROM customers WHERE c_mktsegment = 'BUILDING')"""


def perils(spark, sf):
    """A peril dictionary whose codes come from the data."""
    seen = raw(spark, sf, ["peril_text"]).select(
        text.strip_accents(text.collapse_spaces(F.coalesce("peril_text", F.lit("0")))).alias("code")
    ).distinct()
    return seen.filter(F.col("code") != "GRANIZO").withColumn("value", F.lower(F.replace(F.col("code"), F.lit(" "), F.lit("_"))))


CLEAN_PERIL = f"translate({sql_text('coalesce(peril_text, ' + chr(39) + '0' + chr(39) + ')')}, {SQL_ACCENTS})"
PERIL_CTES = (
    f"clean AS (SELECT policy_no, {CLEAN_PERIL} AS peril FROM raw)",
    "perils AS (SELECT DISTINCT peril AS code, lower(replace(peril, ' ', '_')) AS value FROM clean WHERE peril <> 'GRANIZO')",
)


def _clean_perils(spark, sf):
    return raw(spark, sf, ["policy_no", "peril_text"]).select(
        "policy_no", text.strip_accents(text.collapse_spaces(F.coalesce("peril_text", F.lit("0")))).alias("peril")
    )


def _corrections(spark, sf):
    named = policies(spark, sf, ["crop", "crop_group"])
    return named.groupBy("crop_group").agg(F.min("crop").alias("new_name")).withColumnRenamed("crop_group", "old_name")


# --- whole silver table ------------------------------------------------------------------------


def _silver(spark, sf):
    return silver.build(
        raw(spark, sf),
        silver.Dimensions(
            perils=perils(spark, sf),
            crop_groups=crop_groups(spark, sf),
            places=place_dim(spark, sf),
            districts=district_dim(spark, sf),
            regions=regions(spark, sf),
        ),
        silver.Options(decimal_comma=["sum_insured"]),
    )


def crop_groups(spark, sf):
    part = read(spark, sf, "part")
    return part.filter(F.col("p_size") % 2 == 0).select(
        F.concat("p_brand", F.lit(" 1ª safra")).alias("code"), F.lit("grain").alias("value")
    ).distinct()


def regions(spark, sf):
    nation, region = read(spark, sf, "nation"), read(spark, sf, "region")
    joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.filter(F.col("r_name") != "ASIA").select(F.col("n_name").alias("code"), F.col("r_name").alias("value"))


def _sentinel(expr: str) -> str:
    return f"CASE WHEN {expr} IN ('-', '...', 'X') THEN '0' ELSE {expr} END"


def _clean(expr: str) -> str:
    return f"coalesce(trim(translate({_sentinel(expr)}, {SQL_ACCENTS})), '0')"


def _number(expr: str) -> str:
    return f"TRY_CAST({_clean(expr)} AS DOUBLE)"


RAW_COLUMNS = ", ".join(
    "proposal_id policy_no proposed_on issued_on start_text end_text insured_name insured_document insurer_name "
    "place_text state_code place_code product_class crop_name peril_text area_text head_text sum_text premium_value "
    "rate_value indemnity_value lat_deg lat_min lat_sec lat_half".split()
)

SILVER_CTES = (
    f"""ranked AS (
SELECT *, row_number() OVER (PARTITION BY proposal_id ORDER BY proposed_on, issued_on DESC, {RAW_COLUMNS}) AS rn
FROM raw),
kept AS (SELECT * FROM ranked WHERE rn = 1 OR proposal_id IS NULL)""",
    f"""typed AS (
SELECT policy_no AS policy_id,
  TRY_CAST(start_text AS DATE) AS start_date, TRY_CAST(end_text AS DATE) AS end_date,
  CAST(TRY_CAST({_clean('place_code')} AS DOUBLE) AS INT) AS area_id,
  {sql_slug(_clean('place_text'))} AS place_name,
  {_clean('state_code')} AS state,
  CASE WHEN upper({_clean('lat_half')}) = 'S' THEN -1 ELSE 1 END
    * (TRY_CAST(lat_deg AS DOUBLE) + TRY_CAST(lat_min AS DOUBLE) / 60e0 + TRY_CAST(lat_sec AS DOUBLE) / 3600e0) AS lat,
  {_clean('insurer_name')} AS insurer,
  {_clean('product_class')} AS product_type,
  {_clean('crop_name')} AS crop,
  {_number('area_text')} AS area_ha,
  CAST(TRY_CAST({_clean('head_text')} AS DOUBLE) AS INT) AS head_count,
  TRY_CAST(replace(replace({_clean('sum_text')}, '.', ''), ',', '.') AS DOUBLE) AS sum_insured,
  coalesce(premium_value, 0) AS premium, coalesce(rate_value, 0) AS rate, coalesce(indemnity_value, 0) AS indemnity,
  {sql_text('coalesce(translate(' + _sentinel('peril_text') + ', ' + SQL_ACCENTS + '), ' + chr(39) + '0' + chr(39) + ')')} AS peril_code
FROM kept)""",
    *PERIL_CTES,
    CUSTOMERS_SQL,
    PLACE_DIM,
    DISTRICT_DIM,
    f"""groups AS (
SELECT DISTINCT trim(translate(concat(p_brand, ' 1ª safra'), {SQL_ACCENTS})) AS code FROM part WHERE p_size % 2 = 0)""",
    """regions AS (SELECT n_name AS code, r_name AS value FROM nation JOIN region ON n_regionkey = r_regionkey
WHERE r_name <> 'ASIA')""",
)
SILVER_BODY = """SELECT t.policy_id, t.start_date, t.end_date,
  coalesce(p.code, nullif(t.area_id, 0), d.code) AS area_id,
  CASE WHEN coalesce(p.code, nullif(t.area_id, 0)) IS NULL THEN coalesce(d.seat, t.place_name) ELSE t.place_name END
    AS place_name,
  t.state, coalesce(r.value, 'Other') AS region, coalesce(t.lat, 0) AS lat, t.insurer, t.product_type, t.crop,
  CASE WHEN g.code IS NULL THEN 'other' ELSE 'grain' END AS crop_group,
  t.area_ha, t.head_count, CAST(t.end_date - t.start_date AS INT) AS duration_days,
  t.sum_insured, t.premium, t.rate, t.indemnity,
  coalesce(e.value, CASE WHEN t.peril_code = '0' THEN 'none' ELSE t.peril_code END) AS peril,
  CASE WHEN t.peril_code = '0' THEN 0 ELSE 1 END AS claim,
  CASE WHEN t.premium = 0 THEN 0 ELSE t.indemnity / t.premium END AS loss_ratio
FROM typed t
LEFT JOIN places p ON p.name = t.place_name AND p.state = t.state
LEFT JOIN districts d ON d.district = t.place_name AND d.state = t.state
LEFT JOIN groups g ON g.code = t.crop
LEFT JOIN (SELECT code, value FROM perils WHERE code <> '0') e ON e.code = t.peril_code
LEFT JOIN regions r ON r.code = t.state
WHERE year(t.end_date) <= 2035 AND t.state <> '0'"""

KEYED = ["policy_no"]

CHECKS = {
    "s1_batch_read": Check(
        lambda spark, sf: readers.read_table(spark, f"{sf}/orders.parquet", "parquet", ORDERS_SCHEMA).withColumn(
            "o_orderdate", F.col("o_orderdate").cast("date")
        ),
        "SELECT * FROM orders",
        dates=["o_orderdate"],
    ),
    "s2_decimal_comma": Check(
        on_raw_columns(["policy_no", "sum_text"], lambda d: d.select("policy_no", numbers.from_decimal_comma(F.col("sum_text")).alias("sum_insured"))),
        on_raw("SELECT policy_no, TRY_CAST(replace(replace(sum_text, '.', ''), ',', '.') AS DOUBLE) AS sum_insured FROM raw"),
    ),
    "s3_shared_columns": Check(
        _shared,
        on_policy("SELECT policy_id, state FROM policy WHERE rate < 0.04 UNION ALL SELECT policy_id, state FROM policy WHERE rate >= 0.04"),
    ),
    "s4_overwrite": Check(_overwritten, STATE_TOTALS_SQL, digits(4, "area_ha")),
    "s5_empty_like": Check(
        lambda spark, sf: readers.empty_like(policies(spark, sf, ["policy_id", "state", "rate"])),
        on_policy("SELECT policy_id, state, rate FROM policy WHERE 1 = 0"),
    ),
    "s6_upsert": Check(
        _upserted,
        on_policy(
            "SELECT area_id, CASE WHEN area_id >= 40 THEN -1 ELSE 1 END * CAST(sum(claim) AS BIGINT) AS claims,"
            " max(sum_insured) AS largest FROM policy GROUP BY area_id"
        ),
    ),
    "s6_replace_months": Check(
        _month_replaced,
        on_policy(
            "SELECT CAST(date_trunc('month', start_date) AS DATE) AS ref_month, count(*) AS policies,"
            " CAST(sum(CASE WHEN start_date >= DATE '1998-01-01' THEN 0 ELSE claim END) AS BIGINT) AS claims"
            " FROM policy GROUP BY 1"
        ),
        dates=["ref_month"],
    ),
    "s7_key_contract": Check(
        on_policy_columns(["policy_id"], lambda d: quality.key_violations(d, ["policy_id"])),
        on_policy("SELECT policy_id, count(*) AS n_rows FROM policy GROUP BY 1 HAVING count(*) > 1"),
    ),
    "s8_registered_table": Check(
        lambda spark, sf: features.feature_table("insurer_risk").build(policies(spark, sf, fq.INPUTS["insurer_risk"])),
        fq.INSURER_SQL,
        fq.INSURER_FLOATS,
        ["ref_month"],
    ),
    "a25_step_counts": Check(
        _step_counts,
        on_raw(
            "SELECT 'raw' AS step, count(*) AS n_rows FROM raw UNION ALL SELECT 'plausible', count(*) FROM raw"
            " WHERE year(TRY_CAST(end_text AS DATE)) <= 2035"
        ),
    ),
    "s9_partitioned_write": Check(
        _partitioned,
        on_policy(
            "SELECT CASE WHEN claim = 1 THEN 'claims' ELSE 'quiet' END AS model_name, count(*) AS n_rows,"
            " CAST(sum(claim) AS BIGINT) AS claims FROM policy GROUP BY 1"
        ),
    ),
    "s10_csv_export": Check(_exported, STATE_TOTALS_SQL, digits(4, "area_ha")),
    "s11_geography": Check(
        _geography,
        f"""SELECT c_custkey AS code, {sql_slug("concat(' São ', c_name, '-d''Água ')")} AS name,
  concat('S', lpad(CAST(c_nationkey AS VARCHAR), 2, '0')) AS state FROM customer""",
    ),
    "s12_optional_source": Check(
        _optional,
        on_raw(
            "SELECT h.policy_no, h.place_name, h.state, coalesce(p.code, nullif(h.place_code, 0)) AS place_code"
            " FROM held h LEFT JOIN places p ON p.name = h.place_name AND p.state = h.state",
            SILVER_PLACES, CUSTOMERS_SQL, PLACE_DIM,
        ),
    ),
    # --- scalar expressions ------------------------------------------------------------------------
    "p1_all_to_string": Check(
        on_policy_columns(["policy_id", "start_date", "head_count", "area_id", "state"], cleaning.all_to_string),
        on_policy(
            "SELECT CAST(policy_id AS VARCHAR) AS policy_id, CAST(start_date AS VARCHAR) AS start_date,"
            " CAST(head_count AS VARCHAR) AS head_count, CAST(area_id AS VARCHAR) AS area_id, state FROM policy"
        ),
    ),
    "p2_sentinels": Check(
        on_raw_columns([*KEYED, "state_code", "place_code", "product_class", "head_text"], cleaning.replace_sentinels),
        on_raw(
            "SELECT policy_no, " + ", ".join(f"{_sentinel(c)} AS {c}" for c in ("state_code", "place_code", "product_class", "head_text")) + " FROM raw"
        ),
    ),
    "p3_accents_in_names": Check(
        lambda spark, sf: cleaning.strip_accents_in_names(
            policies(spark, sf, ["policy_id", "indemnity", "region"]).toDF("apólice", "INDENIZAÇÃO", "região")
        ),
        on_policy('SELECT policy_id AS apolice, indemnity AS "INDENIZACAO", region AS regiao FROM policy'),
        digits(6, "INDENIZACAO"),
    ),
    "p4_accents_in_values": Check(
        lambda spark, sf: digest(
            cleaning.strip_accents_in_values(read(spark, sf, "documents").select("doc_id", "text", "lang")), "text"
        ),
        f"""SELECT doc_id, lang, md5(plain) AS text, length(plain) AS text_length
FROM (SELECT doc_id, lang, translate(text, {SQL_ACCENTS}) AS plain FROM documents)""",
    ),
    "p5_parse_date": Check(
        on_raw_columns([*KEYED, "end_text"], lambda d: d.select("policy_no", "end_text", dates.parse_date(F.col("end_text")).alias("end_date"))),
        on_raw("SELECT policy_no, end_text, TRY_CAST(end_text AS DATE) AS end_date FROM raw"),
        dates=["end_date"],
    ),
    "p6_duration": Check(
        on_policy_columns(["policy_id", "start_date", "end_date"], lambda d: d.select("policy_id", F.datediff("end_date", "start_date").alias("days"))),
        on_policy("SELECT policy_id, CAST(end_date - start_date AS INT) AS days FROM policy"),
    ),
    "p7_collapse_spaces": Check(
        lambda spark, sf: digest(
            read(spark, sf, "documents").select("doc_id", text.collapse_spaces(F.col("text")).alias("text")), "text"
        ),
        f"""SELECT doc_id, md5(plain) AS text, length(plain) AS text_length
FROM (SELECT doc_id, {sql_text('text')} AS plain FROM documents)""",
    ),
    "p8_default_code": Check(
        on_raw_columns([*KEYED, "place_code"], lambda d: d.withColumn("place_code", F.coalesce("place_code", F.lit("0")))),
        on_raw("SELECT policy_no, coalesce(place_code, '0') AS place_code FROM raw"),
    ),
    "p9_trim": Check(
        on_raw_columns([*KEYED, "insurer_name", "place_text", "product_class"], cleaning.trim_strings),
        on_raw("SELECT policy_no, trim(insurer_name) AS insurer_name, trim(place_text) AS place_text, trim(product_class) AS product_class FROM raw"),
    ),
    "p10_signed_degrees": Check(
        on_raw_columns(
            [*KEYED, "lat_deg", "lat_min", "lat_sec", "lat_half"],
            lambda d: d.select("policy_no", numbers.signed_degrees(*[F.col(c) for c in ("lat_deg", "lat_min", "lat_sec", "lat_half")], "S").alias("lat")),
        ),
        on_raw(
            "SELECT policy_no, CASE WHEN upper(lat_half) = 'S' THEN -1 ELSE 1 END * (CAST(lat_deg AS DOUBLE)"
            " + CAST(lat_min AS DOUBLE) / 60e0 + TRY_CAST(lat_sec AS DOUBLE) / 3600e0) AS lat FROM raw"
        ),
        digits(9, "lat"),
    ),
    "p11_drop_columns": Check(
        on_raw_columns([*KEYED, "insured_name", "insured_document", "state_code"], lambda d: cleaning.drop_present(d, silver.DROPPED)),
        on_raw("SELECT policy_no, state_code FROM raw"),
    ),
    "p12_rename": Check(
        on_raw_columns([*KEYED, "insurer_name", "state_code"], lambda d: cleaning.rename_present(d, silver.RENAMED)),
        on_raw("SELECT policy_no AS policy_id, insurer_name AS insurer, state_code AS state FROM raw"),
    ),
    "p13_fill_by_type": Check(
        on_raw_columns([*KEYED, "place_code", "head_text", "rate_value", "indemnity_value"], cleaning.fill_by_type),
        on_raw(
            "SELECT policy_no, coalesce(place_code, '0') AS place_code, coalesce(head_text, '0') AS head_text,"
            " coalesce(rate_value, 0) AS rate_value, coalesce(indemnity_value, 0) AS indemnity_value FROM raw"
        ),
        digits(6, "indemnity_value"),
    ),
    "p14_fill_with_mean": Check(
        on_raw_columns([*KEYED, "indemnity_value"], lambda d: cleaning.fill_with_mean(d, "indemnity_value")),
        on_raw("SELECT policy_no, coalesce(indemnity_value, (SELECT avg(indemnity_value) FROM raw)) AS indemnity_value FROM raw"),
        digits(5, "indemnity_value"),
    ),
    "p15_guarded_casts": Check(
        on_raw_columns([*KEYED, "head_text", "place_code", "area_text"], lambda d: cleaning.cast_numbers(d, ["head_text", "place_code"], ["area_text"])),
        on_raw(
            "SELECT policy_no, CAST(TRY_CAST(head_text AS DOUBLE) AS INT) AS head_text,"
            " CAST(TRY_CAST(place_code AS DOUBLE) AS INT) AS place_code, TRY_CAST(area_text AS DOUBLE) AS area_text FROM raw"
        ),
    ),
    "p16_map_keep_original": Check(
        lambda spark, sf: dimensions.map_code(_clean_perils(spark, sf), "peril", perils(spark, sf)),
        on_raw("SELECT c.policy_no, coalesce(p.value, c.peril) AS peril FROM clean c LEFT JOIN perils p ON p.code = c.peril", *PERIL_CTES),
    ),
    "p17_map_with_default": Check(
        lambda spark, sf: dimensions.map_code(
            _clean_perils(spark, sf), "peril", perils(spark, sf), "group", default="other", keep_unmapped=False
        ),
        on_raw(
            "SELECT c.policy_no, c.peril, coalesce(p.value, 'other') AS \"group\" FROM clean c LEFT JOIN perils p ON p.code = c.peril",
            *PERIL_CTES,
        ),
    ),
    "p18_claim_flag": Check(
        on_policy_columns(["policy_id", "peril"], lambda d: d.withColumn("claim", silver.claim_flag(F.col("peril")))),
        on_policy("SELECT policy_id, peril, CASE WHEN peril = 'none' THEN 0 ELSE 1 END AS claim FROM policy"),
    ),
    "p19_guarded_ratio": Check(
        on_raw_columns(
            [*KEYED, "premium_value", "indemnity_value"],
            lambda d: d.select(
                "policy_no",
                numbers.ratio(F.col("indemnity_value"), F.col("premium_value"), when_zero=0.0).alias("loss_ratio"),
                numbers.ratio(F.col("indemnity_value"), F.col("premium_value")).alias("loss_ratio_or_null"),
            ),
        ),
        on_raw(
            "SELECT policy_no, CASE WHEN premium_value = 0 THEN 0 ELSE indemnity_value / premium_value END AS loss_ratio,"
            " indemnity_value / nullif(premium_value, 0) AS loss_ratio_or_null FROM raw"
        ),
        digits(9, "loss_ratio", "loss_ratio_or_null"),
    ),
    "p20_column_order": Check(
        on_policy_columns(["rate", "state", "policy_id", "peril"], lambda d: cleaning.select_present(d, FEATURE_COLUMNS)),
        on_policy("SELECT policy_id, state, rate FROM policy"),
    ),
    "p21_slug": Check(
        on_raw_columns([*KEYED, "place_text"], lambda d: d.withColumn("place_text", text.slug(F.col("place_text")))),
        on_raw(f"SELECT policy_no, {sql_slug('place_text')} AS place_text FROM raw"),
    ),
    "p22_ref_month": Check(
        on_policy_columns(["policy_id", "start_date"], lambda d: d.select("policy_id", dates.ref_month(F.col("start_date")).alias("ref_month"))),
        on_policy("SELECT policy_id, CAST(date_trunc('month', start_date) AS DATE) AS ref_month FROM policy"),
        dates=["ref_month"],
    ),
    "p23_calendar_parts": Check(
        on_policy_columns(
            ["policy_id", "start_date"],
            lambda d: d.select("policy_id", F.month("start_date").alias("m"), F.quarter("start_date").alias("q"), F.year("start_date").alias("y")),
        ),
        on_policy("SELECT policy_id, month(start_date) AS m, quarter(start_date) AS q, year(start_date) AS y FROM policy"),
    ),
    "p24_relative_duration": Check(
        on_policy_columns(["policy_id", "duration_days"], lambda d: d.select("policy_id", dates.relative_duration(F.col("duration_days")).alias("share"))),
        on_policy("SELECT policy_id, duration_days / 365e0 AS share FROM policy"),
        digits(10, "share"),
    ),
    "p25_summer_season": Check(
        on_policy_columns(["policy_id", "start_date"], lambda d: d.select("policy_id", dates.summer_flag(F.col("start_date")).alias("summer"))),
        on_policy("SELECT policy_id, CASE WHEN month(start_date) >= 9 OR month(start_date) = 1 THEN 1 ELSE 0 END AS summer FROM policy"),
    ),
    # --- filters ---------------------------------------------------------------------------------------
    "f1_plausible_end": Check(
        on_raw_columns([*KEYED, "end_text"], lambda d: cleaning.plausible_end(d.select("policy_no", dates.parse_date(F.col("end_text")).alias("end_date")), "end_date")),
        on_raw("SELECT * FROM (SELECT policy_no, TRY_CAST(end_text AS DATE) AS end_date FROM raw) WHERE year(end_date) <= 2035"),
        dates=["end_date"],
    ),
    "f2_valid_state": Check(
        on_raw_columns([*KEYED, "state_code"], lambda d: cleaning.valid_code(cleaning.replace_sentinels(d), "state_code")),
        on_raw("SELECT policy_no, state_code FROM raw WHERE state_code <> '-'"),
    ),
    "f3_drop_all_null": Check(
        on_raw_columns(["place_code", "head_text"], cleaning.drop_all_null),
        on_raw("SELECT place_code, head_text FROM raw WHERE place_code IS NOT NULL OR head_text IS NOT NULL"),
    ),
    "f4_drop_any_null": Check(
        on_raw_columns([*KEYED, "place_code", "head_text"], cleaning.drop_any_null),
        on_raw("SELECT policy_no, place_code, head_text FROM raw WHERE place_code IS NOT NULL AND head_text IS NOT NULL"),
    ),
    "f4_rows_with_null": Check(
        on_raw_columns([*KEYED, "place_code", "head_text"], cleaning.rows_with_null),
        on_raw("SELECT policy_no, place_code, head_text FROM raw WHERE place_code IS NULL OR head_text IS NULL"),
    ),
    "f5_year_slice": Check(
        on_policy_columns(["policy_id", "start_date"], lambda d: cleaning.year_slice(d, "start_date", 1997, 1999)),
        on_policy("SELECT policy_id, start_date FROM policy WHERE year(start_date) BETWEEN 1997 AND 1999"),
        dates=["start_date"],
    ),
    # --- dimension joins ----------------------------------------------------------------------------------
    "j1_single_key_dimension": Check(
        lambda spark, sf: dimensions.correct_names(policies(spark, sf, ["policy_id", "crop_group"]), "crop_group", _corrections(spark, sf)),
        on_policy(
            "SELECT policy_id, coalesce(new_name, crop_group) AS crop_group FROM policy LEFT JOIN fixes ON old_name = crop_group",
            "fixes AS (SELECT crop_group AS old_name, min(crop) AS new_name FROM policy GROUP BY 1)",
        ),
    ),
    "j2_composite_key_dimension": Check(
        lambda spark, sf: dimensions.place_codes(silver_places(spark, sf), place_dim(spark, sf)),
        on_raw(
            "SELECT h.policy_no, h.place_name, h.state, coalesce(p.code, nullif(h.place_code, 0)) AS place_code"
            " FROM held h LEFT JOIN places p ON p.name = h.place_name AND p.state = h.state",
            SILVER_PLACES, CUSTOMERS_SQL, PLACE_DIM,
        ),
    ),
    "j3_district_fallback": Check(
        lambda spark, sf: dimensions.place_codes(silver_places(spark, sf), place_dim(spark, sf), district_dim(spark, sf)),
        on_raw(
            """SELECT policy_no, state, coalesce(place_code, code) AS place_code,
  CASE WHEN place_code IS NULL THEN coalesce(seat, place_name) ELSE place_name END AS place_name
FROM first LEFT JOIN districts d ON d.district = first.place_name AND d.state = first.state""".replace(
                "policy_no, state,", "policy_no, first.state AS state,"
            ),
            SILVER_PLACES, CUSTOMERS_SQL, PLACE_DIM, DISTRICT_DIM,
            """first AS (
SELECT h.policy_no, h.place_name, h.state, coalesce(p.code, nullif(h.place_code, 0)) AS place_code
FROM held h LEFT JOIN places p ON p.name = h.place_name AND p.state = h.state)""",
        ),
    ),
    "j11_unmatched_report": Check(
        lambda spark, sf: dimensions.unmatched(
            silver_places(spark, sf), place_dim(spark, sf).withColumnRenamed("name", "place_name"), ["place_name", "state"]
        ),
        on_raw(
            """SELECT h.place_name, h.state, count(*) AS n_rows FROM held h
WHERE NOT EXISTS (SELECT 1 FROM places p WHERE p.name = h.place_name AND p.state = h.state) GROUP BY 1, 2""",
            SILVER_PLACES, CUSTOMERS_SQL, PLACE_DIM,
        ),
    ),
    "q_unmapped_perils": Check(
        lambda spark, sf: quality.unmapped_codes(_clean_perils(spark, sf), "peril", perils(spark, sf)),
        on_raw("SELECT peril AS code, count(*) AS n_rows FROM clean WHERE peril NOT IN (SELECT code FROM perils) GROUP BY 1", *PERIL_CTES),
    ),
    # --- dedup, unions, limits --------------------------------------------------------------------------------
    "w1_deduplicate": Check(
        on_raw_columns(
            ["proposal_id", "proposed_on", "issued_on", "insurer_name", "sum_text"],
            lambda d: dedup.deduplicate(d, "proposal_id", [F.col("proposed_on").asc(), F.col("issued_on").desc()]),
        ),
        on_raw(
            """SELECT * EXCLUDE (rn) FROM (
  SELECT proposal_id, proposed_on, issued_on, insurer_name, sum_text, row_number() OVER (PARTITION BY proposal_id
    ORDER BY proposed_on, issued_on DESC, insurer_name, sum_text) AS rn FROM raw)
WHERE rn = 1 OR proposal_id IS NULL"""
        ),
        dates=["proposed_on", "issued_on"],
    ),
    "w1_deduplicate_collapse_nulls": Check(
        on_raw_columns(
            ["proposal_id", "proposed_on", "issued_on", "insurer_name", "sum_text"],
            lambda d: dedup.deduplicate(
                d, "proposal_id", [F.col("proposed_on").asc(), F.col("issued_on").desc()], keep_null_keys=False
            ),
        ),
        on_raw(
            """SELECT * EXCLUDE (rn) FROM (
  SELECT proposal_id, proposed_on, issued_on, insurer_name, sum_text, row_number() OVER (PARTITION BY proposal_id
    ORDER BY proposed_on, issued_on DESC, insurer_name, sum_text) AS rn FROM raw)
WHERE rn = 1"""
        ),
        dates=["proposed_on", "issued_on"],
    ),
    "u1_union_aligned": Check(
        lambda spark, sf: policies(spark, sf, ["policy_id", "state", "rate"]).filter("rate < 0.04").unionByName(
            policies(spark, sf, ["state", "policy_id", "insurer", "rate"]).filter("rate >= 0.04"), allowMissingColumns=True
        ),
        on_policy("SELECT policy_id, state, rate, CASE WHEN rate >= 0.04 THEN insurer END AS insurer FROM policy"),
    ),
    "u2_union_by_name": Check(
        lambda spark, sf: policies(spark, sf, ["policy_id", "state"]).filter("policy_id % 2 = 0").unionByName(
            policies(spark, sf, ["state", "policy_id"]).filter("policy_id % 2 <> 0")
        ),
        on_policy("SELECT policy_id, state FROM policy"),
    ),
    "u3_all_but_rank": Check(
        on_policy_columns(
            ["policy_id", "start_date", "state"],
            lambda d: dedup.first_per_key(d, ["policy_id"], [F.col("start_date").asc()]),
        ),
        on_policy(
            """SELECT * EXCLUDE (rn) FROM (
  SELECT policy_id, start_date, state, row_number() OVER (PARTITION BY policy_id ORDER BY start_date, state) AS rn FROM policy)
WHERE rn = 1"""
        ),
        dates=["start_date"],
    ),
    "u4_leaked_columns": Check(
        on_policy_columns(
            ["policy_id", "state", "peril", "claim", "indemnity", "rate"],
            lambda d: d.drop(*quality.leaked_columns(d.columns)),
        ),
        on_policy("SELECT policy_id, state, rate FROM policy"),
    ),
    "o4_preview": Check(on_policy_columns(["policy_id", "state", "rate"], lambda d: d.limit(5))),
    "silver_policies": Check(
        _silver,
        on_raw(SILVER_BODY, *SILVER_CTES),
        digits(9, "lat", "loss_ratio") | digits(6, "premium", "indemnity"),
        ["start_date", "end_date"],
    ),
}
