"""Registered queries: one per inventory item, each with its DuckDB oracle text.

Every query reads whole driver tables (through the stand-ins in
:mod:`meterwise.plans.standins`) and returns a DataFrame; the oracle is the
same question in DuckDB SQL over the same Parquet files. Column names match
between the two; averages are rounded to 4 places and sums are exact decimal
sums so that both engines give identical values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterwise.functions.calendar import formatted_number, with_calendar
from meterwise.operators import clean as CL
from meterwise.operators import consumption as C
from meterwise.operators import ml as ML
from meterwise.operators.inspect import schema_profile, small_frame
from meterwise.operators.wordcount import word_count_of_texts
from meterwise.plans import analysis as AN
from meterwise.plans import jobs as J
from meterwise.plans import standins
from meterwise.plans.standins import (ADVERSITY, FLAT, GAPS_SQL, READINGS_SQL, WARNED,
                                      readings, readings_with_gaps, table)
from meterwise.schemas import ENERGY, GROUP, HOUSEHOLD, READING_SCHEMA, TARIFF, TIME
from meterwise.session import scratch_path
from meterwise.sources import files as SRC
from meterwise.sources import sinks as SNK

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return register


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(table(spark, sf_dir, "lineitem"))


def _gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_with_gaps(table(spark, sf_dir, "lineitem"))


MONTH_SQL = f"concat_ws('-', year({TIME}), month({TIME}))"


def _rounded(df: DataFrame, col: str, digits: int = 4) -> DataFrame:
    """Round one result column, so that both engines give identical values."""
    return df.withColumn(col, F.round(col, digits))


# ---- month / group / tariff means (A3, A7, A8, O4, O5, S11, S12) -----------

_MONTHLY_GROUP_ORACLE = f"""
WITH {READINGS_SQL}
SELECT {MONTH_SQL} AS Month, {GROUP}, ROUND(AVG({ENERGY}), 4) AS avg
FROM readings GROUP BY 1, 2 ORDER BY Month"""

_MONTHLY_TARIFF_ORACLE = f"""
WITH {READINGS_SQL}
SELECT {MONTH_SQL} AS Month, {TARIFF}, ROUND(AVG({ENERGY}), 4) AS avg_KWH
FROM readings GROUP BY 1, 2 ORDER BY Month"""


@query("monthly_mean_by_group", _MONTHLY_GROUP_ORACLE)
def monthly_mean_by_group(spark, sf_dir):
    return _rounded(AN.monthly_mean_by_group(_readings(spark, sf_dir)), "avg")


@query("monthly_mean_by_group_sql", _MONTHLY_GROUP_ORACLE)
def monthly_mean_by_group_sql(spark, sf_dir):
    return _rounded(AN.run_sql(spark, _readings(spark, sf_dir), AN.MONTHLY_MEAN_BY_GROUP_SQL), "avg")


@query("monthly_mean_by_tariff", _MONTHLY_TARIFF_ORACLE)
def monthly_mean_by_tariff(spark, sf_dir):
    return _rounded(AN.monthly_mean_by_tariff(_readings(spark, sf_dir)), "avg_KWH")


@query("monthly_mean_by_tariff_sql", _MONTHLY_TARIFF_ORACLE)
def monthly_mean_by_tariff_sql(spark, sf_dir):
    return _rounded(AN.run_sql(spark, _readings(spark, sf_dir), AN.MONTHLY_MEAN_BY_TARIFF_SQL), "avg_KWH")


_TOTAL_BY_GROUP_ORACLE = f"""
WITH {READINGS_SQL}
SELECT {GROUP}, CAST(SUM(CAST({ENERGY} AS DECIMAL(18,3))) AS DOUBLE) AS TotalKWH
FROM readings GROUP BY 1 ORDER BY TotalKWH DESC"""


@query("total_by_group", _TOTAL_BY_GROUP_ORACLE)
def total_by_group(spark, sf_dir):
    return _rounded(AN.run_sql(spark, _readings(spark, sf_dir), AN.TOTAL_BY_GROUP_SQL), "TotalKWH", 3)


@query("total_by_group_df", _TOTAL_BY_GROUP_ORACLE)
def total_by_group_df(spark, sf_dir):
    return (C.sum_by(_readings(spark, sf_dir), GROUP, ENERGY, "TotalKWH", exact_scale=3)
            .orderBy(F.col("TotalKWH").desc()))


_MEAN_BY_GROUP_ORACLE = f"""
WITH {READINGS_SQL}
SELECT {GROUP}, ROUND(AVG({ENERGY}), 4) AS AvgKWH
FROM readings GROUP BY 1 ORDER BY AvgKWH DESC"""


@query("mean_by_group", _MEAN_BY_GROUP_ORACLE)
def mean_by_group(spark, sf_dir):
    return _rounded(AN.run_sql(spark, _readings(spark, sf_dir), AN.MEAN_BY_GROUP_SQL), "AvgKWH")


@query("mean_by_group_df", _MEAN_BY_GROUP_ORACLE)
def mean_by_group_df(spark, sf_dir):
    return (C.mean_by(_readings(spark, sf_dir), GROUP, ENERGY, "AvgKWH", digits=4)
            .orderBy(F.col("AvgKWH").desc()))


@query("mean_by_tariff", f"""
WITH {READINGS_SQL}
SELECT {TARIFF}, ROUND(AVG({ENERGY}), 4) AS avg_KWH
FROM readings GROUP BY 1 ORDER BY avg_KWH DESC""")
def mean_by_tariff(spark, sf_dir):
    return _rounded(AN.run_sql(spark, _readings(spark, sf_dir), AN.MEAN_BY_TARIFF_SQL), "avg_KWH")


# Readings with many decimal places: nothing is rounded before the final aggregate.
_FINE_SQL = f"fine AS (SELECT l_returnflag AS {GROUP}, l_extendedprice / 1e7 AS {ENERGY} FROM lineitem)"


def _fine(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias(GROUP), (F.col("l_extendedprice") / F.lit(1e7)).alias(ENERGY))


@query("fine_totals", f"""
WITH {_FINE_SQL}
SELECT {GROUP}, ROUND(SUM({ENERGY}), 6) AS TotalKWH, ROUND(AVG({ENERGY}), 9) AS AvgKWH FROM fine GROUP BY 1""")
def fine_totals(spark, sf_dir):
    fine = _fine(spark, sf_dir)
    totals = _rounded(C.sum_by(fine, GROUP, ENERGY, "TotalKWH"), "TotalKWH", 6)
    return totals.join(_rounded(C.mean_by(fine, GROUP, ENERGY, "AvgKWH"), "AvgKWH", 9), GROUP)


@query("fine_grand_total", f"""
WITH {_FINE_SQL}
SELECT ROUND(SUM({ENERGY}), 6) AS total_kwh, COUNT(*) AS n_rows FROM fine""")
def fine_grand_total(spark, sf_dir):
    return _rounded(C.grand_total(_fine(spark, sf_dir)), "total_kwh", 6)


# ---- tariff contrast (A11) -------------------------------------------------

_CONTRAST_AGGS = f"""
  ROUND(AVG({ENERGY}) FILTER (WHERE {TARIFF} = '{WARNED}'), 4) AS avg_warned,
  ROUND(AVG({ENERGY}) FILTER (WHERE {TARIFF} = '{FLAT}'), 4) AS avg_flat,
  ROUND(AVG({ENERGY}) FILTER (WHERE {TARIFF} = '{WARNED}')
        - AVG({ENERGY}) FILTER (WHERE {TARIFF} = '{FLAT}'), 4) AS diff,
  AVG({ENERGY}) FILTER (WHERE {TARIFF} = '{WARNED}')
        < AVG({ENERGY}) FILTER (WHERE {TARIFF} = '{FLAT}') AS warned_below"""


@query("tariff_contrast", f"""
WITH {READINGS_SQL}
SELECT {MONTH_SQL} AS Month, {_CONTRAST_AGGS}
FROM readings GROUP BY 1 ORDER BY Month""")
def tariff_contrast(spark, sf_dir):
    return C.tariff_contrast(_readings(spark, sf_dir), by_month=True, warned=WARNED,
                             flat=FLAT, digits=4)


@query("tariff_contrast_total", f"""
WITH {READINGS_SQL}
SELECT {_CONTRAST_AGGS} FROM readings""")
def tariff_contrast_total(spark, sf_dir):
    return C.tariff_contrast(_readings(spark, sf_dir), by_month=False, warned=WARNED,
                             flat=FLAT, digits=4)


# ---- per household and global (A1, A2, A4, A5) -----------------------------

@query("household_mean", f"""
WITH {READINGS_SQL}
SELECT {HOUSEHOLD}, ROUND(AVG({ENERGY}), 4) AS avg_{ENERGY}
FROM readings GROUP BY 1""")
def household_mean(spark, sf_dir):
    r = _readings(spark, sf_dir).select(HOUSEHOLD, ENERGY)
    return C.numeric_means_by(r, HOUSEHOLD, digits=4)


@query("household_sum", f"""
WITH {READINGS_SQL}
SELECT {HOUSEHOLD}, CAST(SUM(CAST({ENERGY} AS DECIMAL(18,3))) AS DOUBLE) AS sum_{ENERGY}
FROM readings GROUP BY 1""")
def household_sum(spark, sf_dir):
    r = _readings(spark, sf_dir).select(HOUSEHOLD, ENERGY)
    return C.numeric_sums_by(r, HOUSEHOLD, exact_scale=3)


@query("grand_total", f"""
WITH {READINGS_SQL}
SELECT CAST(SUM(CAST({ENERGY} AS DECIMAL(18,3))) AS DOUBLE) AS total_kwh, COUNT(*) AS n_rows
FROM readings""")
def grand_total(spark, sf_dir):
    return C.grand_total(_readings(spark, sf_dir), exact_scale=3)


# ---- filters (F1, F2, F3, F5, F7, P2) --------------------------------------

@query("filter_text", f"""
WITH {READINGS_SQL}
SELECT * FROM readings WHERE {ENERGY} > 1""")
def filter_text(spark, sf_dir):
    return C.filter_text(_readings(spark, sf_dir), f"{ENERGY} > 1")


@query("filter_count", f"""
WITH {READINGS_SQL}
SELECT COUNT(*) AS n_rows FROM readings WHERE {ENERGY} > 1""")
def filter_count(spark, sf_dir):
    return C.row_count(C.filter_text(_readings(spark, sf_dir), f"{ENERGY} > 1"))


@query("filter_select", f"""
WITH {READINGS_SQL}
SELECT {HOUSEHOLD}, {ENERGY}, {GROUP} FROM readings WHERE {ENERGY} > 2""")
def filter_select(spark, sf_dir):
    return C.above(_readings(spark, sf_dir), 2).select([HOUSEHOLD, ENERGY, GROUP])


@query("filter_conjunction", f"""
WITH {READINGS_SQL}
SELECT * FROM readings WHERE {ENERGY} > 1 AND {GROUP} = '{ADVERSITY}'""")
def filter_conjunction(spark, sf_dir):
    return C.above_in_group(_readings(spark, sf_dir), 1, ADVERSITY)


@query("filter_equality", f"""
WITH {READINGS_SQL}
SELECT * FROM readings WHERE {TARIFF} = '{WARNED}'""")
def filter_equality(spark, sf_dir):
    return C.equal_to(_readings(spark, sf_dir), TARIFF, WARNED)


# ---- nulls (F6, F8-F12, K10) -----------------------------------------------

@query("null_rows", f"""
WITH {GAPS_SQL}
SELECT * FROM gaps WHERE {ENERGY} IS NULL""")
def null_rows(spark, sf_dir):
    return CL.null_rows(_gaps(spark, sf_dir), ENERGY)


_DROP_ANY_ORACLE = f"""
WITH {GAPS_SQL}
SELECT * FROM gaps
WHERE {HOUSEHOLD} IS NOT NULL AND {TARIFF} IS NOT NULL AND {TIME} IS NOT NULL
  AND {ENERGY} IS NOT NULL AND Acorn IS NOT NULL AND {GROUP} IS NOT NULL"""


@query("drop_any", _DROP_ANY_ORACLE)
def drop_any(spark, sf_dir):
    return CL.drop_incomplete(_gaps(spark, sf_dir), how="any")


@query("drop_all", f"""
WITH {GAPS_SQL}
SELECT * FROM gaps
WHERE {HOUSEHOLD} IS NOT NULL OR {TARIFF} IS NOT NULL OR {TIME} IS NOT NULL
   OR {ENERGY} IS NOT NULL OR Acorn IS NOT NULL OR {GROUP} IS NOT NULL""")
def drop_all(spark, sf_dir):
    return CL.drop_incomplete(_gaps(spark, sf_dir), how="all")


@query("drop_subset", f"""
WITH {GAPS_SQL}
SELECT * FROM gaps WHERE {ENERGY} IS NOT NULL""")
def drop_subset(spark, sf_dir):
    return CL.drop_incomplete(_gaps(spark, sf_dir), subset=[ENERGY])


@query("drop_thresh", f"""
WITH {GAPS_SQL}
SELECT * FROM gaps
WHERE CAST({HOUSEHOLD} IS NOT NULL AS INTEGER) + CAST({TARIFF} IS NOT NULL AS INTEGER)
    + CAST({TIME} IS NOT NULL AS INTEGER) + CAST({ENERGY} IS NOT NULL AS INTEGER)
    + CAST(Acorn IS NOT NULL AS INTEGER) + CAST({GROUP} IS NOT NULL AS INTEGER) >= 5""")
def drop_thresh(spark, sf_dir):
    return CL.drop_incomplete(_gaps(spark, sf_dir), thresh=5)


@query("null_marker", _DROP_ANY_ORACLE)
def null_marker(spark, sf_dir):
    gaps = _gaps(spark, sf_dir)
    # Missing text cells carry the literal marker, as in the source files.
    marked = gaps.select(*[
        F.coalesce(F.col(f.name), F.lit(CL.NULL_MARKER)).alias(f.name)
        if f.dataType.simpleString() == "string" else F.col(f.name)
        for f in gaps.schema.fields])
    return CL.drop_marked(marked)


@query("null_profile", f"""
WITH {GAPS_SQL}
SELECT 0 AS position, '{HOUSEHOLD}' AS "column", 'string' AS data_type,
       COUNT(*) - COUNT({HOUSEHOLD}) AS nulls FROM gaps
UNION ALL SELECT 1, '{TARIFF}', 'string', COUNT(*) - COUNT({TARIFF}) FROM gaps
UNION ALL SELECT 2, '{TIME}', 'timestamp_ntz', COUNT(*) - COUNT({TIME}) FROM gaps
UNION ALL SELECT 3, '{ENERGY}', 'double', COUNT(*) - COUNT({ENERGY}) FROM gaps
UNION ALL SELECT 4, 'Acorn', 'string', COUNT(*) - COUNT(Acorn) FROM gaps
UNION ALL SELECT 5, '{GROUP}', 'string', COUNT(*) - COUNT({GROUP}) FROM gaps""")
def null_profile(spark, sf_dir):
    return schema_profile(_gaps(spark, sf_dir))


# ---- calendar (X1-X5, P3) --------------------------------------------------

@query("calendar_parts", """
SELECT event_id, ts,
       CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
       CAST(hour(ts) AS INTEGER) AS hour, CAST(year(ts) AS INTEGER) AS year,
       CAST(dayofyear(ts) AS INTEGER) AS day_of_year,
       CAST(weekofyear(ts) AS INTEGER) AS week_of_year,
       concat_ws('-', year(ts), month(ts)) AS month_key,
       CAST(date_trunc('month', ts) AS DATE) AS month_start
FROM events""")
def calendar_parts(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return with_calendar(events, "ts")


# ---- ordering (O1, O2, O6, D3, D7) -----------------------------------------

@query("top_readings", f"""
WITH {READINGS_SQL}
SELECT * FROM readings
ORDER BY {ENERGY} DESC NULLS LAST, {HOUSEHOLD} ASC NULLS FIRST, {TARIFF} ASC NULLS FIRST,
         {TIME} ASC NULLS FIRST, Acorn ASC NULLS FIRST, {GROUP} ASC NULLS FIRST
LIMIT 20""")
def top_readings(spark, sf_dir):
    return C.top_k(_readings(spark, sf_dir), 20)


@query("lowest_readings", f"""
WITH {GAPS_SQL}
SELECT * FROM gaps
ORDER BY {ENERGY} ASC NULLS FIRST, {HOUSEHOLD} ASC NULLS FIRST, {TARIFF} ASC NULLS FIRST,
         {TIME} ASC NULLS FIRST, Acorn ASC NULLS FIRST, {GROUP} ASC NULLS FIRST
LIMIT 50""")
def lowest_readings(spark, sf_dir):
    return C.bottom_k(_gaps(spark, sf_dir), 50)


# ---- word count (X7-X10, A9, O3) -------------------------------------------

@query("word_count", """
WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
     words AS (SELECT unnest(string_split(line, ' ')) AS word FROM lines)
SELECT word, COUNT(*) AS count FROM words GROUP BY word ORDER BY count DESC""")
def word_count(spark, sf_dir):
    return word_count_of_texts(table(spark, sf_dir, "documents").select("text"))


_READINGS_ORACLE = f"""
WITH {READINGS_SQL}
SELECT * FROM readings"""


# ---- sources and sinks: write, read back (S1-S8, K1-K3, K6, P4, P6, F4, §3.1, §3.4) ----

@query("etl_csv_to_parquet", _DROP_ANY_ORACLE)
def etl_csv_to_parquet(spark, sf_dir):
    """§3.1: a raw readings CSV (made from the stand-in, gaps included) is loaded."""
    raw_csv = SNK.write_csv(_gaps(spark, sf_dir), scratch_path(spark, "raw-readings-csv"),
                            header=True)
    return J.load_readings(spark, raw_csv, scratch_path(spark, "readings-parquet"))


@query("etl_partitioned_month", _READINGS_ORACLE)
def etl_partitioned_month(spark, sf_dir):
    """§3.1 with a year/month folder layout (range-partitioned write), read back whole.

    Month filters on this layout prune folders (see tests/test_sources_sinks.py).
    """
    raw_csv = SNK.write_csv(_readings(spark, sf_dir), scratch_path(spark, "raw-readings-csv"),
                            header=True)
    return J.load_readings(spark, raw_csv, scratch_path(spark, "readings-by-month"),
                           partition_by_month=True)


@query("csv_round_trip", _READINGS_ORACLE)
def csv_round_trip(spark, sf_dir):
    path = SNK.write_csv(_readings(spark, sf_dir), scratch_path(spark, "readings-csv"),
                         header=True)
    return SRC.read_readings_csv(spark, path, READING_SCHEMA)


@query("parquet_round_trip", "SELECT * FROM lineitem")
def parquet_round_trip(spark, sf_dir):
    path = SNK.write_parquet(table(spark, sf_dir, "lineitem"),
                             scratch_path(spark, "lineitem-parquet"), mode="errorifexists")
    return SRC.read_parquet(spark, path)


@query("json_round_trip", _READINGS_ORACLE)
def json_round_trip(spark, sf_dir):
    path = SNK.write_json(_readings(spark, sf_dir), scratch_path(spark, "readings-json"))
    return SRC.read_json(spark, path, READING_SCHEMA)


@query("text_round_trip", "SELECT p_name AS value FROM part")
def text_round_trip(spark, sf_dir):
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("value"))
    return SRC.read_text(spark, SNK.write_text(names, scratch_path(spark, "part-names-text")))


@query("positional_rename", _READINGS_ORACLE)
def positional_rename(spark, sf_dir):
    """Headerless read of files that have header lines: rename, drop headers, cast."""
    path = SNK.write_csv(_readings(spark, sf_dir), scratch_path(spark, "readings-csv"),
                         header=True)
    return SRC.repair_headerless(SRC.read_csv_headerless(spark, path), READING_SCHEMA)


@query("filter_range", """
SELECT p_name AS name FROM part WHERE p_size >= 13 AND p_size <= 19""")
def filter_range(spark, sf_dir):
    """§3.4 people job over ``part`` (age <- p_size, name <- p_name)."""
    people = SNK.write_json(standins.people(table(spark, sf_dir, "part")),
                            scratch_path(spark, "people-json"))
    return J.people_job(spark, people, scratch_path(spark, "people-parquet"),
                        csv_out=scratch_path(spark, "people-in-range-csv"))


@query("people_to_parquet", """
SELECT p_name AS name FROM part WHERE p_size >= 20 AND p_size <= 30""")
def people_to_parquet(spark, sf_dir):
    """The people job with an inferred JSON schema, saving its result as Parquet."""
    people = SNK.write_json(standins.people(table(spark, sf_dir, "part")), scratch_path(spark, "people-json"))
    target = scratch_path(spark, "people-in-range")
    J.people_job(spark, people, scratch_path(spark, "people-parquet"), schema=None, low=20, high=30, parquet_out=target)
    return SRC.read_parquet(spark, target)


@query("csv_all_strings", f"""
WITH {READINGS_SQL}
SELECT {HOUSEHOLD}, {TARIFF}, {GROUP} FROM readings""")
def csv_all_strings(spark, sf_dir):
    """S3: names from the header, every column text."""
    path = SNK.write_csv(_readings(spark, sf_dir), scratch_path(spark, "readings-csv"), header=True)
    return spark.read.option("header", True).csv(path).select(HOUSEHOLD, TARIFF, GROUP)


@query("csv_generic_load", _READINGS_ORACLE)
def csv_generic_load(spark, sf_dir):
    """The generic spelling of the same reader."""
    path = SNK.write_csv(_readings(spark, sf_dir), scratch_path(spark, "readings-csv"), header=True)
    return spark.read.format("csv").load(path, schema=READING_SCHEMA, header=True)


@query("date_and_double", f"""
WITH {READINGS_SQL}
SELECT CAST({TIME} AS DATE) AS day, CAST(CAST({ENERGY} AS FLOAT) AS DOUBLE) AS kwh FROM readings""")
def date_and_double(spark, sf_dir):
    """P7 + P9: time to date, single to double precision."""
    r = _readings(spark, sf_dir).select(TIME, F.col(ENERGY).cast("float").alias("kwh"))
    return CL.floats_to_double(CL.to_date_column(r, TIME, "day")).select("day", "kwh")


@query("word_count_text_file", """
WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
     words AS (SELECT unnest(string_split(line, ' ')) AS word FROM lines)
SELECT word, COUNT(*) AS count FROM words GROUP BY word ORDER BY count DESC""")
def word_count_text_file(spark, sf_dir):
    """X10 as the original job: a text file read line by line, counts written out."""
    text = SNK.write_text(table(spark, sf_dir, "documents").select(F.col("text").alias("value")),
                          scratch_path(spark, "documents-text"))
    return J.word_count_job(spark, text, out_csv=scratch_path(spark, "word-count-csv"),
                            out_pairs=scratch_path(spark, "word-count-pairs"))


# ---- machine learning (M1-M15) ---------------------------------------------

@query("index_frequency", """
WITH codes AS (
  SELECT event_type,
         CAST(row_number() OVER (ORDER BY COUNT(*) DESC, event_type) - 1 AS DOUBLE) AS type_code
  FROM events GROUP BY event_type)
SELECT e.event_id, e.event_type, c.type_code FROM events e JOIN codes c USING (event_type)""")
def index_frequency(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return ML.index(events, "event_type", "type_code")


@query("index_alphabetical", """
SELECT event_id, event_type,
       CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS DOUBLE) AS type_code
FROM events""")
def index_alphabetical(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return ML.index(events, "event_type", "type_code", order="alphabetAsc")


@query("index_household_join", f"""
WITH {READINGS_SQL},
codes AS (
  SELECT {HOUSEHOLD}, COUNT(*) AS n,
         CAST(row_number() OVER (ORDER BY COUNT(*) DESC, {HOUSEHOLD}) - 1 AS DOUBLE) AS household_code
  FROM readings GROUP BY {HOUSEHOLD})
SELECT {HOUSEHOLD}, household_code, n FROM codes""")
def index_household_join(spark, sf_dir):
    """Household codes with their counts, both from the code table."""
    codes = ML.code_table(_readings(spark, sf_dir), HOUSEHOLD)
    return codes.select(HOUSEHOLD, F.col("code").alias("household_code"), "n")


@query("index_with_nulls", f"""
WITH {GAPS_SQL},
codes AS (
  SELECT {HOUSEHOLD} AS h, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, {HOUSEHOLD}) - 1 AS DOUBLE) AS code
  FROM gaps WHERE {HOUSEHOLD} IS NOT NULL GROUP BY {HOUSEHOLD})
SELECT {HOUSEHOLD}, code, COUNT(*) AS n FROM gaps LEFT JOIN codes ON h = {HOUSEHOLD} GROUP BY 1, 2""")
def index_with_nulls(spark, sf_dir):
    """A missing household gets a missing code."""
    rows = _gaps(spark, sf_dir).select(HOUSEHOLD)
    codes = ML.code_table(rows, HOUSEHOLD).select(HOUSEHOLD, "code")
    # Counted before the join: each household is one row on both sides.
    return C.count_by(rows, HOUSEHOLD, "n").join(codes, HOUSEHOLD, "left").select(HOUSEHOLD, "code", "n")


@query("split_by_hash", """
SELECT l_orderkey, l_linenumber,
       (CAST('0x' || substr(md5(l_orderkey || '|' || l_linenumber), 1, 8) AS BIGINT) % 10000) < 8000 AS train
FROM lineitem""")
def split_by_hash(spark, sf_dir):
    """M3: the same rows on the same side on any cluster."""
    keys = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    train, test = ML.hash_split(keys, ["l_orderkey", "l_linenumber"], 0.8)
    return train.withColumn("train", F.lit(True)).unionByName(test.withColumn("train", F.lit(False)))


@query("trees_on_group", f"""
WITH {READINGS_SQL}, m AS (SELECT {GROUP}, ROUND(AVG({ENERGY}), 6) AS prediction FROM readings GROUP BY 1)
SELECT model, {GROUP}, prediction FROM m, (VALUES ('decision_tree'), ('random_forest'), ('gbt')) t(model)""")
def trees_on_group(spark, sf_dir):
    """M6-M8: on one three-value feature each learner gives the mean of every group."""
    return ML.trees_on_group(_readings(spark, sf_dir)).withColumn("prediction", F.round("prediction", 6))


_GROUP_CODES_SQL = f"""group_codes AS (
  SELECT {GROUP}, row_number() OVER (ORDER BY COUNT(*) DESC, {GROUP}) - 1 AS group_code
  FROM readings GROUP BY {GROUP})"""

_HOUSEHOLD_CODES_SQL = f"""household_codes AS (
  SELECT {HOUSEHOLD}, row_number() OVER (ORDER BY COUNT(*) DESC, {HOUSEHOLD}) - 1 AS household_code
  FROM readings GROUP BY {HOUSEHOLD})"""


@query("ols_group_code", f"""
WITH {READINGS_SQL}, {_GROUP_CODES_SQL}
SELECT ROUND(regr_slope({ENERGY}, group_code), 6) AS coef_group_code,
       ROUND(regr_intercept({ENERGY}, group_code), 6) AS intercept
FROM readings JOIN group_codes USING ({GROUP})""")
def ols_group_code(spark, sf_dir):
    """M1 + M2 + M4 with one feature: energy on the group code."""
    coded = ML.index(_readings(spark, sf_dir).select(GROUP, ENERGY), GROUP, "group_code")
    model = ML.linear_fit(coded, ["group_code"], ENERGY)
    return _coefficients(spark, model, ["group_code"])


@query("ols_household_group", f"""
WITH {READINGS_SQL}, {_GROUP_CODES_SQL}, {_HOUSEHOLD_CODES_SQL},
x AS (SELECT CAST(household_code AS DOUBLE) AS a, CAST(group_code AS DOUBLE) AS b, {ENERGY} AS y
      FROM readings JOIN group_codes USING ({GROUP}) JOIN household_codes USING ({HOUSEHOLD})),
m AS (SELECT var_pop(a) AS saa, var_pop(b) AS sbb, covar_pop(a, b) AS sab,
             covar_pop(a, y) AS say, covar_pop(b, y) AS sby,
             avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM x),
c AS (SELECT (sbb * say - sab * sby) / (saa * sbb - sab * sab) AS ca,
             (saa * sby - sab * say) / (saa * sbb - sab * sab) AS cb, ma, mb, my FROM m)
SELECT ROUND(ca, 6) AS coef_household_code, ROUND(cb, 6) AS coef_group_code,
       ROUND(my - ca * ma - cb * mb, 6) AS intercept FROM c""")
def ols_household_group(spark, sf_dir):
    """The original model: energy on (household code, group code), least squares."""
    feats = ML.household_group_features(_readings(spark, sf_dir))
    model = ML.linear_fit(feats, ["household_code", "group_code"], ENERGY)
    return _coefficients(spark, model, ["household_code", "group_code"])


@query("group_from_kwh", f"""
WITH {READINGS_SQL}, {_GROUP_CODES_SQL},
x AS (SELECT {ENERGY} AS k, CAST(group_code AS DOUBLE) AS g
      FROM readings JOIN group_codes USING ({GROUP})),
f AS (SELECT regr_slope(g, k) AS s, regr_intercept(g, k) AS i FROM x)
SELECT ROUND(s, 6) AS coef_kwh, ROUND(i, 6) AS intercept,
       ROUND(AVG((g - (i + s * k)) * (g - (i + s * k))), 6) AS mse
FROM x, f GROUP BY s, i""")
def group_from_kwh(spark, sf_dir):
    """The social-group code predicted from energy, fitted and scored on all rows."""
    coded = ML.index(_readings(spark, sf_dir).select(GROUP, ENERGY), GROUP, "group_code")
    data = coded.withColumnRenamed(ENERGY, "kwh")
    model = ML.linear_fit(data, ["kwh"], "group_code")
    mse = model.summary.meanSquaredError
    return small_frame(spark, [(round(float(model.coefficients[0]), 6),
                                round(float(model.intercept), 6), round(float(mse), 6))],
                       _schema(["coef_kwh", "intercept", "mse"]))


def _coefficients(spark, model, names):
    values = [round(float(v), 6) for v in model.coefficients] + [round(float(model.intercept), 6)]
    cols = [f"coef_{n}" for n in names] + ["intercept"]
    return small_frame(spark, [tuple(values)], _schema(cols))


def _schema(double_cols):
    return T.StructType([T.StructField(c, T.DoubleType()) for c in double_cols])


@query("model_comparison")
def model_comparison(spark, sf_dir):
    """M3 + M5-M9: four learners on an 80/20 split by key hash, one score row per model."""
    feats = ML.household_group_features(_readings(spark, sf_dir), keep=(HOUSEHOLD, TIME, GROUP))
    train, test = ML.hash_split(feats, [HOUSEHOLD, TIME, GROUP, ENERGY], 0.8)
    return ML.compare_models(spark, train.select("features", ENERGY), test.select("features", ENERGY), ENERGY)


# Least squares with three features solved by Cramer's rule on the population
# covariances of the training rows; codes are alphabetical (dense_rank - 1) and
# the split is positional (first 80 % of rows in the stated order).
_LABEL_ENCODED_ORACLE = f"""
WITH {READINGS_SQL},
coded AS (
  SELECT CAST(dense_rank() OVER (ORDER BY {GROUP}) - 1 AS DOUBLE) AS a,
         CAST(dense_rank() OVER (ORDER BY {HOUSEHOLD}) - 1 AS DOUBLE) AS b,
         CAST(dense_rank() OVER (ORDER BY Acorn) - 1 AS DOUBLE) AS c,
         {ENERGY} AS y,
         row_number() OVER (ORDER BY {HOUSEHOLD}, {TIME}, {ENERGY}, {TARIFF}, Acorn, {GROUP}) - 1 AS pos,
         COUNT(*) OVER () AS n
  FROM readings),
train AS (SELECT * FROM coded WHERE pos < CAST(floor(n * 0.8) AS BIGINT)),
test AS (SELECT * FROM coded WHERE pos >= CAST(floor(n * 0.8) AS BIGINT)),
m AS (SELECT var_pop(a) AS saa, var_pop(b) AS sbb, var_pop(c) AS scc,
             covar_pop(a, b) AS sab, covar_pop(a, c) AS sac, covar_pop(b, c) AS sbc,
             covar_pop(a, y) AS say, covar_pop(b, y) AS sby, covar_pop(c, y) AS scy,
             avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, avg(y) AS my FROM train),
d AS (SELECT *, saa * (sbb * scc - sbc * sbc) - sab * (sab * scc - sbc * sac)
                + sac * (sab * sbc - sbb * sac) AS det FROM m),
beta AS (
  SELECT (say * (sbb * scc - sbc * sbc) - sab * (sby * scc - sbc * scy)
          + sac * (sby * sbc - sbb * scy)) / det AS ba,
         (saa * (sby * scc - sbc * scy) - say * (sab * scc - sbc * sac)
          + sac * (sab * scy - sby * sac)) / det AS bb,
         (saa * (sbb * scy - sby * sbc) - sab * (sab * scy - sby * sac)
          + say * (sab * sbc - sbb * sac)) / det AS bc,
         ma, mb, mc, my FROM d),
scored AS (SELECT t.y, (beta.my - beta.ba * beta.ma - beta.bb * beta.mb - beta.bc * beta.mc)
                       + beta.ba * t.a + beta.bb * t.b + beta.bc * t.c AS p
           FROM test t, beta)
SELECT 'linear_regression' AS model,
       ROUND(AVG(ABS(p - y)), 6) AS mae,
       ROUND(SQRT(AVG((p - y) * (p - y))), 6) AS rmse,
       ROUND(AVG((p - y) * (p - y)), 6) AS mse,
       ROUND(1 - AVG((p - y) * (p - y)) / var_pop(y), 6) AS r2,
       ROUND(AVG(CASE WHEN p = y THEN 1.0 ELSE 0.0 END), 6) AS exact_share,
       COUNT(*) AS n_test
FROM scored"""


@query("label_encoded_regression", _LABEL_ENCODED_ORACLE)
def label_encoded_regression(spark, sf_dir):
    """Alphabetical codes of three columns, positional 80/20 split, MAE."""
    r = _readings(spark, sf_dir)
    order = [HOUSEHOLD, TIME, ENERGY, TARIFF, "Acorn", GROUP]
    out = ML.label_encoded_regression(spark, r, [GROUP, HOUSEHOLD, "Acorn"], ENERGY, order)
    return out.select("model", *[F.round(c, 6).alias(c) for c in ML.METRICS + ("exact_share",)],
                      "n_test")


@query("count_vector", """
WITH words AS (SELECT unnest(string_split(text, ' ')) AS term FROM documents),
counts AS (SELECT term, COUNT(*) AS term_count FROM words GROUP BY term)
SELECT CAST(row_number() OVER (ORDER BY term_count DESC, term) - 1 AS INTEGER) AS term_index,
       term, term_count
FROM counts ORDER BY term_count DESC, term LIMIT 4""")
def count_vector(spark, sf_dir):
    """Vocabulary of the 4 most frequent tokens, with their corpus counts."""
    docs = table(spark, sf_dir, "documents").select("text")
    return ML.vocabulary_counts(*ML.count_vectorize(docs, "text", vocab_size=4, min_df=1.0))


# ---- incremental load (§3.1 as a stream) -----------------------------------

@query("streaming_ingest", _DROP_ANY_ORACLE)
def streaming_ingest(spark, sf_dir):
    """New CSV files -> schema -> drop incomplete rows -> Parquet, exactly once."""
    from meterwise.streaming.ingest import ingest_available

    landing, target = scratch_path(spark, "landing-csv"), scratch_path(spark, "ingested-parquet")
    gaps = _gaps(spark, sf_dir).withColumn("_half", F.pmod(F.xxhash64(TIME, HOUSEHOLD), F.lit(2)))
    for half in (0, 1):  # two runs, each finding new files
        part = gaps.filter(F.coalesce("_half", F.lit(0)) == half).drop("_half")
        part.write.mode("append").option("header", True).csv(landing)
        found = ingest_available(spark, landing, target)
    return found


@query("tolerant_load", f"""
WITH {GAPS_SQL}
SELECT * FROM gaps""")
def tolerant_load(spark, sf_dir):
    """A file whose missing cells hold the text ``Null`` loads with them as null."""
    path = scratch_path(spark, "marked-csv")
    (_gaps(spark, sf_dir).write.mode("overwrite").option("header", True)
        .option("nullValue", CL.NULL_MARKER).csv(path))
    return SRC.read_tolerant_csv(spark, path, READING_SCHEMA)


@query("analysis_job", _MONTHLY_TARIFF_ORACLE)
def analysis_job(spark, sf_dir):
    """§3.3 end to end: staged Parquet -> SQL over the view -> saved result."""
    staged = SNK.write_parquet(_readings(spark, sf_dir), scratch_path(spark, "staged-readings"))
    return _rounded(J.analysis_job(spark, staged, scratch_path(spark, "monthly-tariff-means")), "avg_KWH")


@query("total_by_group_formatted", f"""
WITH {READINGS_SQL}
SELECT {GROUP}, format('{{:,.2f}}', CAST(SUM(CAST({ENERGY} AS DECIMAL(18,3))) AS DOUBLE)) AS TotalKWH_text
FROM readings GROUP BY 1""")
def total_by_group_formatted(spark, sf_dir):
    """Group totals as display text with thousands separators."""
    totals = C.sum_by(_readings(spark, sf_dir), GROUP, ENERGY, "TotalKWH", exact_scale=3)
    return totals.select(GROUP, formatted_number("TotalKWH", 2).alias("TotalKWH_text"))


# ---- verified models, exact sums, quarantine, reload ------------------------

_CELL_CODES = """
rows AS (
  SELECT l_returnflag AS g, l_linestatus AS t, l_quantity / 10 AS y,
         (CAST('0x' || substr(md5(l_orderkey || '|' || l_linenumber), 1, 8) AS BIGINT) % 10000) < 8000 AS train
  FROM lineitem),
coded AS (
  SELECT *, CAST(dense_rank() OVER (ORDER BY g) - 1 AS DOUBLE) AS a, CAST(dense_rank() OVER (ORDER BY t) - 1 AS DOUBLE) AS b FROM rows)"""


@query("model_comparison_cells", f"""
WITH {_CELL_CODES},
m AS (SELECT var_pop(a) AS saa, var_pop(b) AS sbb, covar_pop(a, b) AS sab, covar_pop(a, y) AS say, covar_pop(b, y) AS sby,
             avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM coded WHERE train),
c AS (SELECT (sbb * say - sab * sby) / (saa * sbb - sab * sab) AS ca, (saa * sby - sab * say) / (saa * sbb - sab * sab) AS cb, ma, mb, my FROM m),
cells AS (SELECT g, t, avg(y) AS p FROM coded WHERE train GROUP BY g, t),
scored AS (
  SELECT 'linear_regression' AS model, y, my + ca * (a - ma) + cb * (b - mb) AS p FROM coded, c WHERE NOT train
  UNION ALL
  SELECT model, y, p FROM coded JOIN cells USING (g, t), (VALUES ('decision_tree'), ('random_forest'), ('gbt')) v(model) WHERE NOT train)
SELECT model, ROUND(AVG(ABS(p - y)), 6) AS mae, ROUND(SQRT(AVG((p - y) * (p - y))), 6) AS rmse, ROUND(AVG((p - y) * (p - y)), 6) AS mse,
       ROUND(1 - AVG((p - y) * (p - y)) / var_pop(y), 6) AS r2, COUNT(*) AS n_test
FROM scored GROUP BY model""")
def model_comparison_cells(spark, sf_dir):
    """M9 with a closed form: the four learners on (group, tariff) codes, split by key hash."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_returnflag").alias(GROUP), F.col("l_linestatus").alias(TARIFF),
        (F.col("l_quantity") / F.lit(10)).alias(ENERGY))
    coded, _ = ML.index_many(rows, [GROUP, TARIFF], ["group_code", "tariff_code"], order="alphabetAsc")
    train, test = ML.hash_split(ML.assemble(coded, ["group_code", "tariff_code"]), ["l_orderkey", "l_linenumber"], 0.8)
    found = ML.compare_models(spark, train.select("features", ENERGY), test.select("features", ENERGY), ENERGY,
                              learners=ML.cell_learners(ENERGY))
    return found.select("model", *(F.round(c, 6).alias(c) for c in ML.METRICS), "n_test")


@query("reproducible_totals", """
SELECT l_returnflag AS g, l_linestatus AS t, ROUND(SUM(CAST(CAST(l_quantity AS DOUBLE) * l_extendedprice AS DECIMAL(38, 6))), 2)::DOUBLE AS total,
       ROUND(AVG(CAST(l_quantity AS DOUBLE) * l_extendedprice), 6) AS avg, COUNT(*) AS n
FROM lineitem GROUP BY 1, 2""")
def reproducible_totals(spark, sf_dir):
    """Sums and means of doubles, bit by bit the same under any partitioning."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("g"), F.col("l_linestatus").alias("t"),
                                                   (F.col("l_quantity").cast("double") * F.col("l_extendedprice")).alias("x"))
    found = C.reproducible_by(rows, ["g", "t"], "x")
    return found.select("g", "t", F.round("total", 2).alias("total"), F.round("avg", 6).alias("avg"), "n")


_BAD_CELLS = """
  l_linenumber = 6 AS bad_time, l_quantity > 45 AS bad_energy"""


@query("quarantined_load", f"""
WITH r AS (SELECT {_BAD_CELLS} FROM lineitem)
SELECT 'DateTime' AS reason, COUNT(*) AS n_cells FROM r WHERE bad_time
UNION ALL SELECT '{ENERGY}', COUNT(*) FROM r WHERE bad_energy
UNION ALL SELECT '_good', COUNT(*) FROM r WHERE NOT bad_time AND NOT bad_energy
UNION ALL SELECT '_rejected', COUNT(*) FROM r WHERE bad_time OR bad_energy""")
def quarantined_load(spark, sf_dir):
    """A file with unreadable times and energies; good rows, rejected rows and reasons counted."""
    lines = table(spark, sf_dir, "lineitem")
    cells = standins.readings(lines).columns
    raw = lines.select("l_linenumber", "l_quantity", *standins.reading_columns()).select(
        *(F.when(F.col("l_linenumber") == 6, F.lit("some day")).otherwise(F.col(c).cast("string")).alias(c) if c == TIME
          else F.when(F.col("l_quantity") > 45, F.lit("n/a")).otherwise(F.col(c).cast("string")).alias(c) if c == ENERGY
          else F.col(c) for c in cells))
    path = SNK.write_csv(raw, scratch_path(spark, "bad-cells-csv"), header=True)
    good, rejected, reasons = SRC.read_quarantined_csv(spark, path)
    sizes = [df.agg(F.lit(name).alias("reason"), F.count(F.lit(1)).alias("n_cells")) for name, df in (("_good", good), ("_rejected", rejected))]
    return reasons.unionByName(sizes[0]).unionByName(sizes[1])


@query("month_reload", _READINGS_ORACLE)
def month_reload(spark, sf_dir):
    """K1, K7: a month loaded wrong, then right, then again: each reload replaces that month only."""
    rows, path = _readings(spark, sf_dir), scratch_path(spark, "reloaded-months")
    march = rows.filter((F.year(TIME) == 1995) & (F.month(TIME) == 3))
    SNK.reload_months(rows, path)
    SNK.reload_months(march.withColumn(ENERGY, F.col(ENERGY) * 1000), path)
    for _ in range(2):
        SNK.reload_months(march, path)
    return SRC.read_parquet(spark, path).drop("year", "month")


@query("contrast_errors", f"""
WITH {READINGS_SQL},
each AS (
  SELECT {MONTH_SQL} AS Month, {HOUSEHOLD},
         coalesce(SUM({ENERGY}) FILTER ({TARIFF} = '{WARNED}'), 0) AS sw, COUNT(*) FILTER ({TARIFF} = '{WARNED}') AS nw,
         coalesce(SUM({ENERGY}) FILTER ({TARIFF} = '{FLAT}'), 0) AS sf, COUNT(*) FILTER ({TARIFF} = '{FLAT}') AS nf
  FROM readings GROUP BY 1, 2),
m AS (SELECT Month, SUM(sw) / NULLIF(SUM(nw), 0) AS mw, SUM(sf) / NULLIF(SUM(nf), 0) AS mf, SUM(nw) AS cw, SUM(nf) AS cf, COUNT(*) AS n
      FROM each GROUP BY 1),
v AS (SELECT Month, mw - mf AS diff, SQRT(SUM(((sw - nw * mw) / cw - (sf - nf * mf) / cf) ** 2)) AS se, n
      FROM each JOIN m USING (Month) GROUP BY Month, mw, mf, n)
SELECT Month, ROUND(diff, 4) AS diff, ROUND(se, 4) AS std_err, ROUND(diff / NULLIF(se, 0), 3) AS t_value, n AS n_households FROM v""")
def contrast_errors(spark, sf_dir):
    """Is the difference of the tariff groups larger than its clustered error?"""
    found = C.contrast_errors(_readings(spark, sf_dir), warned=WARNED, flat=FLAT)
    return found.select("Month", F.round("diff", 4).alias("diff"), F.round("std_err", 4).alias("std_err"),
                        F.round("t_value", 3).alias("t_value"), "n_households")


@query("group_classification", f"""
WITH {READINGS_SQL}
SELECT {GROUP}, COUNT(*) AS n, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (), 4) AS observed_share,
       ROUND(COUNT(*) / SUM(COUNT(*)) OVER (), 4) AS fitted_share
FROM readings GROUP BY 1""")
def group_classification(spark, sf_dir):
    """Multinomial regression of the group on energy; its score equations make fitted and observed shares equal."""
    shares = ML.classify_group(_readings(spark, sf_dir))["shares"]
    return shares.select(GROUP, "n", F.round("observed_share", 4).alias("observed_share"), F.round("fitted_share", 4).alias("fitted_share"))


@query("persisted_pipeline", f"""
WITH {READINGS_SQL}
SELECT {GROUP}, ROUND(AVG({ENERGY}), 6) AS prediction, COUNT(*) AS n FROM readings GROUP BY 1""")
def persisted_pipeline(spark, sf_dir):
    """A fitted pipeline saved to the shared folder and read back scores all rows."""
    rows = _readings(spark, sf_dir)
    model = ML.persisted_pipeline(rows, scratch_path(spark, "group-pipeline"))
    scored = model.transform(rows.select(GROUP))
    return scored.groupBy(GROUP, F.round("prediction", 6).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))
