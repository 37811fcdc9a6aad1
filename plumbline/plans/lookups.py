"""Queries of the lookups. Parts stand for the sites; the waits are the latest month of the
statistics track, stored as a table first."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import lookups
from plumbline.operators import waits
from plumbline.operators.shape import ROW_CAP, top_rows
from plumbline.plans.base import day, longs, query, table
from plumbline.plans.statistics import JUDGED, kept_waits
from plumbline.session import pinned, scratch_path
from plumbline.sources import tables

ALIASES = {"%urgent%": ("now", "soon"), "%medium%": ("middle", "mid")}
LABEL = "Published figures"


def sites(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "concat(p_name, ' ', p_partkey) as name",
        "p_type as site_type",
        "p_brand as town",
        "concat('Shelf ', p_size, ', Hall ', p_partkey % 7) as address",
        "cast(p_partkey as string) as phone",
        "'Mon-Fri' as opening_hours",
        "concat(replace(p_name, ' ', '_'), ';', lower(p_type)) as services",
    )


def latest(spark: SparkSession, folder: str) -> DataFrame:
    """The latest-month table as it is served: written once, read by every call."""
    path = scratch_path(spark, "latest_waits")
    tables.overwrite(waits.latest_waits(pinned(kept_waits(spark, folder), "kept")), path)
    return tables.read(spark, path)


def register(spark: SparkSession, folder: str) -> None:
    sites(spark, folder).createOrReplaceTempView("site_table")
    latest(spark, folder).createOrReplaceTempView("waits_table")
    lookups.create_functions(spark, "site_table", "waits_table", ALIASES, LABEL)


SITES = """site_table as (
    select p_name || ' ' || p_partkey as name, p_type as site_type, p_brand as town,
      'Shelf ' || p_size || ', Hall ' || (p_partkey % 7) as address, p_partkey::varchar as phone, 'Mon-Fri' as opening_hours,
      replace(p_name, ' ', '_') || ';' || lower(p_type) as services from part)"""
LATEST = f"""{JUDGED}, latest as (
    select strftime(month_ending, '%Y-%m-%d') as month_ending, board_name, is_scotland, patient_type, specialty as specialty_code,
      specialty_name, is_all_specialties, trunc(number_waiting)::int as number_waiting, trunc(waiting_over_12_weeks)::int as waiting_over_12_weeks,
      round(100 * share_over_12_weeks, 1) as pct_over_12_weeks, median_wait_days, p90_wait_days
    from kept where month_ending = (select max(month_ending) from kept) and board_name is not null and number_waiting is not null)"""


def matches_sql(name: str, arg: str) -> str:
    cases = " ".join(
        f"when list_has_any(string_split_regex(lower(trim({arg})), '[^a-z]+'), {list(group)}) then '{pattern}'"
        for pattern, group in ALIASES.items()
    )
    letters = f"regexp_replace({arg}, '[^A-Za-z]', '', 'g')"
    return f"""coalesce({name} ilike coalesce(case {cases} end, '__none__')
      or (length({letters}) > 0 and regexp_matches({name}, '(^|[^a-z])' || {letters} || '($|[^a-z])', 'i'))
      or (length(trim({arg})) > 4 and {name} ilike '%' || left(trim({arg}), length(trim({arg})) - 2) || '%'), false)"""


def waits_sql(specialty: str, patient_type: str, board: str) -> str:
    def blank(a):
        return f"({a} is null or trim({a}) = '')"

    return f"""(case when {blank(board)} then is_scotland else board_name ilike '%' || trim({board}) || '%' end)
      and (case when {blank(specialty)} then is_all_specialties else {matches_sql('specialty_name', specialty)} end)
      and ({blank(patient_type)} or patient_type ilike '%' || string_split(trim({patient_type}), ' ')[1] || '%')"""


WAITS_OUT = f"""month_ending, board_name as board, patient_type,
    case when is_all_specialties then 'All specialties' else coalesce(specialty_name, specialty_code) end as specialty,
    number_waiting, waiting_over_12_weeks, pct_over_12_weeks, median_wait_days, round(median_wait_days / 7, 1) as median_wait_weeks,
    p90_wait_days, round(p90_wait_days / 7, 1) as p90_wait_weeks, '{LABEL}' as source"""


@query(
    "fn_find_by_service",
    f"""with {SITES} select * from site_table where (services ilike '%red_widget%' or services ilike '%red widget%' or name ilike '%Red widget%')
      and town ilike '%brand#1%'""",
)
def fn_find_by_service(spark, folder):
    sites(spark, folder).createOrReplaceTempView("site_table")
    lookups.create_site_function(spark, "site_table")
    return lookups.call(spark, "find_clinic", {"service": "Red widget", "town": " brand#1 "})


@query(
    "fn_lookup_by_words",
    f"""with {LATEST} select {WAITS_OUT} from latest where {waits_sql("'Urgently'", "'New Outpatient'", "'nation_1'")}
      order by board_name, specialty_name, patient_type limit {ROW_CAP}""",
)
def fn_lookup_by_words(spark, folder):
    register(spark, folder)
    out = lookups.call(spark, "get_waiting_times", {"specialty": "Urgently", "patient_type": "New Outpatient", "board": "nation_1"})
    return out.withColumn("month_ending", day("month_ending"))


@query("fn_list_names", f"with {LATEST} select distinct specialty_name as specialty from latest where is_scotland and not is_all_specialties and specialty_name is not null")
def fn_list_names(spark, folder):
    register(spark, folder)
    return lookups.call(spark, "list_waiting_time_specialties", {})


@query("fn_named_params", f"with {LATEST} select {WAITS_OUT} from latest where {waits_sql('null', 'null', 'null')} order by board_name, specialty_name, patient_type limit {ROW_CAP}")
def fn_named_params(spark, folder):
    """Blank arguments are dropped: the national total for all specialties."""
    register(spark, folder)
    out = lookups.call(spark, "get_waiting_times", {"specialty": "", "patient_type": None, "board": "  "})
    return out.withColumn("month_ending", day("month_ending"))


CALLS = [
    ("urgent", "New Outpatient", None),
    (None, None, None),
    ("Mediums", "Inpatient", "NATION_7"),
    ("HIGH", "New Outpatient", "NATION_1"),
    ("soon", "New Outpatient", None),
    ("needed soon", "Inpatient", None),
    ("low", None, "nation"),
    ("igh", None, "nation"),
    ("middle", "", "asia"),
]


def _literal(v) -> str:
    return "null::varchar" if v is None else f"'{v}'"


@query(
    "fn_lateral_batch",
    f"""with {LATEST}, calls as (select * from (values {', '.join(f"({i}, {', '.join(map(_literal, c))})" for i, c in enumerate(CALLS))}) as t(call, a_specialty, a_type, a_board)),
      met as (select call, {WAITS_OUT}, row_number() over (partition by call order by board_name nulls first, specialty_name nulls first, patient_type, number_waiting) as row
        from latest, calls where {waits_sql('a_specialty', 'a_type', 'a_board')})
      select * from met where row <= {ROW_CAP}""",
)
@longs("row")
def fn_lateral_batch(spark, folder):
    """Nine calls answered in one scan of the table."""
    calls = spark.createDataFrame([(i, *c) for i, c in enumerate(CALLS)], "call int, specialty string, patient_type string, board string")
    out = lookups.waiting_times_batch(latest(spark, folder), calls, ALIASES, label=LABEL)
    return out.withColumn("month_ending", day("month_ending"))


@query("fn_scalar_sql", "select c_custkey, 'hello ' || c_name as greeting from customer")
def fn_scalar_sql(spark, folder):
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION greet(name STRING) RETURNS STRING COMMENT 'A greeting.' RETURN concat('hello ', name)")
    return table(spark, folder, "customer").select("c_custkey", F.expr("greet(c_name)").alias("greeting"))


@query("fn_scalar_python", "select c_custkey, 'hello ' || c_name as greeting from customer")
def fn_scalar_python(spark, folder):
    @F.pandas_udf("string")
    def greet_python(names: pd.Series) -> pd.Series:
        return "hello " + names

    spark.udf.register("greet_python", greet_python)
    return table(spark, folder, "customer").select("c_custkey", F.expr("greet_python(c_name)").alias("greeting"))


@query("srt_row_cap", f"select s_suppkey, s_name, s_acctbal from supplier order by s_acctbal, s_suppkey limit {ROW_CAP}")
def srt_row_cap(spark, folder):
    return top_rows(table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_acctbal"), ROW_CAP, "s_acctbal", "s_suppkey")
