"""Queries of the statistics track. Orders stand for the monthly file: every raw column is text
derived from an order, with the defects the rules look for."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import quality, waits
from plumbline.operators.shape import only_ids, top_rows
from plumbline.plans.base import day, query, spread, table
from plumbline.session import pinned, scratch_path
from plumbline.sources import files
from plumbline.sources.tables import conform

TODAY = dt.date(2001, 3, 31)


def raw_waits(spark: SparkSession, folder: str, ordered: bool = False) -> DataFrame:
    """The raw columns; `ordered` by `_id`, in which case orders are sorted, and their texts are made once."""
    orders = table(spark, folder, "orders")
    if ordered:
        read = ("o_orderkey", "o_orderdate", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
        orders = orders.select(*read).orderBy("o_orderkey")
    else:
        orders = spread(orders, "o_orderkey")
    return orders.selectExpr(
        "o_orderkey as _id",
        "date_format(last_day(o_orderdate), if(o_custkey % 53 = 0, 'yyyy-MM-dd', 'yyyyMMdd')) as MonthEnding",
        "case when o_custkey % 27 = 0 then 'S92000003' when o_custkey % 101 = 0 then '' "
        "else concat('N', o_custkey % 27) end as HBT",
        "'' as HBTQF",
        "case o_orderstatus when 'F' then 'New Outpatient' when 'O' then 'Inpatient/Day case' else 'Other' end as PatientType",
        "left(o_orderpriority, 1) as Specialty",
        "if(o_orderpriority like '5%', 'D', '') as SpecialtyQF",
        "case when o_custkey % 19 = 0 then '' when o_custkey % 89 = 0 then concat('-', floor(o_totalprice)) "
        "else concat(floor(o_totalprice / 100), if(o_custkey % 37 = 0, '.5', '')) end as NumberWaiting",
        "if(o_custkey % 19 = 0, ':', '') as NumberWaitingQF",
        "cast(floor(o_totalprice * (o_custkey % 13) / 1190) as string) as NumberWaitingOver12Weeks",
        "'' as NumberWaitingOver12WeeksQF",
        "concat(floor(o_totalprice) % 200, '.5') as Median",
        "'' as MedianQF",
        "if(o_custkey % 31 = 0, 'n/a', cast(o_custkey % 250 as string)) as `90thPercentile`",
        "'' as `90thPercentileQF`",
    )


RAW = """raw as (
  select o_orderkey as _id,
    case when o_custkey % 53 = 0 then strftime(last_day(o_orderdate), '%Y-%m-%d')
         else strftime(last_day(o_orderdate), '%Y%m%d') end as month_text,
    case when o_custkey % 27 = 0 then 'S92000003' when o_custkey % 101 = 0 then ''
         else 'N' || (o_custkey % 27) end as hbt,
    case o_orderstatus when 'F' then 'New Outpatient' when 'O' then 'Inpatient/Day case' else 'Other' end as patient_type,
    substr(o_orderpriority, 1, 1) as specialty,
    case when o_orderpriority like '5%' then 'D' else '' end as specialty_qf,
    case when o_custkey % 19 = 0 then '' when o_custkey % 89 = 0 then '-' || floor(o_totalprice)::bigint
         else floor(o_totalprice / 100)::bigint || case when o_custkey % 37 = 0 then '.5' else '' end end as waiting_text,
    floor(o_totalprice * (o_custkey % 13) / 1190)::bigint::varchar as over_text,
    (floor(o_totalprice)::bigint % 200) || '.5' as median_text,
    case when o_custkey % 31 = 0 then 'n/a' else (o_custkey % 250)::varchar end as p90_text
  from orders)"""
NUM = r"'^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$'"
LOOKUPS = """sources as (
    select 'N' || n_nationkey as code, n_name as name, 0 as prio from nation
    union all select 'N' || r_regionkey, r_name, 1 from region
    union all select 'S92000003', 'Scotland', 2),
  boards as (select code, arg_max(name, prio) as name from sources group by code),
  specs as (select distinct substr(o_orderpriority, 1, 1) as code, substr(o_orderpriority, 3) as name
            from orders where o_orderpriority not like '4%')"""
SILVER = f"""{RAW}, {LOOKUPS},
  typed as (
    select _id,
      case when regexp_full_match(month_text, '[0-9]{{8}}') then try_strptime(month_text, '%Y%m%d')::date end as month_ending,
      hbt, patient_type, specialty, specialty_qf,
      case when regexp_matches(waiting_text, {NUM}) then try_cast(trim(waiting_text) as double) end as number_waiting,
      case when regexp_matches(over_text, {NUM}) then try_cast(trim(over_text) as double) end as waiting_over_12_weeks,
      case when regexp_matches(median_text, {NUM}) then try_cast(trim(median_text) as double) end as median_wait_days,
      case when regexp_matches(p90_text, {NUM}) then try_cast(trim(p90_text) as double) end as p90_wait_days
    from raw),
  silver as (
    select t.*, b.name as board_name, s.name as specialty_name, t.hbt = 'S92000003' as is_scotland,
      (lower(specialty_qf) = 'd' or specialty = 'Z9') as is_all_specialties,
      case when number_waiting > 0 then waiting_over_12_weeks / number_waiting end as share_over_12_weeks
    from typed t left join boards b on t.hbt = b.code left join specs s on t.specialty = s.code)"""
RULES = {
    "valid_month": ("drop", "month_ending is not null"),
    "month_not_in_future": ("drop", f"coalesce(month_ending <= date '{TODAY}', true)"),
    "board_present": ("drop", "length(hbt) > 0"),
    "non_negative_counts": (
        "drop",
        "coalesce(number_waiting >= 0, true) and coalesce(waiting_over_12_weeks >= 0, true)",
    ),
    "over_12_weeks_within_total": ("drop", "coalesce(waiting_over_12_weeks <= number_waiting, true)"),
    "median_not_above_p90": ("warn", "coalesce(median_wait_days <= p90_wait_days, true)"),
    "count_present": ("warn", "number_waiting is not null"),
    "known_board": ("warn", "board_name is not null"),
    "known_specialty": ("warn", "(specialty_name is not null or specialty = '' or is_all_specialties)"),
}
REASONS = "concat_ws(';', " + ", ".join(
    f"case when not ({check}) then '{name}' end" for name, (severity, check) in RULES.items() if severity == "drop"
) + ")"
JUDGED = f"""{SILVER},
  reasoned as (select *, {REASONS} as reasons from silver),
  judged as (
    select * exclude (reasons),
      case when reasons = '' and row_number() over (
        partition by reasons = '', month_ending, hbt, patient_type, specialty order by _id desc) > 1
        then 'unique_key' else reasons end as failed_expectations
    from reasoned),
  kept as (select * from judged where failed_expectations = '')"""


def lookups(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    nation = table(spark, folder, "nation").selectExpr("concat('N', n_nationkey) as code", "n_name as name")
    region = table(spark, folder, "region").selectExpr("concat('N', r_regionkey) as code", "r_name as name")
    boards = waits.merge_lookups(
        (nation, "code", "name"), (region, "code", "name"), constants={waits.NATIONAL: waits.NATIONAL_NAME}
    )
    specialties = (
        table(spark, folder, "orders")
        .where("o_orderpriority not like '4%'")
        .selectExpr("left(o_orderpriority, 1) as code", "substr(o_orderpriority, 3) as name")
        .distinct()
    )
    return boards, waits.merge_lookups((specialties, "code", "name"))


def silver_waits(spark: SparkSession, folder: str) -> DataFrame:
    boards, specialties = lookups(spark, folder)
    return waits.to_silver(raw_waits(spark, folder), boards, specialties)


def judged_waits(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(silver_waits(spark, folder), quality.waits_rules(TODAY))


def kept_waits(spark: SparkSession, folder: str) -> DataFrame:
    return quality.kept(judged_waits(spark, folder))


@query(
    "prj_rename",
    f"with {RAW} select _id, month_text as month_ending, hbt, patient_type, waiting_text as number_waiting from raw",
)
def prj_rename(spark, folder):
    renamed = waits.rename(raw_waits(spark, folder), waits.RAW_COLUMNS, keep=("_id",))
    return renamed.select("_id", "month_ending", "hbt", "patient_type", "number_waiting")


@query(
    "prj_date_coerce",
    f"with {SILVER} select _id, strftime(month_ending, '%Y-%m-%d') as month_ending from silver",
)
def prj_date_coerce(spark, folder):
    return raw_waits(spark, folder).select("_id", day(waits.to_date(F.col("MonthEnding"))).alias("month_ending"))


@query("prj_number_coerce", f"with {SILVER} select _id, number_waiting, waiting_over_12_weeks, median_wait_days, p90_wait_days from silver")
def prj_number_coerce(spark, folder):
    raw = raw_waits(spark, folder)
    return raw.select(
        "_id",
        waits.to_number(F.col("NumberWaiting")).alias("number_waiting"),
        waits.to_number(F.col("NumberWaitingOver12Weeks")).alias("waiting_over_12_weeks"),
        waits.to_number(F.col("Median")).alias("median_wait_days"),
        waits.to_number(F.col("90thPercentile")).alias("p90_wait_days"),
    )


@query("prj_flags", f"with {SILVER} select _id, is_scotland, is_all_specialties from silver")
def prj_flags(spark, folder):
    return silver_waits(spark, folder).select("_id", "is_scotland", "is_all_specialties")


@query("prj_guarded_ratio", f"with {SILVER} select _id, share_over_12_weeks from silver")
def prj_guarded_ratio(spark, folder):
    return silver_waits(spark, folder).select("_id", "share_over_12_weeks")


@query("jon_lookup_left", f"with {SILVER} select _id, hbt, board_name, specialty, specialty_name from silver")
def jon_lookup_left(spark, folder):
    return silver_waits(spark, folder).select("_id", "hbt", "board_name", "specialty", "specialty_name")


@query("jon_lookup_precedence", f"with {LOOKUPS} select code, name from boards")
def jon_lookup_precedence(spark, folder):
    return lookups(spark, folder)[0]


@query(
    "flt_latest_month",
    f"""with {JUDGED} select strftime(month_ending, '%Y-%m-%d') as month_ending, board_name, hbt as board_code,
      is_scotland, patient_type, specialty as specialty_code, specialty_name, is_all_specialties,
      trunc(number_waiting)::int as number_waiting, trunc(waiting_over_12_weeks)::int as waiting_over_12_weeks,
      round(100 * share_over_12_weeks, 1) as pct_over_12_weeks, median_wait_days, p90_wait_days
    from kept where month_ending = (select max(month_ending) from kept)
      and board_name is not null and number_waiting is not null""",
)
def flt_latest_month(spark, folder):
    # two scans, of the newest month and of its rows: what they read is judged once
    return waits.latest_waits(pinned(kept_waits(spark, folder), "kept")).withColumn("month_ending", day("month_ending"))


RESULT_ROWS = " union all ".join(
    f"select '{name}' as expectation, '{severity}' as severity, "
    f"count(*) filter (where not ({check})) as failed_rows, count(*) as total_rows from silver"
    for name, (severity, check) in RULES.items()
)
UNIQUE_ROW = """select 'unique_key' as expectation, 'drop' as severity,
    count(*) filter (where failed_expectations = 'unique_key') as failed_rows, count(*) as total_rows from judged"""
FRESH_ROW = f"""select 'fresh_data' as expectation, 'warn' as severity,
    case when date '{TODAY}' - max(month_ending) <= 120 then 0 else 1 end::bigint as failed_rows, 1::bigint as total_rows,
    'latest month ' || max(month_ending) || ', ' || (date '{TODAY}' - max(month_ending)) || ' days old' as detail from kept"""


@query(
    "dq_results",
    f"""with {JUDGED}, counted as ({RESULT_ROWS} union all {UNIQUE_ROW}),
    fresh as ({FRESH_ROW})
    select expectation, severity, failed_rows, total_rows, 1 - failed_rows / total_rows as pass_rate, '' as detail from counted
    union all select expectation, severity, failed_rows, total_rows, (1 - failed_rows)::double, detail from fresh""",
)
def dq_results(spark, folder):
    return quality.results(silver_waits(spark, folder), quality.waits_rules(TODAY), today=TODAY)


@query(
    "dq_unique_key",
    f"with {JUDGED} select expectation, severity, failed_rows, total_rows, 1 - failed_rows / total_rows as pass_rate from ({UNIQUE_ROW})",
)
def dq_unique_key(spark, folder):
    return quality.unique_key_result(silver_waits(spark, folder), quality.waits_rules(TODAY))


@query(
    "dq_freshness",
    f"with {JUDGED} select expectation, severity, failed_rows, total_rows, (1 - failed_rows)::double as pass_rate, detail from ({FRESH_ROW})",
)
def dq_freshness(spark, folder):
    return quality.freshness(kept_waits(spark, folder), TODAY)


@query("dq_reasons", f"with {SILVER} select _id, {REASONS} as failed_expectations from silver")
def dq_reasons(spark, folder):
    rules = quality.waits_rules(TODAY)
    return quality.with_reasons(silver_waits(spark, folder), rules).select("_id", quality.REASONS)


KEPT_COLUMNS = ("_id", "hbt", "patient_type", "specialty", "number_waiting", "waiting_over_12_weeks", "board_name")


@query(
    "dq_kept",
    f"with {JUDGED} select strftime(month_ending, '%Y-%m-%d') as month_ending, {', '.join(KEPT_COLUMNS)} from kept",
)
def dq_kept(spark, folder):
    return kept_waits(spark, folder).select(day("month_ending").alias("month_ending"), *KEPT_COLUMNS)


@query(
    "dq_rejects",
    f"with {JUDGED} select {', '.join(KEPT_COLUMNS)}, failed_expectations from judged where failed_expectations <> ''",
)
def dq_rejects(spark, folder):
    return quality.rejects(judged_waits(spark, folder)).select(*KEPT_COLUMNS, quality.REASONS)


@query(
    "win_keep_last",
    """with ordered as (select *, row_number() over (partition by l_orderkey, l_linenumber
         order by l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc, l_shipdate desc) as rn from lineitem)
       select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice from ordered where rn = 1""",
)
def win_keep_last(spark, folder):
    order = F.struct("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    rows = table(spark, folder, "lineitem").withColumn("position", order)
    last = quality.keep_last(rows, ("l_orderkey", "l_linenumber"), "position")
    return last.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query(
    "win_file_order",
    """select o_custkey, o_orderpriority, max(o_orderkey)::varchar as last_order from orders group by all""",
)
def win_file_order(spark, folder):
    """The last row per key of raw files, by its place in them: the publisher's number is missing or equal."""
    rows = table(spark, folder, "orders").orderBy("o_orderkey").selectExpr(
        "if(o_orderkey % 3 = 0, '', '7') as _id", "o_custkey", "o_orderpriority", "o_orderkey as last_order"
    )
    path = scratch_path(spark, "orders-csv")
    rows.write.csv(path, header=True)
    last = quality.keep_last(files.read_text_csv(spark, path), ("o_custkey", "o_orderpriority"), files.PLACE)
    return last.select(F.col("o_custkey").cast("bigint").alias("o_custkey"), "o_orderpriority", "last_order")


CODES = "select {0} as code, count(*) as n from kept where {1} group by {0} order by n desc, code limit 5"


@query(
    "agg_load_report",
    f"""with {JUDGED}, b as ({CODES.format('hbt', 'board_name is null')}), s as ({CODES.format('specialty', 'specialty_name is null and not is_all_specialties')}),
      t as (select patient_type as code, count(*) as n from kept where number_waiting is null group by 1)
      select (select count(*) from silver) as raw_rows, count(*) as silver_rows, (select count(*) from silver) - count(*) as rejected_rows,
        strftime(min(month_ending), '%Y-%m') || ' to ' || strftime(max(month_ending), '%Y-%m') as months,
        count(distinct hbt) as boards, count(distinct specialty) as specialties,
        string_agg(distinct patient_type, ',' order by patient_type) as patient_types,
        count(*) filter (where is_scotland and is_all_specialties) as scotland_all_specialty_rows,
        coalesce((select string_agg(code || '=' || n, ',' order by n desc, code) from b), '') as unknown_boards,
        coalesce((select string_agg(code || '=' || n, ',' order by n desc, code) from s), '') as unknown_specialties,
        coalesce((select string_agg(code || '=' || n, ',' order by code) from t), '') as blank_counts from kept""",
)
def agg_load_report(spark, folder):
    report = waits.load_report(judged_waits(spark, folder))
    text = lambda c: F.array_join(F.transform(c, lambda e: F.concat(e["code"], F.lit("="), e["rows"])), ",")
    lists = {c: text(F.col(c)) for c in ("unknown_boards", "unknown_specialties", "blank_counts")}
    return report.withColumns({**lists, "patient_types": F.array_join("patient_types", ",")})


@query(
    "agg_run_summary",
    f"""with {JUDGED} select count(*) as silver_rows,
      strftime(min(month_ending), '%Y-%m') || ' to ' || strftime(max(month_ending), '%Y-%m') as months,
      count(distinct hbt) as boards, count(distinct specialty) as specialties,
      string_agg(distinct patient_type, ',' order by patient_type) as patient_types,
      count(*) filter (where is_scotland and is_all_specialties) as scotland_all_specialty_rows from kept""",
)
def agg_run_summary(spark, folder):
    return waits.run_summary(kept_waits(spark, folder))


@query(
    "agg_top_codes",
    f"""with {JUDGED},
      b as (select 'board' as lookup, hbt as code, count(*) as "rows" from kept where board_name is null
            group by hbt order by "rows" desc, code limit 5),
      s as (select 'specialty' as lookup, specialty as code, count(*) as "rows" from kept
            where specialty_name is null and not is_all_specialties group by specialty order by "rows" desc, code limit 5)
      select * from b union all select * from s""",
)
def agg_top_codes(spark, folder):
    kept = kept_waits(spark, folder)
    boards = waits.unknown_boards(kept).select(F.lit("board").alias("lookup"), F.col("hbt").alias("code"), "rows")
    return boards.unionByName(
        waits.unknown_specialties(kept).select(F.lit("specialty").alias("lookup"), F.col("specialty").alias("code"), "rows")
    )


@query(
    "agg_missing_by_group",
    f"""with {JUDGED} select patient_type, count(*) as "rows" from kept where number_waiting is null group by patient_type""",
)
def agg_missing_by_group(spark, folder):
    return waits.blank_counts(kept_waits(spark, folder))


@query(
    "agg_count_max",
    f"""with {JUDGED} select count(*) as n, strftime(max(month_ending), '%Y-%m-%d') as month from kept
      where month_ending = (select max(month_ending) from kept) and board_name is not null and number_waiting is not null""",
)
def agg_count_max(spark, folder):
    latest = waits.latest_waits(kept_waits(spark, folder))
    return latest.agg(F.count(F.lit(1)).alias("n"), day(F.max("month_ending")).alias("month"))


@query(
    "flt_id_subset",
    "select doc_id, source, n_chars from documents where doc_id in (select doc_id from labels)",
)
def flt_id_subset(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source", "n_chars")
    return only_ids(docs, table(spark, folder, "labels"), "doc_id")


@query(
    "snk_conform_schema",
    f"""with {RAW} select case when regexp_full_match(month_text, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
         then month_text end as month_ending, _id::int as _id, null::varchar as note,
         try_cast(p90_text as double)::bigint as p90 from raw""",
)
def snk_conform_schema(spark, folder):
    from pyspark.sql import types as T

    raw = raw_waits(spark, folder).select(
        F.col("MonthEnding").alias("month_ending"),
        F.coalesce(F.col("90thPercentile").try_cast("double"), F.lit(float("nan"))).alias("p90"),
        "_id",
    )
    schema = T._parse_datatype_string("month_ending date, _id int, note string, p90 bigint")
    return conform(raw, schema).withColumn("month_ending", day("month_ending"))


@query(
    "srt_topn",
    """select o_orderkey, o_custkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 15""",
)
def srt_topn(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return top_rows(orders, 15, F.desc("o_totalprice"), "o_orderkey")


@query(
    "mth_rounding",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, round((100 * l_discount / (l_tax + 1))::decimal(18, 9), 1)::double as pct,
         round(l_quantity / 7, 1) as weeks, round((l_extendedprice / 1000)::decimal(18, 9), 2)::double as seconds, (l_partkey * 1000) / 1e6 as ms
       from lineitem""",
)
def mth_rounding(spark, folder):
    c = F.col
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        F.round(100 * c("l_discount") / (c("l_tax") + 1), 1).alias("pct"),
        F.round(c("l_quantity") / 7, 1).alias("weeks"),
        F.round(c("l_extendedprice") / 1000, 2).alias("seconds"),
        ((c("l_partkey") * 1000) / 1e6).alias("ms"),
    )
