"""Queries over traces. An event is one answered question: a trace with three spans (the agent, a
model call, a tool call) and tags, some of them missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import jsonops
from plumbline.operators import traces as tr
from plumbline.plans.base import instant, query, spread, table


def traces(spark: SparkSession, folder: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    start = F.col("event_id") * 1_000_000_000
    ms = F.floor(F.col("value") * 10)

    def span(name, begin, length, kind: str, code):
        attributes = F.concat(
            F.lit('{"k": '),
            F.col("k"),
            F.lit(f', "mlflow.spanType": "\\"{kind}\\"", "retried": '),
            F.when((F.col("k") > 80) & F.lit(kind == "TOOL"), "true").otherwise("false"),
            F.lit("}"),
        )
        return F.struct(
            name.alias("name"),
            begin.alias("start_time_unix_nano"),
            (begin + length * 1_000_000).alias("end_time_unix_nano"),
            F.struct(code.alias("code")).alias("status"),
            F.parse_json(attributes).alias("attributes"),
        )

    ok = F.lit("STATUS_CODE_OK")
    user = F.col("user_id")
    tags = F.create_map(
        F.lit("eval_run"), F.when(user % 7 != 0, F.concat(F.lit("run-"), user % 20)),
        F.lit("backend"), F.when(F.col("event_type") != "view", F.lit("direct")),
        F.lit("stopped"), F.when(F.col("event_type") == "error", "max_steps").when(F.col("event_type") == "signup", "urgent").otherwise("answer"),
        F.lit("guard"), F.when(F.col("event_type") == "signup", "emergency"),
        F.lit("case_id"), F.when(F.col("k") > 10, F.concat(F.lit("case-"), F.col("k"))),
        F.lit("category"), F.col("event_type"),
        F.lit("prompt_version"), F.when(F.col("k") % 3 > 0, (F.col("k") % 3).cast("string")),
        F.lit("prompt_hash"), F.when(F.col("k") % 3 > 0, F.left(F.sha2((F.col("k") % 3).cast("string"), 256), F.lit(12))),
    )
    spans = F.array(
        span(F.lit("agent"), start, ms, "AGENT", ok),
        span(F.lit("completions"), start, F.floor(ms / 2), "CHAT", ok),
        span(F.col("event_type"), start, F.floor(ms / 3), "TOOL", F.when(F.col("k") % 10 == 0, "STATUS_CODE_ERROR").otherwise(ok)),
    )
    return spread(table(spark, folder, "events"), "event_id").withColumn("k", k).select(
        F.col("event_id").cast("string").alias("trace_id"),
        F.col("ts").alias("request_time"),
        ms.alias("execution_duration_ms"),
        tr.clean_tags(tags).alias("tags"),
        spans.alias("spans"),
    )


TRACES = """base as (
    select event_id, ts, event_type, user_id, regexp_extract(props, '[0-9]+')::int as k, floor(value * 10)::bigint as ms from events),
  traces as (
    select *, case when user_id % 7 <> 0 then 'run-' || (user_id % 20) end as eval_run, case when event_type <> 'view' then 'direct' end as backend,
      case event_type when 'error' then 'max_steps' when 'signup' then 'urgent' else 'answer' end as stopped,
      case when event_type = 'signup' then 'emergency' end as guard, case when k > 10 then 'case-' || k end as case_id, event_type as category,
      case when k % 3 > 0 then (k % 3)::varchar end as prompt_version, case when k % 3 > 0 then left(sha256((k % 3)::varchar), 12) end as prompt_hash
    from base),
  spans as (
    select event_id, ts, eval_run, 'agent' as span, ms as span_ms, false as is_tool, false as is_error, false as is_retried, 'AGENT' as kind, k from traces
    union all select event_id, ts, eval_run, 'completions', ms // 2, false, false, false, 'CHAT', k from traces
    union all select event_id, ts, eval_run, event_type, ms // 3, true, k % 10 = 0, k > 80, 'TOOL', k from traces)"""
LAST = "strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f')"


def seconds_sql(c: str) -> str:
    return f"round(({c} / 1000)::decimal(18, 9), 2)::double"


RUNS_SQL = f"""select coalesce(eval_run, '(interactive)') as eval_run, coalesce(backend, '?') as backend, count(*) as traces,
      {seconds_sql('avg(ms)')} as mean_s, {seconds_sql('quantile_disc(ms, 0.5)')} as p50_s, {seconds_sql('quantile_disc(ms, 0.95)')} as p95_s,
      {LAST} as last_trace from traces"""


@query("trc_runs", f"with {TRACES} {RUNS_SQL} group by 1, 2 order by last_trace desc, 1, 2 limit 15")
def trc_runs(spark, folder):
    return tr.runs(traces(spark, folder)).withColumn("last_trace", instant("last_trace"))


@query("trc_runs_of_one", f"with {TRACES} {RUNS_SQL} where eval_run = 'run-3' group by 1, 2")
def trc_runs_of_one(spark, folder):
    return tr.runs(traces(spark, folder), "run-3").withColumn("last_trace", instant("last_trace"))


OUTCOME_SQL = """select coalesce(stopped, '?') as stopped, coalesce(guard, 'none') as guard, count(*) as traces,
      round(100 * count(*) / sum(count(*)) over (), 1) as pct from traces group by 1, 2"""


@query("trc_outcome", f"with {TRACES} {OUTCOME_SQL}")
def trc_outcome(spark, folder):
    return tr.outcome(traces(spark, folder))


@query("win_share_of_total", "select event_type, count(*) as traces, round(100 * count(*) / sum(count(*)) over (), 1) as pct from events group by event_type")
def win_share_of_total(spark, folder):
    from plumbline.operators.shape import share_of_total

    return share_of_total(table(spark, folder, "events"), F.col("event_type"))


@query(
    "trc_tools",
    f"""with {TRACES} select span as tool, count(*) as calls, round(avg(span_ms)) as mean_ms, round(quantile_disc(span_ms::double, 0.95)) as p95_ms,
      count(*) filter (where is_error) as errors, count(*) filter (where is_retried) as retried from spans where is_tool group by span""",
)
def trc_tools(spark, folder):
    return tr.tools(traces(spark, folder))


@query(
    "trc_time_split",
    f"""with {TRACES} select coalesce(eval_run, '(interactive)') as eval_run, count(*) filter (where not is_tool and span <> 'agent') as model_calls,
      round(avg(span_ms) filter (where not is_tool and span <> 'agent')) as model_mean_ms, count(*) filter (where is_tool) as tool_calls,
      round(avg(span_ms) filter (where is_tool)) as tool_mean_ms, {LAST} as last_trace from spans group by 1 order by last_trace desc, 1 limit 15""",
)
def trc_time_split(spark, folder):
    return tr.time_split(traces(spark, folder)).withColumn("last_trace", instant("last_trace"))


@query(
    "trc_slowest",
    f"""with {TRACES} select case_id, category, count(*) as runs, {seconds_sql('avg(ms)')} as mean_s, {seconds_sql('max(ms)')} as max_s
      from traces where case_id is not null group by 1, 2 order by mean_s desc, 1, 2 limit 10""",
)
def trc_slowest(spark, folder):
    return tr.slowest(traces(spark, folder))


@query(
    "trc_prompts",
    f"""with {TRACES} select coalesce(prompt_version, 'code') as prompt_version, coalesce(prompt_hash, '?') as prompt_hash, count(*) as traces,
      round(100 * avg(case when stopped = 'answer' then 1 else 0 end), 1) as answered_pct, {seconds_sql('avg(ms)')} as mean_s,
      strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') as first_seen, {LAST} as last_seen from traces group by 1, 2""",
)
def trc_prompts(spark, folder):
    return tr.prompts(traces(spark, folder)).withColumns({c: instant(c) for c in ("first_seen", "last_seen")})


@query(
    "trc_inspect",
    f"""with {TRACES} select span, count(*) as spans,
      min(left('{{"k":' || k || ',"mlflow.spanType":"\\"' || kind || '\\"","retried":' || is_retried || '}}', 250)) as sample_attributes
      from spans group by span order by spans desc, span limit 20""",
)
def trc_inspect(spark, folder):
    return tr.inspect(traces(spark, folder))


@query("jsn_attr_match", f"with {TRACES} select event_id::varchar as trace_id, span, is_tool, is_retried from spans")
def jsn_attr_match(spark, folder):
    rows = tr.spans(traces(spark, folder), F.col("trace_id"))
    return rows.select("trace_id", "span", "is_tool", "is_retried")


@query("map_clean_tags", f"""with {TRACES} select event_id::varchar as trace_id, 2 + (eval_run is not null)::int + (backend is not null)::int + (guard is not null)::int
      + (case_id is not null)::int + 2 * (prompt_version is not null)::int as tags, eval_run, guard from traces""")
def map_clean_tags(spark, folder):
    """Tags without a value are not kept."""
    return traces(spark, folder).select("trace_id", F.size("tags").alias("tags"), tr.tag("eval_run").alias("eval_run"), tr.tag("guard").alias("guard"))


@query("arr_explode_spans", f"with {TRACES} select event_id::varchar as trace_id, span, span_ms::double as ms, is_error from spans")
def arr_explode_spans(spark, folder):
    return tr.spans(traces(spark, folder), F.col("trace_id")).select("trace_id", "span", "ms", "is_error")


@query(
    "jsn_rows_to_structs",
    "select event_id, event_type as name, value::varchar as size from events union all select event_id, 'k', regexp_extract(props, '[0-9]+') from events",
)
def jsn_rows_to_structs(spark, folder):
    """A tool's `columns` and `rows` as arrays -> rows with fields."""
    output = F.concat(
        F.lit('{"columns": [{"name": "name"}, "size"], "rows": [["'), F.col("event_type"), F.lit('", "'), F.col("value").cast("string"),
        F.lit('"], ["k", "'), F.get_json_object("props", "$.k"), F.lit('"]]}'),
    )
    rows = jsonops.rows_as_objects(output, "name string, size string")
    return spread(table(spark, folder, "events"), "event_id").select("event_id", F.inline(rows))
