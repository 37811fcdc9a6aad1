"""Reports over trace tables with nested spans. All take an optional evaluation run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.jsonops import attribute_matches
from plumbline.operators.shape import share_of_total, top_rows

# Patterns found in the JSON text of span attributes, and row limits.
TOOL_KEY, TOOL_VALUE = "mlflow[.]spanType", "TOOL"
RETRIED_KEY, RETRIED_VALUE = "retried", "true"
RUN_ROWS, SLOWEST_ROWS, INSPECT_ROWS = 15, 10, 20
ROOT_SPAN = "agent"
ACCURACY = 100_000  # of percentiles: ranks are off by at most 1 / ACCURACY of the rows

TRACE_SCHEMA = (
    "trace_id string, request_time timestamp, execution_duration_ms bigint, tags map<string,string>, "
    "spans array<struct<name:string,start_time_unix_nano:bigint,end_time_unix_nano:bigint,"
    "status:struct<code:string>,attributes:variant>>"
)


def clean_tags(tags: Column) -> Column:
    """Tags as text; tags without a value are left out."""
    as_text = F.transform_values(tags, lambda k, v: v.cast("string"))
    return F.map_filter(as_text, lambda k, v: v.isNotNull())


def tag(name: str, default: str | None = None) -> Column:
    value = F.try_element_at("tags", F.lit(name))
    return value if default is None else F.coalesce(value, F.lit(default))


def of_run(traces: DataFrame, eval_run: str | None) -> DataFrame:
    return traces if eval_run is None else traces.where(tag("eval_run") == F.lit(eval_run))


def seconds(c: Column) -> Column:
    return F.round(c / 1000, 2)


def spans(traces: DataFrame, *keep: Column) -> DataFrame:
    """One row per span with its length and what its attributes say it is.

    Only names, times, status and the two tests leave the row, not the attributes.
    """
    exploded = traces.select(*keep, F.explode("spans").alias("s"))
    return exploded.select(
        *[c for c in exploded.columns if c != "s"],
        F.col("s.name").alias("span"),
        ((F.col("s.end_time_unix_nano") - F.col("s.start_time_unix_nano")) / 1e6).alias("ms"),
        F.coalesce(F.contains("s.status.code", F.lit("ERROR")), F.lit(False)).alias("is_error"),
        attribute_matches(F.col("s.attributes"), TOOL_KEY, TOOL_VALUE).alias("is_tool"),
        attribute_matches(F.col("s.attributes"), RETRIED_KEY, RETRIED_VALUE).alias("is_retried"),
    )


def runs(traces: DataFrame, eval_run: str | None = None) -> DataFrame:
    ms = F.col("execution_duration_ms")
    out = (
        of_run(traces, eval_run)
        .groupBy(tag("eval_run", "(interactive)").alias("eval_run"), tag("backend", "?").alias("backend"))
        .agg(
            F.count(F.lit(1)).alias("traces"),
            seconds(F.avg(ms)).alias("mean_s"),
            seconds(F.percentile_approx(ms, 0.5, ACCURACY)).alias("p50_s"),
            seconds(F.percentile_approx(ms, 0.95, ACCURACY)).alias("p95_s"),
            F.max("request_time").alias("last_trace"),
        )
    )
    return top_rows(out, RUN_ROWS, F.desc("last_trace"), "eval_run", "backend")


def outcome(traces: DataFrame, eval_run: str | None = None) -> DataFrame:
    return share_of_total(
        of_run(traces, eval_run), tag("stopped", "?").alias("stopped"), tag("guard", "none").alias("guard")
    ).orderBy(F.desc("traces"), "stopped", "guard")


def tools(traces: DataFrame, eval_run: str | None = None) -> DataFrame:
    return (
        spans(of_run(traces, eval_run))
        .where("is_tool")
        .groupBy(F.col("span").alias("tool"))
        .agg(
            F.count(F.lit(1)).alias("calls"),
            F.round(F.avg("ms")).alias("mean_ms"),
            F.round(F.percentile_approx("ms", 0.95, ACCURACY)).alias("p95_ms"),
            F.count_if("is_error").alias("errors"),
            F.count_if("is_retried").alias("retried"),
        )
        .orderBy(F.desc("calls"), "tool")
    )


def time_split(traces: DataFrame, eval_run: str | None = None, root: str = ROOT_SPAN) -> DataFrame:
    """Per run: model calls and tool calls with their mean time. The root span is neither."""
    is_model = ~F.col("is_tool") & (F.col("span") != root)
    out = (
        spans(of_run(traces, eval_run), tag("eval_run", "(interactive)").alias("eval_run"), F.col("request_time"))
        .groupBy("eval_run")
        .agg(
            F.count_if(is_model).alias("model_calls"),
            F.round(F.avg(F.when(is_model, F.col("ms")))).alias("model_mean_ms"),
            F.count_if("is_tool").alias("tool_calls"),
            F.round(F.avg(F.when(F.col("is_tool"), F.col("ms")))).alias("tool_mean_ms"),
            F.max("request_time").alias("last_trace"),
        )
    )
    return top_rows(out, RUN_ROWS, F.desc("last_trace"), "eval_run")


def slowest(traces: DataFrame, eval_run: str | None = None) -> DataFrame:
    ms = F.col("execution_duration_ms")
    out = (
        of_run(traces, eval_run)
        .where(tag("case_id").isNotNull())
        .groupBy(tag("case_id").alias("case_id"), tag("category").alias("category"))
        .agg(F.count(F.lit(1)).alias("runs"), seconds(F.avg(ms)).alias("mean_s"), seconds(F.max(ms)).alias("max_s"))
    )
    return top_rows(out, SLOWEST_ROWS, F.desc("mean_s"), "case_id", "category")


def prompts(traces: DataFrame, eval_run: str | None = None) -> DataFrame:
    answered = F.when(tag("stopped") == "answer", 1).otherwise(0)
    return (
        of_run(traces, eval_run)
        .groupBy(tag("prompt_version", "code").alias("prompt_version"), tag("prompt_hash", "?").alias("prompt_hash"))
        .agg(
            F.count(F.lit(1)).alias("traces"),
            F.round(100 * F.avg(answered), 1).alias("answered_pct"),
            seconds(F.avg("execution_duration_ms")).alias("mean_s"),
            F.min("request_time").alias("first_seen"),
            F.max("request_time").alias("last_seen"),
        )
        .orderBy(F.desc("last_seen"), "prompt_version", "prompt_hash")
    )


def inspect(traces: DataFrame, eval_run: str | None = None) -> DataFrame:
    """Span names with counts and a sample of their attributes (the lowest text, not any)."""
    out = (
        of_run(traces, eval_run)
        .select(F.explode("spans").alias("s"))
        .groupBy(F.col("s.name").alias("span"))
        .agg(
            F.count(F.lit(1)).alias("spans"),
            F.min(F.left(F.to_json("s.attributes"), F.lit(250))).alias("sample_attributes"),
        )
    )
    return top_rows(out, INSPECT_ROWS, F.desc("spans"), "span")


REPORTS = {
    "runs": runs,
    "outcome": outcome,
    "tools": tools,
    "time_split": time_split,
    "slowest": slowest,
    "prompts": prompts,
    "inspect": inspect,
}
