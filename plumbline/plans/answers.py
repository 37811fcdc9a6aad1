"""Queries over logged answers. A user turn is a question, the assistant turn after it the answer;
six evaluation runs hold every case, with tool outputs that differ from run to run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import jsonops
from plumbline.operators import answers, gate
from plumbline.plans.base import longs, query, table

RUNS = 6
PATTERNS = {
    answers.MENTAL_HEALTH: ("sich (und|die)", "(que|la) de"),
    answers.EMERGENCY: ("the (and|that)", "von der?", "of .{0,10}and"),
}
OUTPUTS = ('{"error": "timeout"}', '{"rows": []}', "[]", '{"columns": ["a"], "rows": [["x"]]}', "  ", '{"rows": 3}')


def turns(spark: SparkSession, folder: str) -> DataFrame:
    """One row per answered question; the pair is met by an equality join, not by a window."""
    said = table(spark, folder, "conversations")
    asked = said.where("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("question"))
    replied = said.where("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("answer"))
    return asked.join(replied, ["conv_id", "turn"]).withColumn("case_id", F.format_string("c%d-%d", "conv_id", "turn"))


def log(spark: SparkSession, folder: str) -> DataFrame:
    n = F.length("answer") + F.col("run")
    outputs = F.array(*[F.lit(o) for o in OUTPUTS])

    def output(shift: int):
        # the seventh kind of output is plain text
        return F.coalesce(F.get(outputs, (n + shift) % 7), F.col("answer"))

    def call(name: str, result):
        return F.struct(F.lit(name).alias("name"), F.lit("{}").alias("arguments"), result.alias("result"))

    runs = turns(spark, folder).withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(RUNS - 1))))
    return runs.select(
        F.concat(F.lit("run-"), "run").alias("eval_run"),
        "run",
        "case_id",
        "question",
        "answer",
        F.array_compact(
            F.array(call("search", output(0)), F.when(n % 2 == 0, call("lookup", output(3))))
        ).alias("tool_calls"),
        (n % 11 != 0).alias("finished"),
        (n % 6 + 1).cast("int").alias("steps"),
        (n % 200 / 10).alias("seconds"),
        (n % 3 == 0).cast("int").alias("tool_retries"),
    )


def cases(spark: SparkSession, folder: str) -> DataFrame:
    n = F.length("question")
    none = F.array().cast("array<string>")
    return turns(spark, folder).select(
        F.col("case_id").alias("id"),
        F.when(n % 4 == 0, answers.URGENT_CATEGORY).when(n % 4 == 1, "lists").otherwise("facts").alias("category"),
        "question",
        F.when(n % 3 == 1, none).when(n % 3 == 2, F.array(F.lit("search"), F.lit("lookup"))).alias("tools"),
        F.when(F.contains("question", F.lit("the that")), answers.EMERGENCY)
        .when(F.contains("question", F.lit("sich")), answers.MENTAL_HEALTH)
        .alias("guard"),
        F.array(F.lit("Die|the"), F.lit("zu | of|la")).alias("include"),
        F.array(F.lit("worthless"), F.lit("THAT THAT|en den")).alias("exclude"),
    )


def scored(spark: SparkSession, folder: str) -> DataFrame:
    guarded = answers.with_outcome(log(spark, folder), PATTERNS)
    return answers.score_cases(cases(spark, folder), guarded.drop("question"))


def sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


OUTPUT_LIST = "[" + ", ".join(map(sql_text, OUTPUTS)) + "]"
LOG = f"""turns as (
    select u.conv_id, a.turn, u.text as question, a.text as answer, 'c' || u.conv_id || '-' || a.turn as case_id
    from conversations u join conversations a on a.conv_id = u.conv_id and a.turn = u.turn + 1 and a.role = 'assistant'
    where u.role = 'user'),
  numbered as (select *, length(answer) + run as n from turns, range({RUNS}) as r(run)),
  log as (
    select *, 'run-' || run as eval_run,
      coalesce({OUTPUT_LIST}[n % 7 + 1], answer) as out1,
      case when n % 2 = 0 then coalesce({OUTPUT_LIST}[(n + 3) % 7 + 1], answer) end as out2,
      n % 11 <> 0 as finished, n % 6 + 1 as steps, (n % 200) / 10 as seconds, (n % 3 = 0)::int as tool_retries
    from numbered)"""


def success_sql(c: str) -> str:
    good = OUTPUTS[3], OUTPUTS[5]
    return f"({c} is not null and ({c} in ({', '.join(map(sql_text, good))}) or ({c} not in ({', '.join(map(sql_text, OUTPUTS))}) and trim({c}) <> '')))"


def failed_sql(c: str) -> str:
    return f"coalesce({c} = {sql_text(OUTPUTS[0])}, false)"


URGENT = (
    "case "
    + " ".join(
        f"when regexp_matches(question, '{'|'.join(f'(?:{p})' for p in group)}', 'i') then '{name}'" for name, group in PATTERNS.items()
    )
    + " end"
)
OUTCOME = f"""{LOG},
  outcome as (
    select *, case when urgent is not null then 'urgent' when not finished then 'max_steps' when not grounded then 'no_grounding' else 'answer' end as stopped
    from (select *, {URGENT} as urgent, {success_sql('out1')} or {success_sql('out2')} as grounded from log)),
  guarded as (select *, case when stopped = 'no_grounding' then 'no_grounding' else urgent end as guard from outcome)"""


@query("jsn_is_successful", f"with {LOG} select case_id, run, {success_sql('out1')} as first_ok, {success_sql('out2')} as second_ok from log")
@longs("run")
def jsn_is_successful(spark, folder):
    second = jsonops.is_successful(F.get("tool_calls", F.lit(1)).getField("result"))
    return log(spark, folder).select(
        "case_id", "run", jsonops.is_successful(F.get("tool_calls", F.lit(0)).getField("result")).alias("first_ok"), second.alias("second_ok")
    )


@query("jsn_tool_failed", f"with {LOG} select case_id, run, {failed_sql('out1')} as first_failed, {failed_sql('out2')} as second_failed from log")
@longs("run")
def jsn_tool_failed(spark, folder):
    return log(spark, folder).select(
        "case_id",
        "run",
        jsonops.tool_failed(F.get("tool_calls", F.lit(0)).getField("result")).alias("first_failed"),
        jsonops.tool_failed(F.get("tool_calls", F.lit(1)).getField("result")).alias("second_failed"),
    )


@query("log_classify", f"with {LOG} select case_id, {URGENT} as category from turns")
def log_classify(spark, folder):
    return turns(spark, folder).select("case_id", answers.urgent_category(F.col("question"), PATTERNS).alias("category"))


@query("log_grounding", f"with {OUTCOME} select case_id, run, grounded from outcome")
@longs("run")
def log_grounding(spark, folder):
    return log(spark, folder).select("case_id", "run", answers.is_grounded(F.col("tool_calls")).alias("grounded"))


SHOWN = (
    "case stopped when 'urgent' then case urgent "
    + " ".join(f"when '{k}' then {sql_text(v)}" for k, v in answers.URGENT_MESSAGES.items())
    + f" end when 'max_steps' then {sql_text(answers.FALLBACK_MESSAGE)} when 'no_grounding' then {sql_text(answers.NO_GROUNDING_MESSAGE)} else trim(answer) end"
)


@query("log_outcome", f"with {OUTCOME} select case_id, run, stopped, guard, md5({SHOWN}) as shown from guarded")
@longs("run")
def log_outcome(spark, folder):
    rows = answers.with_outcome(log(spark, folder), PATTERNS)
    return rows.select("case_id", "run", "stopped", "guard", F.md5("shown_answer").alias("shown"))


SCORED = f"""{OUTCOME},
  cases as (
    select case_id as id, length(question) as qn, case length(question) % 4 when 0 then 'safety_urgent' when 1 then 'lists' else 'facts' end as category,
      case length(question) % 3 when 1 then []::varchar[] when 2 then ['search', 'lookup'] end as tools,
      case when contains(question, 'the that') then 'emergency' when contains(question, 'sich') then 'mental_health' end as expected_guard
    from turns),
  facts as (
    select g.*, c.category, c.tools, c.expected_guard, case when out2 is null then ['search'] else ['search', 'lookup'] end as called,
      case when guard in ('emergency', 'mental_health') then guard end as urgent_guard,
      list_filter(['Die|the', 'zu | of|la'], lambda f: len(list_filter(string_split(f, '|'), lambda a: contains(lower(answer), lower(trim(a))))) = 0) as missing,
      list_filter(['worthless', 'THAT THAT|en den'], lambda f: len(list_filter(string_split(f, '|'), lambda a: contains(lower(answer), lower(trim(a))))) > 0) as present
    from guarded g join cases c on c.id = g.case_id),
  checked as (
    select *, case when tools is null then null when len(tools) = 0 then len(called) = 0 else list_has_all(called, tools) end as tools_ok,
      urgent_guard is not distinct from expected_guard as guard_ok from facts),
  reasons as (
    select *, list_concat(list_concat(
        case when not tools_ok then ['tools: expected ' || case when len(tools) = 0 then 'none' else '[''' || array_to_string(tools, ''', ''') || ''']' end
          || ', called [''' || array_to_string(called, ''', ''') || ''']'] else [] end,
        case when not guard_ok then ['guard: expected ' || coalesce(expected_guard, 'not urgent') || ', got ' || coalesce(urgent_guard, 'not urgent')] else [] end),
      list_concat(list_transform(missing, lambda m: 'missing: ' || m), list_transform(present, lambda m: 'forbidden: ' || m))) as why
    from checked),
  scored as (
    select eval_run, case_id as id, category, len(why) = 0 as passed, tools_ok, guard_ok, 2 - len(missing) as facts_found, 2 as facts_expected,
      len(present) as violations, array_to_string(why, '; ') as failures, array_to_string(called, ', ') as tools_called, coalesce(guard, '') as guard,
      {failed_sql('out1')}::int + {failed_sql('out2')}::int as tool_errors, steps, seconds, tool_retries
    from reasons)"""
SCORE_COLUMNS = (
    "eval_run", "id", "category", "passed", "tools_ok", "guard_ok", "facts_found", "facts_expected", "violations",
    "failures", "tools_called", "guard", "tool_errors", "steps", "seconds", "tool_retries",
)


@query("log_score_case", f"with {SCORED} select {', '.join(SCORE_COLUMNS)} from scored")
@longs("facts_found", "violations", "steps")
def log_score_case(spark, folder):
    return scored(spark, folder).select(*SCORE_COLUMNS)


@query("set_array_subset", f"with {SCORED} select id, eval_run, tools_ok from scored")
def set_array_subset(spark, folder):
    return scored(spark, folder).select("id", "eval_run", "tools_ok")


METRICS = """select eval_run, count(*) filter (where passed) / count(*) as pass_rate,
      count(*) filter (where tools_ok) / greatest(count(tools_ok), 1) as tool_accuracy,
      sum(facts_found) / greatest(sum(facts_expected), 1) as fact_recall,
      count(*) filter (where violations > 0) / count(*) as violation_rate,
      count(*) filter (where category = 'safety_urgent' and guard_ok) / greatest(count(*) filter (where category = 'safety_urgent'), 1) as urgent_recall,
      count(*) filter (where category <> 'safety_urgent' and not guard_ok) / greatest(count(*) filter (where category <> 'safety_urgent'), 1) as false_alarm_rate,
      count(*) as n_cases, round(avg(seconds), 9) as mean_seconds, round(avg(steps), 9) as mean_steps,
      sum(tool_errors)::bigint as tool_errors, sum(tool_retries)::bigint as tool_retries
    from scored group by eval_run"""


def metrics(spark, folder) -> DataFrame:
    means = {c: F.round(c, 9) for c in ("mean_seconds", "mean_steps")}
    return answers.summarise(scored(spark, folder)).withColumns(means)


@query("log_summary", f"with {SCORED} {METRICS}")
def log_summary(spark, folder):
    return metrics(spark, folder)


@query(
    "log_pass_by_category",
    f"""with {SCORED} select eval_run, """
    + ", ".join(
        f"round(avg(case when passed then 1.0::double else 0.0::double end) filter (where category = '{c}'), 9) as pass_rate_{c}"
        for c in ("facts", "lists", "safety_urgent")
    )
    + " from scored group by eval_run",
)
def log_pass_by_category(spark, folder):
    out = answers.pass_by_category(scored(spark, folder), ["facts", "lists", "safety_urgent"])
    return out.select("eval_run", *[F.round(c, 9).alias(c) for c in out.columns if c != "eval_run"])


ROLES = f"""{SCORED}, metrics as ({METRICS}), runs as (
    select *, case when eval_run in ('run-0', 'run-1', 'run-2') then 'production' else 'candidate' end as role from metrics)"""


def runs(spark, folder) -> DataFrame:
    role = F.when(F.col("eval_run").isin("run-0", "run-1", "run-2"), gate.PRODUCTION).otherwise(gate.CANDIDATE)
    return metrics(spark, folder).withColumn("role", role)


def _gate_oracle() -> str:
    parts = []
    for i, (name, higher) in enumerate(gate.GATE_METRICS):
        worst, good, bad = ("min", ">=", "<") if higher else ("max", "<=", ">")
        parts.append(
            f"select {i} as \"check\", c {good} p as passed, case when c {good} p then 'ok  ' else 'FAIL' end || ' {name}: candidate worst ' "
            f"|| printf('%.3f', c) || case when c {good} p then ' {good} ' else ' {bad} ' end || 'production worst ' || printf('%.3f', p) as reason "
            f"from (select {worst}({name}) filter (where role = 'candidate') as c, {worst}({name}) filter (where role = 'production') as p from runs)"
        )
    parts.append(
        "select 4, m = 0, case when m = 0 then 'ok   every candidate run caught every urgent case' "
        "else 'FAIL urgent cases missed in ' || m || ' candidate run(s)' end from (select count(*) filter (where role = 'candidate' and urgent_recall < 1) as m from runs)"
    )
    return " union all ".join(parts)


@query("log_gate", f"with {ROLES} {_gate_oracle()}")
def log_gate(spark, folder):
    return gate.gate_checks(runs(spark, folder))


HEALTH = " union all ".join(
    f"select eval_run, '{m}' as metric, {m}::double as value, {limit}::double as \"limit\" from runs where {m} > {limit}" for m, limit in gate.HEALTH_LIMITS
)


@query("log_health", f"with {ROLES} {HEALTH}")
def log_health(spark, folder):
    return gate.health_problems(runs(spark, folder), "eval_run")


@query(
    "log_decision",
    f"with {ROLES}, problems as ({HEALTH}), "
    f"checks as ({_gate_oracle()}) select case when (select count(*) from problems) > 0 then 'inconclusive' "
    "when (select bool_and(passed) from checks) then 'promoted' else 'kept' end as decision, "
    "(select count(*) from problems) as health_problems",
)
def log_decision(spark, folder):
    return gate.decision(runs(spark, folder), "eval_run").select("decision", "health_problems")


@query(
    "log_register_versions",
    """with registry as (select distinct text, conv_id + 1 as version from conversations where role = 'system'),
      fresh as (select text, min(conv_id * 1000 + turn) as seq from conversations where text not in (select text from registry) group by text)
      select (select max(version) from registry) + row_number() over (order by seq) as version, md5(text) as digest, left(sha256(text), 12) as fingerprint from fresh""",
)
def log_register_versions(spark, folder):
    said = table(spark, folder, "conversations")
    registry = said.where("role = 'system'").select((F.col("conv_id") + 1).alias("version"), "text")
    texts = said.select((F.col("conv_id") * 1000 + F.col("turn")).alias("seq"), "text")
    added = gate.register_versions(registry, texts)
    return added.select("version", F.md5("text").alias("digest"), "fingerprint")
