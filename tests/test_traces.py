import datetime as dt

import pytest
from pyspark.sql import functions as F

from plumbline.operators import traces as tr


def span(name, kind, ms, retried="false", code="OK"):
    return (name, 0, ms * 1_000_000, (code,), f'{{"mlflow.spanType": "\\"{kind}\\"", "retried": {retried}}}')


def trace(i, ms, tags, spans):
    return (str(i), dt.datetime(2026, 10, 17, 10, i), ms, tags, spans)


@pytest.fixture(scope="module")
def table(spark):
    rows = [
        trace(1, 4000, {"eval_run": "r1", "backend": "mcp", "stopped": "answer", "case_id": "a01", "category": "facts", "prompt_version": "2", "prompt_hash": "h"},
              [span("agent", "AGENT", 4000), span("completions", "CHAT", 1000), span("search", "TOOL", 500, "true")]),
        trace(2, 6000, {"eval_run": "r1", "backend": "mcp", "stopped": "urgent", "guard": "emergency", "case_id": "a01", "category": "facts", "prompt_version": "2", "prompt_hash": "h"},
              [span("agent", "AGENT", 6000), span("search", "TOOL", 1500, code="STATUS_CODE_ERROR")]),
        trace(3, 2000, {"stopped": "answer"}, [span("agent", "AGENT", 2000), span("completions", "CHAT", 3000)]),
    ]
    schema = tr.TRACE_SCHEMA.replace("attributes:variant", "attributes:string")
    df = spark.createDataFrame(rows, schema)
    parsed = F.transform("spans", lambda s: s.withField("attributes", F.parse_json(s.getField("attributes"))))
    return df.withColumn("spans", parsed)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_runs(table):
    got = rows(tr.runs(table).drop("last_trace"))
    assert got == [("(interactive)", "?", 1, 2.0, 2.0, 2.0), ("r1", "mcp", 2, 5.0, 4.0, 6.0)]
    assert len(rows(tr.runs(table, "r1"))) == 1 and rows(tr.runs(table, "none")) == []


def test_outcome(table):
    assert rows(tr.outcome(table)) == [("answer", "none", 2, 66.7), ("urgent", "emergency", 1, 33.3)]


def test_tools_and_time(table):
    assert rows(tr.tools(table)) == [("search", 2, 1000.0, 1500.0, 1, 1)]
    assert rows(tr.time_split(table).drop("last_trace")) == [("(interactive)", 1, 3000.0, 0, None), ("r1", 1, 1000.0, 2, 1000.0)]


def test_slowest_prompts_inspect(table):
    assert rows(tr.slowest(table)) == [("a01", "facts", 2, 5.0, 6.0)]
    prompts = rows(tr.prompts(table).drop("first_seen", "last_seen"))
    assert prompts == [("code", "?", 1, 100.0, 2.0), ("2", "h", 2, 50.0, 5.0)]
    assert [r[:2] for r in rows(tr.inspect(table))] == [("agent", 3), ("completions", 2), ("search", 2)]


def test_tags_without_value_go(spark):
    df = spark.createDataFrame([({"a": 1, "b": None},)], "t map<string,int>")
    assert df.select(tr.clean_tags(F.col("t"))).first()[0] == {"a": "1"}
