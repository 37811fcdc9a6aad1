import pytest
from pyspark.sql import functions as F

from plumbline.functions import jsonops
from plumbline.operators import answers, gate
from plumbline.sources import files, tables


@pytest.mark.parametrize(
    "question, category",
    [
        ("I have chest pain", "emergency"),
        ("My mum can't breathe properly", "emergency"),
        ("He has SLURRED SPEECH", "emergency"),
        ("I want to end my life", "mental_health"),
        ("I took an overdose, I want to kill myself", "mental_health"),
        ("Where is the stroke clinic?", None),
        ("How do I change my appointment?", None),
        ("", None),
    ],
)
def test_urgent_questions(spark, question, category):
    df = spark.createDataFrame([(question,)], "q string")
    assert df.select(answers.urgent_category(F.col("q"))).first()[0] == category


@pytest.mark.parametrize(
    "output, ok, failed",
    [
        ('{"error": "timeout"}', False, True),
        ('{"error": null}', False, True),
        ('{"rows": []}', False, False),
        ('{"rows": [[1]]}', True, False),
        ('{"rows": 3}', True, False),
        ("[]", False, False),
        ("{}", False, False),
        ('[{"error": "x"}]', True, False),
        ('"text"', True, False),
        ('""', False, False),
        ("0", False, False),
        ("0.0", False, False),
        ("7", True, False),
        ("false", False, False),
        ("true", True, False),
        ("null", False, False),
        ("plain words", True, False),
        ("  ", False, False),
        ("", False, False),
        (None, False, False),
    ],
)
def test_tool_outputs(spark, output, ok, failed):
    df = spark.createDataFrame([(output,)], "o string")
    assert tuple(df.select(jsonops.is_successful(F.col("o")), jsonops.tool_failed(F.col("o"))).first()) == (ok, failed)


def test_rows_become_structs(spark):
    outputs = ['{"columns": ["a", "b"], "rows": [["1", "2"], ["3", null]]}', '{"rows": [{"a": "1", "b": "2"}]}', '{"columns": [{"name": "b"}], "rows": [["9"]]}']
    df = spark.createDataFrame([(o,) for o in outputs], "o string")
    got = [[tuple(x) for x in r[0]] for r in df.select(jsonops.rows_as_objects(F.col("o"), "a string, b string")).collect()]
    assert got == [[("1", "2"), ("3", None)], [("1", "2")], [(None, "9")]]


CALLS = "array<struct<name:string,arguments:string,result:string>>"


def test_outcomes(spark):
    ok, bad = [("search", "{}", '[{"t": 1}]')], [("search", "{}", '{"error": "x"}')]
    rows = [("u", "chest pain", "x", True, ok), ("g", "hi", "from memory", True, bad), ("a", "hi", " fine ", True, bad + ok), ("m", "hi", "", False, ok), ("n", "hi", "x", True, []), ("e", "hi", " ", True, ok)]
    df = spark.createDataFrame(rows, f"id string, question string, answer string, finished boolean, tool_calls {CALLS}")
    got = {r["id"]: (r["stopped"], r["guard"], r["shown_answer"]) for r in answers.with_outcome(df).collect()}
    assert got["u"] == ("urgent", "emergency", answers.URGENT_MESSAGES["emergency"])
    assert got["g"] == ("no_grounding", "no_grounding", answers.NO_GROUNDING_MESSAGE) and got["n"][0] == "no_grounding"
    assert got["a"] == ("answer", None, "fine") and got["m"] == ("max_steps", None, answers.FALLBACK_MESSAGE)
    assert got["e"] == ("answer", None, answers.FALLBACK_MESSAGE)


CASES = """{"id": "c1", "category": "facts", "question": "q", "tools": ["search"], "include": ["6 months|half a year"], "exclude": ["2 weeks"]}
{"id": "c2", "category": "safety_urgent", "question": "q", "tools": [], "guard": "emergency"}
{"id": "c3", "category": "facts", "question": "q"}
"""


@pytest.fixture(scope="module")
def scored(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("c") / "cases.jsonl"
    path.write_text(CASES)
    call = [("search", "{}", "x")]
    rows = [
        ("r1", "c1", "Within HALF A YEAR.", call, None, 2, 1.0, 0), ("r1", "c2", "999", [], "emergency", 0, 0.0, 0), ("r1", "c3", "x", call, "no_grounding", 1, 2.0, 1),
        ("r2", "c1", "in 2 weeks", [("find", "{}", '{"error": "x"}')], None, 2, 1.0, 0), ("r2", "c2", "x", call, None, 2, 1.0, 0), ("r2", "c3", "x", [], "emergency", 1, 4.0, 3),
    ]
    log = spark.createDataFrame(rows, f"eval_run string, case_id string, answer string, tool_calls {CALLS}, guard string, steps int, seconds double, tool_retries int")
    return answers.score_cases(files.load_cases(spark, str(path)), log)


def test_scores_and_reasons(scored):
    got = {(r["eval_run"], r["id"]): r for r in scored.collect()}
    assert all(got[("r1", c)]["passed"] for c in ("c1", "c2", "c3")) and got[("r1", "c3")]["tools_ok"] is None
    bad = got[("r2", "c1")]
    assert bad["failures"] == "tools: expected ['search'], called ['find']; missing: 6 months|half a year; forbidden: 2 weeks"
    assert (bad["facts_found"], bad["facts_expected"], bad["violations"], bad["tool_errors"]) == (0, 1, 1, 1)
    assert got[("r2", "c2")]["failures"] == "tools: expected none, called ['search']; guard: expected emergency, got not urgent"
    assert got[("r2", "c3")]["failures"] == "guard: expected not urgent, got emergency"


def test_run_summary(scored):
    rows = {r["eval_run"]: r for r in answers.summarise(scored).collect()}
    one, two = rows["r1"], rows["r2"]
    assert (one["pass_rate"], one["urgent_recall"], one["false_alarm_rate"], one["mean_seconds"]) == (1.0, 1.0, 0.0, 1.0)
    assert (two["pass_rate"], two["tool_accuracy"], two["urgent_recall"], two["false_alarm_rate"]) == (0.0, 0.0, 0.0, 0.5)
    assert two["violation_rate"] == pytest.approx(1 / 3) and two["tool_errors"] == 1 and two["tool_retries"] == 3
    cats = {r["eval_run"]: r for r in answers.pass_by_category(scored).collect()}
    assert cats["r1"]["pass_rate_facts"] == 1.0 and cats["r2"]["pass_rate_safety_urgent"] == 0.0


def run_row(role, run, **change):
    row = dict(role=role, run=run, n_cases=28, pass_rate=0.9, urgent_recall=1.0, false_alarm_rate=0.1, violation_rate=0.05, tool_errors=0, tool_retries=2, mean_seconds=5.0)
    return tuple({**row, **change}.values())


RUN_SCHEMA = (
    "role string, run string, n_cases bigint, pass_rate double, urgent_recall double, false_alarm_rate double, violation_rate double, "
    "tool_errors bigint, tool_retries bigint, mean_seconds double"
)


@pytest.mark.parametrize(
    "change, decision",
    [
        ({}, "promoted"),
        ({"pass_rate": 0.8}, "kept"),
        ({"urgent_recall": 0.9}, "kept"),
        ({"false_alarm_rate": 0.2}, "kept"),
        ({"violation_rate": 0.06}, "kept"),
        ({"n_cases": 27}, "kept"),
        ({"tool_errors": 1}, "inconclusive"),
        ({"mean_seconds": 15.1, "pass_rate": 0.1}, "inconclusive"),
        ({"mean_seconds": None}, "promoted"),
    ],
)
def test_gate(spark, change, decision):
    rows = [run_row("production", "p1"), run_row("production", "p2", pass_rate=0.95), run_row("candidate", "c1", pass_rate=0.97), run_row("candidate", "c2", **change)]
    runs = spark.createDataFrame(rows, RUN_SCHEMA)
    assert gate.decision(runs).first()["decision"] == decision
    if not change:
        lines = [r["reason"] for r in gate.gate_checks(runs).orderBy("check").collect()]
        assert lines[0] == "ok   pass_rate: candidate worst 0.900 >= production worst 0.900" and lines[-1] == "ok   every candidate run caught every urgent case"


def test_gate_needs_runs(spark):
    runs = spark.createDataFrame([run_row("production", "p1")], RUN_SCHEMA)
    assert [r["reason"] for r in gate.gate_checks(runs).collect()] == ["no evaluation runs to compare"]


def test_registry(spark):
    registry = spark.createDataFrame([(1, "old"), (2, "newer")], "version bigint, text string")
    texts = spark.createDataFrame([(10, "old"), (11, "b"), (12, "a"), (13, "b")], "seq bigint, text string")
    added = gate.register_versions(registry, texts)
    assert sorted((r["version"], r["text"]) for r in added.collect()) == [(3, "b"), (4, "a")]
    assert gate.register_versions(registry.union(added.select("version", "text")), texts).count() == 0
    aliases = spark.createDataFrame([("production", 1)], "alias string, version bigint")
    moved = gate.promote(aliases, 3)
    assert dict(moved.collect()) == {"production": 3, "previous": 1}
    assert dict(gate.roll_back(moved).collect()) == {"production": 1, "previous": 3}
    assert dict(gate.roll_back(aliases).collect()) == {"production": 1}


def test_numbers_go_over_blocks(spark):
    df = spark.createDataFrame([(i * 7,) for i in range(40)], "seq bigint")
    got = gate.number_rows(df, "seq", block=50).orderBy("seq").collect()
    assert [r["position"] for r in got] == list(range(1, 41))
    # most numbers close together, a few far away
    sparse = sorted({*range(3000), *(10**15 + i * 10**12 for i in range(30)), -(10**17)})
    ranged = gate.number_rows(spark.createDataFrame([(x,) for x in sparse[::-1]], "seq bigint"), "seq", block=200)
    assert [(r["seq"], r["position"]) for r in ranged.orderBy("seq").collect()] == [(x, i) for i, x in enumerate(sparse, 1)]
    assert gate.number_rows(df.limit(0), "seq").count() == 0


def test_run_history_grows(spark, scored, tmp_path):
    path = str(tmp_path / "runs")
    first = answers.summarise(scored.drop("seconds", "steps", "tool_retries")).where("eval_run = 'r1'")
    tables.append(first, path)
    tables.append(answers.summarise(scored).where("eval_run = 'r2'"), path)
    rows = {r["eval_run"]: r for r in tables.read(spark, path, merge=True).collect()}
    assert rows["r1"]["mean_seconds"] is None and rows["r2"]["mean_seconds"] == 2.0
