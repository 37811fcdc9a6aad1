import random
import re

import pytest

from plumbline.operators import joins, relevance
from plumbline.session import scratch_path
from plumbline.sources import files, tables

QUESTIONS = (
    '{"id": "q1", "question": "How long?", "relevant": [{"doc_id": "d1", "evidence": "6  MONTHS"}, {"doc_id": "d2", "evidence": "half a year"}]}\n'
    '{"id": "q2", "question": "Which form?", "kind": "exact", "relevant": [{"doc_id": "d3", "evidence": "HC2"}]}\n'
)


@pytest.fixture(scope="module")
def setup(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("q") / "questions.jsonl"
    path.write_text(QUESTIONS)
    questions = files.load_questions(spark, str(path))
    return questions, files.label_table(questions)


def ranks(spark, rows):
    return spark.createDataFrame(rows, "config string, question_id string, rank int, doc_id string, text string")


def test_sets_have_defaults(setup):
    questions, labels = setup
    assert {r["id"]: r["kind"] for r in questions.collect()} == {"q1": "paraphrase", "q2": "exact"}
    assert labels.count() == 3


def test_rank_two_and_a_miss(spark, setup):
    questions, labels = setup
    rows = relevance.per_question(questions, labels, ranks(spark, [
        ("a", "q1", 1, "d9", "within 6 months"),  # right words, wrong document
        ("a", "q1", 2, "d1", "Normally within **6 months**."),
        ("a", "q1", 3, "d2", "half a year"),
        ("a", "q2", 1, "d3", "another form"),
    ]))
    m = relevance.metrics(rows).first()
    assert (m["recall_at_1"], m["recall_at_3"], m["mrr"], m["doc_recall_at_5"], m["n_questions"]) == (0.0, 0.5, 0.25, 1.0, 2)
    by_id = {r["question_id"]: r for r in rows.collect()}
    assert by_id["q1"]["first_relevant_rank"] == 2 and by_id["q2"]["first_relevant_rank"] is None
    assert by_id["q1"]["top_docs"] == "d9, d1, d2"


def test_kinds_and_configs_are_apart(spark, setup):
    questions, labels = setup
    rows = relevance.per_question(questions, labels, ranks(spark, [
        ("a", "q1", 1, "d1", "6 months"), ("a", "q2", 2, "d3", "hc2 form"), ("a", "q2", 1, "d1", "x"), ("b", "q1", 1, "d1", "6 months"),
    ]))
    kinds = {(r["config"], r["kind"]): r["mrr"] for r in relevance.metrics_by_kind(rows).collect()}
    assert kinds == {("a", "paraphrase"): 1.0, ("a", "exact"): 0.5, ("b", "paraphrase"): 1.0, ("b", "exact"): 0.0}
    long = {(r["config"], r["metric"]): r["value"] for r in relevance.metrics_long(rows).collect()}
    assert long[("a", "mrr")] == 0.75 and long[("a", "exact_mrr")] == 0.5 and long[("b", "n_questions")] == 2.0
    recalls = [long[("a", f"recall_at_{k}")] for k in relevance.KS]
    assert recalls == sorted(recalls)


def test_rankings_without_texts(spark, setup):
    """Texts met by label give what texts in every ranked row give; a document without a passage has no row."""
    questions, labels = setup
    texts = [("d9", "within 6 months"), ("d1", "Normally within **6 months**."), ("d1", "x"), ("d2", None), ("d3", "the HC2 form"), (None, "y")]
    passages = spark.createDataFrame(texts, "doc_id string, text string")
    ids = [("a", "q1", 1, "d9"), ("a", "q1", 2, "d1"), ("a", "q1", 3, "d2"), ("a", "q2", 1, "gone"), ("a", "q2", 2, "d3"), ("b", "q2", 6, "d3"), ("b", None, 1, "d1")]
    ranked = spark.createDataFrame(ids, "config string, question_id string, rank int, doc_id string")
    labels = labels.unionByName(labels).unionByName(spark.createDataFrame([("q2", None, "HC2")], labels.schema))
    with_texts = relevance.per_question(questions, labels, ranked.join(passages, "doc_id"), depth=5, configs=["a", "b"])
    without = relevance.per_question(questions, labels, ranked, depth=5, configs=["a", "b"], passages=passages)
    columns = ["config", "question_id", "first_relevant_rank", "doc_hit_at_5"]
    found = sorted(without.select(columns).collect(), key=str)
    assert found == sorted(with_texts.select(columns).collect(), key=str) and found[0]["first_relevant_rank"] == 2


def test_answerable(spark, setup):
    questions, labels = setup
    passages = spark.createDataFrame([("d2", "about half a  year"), ("d3", "no code")], "doc_id string, text string")
    assert [r["id"] for r in relevance.answerable(questions, labels, passages).collect()] == ["q1"]
    assert [r["id"] for r in relevance.unanswerable(questions, labels, passages).collect()] == ["q2"]


def test_context_cost(spark):
    pool = spark.createDataFrame([("a", n) for n in (1, 2, 3, 4)], "config string, token_count int")
    ranked = ranks(spark, [("a", "q1", i, "d", "one two three four five") for i in range(1, 8)])
    row = relevance.context_cost(pool, ranked).first()
    assert (row["n_chunks"], row["median_chunk_tokens"], row["mean_tokens_top5"]) == (4, 3, 30.0)
    counted = ranked.selectExpr("config", "question_id", "rank", "6 as token_count")
    assert relevance.context_cost(pool, counted).first() == row


def test_runs_are_logged(spark, setup):
    questions, labels = setup
    layout = tables.Layout(scratch_path(spark, "base"))
    rows = relevance.per_question(questions, labels, ranks(spark, [("a", "q1", 1, "d1", "6 months")]))
    for run, k in (("index-ann", 5), ("index-auto", 10)):
        tables.log_run(layout, run, {"k": k, "experiment": "index"}, relevance.metrics(rows), rows)
    runs = {r["run"]: r for r in tables.read(spark, layout.path("ops_eval_runs")).collect()}
    assert runs["index-ann"]["params"] == {"k": "5", "experiment": "index"} and runs["index-auto"]["mrr"] == 0.5
    assert tables.read(spark, layout.path("ops_eval_rows")).count() == 4


def test_evidence_is_found_by_its_rarest_word(spark, monkeypatch):
    rnd = random.Random(7)
    words = ["a", "an", "the", "of", "Hund", "katze", "x-y", "’s", "*bold*", "12", "Größe", "end."]
    passages = [(f"d{rnd.randrange(6)}", " ".join(rnd.choices(words, k=rnd.randint(0, 12)))) for _ in range(120)]
    passages += [("d1", passages[0][1])] * 40 + [("d2", None), (None, "a an the"), ("d9", "the of")]
    labels = []
    for i in range(200):
        text = rnd.choice(passages)[1] or ""
        start = rnd.randint(0, len(text))
        labels.append((f"q{i % 90}", f"d{rnd.randrange(8)}", text[start : start + rnd.randint(0, 14)].swapcase()))
    labels += [("q1", "d1", None), ("q2", None, "the"), ("q3", "d1", "a " * 30), ("q4", "d9", "THE   of")] + [("q5", "d3", "the of a")] * 30
    def norm(t):
        t = t.replace("*", "").replace("’", "'")
        return re.sub(r"\s+", " ", t).strip(" ").lower()
    expected = sorted((q, d, e, t) for q, d, e in labels for pd, t in passages if d and d == pd and e is not None and t is not None and norm(e) in norm(t))
    label_df = spark.createDataFrame(labels, "question_id string, doc_id string, evidence string")
    passage_df = spark.createDataFrame(passages, "doc_id string, text string").repartition(3)
    found = relevance.relevant_pairs(label_df, passage_df)
    assert found.count() == len(expected)
    assert sorted({(r["question_id"], r["doc_id"], r["evidence"]) for r in found.collect()}) == sorted({e[:3] for e in expected})
    questions = spark.createDataFrame([(f"q{i}",) for i in range(95)], "id string")
    held = {e[0] for e in expected}
    monkeypatch.setattr(joins, "TASK_ROWS", 5)  # hot words, texts and labels
    assert {r["id"] for r in relevance.answerable(questions, label_df, passage_df).collect()} == held
    assert {r["id"] for r in relevance.unanswerable(questions, label_df, passage_df).collect()} == {f"q{i}" for i in range(95)} - held
