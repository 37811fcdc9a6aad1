"""Retrieval evaluation: labelled questions against rankings, for any number of configurations.

Rankings are (config, question_id, rank, doc_id, text); labels are (question_id, doc_id, evidence).
A ranking holds k rows per question, so all groups here are bounded by k.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import contains_evidence, normalise_evidence, token_count
from plumbline.operators.joins import join_sized, skew_safe_join
from plumbline.operators.shape import upper_median
from plumbline.session import pinned

KS = (1, 3, 5, 10)  # fixed value: cut-offs of recall
DEPTH = 5  # fixed value: ranks of document recall, of the shown documents and of context cost


def evidence_texts(labels: DataFrame, passages: DataFrame) -> DataFrame:
    """(doc_id, _uid, _text): the passages of labelled documents, each normalised once. Written once."""
    named = labels.select("doc_id").distinct()
    held = join_sized(passages.select("doc_id", "text"), named, "doc_id", spread=["text"])
    return pinned(held.select("doc_id", F.monotonically_increasing_id().alias("_uid"), normalise_evidence(F.col("text")).alias("_text")), "texts")


def _words(c: str) -> Column:
    return F.split(c, " ")


def evidence_places(labels: DataFrame, passages: DataFrame) -> DataFrame:
    """(doc_id, _norm, _uid): the distinct evidences of each document (normalised) with its passages that hold them.

    A substring of three words or more has its inner words whole in any text that holds it. The one that
    fewest passages of the document have is its anchor: evidences and passages meet by document and
    anchor, and only these pairs are tested. Evidence without an inner word meets all passages of its
    document. Equal evidences are one, and words and texts that very many rows share are met in several
    tasks.
    """
    texts = evidence_texts(labels, passages)
    normalised = labels.select("doc_id", normalise_evidence(F.col("evidence")).alias("_norm"))
    evidence = pinned(normalised.where("doc_id is not null and _norm is not null").distinct(), "evidence")
    size = F.size(_words("_norm"))
    inner = F.array_distinct(F.slice(_words("_norm"), F.lit(2), F.greatest(size - 2, F.lit(0))))
    key = F.xxhash64("doc_id", "_word").alias("_key")
    wanted = evidence.select("doc_id", "_norm", F.explode(inner).alias("_word")).select("*", key)
    words = texts.select("doc_id", "_uid", F.explode(F.array_distinct(_words("_text"))).alias("_word")).select("_uid", key)
    words = pinned(join_sized(words, wanted.select("_key").distinct(), "_key", spread=["_uid"]), "words")
    seen = words.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    rarest = F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_key"))
    anchors = wanted.join(seen, "_key", "left").groupBy("doc_id", "_norm").agg(rarest.alias("_rarest"))
    anchors = anchors.where("_rarest.n > 0").select("doc_id", "_norm", F.col("_rarest._key").alias("_key"))
    met = skew_safe_join(words, pinned(anchors, "anchors"), "_key", spread=["_uid"]).select("_uid", "_norm", F.col("doc_id").alias("_doc"))
    short = evidence.where(size <= 2).select("doc_id", "_norm")
    pairs = met.unionByName(skew_safe_join(texts.select("doc_id", "_uid"), short, "doc_id", spread=["_uid"]).select("_uid", "_norm", F.col("doc_id").alias("_doc")))
    tested = skew_safe_join(pairs, texts, "_uid", spread=["_norm"])
    holds = F.contains("_text", "_norm") & (F.col("doc_id") == F.col("_doc"))  # keys are hashes
    return tested.where(holds).select("doc_id", "_norm", "_uid")


def relevant_pairs(labels: DataFrame, passages: DataFrame) -> DataFrame:
    """Label x passage (`_uid`) of the labelled document whose text holds the evidence."""
    return _labelled(labels, evidence_places(labels, passages))


def _labelled(labels: DataFrame, found: DataFrame) -> DataFrame:
    """Labels with the rows found for their document and evidence. Equal labels that are very many are met in several tasks."""
    pair = F.xxhash64("doc_id", "_norm").alias("_pair")
    own = labels.withColumn("_norm", normalise_evidence(F.col("evidence"))).select("*", pair)
    found = found.select(pair, F.col("doc_id").alias("_doc"), F.col("_norm").alias("_found"), *[c for c in found.columns if c not in ("doc_id", "_norm")])
    met = skew_safe_join(own, found, "_pair", spread=["question_id"])
    return met.where((F.col("doc_id") == F.col("_doc")) & (F.col("_norm") == F.col("_found"))).drop("_pair", "_doc", "_found", "_norm")


def _questions_with_evidence(labels: DataFrame, passages: DataFrame) -> DataFrame:
    found = evidence_places(labels, passages).select("doc_id", "_norm").distinct()
    return _labelled(labels, found).select("question_id").distinct()


def answerable(questions: DataFrame, labels: DataFrame, passages: DataFrame) -> DataFrame:
    """Questions with evidence somewhere in the corpus."""
    found = _questions_with_evidence(labels, passages)
    return questions.join(found, questions["id"] == found["question_id"], "left_semi")


def unanswerable(questions: DataFrame, labels: DataFrame, passages: DataFrame) -> DataFrame:
    found = _questions_with_evidence(labels, passages)
    return questions.join(found, questions["id"] == found["question_id"], "left_anti")


def _verdicts(labels: DataFrame, passages: DataFrame) -> DataFrame:
    """(_q, _d, _holds): whether a text of the labelled document holds the evidence, once per question and document."""
    own = labels.select(F.col("question_id").alias("_q"), "doc_id", "evidence").where("doc_id is not null")
    met = join_sized(passages.select("doc_id", "text"), own, "doc_id", spread=["text"])
    judged = met.select("_q", F.col("doc_id").alias("_d"), contains_evidence(F.col("text"), F.col("evidence")).alias("_holds"))
    return judged.groupBy("_q", "_d").agg(F.bool_or("_holds").alias("_holds"))


def per_question(
    questions: DataFrame, labels: DataFrame, rankings: DataFrame, depth: int = DEPTH, configs: list[str] | None = None, passages: DataFrame | None = None
) -> DataFrame:
    """First relevant rank, document hit and top documents per configuration and question.

    Questions without any ranked row stay in, as misses. Name the configurations to spare the
    pass that looks for them. Name the `passages` (doc_id, text) and rankings need no text: a text meets the
    labels of its document once, not every ranked row, and rows of documents without a passage are no rows.
    """
    if passages is None:
        pair = labels.select(F.col("question_id").alias("_q"), F.col("doc_id").alias("_d"), "evidence")
        # texts of unlabelled documents, most of them, are not normalised at all
        holds = F.when(F.col("_d").isNotNull(), contains_evidence(F.col("text"), F.col("evidence"))).otherwise(F.lit(False))
    else:
        pair, holds = _verdicts(labels, passages), F.when(F.col("_d").isNotNull(), F.col("_holds")).otherwise(F.lit(False))
        rankings = rankings.join(passages.select("doc_id"), "doc_id", "left_semi")
    met = rankings.join(pair, (F.col("question_id") == F.col("_q")) & (F.col("doc_id") == F.col("_d")), "left")
    per_rank = met.groupBy("config", "question_id", "rank").agg(
        F.any_value("doc_id").alias("doc_id"),
        F.bool_or(F.col("_d").isNotNull()).alias("doc_match"),
        F.bool_or(holds).alias("relevant"),
    )
    # at most `depth` entries per question: later ranks are NULL and not collected
    shown = F.sort_array(F.collect_list(F.when(F.col("rank") <= depth, F.struct("rank", "doc_id"))))
    scored = per_rank.groupBy("config", "question_id").agg(
        F.min(F.when(F.col("relevant"), F.col("rank"))).alias("first_relevant_rank"),
        F.bool_or((F.col("rank") <= depth) & F.col("doc_match")).alias("doc_hit_at_5"),
        F.array_join(F.transform(shown, lambda x: x.getField("doc_id").cast("string")), ", ").alias("top_docs"),
    )
    wanted = questions.select(F.col("id").alias("question_id"), "kind", "question")
    # configurations are few: give every question one row for each of them
    if configs is None:
        named = rankings.agg(F.sort_array(F.collect_set("config"))).scalar()
    else:
        named = F.array(*[F.lit(c) for c in configs])
    grid = wanted.withColumn("config", F.explode(named))
    return (
        grid.join(scored, ["config", "question_id"], "left")
        .withColumn("doc_hit_at_5", F.coalesce("doc_hit_at_5", F.lit(False)))
        .withColumn("top_docs", F.coalesce("top_docs", F.lit("")))
    )


def _metrics(ks: tuple[int, ...]) -> list[Column]:
    rank = F.col("first_relevant_rank")

    def rate(hit: Column) -> Column:
        return F.avg(F.when(hit, 1.0).otherwise(0.0))

    return [
        *[rate(F.coalesce(rank <= k, F.lit(False))).alias(f"recall_at_{k}") for k in ks],
        F.avg(F.coalesce(1 / rank, F.lit(0.0))).alias("mrr"),
        rate(F.col("doc_hit_at_5")).alias("doc_recall_at_5"),
        F.count(F.lit(1)).alias("n_questions"),
    ]


def metrics(rows: DataFrame, ks: tuple[int, ...] = KS) -> DataFrame:
    """Recall@k, MRR and document recall per configuration."""
    return rows.groupBy("config").agg(*_metrics(ks))


def metrics_by_kind(rows: DataFrame, ks: tuple[int, ...] = KS) -> DataFrame:
    return rows.groupBy("config", "kind").agg(*_metrics(ks))


def metrics_long(rows: DataFrame, ks: tuple[int, ...] = KS) -> DataFrame:
    """(config, metric, value): overall names as they are, per-kind names prefixed by the kind.

    Both levels come from one aggregate over two grouping sets.
    """
    levels = rows.groupingSets([["config"], ["config", "kind"]], "config", "kind").agg(
        *_metrics(ks), F.grouping("kind").alias("_all")
    )
    names = [f"recall_at_{k}" for k in ks] + ["mrr", "doc_recall_at_5", "n_questions"]
    pairs = F.array(
        *[F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value")) for n in names]
    )
    long = levels.select("config", "kind", "_all", F.inline(pairs))
    name = F.when(F.col("_all") == 1, F.col("name")).otherwise(F.concat_ws("_", "kind", "name"))
    return long.select("config", name.alias("metric"), "value")


def context_cost(pool: DataFrame, rankings: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Per configuration: pool size, upper median of its tokens, mean tokens in the top rows.

    `pool` has (config, token_count). Rankings that carry a token_count, as stored passages do, need no text.
    """
    tokens = F.col("token_count") if "token_count" in rankings.columns else token_count(F.col("text"))
    sizes = pool.groupBy("config").agg(
        F.count(F.lit(1)).alias("n_chunks"), upper_median("token_count").alias("median_chunk_tokens")
    )
    read = (
        rankings.groupBy("config", "question_id")
        .agg(F.sum(F.when(F.col("rank") <= depth, tokens).otherwise(0)).alias("_tokens"))
        .groupBy("config")
        .agg(F.avg("_tokens").alias("mean_tokens_top5"))
    )
    return sizes.join(read, "config", "left")
