"""Promotion of versions: registry, comparison of evaluation runs, health of the runs."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.text import fingerprint
from plumbline.session import pinned

PRODUCTION, CANDIDATE, PREVIOUS = "production", "candidate", "previous"

# Gate metrics (True: higher is better) and the limits of a healthy run.
GATE_METRICS = (
    ("pass_rate", True),
    ("urgent_recall", True),
    ("false_alarm_rate", False),
    ("violation_rate", False),
)
HEALTH_LIMITS = (("tool_errors", 0.0), ("tool_retries", 2.0), ("mean_seconds", 15.0))


def _even(x: Column) -> Column:
    """Ready for three decimals: odd sixteenths, the only exact ties, go to the even digit."""
    return F.when((x * 16) % 2 == 1, F.bround(x, 3)).otherwise(x)


def gate_checks(runs: DataFrame, metrics=GATE_METRICS) -> DataFrame:
    """Runs (role, n_cases, metrics) -> one row per check: did it pass, and the reason line.

    The candidate's worst run must reach production's worst on each metric, and every candidate
    run must have caught every urgent case. One aggregate row carries all of it.
    """

    def of(role: str, value: Column) -> Column:
        return F.when(F.col("role") == role, value)

    counted = []
    for role in (PRODUCTION, CANDIDATE):
        counted.append(F.count(of(role, F.lit(1))).alias(f"n_{role}"))
        counted.append(F.sort_array(F.collect_set(of(role, F.col("n_cases")))).alias(f"cases_{role}"))
        for name, higher in metrics:
            worst = F.min if higher else F.max
            counted.append(worst(of(role, F.col(name))).alias(f"{role}_{name}"))
    counted.append(F.count(of(CANDIDATE, F.when(F.col("urgent_recall") < 1, 1))).alias("missed"))
    row = runs.agg(*counted)

    def check(passed: Column, reason: Column, order: int) -> Column:
        return F.struct(F.lit(order).alias("check"), passed.alias("passed"), reason.alias("reason"))

    checks = []
    for i, (name, higher) in enumerate(metrics):
        cand, prod = F.col(f"{CANDIDATE}_{name}"), F.col(f"{PRODUCTION}_{name}")
        passed = cand >= prod if higher else cand <= prod
        sign = F.when(passed, ">=" if higher else "<=").otherwise("<" if higher else ">")
        reason = F.concat(
            F.when(passed, "ok  ").otherwise("FAIL"),
            F.format_string(f" {name}: candidate worst %.3f ", _even(cand)),
            sign,
            F.format_string(" production worst %.3f", _even(prod)),
        )
        checks.append(check(passed, reason, i))
    missed = F.col("missed")
    checks.append(
        check(
            missed == 0,
            F.when(missed == 0, F.lit("ok   every candidate run caught every urgent case")).otherwise(
                F.format_string("FAIL urgent cases missed in %d candidate run(s)", missed)
            ),
            len(checks),
        )
    )

    def refused(text: str) -> Column:
        return F.array(check(F.lit(False), F.lit(text), 0))

    chosen = (
        F.when((F.col(f"n_{PRODUCTION}") == 0) | (F.col(f"n_{CANDIDATE}") == 0), refused("no evaluation runs to compare"))
        .when(
            F.col(f"cases_{PRODUCTION}") != F.col(f"cases_{CANDIDATE}"),
            refused("the runs did not use the same number of questions"),
        )
        .otherwise(F.array(*checks))
    )
    return row.select(F.inline(chosen))


def health_problems(runs: DataFrame, label: str = "run", limits=HEALTH_LIMITS) -> DataFrame:
    """Measures above their limit, one row each. A run without a measure has no problem there."""
    have = [(m, limit) for m, limit in limits if m in runs.columns]
    pairs = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"), F.lit(limit).alias("limit"))
            for m, limit in have
        ]
    )
    return runs.select(label, F.inline(pairs)).where(F.col("value") > F.col("limit"))


def decision(runs: DataFrame, label: str = "run") -> DataFrame:
    """One row: promoted, kept, or inconclusive when a run was not healthy. Runs are scored once: a row each,
    written down for both questions."""
    runs = pinned(runs, "runs")
    problems = health_problems(runs, label).agg(F.count(F.lit(1))).scalar()
    return gate_checks(runs).agg(F.bool_and("passed").alias("passed"), F.count(F.lit(1)).alias("checks")).select(
        F.when(problems > 0, "inconclusive").when(F.col("passed"), "promoted").otherwise("kept").alias("decision"),
        "passed",
        problems.alias("health_problems"),
    )


def register_versions(registry: DataFrame, texts: DataFrame) -> DataFrame:
    """Texts (seq, text) -> rows to add (version, text, fingerprint), in order of first arrival.

    A text that is registered already gets no new version. Numbers go on from the highest. They
    are given per range of `seq`, from counts of the ranges before, so no single task numbers all.
    """
    new = (
        texts.groupBy(F.sha2("text", 256).alias("_digest"))
        .agg(F.min("seq").alias("seq"), F.any_value("text").alias("text"))
        .join(registry.select(F.sha2("text", 256).alias("_digest")).distinct(), "_digest", "left_anti")
    )
    highest = registry.agg(F.coalesce(F.max("version"), F.lit(0))).scalar()
    return number_rows(new, "seq").select(
        (highest + F.col("position")).cast("bigint").alias("version"), "text", fingerprint(F.col("text")).alias("fingerprint")
    )


def number_rows(df: DataFrame, order: str, block: int = 1_000_000) -> DataFrame:
    """Add `position`, 1 to n in the order of a unique column.

    Rows are dealt into ranges of about `block` rows, by bounds that Spark samples, so it does not matter
    how the values are spread. A range starts after the counts of the ranges before it, a number for
    each; rows are numbered within their range.
    """
    n = df.count()
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-n // block))
    ranged = pinned(df.repartitionByRange(parts, F.col(order)).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = sorted(tuple(r) for r in ranged.groupBy("_range").agg(F.count(F.lit(1))).collect())  # a row for each range
    before = [0, *accumulate(size for _, size in sizes)]
    offsets = df.sparkSession.createDataFrame([(number, start) for (number, _), start in zip(sizes, before)], "_range int, _before bigint")
    within = F.row_number().over(Window.partitionBy("_range").orderBy(order))
    numbered = ranged.withColumn("_within", within).join(F.broadcast(offsets), "_range")
    return numbered.withColumn("position", F.col("_before") + F.col("_within")).drop("_range", "_within", "_before")


def set_alias(aliases: DataFrame, alias: str, version: int) -> DataFrame:
    """Alias table (alias, version) with one alias moved."""
    spark = aliases.sparkSession
    moved = spark.createDataFrame([(alias, version)], "alias string, version bigint")
    return aliases.where(F.col("alias") != alias).unionByName(moved)


def promote(aliases: DataFrame, version: int) -> DataFrame:
    """Move production to a version and remember what it was before."""
    was = aliases.where(F.col("alias") == PRODUCTION).select(F.lit(PREVIOUS).alias("alias"), "version")
    others = aliases.where(~F.col("alias").isin(PRODUCTION, PREVIOUS))
    return set_alias(others.unionByName(was), PRODUCTION, version)


def roll_back(aliases: DataFrame) -> DataFrame:
    """Swap production and previous. Without a previous version nothing changes."""
    swap = F.when(F.col("alias") == PRODUCTION, PREVIOUS).when(F.col("alias") == PREVIOUS, PRODUCTION).otherwise(F.col("alias"))
    has_previous = aliases.agg(F.bool_or(F.col("alias") == PREVIOUS)).scalar()
    return aliases.withColumn("alias", F.when(has_previous, swap).otherwise(F.col("alias")))
