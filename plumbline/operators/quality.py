"""Data-quality rules: one boolean column each, counted in one pass, with reasons."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.session import is_small, pinned

KEY = ("month_ending", "hbt", "patient_type", "specialty")
MAX_AGE_DAYS = 120
UNIQUE = "unique_key"
REASONS = "failed_expectations"
ORDERS = ("_place", "_id")  # columns that order rows, the first one there is


@dataclass(frozen=True)
class Rule:
    """`passes` is true for good rows; NULL counts as failed. Severity is drop or warn."""

    name: str
    severity: str
    passes: Column

    @property
    def failed(self) -> Column:
        return ~F.coalesce(self.passes, F.lit(False))


def waits_rules(today: dt.date) -> list[Rule]:
    c = F.col

    def unknown_or(check: Column) -> Column:
        return F.coalesce(check, F.lit(True))

    return [
        Rule("valid_month", "drop", c("month_ending").isNotNull()),
        Rule("month_not_in_future", "drop", unknown_or(c("month_ending") <= F.lit(today))),
        Rule("board_present", "drop", F.length("hbt") > 0),
        Rule(
            "non_negative_counts",
            "drop",
            unknown_or(c("number_waiting") >= 0) & unknown_or(c("waiting_over_12_weeks") >= 0),
        ),
        Rule(
            "over_12_weeks_within_total",
            "drop",
            unknown_or(c("waiting_over_12_weeks") <= c("number_waiting")),
        ),
        Rule("median_not_above_p90", "warn", unknown_or(c("median_wait_days") <= c("p90_wait_days"))),
        Rule("count_present", "warn", c("number_waiting").isNotNull()),
        Rule("known_board", "warn", c("board_name").isNotNull()),
        Rule(
            "known_specialty",
            "warn",
            c("specialty_name").isNotNull() | (c("specialty") == "") | c("is_all_specialties"),
        ),
    ]


def with_reasons(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Names of the failed drop rules in rule order, joined by `;`; '' when none failed."""
    reasons = [F.when(r.failed, F.lit(r.name)) for r in rules if r.severity == "drop"]
    return df.withColumn(REASONS, F.concat_ws(";", *reasons))


def order_of(df: DataFrame) -> str | None:
    """The column that says which of two rows came later: the place in the file, else the publisher's number."""
    return next((c for c in ORDERS if c in df.columns), None)


def last_rows(df: DataFrame, key: Sequence[str], order: str | None, among: Column) -> tuple[DataFrame, DataFrame]:
    """(the rows with `_among` and a `_number` of their own, written once; the numbers of the last row per key `among` them)."""
    held = df.withColumns({"_among": among, "_number": F.monotonically_increasing_id()})
    held = pinned(held, "numbered")
    place = F.struct(*[F.col(order)] if order else [], "_number")
    last = held.where("_among").groupBy(*key).agg(F.max(place).alias("_last"))
    return held, last.select(F.col("_last._number").alias("_number"), F.lit(True).alias("_stays"))


def _marked(held: DataFrame, last: DataFrame, columns: Sequence[str]) -> DataFrame:
    joined = held.join(last, "_number", "left")
    return joined.select(*columns, (F.col("_among") & F.col("_stays").isNull()).alias("_superseded"))


def mark_superseded(df: DataFrame, key: Sequence[str], order: str | None, among: Column) -> DataFrame:
    """Add `_superseded`: a later row with the same key exists `among` the same rows.

    Rows are written once with a number of their own, so exactly one row of a key stays: where `order` is
    null (before all others), equal or not given, the number decides. The last row per key is a partial
    aggregate; rows find it by that number, so a key that holds a third of all rows is no hot partition.
    """
    return _marked(*last_rows(df, key, order, among), df.columns)


def keep_last(df: DataFrame, key: Sequence[str], order: str | None) -> DataFrame:
    """The last row per key, exactly one."""
    return mark_superseded(df, key, order, F.lit(True)).where(~F.col("_superseded")).drop("_superseded")


def judge(df: DataFrame, rules: Sequence[Rule], key: Sequence[str] = KEY, order: str | None = None) -> DataFrame:
    """Every row with the reasons it is rejected for, '' when it is kept.

    Duplicates are looked for among rows that pass all drop rules only; the last one stays, by `order` or
    what `order_of` finds.
    """
    return _judged(mark_superseded(with_reasons(df, rules), key, order or order_of(df), F.col(REASONS) == ""))


def _judged(marked: DataFrame) -> DataFrame:
    return marked.withColumn(
        REASONS, F.when(F.col("_superseded"), F.lit(UNIQUE)).otherwise(F.col(REASONS))
    ).drop("_superseded")


def judge_once(df: DataFrame, rules: Sequence[Rule], key: Sequence[str] = KEY, order: str | None = None) -> DataFrame:
    """What `judge` gives, without the columns that order rows, for several readers: none of them judges again.

    Where the rows that stay were measured and are few, their numbers are written, and each reader marks the rows
    by broadcast; otherwise the judged rows are written.
    """
    rows = with_reasons(df, rules)
    held, last = last_rows(rows, key, order or order_of(df), F.col(REASONS) == "")
    last = pinned(last, "last-rows")
    few = is_small(last)
    judged = _judged(_marked(held, F.broadcast(last) if few else last, [c for c in rows.columns if c not in ORDERS]))
    return judged if few else pinned(judged, "judged")


def kept(judged: DataFrame) -> DataFrame:
    return judged.where(F.col(REASONS) == "").drop(REASONS)


def rejects(judged: DataFrame) -> DataFrame:
    return judged.where(F.col(REASONS) != "")


def _entry(name: str, severity: str, failed: Column, total: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(name).alias("expectation"),
        F.lit(severity).alias("severity"),
        failed.cast("bigint").alias("failed_rows"),
        total.cast("bigint").alias("total_rows"),
        F.when(total > 0, 1 - failed / total).otherwise(F.lit(1.0)).alias("pass_rate"),
        detail.alias("detail"),
    )


def _counts(rules: Sequence[Rule]) -> list[Column]:
    failed = [F.count_if(r.failed).alias(f"_f{i}") for i, r in enumerate(rules)]
    return [F.count(F.lit(1)).alias("_total"), *failed]


def _rule_entries(rules: Sequence[Rule]) -> list[Column]:
    return [_entry(r.name, r.severity, F.col(f"_f{i}"), F.col("_total"), F.lit("")) for i, r in enumerate(rules)]


def rule_results(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Failed rows per rule over all rows, counted in one pass over the data."""
    return df.agg(*_counts(rules)).select(F.inline(F.array(*_rule_entries(rules)))).drop("detail")


def unique_key_result(df: DataFrame, rules: Sequence[Rule], key: Sequence[str] = KEY) -> DataFrame:
    """Rows that a later row with the same key replaces. One aggregate, no row is moved."""
    passing = F.col(REASONS) == ""
    per_key = (
        with_reasons(df, rules)
        .withColumn("_passing", passing)
        .groupBy("_passing", *[F.when(passing, F.col(k)).alias(f"_k{i}") for i, k in enumerate(key)])
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    counted = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_total"),
        F.coalesce(F.sum(F.when(F.col("_passing"), F.col("_n") - 1)), F.lit(0)).alias("_dup"),
    )
    entry = _entry(UNIQUE, "drop", F.col("_dup"), F.col("_total"), F.lit(""))
    return counted.select(F.inline(F.array(entry))).drop("detail")


def _freshness_entry(latest: Column, today: dt.date, max_age_days: int) -> Column:
    age = F.date_diff(F.lit(today), latest)
    stale = F.when(F.coalesce(age <= max_age_days, F.lit(False)), 0).otherwise(1)

    def text(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit("None"))

    detail = F.concat(F.lit("latest month "), text(latest), F.lit(", "), text(age), F.lit(" days old"))
    return _entry("fresh_data", "warn", stale, F.lit(1), detail)


def freshness(df: DataFrame, today: dt.date, max_age_days: int = MAX_AGE_DAYS, period: str = "month_ending") -> DataFrame:
    """Table-level warning: the newest period is older than `max_age_days`."""
    newest = df.agg(F.max(period).cast("date").alias("_latest"))
    return newest.select(F.inline(F.array(_freshness_entry(F.col("_latest"), today, max_age_days))))


def results(df: DataFrame, rules: Sequence[Rule], key: Sequence[str] = KEY, today: dt.date | None = None, period: str = "month_ending") -> DataFrame:
    """All results of a run in long form, ready to append to the history table.

    Rules and freshness come from one pass. The newest period of the rows that pass is that of
    the rows that stay, as a duplicate has the period of the row that replaces it.
    """
    passing = F.lit(True)
    for r in rules:
        if r.severity == "drop":
            passing = passing & ~r.failed
    newest = F.max(F.when(passing, F.col(period))).cast("date").alias("_latest")
    entries = _rule_entries(rules)
    if today is not None:
        entries.append(_freshness_entry(F.col("_latest"), today, MAX_AGE_DAYS))
    counted = df.agg(*_counts(rules), newest).select(F.inline(F.array(*entries)))
    return counted.unionByName(unique_key_result(df, rules, key).withColumn("detail", F.lit("")))


def results_of_judged(judged: DataFrame, rules: Sequence[Rule], today: dt.date, period: str = "month_ending") -> DataFrame:
    """The same results from rows that were judged and stored, in one pass without a shuffle by key."""
    newest = F.max(F.when(F.col(REASONS) == "", F.col(period))).cast("date").alias("_latest")
    replaced = F.count_if(F.col(REASONS) == UNIQUE).alias("_dup")
    entries = [
        *_rule_entries(rules),
        _entry(UNIQUE, "drop", F.col("_dup"), F.col("_total"), F.lit("")),
        _freshness_entry(F.col("_latest"), today, MAX_AGE_DAYS),
    ]
    return judged.agg(*_counts(rules), replaced, newest).select(F.inline(F.array(*entries)))
