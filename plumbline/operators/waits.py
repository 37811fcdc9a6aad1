"""Monthly statistics: raw text columns -> typed, enriched rows -> latest-month table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.joins import join_sized
from plumbline.operators.quality import ORDERS, REASONS

# The published column names and ours, the code of the national total, the code
# of "all specialties", and the qualifier that marks a derived (aggregate) row.
RAW_COLUMNS = {
    "MonthEnding": "month_ending",
    "HBT": "hbt",
    "HBTQF": "hbt_qf",
    "PatientType": "patient_type",
    "Specialty": "specialty",
    "SpecialtyQF": "specialty_qf",
    "NumberWaiting": "number_waiting",
    "NumberWaitingQF": "number_waiting_qf",
    "NumberWaitingOver12Weeks": "waiting_over_12_weeks",
    "NumberWaitingOver12WeeksQF": "waiting_over_12_weeks_qf",
    "Median": "median_wait_days",
    "MedianQF": "median_wait_days_qf",
    "90thPercentile": "p90_wait_days",
    "90thPercentileQF": "p90_wait_days_qf",
}
COUNTS = ("number_waiting", "waiting_over_12_weeks")
PERCENTILES = ("median_wait_days", "p90_wait_days")
NATIONAL = "S92000003"
NATIONAL_NAME = "Scotland"
ALL_SPECIALTIES = "Z9"
DERIVED = "d"

# A number as a CSV reader would take it; keeps try_cast from accepting '1d' or 'NaN'.
NUMBER = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"


class SchemaError(ValueError):
    """A source no longer has the columns a job needs."""


def require_columns(df: DataFrame, needed) -> DataFrame:
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise SchemaError(f"columns missing from the source: {missing}")
    return df


def rename(df: DataFrame, names: dict[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Only the named columns, under their new names (and those in `keep` as they are)."""
    require_columns(df, [*names, *keep])
    return df.select(*[F.col(old).alias(new) for old, new in names.items()], *keep)


def to_date(c: Column, pattern: str = "yyyyMMdd") -> Column:
    """Date of a text of eight digits, NULL when it is not one."""
    return F.when(c.rlike("^[0-9]{8}$"), F.try_to_date(c, pattern))


def to_number(c: Column, type_name: str = "double") -> Column:
    """Number of a text, NULL when it is not one."""
    return F.when(c.rlike(NUMBER), F.trim(c).try_cast("double")).try_cast(type_name)


def share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole)


def merge_lookups(*sources: tuple[DataFrame, str, str], constants: dict[str, str] | None = None) -> DataFrame:
    """One (code, name) row per code. A later source wins, in a source the last row of its file (these are
    small and read in one piece), constants win over all."""
    ranked = [
        df.select(F.col(code).alias("code"), F.col(name).alias("name"), F.lit(i).alias("_rank"), F.monotonically_increasing_id().alias("_row"))
        for i, (df, code, name) in enumerate(sources)
    ]
    if constants:
        spark = sources[0][0].sparkSession
        ranked.append(
            spark.createDataFrame(list(constants.items()), "code string, name string").withColumn(
                "_rank", F.lit(len(sources))
            ).withColumn("_row", F.lit(0).cast("bigint"))
        )
    union = reduce(DataFrame.unionByName, ranked)
    return union.groupBy("code").agg(F.max_by("name", F.struct("_rank", "_row")).alias("name"))


def look_up(df: DataFrame, lookup: DataFrame, code: str, name: str) -> DataFrame:
    """Add `name` for `code`; unknown codes keep their row and get NULL.

    `lookup` has one row per code, so no row is multiplied. It is broadcast when it was measured
    and is small; otherwise hot codes are salted.
    """
    side = lookup.select(F.col("code").alias(code), F.col("name").alias(name))
    return join_sized(df, side, code, spread=df.columns, how="left")


def to_silver(raw: DataFrame, boards: DataFrame, specialties: DataFrame) -> DataFrame:
    """Rename, type and enrich. No row is removed here; the quality rules decide that.

    Numbers stay as they are written until the rules have seen them; `whole_counts` makes the counts whole.
    What orders the rows (place in the file, publisher's number) is carried along, where there is any.
    """
    df = rename(raw, RAW_COLUMNS, keep=tuple(c for c in ORDERS if c in raw.columns))
    df = df.withColumns(
        {
            "month_ending": to_date(F.col("month_ending")),
            **{c: to_number(F.col(c)) for c in (*COUNTS, *PERCENTILES)},
        }
    )
    df = look_up(df, boards, "hbt", "board_name")
    df = look_up(df, specialties, "specialty", "specialty_name")
    return df.withColumns(
        {
            "is_scotland": F.coalesce(F.col("hbt") == NATIONAL, F.lit(False)),
            "is_all_specialties": F.coalesce(F.lower("specialty_qf") == DERIVED, F.lit(False))
            | F.coalesce(F.col("specialty") == ALL_SPECIALTIES, F.lit(False)),
            "share_over_12_weeks": share(F.col("waiting_over_12_weeks"), F.col("number_waiting")),
        }
    )


def whole_counts(df: DataFrame) -> DataFrame:
    """Counts as BIGINT, as the stored tables have them."""
    return df.withColumns({c: F.col(c).cast("bigint") for c in COUNTS})


def latest_only(df: DataFrame, period: str) -> DataFrame:
    """Rows of the newest period. The subquery reads one column and pushes down to the scan."""
    return df.where(F.col(period) == df.agg(F.max(period)).scalar())


def latest_waits(silver: DataFrame) -> DataFrame:
    """The latest month per board, specialty and patient type, as the lookups serve it."""
    return (
        latest_only(silver, "month_ending")
        .where(F.col("board_name").isNotNull() & F.col("number_waiting").isNotNull())
        .select(
            F.col("month_ending").cast("date").alias("month_ending"),
            "board_name",
            F.col("hbt").alias("board_code"),
            "is_scotland",
            "patient_type",
            F.col("specialty").alias("specialty_code"),
            "specialty_name",
            "is_all_specialties",
            *[F.col(c).cast("int").alias(c) for c in COUNTS],
            F.round(100 * F.col("share_over_12_weeks"), 1).alias("pct_over_12_weeks"),
            *PERCENTILES,
        )
    )


def with_lineage(df: DataFrame, **values) -> DataFrame:
    """Constant lineage columns: source file, hash, run id, load time, table name."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def run_summary(kept: DataFrame) -> DataFrame:
    """One row describing a load: rows, months, distinct codes, types, national totals."""
    total = F.col("is_scotland") & F.col("is_all_specialties")
    return kept.agg(
        F.count(F.lit(1)).alias("silver_rows"),
        F.concat(
            F.date_format(F.min("month_ending"), "yyyy-MM"),
            F.lit(" to "),
            F.date_format(F.max("month_ending"), "yyyy-MM"),
        ).alias("months"),
        F.count_distinct("hbt").alias("boards"),
        F.count_distinct("specialty").alias("specialties"),
        F.array_join(F.array_sort(F.collect_set("patient_type")), ",").alias("patient_types"),
        F.count_if(total).alias("scotland_all_specialty_rows"),
    )


def top_codes(df: DataFrame, code: str, n: int = 5) -> DataFrame:
    """Most frequent codes; equal counts in code order."""
    return df.groupBy(code).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), code).limit(n)


def unknown_boards(kept: DataFrame, n: int = 5) -> DataFrame:
    return top_codes(kept.where(F.col("board_name").isNull()), "hbt", n)


def unknown_specialties(kept: DataFrame, n: int = 5) -> DataFrame:
    return top_codes(kept.where(F.col("specialty_name").isNull() & ~F.col("is_all_specialties")), "specialty", n)


def blank_counts(kept: DataFrame) -> DataFrame:
    """Rows without a count, per patient type."""
    return (
        kept.where(F.col("number_waiting").isNull())
        .groupBy("patient_type")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def load_report(judged: DataFrame) -> DataFrame:
    """One row describing a load, from its judged rows: raw, kept and rejected rows, and of the kept ones what
    `run_summary` says, the most frequent unknown codes and the rows without a count per patient type.

    One pass: three grouping sets count boards, specialties and patient types in partial aggregates; what
    is left is a row per code.
    """
    stays = F.col(REASONS) == ""
    rows = judged.select(
        F.when(stays, F.col("hbt")).alias("hbt"), F.when(stays, F.col("specialty")).alias("specialty"), F.when(stays, F.col("patient_type")).alias("type"),
        (stays & F.col("board_name").isNull()).alias("no_board"), (stays & F.col("specialty_name").isNull() & ~F.col("is_all_specialties")).alias("no_specialty"),
        stays.alias("stays"), F.when(stays, F.col("month_ending")).alias("month"), (stays & F.col("is_scotland") & F.col("is_all_specialties")).alias("national"),
        (stays & F.col("number_waiting").isNull()).alias("blank"),
    )
    count = lambda c: F.count_if(F.col(c)).alias(c)
    codes = rows.groupingSets([["hbt"], ["specialty"], ["type"]], "hbt", "specialty", "type").agg(
        F.count(F.lit(1)).alias("n"), F.min("month").alias("first"), F.max("month").alias("last"), F.grouping_id().alias("level"),
        *[count(c) for c in ("stays", "national", "blank", "no_board", "no_specialty")],
    )
    board, specialty, kind = (F.col("level") == i for i in (3, 5, 6))

    def top(level: Column, code: str, n: str) -> Column:
        entry = F.when(level & (F.col(n) > 0), F.struct((-F.col(n)).alias("less"), F.col(code).alias("code"), F.col(n).alias("rows")))
        best = F.slice(F.array_sort(F.collect_list(entry)), 1, 5)
        return F.transform(best, lambda e: F.struct(e["code"].alias("code"), e["rows"].alias("rows")))

    types = F.array_sort(F.collect_list(F.when(kind, F.col("type"))))
    blank = F.array_sort(F.collect_list(F.when(kind & (F.col("blank") > 0), F.struct(F.col("type").alias("code"), F.col("blank").alias("rows")))))
    month = lambda c: F.date_format(c, "yyyy-MM")
    total = lambda c: F.coalesce(F.sum(F.when(kind, F.col(c))), F.lit(0)).cast("bigint")
    return codes.agg(
        total("n").alias("raw_rows"),
        total("stays").alias("silver_rows"),
        (total("n") - total("stays")).alias("rejected_rows"),
        F.concat(month(F.min("first")), F.lit(" to "), month(F.max("last"))).alias("months"),
        F.count_if(board & F.col("hbt").isNotNull()).alias("boards"),
        F.count_if(specialty & F.col("specialty").isNotNull()).alias("specialties"),
        types.alias("patient_types"),
        total("national").alias("scotland_all_specialty_rows"),
        top(board, "hbt", "no_board").alias("unknown_boards"),
        top(specialty, "specialty", "no_specialty").alias("unknown_specialties"),
        blank.alias("blank_counts"),
    )


def failed_map(results: DataFrame) -> DataFrame:
    """One row: rule -> failed rows, for the rules that failed. As many entries as rules."""
    entries = F.collect_list(F.struct("expectation", "failed_rows"))
    return results.where(F.col("failed_rows") > 0).agg(
        F.map_from_entries(F.array_sort(entries)).alias("failed_expectations")
    )
