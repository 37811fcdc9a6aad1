"""Small relational operators: merged filters, schema conformance, top-n, medians, shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_FILTERS = {"status": "current"}  # fixed value: superseded documents stay out
ROW_CAP = 20  # fixed value: rows a lookup returns


def with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row, whatever is built on them.

    Spark puts a plain column's expression into every filter above it, also into the ones it
    derives itself from explode(). Nothing is moved below a generator, so one that emits a
    single element pins the value.
    """
    for name, value in columns.items():
        kept = [c for c in df.columns if c != name]
        df = df.select(*kept, F.explode(F.array(value)).alias(name))
    return df


def merged_filter(filters: dict | None = None, defaults: dict = DEFAULT_FILTERS) -> Column:
    """Equality filters over the defaults; a caller may add filters or override a default."""
    out = F.lit(True)
    for name, value in {**defaults, **(filters or {})}.items():
        out = out & (F.col(name) == F.lit(value))
    return out


def only_ids(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    return df.join(ids.select(column).distinct(), column, "left_semi")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in table order and of the table's types; missing ones are NULL.

    Texts become dates only when they are ISO dates, NaN becomes NULL, timestamps become dates.
    """
    have = {f.name: f.dataType for f in df.schema}
    out = []
    for field in schema:
        if field.name not in have:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        c, source = F.col(field.name), have[field.name]
        if isinstance(source, T.FractionalType) and not isinstance(source, T.DecimalType):
            c = F.when(~F.isnan(c), c)
        if isinstance(field.dataType, T.DateType) and isinstance(source, T.StringType):
            c = F.try_to_date(c, "yyyy-MM-dd")
        out.append(c.cast(field.dataType).alias(field.name))
    return df.select(*out)


def upper_median(column: str) -> Column:
    """Element n // 2 (from 0) of the sorted values: the upper one of two middle values.

    Read from the top, that is the 0.5 quantile. The state holds one entry per distinct value,
    which the token budget bounds, so no group is collected.
    """
    return F.expr(f"cast(percentile_disc(0.5) within group (order by `{column}` desc) as int)")


def share_of_total(df: DataFrame, *keys: Column, name: str = "traces") -> DataFrame:
    """Rows per group and their percentage of all rows."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    everything = counted.agg(F.sum(name)).scalar()
    return counted.withColumn("pct", F.round(100 * F.col(name) / everything, 1))


def top_rows(df: DataFrame, n: int, *order) -> DataFrame:
    """Ordered result with a limit; plans as TakeOrderedAndProject, never a full sort."""
    return df.orderBy(*order).limit(n)
