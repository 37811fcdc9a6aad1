"""Vector expressions over ARRAY<FLOAT> columns; arithmetic is in DOUBLE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.text import let

MIN_NORM = 1e-12  # fixed value: floor of the norm


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_normalise(v: Column) -> Column:
    norm = F.greatest(F.sqrt(dot(v, v)), F.lit(MIN_NORM))
    return let(norm, lambda n: F.transform(v, lambda x: x.cast("double") / n))


def cosine(a: Column, b: Column) -> Column:
    floor = F.lit(MIN_NORM)
    return dot(a, b) / (F.greatest(F.sqrt(dot(a, a)), floor) * F.greatest(F.sqrt(dot(b, b)), floor))
