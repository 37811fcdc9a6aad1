"""Judging and reading JSON tool output with VARIANT expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.text import let, strip


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _is_object(kind: Column) -> Column:
    return kind.startswith("OBJECT")


def _truthy(v: Column, kind: Column) -> Column:
    """Empty containers, empty text, zero, false and null do not count."""
    text = F.to_json(v)
    return (
        F.when(_is_object(kind), text != "{}")
        .when(kind.startswith("ARRAY"), text != "[]")
        .when(kind == "STRING", text != '""')
        .when(kind == "BOOLEAN", text == "true")
        .when(kind == "VOID", F.lit(False))
        .otherwise(F.coalesce(F.try_variant_get(v, "$", "double") != 0, F.lit(True)))
    )


def is_successful(output: Column) -> Column:
    """The call returned something: no error object, no empty result, no blank text."""

    def judge(v: Column) -> Column:
        kind = _kind(v)
        rows = F.try_variant_get(v, "$.rows", "array<variant>")
        return (
            F.when(v.isNull(), strip(output) != "")
            .when(_is_object(kind) & has_key(v, "error"), F.lit(False))
            .when(_is_object(kind) & rows.isNotNull(), F.size(rows) > 0)
            .otherwise(_truthy(v, kind))
        )

    return F.coalesce(let(F.try_parse_json(output), judge), F.lit(False))


def has_key(v: Column, key: str) -> Column:
    """Is the key there, be its value null or not?"""
    return F.array_contains(F.json_object_keys(F.to_json(v)), key)


def tool_failed(output: Column) -> Column:
    """The output is an error object. Empty results and plain text are not errors."""
    return F.coalesce(
        let(F.try_parse_json(output), lambda v: _is_object(_kind(v)) & has_key(v, "error")),
        F.lit(False),
    )


def attribute_matches(attributes: Column, key_pattern: str, value: str) -> Column:
    """Does the attributes' JSON text hold the key with a value containing `value`?

    Works whatever the quoting: values may themselves be JSON text.
    """
    return F.to_json(attributes).rlike(f"{key_pattern}[^,}}]*{value}")


def rows_as_objects(output: Column, row_schema: str) -> Column:
    """`{columns, rows}` with rows as arrays or as objects -> array of row structs.

    `row_schema` is the DDL of one row, all STRING fields.
    """
    columns = F.from_json(F.get_json_object(output, "$.columns"), "array<string>")
    arrays = F.from_json(F.get_json_object(output, "$.rows"), "array<array<string>>")
    objects = F.from_json(F.get_json_object(output, "$.rows"), f"array<struct<{row_schema}>>")
    names = F.transform(columns, lambda c: F.coalesce(F.get_json_object(c, "$.name"), c))
    fields = [f.split()[0] for f in row_schema.split(",")]

    def build(listed: Column) -> Column:
        return F.transform(
            arrays,
            lambda r: F.struct(*[F.get(r, F.array_position(listed, F.lit(f)).cast("int") - 1).alias(f) for f in fields]),
        )

    named = let(names, lambda listed: build(listed))
    return F.when(columns.isNotNull(), named).otherwise(objects)
