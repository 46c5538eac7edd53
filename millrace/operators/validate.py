"""Line-by-line validation of chat examples.

Lines are read as text and parsed to VARIANT, because a typed JSON read would
turn a number into a string instead of reporting it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators.chat import MESSAGE

ROLES = ("system", "user", "assistant")


class DatasetInvalid(ValueError):
    """Raised when a dataset has invalid lines."""


def _kind(v: Column, path: str) -> Column:
    """Type name of a field: null if absent, VOID for JSON null."""
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def check_lines(lines: DataFrame) -> DataFrame:
    """(line, errors) for lines (``line_no``, ``line``); blank lines are skipped but numbered.

    A line that breaks the schema gets only its schema errors; role rules apply
    to lines that pass it.
    """
    v = F.col("_v")
    parsed = lines.where(~text.is_blank(F.col("line"))).select("line_no", F.try_parse_json("line").alias("_v"))
    parsed = parsed.withColumns(
        {
            "_is_object": F.coalesce(F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), F.lit(False)),
            "_items": F.try_variant_get(v, "$.messages", "array<variant>"),
            "_category": _kind(v, "$.category"),
            "_typed": F.try_variant_get(v, "$.messages", f"array<{MESSAGE}>"),
            "_category_text": F.try_variant_get(v, "$.category", "string"),
        }
    )

    def content_kind(m: Column) -> Column:
        return F.coalesce(_kind(m, "$.content"), F.lit(""))

    def role_kind(m: Column) -> Column:
        return F.coalesce(_kind(m, "$.role"), F.lit(""))

    items = F.col("_items")
    bad_role = F.exists(
        items,
        lambda m: (role_kind(m) != "STRING")
        | ~F.coalesce(F.try_variant_get(m, "$.role", "string").isin(*ROLES), F.lit(False)),
    )
    bad_content = F.exists(
        items,
        lambda m: (content_kind(m) != "STRING")
        | (F.coalesce(F.length(F.try_variant_get(m, "$.content", "string")), F.lit(0)) < 1),
    )
    bad_category = (F.coalesce(F.col("_category"), F.lit("")) != "STRING") | (
        F.coalesce(F.length("_category_text"), F.lit(0)) < 1
    )
    schema_errors = F.array_compact(
        F.array(
            F.when(v.isNull(), F.lit("not valid JSON")),
            F.when(v.isNotNull() & ~F.col("_is_object"), F.lit("not an object")),
            F.when(F.col("_is_object") & items.isNull(), F.lit("messages: a list is required")),
            F.when(F.size(items) < 3, F.lit("messages: at least 3 required")),
            F.when(bad_role, F.lit("role: must be system, user or assistant")),
            F.when(bad_content, F.lit("content: a non-empty string is required")),
            F.when(F.col("_is_object") & bad_category, F.lit("category: a non-empty string is required")),
        )
    )
    typed = parsed.select("line_no", F.col("_typed").alias("messages"), schema_errors.alias("_schema"))
    return typed.select(
        "line_no",
        F.when(F.size("_schema") > 0, F.col("_schema")).otherwise(role_errors(F.col("messages"))).alias("errors"),
    )


def role_errors(messages: Column) -> Column:
    """Order rules of one example: system first, assistant last, last content not blank."""
    first, last = F.get(messages, F.lit(0)), F.element_at(messages, -1)
    return F.array_compact(
        F.array(
            F.when(first["role"] != "system", F.concat(F.lit("first message must be system, got "), first["role"])),
            F.when(last["role"] != "assistant", F.concat(F.lit("last message must be assistant, got "), last["role"])),
            F.when(text.is_blank(last["content"]), F.lit("empty assistant content")),
        )
    )


def example_errors(examples: DataFrame) -> DataFrame:
    """Add ``errors`` to typed chat examples (``messages``, ``category``)."""
    messages = F.col("messages")
    shape = F.array_compact(
        F.array(
            F.when(F.coalesce(F.size(messages), F.lit(0)) < 3, F.lit("messages: at least 3 required")),
            F.when(
                F.exists(messages, lambda m: ~F.coalesce(m["role"].isin(*ROLES), F.lit(False))),
                F.lit("role: must be system, user or assistant"),
            ),
            F.when(
                F.exists(messages, lambda m: F.coalesce(F.length(m["content"]), F.lit(0)) < 1),
                F.lit("content: a non-empty string is required"),
            ),
            F.when(
                F.coalesce(F.length("category"), F.lit(0)) < 1,
                F.lit("category: a non-empty string is required"),
            ),
        )
    )
    return examples.withColumn("_shape", shape).withColumn(
        "errors", F.when(F.size("_shape") > 0, F.col("_shape")).otherwise(role_errors(messages))
    ).drop("_shape")


def explode_errors(checked: DataFrame, line: str = "line_no") -> DataFrame:
    return checked.select(line, F.posexplode("errors").alias("error_no", "error"))


def verdict(checked: DataFrame) -> DataFrame:
    """One row: examples checked, errors found."""
    return checked.agg(
        F.count(F.lit(1)).alias("examples"), F.coalesce(F.sum(F.size("errors")), F.lit(0)).alias("errors")
    )


def require_valid(checked: DataFrame, show: int = 20, line: str = "line_no") -> None:
    """Raise :class:`DatasetInvalid` with the first errors, if there are any."""
    totals = verdict(checked).first()
    if totals["errors"]:
        first = explode_errors(checked, line).orderBy(line, "error_no").limit(show).collect()
        shown = "; ".join(f"line {r[line]}: {r['error']}" for r in first)
        raise DatasetInvalid(f"{totals['examples']} examples, {totals['errors']} errors: {shown}")
