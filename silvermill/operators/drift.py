"""What the elements of a JSON array column hold, beside what is declared of them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

_WHOLE = ("tinyint", "smallint", "int", "integer", "bigint", "long")
_NUMBERS = ("float", "double")


def _fits(value: Column, kind: str) -> Column:
    """Whether a JSON value is of the declared type, null being of every type."""
    found = F.schema_of_variant(value)
    if kind in _WHOLE:
        of_kind = (found == "BIGINT") & F.try_variant_get(value, "$", kind).isNotNull()
    elif kind in _NUMBERS or kind.startswith("decimal"):
        of_kind = found.isin("BIGINT", "DOUBLE") | found.startswith("DECIMAL")
    elif kind == "boolean":
        of_kind = found == "BOOLEAN"
    elif kind == "string":
        of_kind = found == "STRING"
    else:
        of_kind = F.try_variant_get(value, "$", kind).isNotNull()
    return of_kind | (found == "VOID")


def element_drift(df: DataFrame, column: str, element: Mapping[str, str]) -> DataFrame:
    """One row per field: field, declared, n_elements that have it, n_null, n_other_type.

    The text is parsed once, to a variant, and each element's fields are looked at
    as they are; `from_json` would drop a field that is not declared and turn one
    of another type to null. Declared fields that no element has are there with 0. A lone
    object is an array of one. Elements that are no objects are counted under a
    null field as of another type. Text that is no JSON has no elements.
    """
    text = F.ltrim(F.col(column))
    whole = F.when(text.startswith("{"), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    spark = df.sparkSession
    parsed = df.select(F.try_parse_json(whole).alias("array")).where(
        F.schema_of_variant("array").startswith("ARRAY")
    )
    elements = parsed.lateralJoin(spark.tvf.variant_explode(F.col("array").outer())).select(
        F.col("value").alias("item")
    )
    is_object = F.schema_of_variant("item").startswith("OBJECT")
    fields = elements.where(is_object).lateralJoin(spark.tvf.variant_explode(F.col("item").outer())).select(
        F.col("key").alias("field"), "value"
    )
    fits = F.lit(True)
    for name, kind in element.items():
        fits = F.when(F.col("field") == name, _fits(F.col("value"), kind)).otherwise(fits)
    counted = fields.groupBy("field").agg(
        F.count("*").alias("n_elements"),
        F.count_if(F.schema_of_variant("value") == "VOID").alias("n_null"),
        F.count_if(~fits).alias("n_other_type"),
    )
    declared = spark.createDataFrame([(name,) for name in element], "declared_field string")
    by_field = declared.join(counted, F.col("declared_field") == F.col("field"), "full_outer").select(
        F.coalesce("declared_field", "field").alias("field"),
        F.col("declared_field").isNotNull().alias("declared"),
        *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in ("n_elements", "n_null", "n_other_type")],
    )
    odd = elements.where(~is_object).groupBy().agg(
        F.lit(None).cast("string").alias("field"), F.lit(False).alias("declared"),
        F.count("*").alias("n_elements"),
        F.count_if(F.schema_of_variant("item") == "VOID").alias("n_null"),
        F.count("*").alias("n_other_type"),
    ).where(F.col("n_elements") > 0)
    return by_field.unionByName(odd)
